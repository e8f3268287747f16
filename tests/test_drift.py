from dataclasses import replace
from datetime import date, datetime
from functools import reduce

import pytest
from legs import bronze_row, bronze_table, renamed
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.operators.drift import (
    MissingColumn,
    NoSources,
    SourceSpec,
    align,
    align_all,
    classify_tables,
    discover_sources,
    missing_groups,
)
from tidemark.plans.inputs import bronze_legs
from tidemark.plans.leadtime import (
    HISTORICAL,
    LEG_TABLE,
    PERIOD,
    STATIC_SOURCES,
    STATIC_TABLE,
    all_sources,
    build_silver,
)

ANY = SourceSpec("p", "t")


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_spec_has_26_required_groups_and_32_columns():
    assert len(LEG_TABLE.required_groups) == 26
    assert len(LEG_TABLE.names) + 1 == 32


def test_optional_columns_are_null_and_typed(spark):
    table = bronze_table(spark, [bronze_row()]).drop("div", "vessel", "customer", "asn_qty")
    aligned = align(table.drop("container_size"), LEG_TABLE, ANY)
    row = one(aligned)
    assert row["div"] is None and row.asn_qty is None and row.container_size is None
    types = dict(aligned.dtypes)
    assert types["asn_qty"] == "double" and types["div"] == "string" and types["etd"] == "date"
    assert types["xfty_to_container_consolidation"] == "timestamp_ntz"


def test_missing_required_column(spark):
    table = bronze_table(spark, [bronze_row()]).drop("etd")
    with pytest.raises(MissingColumn, match="etd"):
        align(table, LEG_TABLE, ANY)
    assert missing_groups(table.columns, LEG_TABLE) == [("etd",)]


def test_first_candidate_wins(spark):
    table = bronze_table(spark, [bronze_row(wh="E1")]).withColumn("whr", F.lit("W9"))
    assert one(align(table, LEG_TABLE, ANY)).wh == "E1"
    assert one(align(table.drop("wh"), LEG_TABLE, ANY)).wh == "W9"


def test_headers_match_in_any_case(spark):
    table = bronze_table(spark, [bronze_row(wh="E1")])
    upper = table.toDF(*[c.upper() for c in table.columns])
    assert one(align(upper, LEG_TABLE, ANY)).wh == "E1"


def test_legacy_layout_swaps_min_and_max(spark):
    row = bronze_row(min_xft_to_received=50.0, max_xft_to_received=30.0)
    table = renamed(bronze_table(spark, [row]), max_min_xfty="min_max_xfty")
    legacy = one(align(table, LEG_TABLE, ANY))
    assert (legacy.min_xft_to_received, legacy.max_xft_to_received) == (30.0, 50.0)
    current = one(align(bronze_table(spark, [row]), LEG_TABLE, ANY))
    assert (current.min_xft_to_received, current.max_xft_to_received) == (50.0, 30.0)


def test_guarded_and_unguarded_legs(spark):
    row = bronze_row(
        gate_in=None, pos_consolidation_to_gate_in=4.0, gate_in_to_etd=45930.0, etd_to_eta=20.0,
        p_u="TBD", eta_to_delivery=9.0, delivery_to_received=9.0,
    )
    aligned = one(align(bronze_table(spark, [row]), LEG_TABLE, ANY))
    assert aligned.pos_consolidation_to_gate_in == 4.0
    assert aligned.gate_in_to_etd is None
    assert aligned.etd_to_eta == 20.0
    assert aligned.eta_to_delivery is None and aligned.delivery_to_received is None


def test_old_dates_count_unless_a_minimum_is_set(spark):
    row = bronze_row(gate_in=datetime(1899, 12, 30), gate_in_to_etd=45930.0)
    table = bronze_table(spark, [row])
    assert one(align(table, LEG_TABLE, ANY)).gate_in_to_etd == 45930.0
    strict = replace(LEG_TABLE, min_valid_date=date(1990, 1, 1))
    assert one(align(table, strict, ANY)).gate_in_to_etd is None


def test_numeric_date_column_is_null(spark):
    table = bronze_table(spark, [bronze_row()]).withColumn("etd", F.lit(45000))
    assert one(align(table, LEG_TABLE, ANY)).etd is None


def test_whole_floats_keep_their_key(spark):
    table = bronze_table(spark, [bronze_row()]).withColumn("folio", F.lit(123.0))
    assert one(align(table, LEG_TABLE, ANY)).folio == "123"


def test_text_in_a_numeric_column_fails(spark):
    table = bronze_table(spark, [bronze_row()]).withColumn("etd_to_eta", F.lit("soon"))
    with pytest.raises(Exception, match="soon"):
        align(table, LEG_TABLE, ANY).collect()


@pytest.mark.parametrize("as_text", [False, True])
def test_window_is_half_open_and_drops_null(spark, as_text):
    days = [datetime(2024, 3, 31), datetime(2024, 4, 1), datetime(2023, 11, 1), None]
    table = bronze_table(spark, [bronze_row(asn=str(i), etd=d) for i, d in enumerate(days)])
    if as_text:
        table = table.withColumn("etd", F.date_format("etd", "M/d/yyyy"))
    q1, q2 = HISTORICAL[1], HISTORICAL[2]
    assert {r.asn for r in align(table, LEG_TABLE, q1).collect()} == {"0", "2"}
    assert {r.asn for r in align(table, LEG_TABLE, q2).collect()} == {"1"}
    assert align(table, LEG_TABLE, ANY).count() == 4


def test_typed_window_reaches_the_scan(spark, folder):
    bronze_table(spark, [bronze_row()]).write.parquet(folder + "/t")
    table = spark.read.parquet(folder + "/t")
    plan = align(table, LEG_TABLE, HISTORICAL[1])._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters" in plan and "GreaterThanOrEqual(etd" in plan and "LessThan(etd" in plan


def test_filter_on_period_removes_other_branches(spark):
    tables = {s.table: bronze_table(spark, [bronze_row()]) for s in HISTORICAL}
    union = align_all(tables, LEG_TABLE, HISTORICAL).filter(F.col(PERIOD) == "2023")
    assert "Union" not in union._jdf.queryExecution().optimizedPlan().toString()


def test_union_does_not_depend_on_source_order(spark):
    tables = {
        s.table: bronze_table(spark, [bronze_row(asn=s.period, etd=datetime(2024, m, 2))])
        for m, s in enumerate(HISTORICAL, start=1)
    }
    tables = {name: df.select(*reversed(df.columns)) for name, df in tables.items()}
    forward = align_all(tables, LEG_TABLE, HISTORICAL)
    backward = align_all(tables, LEG_TABLE, HISTORICAL[::-1])
    assert forward.exceptAll(backward).isEmpty() and backward.exceptAll(forward).isEmpty()


def test_no_sources():
    with pytest.raises(NoSources):
        align_all({}, LEG_TABLE, HISTORICAL)


def test_static_variant_has_an_open_last_window(spark):
    table = bronze_table(spark, [bronze_row(etd=datetime(2030, 1, 1))])
    tables = {HISTORICAL[-1].table: table}
    assert align_all(tables, STATIC_TABLE, STATIC_SOURCES).count() == 1
    assert align_all(tables, LEG_TABLE, HISTORICAL).count() == 0


NAMES = {
    "shipment_lead_time_2025_q3_q3_2025": ("2025_Q3", True),
    "shipment_lead_time_2025_q4_data": ("2025_Q4", True),
    "shipment_lead_time_2026_q1_skipped": ("2026_Q1", False),
    "shipment_lead_time_2025_q2_data": ("2025_Q2", False),
    "shipment_lead_time_2025_q4_summary": ("2025_Q4", False),
    "shipment_lead_time_2025_q4_port_table": ("2025_Q4", False),
    "shipment_lead_time_2025_q4_whr_code": ("2025_Q4", False),
    "copy_of_shipment_lead_time_2025_q3_data": ("2025_Q3", False),
    "shipment_lead_time_2026_q1_old_version_do_not_use": ("2026_Q1", False),
    "shipment_lead_time_2026_q5_data": (None, False),
    "freight_2026_q1_data": (None, False),
}


def test_discovery(spark):
    full = bronze_table(spark, [bronze_row()])
    tables = {name: full for name in NAMES}
    tables["shipment_lead_time_2026_q2_data"] = full.drop("region")
    found = discover_sources(tables, LEG_TABLE, ["shipment_lead_time_2026_q1_SKIPPED"])
    assert [s.table for s in found] == [name for name, (_, ok) in NAMES.items() if ok]
    assert [s.period for s in found] == ["2025_Q3", "2025_Q4"]
    assert all(s.start is None and s.end is None for s in found)

    listing = spark.createDataFrame(
        [(name, full.columns) for name in NAMES], "table_name string, columns array<string>"
    )
    judged = classify_tables(listing, LEG_TABLE.required_groups).collect()
    assert {r.table_name: r.period for r in judged} == {n: p for n, (p, _) in NAMES.items()}


def test_mapped_sources_come_first_and_missing_ones_are_skipped(spark):
    full = bronze_table(spark, [bronze_row()])
    names = ["shipment_lead_time_2026_q1_data", HISTORICAL[0].table, HISTORICAL[3].table]
    sources = all_sources({name: full for name in names})
    assert [s.period for s in sources] == ["2023", "2024_Q3", "2026_Q1"]


def test_silver_edge_rows(spark):
    early, late = datetime(2025, 8, 1, 9), datetime(2025, 8, 2, 9)
    rows = [
        bronze_row(asn="up", _bronze_insert_ts=early, vessel="old"),
        bronze_row(asn="up", _bronze_insert_ts=late, vessel="new"),
        bronze_row(asn="tie", _source_file_name="b.xlsx", vessel="b"),
        bronze_row(asn="tie", _source_file_name="a.xlsx", vessel="a"),
        bronze_row(asn="null", etd=None, vessel="1"),
        bronze_row(asn="null", etd=None, vessel="2"),
        bronze_row(asn="case", wh="e1"),
        bronze_row(asn="case", wh="E1 "),
    ]
    tables = {"shipment_lead_time_2025_q3_data": bronze_table(spark, rows)}
    silver = build_silver(tables, all_sources(tables))
    kept = sorted((r.asn, r.wh, r.vessel) for r in silver.collect())
    assert kept == [
        ("case", "E1", "V1"), ("case", "E1", "V1"), ("null", "E1", "1"), ("tie", "E1", "a"),
        ("up", "E1", "new"),
    ]
    assert silver.columns == [*LEG_TABLE.names[:-2], PERIOD, *LEG_TABLE.names[-2:]]
    assert quality.null_gate(silver, "etd").first().asDict() == {"null_rows": 1, "passed": False}
    assert [(r.asn, r.duplicate_count) for r in quality.duplicate_report(silver).collect()] == [
        ("case", 2)
    ]
    merged = build_silver(tables, all_sources(tables), normalize_first=True)
    assert merged.filter("asn = 'case'").count() == 1


def test_templates_align_to_the_same_canonical_rows(spark):
    """The same legs written in every template come back as the same rows."""
    rows = [bronze_row(asn=str(i), etd=datetime(2024, 1, 1 + i)) for i in range(5)]
    base = bronze_table(spark, rows)

    def text(df, form, *names):
        return df.withColumns({n: F.date_format(n, form) for n in names})

    requested = {
        f"{m}_of_po_head_req_delivery_date": f"{m}_header_delivery_date" for m in ("min", "max")
    }
    swapped = renamed(
        base,
        max_min_xfty="min_max_xfty",
        container_size="continer_size",
        min_xft_to_received="max_xft_to_received",
        max_xft_to_received="min_xft_to_received",
    )
    drifted = [
        base,
        text(swapped, "M/d/yy", "p_u"),
        renamed(text(base, "MM-dd-yyyy", *requested, "asn_receive"), wh="whr", **requested),
        renamed(text(base, "yyyy-MM-dd HH:mm:ss", "etd", "gate_in"), current_eta_port="eta"),
    ]
    aligned = [align(df, LEG_TABLE, ANY) for df in drifted]
    assert reduce(lambda a, b: a.union(b), aligned).distinct().count() == 5


def test_aligned_rows_are_made_once(spark):
    """Dates that a guard reads too do not take a projection of their own."""
    source = SourceSpec("2024_Q1", "t", date(2024, 1, 1), date(2025, 1, 1))
    rows = [bronze_row(p_u="1/30/2024"), bronze_row(p_u="n/a"), bronze_row(etd=None)]
    legs = align(bronze_table(spark, rows), LEG_TABLE, source)
    plan = legs._jdf.queryExecution().optimizedPlan().toString()
    assert sum(line.lstrip(" :+-").startswith("Project [") for line in plan.split("\n")) == 1
    # The window holds no leg without a date; durations to an unknown pick-up are dropped.
    assert sorted((str(r.p_u), r.eta_to_delivery) for r in legs.collect()) == [("2024-01-30", 5.0), ("None", None)]


def test_shaped_tables_keep_the_scan_apart(spark, tmp_path):
    """Scan and filter of a drifted table are followed by a step that ends their method."""
    spark.sql(
        "SELECT 1L l_orderkey, 2L l_partkey, 3L l_suppkey, 4 l_linenumber, 1.0D l_quantity, 2.0D l_extendedprice,"
        " 0.1D l_discount, 0.2D l_tax, 'A' l_returnflag, 'F' l_linestatus, TIMESTAMP_NTZ'1996-05-06 00:00:00' l_shipdate"
    ).write.parquet(f"{tmp_path}/lineitem.parquet")
    for table in bronze_legs(spark, str(tmp_path)).values():
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert plan.index("Project") < plan.index("Coalesce") < plan.index("Filter")
        assert table.rdd.getNumPartitions() == 1
