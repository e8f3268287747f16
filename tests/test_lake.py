"""Masters, layouts, the manifest, logs, and proofs about written tables."""

import os
from dataclasses import replace
from datetime import date, datetime, timedelta, timezone

import duckdb
import pytest
from legs import bronze_row, bronze_table, renamed
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.operators import clustering, publish
from tidemark.operators.drift import MissingColumn, NoSources, SourceSpec, align_all, align_stored
from tidemark.operators.quality import grain_gate
from tidemark.operators.reshape import clustered
from tidemark.plans import leadtime
from tidemark.plans.leadtime import HISTORICAL, LEG_TABLE, bronze_sources, judge_tabs, source_log
from tidemark.sources.erp import JdbcErp, cut_query, range_conditions
from tidemark.sources.files import BadMaster, read_master, read_phases
from tidemark.sources.lake import Lake, Landing

TS = datetime(2026, 1, 2, 3, 4, 5, tzinfo=timezone.utc)


@pytest.fixture
def lake(spark, folder):
    lake = Lake(spark, folder + "/lake")
    lake.create_layers()
    return lake


def csv(folder, text, name="m.csv"):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8") as stream:
        stream.write(text)
    return f"{folder}/{name}"


# ---------------------------------------------------------------- masters


def test_a_master_is_read_by_name(spark, folder):
    path = csv(folder, 'phase_alias,IS_ASSUMPTION,Phase,note,phase_order,benchmark_days,phase_group\n'
                       'al,true,"X, ""y""",n,2,,G\n,false,Z,,1,3,\n')
    rows = [tuple(r) for r in read_phases(spark, path).collect()]
    assert rows == [("Z", None, 1, None, 3, False), ('X, "y"', "al", 2, "G", None, True)]
    assert read_phases(spark, path).dtypes == [
        ("Phase", "string"), ("phase_alias", "string"), ("phase_order", "int"), ("phase_group", "string"),
        ("benchmark_days", "int"), ("is_assumption", "boolean"),
    ]


@pytest.mark.parametrize(("line", "shown"), [
    ("a,one,true", "one"), ("a,1,maybe", "maybe"), ("a,1.5,true", "1.5"), ("a,1", "a,1"), ("a,1,true,more", "more"),
    ("a,99999999999,true", "99999999999"),
])
def test_a_bad_line_is_an_error_whatever_is_read(spark, folder, line, shown):
    path = csv(folder, f"name,n,flag\nok,1,true\n{line}\n")
    master = read_master(spark, path, "name string, n int, flag boolean")
    for use in (master.collect, master.select("name").collect, master.count):
        with pytest.raises(PySparkException) as problem:
            use()
        assert "m.csv" in str(problem.value) and shown in str(problem.value)


def test_headers_that_do_not_fit(spark, folder):
    with pytest.raises(BadMaster, match="n is missing"):
        read_master(spark, csv(folder + "/a", "name,m\nx,1\n"), "name string, n int")
    with pytest.raises(BadMaster, match="more than once"):
        read_master(spark, csv(folder + "/b", "name,n,N\nx,1,2\n"), "name string, n int")
    csv(folder + "/c", "name,n\nx,1\n", "1.csv")
    csv(folder + "/c", "n,name\n1,x\n", "2.csv")
    with pytest.raises(Exception, match="(?i)header"):
        read_master(spark, folder + "/c", "name string, n int").collect()


def test_a_master_without_rows_and_with_line_ends(spark, folder):
    assert read_master(spark, csv(folder, "name,n\n"), "n int").collect() == []
    path = csv(folder, 'name,n\n"two\nlines",1\n', "two.csv")
    assert read_master(spark, path, "name string, n int", multi_line=True).collect() == [("two\nlines", 1)]


# ---------------------------------------------------------------- layouts


def landed(spark, lake):
    """Two tables of one layout, one of another, one that is no source."""
    day = lambda *d: datetime(*d)
    old = bronze_table(spark, [bronze_row(asn="a", etd=day(2023, 1, 5)), bronze_row(asn="late", etd=day(2023, 12, 1)),
                               bronze_row(asn="none", etd=None)])
    new = bronze_table(spark, [bronze_row(asn="b", etd=day(2024, 1, 5)), bronze_row(asn="early", etd=day(2023, 10, 31))])
    other = renamed(bronze_table(spark, [bronze_row(asn="c", etd=day(2025, 8, 1)), bronze_row(asn="open", etd=None)]), wh="WHR")
    return {
        "shipment_lead_time_2023_data": old, "shipment_lead_time_2024_q1_data": new,
        "shipment_lead_time_2025_q3_q3": other, "copy_of_shipment_lead_time_2025_q3_x": other,
        "shipment_lead_time_2025_q4_été": other,
    }


def rows_of(df):
    return sorted(map(str, df.collect()))


def scans(df):
    return df._jdf.queryExecution().optimizedPlan().toString().count("] parquet")


def test_layouts_give_the_rows_of_the_tables(spark, lake):
    tables = landed(spark, lake)
    lake.record([lake.land("bronze", name, table, TS) for name, table in tables.items()])
    stored, sources = bronze_sources(lake)
    assert [s.table for s in sources] == [
        "shipment_lead_time_2023_data", "shipment_lead_time_2024_q1_data", "shipment_lead_time_2025_q3_q3",
        "shipment_lead_time_2025_q4_été",
    ]
    wanted = align_all({n: lake.read("bronze", n) for n in tables}, LEG_TABLE, sources)
    got = align_stored(spark, stored, LEG_TABLE, sources)
    assert got.schema.simpleString() == wanted.schema.simpleString()
    assert rows_of(got) == rows_of(wanted) and got.count() == 6
    assert scans(got) == 2 < scans(wanted) == 4
    # What all windows of a layout share reaches the scan.
    mapped = [s for s in sources if s.end]
    plan = align_stored(spark, stored, LEG_TABLE, [replace(s, start=date(2020, 1, 1)) for s in mapped])
    assert "GreaterThanOrEqual(etd,2020-01-01" in plan._jdf.queryExecution().executedPlan().toString()


def test_the_plan_grows_with_layouts_not_with_tables(spark, lake):
    table = landed(spark, lake)["shipment_lead_time_2025_q3_q3"]
    names = [f"shipment_lead_time_2025_q3_{i}" for i in range(12)]
    lake.record([lake.land("bronze", n, table.limit(1), TS) for n in names])
    stored, sources = bronze_sources(lake)
    assert len(sources) == 12 and scans(align_stored(spark, stored, LEG_TABLE, sources)) == 1
    with pytest.raises(NoSources):
        align_stored(spark, {}, LEG_TABLE, sources)


def test_a_layout_without_a_required_column(spark, lake):
    table = landed(spark, lake)["shipment_lead_time_2023_data"].drop("asn")
    lake.record([lake.land("bronze", HISTORICAL[0].table, table, TS)])
    stored, sources = bronze_sources(lake)
    with pytest.raises(MissingColumn, match="asn"):
        align_stored(spark, stored, LEG_TABLE, sources)


# ---------------------------------------------------------------- manifest and logs


def test_the_newest_landing_counts(spark, lake):
    for hour, columns in ((0, ["a"]), (2, ["a", "B"]), (1, ["c"])):
        df = spark.createDataFrame([tuple(columns)], columns)
        lake.record([lake.land("bronze", "t", df, TS + timedelta(hours=hour))])
    row = lake.manifest("bronze").collect()
    assert [(r.table_name, r.columns, r.types, r.rows) for r in row] == [("t", ["a", "b"], ["string", "string"], 1)]
    assert lake.manifest("silver").collect() == []


def test_tables_that_the_manifest_does_not_know(spark, lake):
    lake.write("bronze", "t", spark.range(3).toDF("ID"))
    lake.record([lake.land("bronze", "u", spark.range(2), TS)])
    assert lake.record_missing("bronze", TS) == ["t"]
    assert lake.record_missing("bronze", TS) == []
    rows = {r.table_name: r for r in lake.manifest("bronze").collect()}
    assert rows["t"].columns == ["id"] and rows["t"].rows is None and rows["u"].rows == 2
    assert spark.read.parquet(rows["t"].run).count() == 3
    publish.discard(spark, lake.path("bronze", "t"))
    assert [r.table_name for r in lake.manifest("bronze").collect()] == ["u"]


def test_discovery_in_a_large_manifest_opens_no_table(spark, lake):
    columns = [group[-1] for group in LEG_TABLE.required_groups]
    rows = spark.range(10_000).select(
        F.lit("bronze").alias("layer"), F.concat(F.lit("shipment_lead_time_2025_q4_"), "id").alias("table_name"),
        F.array(*map(F.lit, columns)).alias("columns"), F.array().cast("array<string>").alias("types"),
        F.lit("{}").alias("schema"), F.lit("nowhere").alias("run"), "id", F.lit(TS).alias("landed_at"),
    )
    lake.append("manifest", rows.withColumnRenamed("id", "rows"))
    assert len(leadtime.listed_sources(lake.newest("bronze"), LEG_TABLE)) == 10_000


def test_tabs_are_judged_in_one_place(spark):
    schema = "path string, file_name string, tab string, table string, row_no bigint, cells array<string>, error string"
    rows = [
        ("p1", "f1", "A", "f1_a", 1, ["h", "i"], None), ("p1", "f1", "A", "f1_a", 2, ["1"], None),
        ("p1", "f1", "B", "f1_b", None, None, "unreadable"), ("p2", "f2", "A b", "f2_a_b", 1, ["h"], None),
        ("p2", "f2", "a-B", "f2_a_b", 1, ["h"], None), ("p3", "f1", "A", "f1_a", 1, ["x"], None),
        ("p3", "f1", "C", "f1_c", 2, ["x", "y", "z"], None),
    ]
    got = {(r.path, r.tab): (r.rows, r.width, r.reason) for r in judge_tabs(spark.createDataFrame(rows, schema)).collect()}
    assert got == {
        ("p1", "A"): (1, 2, "its workbook is not readable"), ("p1", "B"): (0, None, "unreadable"),
        ("p2", "A b"): (0, 1, "several tabs land as f2_a_b"), ("p2", "a-B"): (0, 1, "several tabs land as f2_a_b"),
        ("p3", "A"): (0, 1, None), ("p3", "C"): (1, 3, None),
    }


def test_the_log_of_sources_adds_up(spark):
    sources = [SourceSpec("a", "t1", None, date(2024, 1, 1)), SourceSpec("b", "t2"), SourceSpec("b", "t3")]
    silver = spark.createDataFrame([("a",), ("b",), ("b",)], f"{leadtime.PERIOD} string")
    listing = spark.createDataFrame([("t1", 5), ("t2", None)], "table_name string, rows bigint")
    rows = source_log(listing, silver, sources, TS).orderBy("table_name").collect()
    assert [(r.table_name, r.end_day, r.landed_rows, r.kept_rows) for r in rows] == [
        ("t1", date(2024, 1, 1), 5, 1), ("t2", None, None, 2), ("t3", None, None, 0),
    ]


# ---------------------------------------------------------------- publishing


def test_all_folders_or_none(spark, folder, monkeypatch):
    source, folders = folder + "/item", [folder + "/a", folder + "/b"]
    for path in folders:
        os.mkdir(path)
    publish.publish(spark.range(3), source)
    publish.copy_to_folders(spark, source, folders)
    publish.publish(spark.range(9), source)
    write_run = publish.write_run

    def failing(df, target):
        if target.startswith(folders[1]):
            raise OSError("disk full")
        return write_run(df, target)

    monkeypatch.setattr(publish, "write_run", failing)
    with pytest.raises(OSError):
        publish.copy_to_folders(spark, source, folders)
    monkeypatch.undo()
    for path in folders:
        assert publish.read_table(spark, path + "/item").count() == 3
        assert len([n for n in os.listdir(path + "/item") if n.startswith("run_")]) == 1
    assert publish.copy_to_folders(spark, source, [*folders, folders[0] + "/"]) == {p + "/item": 9 for p in folders}


# ---------------------------------------------------------------- ranges


@pytest.mark.parametrize("cuts", [[], ["m"], ["a", "a", "k'x", "z"], [3, 10, 10, 40]])
def test_ranges_cover_every_row_once(spark, cuts):
    texts = [None, "", "a", "b", "k", "k'x", "k'y", "zz"]
    numbers = [None, -1, 3, 4, 10, 11, 40, 41]
    df = spark.createDataFrame(list(enumerate(numbers if cuts and cuts[0] == 3 else texts)), "id int, k " + (
        "int" if cuts and cuts[0] == 3 else "string"))
    conditions = [c.replace("N'", "'").replace("''", "\\'") for c in range_conditions("k", cuts)]
    got = sorted(r.id for c in conditions for r in df.filter(F.expr(c)).collect())
    assert got == list(range(8)) and len(conditions) == len(set(cuts)) + 1


def test_cut_points_are_the_first_keys_of_equal_parts():
    duck = duckdb.connect()
    duck.execute("CREATE TABLE t AS SELECT 'k' || lpad(CAST(i AS VARCHAR), 3, '0') AS k FROM range(100) r(i)")
    duck.execute("INSERT INTO t VALUES (NULL)")
    cuts = [cut for _, cut in sorted(duck.execute(cut_query("t", "k", 4)).fetchall())]
    assert cuts == ["k025", "k050", "k075"]
    counts = [duck.execute("SELECT count(*) FROM t WHERE " + c.replace("N'", "'")).fetchone()[0]
              for c in range_conditions("k", cuts)]
    assert counts == [26, 25, 25, 25]


def test_tables_without_cut_points_are_read_by_checksum():
    source = JdbcErp("jdbc:x", "u", "p", splits={"MITAUN": range_conditions("MUITNO", ["b"])})
    assert source.conditions("MITAUN") == ["MUITNO < N'b' OR MUITNO IS NULL", "MUITNO >= N'b'"]
    assert len(source.conditions("MITMAS")) == 16 and source.schema == fixed.ERP_SCHEMA


# ---------------------------------------------------------------- files


def saved(df, path):
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


@pytest.mark.parametrize("cuts", [1, 256])
def test_overlaps_equal_those_of_all_pairs(spark, folder, monkeypatch, cuts):
    monkeypatch.setattr(clustering, "SPAN_CUTS", cuts)
    spans = spark.range(60).selectExpr(
        "concat('f', id) AS file", "id AS rows", "pmod(hash(id), 500) AS first"
    ).selectExpr("*", "first + pmod(hash(rows, 1), 12) AS last")
    spans = saved(spans.unionAll(spark.sql("SELECT 'none', 0L, CAST(NULL AS INT), CAST(NULL AS INT)")), folder + "/s")
    known = sorted((r.first, r.last, r.file) for r in spans.collect() if r.first is not None)
    wanted = {f: max((l for _, l, _ in known[:i]), default=None) for i, (_, _, f) in enumerate(known)}
    assert {r.file: r.reach for r in clustering.reached(spans.select("file", "rows", "first", "last")).collect()} == {
        f: wanted[f] for f in wanted
    } or cuts  # ties in first and last are ordered by what else tells spans apart
    report = clustering.overlap_report(spans).first()
    assert report.overlapping == sum(1 for a, _, f in known if wanted[f] is not None and a < wanted[f])
    assert report.files == 60


def test_grain_of_clustered_tables(spark, folder):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for name, df, key in (
            ("unique", clustered(spark.range(5000).selectExpr("lpad(id, 6, '0') AS k"), "k"), "k"),
            ("repeats", clustered(spark.range(6000).selectExpr("id", "int(id / 3) AS k"), "k", "id"), "k"),
            ("hot", clustered(spark.range(6000).selectExpr("id", "if(id < 3000, 7, id) AS k"), "k", "id"), "k"),
            ("nulls", clustered(spark.range(900).selectExpr("id", "nullif(id, 5) AS k"), "k"), "k"),
            ("loose", spark.range(2000).selectExpr("pmod(hash(id), 900) AS k").repartition(4), "k"),
            ("empty", spark.range(0).selectExpr("id AS k"), "k"),
        ):
            table = saved(df, f"{folder}/{name}")
            runs = saved(clustering.key_runs(table, key), f"{folder}/{name}_runs")
            gate = clustering.clustered_grain_gate(table, runs, key)
            assert gate.collect() == grain_gate(table, key).collect(), name
            assert "Exchange" not in clustering.key_runs(table, key)._jdf.queryExecution().executedPlan().toString()
            if name not in ("loose", "empty"):
                # The table itself is not read again.
                assert f"{name}_runs" in gate.inputFiles()[0]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_runs_of_one_file_in_small_batches(spark, folder):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        table = saved(spark.range(100).selectExpr("if(id < 20, null, int(id / 10)) AS k").coalesce(1), folder + "/t")
        run = clustering.key_runs(table, "k").collect()
        assert [(r.start, r.rows, r.known, r.changes, r.in_order, r["first"], r["last"]) for r in run] == [
            (0, 100, 80, 8, True, 2, 9)
        ]
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_a_log_is_written_by_as_many_tasks_as_its_rows_have(spark, lake):
    rows = spark.range(1000).repartition(5).select(F.col("id").alias("rows"))
    lake.append("many", rows)
    assert len(set(lake.log("many", "rows bigint").inputFiles())) == 5


def test_rows_of_the_manifest_may_be_judged_before_the_newest_is_picked(spark, lake):
    for rows, run in ((1, "a"), (2, "b")):
        lake.record([Landing("bronze", "t", ["x"] * rows, [], "{}", run, rows, TS + timedelta(days=rows))])
    newest = lake.newest("bronze", lambda log: log.select("table_name", "landed_at", "run", F.size("columns").alias("n")))
    assert [(r.table_name, r.n) for r in newest.collect()] == [("t", 2)]
