"""Workbooks to star schema, end to end."""

import json
import os
from datetime import date, datetime, timezone

import pytest
import xlsx
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.__main__ import main
from tidemark.operators.quality import DataQualityError
from tidemark.plans.leadtime import (
    SILVER,
    FetchTask,
    LoadFailed,
    load_bronze,
    run_leadtime,
    silver_reports,
)
from tidemark.operators.reshape import clustered
from tidemark.sources.files import NoMatchingFiles, file_manifest, read_phases, write_phases
from tidemark.sources.lake import Lake
from tidemark.sources.workbook import decode_workbook, sheet_headers

TS = datetime(2026, 1, 2, 3, 4, 5, tzinfo=timezone.utc)

OLD = [
    "WH", "ASN", "Folio", "Div", "Continer Size", "Vessel", "B/L", "Port", "Container",
    "Min of PO Head Req Delivery Date", "Max of PO Head Req Delivery Date", "Min - Max XFTY",
    "XFTY to Container Consolidation", "POs Consolidation to Gate In", "Gate In",
    "Gate In to ETD", "ETD", "ETD to ETA", "Current ETA Port", "ETA to Delivery", "P/U",
    "Delivery to Received", "ASN Receive", "Max XFT to Received", "Min XFT to Received",
    "Avg XFTY to Received", "Customer", "Region", "ASN Qty",
]
DROPPED = ["Div", "Continer Size", "Vessel", "Customer", "ASN Qty"]
RENAMED = {
    "WH": "WHR",
    "Min of PO Head Req Delivery Date": "Min Header Delivery Date",
    "Max of PO Head Req Delivery Date": "Max Header Delivery Date",
    "Min - Max XFTY": "Max - Min XFTY",
    "Current ETA Port": "ETA",
}
NEW = [RENAMED.get(h, h) for h in OLD if h not in DROPPED]


def leg(headers, asn, etd, **changes):
    known = {
        "WH": "e1 ", "WHR": "E1", "ASN": asn, "Folio": 7, "Div": "d1", "Continer Size": "40h",
        "Vessel": "V", "B/L": "BL", "Port": "Sekou", "Container": "C1",
        "Min of PO Head Req Delivery Date": datetime(2023, 1, 1),
        "Max of PO Head Req Delivery Date": datetime(2023, 1, 9),
        "Min Header Delivery Date": "01-01-2023", "Max Header Delivery Date": "01-09-2023",
        "Min - Max XFTY": 2, "Max - Min XFTY": 2,
        "XFTY to Container Consolidation": datetime(2023, 1, 2, 12),
        "POs Consolidation to Gate In": 1, "Gate In": datetime(2023, 1, 3), "Gate In to ETD": 1.5,
        "ETD": etd, "ETD to ETA": 20, "Current ETA Port": datetime(2023, 2, 1),
        "ETA": datetime(2023, 2, 1), "ETA to Delivery": 4, "P/U": "1/30/23",
        "Delivery to Received": 3, "ASN Receive": datetime(2023, 2, 9), "Max XFT to Received": 30,
        "Min XFT to Received": 50, "Avg XFTY to Received": 40, "Customer": "cust",
        "Region": "China ", "ASN Qty": 10,
    }
    return [{**known, **changes}[h] for h in headers]


def workbooks(folder, new_etd=datetime(2025, 8, 1)):
    """Two quarterly workbooks, a lock file and one that is not selected."""
    os.mkdir(folder)
    xlsx.write(
        folder + "/Shipment Lead Time 2023.xlsx",
        {
            "Data": [
                OLD,
                leg(OLD, "A1", datetime(2023, 1, 5)),
                leg(OLD, "A1", datetime(2023, 1, 5)),
                [None] * len(OLD),
                leg(OLD, "late", datetime(2023, 11, 1)),
                leg(OLD, "zero", datetime(2023, 2, 5), **{"Gate In": None, "Gate In to ETD": 45000}),
            ],
            "Summary": [["WH", "Total"], ["E1", 3]],
        },
    )
    xlsx.write(
        folder + "/Shipment Lead Time 2025 Q3.xlsx",
        {
            "Q3 2025": [
                NEW,
                leg(NEW, 123, new_etd),
                [("VIETNAM" if h == "Region" else None) for h in NEW],
                [("CHINA" if h == "Region" else None) for h in NEW] if new_etd is None else [None],
            ]
        },
    )
    xlsx.write(folder + "/other.xlsx", {"Data": [["x"], [1]]})
    for name in ("~$Shipment Lead Time 2023.xlsx", "Shipment Lead Time.txt"):
        with open(f"{folder}/{name}", "w") as lock:
            lock.write("not a workbook")


@pytest.fixture
def lake(spark, folder):
    return Lake(spark, folder + "/lake")


@pytest.fixture
def phases(spark, folder):
    write_phases(spark, folder + "/phases")
    return folder + "/phases"


def test_manifest(spark, folder):
    workbooks(folder + "/in")
    files = file_manifest(spark, folder + "/in", "shipment LEAD time")
    names = sorted(r.file_name for r in files.collect())
    assert names == ["Shipment Lead Time 2023.xlsx", "Shipment Lead Time 2025 Q3.xlsx"]
    assert files.filter("file_size > 0 AND modified_at IS NOT NULL").count() == 2
    assert "content" not in files._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(FileNotFoundError):
        file_manifest(spark, folder + "/nowhere", "x")


def test_phase_master(spark, phases):
    rows = [tuple(r) for r in read_phases(spark, phases).collect()]
    assert rows == fixed.PHASES


def test_whole_run(spark, folder, lake, phases):
    workbooks(folder + "/in")
    counts = run_leadtime(lake, [FetchTask(folder + "/in", "lead time")], phases, TS)
    assert counts == {
        SILVER: 3, "dim_country": 1, "dim_date": 4018, "dim_phase": 9, "dim_port": 1, "dim_wh": 1,
        "fact_leadtime": 27,
    }
    assert lake.tables("bronze") == [
        "shipment_lead_time_2023_data", "shipment_lead_time_2023_summary",
        "shipment_lead_time_2025_q3_q3_2025",
    ]
    bronze = lake.read("bronze", "shipment_lead_time_2023_data")
    assert bronze.count() == 4
    assert bronze.select("_source_file_name").distinct().first()[0] == "Shipment Lead Time 2023.xlsx"
    assert lake.read("bronze", "shipment_lead_time_2025_q3_q3_2025").count() == 1

    silver = {r.asn: r for r in lake.read("silver", SILVER).collect()}
    assert set(silver) == {"A1", "zero", "123"}
    old, new = silver["A1"], silver["123"]
    assert (old.wh, old.folio, old.container_size, old.port) == ("E1", "7", "40H", "SHEKOU")
    assert (old.min_xft_to_received, old.max_xft_to_received) == (30.0, 50.0)
    assert (new.min_xft_to_received, new.max_xft_to_received) == (50.0, 30.0)
    assert old.etd == date(2023, 1, 5) and old.p_u == date(2023, 1, 30)
    assert old.xfty_to_container_consolidation == datetime(2023, 1, 2, 12)
    assert old.min_req_delivery_date == new.min_req_delivery_date == date(2023, 1, 1)
    assert (old.gate_in_to_etd, silver["zero"].gate_in_to_etd) == (1.5, None)
    assert new.customer is None and new.div is None and new.asn_qty is None
    assert (old._source_period, new._source_period) == ("2023", "2025_Q3")

    reports = silver_reports(lake.read("silver", SILVER))
    assert [(r[0], r[1]) for r in reports["periods"].collect()] == [("2023", 2), ("2025_Q3", 1)]
    assert reports["total"].first().source_periods == 2
    assert reports["duplicates"].isEmpty()
    assert [r.null_asn_receive for r in reports["nulls"].collect()] == [0, 0]

    fact = lake.read("gold", "fact_leadtime")
    assert fact.groupBy("Phase").count().filter("count <> 3").isEmpty()
    assert fact.join(lake.read("gold", "dim_phase"), "Phase", "left_anti").isEmpty()
    assert fact.join(lake.read("gold", "dim_date"), "date_key", "left_anti").isEmpty()


def test_a_null_etd_stops_before_silver_is_replaced(spark, folder, lake, phases):
    workbooks(folder + "/in")
    run_leadtime(lake, [FetchTask(folder + "/in", "lead time")], phases, TS)
    workbooks(folder + "/again", new_etd=None)
    with pytest.raises(DataQualityError, match="etd"):
        run_leadtime(lake, [FetchTask(folder + "/again", "lead time")], phases, TS)
    assert lake.read("silver", SILVER).filter("etd IS NULL").isEmpty()
    assert lake.read("silver", SILVER).count() == 3
    assert not [n for n in os.listdir(lake.root + "/silver") if n.startswith("_")]


def test_a_bad_workbook_is_reported_and_the_others_land(spark, folder, lake):
    workbooks(folder + "/in")
    with open(folder + "/in/Broken lead time.xlsx", "wb") as broken:
        broken.write(b"PK not really")
    xlsx.write(folder + "/in/Clash lead time.xlsx", {"T": [["B/L", "b l"], [1, 2]]})
    xlsx.write(folder + "/in/Same lead time.xlsx", {"A b": [["x"], [1]], "a-B": [["x"], [2]]})
    lake.create_layers()
    with pytest.raises(LoadFailed) as failure:
        load_bronze(lake, [FetchTask(folder + "/in", "lead time")], TS)
    assert "Broken lead time.xlsx" in str(failure.value)
    assert "Clash lead time.xlsx / T" in str(failure.value)
    assert "several tabs land as same_lead_time_a_b" in str(failure.value)
    assert len(lake.tables("bronze")) == 3


def test_one_name_from_two_folders_is_reported(spark, folder, lake):
    for place in ("a", "b"):
        os.mkdir(f"{folder}/{place}")
        xlsx.write(f"{folder}/{place}/Lead Time X.xlsx", {"data": [["x"], [place]]})
    xlsx.write(folder + "/b/Lead Time Y.xlsx", {"data": [["x"], [1]]})
    lake.create_layers()
    tasks = [FetchTask(folder + "/a", "lead"), FetchTask(folder + "/b", "lead"), FetchTask(folder + "/b", "time y")]
    with pytest.raises(LoadFailed, match="several tabs land as lead_time_x_data"):
        load_bronze(lake, tasks, TS)
    assert lake.tables("bronze") == ["lead_time_y_data"]


def test_a_failing_task_does_not_stop_the_others(spark, folder, lake):
    os.mkdir(folder + "/bad")
    with open(folder + "/bad/Broken lead time.xlsx", "wb") as broken:
        broken.write(b"PK not really")
    workbooks(folder + "/good")
    lake.create_layers()
    tasks = [FetchTask(f"{folder}/{place}", "lead time") for place in ("bad", "missing", "good")]
    with pytest.raises(LoadFailed) as failure:
        load_bronze(lake, [*tasks, FetchTask(folder + "/good", "invoices")], TS)
    for part in ("Broken lead time.xlsx", "missing", "invoices"):
        assert part in str(failure.value)
    assert len(lake.tables("bronze")) == 3
    shared = spark.conf.get("spark.checkpoint.dir") + "/tidemark"
    assert not [name for name in os.listdir(shared) if name.startswith(f"{TS:%Y%m%dT}")]


def test_silver_files_hold_disjoint_spans(spark, folder):
    legs = spark.range(20_000).selectExpr("date_add(DATE '2024-01-01', int(pmod(hash(id), 300))) AS etd", "id")
    hot = legs.union(spark.range(20_000).selectExpr("DATE '2024-06-01' AS etd", "-id AS id"))
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        clustered(hot, "etd", "id").write.parquet(folder + "/s")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    files = spark.read.parquet(folder + "/s").groupBy("_metadata.file_name").agg(
        F.min("etd").alias("low"), F.max("etd").alias("high"), F.count("*").alias("n")
    ).orderBy("low", "high").collect()
    assert len(files) > 4 and max(f.n for f in files) < 12_000
    assert all(a.high <= b.low for a, b in zip(files, files[1:]))


def test_schemas_are_fixed(spark, folder, lake, phases):
    workbooks(folder + "/in")
    run_leadtime(lake, [FetchTask(folder + "/in", "lead time")], phases, TS)
    silver = dict(lake.read("silver", SILVER).dtypes)
    dates = {"min_req_delivery_date", "max_req_delivery_date", "gate_in", "etd", "current_eta_port", "p_u", "asn_receive"}
    assert {name for name, kind in silver.items() if kind == "date"} == dates
    assert silver["_bronze_insert_ts"] == "timestamp" and silver["xfty_range"] == silver["asn_qty"] == "double"
    fact = dict(lake.read("gold", "fact_leadtime").dtypes)
    assert fact["fact_row_key"] == "string" and fact["date_key"] == "date" and fact["Value"] == "double"
    calendar = dict(lake.read("gold", "dim_date").dtypes)
    assert calendar["date_key"] == "date" and calendar["is_weekend"] == "boolean" and calendar["year"] == "int"


def test_nothing_selected_is_an_error(folder, lake):
    workbooks(folder + "/in")
    with pytest.raises(NoMatchingFiles, match="invoices"):
        load_bronze(lake, [FetchTask(folder + "/in", "invoices")], TS)


def test_cell_kinds(folder):
    raw = [
        ["n", "text"],
        [1, 2.5, 1e7, True, "NA", "n/a ", "#N/A", datetime(2024, 1, 5, 10, 30)],
        [
            xlsx.Raw('<c {at} t="inlineStr"><is><r><t>a</t></r><r><t>b</t></r></is></c>'),
            xlsx.Raw('<c {at} t="str"><f>A1</f><v>made</v></c>'),
            xlsx.Raw('<c {at} t="e"><v>#REF!</v></c>'),
            xlsx.Raw('<c {at} s="2"><v>3</v></c>'),
            xlsx.Raw('<c {at} s="3"><v>45296</v></c>'),
            xlsx.Raw('<c {at} s="1"><v>0</v></c>'),
            xlsx.Raw('<c {at} s="1"><v>1</v></c>'),
            xlsx.Raw('<c {at} t="d"><v>2024-01-05T00:00:00</v></c>'),
            xlsx.Raw("<c {at}/>"),
        ],
    ]
    xlsx.write(folder + "/k.xlsx", {"A & B": raw})
    with open(folder + "/k.xlsx", "rb") as content:
        rows = list(decode_workbook(content.read()))
    assert rows == [
        ("A & B", 1, ["n", "text"]),
        ("A & B", 2, ["1", "2.5", "10000000", "True", None, "n/a ", None, "2024-01-05 10:30:00"]),
        (
            "A & B",
            3,
            [
                "ab", "made", None, "3", "2024-01-05 00:00:00", "00:00:00", "1900-01-01 00:00:00",
                "2024-01-05 00:00:00", None,
            ],
        ),
    ]


def test_sheet_headers():
    assert sheet_headers(["a", None, "a", "b"], 5) == ["a", "Unnamed: 1", "a.1", "b", "Unnamed: 4"]


def test_a_large_tab_streams_in_batches(spark, folder, lake):
    os.mkdir(folder + "/in")
    rows = [["asn", "v"], *[[f"x{i}", i] for i in range(10_000)]]
    xlsx.write(folder + "/in/big lead time.xlsx", {"T": rows})
    lake.create_layers()
    assert load_bronze(lake, [FetchTask(folder + "/in", "lead")], TS) == ["big_lead_time_t"]
    table = lake.read("bronze", "big_lead_time_t")
    assert table.agg(F.count("asn"), F.sum(F.col("v").cast("long"))).first() == (10_000, 49_995_000)


def test_command_line(spark, folder, phases, capsys):
    workbooks(folder + "/in")
    settings = {
        "lake": folder + "/lake",
        "fetch": [{"folder": folder + "/in", "keyword": "Shipment Lead Time"}],
        "phases": phases,
    }
    with open(folder + "/settings.json", "w") as stream:
        json.dump(settings, stream)
    assert main(["leadtime", folder + "/settings.json"])["fact_leadtime"] == 27
    assert "fact_leadtime: 27 rows" in capsys.readouterr().out
