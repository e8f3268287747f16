import re
from datetime import datetime, timezone

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from legs import bronze_row, bronze_table
from pyspark.sql import functions as F

from tidemark import fixed_values as fixed
from tidemark.operators import joins, landing, quality
from tidemark.operators.dedup import keep_first, keep_latest
from tidemark.operators.reshape import cells_to_table
from tidemark.plans.leadtime import build_fact, distinct_values, unpivot_phases

# ---------------------------------------------------------------- landing


def test_clean_headers(spark):
    df = spark.createDataFrame([(1, 2)], "` ASN # ` int, `a.b c` int")
    assert landing.clean_headers(df).columns == ["asn", "a_b_c"]


def test_header_collision(spark):
    df = spark.createDataFrame([(1, 2)], "`B/L` int, `b l` int")
    with pytest.raises(landing.HeaderCollision, match="b_l"):
        landing.clean_headers(df)


def test_blank_and_stray_rows(spark):
    rows = [("VIETNAM", None), ("VIETNAM", "x"), ("CHINA", None), (None, None), (None, "y")]
    df = landing.stamp(spark.createDataFrame(rows, "region string, asn string"), TS, "f")
    kept = landing.drop_blank_rows(df)
    assert kept.count() == 4
    kept = landing.drop_stray_rows(kept, "region", "VIETNAM")
    assert {(r.region, r.asn) for r in kept.collect()} == {
        ("VIETNAM", "x"), ("CHINA", None), (None, "y"),
    }
    assert landing.drop_stray_rows(df, "absent", "x").count() == 5


TS = datetime(2026, 1, 2, tzinfo=timezone.utc)


def test_stamp_is_one_value(spark):
    stamped = landing.stamp(spark.range(100).repartition(4), TS, "f.xlsx")
    assert stamped.select("_bronze_insert_ts", "_source_file_name").distinct().count() == 1
    assert stamped.select(F.unix_seconds("_bronze_insert_ts")).first()[0] == int(TS.timestamp())


def test_pin_text(spark):
    df = spark.createDataFrame([(1, 2.0, 3.0)], "asn long, folio double, qty double")
    pinned = landing.pin_text(df)
    assert pinned.first() == ("1", "2", 3.0)
    assert landing.land_text(df).dtypes == [(c, "string") for c in df.columns]


# ---------------------------------------------------------------- dedup


def test_null_keys_are_one_key(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    assert {tuple(r) for r in keep_first(df, ["k"], {"v": "desc"}).collect()} == {
        (None, 2), ("a", 3),
    }


def test_nulls_sort_last_either_way(spark):
    df = spark.createDataFrame([(1, None, "x"), (1, 5, "y"), (1, 7, "z")], "k int, v int, t string")
    assert keep_first(df, ["k"], {"v": "asc"}).first().t == "y"
    assert keep_first(df, ["k"], {"v": "desc"}).first().t == "z"


@settings(max_examples=5, deadline=None)
@given(
    st.lists(
        st.tuples(
            st.sampled_from("ab"), st.integers(0, 2), st.sampled_from("fg"), st.integers(0, 3)
        ),
        min_size=1,
        max_size=40,
    ),
    st.integers(1, 5),
)
def test_keep_latest_is_stable_and_idempotent(spark, rows, parts):
    df = spark.createDataFrame(rows, "k string, ts int, f string, v int")
    kept = keep_latest(df, ["k"], "ts", "f")
    moved = keep_latest(df.repartition(parts, "v"), ["k"], "ts", "f")
    wanted = {k: min((r for r in rows if r[0] == k), key=lambda r: (-r[1], r[2], r[3])) for k, *_ in rows}
    assert sorted(tuple(r) for r in kept.collect()) == sorted(wanted.values())
    assert sorted(moved.collect()) == sorted(kept.collect())
    assert sorted(keep_latest(kept, ["k"], "ts", "f").collect()) == sorted(kept.collect())


def test_ranking_is_limited_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = keep_first(df, ["k"], {"v": "asc"})._jdf.queryExecution().executedPlan().toString()
    before_shuffle = plan[plan.index("Exchange") :]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def test_ranking_sorts_by_a_hash_of_the_key_first(spark):
    rows = spark.createDataFrame([("a", None, 2), ("a", None, 1), (None, 0.0, 3), (None, -0.0, 4)], "k string, x double, v int")
    kept = keep_first(rows, ["k", "x"], {"v": "asc"})
    sorts = re.findall(r"Sort \[(\S+)", kept._jdf.queryExecution().executedPlan().toString())
    assert sorts and all("w0" in s or "hash" in s for s in sorts)
    assert sorted(r.v for r in kept.collect()) == [1, 3]


# ---------------------------------------------------------------- lookups


def skewed(spark):
    """Half of the rows hold one key, some hold none, and rows repeat."""
    rows = spark.range(0, 6000, numPartitions=6)
    key = F.when(F.col("id") % 2 == 0, 7).when(F.col("id") % 11 == 0, F.lit(None)).otherwise(
        F.col("id") % 900
    )
    return rows.select(
        F.lit(1).alias("c"), key.cast("bigint").alias("k"), (F.col("id") % 5).alias("v")
    )


def fan_out(spark):
    """Keys with one, two or no partners, and a NULL key."""
    once = spark.range(0, 600).select(
        F.lit(1).alias("rc"), F.col("id").alias("rk"), F.concat(F.lit("n"), "id").alias("name")
    )
    return once.union(once.filter("rk in (3, 7, 9)")).union(
        spark.sql("SELECT 1, CAST(NULL AS BIGINT), 'null'")
    )


@pytest.mark.parametrize("salts", [1, 4, 32])
def test_salted_join_equals_broadcast_join(spark, salts):
    left = skewed(spark)
    lookup = joins.Lookup(fan_out(spark), (("c", "rc"), ("k", "rk")))
    hot = joins.hot_keys(left, [["c", "k"]], share=0.1)[0]
    rows = left.where("c = 1 AND k = 7").count() / left.count()
    hash7 = spark.range(1).select(F.xxhash64(F.lit(1), F.lit(7).cast("bigint"))).first()[0]
    assert hot[hash7] == pytest.approx(rows, abs=0.02) and len(hot) <= 10
    salted = joins.salted_left_joins(left, [lookup], hot, salts)
    plain = joins.left_lookups(left, [lookup])
    assert salted.columns == plain.columns == ["c", "k", "v", "name"]
    assert salted.count() == plain.count() > left.count()
    assert salted.exceptAll(plain).isEmpty() and plain.exceptAll(salted).isEmpty()


def test_several_lookups_either_way(spark, folder):
    left = skewed(spark)
    names = fan_out(spark)
    codes = names.select(F.col("rk").alias("ck"), F.upper("name").alias("code"))
    lookups = [
        joins.Lookup(names, (("c", "rc"), ("k", "rk"))),
        joins.Lookup(codes, (("k", "ck"),)),
    ]
    broadcast = joins.left_lookups(left, lookups)
    shuffled = joins.left_lookups(left, lookups, broadcast_bytes=-1)
    assert broadcast.exceptAll(shuffled).isEmpty() and shuffled.exceptAll(broadcast).isEmpty()
    names.write.mode("overwrite").parquet(folder + "/names")
    lookups[0] = joins.Lookup(spark.read.parquet(folder + "/names"), lookups[0].on)
    bounds = [joins.size_bound(lookup.table) for lookup in lookups]
    for bound in bounds:
        mixed = joins.left_lookups(left, lookups, bound)
        assert mixed.columns == broadcast.columns == shuffled.columns
        assert mixed.exceptAll(broadcast).isEmpty() and broadcast.exceptAll(mixed).isEmpty()


def test_lookups_on_the_same_keys_share_a_shuffle(spark):
    left = skewed(spark)
    names = fan_out(spark)
    more = names.select("rc", "rk", F.upper("name").alias("code"))
    lookups = [
        joins.Lookup(names, (("c", "rc"), ("k", "rk"))),
        joins.Lookup(more, (("c", "rc"), ("k", "rk"))),
    ]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = joins.left_lookups(left, lookups, broadcast_bytes=-1)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 3
        plain = joins.left_lookups(left, lookups)
        assert joined.exceptAll(plain).isEmpty() and plain.exceptAll(joined).isEmpty()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_a_hot_key_is_spread(spark):
    left = skewed(spark)
    lookup = joins.Lookup(fan_out(spark), (("c", "rc"), ("k", "rk")))
    hot = joins.hot_keys(left, [["c", "k"]], share=0.1)[0]
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = joins.salted_left_joins(left, [lookup], hot, 32)
        sizes = joined.groupBy(F.spark_partition_id()).count()
        assert sizes.agg(F.max("count") / F.sum("count")).first()[0] < 0.35
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)


def test_lookup_rows_are_copied_by_the_share_of_their_key(spark):
    hot = {h: 0.0033 for h in range(150)} | {1000: 0.5}
    rows = spark.createDataFrame([(h,) for h in hot], "h long")
    salts = rows.select(F.sum(joins._salts(F.col("h"), hot, 2000))).first()[0]
    assert salts == 2000 + 150 * 14
    assert rows.select(joins._salts(F.col("h") + 5000, hot, 2000).alias("n")).distinct().collect()[0].n == 1


def test_small_lookups_start_no_job_while_the_plan_is_built(spark, folder):
    fan_out(spark).write.parquet(folder + "/names")
    left, names = skewed(spark), spark.read.parquet(folder + "/names")
    spark.sparkContext.setJobGroup("building", "")
    try:
        joined = joins.left_lookups(left, [joins.Lookup(names, (("c", "rc"), ("k", "rk")))])
        assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert joined.count() > left.count()


# ---------------------------------------------------------------- reshape


def fact_input(spark, rows):
    return bronze_table(spark, rows).withColumn("xfty_range", F.col("max_min_xfty"))


def test_unpivot_keeps_null_values(spark):
    empty = {c: None for c, _ in fixed.FACT_PHASES if c != "xfty_range"} | {"max_min_xfty": None}
    long = unpivot_phases(fact_input(spark, [bronze_row(), bronze_row(asn="A2", **empty)]))
    assert long.count() == 18
    assert long.filter("`ASN#` = 'A2' AND Value IS NULL").count() == 9
    assert {r.Phase for r in long.collect()} == {p[0] for p in fixed.PHASES}
    assert long.columns == [n for _, n in fixed.FACT_IDS] + ["Phase", "Value"]
    assert dict(long.dtypes)["Value"] == "double"


def test_fact_is_narrow_and_reads_only_its_columns(spark, folder):
    fact_input(spark, [bronze_row()]).write.parquet(folder + "/s")
    fact = build_fact(spark.read.parquet(folder + "/s"))
    plan = fact._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    scanned = re.search(r"FileScan parquet \[(.*?)\]", plan).group(1).split(",")
    assert len(scanned) == 15 and not any(c.startswith("vessel") for c in scanned)
    assert fact.columns[:2] == ["fact_row_key", "date_key"] and len(fact.columns) == 10


def test_distinct_values(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "region string")
    values = distinct_values(df, "region", "Country")
    assert sorted(r.Country for r in values.collect()) == ["a", "b"]


def test_cells_to_table(spark):
    rows = [("f", 1, 0, "a"), ("f", 1, 1, "b"), ("f", 2, 1, "c"), ("f", 2, 9, "beyond")]
    cells = spark.createDataFrame(rows, "file string, row_no int, col_no int, text string")
    table = cells_to_table(cells, ["file", "row_no"], "col_no", "text", ["x", "y.z"])
    assert {tuple(r) for r in table.collect()} == {("f", 1, "a", "b"), ("f", 2, None, "c")}


# ---------------------------------------------------------------- quality


def test_load_report(spark):
    rows = [("a ",), ("a",), (" a",), ("b",), ("  ",), (None,), ("c",), ("c",)]
    df = spark.createDataFrame(rows, "sku string")
    assert quality.load_report(df, "sku").first().asDict() == {
        "bronze_rows": 8, "blank_rows": 2, "silver_rows": 3, "repeated_keys": 2, "dropped_rows": 3,
    }
    assert [tuple(r) for r in quality.repeat_report(df, "sku").collect()] == [("a", 3), ("c", 2)]
    empty = quality.load_report(df.limit(0), "sku").first().asDict()
    assert set(empty.values()) == {0}


def test_gates(spark):
    df = spark.createDataFrame([("a", 1), ("b", None)], "k string, v int")
    assert quality.enforce(quality.grain_gate(df, "k"), "k")["total_rows"] == 2
    with pytest.raises(quality.DataQualityError, match="v"):
        quality.enforce(quality.grain_gate(df, "v"), "v")
    with pytest.raises(quality.DataQualityError, match="null_rows"):
        quality.enforce(quality.null_gate(df, "v"), "v")
    assert quality.enforce(quality.null_gate(df, "k"), "k")["null_rows"] == 0
