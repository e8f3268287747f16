import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from tidemark.operators import publish
from tidemark.session import EXPANSION, PARTITION_BYTES, PARTITIONS_MOST, build_session, shuffle_partitions, size_shuffles
from tidemark.sources.lake import Lake, catalog_tables, work_folder


def leftovers(folder):
    return [n for n in os.listdir(folder) if n.startswith("_")]


def test_full_refresh_replaces_and_cleans_up(spark, folder):
    lake = Lake(spark, folder)
    lake.create_layers()
    assert lake.write("bronze", "t", spark.range(5)) == 5
    assert lake.write("bronze", "t", spark.range(3).withColumn("x", F.lit(1))) == 3
    assert lake.read("bronze", "t").columns == ["id", "x"]
    assert lake.has("bronze", "t") and not lake.has("silver", "t")
    assert leftovers(folder + "/bronze") == []


def test_readers_always_find_a_whole_table(spark, folder):
    """Publishing while others read: every read sees the rows of one run, and a plan made
    before a run was published still finds its files."""
    target = folder + "/t"
    publish.publish(spark.range(10).withColumn("run", F.lit(0)), target)
    seen, stop, problems = set(), threading.Event(), []

    def reader():
        while not stop.is_set():
            try:
                row = publish.read_table(spark, target).agg(F.count("*"), F.count_distinct("run"), F.max("run")).first()
                seen.add(tuple(row))
            except Exception as problem:
                problems.append(problem)

    threads = [threading.Thread(target=reader) for _ in range(2)]
    for thread in threads:
        thread.start()
    early = publish.read_table(spark, target)
    for run in range(1, 4):
        publish.publish(spark.range(10 + run).withColumn("run", F.lit(run)), target)
        if run == 1:
            assert early.count() == 10
        time.sleep(0.5)
    stop.set()
    for thread in threads:
        thread.join()
    assert not problems and seen <= {(10 + run, 1, run) for run in range(4)} and len(seen) > 1
    assert publish.read_table(spark, target).count() == 13
    assert sum(name.startswith("run_") for name in os.listdir(target)) == publish.KEPT_RUNS


def test_a_run_that_fails_its_check_is_not_published(spark, folder):
    def check(table):
        if table.count() > 5:
            raise ValueError("too many")

    assert publish.publish(spark.range(5), folder + "/t", check=check) == 5
    with pytest.raises(ValueError, match="too many"):
        publish.publish(spark.range(6), folder + "/t", check=check)
    assert publish.read_table(spark, folder + "/t").count() == 5
    with pytest.raises(ValueError, match="too many"):
        publish.publish(spark.range(6), folder + "/u", check=check)
    assert not os.path.exists(folder + "/u") and not publish.is_table(spark, folder + "/u")


def test_a_failing_write_keeps_the_table(spark, folder):
    lake = Lake(spark, folder)
    lake.create_layers()
    lake.write("gold", "t", spark.range(5))
    broken = spark.range(10).withColumn("x", F.raise_error(F.lit("broken")).cast("int"))
    with pytest.raises(Exception, match="broken"):
        lake.write("gold", "t", broken)
    assert lake.read("gold", "t").count() == 5
    assert leftovers(folder + "/gold") == []


def test_an_empty_extract_keeps_the_table(spark, folder):
    lake = Lake(spark, folder)
    lake.create_layers()
    lake.write("bronze", "t", spark.range(5), allow_empty=False)
    with pytest.raises(publish.EmptyExtract):
        lake.write("bronze", "t", spark.range(0), allow_empty=False)
    assert lake.read("bronze", "t").count() == 5
    assert leftovers(folder + "/bronze") == []
    assert lake.write("bronze", "u", spark.range(0)) == 0


def test_a_table_can_be_rewritten_from_itself(spark, folder):
    lake = Lake(spark, folder)
    lake.create_layers()
    lake.write("gold", "t", spark.range(5))
    assert lake.write("gold", "t", lake.read("gold", "t").filter("id > 1")) == 3
    assert lake.read("gold", "t").count() == 3


def test_listing(spark, folder):
    lake = Lake(spark, folder)
    lake.create_layers()
    lake.write("bronze", "shipment_LEAD_time_x", spark.range(1).toDF("ID"))
    lake.write("bronze", "other", spark.range(1))
    os.mkdir(folder + "/bronze/_staging_z")
    assert lake.tables("bronze", "lead_time") == ["shipment_LEAD_time_x"]
    assert lake.tables("bronze") == ["other", "shipment_LEAD_time_x"]
    assert lake.columns("bronze", "shipment_LEAD_time_x") == ["id"]
    with pytest.raises(ValueError):
        lake.path("copper", "t")


def test_copies(spark, folder):
    source = folder + "/dim_item"
    publish.publish(spark.range(7), source)
    targets = [folder + "/a", folder + "/b/"]
    for target in targets:
        os.mkdir(target)
    copied = publish.copy_to_folders(spark, source, targets)
    assert copied == {folder + "/a/dim_item": 7, folder + "/b/dim_item": 7}
    assert publish.read_table(spark, folder + "/b/dim_item").count() == 7
    with pytest.raises(FileNotFoundError, match="nowhere"):
        publish.copy_to_folders(spark, source, [folder + "/nowhere"])
    assert not os.path.exists(folder + "/nowhere") and leftovers(folder + "/a") == []


def test_work_folder_is_the_shared_one(spark):
    assert work_folder(spark).startswith(spark.conf.get("spark.checkpoint.dir"))


def test_session_catalog(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS bronze_test")
    spark.range(1).toDF("Asn").write.mode("overwrite").saveAsTable("bronze_test.lead_time_x")
    rows = catalog_tables(spark, "bronze_test", "*lead_time*").collect()
    assert [(r.table_name, r.columns) for r in rows] == [("lead_time_x", ["asn"])]


def test_shuffles_are_sized_by_the_input(spark, folder):
    """As the runs do it, in a session built the way the command line builds it."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        session = build_session()
        spark.range(2_000_000).selectExpr("id", "uuid() AS u").write.parquet(folder + "/a")
        size = sum(os.path.getsize(f"{folder}/a/{name}") for name in os.listdir(folder + "/a"))
        cores = session.sparkContext.defaultParallelism
        wanted = max(cores, -(-2 * size * EXPANSION // PARTITION_BYTES))
        assert abs(size_shuffles(session, [folder + "/a", folder + "/a"]) - wanted) <= 1
        assert session.conf.get("spark.sql.shuffle.partitions") == str(wanted)
        assert shuffle_partitions(10**12, 1000) == 7451
        assert shuffle_partitions(100 * 10**12 * EXPANSION, 1000) == PARTITIONS_MOST
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
