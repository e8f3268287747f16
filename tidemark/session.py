"""Session settings the pipelines are tuned for."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import SparkSession

PARTITION_BYTES = 128 * 1024 * 1024
# The driver keeps a size per map task and partition: beyond this partitions grow, and spill.
PARTITIONS_MOST = 32_768


def shuffle_partitions(input_bytes: int, cores: int) -> int:
    """Partitions for a shuffle of about ``input_bytes``: 128 MB each, no fewer than the cores
    and at most PARTITIONS_MOST.  Adaptive execution merges what turns out to be small."""
    return min(PARTITIONS_MOST, max(cores, -(-input_bytes // PARTITION_BYTES)))


# Parquet is smaller than the rows that are shuffled from it.
EXPANSION = 3


def size_shuffles(spark: SparkSession, paths: Iterable[str]) -> int:
    """Set the session's shuffle partitions for the data below ``paths`` and return them."""
    size = 0
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        files = place.getFileSystem(spark._jsc.hadoopConfiguration())
        size += files.getContentSummary(place).getLength()
    partitions = shuffle_partitions(size * EXPANSION, spark.sparkContext.defaultParallelism)
    spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
    return partitions


# The JVM only interprets methods above this size; wide projections are then better off
# compiled expression by expression.
METHOD_BYTES = "8000"
_LIMIT, _UNSET = "spark.sql.codegen.hugeMethodLimit", "65535"


def limit_methods(spark: SparkSession) -> None:
    """Set the limit of a session that others built, unless they chose one."""
    if spark.conf.get(_LIMIT) == _UNSET:
        spark.conf.set(_LIMIT, METHOD_BYTES)


def build_session(
    name: str = "tidemark", master: str | None = None, partitions: int | None = None, **settings: str
) -> SparkSession:
    """A session with adaptive execution, ANSI casts and UTC; ``settings`` override."""
    values = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        # Every column call would look up its call site for error messages.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        _LIMIT: METHOD_BYTES,
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.files.maxPartitionBytes": str(PARTITION_BYTES),
        **{key.replace("__", "."): value for key, value in settings.items()},
    }
    if partitions is not None:
        values["spark.sql.shuffle.partitions"] = str(partitions)
    builder = SparkSession.builder.appName(name)
    if master is not None:
        builder = builder.master(master)
    for key, value in values.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
