"""URL filters by sorted sweeps over nested intervals, in DataFrame functions only.

A rule names a host, with all its subdomains, and a prefix of the path.  Reversed label by
label, a host and its subdomains are an interval of keys, and so is a prefix of paths; both
kinds nest.  One sweep finds the rule hosts that enclose each distinct host, a second one the
path prefixes of those hosts that enclose each distinct path.  In a sweep, starts, ends and
points are sorted by key; a running sum of starts less ends is the height of the stack of
active intervals, and the latest start at a height is what lies there on the stack.

Points of a group are dealt to slices of bounded size, and the group's intervals to each
slice; events are then shuffled by group and slice, so a host with very many points is swept
by many tasks.  There are at most as many copies of intervals as points.

Defined cases: an url that is null or has no ``://`` has an empty host and path and meets no
rule.  Rules without host or path are ignored; of rules with equal host and path ``block``
wins.  The longest rule (host and path together, then host) decides; without one the verdict
is the caller's default, ``allow`` unless given.  Repeated rows are returned as often as they
come; extra columns are kept by :func:`judge`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.llm.common import lower_ascii, query, read, written

SLICE = 1024  # points of a group swept together, unless it has more intervals than that


def url_host(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lowered."""
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels from the last to the first, each in hexadecimal and ended by a full stop: the
    keys of a host's subdomains are those that start with its key."""
    labels = F.reverse(F.split(host, r"\.", -1))
    return F.array_join(F.transform(labels, lambda label: F.concat(F.hex(label), F.lit("."))), "").cast("binary")


def enclosing(points: DataFrame, intervals: DataFrame, top_only: bool = False) -> DataFrame:
    """(group, point, interval) for every interval that encloses a point of its group.

    ``points`` has group, point (any struct) and key (binary); ``intervals`` group, interval
    (any struct) and key, and encloses the keys that start with its own.  Keys of intervals
    are distinct within a group.  ``top_only`` returns the innermost interval only.
    """
    sizes = intervals.groupBy("group").agg(F.count("*").alias("n"))
    counts = points.groupBy("group").agg(F.count("*").alias("points"))
    # Written, so that the joins with it can split the partition of a large group.
    slices = written(sizes.join(counts, "group").select(
        "group", F.ceil(F.col("points") / F.greatest(F.lit(SLICE), F.col("n"))).alias("slices")
    ))
    spread = points.join(slices, "group").withColumn("slice", F.pmod(F.xxhash64("key", "point"), F.col("slices")))
    copied = intervals.join(slices, "group").withColumn(
        "slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))
    )
    none = lambda frame, name: F.lit(None).cast(frame.schema[name].dataType)
    events = (
        copied.select(
            "group", "slice", "key", F.lit(0).alias("kind"), F.lit(1).alias("step"),
            "interval", none(points, "point").alias("point"),
        )
        .union(spread.select("group", "slice", "key", F.lit(1), F.lit(0), none(intervals, "interval"), "point"))
        .union(
            # 0xFF is in no text: this key follows all keys that start with the interval's.
            copied.select(
                "group", "slice", F.concat("key", F.lit(b"\xff")), F.lit(2), F.lit(-1),
                none(intervals, "interval"), none(points, "point"),
            )
        )
    )
    # Otherwise the partitioning of the joins by group would do for the windows.
    events = events.repartition("group", "slice")
    sweep = W.partitionBy("group", "slice").orderBy("key", "kind")
    height = F.sum("step").over(sweep.rowsBetween(W.unboundedPreceding, 0))
    levels = events.withColumn("height", height).where("step >= 0 AND height > 0")
    if top_only:
        levels = levels.withColumn("level", F.col("height"))
    else:
        levels = levels.withColumn(
            "level",
            F.explode(
                F.when(F.col("kind") == 0, F.array("height")).otherwise(F.sequence(F.lit(1).cast("long"), "height"))
            ),
        )
    stack = W.partitionBy("group", "slice", "level").orderBy("key", "kind").rowsBetween(W.unboundedPreceding, 0)
    return (
        levels.withColumn("interval", F.last("interval", ignorenulls=True).over(stack))
        .where("kind = 1")
        .select("group", "point", "interval")
    )


def judge(urls: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``urls`` (with a column url) with host, path, rule and verdict, which take the place of
    columns of these names; ``rules`` has host, path and verdict."""
    rules = (
        rules.where("host IS NOT NULL AND host <> '' AND path IS NOT NULL")
        .select(lower_ascii(F.col("host")).alias("host"), "path", "verdict")
        .groupBy("host", "path")
        .agg(F.max("verdict").alias("verdict"))
    )
    urls = urls.drop("host", "path", "rule", "verdict")
    parsed = urls.withColumns({"host": url_host(F.col("url")), "path": url_path(F.col("url"))})
    pairs = parsed.where("host <> ''").select("host", "path").distinct()

    # First sweep: distinct hosts against rule hosts, by their last label.
    group = F.element_at(F.split("host", r"\."), -1).alias("group")
    hosts = pairs.select("host").distinct()
    above = enclosing(
        hosts.select(group, F.struct("host").alias("point"), host_key(F.col("host")).alias("key")),
        rules.select("host").distinct().select(
            group, F.struct("host").alias("interval"), host_key(F.col("host")).alias("key")
        ),
    ).select(F.col("point.host").alias("host"), F.col("interval.host").alias("rule_host"))

    # Second sweep: the paths of those hosts against the prefixes of each rule host.
    paths = pairs.join(above, "host")
    fits = enclosing(
        paths.select(
            F.col("rule_host").alias("group"), F.struct("host", "path").alias("point"),
            F.col("path").cast("binary").alias("key"),
        ),
        rules.select(
            F.col("host").alias("group"), F.struct("path", "verdict").alias("interval"),
            F.col("path").cast("binary").alias("key"),
        ),
        top_only=True,
    )
    best = (
        fits.groupBy("point.host", "point.path")
        .agg(
            F.max(
                F.struct(
                    (F.length("group") + F.length("interval.path")).alias("length"),
                    F.length("group").alias("host_length"),
                    F.concat("group", "interval.path").alias("rule"),
                    F.col("interval.verdict").alias("verdict"),
                )
            ).alias("best")
        )
        .select("host", "path", "best.rule", "best.verdict")
    )
    return parsed.join(written(best), ["host", "path"], "left").select(
        *urls.columns, "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict")
    )


RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]


@query(
    "op2_url_filters",
    r"""
    WITH rules(host, path, verdict) AS (
        VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'),
               ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
    ), parsed AS (
        SELECT row_number() OVER () AS n, page_id,
               coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                  'abcdefghijklmnopqrstuvwxyz'), '') AS host,
               coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
        FROM pages
    ), fit AS (
        SELECT p.*, r.host || r.path AS rule, r.verdict AS verdict,
               row_number() OVER (PARTITION BY n ORDER BY length(r.host) + length(r.path) DESC, length(r.host) DESC) AS place
        FROM parsed p LEFT JOIN rules r
          ON (p.host = r.host OR p.host LIKE '%.' || r.host) AND starts_with(p.path, r.path)
    )
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fit WHERE place = 1
    """,
)
def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return judge(read(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")
