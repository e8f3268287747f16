"""Writing tables so that readers only ever see whole, checked ones.

A table is a folder of runs.  Every write goes to a new run, is counted and checked there,
and counts as published once an empty marker file names it; readers take the newest marked
run.  Nothing is renamed or overwritten, so this holds on object stores as well, and a
reader that began before a newer run was published still finds its files: the run
before the newest is kept.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


class PublishError(RuntimeError):
    """A written table is not what was to be published."""


class EmptyExtract(RuntimeError):
    """An extract without rows must not replace a good table."""


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _file_system(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return _file_system(spark, path).exists(_path(spark, path))


def is_folder(spark: SparkSession, path: str) -> bool:
    fs = _file_system(spark, path)
    return fs.exists(_path(spark, path)) and fs.getFileStatus(_path(spark, path)).isDirectory()


def make_folder(spark: SparkSession, path: str) -> None:
    _file_system(spark, path).mkdirs(_path(spark, path))


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, hidden ones left out."""
    if not is_folder(spark, path):
        return []
    entries = _file_system(spark, path).listStatus(_path(spark, path))
    names = [e.getPath().getName() for e in entries if e.isDirectory()]
    return sorted(name for name in names if not name.startswith(("_", ".")))


MARKER = "_done_"
KEPT_RUNS = 2


def _names(spark: SparkSession, path: str) -> list[str]:
    if not is_folder(spark, path):
        return []
    return [e.getPath().getName() for e in _file_system(spark, path).listStatus(_path(spark, path))]


def _runs(spark: SparkSession, target: str) -> list[str]:
    """Published runs, newest first."""
    marked = [n.removeprefix(MARKER) for n in _names(spark, target) if n.startswith(MARKER)]
    return sorted(marked, reverse=True)


def current(spark: SparkSession, target: str) -> str:
    """Path of the newest published run; a folder without runs, written by others, is itself
    the table."""
    runs = _runs(spark, target)
    return f"{target.rstrip('/')}/{runs[0]}" if runs else target


def is_table(spark: SparkSession, target: str) -> bool:
    return bool(_runs(spark, target))


def read_table(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.parquet(current(spark, target))


def write_run(df: DataFrame, target: str) -> tuple[str, int]:
    """Write a new run; return its path and its checked row count.

    Rows are counted on their way into the writer and again in what was written, so
    the check costs no second run of the query.
    """
    spark = df.sparkSession
    run = f"{target.rstrip('/')}/run_{time.time_ns():020d}_{uuid.uuid4().hex[:8]}"
    seen = Observation()
    try:
        df.observe(seen, F.count(F.lit(1)).alias("n")).write.parquet(run)
        written = spark.read.schema(df.schema).parquet(run).count()
        if written != seen.get["n"]:
            raise PublishError(f"{target}: {seen.get['n']} rows sent, {written} rows written")
    except BaseException:
        drop_run(spark, run)
        raise
    return run, written


def mark(spark: SparkSession, run: str) -> None:
    """Make a run the current one, and delete those that no reader should be at any more."""
    target, _, name = run.rpartition("/")
    marker = f"{target}/{MARKER}{name}"
    touch(spark, marker)
    for old in _runs(spark, target)[KEPT_RUNS:]:
        discard(spark, f"{target}/{MARKER}{old}")
        discard(spark, f"{target}/{old}")


def touch(spark: SparkSession, path: str) -> None:
    """An empty file that must not be there yet."""
    _file_system(spark, path).create(_path(spark, path), False).close()


def is_marked(spark: SparkSession, run: str) -> bool:
    target, _, name = run.rpartition("/")
    return exists(spark, f"{target}/{MARKER}{name}")


def discard(spark: SparkSession, path: str) -> None:
    _file_system(spark, path).delete(_path(spark, path), True)


def drop_run(spark: SparkSession, run: str) -> None:
    """Delete a run that was not published, and its table's folder if it has no other."""
    discard(spark, run)
    target = run.rpartition("/")[0]
    if is_folder(spark, target) and not _names(spark, target):
        discard(spark, target)


def publish(
    df: DataFrame,
    target: str,
    *,
    allow_empty: bool = True,
    check: Callable[[DataFrame], object] | None = None,
) -> int:
    """Full refresh of one table: write, count, check what was written, mark.  Returns the row
    count; if anything raises, readers keep the table they had."""
    return publish_run(df, target, allow_empty=allow_empty, check=check)[1]


def publish_run(
    df: DataFrame,
    target: str,
    *,
    allow_empty: bool = True,
    check: Callable[[DataFrame], object] | None = None,
) -> tuple[str, int]:
    """:func:`publish`, with the path of the run."""
    spark = df.sparkSession
    run, rows = write_run(df, target)
    try:
        if rows == 0 and not allow_empty:
            raise EmptyExtract(f"{target}: no rows, the existing table is kept")
        if check is not None:
            check(spark.read.parquet(run))
        mark(spark, run)
    except BaseException:
        drop_run(spark, run)
        raise
    return run, rows


def copy_to_folders(spark: SparkSession, source: str, folders: Iterable[str]) -> dict[str, int]:
    """Publish a written table under its own name into each folder, or into none.

    First every folder gets its copy, unmarked and checked; only when all copies are
    complete are they marked, one empty file each.  Whatever is refused before that leaves
    every folder with the table it had.  A folder that does not exist is an error: it usually
    means a mount is missing.
    """
    name = source.rstrip("/").rpartition("/")[2]
    folders = list(dict.fromkeys(folder.rstrip("/") for folder in folders))
    for folder in folders:
        if not is_folder(spark, folder):
            raise FileNotFoundError(f"export folder not found: {folder}")
    table = read_table(spark, source)
    expected = table.count()
    copies: dict[str, str] = {}
    try:
        for folder in folders:
            target = f"{folder}/{name}"
            copies[target], rows = write_run(table, target)
            if rows != expected:
                raise PublishError(f"{name}: {expected} rows expected, {rows} copied to {folder}")
        for run in copies.values():
            mark(spark, run)
    except BaseException:
        for run in copies.values():
            if not is_marked(spark, run):
                drop_run(spark, run)
        raise
    return dict.fromkeys(copies, expected)
