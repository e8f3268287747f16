"""The layered lake: one folder of published runs per table under a folder per layer.

Beside the layers lie logs, tables that are only ever appended to.  The manifest is one: each
landing adds a row per table with its columns, schema, run and rows, so that tables can be
found and read without opening their files.
"""

from __future__ import annotations

import atexit
import tempfile
from collections.abc import Callable, Iterable
from dataclasses import astuple, dataclass
from datetime import datetime
from functools import cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators import publish

LAYERS = ("bronze", "silver", "gold")
MANIFEST = "manifest"
MANIFEST_SCHEMA = (
    "layer string, table_name string, columns array<string>, types array<string>, schema string, "
    "run string, rows bigint, landed_at timestamp"
)


@dataclass(frozen=True)
class Landing:
    """A row of the manifest: a table as one run has it."""

    layer: str
    table_name: str
    columns: list[str]
    types: list[str]
    schema: str
    run: str
    rows: int | None
    landed_at: datetime


class Lake:
    """Named tables in three layers below a root path."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def create_layers(self) -> None:
        for layer in LAYERS:
            publish.make_folder(self.spark, f"{self.root}/{layer}")

    def path(self, layer: str, table: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer}")
        return f"{self.root}/{layer}/{table}"

    def write(
        self,
        layer: str,
        table: str,
        df: DataFrame,
        *,
        allow_empty: bool = True,
        check: Callable[[DataFrame], object] | None = None,
    ) -> int:
        return publish.publish(df, self.path(layer, table), allow_empty=allow_empty, check=check)

    def land(self, layer: str, table: str, df: DataFrame, landed_at: datetime) -> Landing:
        """Write a table and return its row for the manifest (see :meth:`record`)."""
        run, rows = publish.publish_run(df, self.path(layer, table))
        return self._landing(layer, table, run, df, rows, landed_at)

    def _landing(
        self, layer: str, table: str, run: str, df: DataFrame, rows: int | None, landed_at: datetime
    ) -> Landing:
        columns = [field.name.lower() for field in df.schema]
        types = [field.dataType.simpleString() for field in df.schema]
        return Landing(layer, table, columns, types, df.schema.json(), run, rows, landed_at)

    def record(self, landings: Iterable[Landing]) -> None:
        """Append rows to the manifest."""
        rows = self.spark.createDataFrame([astuple(x) for x in landings], MANIFEST_SCHEMA)
        self.append(MANIFEST, rows.coalesce(1))  # rows the driver holds

    def record_missing(self, layer: str, landed_at: datetime) -> list[str]:
        """Add the tables of a layer that the manifest does not know, by reading their schemas;
        returns their names.  There are none if all landings were recorded."""
        known = self.manifest(layer).select("table_name")
        names = self._names(layer).join(known, "table_name", "left_anti")
        missing = sorted(row["table_name"] for row in names.collect())
        found = [(name, publish.current(self.spark, self.path(layer, name))) for name in missing]
        if found:
            self.record(
                self._landing(layer, name, run, self.spark.read.parquet(run), None, landed_at) for name, run in found
            )
        return missing

    def _names(self, layer: str) -> DataFrame:
        return self.spark.createDataFrame(pa.table({"table_name": pa.array(self.tables(layer), type=pa.string())}))

    def newest(self, layer: str, shape: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
        """The newest row of the manifest for each table of a layer.

        ``shape`` may judge the rows and drop columns, all but table_name, landed_at and run,
        before any row is sorted or sent: column lists are most of a row.
        """
        rows = self.log(MANIFEST, MANIFEST_SCHEMA).filter(F.col("layer") == layer)
        rows = rows if shape is None else shape(rows)
        newest = F.max_by(F.struct(*rows.columns), F.struct("landed_at", "run")).alias("newest")
        # Names begin alike, so that sorting by them compares whole texts; their hashes differ.
        keys = [F.xxhash64("table_name").alias("__hash"), F.col("table_name")]
        return rows.groupBy(*keys).agg(newest).select("newest.*")

    def manifest(self, layer: str) -> DataFrame:
        """:meth:`newest` for the tables that are still there."""
        return self.newest(layer).join(self._names(layer), "table_name", "left_semi")

    def append(self, name: str, df: DataFrame) -> None:
        """Add rows to a log, a file per partition: what the driver holds should be one."""
        df.write.mode("append").parquet(f"{self.root}/{name}")

    def log(self, name: str, schema: str) -> DataFrame:
        """The rows of a log, none if nothing was added yet."""
        path = f"{self.root}/{name}"
        if not publish.is_folder(self.spark, path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path)

    def read(self, layer: str, table: str) -> DataFrame:
        return publish.read_table(self.spark, self.path(layer, table))

    def has(self, layer: str, table: str) -> bool:
        return publish.is_table(self.spark, self.path(layer, table))

    def tables(self, layer: str, containing: str = "") -> list[str]:
        names = publish.folder_names(self.spark, f"{self.root}/{layer}")
        return [name for name in names if containing.lower() in name.lower()]

    def columns(self, layer: str, table: str) -> list[str]:
        return [name.lower() for name in self.read(layer, table).columns]


@cache
def _own_folder() -> str:
    folder = tempfile.TemporaryDirectory(prefix="tidemark-")
    atexit.register(folder.cleanup)
    return folder.name


def work_folder(spark: SparkSession) -> str:
    """Folder for written intermediate tables, shared by all executors.

    The cluster names it in ``spark.checkpoint.dir``, or the program by ``setCheckpointDir``.
    Where both are unset, a session without a cluster gets a folder of its own until it ends;
    a cluster session is refused.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = _own_folder()
    return folder.rstrip("/") + "/tidemark"


def catalog_tables(spark: SparkSession, database: str, pattern: str = "*") -> DataFrame:
    """(table_name, columns) rows of the tables of a database in the session catalog whose
    names match; views of the session belong to every database."""
    rows = [
        (t.name, [c.name.lower() for c in spark.catalog.listColumns(t.name if t.isTemporary else f"{database}.{t.name}")])
        for t in spark.catalog.listTables(database, pattern)
    ]
    return spark.createDataFrame(rows, "table_name string, columns array<string>")
