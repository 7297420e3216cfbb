"""Tables in versions: a write adds folders, and one small file committed last makes them current.

``root/data/load=<unique>`` holds the rows of one write. ``root/manifest/<unique>`` holds one JSON line for
each table that a commit changes: its name, its next version, the folders that make it up and its schema.
Spark moves that single file into place when everything else is there, so a write that fails half-way
leaves the tables as they were, several tables change together, and a frame read before goes on reading
its own version's folders. Nothing is overwritten or deleted, and no session setting is changed.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST = "name string, version bigint, folders array<string>, schema string, committed timestamp"
#: Name of the table of a root that holds only one, and the column that tells a scan's folders apart.
ONLY = "table"
LOAD = "load"


@dataclass(frozen=True)
class Written:
    """Folders with rows of one schema (JSON)."""

    folders: tuple[str, ...]
    schema: str

    def __add__(self, other: Written) -> Written:
        return Written(self.folders + other.folders, self.schema)


def add_data(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> Written:
    """Write rows into a new folder under ``root``; no reader sees it until it is committed."""
    load = f"w{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(f"{root}/data/{LOAD}={load}")
    return Written((load,), df.schema.json())


def read_data(spark: SparkSession, root: str, written: Written, keep_load: bool = False) -> DataFrame:
    """The rows of some folders, as one scan."""
    schema = T.StructType.fromJson(json.loads(written.schema)).add(LOAD, "string")
    paths = [f"{root}/data/{LOAD}={load}" for load in written.folders]
    rows = spark.read.schema(schema).option("basePath", f"{root}/data").parquet(*paths)
    return rows if keep_load else rows.drop(LOAD)


def manifest(spark: SparkSession, root: str) -> DataFrame:
    """All committed versions of all tables under ``root``; no rows if there is none."""
    try:
        return spark.read.schema(MANIFEST).json(f"{root}/manifest/*")
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return spark.createDataFrame([], MANIFEST)
        raise


def current(spark: SparkSession, root: str, version: int | None = None) -> dict[str, tuple[int, Written]]:
    """``(version, data)`` of each table's newest (or the given) version. Of two commits of one version the later one counts."""
    rows = manifest(spark, root)
    rows = rows if version is None else rows.filter(F.col("version") == version)
    newest = F.max_by(F.struct("version", "folders", "schema"), F.struct("version", "committed", "folders"))
    return {r.name: (r.v.version, Written(tuple(r.v.folders), r.v.schema)) for r in rows.groupBy("name").agg(newest.alias("v")).collect()}


def commit(spark: SparkSession, root: str, tables: Mapping[str, Written]) -> None:
    """Make the data the next version of each named table, all at once."""
    before = current(spark, root)
    rows = [(name, before[name][0] + 1 if name in before else 1, list(w.folders), w.schema) for name, w in tables.items()]
    lines = spark.createDataFrame(rows, "name string, version bigint, folders array<string>, schema string")
    lines.withColumn("committed", F.current_timestamp()).coalesce(1).write.json(f"{root}/manifest/{uuid.uuid4().hex}")


def replace_table(df: DataFrame, root: str, name: str = ONLY, partition_by: Sequence[str] = ()) -> None:
    """Write the rows, then make them the table's next version."""
    commit(df.sparkSession, root, {name: add_data(df, root, partition_by)})


def append_rows(df: DataFrame, root: str, name: str = ONLY, partition_by: Sequence[str] = ()) -> None:
    """Write the rows, then make the current version's folders and them the next version."""
    spark = df.sparkSession
    written = add_data(df, root, partition_by)
    before = current(spark, root)
    commit(spark, root, {name: before[name][1] + written if name in before else written})


def read_version(spark: SparkSession, root: str, name: str = ONLY, version: int | None = None) -> DataFrame:
    """The newest (or the given) version of a table; the frame stays with that version's folders."""
    found = current(spark, root, version).get(name)
    if found is None:
        raise FileNotFoundError(f"no version of {name} under {root}")
    return read_data(spark, root, found[1])
