"""Shared helpers: table access, scratch tables in the shared folder, ASCII text rules."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.  Where it is unset, a
    local master (tests) gets a temporary folder; a cluster is refused, since
    its executors do not share one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    root = tempfile.mkdtemp(prefix="llm-shared-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


#: Parquet asks for the size of what it holds after 100 rows at first; of large rows it then holds gigabytes, and so does a reader.
LARGE_ROWS = {"parquet.block.size": 16 << 20, "parquet.page.size.row.check.min": 1}


def materialise(df: DataFrame, name: str, large_rows: bool = False) -> DataFrame:
    """Write ``df`` as Parquet below the shared folder and read it back.

    This cuts the lineage at a point that survives lost executors, fixes the
    rows of a plan that is read more than once, and gives Spark the size by
    which it decides on broadcasts.  Tables lie in
    ``<shared>/llm/<application id>/`` and can go when the application ends.
    ``large_rows``: rows of megabytes lie in row groups of few rows, since a
    task reads a row group as a whole.
    """
    spark = df.sparkSession
    path = f"{shared_root(spark)}/llm/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.options(**(LARGE_ROWS if large_rows else {})).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh_names(columns: Iterable[str], *stems: str) -> list[str]:
    """A name for each stem that none of ``columns`` has, whatever its case."""
    taken = {c.lower() for c in columns}
    out = []
    for name in stems:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def join_on_hot_key(rows: DataFrame, keyed: DataFrame, key: str, count: str, share: int = 4096) -> DataFrame:
    """``rows`` joined to ``keyed``, one row per ``key`` with the number ``count`` of rows it has.

    Keys with more than one row in ``share`` of all are at most ``share``, so
    they are broadcast and their rows stay where they are; the rest is joined
    by Spark's choice.  Both sides should be written tables.
    """
    least = rows.count() // share + 2
    heavy = keyed.where(F.col(count) >= least).drop(count)
    light = keyed.where(F.col(count) < least).drop(count)
    rest = rows.join(F.broadcast(heavy.select(key)), key, "left_anti")
    return rows.join(F.broadcast(heavy), key).unionByName(rest.join(light, key))


def ascii_lower(col: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(col, UPPER, LOWER)


def small_batches(batches: Iterable[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows, at most ``rows`` at a time: what a task holds as Python
    objects stays small however large the batches that Spark sends."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)
