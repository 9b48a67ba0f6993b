"""Warehouse load / read and the named-query registry.

Layout under a root folder on the shared filesystem::

    root/<version>/<table>/part-*.parquet   one folder per published version
    root/_CURRENT-<version>                 marks a version as published

``load_warehouse`` writes every table of a new version (dimensions first),
optionally runs the constraint checks, and only then renames the version's
marker into place.  A marker never replaces another, so at every moment the
newest marker names a complete version: readers are never without one, and a
failed load leaves the previous version live.  Versions sort by time and end
in a random part, so two writers never share one.  Beyond the newest ``keep``
versions, old ones are removed after a publish.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Mapping, Sequence
from multiprocessing.pool import ThreadPool

from pyspark.sql import DataFrame, SparkSession

from ..session import ensure_checkpoint_dir

MARKER = "_CURRENT-"


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p, jvm


def _mark(spark: SparkSession, root: str, version: str, text: str) -> None:
    """Publish ``version``: its marker appears complete, by one rename to a new name."""
    fs, tmp, jvm = _fs(spark, f"{root}/.{MARKER}{version}.tmp")
    out = fs.create(tmp, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    if not fs.rename(tmp, jvm.org.apache.hadoop.fs.Path(f"{root}/{MARKER}{version}")):
        raise OSError(f"could not publish {version} below {root}")


def _published(spark: SparkSession, root: str) -> list[str]:
    """Published versions, oldest first."""
    fs, p, _ = _fs(spark, root)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(n[len(MARKER):] for n in names if n.startswith(MARKER))


def _remove_old(spark: SparkSession, root: str, keep: int, hours: float) -> None:
    """Remove published versions beyond the newest ``keep`` that were replaced more than ``hours`` ago:
    the marker first, then the tables.

    A version is replaced when the next one appears, so a reader that opened
    it has that long to finish.
    """
    versions = _published(spark, root)
    since = {}
    for version in versions:
        fs, p, _ = _fs(spark, f"{root}/{MARKER}{version}")
        since[version] = fs.getFileStatus(p).getModificationTime() / 1000
    for version, following in list(zip(versions, versions[1:]))[:max(0, len(versions) - keep)]:
        if since[following] > time.time() - hours * 3600:
            continue
        for name in (f"{MARKER}{version}", version):
            fs, p, _ = _fs(spark, f"{root}/{name}")
            fs.delete(p, True)


def source_fingerprint(spark: SparkSession, paths: Sequence[str]) -> str:
    """Names, sizes and modification times of the files below ``paths``: changes when a source does."""
    import hashlib

    out = hashlib.sha1()
    for path in paths:
        fs, p, _ = _fs(spark, path)
        files = fs.listFiles(p, True)
        seen = []
        while files.hasNext():
            f = files.next()
            seen.append(f"{f.getPath().getName()}|{f.getLen()}|{f.getModificationTime()}")
        out.update("\n".join([path, *sorted(seen)]).encode())
    return out.hexdigest()


def warehouse_root(spark: SparkSession, name: str) -> str:
    """A warehouse folder inside the shared folder named by ``spark.checkpoint.dir``."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/warehouse/{name}"


def load_warehouse(tables: Mapping[str, DataFrame], root: str, order: Sequence[str] | None = None,
                   checks: Callable[[dict[str, DataFrame]], None] | None = None,
                   empty_as_null: bool = True,
                   partition_by: Mapping[str, Sequence[str]] | None = None, keep: int = 2,
                   parallelism: int = 4, keep_hours: float = 24) -> str:
    """Idempotent full reload of a set of tables, ``parallelism`` of them at
    a time and in the given order; returns the new version.

    ``partition_by`` names Hive-style partition columns per table (e.g. a
    summary by year), so filters on them prune whole folders.  Versions beyond
    the newest ``keep`` are removed ``keep_hours`` after they were replaced,
    which must be longer than any read takes."""
    names = list(order or tables.keys())
    spark = next(iter(tables.values())).sparkSession
    root = root.rstrip("/")
    version = f"v{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    base = f"{root}/{version}"

    def write(n: str) -> None:
        df = tables[n]
        texts = [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
        if empty_as_null and texts:
            df = df.replace("", None, subset=texts)
        parts = list(partition_by.get(n, [])) if partition_by else []
        # REBALANCE: AQE sizes the output files to the advisory partition size
        # (coalescing small partitions, splitting skewed ones) at any scale
        df = df.hint("rebalance", *parts) if parts else df.hint("rebalance")
        w = df.write.mode("overwrite")
        if parts:
            w = w.partitionBy(*parts)
        w.parquet(f"{base}/{n}")

    with ThreadPool(max(1, parallelism)) as pool:  # the tables are independent; nothing is visible before the marker
        pool.map(write, names, chunksize=1)
    staged = {n: spark.read.parquet(f"{base}/{n}") for n in names}
    if checks is not None:
        checks(staged)  # raises → no marker, old version stays live
    _mark(spark, root, version, ",".join(names))
    _remove_old(spark, root, keep, keep_hours)
    return version


def current_version(spark: SparkSession, root: str) -> tuple[str, list[str]]:
    root = root.rstrip("/")
    versions = _published(spark, root)
    if not versions:
        raise FileNotFoundError(root)
    fs, p, jvm = _fs(spark, f"{root}/{MARKER}{versions[-1]}")
    reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(fs.open(p), "UTF-8"))
    try:
        names = (reader.readLine() or "").strip()
    finally:
        reader.close()
    return versions[-1], [n for n in names.split(",") if n]


def read_warehouse(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """Open the live version's tables.

    Nothing is registered under a session-wide name: two warehouses with the
    same table names can be open at once.  :class:`QueryRegistry` binds SQL
    texts to the tables it is given.
    """
    version, names = current_version(spark, root)
    return {n: spark.read.parquet(f"{root.rstrip('/')}/{version}/{n}") for n in names}


def register_views(tables: Mapping[str, DataFrame], prefix: str = "") -> None:
    """Temp views ``<prefix><table>`` of the session; a prefix per warehouse keeps them apart."""
    for n, df in tables.items():
        df.createOrReplaceTempView(prefix + n)


class QueryRegistry:
    """Named SQL texts run with ``spark.sql``.

    A text names its tables as ``{table}`` and its parameters as ``:name``;
    each run binds the placeholders to the tables passed in, so a text never
    reads another warehouse's view.  Plain names refer to views.
    """

    def __init__(self, queries: Mapping[str, str] | None = None):
        self._q = dict(queries or {})

    def register(self, name: str, sql: str) -> None:
        self._q[name] = sql

    def names(self) -> list[str]:
        return sorted(self._q)

    def run(self, spark: SparkSession, name: str, tables: Mapping[str, DataFrame] | None = None, **params) -> DataFrame:
        return spark.sql(self._q[name], args=params or None, **dict(tables or {}))
