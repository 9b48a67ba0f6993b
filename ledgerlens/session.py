"""Session helpers: a tuned local session for tests/bench and lineage cuts.

On a cluster the session is created by the platform; library code only
reads configuration from it (``spark.checkpoint.dir``) and never sets a
machine-local folder there.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "ledgerlens") -> SparkSession:
    """A local session for tests and benchmarks (UI off, AQE on, UTC)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Where it is unset, a local master (tests, bench) gets a scratch folder;
    on a cluster that is an error, since executors do not share one.
    """
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not current:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="ledgerlens-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        spark.conf.set("spark.checkpoint.dir", current)
    if sc._jsc.sc().getCheckpointDir().isEmpty():
        sc.setCheckpointDir(current)
    return current


def scratch_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet below the shared folder and read back:
    fixes its rows for several readers and cuts the lineage at a point that
    survives lost executors.  The tables lie in ``<shared>/ledgerlens/<application>/``
    and can go when the application ends."""
    spark = df.sparkSession
    path = (f"{ensure_checkpoint_dir(spark).rstrip('/')}/ledgerlens/{spark.sparkContext.applicationId}/"
            f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class _Tables(dict):
    """Parquet tables opened on first access (a read lists files and reads
    footers, so only the tables a query touches are opened)."""

    def __init__(self, spark: SparkSession, sf_dir: str, names):
        super().__init__()
        self._spark, self._dir, self._names = spark, sf_dir.rstrip("/"), set(names)

    def __missing__(self, name: str) -> DataFrame:
        if name not in self._names:
            raise KeyError(name)
        df = self._spark.read.parquet(f"{self._dir}/{name}.parquet")
        self[name] = df
        return df


_OPENED: dict[tuple, _Tables] = {}


def read_tables(spark: SparkSession, sf_dir: str, names=TABLES) -> dict[str, DataFrame]:
    """The parquet tables of one scale factor, opened lazily and reused per session."""
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"), tuple(names))
    if key not in _OPENED:
        _OPENED[key] = _Tables(spark, sf_dir, names)
    return _OPENED[key]
