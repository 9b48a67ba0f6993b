"""File sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BOM = "﻿"


def _header(spark: SparkSession, path: str, encoding: str, sep: str, multi_line: bool) -> list[str]:
    """Header names only: reads the first line of the (first) file."""
    first = (spark.read.option("encoding", encoding).option("header", False).option("multiLine", multi_line)
             .option("sep", sep).option("escape", '"').option("recursiveFileLookup", True).csv(path).limit(1).collect())
    if not first:
        return []
    return [str(v) if v is not None else f"_c{i}" for i, v in enumerate(first[0])]


def clean_names(names) -> list[str]:
    """C1 for headers: strip a literal BOM and surrounding blanks."""
    return [n.replace(BOM, "").strip() for n in names]


def read_csv(spark: SparkSession, path: str, encoding: str = "UTF-8", sep: str = ",",
             schema: T.StructType | None = None, empty_as_null: bool = True, multi_line: bool = False) -> DataFrame:
    """Read a dirty CSV with every column as text, header names trimmed.

    Never infers types: money and dates are parsed afterwards by the
    cleaning expressions.  A doubled quote within quotes stands for one.  Works for Latin-1 (``encoding='ISO-8859-1'``) and
    BOM-prefixed UTF-8 files.  ``multi_line`` lets quoted values hold line
    breaks; a file is then read by one task.
    """
    if schema is None:
        names = _header(spark, path, encoding, sep, multi_line)
        schema = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(len(names))])
        trimmed = clean_names(names)
    else:
        trimmed = clean_names(schema.fieldNames())
    reader = (spark.read.option("header", True).option("encoding", encoding).option("sep", sep).option("escape", '"')
              .option("recursiveFileLookup", True)  # folders are parts of the data, not columns
              .option("multiLine", multi_line).schema(schema))
    if not empty_as_null:
        reader = reader.option("nullValue", "\u0000")
    return reader.csv(path).toDF(*trimmed)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """S3: export with a header, quotes within values doubled; ``single_file`` only for small, bounded results."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_raw_csv(lines: DataFrame, path: str, header: str, mark: bool = False) -> None:
    """CSV files from finished text lines (column ``line``), each file starting with ``header``, and with
    ``mark`` with U+FEFF before it: what Spark's CSV writer cannot make.

    Every task of ``lines`` becomes a folder with one file; the header is a
    row that sorts first in it.
    """
    dealt = lines.select(F.spark_partition_id().alias("__file"), F.lit(1).alias("__place"), "line")
    first = (BOM if mark else "") + header
    heads = dealt.select("__file").distinct().select("__file", F.lit(0).alias("__place"), F.lit(first).alias("line"))
    rows = dealt.unionByName(heads).repartition("__file").sortWithinPartitions("__file", "__place")
    rows.select("line", "__file").write.mode("overwrite").partitionBy("__file").text(path)


def write_parquet(df: DataFrame, path: str, partition_by=None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.parquet(path)


def text_lines(df: DataFrame, key: str, text: str = "text", line: str = "line",
               position: str = "line_no") -> DataFrame:
    """One row per line of every document, with its 1-based line number."""
    return df.select(key, F.posexplode(F.split(F.col(text), "\n")).alias(position, line)) \
             .withColumn(position, F.col(position) + 1)


def read_text_lines(spark: SparkSession, path: str) -> DataFrame:
    """S8 for files: ``(path, line_no, line)`` of every text file under ``path``.

    Files are read in splits, so a large one is shared by many tasks; a
    distributed row number in (file, split, place) order counts the lines.
    """
    from ..operators.ordering import global_row_number

    lines = spark.read.text(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("__at"),
        F.monotonically_increasing_id().alias("__id"), F.col("value").alias("line"))
    numbered = global_row_number(lines, ["path", "__at", "__id"], "__rn")
    first = numbered.groupBy(F.col("path").alias("__path")).agg(F.min("__rn").alias("__first"))
    return numbered.join(first, F.col("path") == F.col("__path")).select(
        "path", (F.col("__rn") - F.col("__first") + 1).cast("int").alias("line_no"), "line")


def save_model(model, path: str) -> None:
    """Persist a fitted ``PipelineModel`` (or any MLWritable)."""
    model.write().overwrite().save(path)


def load_model(path: str):
    """Load a ``PipelineModel`` saved by :func:`save_model`."""
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path)
