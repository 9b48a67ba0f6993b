"""A training corpus from ``documents`` in five stages, each one operator of ``ledgerlens.llm``.

Every stage is ``(name, function)``; a function takes (spark, docs, sf_dir)
and returns a DataFrame that is written as Parquet and read again as the next
one's docs.  All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.llm import decontam, line_dedup, packing, simhash, toxicity
from ledgerlens.llm.common import fresh_names, materialise, read_table
from ledgerlens.llm.queries import tokenizer_path


def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the counterfactual-regularised classifier does not call toxic."""
    return toxicity.drop_toxic(docs, read_table(spark, sf_dir, "labels"))


def site_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document without the boilerplate lines of its source; ``n_chars`` follows the text."""
    lines, dropped = fresh_names(docs.columns, "lines", "dropped")
    cleaned = line_dedup.drop_boilerplate(docs, counts=(lines, dropped))
    cleaned = cleaned.withColumn("n_chars", F.when(F.col(dropped) > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType))
                                 .otherwise(F.col("n_chars")))
    return cleaned.drop(lines, dropped)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash near-duplicate group."""
    return simhash.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by the benchmark."""
    return decontam.drop_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def bounded_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all remaining documents in their training sequences."""
    return packing.pack(docs, tokenizer_path(), added_tokens=True)


STAGES = [
    ("toxicity", toxicity_filter),
    ("line_dedup", site_lines),
    ("simhash_near_dedup", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("packing", bounded_packing),
]

#: The learnt classifier, XXH64 fingerprints and token ids have no SQL form; the tests hold a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
