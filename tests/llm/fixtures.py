"""Rows that every operator must bear, and small helpers."""

from pyspark.sql import DataFrame, SparkSession

SMALL = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Extra columns whose names operators use themselves.
CLASHING = (
    "score double, fp long, shard int, rank int, key long, open boolean, items string, _host string, lines string, "
    "_lines string, _kept string, host string, gone string, left string, _drop_id long, _drop_text string, gone_id long, "
    "gone_text string, text_hash long, root long, component_id long, rep long, n long, _row long, _text string, "
    "_toxicity double, toxicity double, _id long, _toxic int, has string, doc_ids string, n_words long, n_hit long, "
    "item_ids string, contaminated boolean, ordinal int, hits string, start long, length long, sequence_id long, "
    "offset long, ids string, piece int, tokens string, predicted int, held_out boolean, size long, hilbert long, slot long, "
    "codes string, _at long, _part long, _offset long")

LONG = "the quick brown fox jumps over the lazy dog and runs away " * 4000


def edge_rows() -> list[tuple]:
    """Nulls in every column, empty, blank and very long texts, ties and repeated rows."""
    rows = [(1, "alpha beta gamma delta epsilon zeta eta theta", "en", "a", 45), (2, None, None, None, None),
            (None, "alpha beta gamma delta epsilon zeta eta theta", "en", "a", 45), (3, "", "en", "a", 0),
            (4, "   \n\t ", "en", "b", 6), (5, LONG, "en", "b", len(LONG)), (6, "naïve café ÜBER straße\nzweite Zeile", "de", "b", 34),
            (7, "one", "fr", "a", 3), (7, "one", "fr", "a", 3), (8, "same id, first text", "en", "c", 19),
            (8, "same id, second text", "en", "c", 20), (None, None, None, None, None)]
    return rows


def edge_docs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(edge_rows(), DOCS)


def with_clashes(docs: DataFrame) -> DataFrame:
    from pyspark.sql import functions as F

    kinds = dict(part.split() for part in CLASHING.split(", "))
    return docs.withColumns({name: F.lit("true" if kind == "boolean" else "1").cast(kind) for name, kind in kinds.items()
                             if name not in docs.columns})


def empty_docs(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], DOCS)


def rows_of(df: DataFrame, *columns: str) -> list[tuple]:
    """Rows as tuples in a fixed order."""
    return sorted((tuple(r) for r in df.select(*columns or df.columns).collect()), key=repr)
