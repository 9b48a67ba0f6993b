"""Text search over document lines.

Documents are split into lines with their position (S8).  One document may
hold a large share of all lines, so no step funnels a document into one
task: the heading carry-down is a distributed running count, first
occurrences are a map-side-combined ``min``, per-document top hits use the
map-side group limit and match counts a partial aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import search_contains
from ..sources.files import text_lines
from .ordering import running_totals
from .reshape import dedupe_keep_first
from .windows import top_n_per_group

# Section headings have two number signs; text before the first belongs to this section.
_HEADING = r"^\s*##\s+(.+?)\s*$"
_ITEM = r"^\s*(\d+)\.\s+(.*\S)\s*$"
FIRST_SECTION = "General"


def extract_numbered_items(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``N. text`` lines with the latest heading above them carried
    down (``General`` before any), bold marks removed, one row per
    (document, number) — the first occurrence.

    Only heading and item lines take part.  A running count of headings in
    (document, line) order numbers them, so the heading above an item is the
    one whose number equals the item's running count — an equi-join (on the
    document too, so a count carried over from an earlier document finds
    nothing).  A heading with very many items is a skewed join key that
    AQE splits; no document is sorted whole in one task.
    """
    lines = text_lines(docs, key, text)
    is_head = F.col("line").rlike(_HEADING)
    marked = lines.where(is_head | F.col("line").rlike(_ITEM)) \
                  .select(key, "line_no", "line", is_head.cast("long").alias("__h"))
    numbered = running_totals(marked, [key, "line_no"], ["__h"], prefix="__cum")
    heads = numbered.where(F.col("__h") == 1).select(
        F.col(key).alias("__hkey"), F.col("__cum__h").alias("__hno"),
        F.regexp_extract("line", _HEADING, 1).alias("section"))
    items = numbered.where(F.col("__h") == 0).select(
        key, "line_no", "__cum__h",
        F.regexp_extract("line", _ITEM, 1).cast("int").alias("number"),
        F.trim(F.regexp_replace(F.regexp_extract("line", _ITEM, 2), r"\*\*", "")).alias("item"))
    placed = items.join(heads, (items["__cum__h"] == heads["__hno"]) & items[key].eqNullSafe(heads["__hkey"]),
                        "left").select(key, "number", "line_no",
                                       F.coalesce("section", F.lit(FIRST_SECTION)).alias("section"), "item")
    first = dedupe_keep_first(placed, [key, "number"], ["line_no"])
    return first.select(key, "number", "section", "item")


def search_documents(docs: DataFrame, key: str, query: str, k: int = 3, text: str = "text") -> DataFrame:
    """K1: non-blank lines containing ``query`` (case-insensitive literal),
    the first ``k`` per document, with the document's match count."""
    lines = text_lines(docs, key, text)
    hits = lines.where((F.trim("line") != "") & search_contains("line", query))
    counts = hits.groupBy(F.col(key).alias("__ckey")).agg(F.count(F.lit(1)).alias("matches"))
    first = top_n_per_group(hits.withColumn("__desc", -F.col("line_no")), key, "__desc", k,
                            rank_col="hit_no", ties=False)
    return first.join(counts, first[key].eqNullSafe(counts["__ckey"]), "inner") \
                .select(key, "line_no", "line", "hit_no", "matches")


def search_insights(items: DataFrame, query: str | None = None, section: str | None = None) -> DataFrame:
    """K2: numbered insights filtered by section and a literal search."""
    out = items
    if section is not None:
        out = out.where(F.col("section") == section)
    if query:
        out = out.where(search_contains("item", query))
    return out
