"""Sharding along a Hilbert curve over several metadata dimensions.

Every dimension is quantised to a few bits by cutting its sorted values into
runs of about equal row counts, so codes keep the order of the values.  The
codes become one Hilbert index, the rows are sorted by it, and the order is
cut into runs whose row counts differ by one at most.  Rows of like metadata
then share few shards, and since the codes keep the order, the smallest and
largest value per shard (``manifest``) let a filter on any dimension skip
most of them.

Only DataFrame functions; the sort moves ids and numbers, not texts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.ordering import running_totals
from .common import materialise

BITS = 6
#: Row position within a partition, as monotonically_increasing_id lays it out.
_ROW_BITS = 33


def curve_tables(dims: int) -> tuple[list[int], list[int]]:
    """For each (state, corner) of the curve: the rank of the corner on the curve, and the next state.

    A state is the entry corner of a cell and the axis along which the curve
    leaves it, as ``entry * dims + axis``.
    """
    size, mask = 1 << dims, (1 << dims) - 1
    turn = lambda x, by: ((x << by % dims) | (x >> (dims - by % dims))) & mask
    gray = [w ^ (w >> 1) for w in range(size)]
    rank_of = {g: w for w, g in enumerate(gray)}
    trailing = lambda w: (~w & (w + 1)).bit_length() - 1
    ranks, following = [], []
    for state in range(size * dims):
        entry, axis = divmod(state, dims)
        for corner in range(size):
            seen = corner ^ entry
            w = rank_of[turn(seen, dims - (axis + 1) % dims)]
            start = gray[2 * ((w - 1) // 2)] if w else 0
            step = trailing(w - 1 if w % 2 == 0 else w) % dims if w else 0
            ranks.append(w)
            following.append((entry ^ turn(start, axis + 1)) * dims + (axis + step + 1) % dims)
    return ranks, following


def hilbert_index(codes: Sequence[Column], bits: int = BITS) -> Column:
    """Position on the Hilbert curve of the cell given by ``codes`` (each below 2**bits), as a long."""
    dims = len(codes)
    if dims * bits > 62:
        raise ValueError("the index must fit a long")
    ranks, following = curve_tables(dims)
    rank_at, next_at = (F.array(*map(F.lit, t)) for t in (ranks, following))

    def level(acc: Column, i: Column) -> Column:
        corner = sum((F.call_function("shiftright", c.cast("int"), i).bitwiseAND(F.lit(1)) * F.lit(1 << k)
                      for k, c in enumerate(codes)), F.lit(0))
        at = acc["state"] * (1 << dims) + corner + 1
        return F.struct((acc["index"] * (1 << dims) + F.element_at(rank_at, at)).alias("index"),
                        F.element_at(next_at, at).alias("state"))

    levels = F.array(*(F.lit(i) for i in reversed(range(bits))))
    return F.aggregate(levels, F.struct(F.lit(0).cast("long").alias("index"), F.lit(0).alias("state")), level)["index"]


def edges(rows: DataFrame, value: str, bits: int = BITS) -> list[tuple]:
    """``(smallest value, code)`` of each code in use, ascending: at most ``2**bits`` pairs.

    A value's code is the share of rows with smaller values, in steps of
    ``2**-bits``.  Counted per distinct value, then one running count.
    """
    counts = rows.where(F.col(value).isNotNull()).groupBy(value).agg(F.count("*").alias("n"))
    run = running_totals(counts, [value], ["n"], prefix="to_")
    total = run.agg(F.max("to_n")).first()[0] or 1
    code = F.expr(f"cast((to_n - n) * {1 << bits} div {total} as int)")
    found = run.groupBy(code.alias("code")).agg(F.min(value).alias("least")).orderBy("code").collect()
    return [(r["least"], r["code"]) for r in found]


def ordered_code(col: Column, pairs: Sequence[tuple]) -> Column:
    """The code of the last of ``edges`` that is not above the value; null comes first (code 0)."""
    if not pairs:
        return F.lit(0)
    known = F.array(*(F.struct(F.lit(least).alias("least"), F.lit(code).alias("code")) for least, code in pairs))
    below = F.filter(known, lambda e: e["least"] <= col)
    return F.when(col.isNull() | (F.size(below) == 0), F.lit(0)).otherwise(F.element_at(below, -1)["code"]).cast("int")


def ranked(rows: DataFrame, order: Sequence[str]) -> tuple[DataFrame, int]:
    """``rows`` with ``rank`` from 0 in the global order of ``order`` (nulls first), and their number.

    Range-partitioned sort; the ordered rows are written once, so every task
    that reads them sees one and the same order.  Only one row per partition
    is gathered for the offsets.  ``order`` should end in a near-unique column:
    rows equal in all of it share a partition, in any order.
    """
    at = F.monotonically_increasing_id()
    placed = materialise(
        rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", at), "ordered")
    part = F.call_function("shiftright", F.col("_at"), F.lit(_ROW_BITS))
    counts = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = materialise(
        counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset")), "offsets")
    out = placed.withColumn("_part", part).join(offsets, "_part").withColumn(
        "rank", F.col("_offset") + F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)))
    return out.drop("_part", "_offset", "_at"), placed.count()


def shard_documents(docs: DataFrame, shards: int = 16, bits: int = BITS, categories: Sequence[str] = ("source", "lang"),
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, size, text_crc32, hilbert, shard, slot`` for every row of ``docs``.

    The dimensions are the ``categories`` (as text) and the size of the text.
    ``size`` is the UTF-8 length plus 1; null text has none, so 1.  Counts of
    any two shards differ by one at most; ``slot`` counts from 0 in curve
    order.  Ties on the curve go by id, then checksum and size.  An empty
    table gives no rows, fewer rows than shards leave some shards empty, and
    repeated rows are placed one by one.  Other columns are ignored.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    dims = [f"d{i}" for i in range(len(categories))]
    rows = materialise(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + F.lit(1)).cast("long").alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
        *(F.col(c).cast("string").alias(d) for c, d in zip(categories, dims))), "metadata")
    codes = [ordered_code(F.col(d), edges(rows, d, bits)) for d in [*dims, "size"]]
    rows = rows.select("doc_id", "size", "text_crc32", hilbert_index(codes, bits).alias("hilbert"))
    placed, total = ranked(rows, ["hilbert", "doc_id", "text_crc32", "size"])
    shard = F.expr(f"rank * {shards} div {max(1, total)}")
    first = F.expr(f"(shard * {total} + {shards} - 1) div {shards}")
    return placed.withColumn("shard", shard).withColumn("slot", F.col("rank") - first).select(
        "doc_id", "size", "text_crc32", "hilbert", F.col("shard").cast("int").alias("shard"), "slot")


def manifest(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Smallest and largest value of ``columns`` per shard: what a reader needs to skip shards."""
    return rows.groupBy("shard").agg(
        F.count("*").alias("rows"),
        *(f(c).alias(f"{n}_{c}") for c in columns for n, f in (("min", F.min), ("max", F.max))))
