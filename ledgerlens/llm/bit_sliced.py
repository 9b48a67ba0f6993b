"""Exact top-k inner products on a bit-sliced index.

Every vector component x is quantised to floor(256 x).  A block of rows is
stored as bit slices: for each dimension one bitmap per binary digit of the
quantised attribute, one bit per row.  The score of a query against all rows
of a block is the sum of the slices shifted by the set bits of the query's
components; bitmaps of equal weight are added three at a time by carry-save
adders, so the score itself comes out as bit slices.  The best rows are then
selected from the most significant slice downward, and rows tied at the
boundary are resolved by their ids.

Both sides of the product meet in bounded pieces: blocks of at most about
``BLOCK_ROWS`` rows against blocks of at most about ``QUERY_ROWS`` queries.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise

SCALE = 256
BLOCK_ROWS = 1 << 15
QUERY_ROWS = 128
#: Quantised components of this size or more have no slices in a long: an error, not a row less.
LARGEST = 1 << 62


def quantised(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(vec_id, q, row)``: floor(256 x) of every component of every vector that takes part, and a number per row.

    Left out: null ids, null vectors, and vectors that hold a null or a
    non-finite component.  Rows that repeat an id stay rows of their own.  A
    component of 2**62 or more after quantising raises an error.
    """
    infinite = float("inf")
    x = F.transform(F.col(vector_col), lambda v: v.cast("double"))
    fine = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < infinite))
    rows = vectors.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("vec_id"), x.alias("x")).where(fine.isNull() | fine)
    rows = rows.where(F.forall("x", lambda v: v.isNotNull()))
    q = F.transform("x", lambda v: F.when(F.abs(v) < LARGEST / SCALE, F.floor(v * SCALE).cast("long")).otherwise(
        F.raise_error(F.lit("a component is too large to be sliced")).cast("long")))
    return rows.select("vec_id", q.alias("q"), F.monotonically_increasing_id().alias("row"))


def _matrix(lists: pd.Series, width: int) -> np.ndarray:
    """Rows padded with zeros to ``width`` components."""
    out = np.zeros((len(lists), width), np.int64)
    for i, row in enumerate(lists):
        out[i, :len(row)] = row
    return out


def build_block(rows: pd.DataFrame) -> pd.DataFrame:
    """The bit-sliced index of one block: rows by ascending id, slices of (component + 2**(bits-1)) per dimension."""
    rows = rows.sort_values(["vec_id", "row"])
    width = max(map(len, rows["q"]), default=0)
    values = _matrix(rows["q"], width)
    top = int(np.abs(values).max(initial=0))
    bits = max(2, top.bit_length() + 1)
    unsigned = values + (1 << (bits - 1))
    words = -(-len(rows) // 64)
    slices = np.zeros((width, bits, words * 8), np.uint8)
    for d in range(width):
        for j in range(bits):
            packed = np.packbits((unsigned[:, d] >> j & 1).astype(np.uint8), bitorder="little")
            slices[d, j, :len(packed)] = packed
    return pd.DataFrame({"block": [rows["block"].iloc[0]], "n": [len(rows)], "width": [width], "bits": [bits],
                         "ids": [rows["vec_id"].to_numpy("<i8").tobytes()], "slices": [slices.tobytes()]})


BLOCKS = "block int, n int, width int, bits int, ids binary, slices binary"


def build_index(vectors: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of the index from ``quantised`` rows, which are dealt to blocks by a hash of their number."""
    blocks = max(1, -(-vectors.count() // block_rows))
    dealt = vectors.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    return dealt.groupBy("block").applyInPandas(build_block, BLOCKS)


def add_slices(columns: list[list[np.ndarray]], words: int) -> list[np.ndarray]:
    """Slices of the sum of weighted bitmaps; ``columns[w]`` holds bitmaps of weight 2**w."""
    out, w = [], 0
    while w < len(columns):
        column = columns[w]
        while len(column) > 1:
            if w + 1 == len(columns):
                columns.append([])
            a, b = column.pop(), column.pop()
            half = a ^ b
            if column:  # carry-save adder: three bitmaps become one, and a carry
                c = column.pop()
                column.insert(0, half ^ c)
                half &= c
                half |= a & b
                columns[w + 1].append(half)
            else:
                column.append(half)
                columns[w + 1].append(a & b)
        out.append(column[0] if column else np.zeros(words, np.uint64))
        w += 1
    return out


def score_slices(query: np.ndarray, slices: np.ndarray, words: int) -> tuple[list[np.ndarray], int]:
    """Slices of (score - base) over the rows of a block, and base.

    A dimension's slices hold u = v + half; for a negative query component
    the complement (2 half - 1) - u is added, so no term is negative.
    """
    width, bits = slices.shape[:2]
    half, base = 1 << (bits - 1), 0
    columns: list[list[np.ndarray]] = [[] for _ in range(bits + int(np.abs(query).max(initial=0)).bit_length())]
    flipped = ~slices
    for d in range(min(width, len(query))):
        size = abs(int(query[d]))
        source = slices[d] if query[d] > 0 else flipped[d]
        base += -size * half if query[d] > 0 else -size * (half - 1)
        for i in range(size.bit_length()):
            if size >> i & 1:
                for j in range(bits):
                    columns[i + j].append(source[j])
    return add_slices(columns, words), base


def _count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def _positions(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def select_top(scores: list[np.ndarray], among: np.ndarray, k: int) -> np.ndarray:
    """Rows of the ``k`` highest scores among the set bits, ties to lower rows, in no order.

    Slice by slice from the most significant: ``sure`` are rows above the
    boundary, ``tied`` those that agree with it so far.
    """
    sure, tied = np.zeros_like(among), among.copy()
    n_sure = 0
    for bitmap in reversed(scores):
        ones = tied & bitmap
        n = _count(ones)
        if n_sure + n > k:
            tied = ones
        else:
            sure |= ones
            n_sure += n
            tied &= ~bitmap
        if n_sure == k:
            return _positions(sure)
    return np.concatenate([_positions(sure), _positions(tied)[:k - n_sure]])


def search_block(block: pd.DataFrame, queries: pd.DataFrame, k: int) -> pd.DataFrame:
    """Every query's ``k`` best rows of one block, its own id left out."""
    out: list[tuple[int, int, int]] = []
    if len(block) and len(queries):
        b = block.iloc[0]
        words = -(-int(b["n"]) // 64)
        ids = np.frombuffer(b["ids"], "<i8")
        slices = np.frombuffer(b["slices"], np.uint64).reshape(b["width"], b["bits"], words)
        full = np.zeros(words * 64, np.uint8)
        full[:len(ids)] = 1
        every = np.packbits(full, bitorder="little").view(np.uint64)
        for own, q in zip(queries["vec_id"], queries["q"]):
            query = np.asarray(q, np.int64)
            scores, base = score_slices(query, slices, words)
            among = every
            first, end = (int(np.searchsorted(ids, own, side)) for side in ("left", "right"))
            if first < end:
                full[first:end] = 0
                among = np.packbits(full, bitorder="little").view(np.uint64)
                full[first:end] = 1
            for row in select_top(scores, among, k):
                score = sum(int(s[row >> 6] >> np.uint64(row & 63) & np.uint64(1)) << w for w, s in enumerate(scores))
                out.append((own, int(ids[row]), score + base))
    return pd.DataFrame(out, columns=["query_id", "vec_id", "score"]).astype("int64")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vector_col: str = "embedding",
          block_rows: int = BLOCK_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: for each query its ``k`` highest integer inner products over ``vectors``.

    ``queries`` has the same two columns; rows with the query's own id are no
    candidates.  Rows that repeat an id are candidates one by one, and queries
    that repeat one share its ``k`` places.  Ties go to the smaller id; fewer
    than ``k`` candidates give fewer rows.  A score beyond a long raises an
    error.  Vectors of unequal length are compared as if the shorter had
    zeros at its end.  Empty tables give an empty result.
    """
    rows = materialise(quantised(vectors, id_col, vector_col), "quantised")
    index = materialise(build_index(rows, block_rows), "slices")
    asked = materialise(quantised(queries, id_col, vector_col), "queries")
    parts = max(1, -(-asked.count() // query_rows))
    blocks = max(1, -(-rows.count() // block_rows))
    dealt = asked.withColumn("part", F.pmod(F.xxhash64("row"), F.lit(parts)).cast("int"))
    left = index.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(parts - 1))))
    right = dealt.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    found = (left.groupBy("block", "part").cogroup(right.groupBy("block", "part"))
             .applyInPandas(lambda a, b: search_block(a, b, k), "query_id long, vec_id long, score long"))
    best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
