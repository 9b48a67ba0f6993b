"""SimHash near-duplicates by multi-index hashing.

A fingerprint is cut into two 32-bit segments.  Two fingerprints that differ
in at most three bits differ in at most one bit of one of the segments, so
every fingerprint looks up the ball of radius one around each of its segments
in a table keyed by (segment, value), and each match is verified on the
complete fingerprints.  A pair at segment distance one is looked up only from
the side whose bit is 0, which halves the ball without losing a pair.

Spark shuffles only distinct fingerprints: copies collapse before the search,
and links are contracted to components without leaving Spark.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh_names, join_on_hot_key, materialise, small_batches
from .components import connected_components

SEED = 42
SEGMENT_BITS = 32
BLOCK = 1 << 15


def fingerprint(data: bytes, shingle: int = 3) -> int:
    """64-bit SimHash of UTF-8 text: a bit is set if more than half of the
    shingle hashes have it.  No words: 0.  Fewer words than a shingle: the
    whole sequence is the one shingle."""
    words = data.lower().split()  # bytes: A-Z only, and exactly the ASCII white space
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    grams = map(b" ".join, zip(*(islice(words, i, None) for i in range(shingle)))) if n > 1 else [
        b" ".join(words)]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, grams, repeat(SEED)), np.uint64, n)
    ones = np.zeros(64, np.int64)
    for i in range(0, n, BLOCK):
        octets = hashes[i:i + BLOCK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """``(doc_id, text_hash, fp)`` per row; ``fp`` is the fingerprint as a signed long.  Null text counts as empty."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            texts = batch.column(2).cast(pa.binary())
            fps = (fingerprint(t.as_py() or b"", shingle) for t in texts)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fps, pa.int64())], names=["doc_id", "text_hash", "fp"])

    text = F.col(text_col).cast("string")
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"),
                         text.alias("text"))
    return picked.mapInArrow(scan, "doc_id long, text_hash long, fp long")


def links(distinct: DataFrame, max_bits: int = 3) -> DataFrame:
    """Verified links ``(a, b)`` between distinct fingerprints ``fp`` at 1 to ``max_bits`` differing bits.

    ``max_bits`` must be 3 or less: that is what radius one in two segments covers.
    """
    if not 0 <= max_bits <= 3:
        raise ValueError("two segments searched to radius one cover at most three bits")
    segment = F.explode(F.array(*(
        F.struct(F.lit(j).alias("j"),
                 F.shiftrightunsigned("fp", 32 * j).bitwiseAND(F.lit(0xFFFFFFFF)).alias("seg")) for j in (0, 1))))
    cut = distinct.select("fp", segment.alias("s")).select("fp", "s.j", "s.seg")
    key = F.col("seg") + F.col("j") * F.lit(1 << SEGMENT_BITS)
    home = cut.select(key.alias("key"), F.col("fp").alias("b"))
    flips = F.explode(F.array(*(F.lit(1 << i) for i in range(SEGMENT_BITS)))).alias("bit")
    ball = (cut.select("fp", "j", "seg", flips).where(F.col("seg").bitwiseAND(F.col("bit")) == 0)
            .select((key + F.col("bit")).alias("key"), F.col("fp").alias("a"), F.lit(True).alias("flipped")))
    probe = cut.select(key.alias("key"), F.col("fp").alias("a"), F.lit(False).alias("flipped")).unionByName(ball)
    differ = F.bit_count(F.col("a").bitwiseXOR(F.col("b")))
    found = probe.join(home, "key").where(
        (differ <= max_bits) & (differ > 0) & (F.col("flipped") | (F.col("a") < F.col("b"))))
    return found.select("a", "b")


def _rows_with_components(docs: DataFrame, id_col: str, text_col: str, shingle: int, max_bits: int) -> DataFrame:
    """``(doc_id, text_hash, fp, root, component_id)`` per row; ``root`` is a fingerprint that names the component."""
    rows = materialise(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    distinct = materialise(rows.groupBy("fp").agg(F.min("doc_id").alias("rep"), F.count("*").alias("n")), "distinct")
    label = connected_components(links(distinct.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    linked = distinct.join(label, "fp")
    smallest = linked.groupBy("root").agg(F.min("rep").alias("smallest"))
    moved = linked.join(smallest, "root").select("fp", "root", "smallest", F.lit(True).alias("moved"))
    per_print = materialise(distinct.join(moved, "fp", "left").select(
        "fp", "n", F.coalesce("root", "fp").alias("root"),
        F.when(F.col("moved"), F.col("smallest")).otherwise(F.col("rep")).alias("component_id")), "labelled")
    return join_on_hot_key(rows, per_print, "fp", "n").select("doc_id", "text_hash", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row of ``docs``.

    ``component_id`` is the smallest id reachable over links of at most
    ``max_bits`` differing bits, the row's own included; null ids never win,
    and a component of null ids only has a null ``component_id``.  Repeated
    rows come back as often as they came.  Empty tables give empty results;
    extra columns are ignored.
    """
    found = _rows_with_components(docs, id_col, text_col, shingle, max_bits)
    return found.select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` with one row per near-duplicate component: that of the smallest id.

    A null id gives way to any other id; among rows of one id the smallest
    text hash stays, and of rows equal in id and text any one.  Null text is
    empty.  An empty table stays empty.  Columns are those of ``docs``,
    whatever their names.
    """
    found = materialise(_rows_with_components(docs, id_col, text_col, shingle, max_bits), "components-of-rows")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")
    keeper = materialise(found.groupBy("root").agg(F.min(rank).alias("keeper"), F.count("*").alias("n")), "keepers")
    drop = join_on_hot_key(found, keeper, "root", "n").where(~rank.eqNullSafe(F.col("keeper")))
    gone_id, gone_text = fresh_names(docs.columns, "gone_id", "gone_text")
    drop = materialise(drop.select(F.col("doc_id").alias(gone_id), F.col("text_hash").alias(gone_text)).distinct(),
                       "dropped-rows")
    text_hash = F.xxhash64(F.col(text_col).cast("string"))
    kept = docs.join(drop, F.col(id_col).cast("long").eqNullSafe(F.col(gone_id))
                     & (text_hash == F.col(gone_text)), "left_anti")
    keys = found.select("doc_id", "text_hash")
    repeated = not keys.groupBy("doc_id", "text_hash").count().where("count > 1").isEmpty()
    return kept.dropDuplicates([id_col, text_col]) if repeated else kept
