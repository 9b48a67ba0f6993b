"""Benchmark decontamination with a document-partitioned positional inverted index.

``build_index`` cuts the corpus into shards of bounded size and stores, per
shard, the postings of every wanted term: the word positions of the shard's
documents laid end to end, with a gap that no phrase can bridge.  ``search``
sends the test phrases to every shard and intersects offset-adjusted posting
lists from the rarest term (by its count in the whole corpus) onwards, which
leaves the exact starts of each phrase, or with ``slop`` the starts at which
every word stands within ``slop`` words of its place.

The index grows with the corpus and is never gathered.  The test phrases are
the stated query set: they are shipped to the tasks in blocks of at most
``block_words`` words, so what is broadcast has a fixed bound.  If one block
holds them all, only postings of its terms are stored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, fresh_names, materialise, small_batches

#: Not a word: ASCII but digits and letters.  The complement of [^\x00-\x2F\x3A-\x60\x7B-\x7F] after A-Z became a-z.
_WORD_BYTES = bytes(c if c >= 0x80 or chr(c).isalnum() else 0x20 for c in range(256))
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

SHARD_BYTES = 8 << 20
#: Free positions between two documents of a shard.
GAP = 64
INDEX = ("shard long, gap int, doc_ids array<long>, text_hashes array<long>, doc_words array<int>, terms array<string>, "
         "counts array<int>, postings binary")


def words_of(data: bytes) -> list[bytes]:
    """Words of UTF-8 text: lower-cased ASCII letters, digits and all bytes above ASCII."""
    return data.lower().translate(_WORD_BYTES).split()


def build_index(docs: DataFrame, wanted: list[str] | None = None, gap: int = 64, id_col: str = "doc_id",
                text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The index, one row per shard.

    ``wanted``: the only terms whose postings are stored (None: all); a search
    for other terms finds nothing.  ``gap``: positions left free between two
    documents; phrases and slop must be shorter.  ``postings`` holds, term by
    term in the order of ``terms``, ``counts`` positions as little-endian
    unsigned 32-bit numbers in ascending order.  A shard is closed after
    ``shard_bytes`` of text; a document is never split.  Null text has no
    words, null ids stay null, repeated rows are documents of their own.
    """
    fixed = None if wanted is None else {w.encode(): i for i, w in enumerate(sorted(set(wanted)))}

    def flush(shard: int, ids: list, hashes: list, sizes: list, parts: list, terms: dict[bytes, int]) -> pa.RecordBatch:
        starts = np.concatenate([[0], np.cumsum(np.array(sizes, np.int64) + gap)[:-1]])
        codes = np.concatenate([c for c, _ in parts]) if parts else np.empty(0, np.int32)
        places = np.concatenate([p + s for (_, p), s in zip(parts, starts)]) if parts else np.empty(0, np.int64)
        order = np.argsort(codes, kind="stable")
        present, counts = np.unique(codes, return_counts=True)
        names = [None] * len(terms)
        for word, code in terms.items():
            names[code] = word
        return pa.RecordBatch.from_arrays([
            pa.array([shard], pa.int64()), pa.array([gap], pa.int32()), pa.array([ids], pa.list_(pa.int64())),
            pa.array([hashes], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int32())),
            pa.array([[names[c].decode() for c in present]], pa.list_(pa.string())),
            pa.array([counts.astype(np.int32)], pa.list_(pa.int32())),
            pa.array([places[order].astype("<u4").tobytes()], pa.binary())],
            names=["shard", "gap", "doc_ids", "text_hashes", "doc_words", "terms", "counts", "postings"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId() << 32
        terms = dict(fixed or {})
        ids, hashes, sizes, parts, held = [], [], [], [], 0
        for batch in small_batches(batches):
            texts = batch.column(1).cast(pa.binary())
            for doc_id, text, digest in zip(batch.column(0), texts, batch.column(2)):
                data = text.as_py() or b""
                words = words_of(data)
                if fixed is None:
                    found = np.fromiter((terms.setdefault(w, len(terms)) for w in words), np.int32, len(words))
                else:
                    get = terms.get
                    found = np.fromiter((get(w, -1) for w in words), np.int32, len(words))
                places = np.flatnonzero(found >= 0)
                ids.append(doc_id.as_py())
                hashes.append(digest.as_py())
                sizes.append(len(words))
                parts.append((found[places], places))
                held += len(data) + 1
                if held >= shard_bytes:
                    yield flush(shard, ids, hashes, sizes, parts, terms)
                    shard, terms = shard + 1, dict(fixed or {})
                    ids, hashes, sizes, parts, held = [], [], [], [], 0
        if ids:
            yield flush(shard, ids, hashes, sizes, parts, terms)

    text = F.col(text_col).cast("string")
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"), F.xxhash64(text).alias("text_hash"))
    return picked.mapInArrow(scan, INDEX)


def term_counts(index: DataFrame) -> DataFrame:
    """``(term, n)``: how often each stored term occurs in the whole corpus."""
    pairs = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("p"))
    return pairs.groupBy(F.col("p.terms").alias("term")).agg(F.sum("p.counts").alias("n"))


def phrases_of(items: DataFrame, size: int = 13, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """``(phrase, items)``: distinct windows of ``size`` words with the ids of the items that hold them.

    An item with fewer words, but some, is one window; items without words
    have none.  The windows of items whose id is null count as hits, but there
    is no id to report.
    """
    words = F.regexp_extract_all(ascii_lower(F.col(text_col).cast("string")), F.lit(WORD), F.lit(0))
    cut = items.select(F.col(id_col).cast("long").alias("item"), words.alias("w"))
    last = F.greatest(F.lit(1), F.size("w") - size + 1)
    windows = cut.where(F.size("w") > 0).select(
        "item", F.explode(F.transform(F.sequence(F.lit(1), last), lambda i: F.slice("w", i, size))).alias("phrase"))
    return windows.groupBy("phrase").agg(F.collect_set("item").alias("items"))


def match(lists: list[np.ndarray], offsets: list[int], slop: int = 0) -> np.ndarray:
    """Starts at which every term stands at its offset, or within ``slop`` of it.

    ``lists``: ascending positions per term, rarest term first.
    """
    starts = lists[0].astype(np.int64) - offsets[0]
    if slop:
        starts = np.unique((starts[:, None] + np.arange(-slop, slop + 1)).ravel())
    starts = starts[starts >= -slop]
    for places, offset in zip(lists[1:], offsets[1:]):
        if not len(starts):
            break
        at = np.searchsorted(places, starts + offset - slop)
        near = at < len(places)
        near[near] = places[at[near]] <= starts[near] + offset + slop
        starts = starts[near]
    return starts


def search(index: DataFrame, phrases: list[tuple[list[str], list[int]]], order: dict[str, int],
           slop: int = 0) -> DataFrame:
    """Per document of the index: its words, hit words, items found exactly, and items found within ``slop``.

    ``phrases``: (words, item ids); ``order``: corpus count of each term.  A
    phrase with a term that a shard lacks is skipped there before any list is
    read.  Returns ``(shard, ordinal, doc_id, text_hash, n_words, hits, items, near_items)``;
    ``hits`` are the ascending ordinals of hit words within the document.  A
    phrase and its slop must be shorter than the gap of the index.
    """
    plan = [([w.encode() for w, _ in ranked], [o for _, o in ranked], len(words), items) for words, items in phrases
            for ranked in [sorted(((w, o) for o, w in enumerate(words)), key=lambda x: (order.get(x[0], 0), x[1]))]]
    longest = max((len(words) for words, _ in phrases), default=0)
    shared = index.sparkSession.sparkContext.broadcast(plan)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield one(*(batch.column(k)[row] for k in range(8)))

    def one(shard, gap, doc_ids, text_hashes, doc_words, terms, counts, postings) -> pa.RecordBatch:
        if longest + slop >= gap.as_py():
            raise ValueError(f"phrases and slop together must stay below the index's gap of {gap} words")
        ids, sizes = doc_ids.as_py(), np.array(doc_words.as_py(), np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes + gap.as_py())]).astype(np.int64)
        places = np.frombuffer(postings.as_py(), "<u4").astype(np.int64)
        ends = np.cumsum(np.array(counts.as_py(), np.int64))
        lists = {t.encode(): places[e - n:e] for t, n, e in zip(terms.as_py(), counts.as_py(), ends)}
        covered = np.zeros(starts[-1] + 1, np.int32)
        exact: dict[int, set] = {}
        near: dict[int, set] = {}
        for words, offsets, size, items in shared.value:
            if any(w not in lists for w in words):
                continue
            mine = [lists[w] for w in words]
            found = match(mine, offsets)
            np.add.at(covered, found, 1)
            np.add.at(covered, found + size, -1)
            for d in np.unique(np.searchsorted(starts, found, "right") - 1):
                exact.setdefault(int(d), set()).update(items)
            if slop:
                close = match(mine, offsets, slop)
                for d in np.unique(np.searchsorted(starts, close + slop, "right") - 1):
                    near.setdefault(int(d), set()).update(items)
        hit = np.flatnonzero(np.cumsum(covered) > 0)
        owner = np.searchsorted(starts, hit, "right") - 1
        cuts = np.searchsorted(owner, np.arange(len(ids) + 1))
        n = len(ids)
        return pa.RecordBatch.from_arrays([
            pa.array([shard.as_py()] * n, pa.int64()), pa.array(range(n), pa.int32()), pa.array(ids, pa.int64()),
            text_hashes.values, pa.array(sizes, pa.int64()),
            pa.array([hit[cuts[d]:cuts[d + 1]] - starts[d] for d in range(n)], pa.list_(pa.int64())),
            pa.array([sorted(exact.get(d, ())) for d in range(n)], pa.list_(pa.int64())),
            pa.array([sorted(near.get(d, ())) for d in range(n)], pa.list_(pa.int64()))],
            names=["shard", "ordinal", "doc_id", "text_hash", "n_words", "hits", "items", "near_items"])

    return index.mapInArrow(scan, "shard long, ordinal int, doc_id long, text_hash long, n_words long, hits array<long>, "
                                  "items array<long>, near_items array<long>")


def _blocks(phrases: DataFrame, block_words: int) -> Iterator[list[tuple[list[str], list[int]]]]:
    """The test phrases in driver-side blocks of at most ``block_words`` words."""
    block, held = [], 0
    for row in phrases.toLocalIterator():
        block.append((row["phrase"], row["items"]))
        held += len(row["phrase"]) + len(row["items"])
        if held >= block_words:
            yield block
            block, held = [], 0
    if block:
        yield block


def contamination(docs: DataFrame, benchmark: DataFrame, size: int = 13, share: int = 20, slop: int = 2,
                  block_words: int = 2_000_000, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: ``doc_id, text_hash, n_words, n_hit, item_ids, near_item_ids, contaminated``.

    A document word inside any occurrence of a benchmark window is hit; a
    document is contaminated if ``n_hit > 0`` and ``share * n_hit >= n_words``.
    ``near_item_ids`` are items of which a window stands with every word
    within ``slop`` of its place (the exact ones included); they inform and
    do not contaminate.  Every row of ``docs`` gives one row; null text has no
    words.  Extra columns of either table are ignored; an empty benchmark
    finds nothing.
    """
    if not size + slop < GAP:
        raise ValueError(f"windows and slop together must stay below {GAP} words")
    phrases = materialise(phrases_of(benchmark, size), "phrases")
    blocks = _blocks(phrases, block_words)
    first, second = next(blocks, []), next(blocks, None)
    wanted = sorted({w for words, _ in first for w in words}) if second is None else None
    index = materialise(build_index(docs, wanted, GAP, id_col, text_col), "index")
    asked = phrases.select(F.explode("phrase").alias("term")).distinct()
    order = materialise(term_counts(index).join(asked, "term"), "term-counts")
    results = []
    for block in chain([first], [] if second is None else [second], blocks):
        used = {w for words, _ in block for w in words}
        counts = {r["term"]: r["n"] for r in order.toLocalIterator() if r["term"] in used}
        results.append(search(index, block, counts, slop))
    found = results[0]
    if len(results) > 1:
        found = materialise(_union(results), "matches").groupBy("shard", "ordinal").agg(
            F.first("doc_id").alias("doc_id"), F.first("text_hash").alias("text_hash"), F.first("n_words").alias("n_words"),
            *(F.array_distinct(F.flatten(F.collect_list(c))).alias(c) for c in ("hits", "items", "near_items")))
    n_hit = F.size("hits").cast("long")
    return found.select(
        "doc_id", "text_hash", "n_words", n_hit.alias("n_hit"), F.col("items").alias("item_ids"),
        F.col("near_items").alias("near_item_ids"),
        ((n_hit > 0) & (share * n_hit >= F.col("n_words"))).alias("contaminated"))


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def items_digest(items) -> "F.Column":
    """SHA-256 (lower-case hex) of item ids sorted as strings and joined by commas."""
    names = F.array_sort(F.transform(items, lambda x: x.cast("string")))
    return F.sha2(F.concat_ws(",", names), 256)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      **how) -> DataFrame:
    """``docs`` without contaminated rows; columns are those of ``docs``, whatever their names, and rows
    without words stay.

    Rows are told apart by their id and a hash of their text, so repeated and
    null ids are judged row by row; rows equal in both go or stay together.
    Null text has no words; an empty table stays empty.  What goes is written
    first, so Spark broadcasts it only if its files are small.
    """
    found = contamination(docs, benchmark, id_col=id_col, text_col=text_col, **how)
    gone_id, gone_text = fresh_names(docs.columns, "gone_id", "gone_text")
    drop = materialise(found.where("contaminated").select(
        F.col("doc_id").alias(gone_id), F.col("text_hash").alias(gone_text)).distinct(), "contaminated")
    same = F.col(id_col).cast("long").eqNullSafe(F.col(gone_id)) & (
        F.xxhash64(F.col(text_col).cast("string")) == F.col(gone_text))
    return docs.join(drop, same, "left_anti")
