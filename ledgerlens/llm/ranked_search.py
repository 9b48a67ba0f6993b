"""Ranked lexical search by NRA over a document-partitioned inverted index.

``build_index`` cuts the corpus into shards of bounded size and stores, per
shard, the postings (document, occurrences) of every term.  The collection's
statistics are sums over the shards.  ``search`` ships the items, in blocks of
bounded size, to every shard.  There each term's postings are sorted by
impact, the integer a document earns for the term, and read from the top down
by NRA ("no random access"): every document met has a lower bound, what it was
seen to earn, and an upper bound, which adds the impact at each list's reading
position for lists in which it was not seen yet.  Reading goes on until no
other document can enter the best k or tie into them and the scores of the
best k are exact.  The shards' best k per item meet in one top-k by item.

Nothing of the corpus is gathered, and no posting is dropped: a frequent term
is a longer list in each shard.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import ascii_lower, materialise, small_batches
from .decontam import words_of

#: A term: the complement of these ASCII ranges, A-Z lower-cased.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
SHARD_BYTES = 8 << 20
#: First reading step of a list; it doubles from round to round.
STEP = 32
INDEX = ("shard long, doc_ids array<long>, doc_words array<long>, terms array<string>, counts array<int>, "
         "postings binary, n_docs long, n_words long")


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """The index, one row per shard of about ``shard_bytes`` of text; a document is never split.

    ``postings`` holds, term by term in the order of ``terms``, ``counts``
    pairs (document's place in ``doc_ids``, occurrences) as little-endian
    unsigned 32-bit numbers.  ``n_docs`` counts documents with a term,
    ``n_words`` all their terms.  Null text has no terms; null ids stay null
    and repeated rows are documents of their own.
    """

    def flush(shard: int, ids: list, sizes: list, parts: list, terms: dict[bytes, int]) -> pa.RecordBatch:
        codes = np.concatenate(parts).astype(np.int64)
        owner = np.repeat(np.arange(len(ids)), sizes)
        pairs, tf = np.unique(codes * len(ids) + owner, return_counts=True)
        present, counts = np.unique(pairs // len(ids), return_counts=True)
        names = list(terms)
        postings = np.stack([pairs % len(ids), tf], axis=1).astype("<u4")
        return pa.RecordBatch.from_arrays([
            pa.array([shard], pa.int64()), pa.array([ids], pa.list_(pa.int64())), pa.array([sizes], pa.list_(pa.int64())),
            pa.array([[names[c].decode() for c in present]], pa.list_(pa.string())),
            pa.array([counts], pa.list_(pa.int32())), pa.array([postings.tobytes()], pa.binary()),
            pa.array([sum(s > 0 for s in sizes)], pa.int64()), pa.array([sum(sizes)], pa.int64())],
            names=[x.split()[0] for x in INDEX.split(", ")])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId() << 32
        terms: dict[bytes, int] = {}
        ids, sizes, parts, held = [], [], [], 0
        for batch in small_batches(batches):
            texts = batch.column(1).cast(pa.binary())
            for doc_id, text in zip(batch.column(0), texts):
                data = text.as_py() or b""
                words = words_of(data)
                parts.append(np.fromiter((terms.setdefault(w, len(terms)) for w in words), np.int32, len(words)))
                ids.append(doc_id.as_py())
                sizes.append(len(words))
                held += len(data) + 1
                if held >= shard_bytes:
                    yield flush(shard, ids, sizes, parts, terms)
                    shard, terms = shard + 1, {}
                    ids, sizes, parts, held = [], [], [], 0
        if ids:
            yield flush(shard, ids, sizes, parts, terms)

    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(scan, INDEX)


def document_frequencies(index: DataFrame) -> DataFrame:
    """``(term, df)``: the number of documents that hold each term."""
    pairs = index.select(F.explode(F.arrays_zip("terms", "counts")).alias("p"))
    return pairs.groupBy(F.col("p.terms").alias("term")).agg(F.sum("p.counts").alias("df"))


def weight(n: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))


def nra(lists: list[tuple[np.ndarray, np.ndarray]], tie: np.ndarray, k: int, step: int = STEP) -> list[tuple[int, int]]:
    """The best ``k`` of ``(document, score)``, highest score first, then smallest ``tie``.

    ``lists``: per term the documents and what each earns, highest first, all
    above 0; ``tie`` is a distinct number per document.
    """
    seen = np.zeros((len(lists), len(tie)), bool)
    lower = np.zeros(len(tie), np.int64)
    at = [0] * len(lists)
    wanted = range(len(lists))
    while True:
        for t in wanted:
            docs, gains = (x[at[t]:at[t] + step] for x in lists[t])
            lower[docs] += gains
            seen[t, docs] = True
            at[t] += len(docs)
        bounds = np.array([gains[a] if a < len(gains) else 0 for (_, gains), a in zip(lists, at)], np.int64)
        open_ = int(bounds.sum())
        met = np.flatnonzero(lower)
        upper = lower[met] + open_ - bounds @ seen[:, met]
        order = np.lexsort((tie[met], -lower[met]))
        top, rest = order[:k], order[k:]
        worst = int(lower[met[top[-1]]]) if len(top) == k else 0
        settled = open_ == 0 or len(top) == k and open_ < worst and not (
            (upper[rest] > worst) | ((upper[rest] == worst) & (tie[met[rest]] < tie[met[top[-1]]]))).any()
        if settled:  # membership and ties; now only lists that may still add to the best k
            unsure = [t for t in range(len(lists)) if bounds[t] and not seen[t, met[top]].all()]
            if not unsure:
                return [(int(met[i]), int(lower[met[i]])) for i in top]
            wanted = unsure
        else:
            wanted = range(len(lists))
        step *= 2


def _search_block(index: DataFrame, items: list, frequency: dict[str, int], n_docs: int, n_words: int, k: int) -> DataFrame:
    """The best ``k`` of every shard for one block of items."""
    weights = {t: weight(n_docs, df) for t, df in frequency.items()}
    code = {t: i for i, t in enumerate(t for t, w in weights.items() if w > 0)}
    known = {t.encode(): (c, weights[t]) for t, c in code.items()}
    asked = []
    for row in items:
        found = Counter(code[w] for w in row["words"] if w in code)
        asked.append((row["key"], row["item_id"], np.array(list(found), np.int32), np.array(list(found.values()), np.int64)))
    shared = index.sparkSession.sparkContext.broadcast((known, asked))

    def one(doc_ids, doc_words, terms, counts, postings) -> pa.RecordBatch:
        known, asked = shared.value
        ids = doc_ids.as_py()
        m = 25 + 75 * np.array(doc_words.as_py(), np.int64) * n_docs // n_words
        tie = np.empty(len(ids), np.int64)
        tie[sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i]))] = np.arange(len(ids))
        pairs = np.frombuffer(postings.as_py(), "<u4").reshape(-1, 2)
        lists: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        ends = np.cumsum(np.array(counts.as_py(), np.int64))
        for term, n, end in zip(terms.as_py(), counts.as_py(), ends):
            if hit := known.get(term.encode()):
                docs, tf = pairs[end - n:end].astype(np.int64).T
                impact = hit[1] * (1_000_000_000 * tf // (1000 * tf + 8 * m[docs]))
                order = np.argsort(-impact, kind="stable")
                order = order[impact[order] > 0]
                lists[hit[0]] = docs[order], impact[order]
        out: list[tuple] = []
        for key, item_id, codes, times in asked:
            mine = [(lists[c][0], lists[c][1] * x) for c, x in zip(codes.tolist(), times) if c in lists]
            out += ((key, item_id, ids[d], score) for d, score in (nra(mine, tie, k) if mine else ()))
        columns = list(zip(*out)) or [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["key", "item_id", "doc_id", "score"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                yield one(*(batch.column(c)[row] for c in range(5)))

    return index.select("doc_ids", "doc_words", "terms", "counts", "postings").mapInArrow(
        scan, "key long, item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, k: int = 10, block_words: int = 2_000_000, id_col: str = "doc_id",
           text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
           shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of every row of ``items``, score above 0.

    Equal scores rank by ascending id, null ids last.  Every row of ``docs``
    is a document of its own and every row of ``items`` a query of its own,
    repeated rows included; null text has no terms.  Items without a known
    term, and all items of an empty corpus, give no rows.  Other columns of
    both tables are ignored, whatever their names.
    """
    words = F.regexp_extract_all(ascii_lower(F.col(item_text_col).cast("string")), F.lit(TERM), F.lit(0))
    asked = materialise(items.select(
        F.monotonically_increasing_id().alias("key"), F.col(item_col).cast("long").alias("item_id"), words.alias("words")
    ).where(F.size("words") > 0), "items")
    index = materialise(build_index(docs, id_col, text_col, shard_bytes), "postings", large_rows=True)
    n_docs, n_words = index.agg(F.sum("n_docs"), F.sum("n_words")).first()
    total = asked.agg(F.sum(F.size("words"))).first()[0]
    blocks = math.ceil((total or 0) / block_words) if n_words else 0
    asked = asked.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(max(1, blocks))))
    terms = asked.select("block", F.explode("words").alias("term")).distinct()
    frequency = materialise(terms.join(document_frequencies(index), "term"), "frequencies")
    found = [asked.select("key", "item_id", F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).limit(0)]
    for block in range(blocks):
        rows = asked.where(F.col("block") == block).collect()
        df = {r["term"]: r["df"] for r in frequency.where(F.col("block") == block).collect()}
        found.append(_search_block(index, rows, df, n_docs, n_words, k))
    best = W.partitionBy("key").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(best)).where(
        F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
