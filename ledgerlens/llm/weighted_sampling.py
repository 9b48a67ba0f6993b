"""Document fingerprints by consistent weighted sampling.

A document is its words, each weighted with its number of occurrences.  For
each of ``SAMPLES`` hash functions a word's gamma variables r and c and its
uniform b give ``t = floor(ln w / r + b)`` and ``ln a = ln c - r (t - b) - r``;
the word of smallest ``a``, with its ``t``, is the sample.  Two documents draw
the same sample with a probability equal to their generalised Jaccard
similarity, the sum of the smaller weights over the sum of the larger ones, so
the share of equal samples estimates it.

The variables are drawn from one table of ``DRAWS`` triples, which the driver
makes and broadcasts: tasks only look up, add, divide and round down, which
every machine does alike, so equal texts have equal fingerprints wherever they
are computed.  Words that draw the same triple are ordered by their hash.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, small_batches

#: Samples of a fingerprint (16 bits each), triples in the table, and the seed of both tables.
SAMPLES, DRAWS, SEED = 128, 1 << 16, 42
#: Bytes of text in one range of the document order, and the largest number of ranges.
RANGE_BYTES, MAX_RANGES = 8 << 20, 50_000
#: Words weighed at a time, and what a row counts beside its text.
_STEP, _ROW_BYTES = 2048, 64
_MIX = np.uint64(0xD6E8FEB86659FD93)


class Sampler:
    """The tables of gamma and uniform draws, and the fingerprints drawn from them."""

    def __init__(self, samples: int = SAMPLES, seed: int = SEED):
        rng = np.random.default_rng(seed)
        self.r = rng.standard_gamma(2.0, DRAWS).astype(np.float32)
        self.ln_c = np.log(rng.standard_gamma(2.0, DRAWS)).astype(np.float32)
        self.b = rng.random(DRAWS, np.float32)
        self.once = self._rank(np.zeros(DRAWS, np.float32), slice(None))
        self.ln = np.log(np.arange(1, 1025, dtype=np.float64)).astype(np.float32)
        self.times, self.plus = (rng.integers(0, 2**32, (samples, 1), np.uint32) | np.uint32(1) for _ in range(2))

    def _rank(self, t: np.ndarray, at) -> np.ndarray:
        return self.ln_c[at] - self.r[at] * (t - self.b[at]) - self.r[at]

    def _ln(self, weights: np.ndarray) -> np.ndarray:
        """ln of whole weights; above the table's end its sum with the power of two left out."""
        shift = np.maximum(0, np.frexp(weights.astype(np.float64))[1] - 10)
        return self.ln[(weights >> shift) - 1] + shift.astype(np.float32) * self.ln[1]

    def draw(self, terms: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The samples (16 bits each) of distinct term hashes with weights of 1 and more; no terms give zeros."""
        samples = len(self.times)
        if not len(terms):
            return np.zeros(samples, np.uint16)
        order = np.argsort(terms)
        terms, weights = terms[order], weights[order]
        best, term, count = np.full(samples, np.inf, np.float32), np.zeros(samples, np.uint64), np.zeros(samples, np.int64)
        every = np.arange(samples)
        for i in range(0, len(terms), _STEP):
            own, w = terms[i:i + _STEP], weights[i:i + _STEP]
            x = own.astype(np.uint32) * self.times  # one row per sample
            x ^= x >> np.uint32(15)
            x += (own >> np.uint64(32)).astype(np.uint32)
            x *= self.plus
            x = (x >> np.uint32(16)).astype(np.intp)
            rank = self.once.take(x, mode="clip")
            more = np.flatnonzero(w > 1)
            steps = np.zeros((samples, 0), np.float32)
            if len(more):
                at = x[:, more]
                steps = np.floor(self._ln(w[more]) / self.r.take(at) + self.b.take(at))
                rank[:, more] = self._rank(steps, at)
            low = rank.argmin(axis=1)
            place = np.full(len(own), -1)
            place[more] = np.arange(len(more))
            repeated = place[low] >= 0
            step = np.zeros(samples, np.int64)
            step[repeated] = steps[every[repeated], place[low[repeated]]]
            lowest = rank[every, low]
            better = lowest < best
            best = np.where(better, lowest, best)
            term, count = np.where(better, own[low], term), np.where(better, step, count)
        x = (term ^ (count.astype(np.uint64) * _MIX)) * (self.times[:, 0].astype(np.uint64) << np.uint64(32) | self.plus[:, 0])
        x ^= x >> np.uint64(29)
        return (x * _MIX >> np.uint64(48)).astype(np.uint16)

    def fingerprint(self, text: bytes) -> np.ndarray:
        """The samples of a UTF-8 text: words between ASCII white space, A-Z lower-cased."""
        words = Counter(text.lower().split())
        terms = np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))
        return self.draw(terms, np.fromiter(words.values(), np.int64, len(words)))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of equal samples: an estimate of generalised Jaccard similarity.  Two texts without words
    are alike (1); a text without words is unlike any other (0)."""
    if a.any() != b.any():
        return 0.0
    return float((a == b).mean())


def _hex(samples: np.ndarray) -> str:
    return samples.astype(">u2").tobytes().hex()


def _starts(keys: DataFrame, range_bytes: int) -> list[tuple]:
    """Ascending keys ``(id or 0, id is given, hash)`` at which ranges of about ``range_bytes`` start, the smallest key first."""
    total = keys.agg(F.sum("size")).first()[0] or 0
    limit = max(range_bytes, total // MAX_RANGES)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = 0
        for batch in batches:
            ends = held + np.cumsum(batch.column(2).to_numpy())
            held = int(ends[-1]) if len(ends) else held
            before = ends - batch.column(2).to_numpy()
            yield batch.filter(pa.array(ends // limit > before // limit)).select([0, 1])

    picked = keys.mapInArrow(scan, "id long, hash long").collect()
    smallest = keys.agg(F.min(F.struct("id", "hash")).alias("k")).first()["k"]
    return sorted({(k["id"] is not None, k["id"] or 0, k["hash"]) for k in [*picked, *([smallest] if smallest else [])]})


def in_order(docs: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """``id, hash, text`` dealt to ranges of the order by (id, hash), rows of a range together and in order.

    The first document of each range stands also, marked ``guest``, at the
    end of the range before (of the last range for the very first), so every
    document is followed by its next one.  Texts are shuffled once.
    """
    keys = materialise(docs.select("id", "hash", (F.octet_length("text") + _ROW_BYTES).cast("long").alias("size"))
                       .repartitionByRange("id", "hash").sortWithinPartitions("id", "hash"), "document-order")
    shared = docs.sparkSession.sparkContext.broadcast(_starts(keys, range_bytes))

    @F.pandas_udf("range int, before int")
    def place(given: pd.Series, ids: pd.Series, hashes: pd.Series) -> pd.DataFrame:
        starts = shared.value
        found, before = [], []
        for key in zip(given, ids, hashes):
            at = bisect_right(starts, key) - 1
            found.append(at)
            before.append((at - 1) % len(starts) if starts[at] == key else -1)
        return pd.DataFrame({"range": found, "before": before})

    placed = docs.withColumn("p", place(F.col("id").isNotNull(), F.coalesce("id", F.lit(0)), F.col("hash")))
    own = F.struct(F.col("p.range").alias("range"), F.lit(False).alias("guest"))
    ahead = F.struct(F.col("p.before").alias("range"), F.lit(True).alias("guest"))
    spread = placed.select("id", "hash", "text", F.explode(
        F.when(F.col("p.before") >= 0, F.array(own, ahead)).otherwise(F.array(own))).alias("p"))
    tasks = max(1, len(shared.value))
    return spread.select("p.range", "p.guest", "id", "hash", "text").repartition(tasks, "range").sortWithinPartitions(
        "range", "guest", "id", "hash")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", samples: int = SAMPLES,
                 seed: int = SEED, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """Per row ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next``.

    The edited text is the text with its last ``n_chars // 2`` code points
    replaced by the first as many (or all) of the next document's.  Documents
    follow each other by ascending id, null ids first, equal ids by a hash of
    the text, and after the last comes the first; rows equal in id and text
    are one document that is returned as often as it came, and a lone document
    is its own next.  Null text is empty.  Texts without words have the zero
    fingerprint.  An empty table gives no rows; other columns are ignored.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    shared = docs.sparkSession.sparkContext.broadcast(Sampler(samples, seed))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sampler, names = shared.value, [x.split()[0] for x in schema.split(", ")]
        held = None  # the last document: key, text, samples, copies

        def result(following: str, its: np.ndarray) -> list[tuple]:
            (_, doc_id, _), own, drawn, copies = held
            n = len(own)
            edited = (own[:n - n // 2] + following[:n // 2]).encode()
            new = sampler.fingerprint(edited)
            row = (doc_id, n, hashlib.sha256(edited).hexdigest(), _hex(drawn), _hex(new), likeness(drawn, new),
                   likeness(drawn, its))
            return [row] * copies

        for batch in small_batches(batches):
            out: list[tuple] = []
            for part, guest, doc_id, digest, value in zip(*batch.columns):
                key = (part.as_py(), doc_id.as_py(), digest.as_py())
                if held and held[0] == key and not guest.as_py():
                    held = (*held[:3], held[3] + 1)
                    continue
                if guest.as_py() and held is None:  # further copies of a guest
                    continue
                own = value.as_py()
                drawn = sampler.fingerprint(own.encode())
                if held:
                    out += result(own, drawn)
                held = None if guest.as_py() else (key, own, drawn, 1)
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2])],
                    names=names)

    schema = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")
    picked = docs.select(F.col(id_col).cast("long").alias("id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    return in_order(picked, range_bytes).mapInArrow(scan, schema)
