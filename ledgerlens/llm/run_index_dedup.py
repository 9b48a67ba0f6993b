"""Exact removal of long repeats with run-length indexes.

Every byte covered by a string of ``length`` bytes that also starts anywhere
else in the corpus is removed.  A repeat is found inside a *bucket*: each
window of ``length`` bytes is keyed by the smallest hash among its k-grams,
so equal windows have equal keys wherever they stand.  Keys seen once cannot
belong to a repeat and are dropped before any text moves.  The segments of
the other keys (a segment is a stretch of windows with one key) are made
distinct by digest, one text of each is dealt to buckets of bounded size, and
each bucket builds a run-length index of its segments:

* the suffix order and the Burrows-Wheeler transform, kept as runs;
* for each run the text position at its head, that at the end of the run
  before it, and the length of their common prefix (the sampled run ends);
* the matching statistics of the segments against the bucket, streamed over
  the text: between two samples the match gets shorter by one with each
  step, and its other place moves on by one.

Matches of ``length`` or more mark both places.  Copies of a whole text or of
a whole segment are found by their hashes beforehand, so the index holds each
distinct segment once however often it occurs.  A key with very many distinct
segments would overflow a bucket; its windows are compared by 128-bit digests
in a plain aggregate instead, which splits without limit.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import join_on_hot_key, materialise, small_batches

LENGTH = 200
GRAM = 64
#: Text handled at once when keys are computed.
CHUNK = 1 << 19
BUCKET_BYTES = 3 << 18
#: More distinct segments of one key than this do not go to an index.
MAX_SEGMENTS = 4096
#: Windows of a segment; longer stretches are cut, so a count fits a byte.
MAX_WINDOWS = 255
#: Low bits of a text's length that travel with its hash.
SIZE_MASK = (1 << 23) - 1

_MULTIPLIERS = np.array([0x9E3779B97F4A7C15 + 2 * i * 0x632BE59BD9B4E019 & (1 << 64) - 1 | 1 for i in range(64)], np.uint64)


def rolling_hash(data: np.ndarray, size: int, seed: int = 0) -> np.ndarray:
    """A 64-bit hash of every ``size`` bytes of ``data``, by doubling."""
    if len(data) < size:
        return np.empty(0, np.uint64)
    part, have, out, done = data.astype(np.uint64) + np.uint64(1), 1, None, 0
    part *= _MULTIPLIERS[seed % 64]
    part ^= part >> np.uint64(29)
    while True:
        if size >> (have.bit_length() - 1) & 1:
            if out is None:
                out, done = part, have
            else:  # the piece so far, then this one
                n = len(data) - done - have + 1
                out = out[:n] * _MULTIPLIERS[(have.bit_length() + 7 * seed) % 64] + part[done:done + n]
                done += have
        if done == size:
            break
        n = len(part) - have
        part = part[:n] * _MULTIPLIERS[(have.bit_length() + 13 + 5 * seed) % 64] + part[have:have + n]
        part ^= part >> np.uint64(31)
        have *= 2
    out = out[:len(data) - size + 1]
    out = (out ^ (out >> np.uint64(32))) * _MULTIPLIERS[(seed + 29) % 64]
    return out ^ (out >> np.uint64(29))


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of every ``width`` consecutive values."""
    have = 1
    while have * 2 <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    rest = width - have
    return np.minimum(values[:-rest], values[rest:]) if rest else values


def segments_of(data: np.ndarray, ends: np.ndarray, length: int,
                gram: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys, first windows, numbers of windows and doubts of the segments of texts laid end to end in ``data``.

    ``ends``: where each text ends.  No window crosses an end.  A segment is
    in doubt if two of its own windows can be equal: its key then stands
    before the last window's start, so it is not one and the same k-gram that
    all windows share.
    """
    if len(data) < length:
        return (np.empty(0, np.uint64), *(np.empty(0, np.int64) for _ in range(2)), np.empty(0, bool))
    grams = rolling_hash(data, gram)
    keys = sliding_min(grams, length - gram + 1)
    starts = np.concatenate([[0], ends[:-1]])
    windows = np.maximum(0, ends - starts - length + 1)
    first = np.repeat(starts - np.concatenate([[0], np.cumsum(windows)[:-1]]), windows)
    at = np.arange(len(first)) + first  # starts of whole windows
    keys = keys[at]
    cut = np.concatenate([[True], (keys[1:] != keys[:-1]) | (at[1:] != at[:-1] + 1)]) if len(at) else np.empty(0, bool)
    head = np.flatnonzero(cut)
    n = np.diff(np.append(head, len(at)))
    doubt = np.zeros(len(head), bool)
    wide = np.flatnonzero(n > 1)
    if len(wide):
        bounds = np.stack([at[head[wide]], at[head[wide]] + n[wide] - 1], 1).ravel()
        doubt[wide] = np.minimum.reduceat(grams, bounds)[::2] == keys[head[wide]]
    pieces = -(-n // MAX_WINDOWS)
    if len(pieces) and pieces.max() > 1:
        inner = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        head, left = np.repeat(head, pieces) + inner * MAX_WINDOWS, np.repeat(n, pieces) - inner * MAX_WINDOWS
        n, doubt = np.minimum(left, MAX_WINDOWS), np.repeat(doubt, pieces)
    return keys[head], at[head], n, doubt


class RunIndex:
    """Run-length index of distinct byte strings, with the samples that matching statistics need."""

    def __init__(self, strings: list[bytes]):
        sizes = np.array([len(s) for s in strings], np.int64)
        self.starts = np.cumsum(sizes + 1) - sizes - 1
        self.ends = self.starts + sizes
        text = np.frombuffer(b"\0".join(strings) + b"\0", np.uint8).astype(np.uint16) + 1
        text[self.ends] = 0  # the separator is smaller than every byte
        self.text = text
        order = suffix_order(text)
        last = text[order - 1]  # the transform; the first suffix is preceded by the last symbol
        fresh = np.concatenate([[True], last[1:] != last[:-1]])
        heads = np.flatnonzero(fresh)
        self.symbols, self.run_starts = last[heads], heads
        # Nothing stands before the first suffix, so neither its row nor the one after it goes on from a step before.
        first = int(np.flatnonzero(order == 0)[0])
        fresh[first:first + 2] = True
        rows = np.flatnonzero(fresh)
        head, before = order[rows], order[rows - 1]
        common = common_prefix(text, head[1:], before[1:])
        by = np.argsort(head)
        self.sample_at, self.sample_other = head[by], before[by]
        self.sample_length = np.concatenate([[0], common])[by]

    def matching_statistics(self) -> tuple[np.ndarray, np.ndarray]:
        """For each position of the text: the longest match with the suffix before it in order, and its place."""
        x = np.arange(len(self.text))
        near = np.searchsorted(self.sample_at, x, "right") - 1
        step = x - self.sample_at[near]
        return self.sample_length[near] - step, self.sample_other[near] + step

    def repeated(self, length: int) -> np.ndarray:
        """Starts of the strings' windows of ``length`` bytes that stand at two places or more, ascending."""
        size, other = self.matching_statistics()
        ends = np.repeat(self.ends, np.diff(np.append(self.starts, len(self.text))))
        x = np.flatnonzero((size >= length) & (np.arange(len(size)) + length <= ends))
        mark = np.zeros(len(size), bool)
        mark[x] = mark[other[x]] = True
        return np.flatnonzero(mark)


def suffix_order(text: np.ndarray) -> np.ndarray:
    """The suffixes of ``text`` (symbols below 512) in order, by prefix doubling over those not yet told apart."""
    n, have = len(text), 7
    padded = np.concatenate([text, np.zeros(have, text.dtype)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(have):
        key = key << np.uint64(9) | padded[i:i + n]
    order = np.argsort(key)
    fresh = np.concatenate([[True], key[order[1:]] != key[order[:-1]]])
    rank = np.empty(n, np.int64)  # first row of the group of equal prefixes
    rank[order] = np.maximum.accumulate(np.where(fresh, np.arange(n), 0))
    while True:
        group = rank[order]
        alone = np.concatenate([group[1:] != group[:-1], [True]]) & (group == np.arange(n))
        rows = np.flatnonzero(~alone)
        if not len(rows):
            return order
        here = order[rows]
        then = here + have
        follow = np.where(then < n, rank[np.minimum(then, n - 1)] + 1, 0)
        group = group[rows]
        by = np.argsort(group * (n + 1) + follow)
        here, group, follow = here[by], group[by], follow[by]
        order[rows] = here
        fresh = np.concatenate([[True], (group[1:] != group[:-1]) | (follow[1:] != follow[:-1])])
        rank[here] = np.maximum.accumulate(np.where(fresh, rows, 0))
        have *= 2


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Lengths of the common prefixes of the suffixes at ``a`` and ``b``, seven symbols at a time."""
    n, step = len(text), 7
    padded = np.concatenate([text, np.zeros(step + 1, text.dtype)]).astype(np.uint64)
    packed = np.zeros(n + 1, np.uint64)
    for i in range(step):
        packed = packed << np.uint64(9) | padded[i:i + n + 1]
    out = np.zeros(len(a), np.int64)
    left = np.arange(len(a))
    while len(left):
        x, y = a[left] + out[left], b[left] + out[left]
        same = (x < n) & (y < n) & (packed[np.minimum(x, n)] == packed[np.minimum(y, n)])
        out[left[same]] += step
        left = left[same]
    for _ in range(step):
        x, y = a + out, b + out
        same = (x < n) & (y < n)
        same &= text[np.minimum(x, n - 1)] == text[np.minimum(y, n - 1)]
        stop = ~same
        out[same] += 1
        if stop.all():
            break
        a, b = np.where(stop, n, a), np.where(stop, n, b)
    return out


def spans_of(starts: np.ndarray, length: int) -> np.ndarray:
    """Flat [start, end, start, end, ...] of the runs covered by windows at ascending ``starts``."""
    if not len(starts):
        return np.empty(0, np.int64)
    gap = np.flatnonzero(starts[1:] > starts[:-1] + length)
    return np.stack([starts[np.append(0, gap + 1)], starts[np.append(gap, len(starts) - 1)] + length], 1).ravel()


def merged(spans: np.ndarray) -> np.ndarray:
    """Flat spans in any order as ascending maximal runs (touching ones join)."""
    pairs = spans.reshape(-1, 2)
    pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pairs[:, 1])
    fresh = np.flatnonzero(np.append(True, pairs[1:, 0] > reach[:-1]))
    return np.stack([pairs[fresh, 0], reach[np.append(fresh[1:] - 1, len(pairs) - 1)]], 1).ravel()


def _batches(keys: list[str], kinds: list[pa.DataType], rows: Iterator[tuple], size: int = 1 << 22) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of about ``size`` bytes of their binary values."""
    held, weight = [], 0
    for row in rows:
        held.append(row)
        weight += sum(len(v) for v in row if isinstance(v, bytes)) + 64
        if weight >= size:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=keys)
            held, weight = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=keys)


def _keyed(texts: DataFrame, length: int, gram: int) -> DataFrame:
    """``(key, tid, at)`` of every segment; ``at`` packs first window, windows and the text's length (23 bits).

    A segment in doubt comes twice, told apart by a bit, so its key counts as seen at two places.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            tids, held, pieces = batch.column(0).to_numpy(), 0, []
            for tid, text in zip(tids, batch.column(1)):
                data = np.frombuffer(text.as_buffer(), np.uint8)
                for base in range(0, max(1, len(data) - length + 1), CHUNK):
                    part = data[base:base + CHUNK + length - 1]
                    pieces.append((tid, base, len(data), part))
                    held += len(part)
                    if held >= CHUNK:
                        yield keys_of(pieces)
                        held, pieces = 0, []
            if pieces:
                yield keys_of(pieces)

    def keys_of(pieces: list) -> pa.RecordBatch:
        ends = np.cumsum([len(p[3]) for p in pieces])
        keys, first, n, doubt = segments_of(np.concatenate([p[3] for p in pieces]), ends, length, gram)
        owner = np.searchsorted(ends, first, "right")
        tids, bases, sizes = (np.array([p[k] for p in pieces], np.int64)[owner] for k in range(3))
        begins = np.concatenate([[0], ends[:-1]])[owner]
        at = (first - begins + bases) << 32 | n << 24 | sizes & SIZE_MASK
        keys, tids, at = (np.concatenate([x, y]) for x, y in (
            (keys, keys[doubt]), (tids, tids[doubt]), (at, at[doubt] | SIZE_MASK + 1)))
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(tids), pa.array(at)],
                                          names=["key", "tid", "at"])

    return texts.mapInArrow(scan, "key long, tid long, at long")


def _packed(rows: DataFrame) -> DataFrame:
    """``(doc_id, tid, size, sha, text)`` with each text as a Zstandard frame: about two thirds of what a shuffle
    makes of it, and only Python reads it further on."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = zstandard.ZstdCompressor(level=3).compress
        for batch in small_batches(batches):
            texts = pa.array((encode(t.as_py()) for t in batch.column(4)), pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], texts], names=batch.schema.names)

    return rows.select("doc_id", "tid", "size", "sha", "text").mapInArrow(
        pack, "doc_id long, tid long, size long, sha string, text binary")


def _segments(rows: DataFrame, length: int) -> DataFrame:
    """Segments wanted from ``(tid, packed text, wanted)`` rows, by digest: ``(key, digest, tid, size, start, n, doubt)``."""
    names = ["key", "digest", "tid", "size", "start", "n", "doubt"]

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        decode = zstandard.ZstdDecompressor().decompress
        for batch in small_batches(batches):
            for tid, text, wanted in zip(*(batch.column(k) for k in range(3))):
                data, name = decode(text.as_py()), tid.as_py()
                for w in wanted.as_py():
                    start, n, doubt = w["at"] >> 32, w["at"] >> 24 & 0xFF, w["at"] >> 23 & 1
                    digest = xxhash.xxh64_intdigest(data[start:start + n + length - 1])
                    yield w["key"], digest - (1 << 64) if digest >> 63 else digest, name, len(data), start, n, doubt

    return rows.mapInArrow(lambda batches: _batches(names, [pa.int64()] * 7, hashed(batches)),
                           ", ".join(f"{n} long" for n in names))


def _texts_of(rows: DataFrame, length: int) -> DataFrame:
    """``(key, digest, segment)`` of the segments that ``(packed text, chosen)`` rows name."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        decode = zstandard.ZstdDecompressor().decompress
        for batch in small_batches(batches):
            for text, chosen in zip(batch.column(0), batch.column(1)):
                data = decode(text.as_py())
                for c in chosen.as_py():
                    yield c["key"], c["digest"], data[c["start"]:c["start"] + c["n"] + length - 1]

    return rows.select("text", "chosen").mapInArrow(
        lambda batches: _batches(["key", "digest", "segment"], [pa.int64(), pa.int64(), pa.binary()], cut(batches)),
        "key long, digest long, segment binary")


def _indexed(distinct: DataFrame, buckets: int, length: int) -> DataFrame:
    """``(key, digest, spans)`` of segments with windows that stand elsewhere in their bucket."""

    def search(group: pd.DataFrame) -> pd.DataFrame:
        index = RunIndex(group["segment"].tolist())
        found = index.repeated(length)
        cuts = np.searchsorted(found, np.append(index.starts, len(index.text)))
        out = [(k, d, spans_of(found[cuts[i]:cuts[i + 1]] - index.starts[i], length))
               for i, (k, d) in enumerate(zip(group["key"], group["digest"])) if cuts[i + 1] > cuts[i]]
        return pd.DataFrame(out, columns=["key", "digest", "spans"])

    dealt = distinct.select("key", "digest", "segment", F.pmod(F.xxhash64("key"), F.lit(buckets)).alias("bucket"))
    return dealt.groupBy("bucket").applyInPandas(search, "key long, digest long, spans array<long>")


def _compared(distinct: DataFrame, length: int) -> DataFrame:
    """The same for segments of overflowing keys, by digests of their windows."""

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            for key, digest, segment in zip(*(batch.column(k) for k in range(3))):
                data = np.frombuffer(segment.as_buffer(), np.uint8)
                a, b = rolling_hash(data, length, 1), rolling_hash(data, length, 2)
                n = len(a)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array([key.as_py()] * n, pa.int64()),
                     pa.array([digest.as_py()] * n, pa.int64()), pa.array(np.arange(n))],
                    names=["a", "b", "key", "digest", "offset"])

    shape = "a long, b long, key long, digest long, offset long"
    each = materialise(distinct.select("key", "digest", "segment").mapInArrow(windows, shape), "windows")
    twice = each.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1").drop("n")
    hits = each.join(twice, ["a", "b"]).groupBy("key", "digest").agg(F.collect_list("offset").alias("offsets"))
    spans = F.flatten(F.transform("offsets", lambda o: F.array(o, o + length)))
    return hits.select("key", "digest", spans.alias("spans"))


def _cut_out(rows: DataFrame) -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` from ``(doc_id, packed text, spans)``."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decode = zstandard.ZstdDecompressor().decompress
        for batch in small_batches(batches):
            out = []
            for doc_id, text, spans in zip(*(batch.column(k) for k in range(3))):
                data, runs = decode(text.as_py()), np.array(spans.as_py() or [], np.int64)
                runs = merged(runs) if len(runs) else runs
                kept, at = hashlib.sha256(), 0
                for start, end in runs.reshape(-1, 2).tolist():
                    kept.update(data[at:start])
                    at = end
                kept.update(data[at:])
                removed = int((runs[1::2] - runs[::2]).sum())
                out.append((doc_id.as_py(), len(data), removed, len(runs) // 2, kept.hexdigest()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*out), [*[pa.int64()] * 4, pa.string()])] if out else
                [pa.array([], k) for k in [*[pa.int64()] * 4, pa.string()]],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    return rows.mapInArrow(scan, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def _occurrence(tid: Column, place: Column) -> Column:
    return F.xxhash64(tid, place)


def remove_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, bucket_bytes: int = BUCKET_BYTES,
                   max_segments: int = MAX_SEGMENTS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_bytes, n_removed, n_spans, kept_sha256)`` per row of ``docs``.

    Null text is empty; texts shorter than ``length`` stay whole; rows of
    equal text (repeated rows too) are copies of each other and lose all
    their bytes, if there are enough; null ids stay null; an empty table gives
    no rows.  Texts are told apart by a 64-bit hash and their length.
    """
    if not 0 < gram <= length:
        raise ValueError("a k-gram must fit a window")
    text = F.encode(F.coalesce(F.col(text_col).cast("string"), F.lit("")), "UTF-8")
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), text.alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("tid"), F.octet_length("text").cast("long").alias("size"), "text")
    long = rows.where(F.col("size") >= length)
    copies = long.groupBy("tid", "size").agg(F.count("*").alias("n")).where("n > 1").select(
        "tid", "size", F.lit(True).alias("copied"))

    keyed = materialise(_keyed(long.select("tid", "text"), length, gram), "keys")
    place = _occurrence(F.col("tid"), F.col("at"))
    several = materialise(keyed.groupBy("key").agg(
        F.min(place).alias("a"), F.max(place).alias("b"), F.count("*").alias("n")).where("a <> b").select("key", "n"), "several")
    wanted = join_on_hot_key(keyed, several, "key", "n").groupBy("tid", F.col("at").bitwiseAND(F.lit(SIZE_MASK)).alias("low")).agg(
        F.collect_set(F.struct("key", "at")).alias("wanted"))
    notes = wanted.join(copies.withColumn("low", F.col("size").bitwiseAND(F.lit(SIZE_MASK))).drop("size"),
                        ["tid", "low"], "full_outer")
    low = F.col("size").bitwiseAND(F.lit(SIZE_MASK))
    packed = _packed(rows.withColumn("sha", F.sha2("text", 256)))
    noted = packed.withColumn("low", low).join(notes, ["tid", "low"], "left")
    has = F.col("wanted").isNotNull()
    noted = materialise(noted.select(
        "doc_id", "tid", "size", "wanted", F.coalesce("copied", F.lit(False)).alias("copied"),
        F.when(has, F.col("text")).alias("text"),
        F.when(~has & F.col("copied").isNull(), F.col("sha")).alias("sha")), "noted")

    # Segments by digest: how many places, and one place to read each from.  A key with one segment only needs
    # no index, unless the segment can repeat itself: it is repeated as a whole or not at all.
    candidates = noted.where("wanted is not null").select("tid", "size", "text", "wanted")
    places = _segments(candidates.select("tid", "text", "wanted"), length)
    where = _occurrence(F.col("tid"), F.col("start"))
    distinct = materialise(places.groupBy("key", "digest").agg(
        F.min(F.struct("tid", "size", "start", "n")).alias("place"), (F.min(where) != F.max(where)).alias("again"),
        F.max("doubt").alias("doubt")), "segments")
    per_key = distinct.groupBy("key").agg(F.count("*").alias("held"), F.max("doubt").alias("doubt"))
    mixed = materialise(per_key.where("held > 1 or doubt = 1").select(
        "key", (F.col("held") > max_segments).alias("large")), "mixed-keys")
    chosen = distinct.drop("doubt").join(mixed, "key").select("key", "digest", "place.*", "large")
    size = chosen.agg(F.sum(F.col("n") + length - 1).alias("bytes"), F.max("large").alias("large")).first()
    buckets = max(1, -(-(size["bytes"] or 0) // bucket_bytes))

    def texts(picked: DataFrame) -> DataFrame:
        per_text = picked.groupBy("tid", "size").agg(F.collect_list(F.struct("key", "digest", "start", "n")).alias("chosen"))
        one = candidates.groupBy("tid", "size").agg(F.first("text").alias("text"))  # copies of a text count once
        return _texts_of(one.join(per_text, ["tid", "size"]), length)

    found = _indexed(texts(chosen.where("not large")), buckets, length)
    if size["large"]:
        found = found.unionByName(_compared(texts(chosen.where("large")), length))
    whole = distinct.where("again").select(
        "key", "digest", F.array(F.lit(0), F.col("place.n") + length - 1).cast("array<long>").alias("spans"))
    found = materialise(found.unionByName(whole), "found").groupBy("key", "digest").agg(
        F.flatten(F.collect_list("spans")).alias("spans"))

    places = places.select("key", "digest", "tid", "size", "start").distinct()
    shifted = F.transform("spans", lambda s: s + F.col("start"))
    spans = places.join(found, ["key", "digest"]).select("tid", "size", shifted.alias("spans")).groupBy("tid", "size").agg(
        F.flatten(F.collect_list("spans")).alias("spans"))
    alone = noted.where("wanted is not null and not copied").select("doc_id", "tid", "size", "text")
    cut = _cut_out(alone.join(spans, ["tid", "size"], "left").select("doc_id", "text", "spans"))
    none, nothing = F.lit(0).cast("long"), hashlib.sha256().hexdigest()
    copied = noted.where("copied").select(
        "doc_id", F.col("size").alias("n_bytes"), F.col("size").alias("n_removed"), F.lit(1).cast("long").alias("n_spans"),
        F.lit(nothing).alias("kept_sha256"))
    clean = noted.where("wanted is null and not copied").select(
        "doc_id", F.col("size").alias("n_bytes"), none.alias("n_removed"), none.alias("n_spans"),
        F.col("sha").alias("kept_sha256"))
    return cut.unionByName(copied).unionByName(clean)
