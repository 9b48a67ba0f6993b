"""Toxicity classifier with counterfactual regularisation.

A logistic regression over the distinct words of a whole text and their first
four to six letters.  In labelled texts that name a group of people, the
identity terms are swapped for others of the same kind, and the squared
change of the score is added to the loss, so a mention of a group cannot
carry a score and neutral mentions are not flagged.

Every step runs in Spark: features and their counts, each pass of the
optimiser (tasks send sums of fixed length), and the scores.
"""

from __future__ import annotations

import math
import warnings
import zlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import fresh_names, materialise, small_batches
from .decontam import words_of

BUCKETS = 1 << 18
PREFIXES = (4, 5, 6)
#: Bound of the sample of labelled rows that the classifier is fitted on.
MAX_ROWS = 50_000
#: Bound of the features, those whose rates differ most clearly; the optimiser holds a number for each.
MAX_FEATURES = 20_000
#: A feature is used if its rates in the two classes differ by so many standard errors, in so many rows.
MIN_Z, MIN_ROWS = 4.0, 3
CACHE_WORDS = 200_000

#: Terms that name groups of people, by kind; terms of one kind are swapped for one another.
IDENTITY_TERMS = (
    "women men females males girls boys mothers fathers", "woman man girl boy mother father", "female male transgender nonbinary",
    "christian muslim jewish hindu buddhist sikh catholic protestant atheist mormon",
    "christians muslims jews hindus buddhists sikhs catholics protestants atheists mormons",
    "black white asian african latino hispanic european arab indigenous",
    "blacks whites asians africans latinos hispanics europeans arabs",
    "gay straight lesbian bisexual heterosexual homosexual queer",
    "gays lesbians bisexuals heterosexuals homosexuals",
    "american mexican chinese indian german french spanish russian turkish polish nigerian japanese",
    "americans mexicans indians germans russians turks poles nigerians japanese",
    "immigrants refugees migrants foreigners citizens natives", "deaf blind disabled autistic elderly young",
    "frauen männer mädchen jungen", "christen muslime juden buddhisten atheisten",
    "deutsche türken polen russen franzosen", "femmes hommes filles garçons",
    "chrétiens musulmans juifs bouddhistes athées", "français allemands espagnols arabes africains",
    "mujeres hombres niñas niños", "cristianos musulmanes judíos budistas ateos",
    "españoles mexicanos alemanes franceses africanos")


class Model(NamedTuple):
    """Weights by feature bucket, and the score of a text without any of them."""

    weights: dict[int, float]
    bias: float


def features(word: bytes) -> list[int]:
    """Buckets of a word: itself, and its beginnings."""
    text = word.decode("utf-8", "ignore")
    own = [zlib.crc32(b"w" + word) % BUCKETS]
    return own + [zlib.crc32(b"p%d" % k + text[:k].encode()) % BUCKETS for k in PREFIXES if len(text) > k]


def swap_table() -> dict[bytes, list[bytes]]:
    """For each identity term the others of its kind, the next one first."""
    out = {}
    for kind in IDENTITY_TERMS:
        terms = [t.encode() for t in kind.split()]
        for i, term in enumerate(terms):
            out.setdefault(term, terms[i + 1:] + terms[:i])
    return out


def swapped(words: set[bytes], table: dict[bytes, list[bytes]], variant: int) -> tuple[list[int], list[int]]:
    """Buckets lost and gained when every identity term gives way to the ``variant``-th other of its kind."""
    lost, gained = [], []
    for term in sorted(words & table.keys()):
        others = table[term]
        lost += features(term)
        gained += features(others[variant % len(others)])
    return lost, gained


def held_out(id_col: str, folds: int = 5) -> Column:
    """Rows never learnt from: crc32 of the id as text is divisible by ``folds``; null ids are not held out."""
    return F.coalesce(F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % folds == 0, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame, max_rows: int = MAX_ROWS, id_col: str = "doc_id",
                  text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """``(toxic, text)`` of at most ``max_rows`` labelled rows that are not held out, taken by hash of the id.

    Null labels and ids are left out; an id labelled more than once is toxic
    if any of its labels says so.  The sampled labels are broadcast: their
    number is bounded by ``max_rows``.
    """
    known = (labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & ~held_out(id_col))
             .groupBy(F.col(id_col).cast("long").alias("_id")).agg(F.max(F.col(label_col).cast("int")).alias("_toxic")))
    known = materialise(known, "known-labels")
    # the smallest hashes lie below this share of all hashes (ten standard deviations of room), so few more than
    # max_rows rows meet in the task that ranks them
    share = (1.2 * max_rows + 10 * math.sqrt(max_rows) + 50) / max(1, known.count())
    if share < 1:
        known = known.where(F.xxhash64("_id") < F.lit(int(-(1 << 63) + share * (1 << 64))))
    sample = materialise(known.orderBy(F.xxhash64("_id"), "_id").limit(max_rows), "labels")
    joined = docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text_col).cast("string").alias("_text")).join(
        F.broadcast(sample), "_id")
    return joined.select(F.col("_toxic").alias("toxic"), F.col("_text").alias("text"))


def _examples(rows: DataFrame, swaps: int) -> DataFrame:
    """``(toxic, has, lost, gained)``: buckets of each text, and of each of its swapped versions."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, known = swap_table(), {}
        for batch in small_batches(batches):
            has, lost, gained = [], [], []
            for text in batch.column(1):
                words = set(words_of((text.as_py() or "").encode()))
                if len(known) > CACHE_WORDS:
                    known.clear()
                for w in words:
                    if w not in known:
                        known[w] = features(w)
                has.append([b for w in words for b in known[w]])
                pairs = [swapped(words, table, v) for v in range(swaps)] if words & table.keys() else []
                lost.append([p[0] for p in pairs])
                gained.append([p[1] for p in pairs])
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(has, ints), pa.array(lost, pa.list_(ints)), pa.array(gained, pa.list_(ints))],
                names=["toxic", "has", "lost", "gained"])

    return rows.mapInArrow(scan, "toxic int, has array<int>, lost array<array<int>>, gained array<array<int>>")


def _telling(examples: DataFrame, max_features: int) -> tuple[list[int], int, int]:
    """Buckets whose rates in the two classes differ clearly, and the numbers of toxic and other rows."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS + 1), np.int64)  # the last counts rows
        for batch in small_batches(batches):
            for toxic, has in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts[int(toxic > 0), np.append(np.unique(np.asarray(has.as_py(), np.int64)), BUCKETS)] += 1
        found = np.flatnonzero(counts.sum(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(found), pa.array(counts[0, found]), pa.array(counts[1, found])], names=["bucket", "no", "yes"])

    counts = examples.select("toxic", "has").mapInArrow(scan, "bucket long, no long, yes long")
    counts = counts.groupBy("bucket").agg(F.sum("no").alias("no"), F.sum("yes").alias("yes"))
    total = counts.where(F.col("bucket") == BUCKETS).collect()
    n0, n1 = (total[0]["no"], total[0]["yes"]) if total else (0, 0)
    if not n0 or not n1:
        return [], n1, n0
    rate = (F.col("no") + F.col("yes")) / F.lit(n0 + n1)
    z = F.abs(F.col("yes") / F.lit(n1) - F.col("no") / F.lit(n0)) / F.sqrt(
        rate * (1 - rate) * F.lit(1 / n0 + 1 / n1) + F.lit(1e-12))
    chosen = (counts.where((F.col("bucket") < BUCKETS) & (F.col("no") + F.col("yes") >= MIN_ROWS) & (z >= MIN_Z))
              .orderBy(z.desc(), "bucket").limit(max_features))
    return [r["bucket"] for r in chosen.select("bucket").collect()], n1, n0


def _compact(examples: DataFrame, chosen: list[int]) -> DataFrame:
    """Examples over the chosen buckets, numbered by their place: ``(toxic, has, at, by, n)``.

    ``at`` and ``by`` are the places and changes of all swapped versions one
    after another, ``n`` their lengths.
    """
    place = {b: i for i, b in enumerate(chosen)}

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small_batches(batches):
            has, at, by, n = [], [], [], []
            for own, lost, gained in zip(*(batch.column(k).to_pylist() for k in (1, 2, 3))):
                has.append([place[b] for b in own if b in place])
                moves = [[(place[b], s) for part, s in ((l, -1), (g, 1)) for b in part if b in place]
                         for l, g in zip(lost, gained)]
                at.append([a for m in moves for a, _ in m])
                by.append([s for m in moves for _, s in m])
                n.append([len(m) for m in moves])
            ints = pa.list_(pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(x, ints) for x in (has, at, by, n))], names=["toxic", "has", "at", "by", "n"])

    return examples.mapInArrow(scan, "toxic int, has array<int>, at array<int>, by array<int>, n array<int>")


def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values of a list column, and the row of each."""
    lengths = np.diff(column.offsets.to_numpy())
    return column.flatten().to_numpy(zero_copy_only=False), np.repeat(np.arange(len(column)), lengths)


def loss_and_slope(batch: pa.RecordBatch, w: np.ndarray, swap_weight: float) -> np.ndarray:
    """(loss, slope...) over a batch of compact examples; the last weight is the bias.

    Logistic loss, plus ``swap_weight / 2`` times the squared change of the
    score for each swapped version.
    """
    y = batch.column(0).to_numpy(zero_copy_only=False).astype(float)
    at, row = _flat(batch.column(1))
    s = np.bincount(row, w[at], minlength=len(y)) + w[-1]
    miss = 1 / (1 + np.exp(-np.clip(s, -500, 500))) - y
    slope = np.bincount(at, miss[row], minlength=len(w)).astype(float)
    slope[-1] += miss.sum()
    loss = float((np.logaddexp(0, s) - y * s).sum())
    moved, _ = _flat(batch.column(2))
    by, _ = _flat(batch.column(3))
    lengths, _ = _flat(batch.column(4))
    if len(lengths):
        version = np.repeat(np.arange(len(lengths)), lengths)
        change = np.bincount(version, w[moved] * by, minlength=len(lengths))
        loss += swap_weight / 2 * float((change ** 2).sum())
        slope += swap_weight * np.bincount(moved, change[version] * by, minlength=len(w))
    return np.concatenate([[loss], slope])


def _minimise(total, w: np.ndarray, rounds: int = 60, memory: int = 10) -> np.ndarray:
    """L-BFGS with halving steps; ``total(w)`` gives (loss, slope...)."""
    at = total(w)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        slope = at[1:]
        q, kept = slope.copy(), []
        for s, y in reversed(steps):
            kept.append((s @ q) / (y @ s))
            q -= kept[-1] * y
        q *= (steps[-1][0] @ steps[-1][1]) / (steps[-1][1] @ steps[-1][1]) if steps else 1 / max(1e-12, np.abs(slope).sum())
        for (s, y), a in zip(steps, reversed(kept)):
            q += (a - (y @ q) / (y @ s)) * s
        size, fall = 1.0, float(slope @ q)
        while True:
            after = total(w - size * q)
            if after[0] <= at[0] - 1e-4 * size * fall or size < 1e-6:
                break
            size /= 2
        if after[0] >= at[0]:
            return w
        step, bend = -size * q, after[1:] - slope
        if step @ bend > 1e-12:
            steps = [*steps, (step, bend)][-memory:]
        done = at[0] - after[0] < 1e-5 * abs(at[0])
        w, at = w + step, after
        if done:
            return w
    warnings.warn(f"the fit did not settle in {rounds} rounds", stacklevel=2)
    return w


def fit(rows: DataFrame, swaps: int = 3, swap_weight: float = 10.0, l2: float = 0.5, max_rows: int = MAX_ROWS,
        max_features: int = MAX_FEATURES) -> Model:
    """Fit on ``(toxic, text)`` rows.

    Rows without both classes give a model of one score, the smoothed share
    of toxic rows (a quarter without any rows).  Repeated ids can give more
    rows than labels; beyond ``max_rows`` those of smallest hash are used.
    """
    examples = materialise(_examples(rows, swaps), "examples")
    if examples.count() > max_rows:
        examples = materialise(examples.orderBy(F.xxhash64("toxic", "has")).limit(max_rows), "examples")
    chosen, n1, n0 = _telling(examples, max_features)
    prior = (n1 + 0.5) / (n1 + n0 + 2)
    bias = math.log(prior / (1 - prior))
    if not chosen:
        return Model({}, bias)
    compact = materialise(_compact(examples, chosen), "compact").persist()

    def total(w: np.ndarray) -> np.ndarray:
        shipped = compact.sparkSession.sparkContext.broadcast(w)

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros(len(shipped.value) + 1)
            for batch in small_batches(batches):
                out += loss_and_slope(batch, shipped.value, swap_weight)
            yield pa.RecordBatch.from_arrays([pa.array([out.tobytes()], pa.binary())], names=["sums"])

        parts = compact.mapInArrow(scan, "sums binary").collect()
        shipped.unpersist()
        out = np.sum([np.frombuffer(p["sums"]) for p in parts], axis=0)
        out[0] += l2 / 2 * float((w[:-1] ** 2).sum())
        out[1:-1] += l2 * w[:-1]
        return out

    w = _minimise(total, np.append(np.zeros(len(chosen)), bias))
    compact.unpersist()
    return Model(dict(zip(chosen, w[:-1].tolist())), float(w[-1]))


def score(docs: DataFrame, model: Model, text_col: str = "text", name: str = "score") -> DataFrame:
    """``docs`` with ``name`` (0 to 1) at the end, from the text alone; null and empty texts get the bias."""
    position = docs.columns.index(text_col)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, float] = {}
        weight = model.weights.get
        for batch in small_batches(batches):
            out = []
            for text in batch.column(position).cast(pa.binary()):
                words = set(words_of(text.as_py() or b""))
                if len(known) > CACHE_WORDS:
                    known.clear()
                for w in words:
                    if w not in known:
                        known[w] = sum(weight(b, 0.0) for b in features(w))
                s = model.bias + math.fsum(map(known.__getitem__, words))
                out.append(1 / (1 + math.exp(-s)) if s > -700 else 0.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())],
                                             names=[*batch.schema.names, name])

    return docs.mapInArrow(scan, T.StructType([*docs.schema.fields, T.StructField(name, T.DoubleType())]))


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             max_rows: int = MAX_ROWS) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every row of ``docs``; extra columns of either table are ignored."""
    model = fit(training_rows(docs, labels, max_rows, id_col, text_col), max_rows=max_rows)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return score(rows, model).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               threshold: float = 0.5) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more; columns are those of ``docs``, whatever
    their names.

    Null and empty texts get the model's bias; repeated rows go or stay
    together; an empty table stays empty, and empty labels give the prior.
    """
    model = fit(training_rows(docs, labels, MAX_ROWS, id_col, text_col))
    [name] = fresh_names(docs.columns, "toxicity")
    return score(docs, model, text_col, name).where(F.col(name) < threshold).drop(name)
