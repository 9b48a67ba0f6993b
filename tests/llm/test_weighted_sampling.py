"""Fingerprints by consistent weighted sampling against exact similarities and a plain document order."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from fixtures import SMALL, edge_docs, edge_rows, with_clashes

from ledgerlens.llm import weighted_sampling as cws
from ledgerlens.llm.queries import QUERIES

DOC = "doc_id long, text string"
COLUMNS = "doc_id n_chars edited_sha256 fingerprint edited_fingerprint near_edited near_next".split()


def signed(text):
    import xxhash

    h = xxhash.xxh64_intdigest(text.encode(), 42)
    return h - 2**64 if h >= 2**63 else h


def slow(docs, sampler=None):
    sampler = sampler or cws.Sampler()
    key = lambda d: (d[0] is not None, d[0] or 0, signed(d[1] or ""))
    copies = Counter((i, t or "") for i, t in docs)
    order = sorted(copies, key=key)
    out = []
    for (i, t), (_, following) in zip(order, order[1:] + order[:1]):
        half = len(t) // 2
        edited = t[:len(t) - half] + following[:half]
        own, new, its = (sampler.fingerprint(x.encode()) for x in (t, edited, following))
        row = (i, len(t), hashlib.sha256(edited.encode()).hexdigest(), own.astype(">u2").tobytes().hex(),
               new.astype(">u2").tobytes().hex(), cws.likeness(own, new), cws.likeness(own, its))
        out += [row] * copies[(i, t)]
    return sorted(out, key=repr)


def fast(df, **how):
    return sorted((tuple(r) for r in cws.fingerprints(df, **how).select(COLUMNS).collect()), key=repr)


def similarity(a, b):
    return sum((a & b).values()) / sum((a | b).values())


@pytest.mark.parametrize("seed", range(4))
def test_collisions_follow_generalised_jaccard(seed):
    rng = random.Random(seed)
    sampler = cws.Sampler(samples=4096, seed=seed)
    for share, heavy in ((0.1, 1), (0.5, 1), (0.5, 9), (0.8, 3000), (0.95, 40)):
        a = Counter({f"t{i}": rng.randint(1, heavy) for i in range(300)})
        b = Counter({t if rng.random() < share else f"{t}'": n if rng.random() < share else rng.randint(1, heavy) for t, n in a.items()})
        x, y = (sampler.draw(np.array([signed(t) for t in c], np.int64).view(np.uint64), np.array(list(c.values()))) for c in (a, b))
        want = similarity(a, b)
        assert abs(cws.likeness(x, y) - want) < 4 * (want * (1 - want) / 4096) ** 0.5 + 0.01


def test_fingerprint_ignores_order_and_weighs_repeats():
    sampler = cws.Sampler()
    one = sampler.fingerprint("a b c a".encode())
    assert (one == sampler.fingerprint("C a\nB  A".encode())).all()
    assert cws.likeness(one, sampler.fingerprint(b"a b c")) < 1
    assert cws.likeness(sampler.fingerprint(b""), sampler.fingerprint(b" \n")) == 1
    assert cws.likeness(sampler.fingerprint(b""), one) == 0


def test_chunks_of_a_long_text_change_nothing(monkeypatch):
    words = " ".join(f"w{i % 700}" for i in range(5000)).encode()
    whole = cws.Sampler().fingerprint(words)
    monkeypatch.setattr(cws, "_STEP", 13)
    assert (cws.Sampler().fingerprint(words) == whole).all()


@pytest.mark.parametrize("range_bytes", [8 << 20, 300, 1])
def test_next_document_across_ranges(spark, range_bytes):
    rng = random.Random(7)
    docs = [(rng.randrange(-50, 10**15), " ".join(rng.choices(["añ", "b", "cc", "ddd", "ß"], k=rng.randrange(30)))) for _ in range(120)]
    docs += [(None, "no id"), (None, None), (None, "no id")] + [docs[5]] * 3 + [(docs[6][0], "same id, other text")] + [(2**60 + 1, "x"), (2**60, "y z")]
    assert fast(spark.createDataFrame(docs, DOC).repartition(5), range_bytes=range_bytes) == slow(docs)


def test_edges(spark):
    docs = with_clashes(edge_docs(spark))
    for name in "id hash text2 size p range guest before".split():
        docs = docs.withColumn(name, docs.text)
    assert fast(docs) == slow([r[:2] for r in edge_rows()])
    assert fast(docs.limit(0)) == []
    assert fast(spark.createDataFrame([(4, "one two three")], DOC)) == slow([(4, "one two three")])


def test_query_matches_brute_force(spark):
    given = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    found = sorted((tuple(r) for r in QUERIES["op13_weighted_sampling"](spark, SMALL).select(COLUMNS).collect()), key=repr)
    assert found == slow(given)
    assert sum(r[5] > r[6] for r in found) > 0.95 * len(found)
