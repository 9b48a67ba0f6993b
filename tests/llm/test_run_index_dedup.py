import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from fixtures import edge_docs, edge_rows, empty_docs, rows_of, with_clashes

from ledgerlens.llm import run_index_dedup as rid


def slow(rows, length):
    data = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[p:p + length] for _, b in data for p in range(len(b) - length + 1))
    out = []
    for i, b in data:
        gone = np.zeros(len(b) + 1, bool)
        for p in range(len(b) - length + 1):
            if seen[b[p:p + length]] > 1:
                gone[p:p + length] = True
        gone = gone[:len(b)]
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def texts(seed=7):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choices("abcdeé", k=rng.randrange(1, 7)))
    prose = lambda n: " ".join(word() for _ in range(n))
    passages = [prose(20) for _ in range(5)]
    rows = []
    for i in range(60):
        parts = [prose(rng.randrange(30)) for _ in range(3)]
        if i % 2:
            parts.insert(1, rng.choice(passages))
        if i % 11 == 0:
            parts.append("ab " * 60)  # repeats itself
        rows.append((i, " ".join(parts)))
    rows += [(60, rows[4][1]), (61, rows[5][1][:-9] + "changed"), (62, "z" * 500), (63, "xy" * 45), (64, None), (65, "")]
    return rows


def run(spark, rows, **how):
    return rows_of(rid.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), **how))


@pytest.mark.parametrize("how", [
    {}, {"max_segments": 0}, {"bucket_bytes": 3000}, {"gram": 40}, {"gram": 5, "max_segments": 3}])
def test_matches_brute_force(spark, how):
    rows = texts()
    assert run(spark, rows, **{"length": 40, "gram": 16, **how}) == slow(rows, 40)


def test_edges(spark):
    rows = [(r[0], r[1]) for r in edge_rows() if r[0] != 5] + [(5, "long run of words " * 200), (9, "\0" * 300), (10, "\0" * 300 + "é")]
    assert run(spark, rows) == slow(rows, 200)
    assert rid.remove_repeats(empty_docs(spark)).count() == 0
    assert rid.remove_repeats(with_clashes(edge_docs(spark))).count() == len(edge_rows())


def test_long_text_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(rid, "CHUNK", 256)
    rows = [(i, t if not t else t * 3) for i, t in texts(8)][:40]
    assert run(spark, rows, length=40, gram=16) == slow(rows, 40)


def test_suffix_order_runs_and_statistics():
    rng = random.Random(3)
    strings = [bytes(rng.choices(b"ab", k=rng.randrange(1, 60))) for _ in range(30)]
    strings = list(dict.fromkeys(strings))
    index = rid.RunIndex(strings)
    text = bytes(index.text.astype(np.uint8))
    order = sorted(range(len(text)), key=lambda i: text[i:])
    assert rid.suffix_order(index.text).tolist() == order
    last = [text[i - 1] for i in order]
    heads = [0] + [i for i in range(1, len(last)) if last[i] != last[i - 1]]
    assert index.run_starts.tolist() == heads and index.symbols.tolist() == [last[i] for i in heads]
    size, other = index.matching_statistics()
    for row in range(1, len(order)):
        a, b = text[order[row]:], text[order[row - 1]:]
        common = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
        assert size[order[row]] == common
        if common:
            assert other[order[row]] == order[row - 1]


def test_hashes_and_minima():
    data = np.frombuffer(bytes(random.Random(1).choices(b"abc", k=400)), np.uint8)
    for size in (1, 2, 3, 7, 64, 200):
        hashes, windows = rid.rolling_hash(data, size), [bytes(data[i:i + size]) for i in range(400 - size + 1)]
        assert len(hashes) == len(windows) and len(set(hashes.tolist())) == len(set(windows))
        same = {}
        assert all(same.setdefault(w, h) == h for w, h in zip(windows, hashes.tolist()))
    values = np.array([5, 3, 8, 1, 9, 2, 2, 7])
    for width in (1, 2, 3, 5, 8):
        assert rid.sliding_min(values, width).tolist() == [min(values[i:i + width]) for i in range(9 - width)]


def test_first_suffix_among_other_starts():
    assert rid.RunIndex([b"ab", b"aa"]).repeated(2).tolist() == []
    rng = random.Random(5)
    for _ in range(2000):
        stem = bytes(rng.choices(b"ab", k=rng.randrange(6)))
        strings = list(dict.fromkeys(stem + bytes(rng.choices(b"ab", k=rng.randrange(1, 9))) for _ in range(rng.randrange(1, 7))))
        length = rng.randrange(1, 8)
        index = rid.RunIndex(strings)
        at = [(int(s) + p, t[p:p + length]) for s, t in zip(index.starts, strings) for p in range(len(t) - length + 1)]
        seen = Counter(w for _, w in at)
        assert index.repeated(length).tolist() == [x for x, w in at if seen[w] > 1]
