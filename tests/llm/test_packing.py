import zlib

import numpy as np
import pytest
from fixtures import SMALL, edge_docs, empty_docs, with_clashes

from ledgerlens.llm import packing
from ledgerlens.llm.queries import tokenizer_path


def ids_of(text):
    from tokenizers import Tokenizer

    if "t" not in ids_of.__dict__:
        ids_of.t = Tokenizer.from_file(tokenizer_path())
        ids_of.t.encode_special_tokens = True
    return [*ids_of.t.encode(text or "", add_special_tokens=False).ids, 1]


def holds(rows, docs, size):
    """Every id in exactly one piece, digests right, and sequences gapless and within the size."""
    want = sorted((d[0], zlib.crc32(np.array(ids_of(d[1]), "<u4").tobytes()), len(ids_of(d[1]))) for d in docs if d[0] is not None)
    got = {}
    for r in rows:
        assert r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) and r["length"] == len(r["ids"]) > 0
        got.setdefault(r["doc_id"], []).append(r)
    whole = []
    for name, pieces in got.items():
        if name is None:
            continue
        by_start = {}
        for p in pieces:
            by_start.setdefault(p["start"], []).append(p)
        while by_start.get(0):  # repeated ids give several chains
            at, ids, total = 0, [], by_start[0][0]["doc_tokens"]
            while at < total:
                piece = next(p for p in by_start[at] if p["doc_tokens"] == total)
                by_start[at].remove(piece)
                ids += piece["ids"]
                at += piece["length"]
            whole.append((name, zlib.crc32(np.array(ids, "<u4").tobytes()), total))
    assert sorted(whole) == want
    sequences = {}
    for r in rows:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return sum(r["length"] for r in rows) / (size * len(sequences))


@pytest.mark.parametrize("size,windows", [(2048, 64), (64, 2), (16, 1)])
def test_round_trip(spark, size, windows):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").repartition(3).select("doc_id", "text")
    rows = packing.pack(docs, tokenizer_path(), size, windows, with_ids=True).collect()
    fill = holds(rows, [tuple(r) for r in docs.collect()], size)
    assert fill > (0.95 if size == 2048 else 0.8)


def test_edges_and_special_tokens(spark):
    docs = with_clashes(edge_docs(spark)).union(with_clashes(spark.createDataFrame(
        [(20, "a <|endoftext|> b", "en", "a", 1)], edge_docs(spark).schema)))
    rows = packing.pack(docs, tokenizer_path(), with_ids=True).collect()
    holds(rows, [(r["doc_id"], r["text"]) for r in docs.collect()], 2048)
    assert sum(r["doc_id"] is None for r in rows) == 2
    assert packing.pack(empty_docs(spark), tokenizer_path()).count() == 0


def test_other_tokenizers_are_refused():
    import public_tokenizers

    with pytest.raises(ValueError):
        packing.byte_level_bpe(str(public_tokenizers.path("word_bpe_49k.json")))


def test_windows_stay_bounded_and_emit_the_fullest():
    out = []
    held = packing.OpenWindows(10, 2, 0, lambda name, pieces, left: out.append((name, [p[0] for p in pieces], left)))
    for name, length in (("a", 6), ("b", 7), ("c", 3), ("d", 8), ("e", 2)):
        held.place(length, (name,))
        assert len(held.windows) <= 2
    held.close()
    # c fills b; d fits nowhere and is the second window; e fits d best.
    assert out == [(1, ["b", "c"], False), (2, ["d", "e"], False), (0, ["a"], True)]


@pytest.mark.parametrize("run", [" " * 2_000_000, "\n" * 2_000_000, " \n\u2028\u3000" * 500_000])
def test_very_long_runs_of_white_space(run):
    encoding = packing.byte_level_bpe(tokenizer_path())
    for text in (run, f"a b{run}", f"{run}c d", f"a{run}b \x85", f"a{run}\x1cb"):
        assert [*packing.plain_ids(encoding, text).tolist(), 1] == ids_of(text)


def test_cuts_at_runs_change_no_ids(monkeypatch):
    monkeypatch.setattr(packing, "LONG_RUN", 2)
    encoding = packing.byte_level_bpe(tokenizer_path())
    rng = np.random.default_rng(4)
    for _ in range(500):
        text = "".join(rng.choice(list(" \n\t\r\x0b\x1c\x1f\x85\xa0\u200b\u2009\u180e\u2028\u3000\ufeffab1!'s"), 30))
        assert [*packing.plain_ids(encoding, text).tolist(), 1] == ids_of(text)


def test_added_tokens_as_tokenizers_by_default():
    from tokenizers import Tokenizer

    reference, encoding = Tokenizer.from_file(tokenizer_path()), packing.byte_level_bpe(tokenizer_path())
    assert packing.token_ids(encoding, "a <|endoftext|> b", True).tolist() == [64, 220, 50256, 275]
    for text in ("<|endoftext|>", "a  <|endoftext|><|endoftext|>  b", "x\n\n<|endoftext|", "<|<|endoftext|>|>", "plain", ""):
        assert packing.token_ids(encoding, text, True).tolist() == reference.encode(text, add_special_tokens=False).ids


def test_queries_give_added_tokens_their_ids(spark, tmp_path):
    from ledgerlens.llm import queries

    spark.createDataFrame([(1, "a <|endoftext|> b")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    row = queries.op7_bounded_packing(spark, str(tmp_path)).first()
    assert row["ids_crc32"] == zlib.crc32(np.array([64, 220, 50256, 275, 1], "<u4").tobytes())
