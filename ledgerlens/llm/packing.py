"""Bounded-space online packing of tokenised documents into fixed windows.

Each task keeps a fixed number of open windows, places every document by best
fit, and emits the fullest window when none fits.  What is left open at the
end of the tasks (a fixed number of windows per task) is merged in a second
pass over the lengths of the pieces alone.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_right, insort
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise, small_batches

#: Fixed value: how byte-level BPE of this kind cuts text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space as the pattern sees it, and the longest run of it that tiktoken's matcher is given (it fails at a million).
SPACES = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
LONG_RUN = 1 << 19
MERGE_GROUP = 4096
FLUSH = 1 << 14

PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long, open boolean")


def _byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def byte_level_bpe(path: str) -> tiktoken.Encoding:
    """The byte-level BPE of a ``tokenizers`` JSON file, run by tiktoken.

    tiktoken merges the same ranks about four times as fast as ``tokenizers``
    and gives the same ids (the tests compare them).  Other kinds of tokenizer
    are refused.  Kept per process (on the tiktoken module, since this module
    travels with each task).
    """
    known = tiktoken.__dict__.setdefault("_byte_level_bpe", {})
    if path in known:
        return known[path]
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec.get("pre_tokenizer") or {}
    if spec["model"]["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space"):
        raise ValueError(f"{path} is not a byte-level BPE")
    special = {t["content"]: t["id"] for t in spec.get("added_tokens", ())}
    alphabet = _byte_alphabet()
    ranks = {bytes(alphabet[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
    known[path] = tiktoken.Encoding("byte-level-bpe", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return known[path]


def plain_ids(encoding: tiktoken.Encoding, text: str) -> np.ndarray:
    """The ids of a text.  A very long run of white space goes to the merges as the one piece that the pattern makes of it:
    the whole run at the end of the text, else all but its last character."""
    if len(text) <= LONG_RUN:
        return encoding.encode_to_numpy(text, disallowed_special=())
    parts, at = [], 0
    for run in SPACES.finditer(text):
        if run.end() - run.start() > LONG_RUN:
            stop = run.end() - (run.end() < len(text))
            parts.append(encoding.encode_to_numpy(text[at:run.start()], disallowed_special=()))
            parts.append(np.array(encoding._encode_single_piece(text[run.start():stop]), np.uint32))
            at = stop
    return np.concatenate([*parts, encoding.encode_to_numpy(text[at:], disallowed_special=())])


def token_ids(encoding: tiktoken.Encoding, text: str, added: bool) -> np.ndarray:
    """The ids of a text; ``added``: the file's added tokens in it give their own ids, as ``tokenizers`` does by default."""
    names = sorted(encoding.special_tokens_set, key=len, reverse=True) if added else []
    if not any(name in text for name in names):
        return plain_ids(encoding, text)
    parts = re.split("(" + "|".join(map(re.escape, names)) + ")", text)
    return np.concatenate([np.array([encoding.encode_single_token(p)], np.uint32) if i % 2 else plain_ids(encoding, p)
                           for i, p in enumerate(parts)])


class OpenWindows:
    """At most ``limit`` open windows of ``size`` tokens, kept in order of their fill."""

    def __init__(self, size: int, limit: int, first_id: int, emit: Callable[[int, list, bool], None]):
        self.size, self.limit, self.next_id, self.emit = size, limit, first_id, emit
        self.windows: list[tuple[int, int, list]] = []  # (tokens used, sequence id, pieces)

    def place(self, length: int, piece: tuple) -> None:
        at = bisect_right(self.windows, self.size - length, key=lambda w: w[0]) - 1
        if at >= 0:
            used, name, pieces = self.windows.pop(at)
        else:
            if len(self.windows) >= self.limit:
                _, name, pieces = self.windows.pop()
                self.emit(name, pieces, False)
            used, name, pieces = 0, self.next_id, []
            self.next_id += 1
        pieces.append((*piece, used))
        if used + length == self.size:
            self.emit(name, pieces, False)
        else:
            insort(self.windows, (used + length, name, pieces), key=lambda w: w[0])

    def close(self) -> None:
        for _, name, pieces in self.windows:
            self.emit(name, pieces, True)
        self.windows = []


def pack_parts(docs: DataFrame, tokenizer: str, size: int = 2048, windows: int = 64, end_id: int = 1,
               id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False,
               added_tokens: bool = False) -> DataFrame:
    """Pieces of every document as placed by its task; ``open`` marks windows left open at the task's end."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoding, rows = byte_level_bpe(tokenizer), []

        def emit(name: int, pieces: list, left_open: bool) -> None:
            rows.extend((*p[:5], name, p[6], left_open, *((p[5],) if with_ids else ())) for p in pieces)

        def flush() -> pa.RecordBatch:
            kinds = [pa.int64()] * 7 + [pa.bool_()] + ([pa.list_(pa.int32())] if with_ids else [])
            names = [c.split()[0] for c in schema.split(", ")]
            cols = list(zip(*rows)) or [[] for _ in kinds]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=names)

        held = OpenWindows(size, windows, TaskContext.get().partitionId() << 33, emit)
        for batch in small_batches(batches):
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                body = token_ids(encoding, text.as_py() or "", added_tokens)
                ids = np.append(body, end_id).astype("<u4")
                for start in range(0, len(ids), size):
                    part = ids[start:start + size]
                    held.place(len(part), (doc_id, start, len(part), zlib.crc32(part.tobytes()), len(ids),
                                           part if with_ids else None))
            if len(rows) >= FLUSH:
                yield flush()
                rows.clear()
        held.close()
        yield flush()

    schema = PIECES + (", ids array<int>" if with_ids else "")
    picked = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return picked.mapInArrow(scan, schema)


def _merge(group: pd.DataFrame, size: int) -> pd.DataFrame:
    """The pieces of one bounded group of leftover windows anew by best fit, longest first: where each one goes."""
    bins: list[tuple[int, int]] = []  # (tokens used, sequence id)
    names = iter(sorted(set(group["sequence_id"])))
    out = []
    for length, name, offset in sorted(zip(group["length"], group["sequence_id"], group["offset"]),
                                       key=lambda p: (-p[0], p[1], p[2])):
        at = bisect_right(bins, size - length, key=lambda b: b[0]) - 1
        if at >= 0:
            filled, into = bins.pop(at)
        else:
            filled, into = 0, next(names, None)
            if into is None:  # more windows than before: the old placing stands
                return group.assign(into=group["sequence_id"], place=group["offset"])[
                    ["sequence_id", "offset", "into", "place"]]
        out.append((name, offset, into, filled))
        insort(bins, (filled + length, into), key=lambda b: b[0])
    return pd.DataFrame(out, columns=["sequence_id", "offset", "into", "place"]).astype("int64")


def pack(docs: DataFrame, tokenizer: str, size: int = 2048, windows: int = 64, end_id: int = 1,
         id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False,
         added_tokens: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` (and ``ids``).

    Every row of ``docs`` is tokenised whole and closed by ``end_id``; null
    text is empty and gives that one id; null ids stay null and repeated rows
    are documents of their own.  A document longer than ``size`` is cut into
    full pieces and a rest; others stay whole.  An empty table gives no rows.
    With ``added_tokens`` a literal added token of the file gives its own id,
    otherwise it is ordinary text.  The pieces of leftover windows are placed anew in groups of about
    ``MERGE_GROUP`` windows, so the last pass stays bounded however many tasks
    there were.
    """
    pieces = materialise(
        pack_parts(docs, tokenizer, size, windows, end_id, id_col, text_col, with_ids, added_tokens), "pieces")
    left = pieces.where("open")
    windows_left = left.agg(F.count_distinct("sequence_id")).first()[0]
    groups = max(1, -(-windows_left // MERGE_GROUP))
    moved = (left.select("sequence_id", "offset", "length")
             .withColumn("g", F.pmod(F.xxhash64("sequence_id"), F.lit(groups))).groupBy("g")
             .applyInPandas(lambda g: _merge(g, size), "sequence_id long, offset long, into long, place long"))
    done = pieces.where("not open").drop("open")
    merged = (left.drop("open").join(moved, ["sequence_id", "offset"])
              .withColumn("offset", F.col("place")).withColumn("sequence_id", F.col("into")).drop("into", "place"))
    return done.unionByName(merged.select(done.columns))
