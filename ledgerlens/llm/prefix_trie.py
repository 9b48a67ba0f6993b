"""Conversation prefix trie over minimal-perfect-hash node tables.

Rebuilt conversations are paths; a node is a distinct sequence of first turns.
Every path row carries the digest of its prefix: the XOR of 128-bit hashes of
(depth, turn), so digests come from a running XOR over globally sorted rows
and no conversation is ever gathered.  Path rows are dealt to shards of
bounded size.  A shard enumerates its distinct prefix digests, builds a
minimal perfect hash over them, verifies every row against the slot it is
given, and scatters counts into flat arrays indexed by slot.  Shards meet in
one aggregate by digest.  Then each node's own leaf and token counts go to
one shard that holds the node with all its ancestors, where they are added up
through the array of parent slots in depth order; what shards add to a common
ancestor is summed by digest.

A path longer than ``FRAGMENT`` turns is cut into fragments of that length;
shards of deeper fragments come first and hand the sums of their topmost
nodes to the fragment above.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import materialise
from .hilbert import ranked

#: Path rows a shard holds on average, turns of one path in one fragment, bytes of ids in one chunk.
SHARD_ROWS, FRAGMENT, CHUNK = 8192, 4096, 1 << 20
#: Conversations share the opening of the first one of their block.
BLOCK, OPENINGS = 100, 6

_NO_LABEL = "00" * 16
_LOCAL = ("shard long, level long, slot long, parent_slot long, depth long, p1 long, p2 long, q1 long, q2 long, "
          "label binary, chars long, n long, ends long, conv long")


class PerfectHash:
    """A minimal perfect hash of distinct 128-bit keys ``(n, 2) uint64``: slots 0 to n - 1.

    Each level hashes the keys left over into twice as many places and settles
    those that are alone there; a slot is the rank of the key's place among
    all settled ones.  ``slots`` gives some slot (or -1) for keys outside the
    set, so callers compare the key stored at the slot.
    """

    def __init__(self, keys: np.ndarray):
        self.levels: list[np.ndarray] = []
        settled, left = 0, keys
        while len(left):
            at = self._places(left, len(self.levels), 2 * len(left))
            alone = np.bincount(at, minlength=2 * len(left)) == 1
            self.levels.append(np.where(alone, np.cumsum(alone) - 1 + settled, -1))
            settled += int(alone.sum())
            left = left[~alone[at]]

    @staticmethod
    def _places(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        x = keys[:, 0] ^ np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
        for column in (keys[:, 1], np.uint64(0)):
            x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
            x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB) + column
        return ((x ^ (x >> np.uint64(32))) % np.uint64(size)).astype(np.int64)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        out = np.full(len(keys), -1, np.int64)
        left = np.arange(len(keys))
        for level, ranks in enumerate(self.levels):
            out[left] = ranks[self._places(keys[left], level, len(ranks))]
            left = left[out[left] < 0]
        return out


def _longs(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table.column(n).to_numpy() for n in names]


def _labels(table: pa.Table) -> np.ndarray:
    column = table.column("label").cast(pa.binary(16)).combine_chunks()
    column = column.chunk(0) if isinstance(column, pa.ChunkedArray) else column
    return np.frombuffer(column.buffers()[1], "<u8")[2 * column.offset:2 * (column.offset + len(column))].reshape(-1, 2)


def node_table(rows: pa.Table) -> pa.Table:
    """The node table of one shard: its distinct digests by slot, with the counts of its path rows."""
    shard, level, depth, chars, conv, p1, p2, q1, q2 = _longs(
        rows, "shard", "level", "depth", "chars", "c", "p1", "p2", "q1", "q2")
    ends, labels = rows.column("is_end").to_numpy(zero_copy_only=False), _labels(rows)
    keys = np.stack([p1, p2], axis=1).view(np.uint64)
    order = np.lexsort((p2, p1))
    fresh = np.ones(len(order), bool)
    fresh[1:] = (keys[order][1:] != keys[order][:-1]).any(axis=1)
    distinct = order[fresh]
    perfect = PerfectHash(keys[distinct])
    n = len(distinct)
    one = np.empty(n, np.int64)  # a row of each slot
    one[perfect.slots(keys[distinct])] = distinct
    slot = perfect.slots(keys)
    mine = one[slot]
    same = (keys == keys[mine]).all(axis=1) & (depth == depth[mine]) & (q1 == q1[mine]) & (q2 == q2[mine])
    if not (same & (labels == labels[mine]).all(axis=1)).all():
        raise ValueError("two prefixes share a digest")
    parent = np.full(n, -1, np.int64)
    inner = np.flatnonzero(depth[one] % FRAGMENT)
    above = np.stack([q1[one[inner]], q2[one[inner]]], axis=1).view(np.uint64)
    parent[inner] = perfect.slots(above)
    if not (keys[one[parent[inner]]] == above).all():
        raise ValueError("a node lacks its parent")
    smallest = np.full(n, np.iinfo(np.int64).max)
    np.minimum.at(smallest, slot, conv)
    columns = [shard[one], level[one], np.arange(n), parent, depth[one], p1[one], p2[one], q1[one], q2[one],
               [x.tobytes() for x in labels[one]], chars[one], np.bincount(slot, minlength=n),
               np.bincount(slot[ends], minlength=n), smallest]
    names = [x.split()[0] for x in _LOCAL.split(", ")]
    return pa.table([pa.array(c, pa.binary() if k == "label" else pa.int64()) for k, c in zip(names, columns)], names)


def subtree_sums(nodes: pa.Table) -> pa.Table:
    """Leaf and token counts of one shard's nodes summed over their subtrees, deepest nodes first.

    Returns what each node receives, and for topmost nodes of a deeper
    fragment the same sums addressed to their parents (``up``).
    """
    slot, parent, depth, leaves, saved = _longs(nodes, "slot", "parent_slot", "depth", "leaves", "saved")
    n = len(slot)
    row = np.empty(n, np.int64)
    row[slot] = np.arange(n)
    sums = np.stack([leaves[row], saved[row]], axis=1)
    parent, depth = parent[row], depth[row]
    by_depth = np.argsort(-depth, kind="stable")
    cuts = np.flatnonzero(np.diff(depth[by_depth])) + 1
    for level in np.split(by_depth, cuts):
        level = level[parent[level] >= 0]
        np.add.at(sums, parent[level], sums[level])
    p1, p2, q1, q2 = (x[row] for x in _longs(nodes, "p1", "p2", "q1", "q2"))
    some = sums.any(axis=1)
    tops = some & (parent < 0) & (depth > 0)
    parts = [(p1[some], p2[some], sums[some], False), (q1[tops], q2[tops], sums[tops], True)]
    return pa.table({
        "p1": np.concatenate([a for a, _, _, _ in parts]), "p2": np.concatenate([b for _, b, _, _ in parts]),
        "leaves": np.concatenate([s[:, 0] for _, _, s, _ in parts]),
        "saved": np.concatenate([s[:, 1] for _, _, s, _ in parts]),
        "up": np.concatenate([np.full(len(a), u) for a, _, _, u in parts])})


def _opening(conv: Column) -> Column:
    return F.crc32(conv.cast("string").cast("binary")) % OPENINGS


def rebuilt_turns(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                  text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``(turns, convs)`` of all rebuilt conversations.

    ``turns``: ``c, depth, label, chars, is_end``, depth from 1; ``convs``:
    ``c, n_turns``, one row per conversation.  Turns stand in the order of
    turn (null first), then role, then a digest of the text.  Rows without a
    conversation id take no part.
    """
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in (role_col, text_col))
    label = F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    given = conversations.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).cast("long").alias("c"), F.col(turn_col).cast("long").alias("turn"), role.alias("role"),
        label.alias("label"), F.char_length(text).cast("long").alias("chars"))
    placed, _ = ranked(given, ["c", "turn", "role", "label"])
    placed = placed.select("c", "rank", "label", "chars")
    spans = materialise(placed.groupBy("c").agg(F.min("rank").alias("base"), F.count("*").alias("len")).select(
        "c", "base", "len", (F.col("c") - F.col("c") % BLOCK).alias("home"), _opening(F.col("c")).alias("h")), "spans")
    homes = spans.where("c = home").select("home", F.col("base").alias("home_base"), F.col("len").alias("home_len"))
    spans = spans.join(homes, "home", "left").withColumn("hp", F.least("h", F.coalesce("home_len", F.lit(0)))).select(
        "c", "home", "base", "h", "hp", (F.col("hp") + F.greatest(F.col("len") - F.col("h"), F.lit(0))).alias("n_turns"))
    spans = materialise(spans, "spans")
    depth = F.col("rank") - F.col("base") - F.col("h") + F.col("hp") + 1
    own = placed.join(spans, "c").where(F.col("rank") - F.col("base") >= F.col("h")).select(
        "c", depth.alias("depth"), "label", "chars", "n_turns")
    heads = placed.where(F.col("c") % BLOCK == 0).join(homes.withColumnRenamed("home", "c"), "c").select(
        F.col("c").alias("home"), (F.col("rank") - F.col("home_base") + 1).alias("depth"), "label", "chars").where(
        F.col("depth") < OPENINGS)
    borrowed = spans.join(heads, "home").where("depth <= hp").select("c", "depth", "label", "chars", "n_turns")
    turns = own.unionByName(borrowed).select("c", "depth", "label", "chars", F.expr("depth = n_turns").alias("is_end"))
    return turns, spans.select("c", "n_turns")


def prefix_digests(turns: DataFrame) -> DataFrame:
    """``turns`` with the digest ``p1, p2`` of the prefix that ends there and ``q1, q2`` of the one before.

    Rows are range-partitioned by (conversation, depth), so a conversation of
    any length spreads over tasks; a running XOR per task is completed by one
    row for each conversation that crosses a task's end.
    """

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, last, state = TaskContext.get().partitionId(), None, np.zeros(2, np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            conv = batch.column(0).to_numpy()
            own = np.stack([batch.column(k).to_numpy() for k in (5, 6)], axis=1)
            running = np.bitwise_xor.accumulate(own, axis=0)
            first = np.flatnonzero(np.concatenate([[True], conv[1:] != conv[:-1]]))
            before = np.where((first > 0)[:, None], running[first - 1], state if conv[0] == last else 0)
            if first[0] == 0 and conv[0] == last:
                before[0] = state
            running ^= np.repeat(before, np.diff(np.append(first, len(conv))), axis=0)
            last, state = conv[-1], running[-1].copy()
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(conv), part)), *batch.columns, pa.array(running[:, 0]), pa.array(running[:, 1])],
                names=["part", "c", "depth", "label", "chars", "is_end", "a", "b", "x1", "x2"])

    mixed = turns.select("c", "depth", "label", "chars", "is_end",
                         *(F.xxhash64(F.lit(k), "depth", "label").alias(n) for k, n in ((1, "a"), (2, "b"))))
    placed = materialise(
        mixed.repartitionByRange("c", "depth").sortWithinPartitions("c", "depth").mapInArrow(
            scan, "part long, c long, depth long, label binary, chars long, is_end boolean, a long, b long, x1 long, x2 long"),
        "running")
    spread = placed.groupBy("part", "c").agg(F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"))
    split = placed.groupBy("c").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).where("lo < hi")
    earlier = W.partitionBy("c").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    carry = materialise(spread.join(split, "c").select(
        "part", "c", *(F.bit_xor(x).over(earlier).alias(f"c{x}") for x in ("a", "b"))), "carries")
    p1 = F.col("x1").bitwiseXOR(F.coalesce("ca", F.lit(0)))
    p2 = F.col("x2").bitwiseXOR(F.coalesce("cb", F.lit(0)))
    return placed.join(carry, ["part", "c"], "left").select(
        "c", "depth", "label", "chars", "is_end", p1.alias("p1"), p2.alias("p2"),
        p1.bitwiseXOR(F.col("a")).alias("q1"), p2.bitwiseXOR(F.col("b")).alias("q2"))


def ends_digest(ends: DataFrame) -> DataFrame:
    """``p1, p2, ends_sha256``: the SHA-256 of each node's ids ``c`` in ascending order, comma-joined.

    Ids are sorted and joined to chunks by tasks that share a node's ids; the
    hash itself, sequential by its nature, streams over the node's chunks.
    """

    def chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, first, ids, held = None, 0, [], 0
        done: list[tuple] = []
        for batch in batches:
            for a, b, conv in zip(*(c.to_pylist() for c in batch.columns)):
                if node != (a, b) or held >= CHUNK:
                    if ids:
                        done.append((*node, first, ",".join(ids)))
                    node, first, ids, held = (a, b), conv, [], 0
                ids.append(str(conv))
                held += len(ids[-1]) + 1
            if done:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], names=["p1", "p2", "first", "ids"])
                done = []
        if ids:
            yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (*node, first, ",".join(ids))],
                                             names=["p1", "p2", "first", "ids"])

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, state, done = None, None, []

        def out():
            return pa.RecordBatch.from_arrays([pa.array(x) for x in zip(*done)], names=["p1", "p2", "ends_sha256"])

        for batch in batches:
            for a, b, _, ids in zip(*(c.to_pylist() for c in batch.columns)):
                if node == (a, b):
                    state.update(b"," + ids.encode())
                else:
                    if node:
                        done.append((*node, state.hexdigest()))
                    node, state = (a, b), hashlib.sha256(ids.encode())
            if done:
                yield out()
                done = []
        if node:
            done.append((*node, state.hexdigest()))
            yield out()

    order = ["p1", "p2", "c"]
    joined = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(
        chunks, "p1 long, p2 long, first long, ids string")
    return joined.repartition("p1", "p2").sortWithinPartitions("p1", "p2", "first").mapInArrow(
        hashes, "p1 long, p2 long, ends_sha256 string")


def _one(name: str) -> Column:
    """The value on which all shards agree for a node; an error if they do not."""
    low, high = F.min(name), F.max(name)
    return F.when(low.eqNullSafe(high), low).otherwise(F.raise_error(F.lit(f"two prefixes share a digest ({name})")).cast("long"))


def trie(conversations: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
         text_col: str = "text", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per trie node: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    n_ends, ends_sha256``.

    ``conv_id`` is the smallest member; ``n_ends`` members end at the node.
    Null role or text is empty, a null turn comes first, equal turns go by
    role and text digest, repeated rows are turns of their own, and rows
    without a conversation id take no part.  An empty table has no nodes.
    Other columns are ignored, whatever their names.
    """
    turns, convs = rebuilt_turns(conversations, conv_col, turn_col, role_col, text_col)
    roots = convs.select("c", F.lit(0).cast("long").alias("depth"), F.unhex(F.lit(_NO_LABEL)).alias("label"),
                         F.lit(0).cast("long").alias("chars"), F.expr("n_turns = 0").alias("is_end"),
                         *(F.lit(0).cast("long").alias(x) for x in ("p1", "p2", "q1", "q2")))
    paths = materialise(prefix_digests(turns).unionByName(roots).withColumn("level", F.expr(f"depth div {FRAGMENT}")), "paths")
    shards = max(1, math.ceil(paths.count() / shard_rows))
    block = F.pmod(F.xxhash64(F.expr(f"c div {BLOCK}"), F.col("level")), F.lit(shards))
    dealt = paths.withColumn("shard", F.col("level") * shards + block)
    local = materialise(dealt.groupBy("shard").applyInArrow(node_table, _LOCAL), "local-nodes")
    nodes = materialise(local.groupBy("p1", "p2").agg(
        _one("depth").alias("depth"), _one("q1").alias("q1"), _one("q2").alias("q2"), _one("chars").alias("chars"),
        F.when(F.min("label") == F.max("label"), 0).otherwise(F.raise_error(F.lit("two turns share a digest")).cast("int")).alias("_same"),
        F.sum("n").alias("n_convs"), F.sum("ends").alias("n_ends"), F.min("conv").alias("conv_id"),
        F.min("shard").alias("owner"), F.min("level").alias("level")), "nodes")
    below = nodes.where("depth > 0").groupBy("q1", "q2").agg(F.count("*").alias("n_children"))
    above = nodes.select(F.col("p1").alias("q1"), F.col("p2").alias("q2"), F.col("conv_id").alias("parent_conv_id"),
                         (F.col("depth") + 1).alias("depth"))
    nodes = nodes.join(below.select(F.col("q1").alias("p1"), F.col("q2").alias("p2"), "n_children"), ["p1", "p2"], "left")
    nodes = materialise(nodes.join(above, ["q1", "q2", "depth"], "left").withColumn(
        "n_children", F.coalesce("n_children", F.lit(0))), "linked-nodes")

    totals, carried = [], None
    for level in range((nodes.agg(F.max("level")).first()[0] or 0), -1, -1):
        own = nodes.where(F.col("level") == level).select(
            F.col("owner").alias("shard"), "p1", "p2", F.expr("cast(n_children = 0 as long)").alias("leaves"),
            ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"))
        if carried is not None:
            more = carried.select("p1", "p2", F.col("leaves").alias("l"), F.col("saved").alias("s"))
            own = own.join(more, ["p1", "p2"], "left").select(
                "shard", "p1", "p2", (F.col("leaves") + F.coalesce("l", F.lit(0))).alias("leaves"),
                (F.col("saved") + F.coalesce("s", F.lit(0))).alias("saved"))
        held = local.where(F.col("level") == level).join(own, ["shard", "p1", "p2"], "left").select(
            "shard", "slot", "parent_slot", "depth", "p1", "p2", "q1", "q2",
            F.coalesce("leaves", F.lit(0)).alias("leaves"), F.coalesce("saved", F.lit(0)).alias("saved"))
        sums = materialise(held.groupBy("shard").applyInArrow(
            subtree_sums, "p1 long, p2 long, leaves long, saved long, up boolean"), "sums").groupBy("p1", "p2", "up").agg(
            F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
        totals.append(sums.where("not up"))
        carried = materialise(sums.where("up"), "carried") if level else None
    total = totals[0]
    for part in totals[1:]:
        total = total.unionByName(part)
    total = total.select("p1", "p2", F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"))
    ended = ends_digest(paths.where("is_end"))
    found = nodes.join(total, ["p1", "p2"]).join(ended, ["p1", "p2"], "left")
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "n_ends",
                        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
