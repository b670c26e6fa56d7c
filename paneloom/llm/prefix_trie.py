"""Prefix trie of conversations, by union-find over the common prefixes of sorted neighbours.

A conversation is a key: 20 bytes a turn, 16 of the turn's digest and 4 of its text's length, so that a
prefix of turns is a prefix of bytes. Distinct keys are sorted over range partitions. In a task they
come in blocks of bounded size; the edges between neighbours are taken in descending order of their
common prefix, and every merge of two components makes the branching node of that depth. What
a block shares with its neighbours, the prefixes that its first or last key has in common with
the key beside it, is left open: these nodes of all blocks' forests, known by the digest of their prefix, are merged
across the boundaries by adding them up. Every node counts as new only in the block of its first key.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paneloom.llm.ordering import running_totals
from paneloom.store import materialise

#: Bytes of a turn in a key.
TURN = 20
#: Bytes of keys and number of keys, about, in a block of a forest.
BLOCK_BYTES = 1 << 23
BLOCK_KEYS = 1 << 15
#: Turns of a conversation, and members of a node, put together in one piece.
PIECE = 1024
MEMBERS = 4096
NO_MEMBERS = hashlib.sha256(b"").hexdigest()

NUMBERS = ["conv_id", "n_convs", "n_children", "n_leaves", "gross", "own"]
SCHEMA = "depth long, digest binary, parent_digest binary, ends binary, parent_conv_id long, " + ", ".join(f"{c} long" for c in NUMBERS)


def turns(conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, pos, code): every row with its position in its conversation, from 1, and its turn as 40 hex digits.

    Rows come by ``turn``, null first; rows with the same turn by their digest, repeated rows as often as
    they are there. Null roles and texts are empty. Rows without a conversation id belong to none and go.
    """
    speaker, said = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    spoken = F.concat(F.char_length(speaker).cast("string"), F.lit(":"), speaker, said)
    code = F.concat(F.substring(F.sha2(spoken, 256), 1, 32), F.lpad(F.lower(F.hex(F.char_length(said))), 8, "0"))
    rows = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("bigint").alias("conv"), F.col(turn).alias("turn"), code.alias("code"), F.monotonically_increasing_id().alias("no"), F.lit(1).alias("one")
    )
    return running_totals(rows, ["conv"], ["turn", "code", "no"], "one").select("conv", (F.col("before") + 1).alias("pos"), "code")


def shared_openings(found: DataFrame, group: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Rebuild conversations on the opening of their group's first one: (conv, pos, code) and all conversations (conv).

    Conversation c takes the first h turns of conversation c - c % ``group``, h being crc32(c) % ``most``,
    and its own turns after its first h. One opening goes to fewer than 2 * ``group`` conversations.
    """
    opening = F.crc32(F.col("conv").cast("string")) % most
    convs = materialise(found.select("conv").distinct(), "conversations")
    wanted = convs.select("conv", opening.alias("h"), (F.col("conv") - F.col("conv") % group).alias("first")).where("h > 0")
    heads = found.where((F.col("pos") < most) & (F.col("conv") % group == 0)).select(F.col("conv").alias("of"), "pos", "code")
    opened = wanted.join(heads, (F.col("first") == F.col("of")) & (F.col("pos") <= F.col("h"))).select("conv", "pos", "code")
    return found.where(F.col("pos") > opening).unionByName(opened), convs


def _in_order(position: str, value: str) -> Column:
    sorted_ = F.array_sort(F.collect_list(F.struct(position, value)))
    return F.array_join(F.transform(sorted_, lambda x: x.getField(value)), "")


def sequences(found: DataFrame, convs: DataFrame) -> DataFrame:
    """(conv, key, ends): one key per conversation, empty without turns, and the key's digest.

    A long conversation is put together from pieces; a row holds 20 bytes for each of its turns.
    """
    pieces = found.groupBy("conv", F.floor(F.col("pos") / F.lit(PIECE)).alias("piece")).agg(_in_order("pos", "code").alias("codes"))
    keys = pieces.groupBy("conv").agg(F.unhex(_in_order("piece", "codes")).alias("key")).withColumnRenamed("conv", "of")
    key = F.coalesce("key", F.lit(b"").cast("binary"))
    return convs.join(keys, F.col("conv") == F.col("of"), "left").select("conv", key.alias("key"), F.unhex(F.sha2(key, 256)).alias("ends"))


def common(a: bytes, b: bytes) -> int:
    """Turns that two keys share from the start."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // TURN
    step = np.frombuffer(a, np.uint8, n) != np.frombuffer(b, np.uint8, n)
    return int(step.argmax()) // TURN


def _digests(key: bytes, depth: int) -> list[bytes]:
    """SHA-256 of the prefixes of 0 to ``depth`` turns."""
    state, out = hashlib.sha256(), []
    for t in range(depth + 1):
        out.append(state.digest())
        state.update(key[t * TURN : (t + 1) * TURN])
    return out


class Forest:
    """The compact trie of a block of sorted, distinct keys: one node per key and one per branching.

    ``left`` and ``right`` are the turns that the first and the last key share with the keys beside the block, -1 without one.
    """

    def __init__(self, keys: list[bytes], members: list[int], least: list[int], ends: list[bytes], left: int, right: int) -> None:
        self.left, self.right, self.keys, self.ends = left, right, keys, ends
        n = len(keys)
        self.last = n - 1
        self.lengths = [[0, *np.frombuffer(k, np.dtype([("digest", "V16"), ("length", ">u4")]))["length"].cumsum(dtype=np.int64).tolist()] for k in keys]
        self.depth = [len(k) // TURN for k in keys]
        self.start, self.end = list(range(n)), list(range(n))
        self.members, self.least = list(members), list(least)
        self.children, self.leaves = [0] * n, [1] * n
        self.gross, self.own = [0] * n, [0] * n  # members times length, and length, of all nodes below
        self.parent = [-1] * n
        if right >= self.depth[-1]:
            self.leaves[-1] = 0  # the key goes on in the next block
        self._merge()

    def _merge(self) -> None:
        joined, top = list(range(len(self.keys))), list(range(len(self.keys)))

        def find(i: int) -> int:
            while joined[i] != i:
                joined[i] = joined[joined[i]]
                i = joined[i]
            return i

        shared = [common(a, b) for a, b in zip(self.keys, self.keys[1:], strict=False)]
        for i in sorted(range(len(shared)), key=lambda i: -shared[i]):  # left to right at the same depth
            a, b = find(i), find(i + 1)
            node = top[a]
            if self.depth[node] != shared[i]:  # neither a key that ends here nor merged here before
                node = self._add(shared[i], top[a])
            self._attach(node, top[b])
            joined[b], top[a] = a, node
        self.root = top[find(0)]
        if self.depth[self.root]:
            self.root = self._add(0, self.root)

    def _add(self, depth: int, child: int) -> int:
        for column, value in (
            (self.depth, depth), (self.start, self.start[child]), (self.end, self.end[child]), (self.members, 0), (self.least, self.least[child]),
            (self.children, 0), (self.leaves, 0), (self.gross, 0), (self.own, 0), (self.parent, -1),
        ):
            column.append(value)
        self._attach(len(self.depth) - 1, child)
        return len(self.depth) - 1

    def _attach(self, node: int, child: int) -> None:
        below = self.lengths[self.start[child]]
        span = below[self.depth[child]] - below[self.depth[node]]
        if not self.children[node]:
            self.leaves[node] = 0
        self.children[node] += 1
        self.leaves[node] += self.leaves[child]
        self.gross[node] += self.gross[child] + self.members[child] * span
        self.own[node] += self.own[child] + span
        self.members[node] += self.members[child]
        self.least[node] = min(self.least[node], self.least[child])
        self.end[node] = max(self.end[node], self.end[child])
        self.parent[child] = node

    def rows(self) -> Iterator[tuple]:
        """All nodes, one for each depth, in the order of SCHEMA; an open one has a digest and holds this block's part."""
        first, final = _digests(self.keys[0], max(self.left, 0)), _digests(self.keys[-1], max(self.right, 0))

        def opened(node: int, t: int) -> bytes | None:
            if self.start[node] == 0 and t <= max(self.left, 0):
                return first[t]
            return final[t] if t == 0 or self.end[node] == self.last and t <= self.right else None

        edge = self.lengths[0][max(self.left, 0)]
        for node, depth in enumerate(self.depth):
            above = self.parent[node]
            along = self.lengths[self.start[node]]
            for t in range(self.depth[above] + 1 if above >= 0 else 0, depth + 1):
                span = along[depth] - along[max(t - 1, 0)]
                children = self.children[node] if t == depth else 1
                own = self.own[node] + span
                if self.start[node] == 0 and t <= self.left:  # nodes of an earlier block
                    own -= edge - along[max(t - 1, 0)]
                    children -= t < self.left
                before = above if above >= 0 and t == self.depth[above] + 1 else node
                parent = opened(before, t - 1) if t else None
                known = self.least[before] if t and parent is None else None
                ends = self.ends[node] if t == depth and node <= self.last else None
                yield (
                    t, opened(node, t), parent, ends, known, self.least[node], self.members[node], children, self.leaves[node],
                    self.gross[node] + self.members[node] * span, own,
                )


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[Forest]:
    """Rows (part, key, n_convs, conv_id, ends, left, right) in order of part and key, as forests of blocks."""
    rows: list[tuple] = []
    size, left = 0, -1
    for batch in batches:
        for row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if rows and (row[0] != rows[0][0] or size > BLOCK_BYTES or len(rows) >= BLOCK_KEYS):
                same = row[0] == rows[0][0]
                right = common(rows[-1][1], row[1]) if same else rows[0][6]
                yield _forest(rows, left, right)
                rows, size, left = [], 0, right if same else row[5]
            elif not rows:
                left = row[5]
            rows.append(row)
            size += len(row[1])
    if rows:
        yield _forest(rows, left, rows[0][6])


def _forest(rows: list[tuple], left: int, right: int) -> Forest:
    _, keys, members, least, ends, *_ = (list(c) for c in zip(*rows, strict=True))
    return Forest(keys, members, least, ends, left, right)


def _forests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary(), *[pa.int64()] * 7]
    names = [c.split()[0] for c in SCHEMA.split(", ")]
    for forest in _blocks(batches):
        waiting: list[tuple] = []
        for row in forest.rows():
            waiting.append(row)
            if len(waiting) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*waiting, strict=True), kinds, strict=True)], names=names)
                waiting = []
        if waiting:
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*waiting, strict=True), kinds, strict=True)], names=names)


def _borders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        part, least, most, before, after = (c.to_pylist() for c in batch.columns)
        left = [-1 if b is None else common(b, k) for b, k in zip(before, least, strict=True)]
        right = [-1 if a is None else common(k, a) for k, a in zip(most, after, strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (part, left, right)], names=["of", "left", "right"])


def _member_digests(rows: DataFrame) -> DataFrame:
    """(of, ends_sha256): SHA-256 of the ids, ascending and joined by commas, of the conversations with the same key.

    Members are numbered and joined into texts of some thousand, so that the task that feeds a hash reads few rows.
    """
    placed = running_totals(rows.select("ends", "conv", F.lit(1).alias("one")), ["ends"], ["conv"], "one")
    ids = F.transform(F.array_sort(F.collect_list("conv")), lambda c: c.cast("string"))
    texts = placed.groupBy("ends", F.floor(F.col("before") / F.lit(MEMBERS)).alias("piece")).agg(F.array_join(ids, ",").alias("ids"))
    pieces = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def feed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, state = None, hashlib.sha256()
        for batch in batches:
            done = []
            for ends, ids in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), strict=True):
                if ends == current:
                    state.update(b",")
                else:
                    if current is not None:
                        done.append((current, state.hexdigest()))
                    current, state = ends, hashlib.sha256()
                state.update(ids.encode())
            if done:
                yield _digest_rows(done)
        if current is not None:
            yield _digest_rows([(current, state.hexdigest())])

    dealt = texts.repartition(pieces, "ends").sortWithinPartitions("ends", "piece")
    return dealt.mapInArrow(feed, "of binary, ends_sha256 string")


def _digest_rows(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    of, digests = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays([pa.array(of, pa.binary()), pa.array(digests, pa.string())], names=["of", "ends_sha256"])


def prefix_trie(found: DataFrame, convs: DataFrame) -> DataFrame:
    """All distinct prefixes of the conversations in ``convs`` with the turns (conv, pos, code) of ``found``.

    One row per prefix: conv_id (the smallest that starts with it), depth, parent_conv_id (of the prefix
    without its last turn; null for the root of depth 0), n_convs, n_children, n_leaves, saved_tokens (code points of
    last texts times members beyond the first, over the subtree) and ends_sha256 (of the
    conversations that end there). No conversations have no root and give no rows.
    """
    rows = materialise(sequences(found, convs), "sequences")
    pieces = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    distinct = rows.groupBy("key", "ends").agg(F.count("*").alias("n_convs"), F.min("conv").alias("conv_id"))
    placed = materialise(distinct.repartitionByRange(pieces, "key").withColumn("part", F.spark_partition_id()), "keys")
    # One row per partition; the windows run over those.
    order = Window.orderBy("part")
    spans = placed.groupBy("part").agg(F.min("key").alias("least"), F.max("key").alias("most"))
    beside = spans.select("part", "least", "most", F.lag("most").over(order).alias("before"), F.lead("least").over(order).alias("after"))
    borders = materialise(beside.mapInArrow(_borders, "of long, left long, right long"), "borders")
    sorted_ = (
        placed.join(borders, F.col("part") == F.col("of"))
        .select("part", "key", "n_convs", "conv_id", "ends", "left", "right")
        .repartitionByRange(pieces, "part")
        .sortWithinPartitions("part", "key")
    )
    nodes = materialise(sorted_.mapInArrow(_forests, SCHEMA), "nodes")

    sums = [F.sum(c).alias(c) for c in NUMBERS[1:]]
    shared = nodes.where("digest is not null").groupBy("digest").agg(
        F.first("depth").alias("depth"), F.first("parent_digest").alias("parent_digest"), F.max("ends").alias("ends"), F.min("conv_id").alias("conv_id"), *sums
    )
    shared = materialise(shared, "shared-nodes")
    closed = nodes.where("digest is null")
    above = shared.select(F.col("digest").alias("above"), F.col("conv_id").alias("above_conv"))
    columns = ["depth", "ends", *NUMBERS]
    below_shared = closed.where("parent_digest is not null").select("parent_digest", *columns).unionByName(
        shared.where("parent_digest is not null").select("parent_digest", *columns)
    )
    whole = (
        closed.where("parent_digest is null").select(*columns, "parent_conv_id")
        .unionByName(below_shared.join(above, F.col("parent_digest") == F.col("above")).select(*columns, F.col("above_conv").alias("parent_conv_id")))
        .unionByName(shared.where("parent_digest is null").select(*columns, F.lit(None).cast("bigint").alias("parent_conv_id")))
    )
    whole = materialise(whole, "trie")
    ended = whole.where("ends is not null").join(_member_digests(rows), F.col("ends") == F.col("of"))
    passed = whole.where("ends is null").withColumn("ends_sha256", F.lit(NO_MEMBERS))
    return ended.drop("of").unionByName(passed).select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", (F.col("gross") - F.col("own")).alias("saved_tokens"), "ends_sha256"
    )
