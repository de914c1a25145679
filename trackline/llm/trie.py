"""Conversation prefix trie from ternary search trees.

A turn becomes 40 bytes, the SHA-256 of its role and text and the text's length
in UTF-8 bytes; a conversation becomes the string of its turns' bytes, whose
byte order puts equal prefixes next to each other.  Conversations go to range
shards of that order (ties by conv_id), so that neither a frequent first turn nor
a conversation with many copies stays in one task.

A shard is read in blocks of bounded size.  A block encodes its turns by a
dictionary, inserts its distinct sequences into a ternary search tree over the
ids, medians first, and one iterative pass from the last node made to the first
adds up members, leaves and savings.  A prefix of the first or last sequence of a
block may go on in its neighbours: such boundary nodes are merged, block by block
within a shard, then over groups of ``fan`` neighbouring shards until one is left.
A boundary node is named by a chain of digests of its turns and closed once no
neighbour can hold it.

The digest of the conversations that end at a node is taken as they pass; for a
sequence at a shard's edge, or with many conversations, their numbers are written
in chunks and hashed in order afterwards.

Turns come in order of ``turn`` (null first), ties by role and digest of role and
text.  Null roles and texts count as empty, repeated rows are turns of their own,
rows with a null conv_id belong to no conversation and other columns are not
read.  An empty table has no conversation and no node.  A conversation is one row of
40 bytes a turn.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import write_shared

TURN_BYTES = 40
BLOCK_SEQUENCES, BLOCK_TURNS = 8_192, 200_000
CHUNK_BYTES = 1 << 20
FAN = 32
ROOT = b"root"
NOTHING = hashlib.sha256(b"").hexdigest()
_NODE = [("conv_id", "long"), ("depth", "long"), ("parent_conv_id", "long"), ("n_convs", "long"), ("n_children", "long"),
         ("n_leaves", "long"), ("saved_tokens", "long"), ("ends_sha256", "string"), ("pid", "binary"), ("ppid", "binary"), ("shard", "long")]
_EDGE = [("kind", "string"), ("size", "long"), ("on_first", "boolean"), ("on_last", "boolean"), ("chunk", "long"), ("data", "binary")]
SCHEMA = ", ".join(f"{n} {t}" for n, t in _NODE + _EDGE)
_ARROW = pa.schema([(n, {"long": pa.int64(), "string": pa.string(), "binary": pa.binary(), "boolean": pa.bool_()}[t]) for n, t in _NODE + _EDGE])


# ---------------------------------------------------------------- sequences

def _turn_code() -> Column:
    """80 hexadecimal digits: digest of role and text, length of the text in bytes."""
    role, text = (F.coalesce(c, F.lit("")) for c in ("role", "text"))
    of = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256)
    return F.concat(of, F.lpad(F.hex(F.octet_length(text).cast("long")), 16, "0"))


def sequences(conversations: DataFrame, swap: int | None = None, heads: Column | None = None) -> DataFrame:
    """conv_id and key, the bytes of its turns.

    With ``swap`` conversation c starts with the first ``heads`` (a column over conv_id) turns of conversation
    ``c - c % swap`` in place of as many of its own.
    """
    base = F.col("conv_id") - F.col("conv_id") % (swap or 1)
    turns = conversations.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
                                 _turn_code().alias("code")).where("conv_id is not null").withColumn("base", base)
    # one exchange: the base of a conversation and those built on it are few and stand together
    own = turns.repartition("base").groupBy("base", "conv_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("turn", "role", "code"))), lambda t: t["code"]).alias("codes"))
    if swap:
        own = own.withColumn("heads", heads.cast("int"))
        family = own.groupBy("base").agg(F.collect_list(F.struct("conv_id", "heads", "codes")).alias("family"))
        first = F.filter("family", lambda c: c["conv_id"] == F.col("base"))
        none = F.array().cast("array<string>")
        own = family.withColumn("first", F.when(F.size(first) > 0, first[0]["codes"]).otherwise(none)).select(
            F.explode("family").alias("c"), "first").select("c.conv_id", F.expr(
                "concat(slice(first, 1, c.heads), slice(c.codes, c.heads + 1, greatest(size(c.codes) - c.heads, 0)))").alias("codes"))
    return own.select("conv_id", F.unhex(F.array_join("codes", "")).alias("key"))


# ---------------------------------------------------------------- one block

def _chain(key: bytes) -> list[bytes]:
    """Names of all prefixes of a sequence, the root's first."""
    names = [ROOT]
    for i in range(0, len(key), TURN_BYTES):
        names.append(hashlib.sha256(names[-1] + key[i:i + TURN_BYTES]).digest())
    return names


class Ternary:
    """Ternary search tree over sequences of small integers; nodes are numbers, 0 is the root before the first turn."""

    def __init__(self) -> None:
        self.turn, self.up, self.depth = [-1], [-1], [0]
        self.low, self.high, self.down = [0], [0], [0]  # 0: none

    def _add(self, turn: int, up: int) -> int:
        self.turn.append(turn), self.up.append(up), self.depth.append(self.depth[up] + 1)
        self.low.append(0), self.high.append(0), self.down.append(0)
        return len(self.turn) - 1

    def insert(self, ids: list[int]) -> int:
        """The node where the sequence ends."""
        at = 0
        for x in ids:
            here = self.down[at]
            if not here:
                here = self.down[at] = self._add(x, at)
            else:
                while self.turn[here] != x:
                    side = self.low if x < self.turn[here] else self.high
                    if not side[here]:
                        side[here] = self._add(x, at)
                    here = side[here]
            at = here
        return at


def medians(n: int) -> Iterator[int]:
    """0 .. n-1, the middle first, then the middles of both halves."""
    spans = [(0, n)]
    for a, b in spans:
        if a < b:
            m = (a + b) // 2
            yield m
            spans += [(a, m), (m + 1, b)]


class Sequence:
    """Equal conversations that follow each other: their bytes, number, least conv_id, and the list of their conv_ids."""

    def __init__(self, key: bytes) -> None:
        self.key, self.n, self.least, self.ids, self.chunks = key, 0, None, bytearray(), 0


def spill(s: Sequence, shard: int) -> dict:
    """The row of the conv_ids gathered so far, which are let go."""
    row = {"kind": "ends", "pid": _chain(s.key)[-1], "shard": shard, "chunk": s.chunks, "data": bytes(s.ids)}
    s.chunks, s.ids = s.chunks + 1, bytearray()
    return row


class Open:
    """A boundary node: what is known of it so far."""

    __slots__ = ("pid", "ppid", "depth", "size", "least", "n", "children", "leaves", "saved")

    def __init__(self, pid, ppid, depth, size, least=None, n=0, children=0, leaves=0, saved=0):
        self.pid, self.ppid, self.depth, self.size, self.least = pid, ppid, depth, size, least
        self.n, self.children, self.leaves, self.saved = n, children, leaves, saved

    def add(self, least: int, n: int, children: int, leaves: int, saved: int) -> None:
        self.least = least if self.least is None else min(self.least, least)
        self.n, self.children, self.leaves, self.saved = self.n + n, self.children + children, self.leaves + leaves, self.saved + saved


def close(nodes: dict[bytes, Open], still: set[bytes], shard: int) -> Iterator[dict]:
    """Take the nodes that are not in ``still`` out of ``nodes``, deepest first, and give their rows."""
    for x in sorted((x for x in nodes.values() if x.pid not in still), key=lambda x: -x.depth):
        del nodes[x.pid]
        leaves, saved = x.leaves or 1, x.saved + (x.n - 1) * x.size
        if x.ppid is not None:
            up = nodes[x.ppid]
            up.children, up.leaves, up.saved = up.children + 1, up.leaves + leaves, up.saved + saved
        yield {"kind": "node", "conv_id": x.least, "depth": x.depth, "n_convs": x.n, "n_children": x.children, "n_leaves": leaves,
               "saved_tokens": saved, "pid": x.pid, "ppid": x.ppid, "shard": shard}


def left_open(nodes: dict[bytes, Open], shard: int, first: set[bytes], last: set[bytes]) -> Iterator[dict]:
    """Rows of boundary nodes, with the paths they are on."""
    for x in nodes.values():
        yield {"kind": "open", "conv_id": x.least, "depth": x.depth, "n_convs": x.n, "n_children": x.children, "n_leaves": x.leaves,
               "saved_tokens": x.saved, "size": x.size, "pid": x.pid, "ppid": x.ppid, "shard": shard,
               "on_first": x.pid in first, "on_last": x.pid in last}


def grow(block: list[Sequence], nodes: dict[bytes, Open], shard: int) -> Iterator[dict]:
    """Rows of the nodes that lie inside the block; those on its first and last path are added to ``nodes``."""
    words = [[s.key[i:i + TURN_BYTES] for i in range(0, len(s.key), TURN_BYTES)] for s in block]
    coded = {t: i for i, t in enumerate(sorted({t for w in words for t in w}))}
    sizes = [int.from_bytes(t[32:], "big") for t in coded]  # a dict keeps the sorted order
    tree, end_of = Ternary(), {}
    for m in medians(len(block)):
        end_of[tree.insert([coded[t] for t in words[m]])] = block[m]
    count = len(tree.turn)
    n, children, leaves, saved, least = [0] * count, [0] * count, [0] * count, [0] * count, [None] * count
    edge: dict[int, bytes] = {}
    for s, w in ((block[0], words[0]), (block[-1], words[-1])):
        at = tree.insert([coded[t] for t in w])
        for name in reversed(_chain(s.key)):
            edge[at] = name
            at = tree.up[at]
    for v in range(count - 1, -1, -1):  # a node is made after the one above it
        s, up = end_of.get(v), tree.up[v]
        if s is not None:
            n[v] += s.n
            least[v] = s.least if least[v] is None else min(least[v], s.least)
        if v not in edge:
            leaves[v] = leaves[v] or 1
            saved[v] += (n[v] - 1) * sizes[tree.turn[v]]
            children[up], leaves[up], saved[up] = children[up] + 1, leaves[up] + leaves[v], saved[up] + saved[v]
        if v:
            n[up] += n[v]
            least[up] = least[v] if least[up] is None else min(least[up], least[v])
    for v in range(count):
        up = tree.up[v]
        if v in edge:
            name = edge[v]
            if name not in nodes:
                nodes[name] = Open(name, edge[up] if v else None, tree.depth[v], sizes[tree.turn[v]] if v else 0)
            nodes[name].add(least[v], n[v], children[v], leaves[v], saved[v])
            if v in end_of and end_of[v].ids:
                yield spill(end_of[v], shard)
        else:
            row = {"kind": "node", "conv_id": least[v], "depth": tree.depth[v], "n_convs": n[v], "n_children": children[v],
                   "n_leaves": leaves[v], "saved_tokens": saved[v], "shard": shard, "ends_sha256": NOTHING}
            if up in edge:
                row["ppid"] = edge[up]
            else:
                row["parent_conv_id"] = least[up]
            s = end_of.get(v)
            if s is not None:
                if s.chunks:
                    if s.ids:
                        yield spill(s, shard)
                    row["pid"], row["ends_sha256"] = _chain(s.key)[-1], None
                else:
                    row["ends_sha256"] = hashlib.sha256(s.ids).hexdigest()
            yield row


def _rows(rows: Iterable[dict]) -> Iterator[pa.RecordBatch]:
    held: list[dict] = []
    size = 0
    for r in rows:
        held.append(r)
        size += 100 + len(r.get("data") or b"")
        if size > 4_000_000:
            yield pa.RecordBatch.from_pylist(held, _ARROW)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_pylist(held, _ARROW)


def _shard(block_sequences: int, chunk_bytes: int):
    """Nodes, boundary nodes and chunks of conv_ids of one range shard, whose rows come in order of (key, conv_id)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        shard = TaskContext.get().partitionId()
        nodes: dict[bytes, Open] = {}
        block: list[Sequence] = []
        turns, first = 0, None

        def flush(last: bool) -> Iterator[dict]:
            nonlocal block, turns, first
            first = first or set(_chain(block[0].key))
            on_last = set(_chain(block[-1].key))
            yield from grow(block, nodes, shard)
            yield from close(nodes, first | on_last, shard)
            if last:
                yield from left_open(nodes, shard, first, on_last)
            block, turns = [], 0

        for batch in batches:
            for key, conv in zip(batch.column("key").to_pylist(), batch.column("conv_id").to_pylist()):
                if not block or block[-1].key != key:
                    if len(block) >= block_sequences or turns >= BLOCK_TURNS:
                        yield from flush(False)
                    block.append(Sequence(key))
                    turns += len(key) // TURN_BYTES
                s = block[-1]
                s.ids += b"%d" % conv if not s.n else b",%d" % conv
                s.n += 1
                s.least = conv if s.least is None else min(s.least, conv)
                if len(s.ids) > chunk_bytes:
                    yield spill(s, shard)
        if block:
            yield from flush(True)

    return lambda batches: _rows(rows(batches))


def _merge(last: bool):
    """Merges the boundary nodes of groups of neighbouring shards; rows come in order of (group, shard)."""
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        nodes: dict[bytes, Open] = {}
        group = shard = first = None
        here: tuple[set[bytes], set[bytes]] = (set(), set())  # on the first and on the last path of the shard

        def end_shard() -> Iterator[dict]:
            nonlocal first
            first = here[0] if first is None else first
            yield from close(nodes, first | here[1], -1)

        def end_group() -> Iterator[dict]:
            yield from end_shard()
            if last:
                yield from close(nodes, set(), -1)
            yield from left_open(nodes, group, first, here[1])

        for batch in batches:
            for r in batch.to_pylist():
                if (r["group"], r["shard"]) != (group, shard):
                    if group is not None:
                        yield from end_shard() if r["group"] == group else end_group()
                    if r["group"] != group:
                        nodes, first = {}, None
                    group, shard, here = r["group"], r["shard"], (set(), set())
                for on, names in zip(("on_first", "on_last"), here):
                    if r[on]:
                        names.add(r["pid"])
                if r["pid"] not in nodes:
                    nodes[r["pid"]] = Open(r["pid"], r["ppid"], r["depth"], r["size"])
                nodes[r["pid"]].add(r["conv_id"], r["n_convs"], r["n_children"], r["n_leaves"], r["saved_tokens"])
        if group is not None:
            yield from end_group()

    return lambda batches: _rows(rows(batches))


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """pid and the digest of its conv_ids from chunks in order of (pid, shard, chunk)."""
    pid, digest = None, None
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            if r["pid"] != pid:
                if pid is not None:
                    out.append((pid, digest.hexdigest()))
                pid, digest = r["pid"], hashlib.sha256()
                data = r["data"]
            else:
                data = r["data"] if r["data"].startswith(b",") else b"," + r["data"]
            digest.update(data)
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.binary()), pa.array([x[1] for x in out])], ["pid", "of_ends"])
    if pid is not None:
        yield pa.RecordBatch.from_arrays([pa.array([pid], pa.binary()), pa.array([digest.hexdigest()])], ["pid", "of_ends"])


# ---------------------------------------------------------------- the whole

def prefix_trie(rows: DataFrame, block_sequences: int = BLOCK_SEQUENCES, chunk_bytes: int = CHUNK_BYTES, fan: int = FAN) -> DataFrame:
    """One row per node of the trie of ``rows`` (conv_id, key; see :func:`sequences`)."""
    dealt = rows.select("conv_id", "key").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id")
    made = write_shared(dealt.mapInArrow(_shard(block_sequences, chunk_bytes), SCHEMA), "trie-shards")
    names = [n for n, _ in _NODE]
    closed, edges = made.where("kind = 'node'").select(names), made.where("kind = 'open'")
    top = edges.agg(F.max("shard")).first()[0]
    places = edges.select("pid", "shard")
    while top is not None:
        grouped = edges.withColumn("group", F.floor(F.col("shard") / fan).cast("long"))
        merged = write_shared(grouped.repartition("group").sortWithinPartitions("group", "shard").mapInArrow(_merge(top < fan), SCHEMA), "trie-edges")
        closed, edges = closed.union(merged.where("kind = 'node'").select(names)), merged.where("kind = 'open'")
        top = top // fan if top >= fan else None
    # the parent of a node below a boundary node was not whole then; it is looked up by name and shard, so that no name is hot
    named = closed.where("pid is not null").select("pid", "shard", F.col("conv_id").alias("above"))
    places = places.union(named.select("pid", "shard")).distinct().join(named.drop("shard"), "pid").withColumnRenamed("pid", "ppid")
    ends = made.where("kind = 'ends'").select("pid", "shard", "chunk", "data").repartition("pid").sortWithinPartitions(
        "pid", "shard", "chunk").mapInArrow(_hashed, "pid binary, of_ends string")
    out = closed.join(places, ["ppid", "shard"], "left").join(ends, "pid", "left")
    return out.select("conv_id", "depth", F.coalesce("parent_conv_id", "above").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
                      "saved_tokens", F.coalesce("of_ends", "ends_sha256", F.lit(NOTHING)).alias("ends_sha256"))
