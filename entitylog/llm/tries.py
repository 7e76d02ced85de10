"""Prefix tries of conversations, from adaptive radix trees over turn ids.

A turn's id is the MD5 of its role and text, 16 bytes in big-endian order, and a
conversation's key is the ids of its turns one after another. Keys are sorted over
all tasks, and each task builds adaptive radix trees of runs of at most ``CHUNK``
keys: nodes grow through layouts of 4, 16, 48 and 256 children, and bytes without a
branch are kept as one compressed path. Only depths that are whole turns, inside a
compressed path too, are nodes of the conversation trie.

As a run holds neighbours in the order of the keys, all nodes but those on the way
to its first and last key lie in it whole, and the tree gives their counts and sums
at once. The others are open: each run emits its share, shares are added up by node,
and sums are carried up the open nodes by doubling steps. So no key, however many
conversations begin with it, is gathered in one task.

A conversation is cut into segments of ``SEGMENT`` turns, so that one of any length
is many short keys. A segment's key begins with the name of the node it starts from,
and nodes that a segment goes on from are open. Names are digests of the way to a
node; of the longest conversations one digest a segment passes through one task.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entitylog.llm.common import ranked, small_batches, spread_join, stored

# Executors get the functions of this module with the job, and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Bytes of a turn's id and of a node's name.
WIDTH = 16
ROOT = bytes(WIDTH)
#: Turns of a conversation in one key.
SEGMENT = 64
#: Keys of one radix tree, and their bytes.
CHUNK, CHUNK_BYTES = 20_000, 16 << 20


class Node:
    """A node of an adaptive radix tree: ``path`` leads from below its parent's branch to its own.

    ``slots`` are the branching bytes in order (4 or 16 children), a place for each
    of 256 bytes (48), or nothing (256, where children are at their byte).
    """

    __slots__ = ("path", "layout", "slots", "children", "end")

    def __init__(self, path: bytes, end: int = -1):
        self.path, self.layout, self.slots, self.children, self.end = path, 4, bytearray(), [], end

    def child(self, byte: int) -> Node | None:
        if self.layout <= 16:
            at = self.slots.find(byte)
            return self.children[at] if at >= 0 else None
        if self.layout == 48:
            at = self.slots[byte]
            return self.children[at] if at < 48 else None
        return self.children[byte]

    def put(self, byte: int, node: Node) -> None:
        """Sets the child at a byte; a full layout is exchanged for the next."""
        if self.layout <= 16:
            at = self.slots.find(byte)
            if at >= 0:
                self.children[at] = node
                return
            if len(self.children) < self.layout:
                at = sum(s < byte for s in self.slots)
                self.slots.insert(at, byte)
                self.children.insert(at, node)
                return
            if self.layout == 4:
                self.layout = 16
                return self.put(byte, node)
            places = bytearray(b"\x30" * 256)
            for at, slot in enumerate(self.slots):
                places[slot] = at
            self.layout, self.slots = 48, places
        if self.layout == 48:
            if self.slots[byte] < 48:
                self.children[self.slots[byte]] = node
                return
            if len(self.children) < 48:
                self.slots[byte] = len(self.children)
                self.children.append(node)
                return
            full: list = [None] * 256
            for slot, at in enumerate(self.slots):
                if at < 48:
                    full[slot] = self.children[at]
            self.layout, self.slots, self.children = 256, bytearray(), full
        self.children[byte] = node

    def below(self) -> list[Node]:
        return self.children if self.layout <= 48 else [c for c in self.children if c is not None]


def insert(root: Node, key: bytes, end: int) -> None:
    """Adds a key under a root without a path; ``end`` is its number."""
    node, at = root, 0
    while True:
        if at == len(key):
            node.end = end
            return
        byte = key[at]
        child = node.child(byte)
        if child is None:
            node.put(byte, Node(key[at + 1 :], end))
            return
        path, at = child.path, at + 1
        if key.startswith(path, at):
            node, at = child, at + len(path)
            continue
        same = 0
        for a, b in zip(path, memoryview(key)[at:]):
            if a != b:
                break
            same += 1
        # The path parts here: a new node takes what is shared.
        fork = Node(path[:same])
        child.path = path[same + 1 :]
        fork.put(path[same], child)
        node.put(byte, fork)
        node, at = fork, at + same


def radix_tree(keys: list[bytes]) -> Node:
    root = Node(b"")
    for n, key in enumerate(keys):
        insert(root, key, n)
    return root


def name(start: bytes, ids: bytes) -> bytes:
    """The name of the node that a way of ids leads to from a start."""
    return hashlib.md5(start + hashlib.md5(ids).digest()).digest() if ids else start


class Below:
    """What hangs below a place of the tree: members, range of keys, and sums of the nodes nearest to it."""

    __slots__ = ("n", "conv", "low", "high", "more", "children", "leaves", "saved", "tops")

    def __init__(self):
        self.n, self.conv, self.low, self.high, self.more = 0, None, 1 << 60, -1, False
        self.children, self.leaves, self.saved, self.tops = 0, 0, 0, []

    def member(self, n: int, conv: int, at: int, more: bool) -> None:
        self.n, self.conv = self.n + n, conv if self.conv is None else min(self.conv, conv)
        self.low, self.high, self.more = min(self.low, at), max(self.high, at), self.more or more

    def add(self, other: Below) -> None:
        self.member(other.n, other.conv, other.low, other.more)
        self.high = max(self.high, other.high)
        self.children += other.children
        self.leaves += other.leaves
        self.saved += other.saved
        self.tops += other.tops


PARTS = ("name", "parent", "depth", "n", "conv", "chars", "children", "leaves", "saved", "open", "parent_conv")
NODE = (
    "name binary, parent binary, depth long, n long, conv long, chars long, children long, leaves long,"
    " saved long, open boolean, parent_conv long"
)
TYPES = dict(zip(PARTS, (pa.binary(), pa.binary(), *[pa.int64()] * 7, pa.bool_(), pa.int64())))


def trie(keys: list[bytes], ns: list[int], convs: list[int], chars: list, segments: list[int], more: list[bool]) -> dict:
    """Nodes of the conversation trie from a run of sorted keys, as columns ``PARTS``.

    A key is a start and the ids of a segment. Open nodes have the shares of this run
    and of their closed children only.
    """
    out: dict[str, list] = {p: [] for p in PARTS}
    last = len(keys) - 1

    def emit(at: int, below: Below) -> Below:
        """The node at a byte depth with all that is below it; what is below that place then."""
        key, turns = keys[below.low], at // WIDTH - 1
        open_ = turns == 0 or below.more or below.low == 0 or below.high == last
        size = chars[below.low][turns - 1] if turns else 0
        leaves, saved = below.leaves, below.saved
        if not open_:
            leaves, saved = leaves or 1, saved + (below.n - 1) * size
            for row in below.tops:
                out["parent_conv"][row] = below.conv
        start = key[:WIDTH]
        row = (
            name(start, key[WIDTH:at]), name(start, key[WIDTH : at - WIDTH]) if turns else None,
            segments[below.low] * SEGMENT + turns, below.n if turns else 0, below.conv if turns else None, size,
            below.children, leaves, saved, open_, None,
        )
        for part, value in zip(PARTS, row):
            out[part].append(value)
        top = Below()
        top.member(below.n, below.conv, below.low, below.more)
        top.high = below.high
        if not open_:
            top.children, top.leaves, top.saved, top.tops = 1, leaves, saved, [len(out["name"]) - 1]
        return top

    # After all below it: a place on the stack is a node, the depth above and at it, and what was found.
    stack = [(radix_tree(keys), 0, 0, iter(()), Below())]
    stack[0] = (stack[0][0], 0, 0, iter(stack[0][0].below()), stack[0][4])
    while stack:
        node, above, at, rest, below = stack[-1]
        child = next(rest, None)
        if child is not None:
            # The branching byte is the child's first.
            stack.append((child, at, at + 1 + len(child.path), iter(child.below()), Below()))
            continue
        stack.pop()
        if node.end >= 0:
            n = node.end
            below.member(ns[n], convs[n], n, more[n])
        if below.high < 0:
            continue
        for depth in range(at // WIDTH * WIDTH, above // WIDTH * WIDTH, -WIDTH):
            below = emit(depth, below)
        if stack:
            stack[-1][4].add(below)
    return out


def _tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def made(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        found = trie(*(rows.column(c).to_pylist() for c in ("key", "n", "conv", "chars", "segment", "more")))
        return pa.RecordBatch.from_pydict({p: pa.array(found[p], TYPES[p]) for p in PARTS})

    held: list[pa.RecordBatch] = []
    rows = size = 0
    for batch in batches:
        held.append(batch)
        rows, size = rows + batch.num_rows, size + batch.nbytes
        if rows >= CHUNK or size >= CHUNK_BYTES:
            yield made(held)
            held, rows, size = [], 0, 0
    if rows:
        yield made(held)


def _starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Names of the nodes that segments start from; sorted by conversation and segment."""
    conv, start = None, ROOT
    for batch in batches:
        starts = []
        for c, digest in zip(batch.column("conv").to_pylist(), batch.column("digest").to_pylist()):
            if c != conv:
                conv, start = c, ROOT
            starts.append(start)
            start = hashlib.md5(start + digest).digest()
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv"), batch.column("segment"), pa.array(starts, pa.binary())], ["conv", "segment", "start"]
        )


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one node's conversations, sorted, as text."""
    for batch in batches:
        names, ids = batch.column("name").to_pylist(), batch.column("conv").to_pylist()
        if not names:
            continue
        starts = [n for n in range(len(names)) if n == 0 or names[n] != names[n - 1]]
        runs = list(zip(starts, [*starts[1:], len(names)]))
        yield pa.RecordBatch.from_pydict(
            {
                "name": pa.array([names[a] for a, _ in runs], pa.binary()),
                "first": pa.array([ids[a] for a, _ in runs], pa.int64()),
                "ids": [",".join(map(str, ids[a:b])) for a, b in runs],
            }
        )


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest of all a node's runs, which come in order; only the digest's state is kept."""
    node, digest = None, None
    for batch in batches:
        names, found = [], []
        for current, ids in zip(batch.column("name").to_pylist(), batch.column("ids").to_pylist()):
            if current == node:
                digest.update(b",")
            else:
                if node is not None:
                    names.append(node)
                    found.append(digest.hexdigest())
                node, digest = current, hashlib.sha256()
            digest.update(ids.encode())
        yield pa.RecordBatch.from_pydict({"name": pa.array(names, pa.binary()), "ends_sha256": pa.array(found, pa.string())})
    if node is not None:
        yield pa.RecordBatch.from_pydict(
            {"name": pa.array([node], pa.binary()), "ends_sha256": pa.array([digest.hexdigest()], pa.string())}
        )


def turns(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Turns with their place: ``conv``, ``at`` (from 1, by turn, nulls first, ties by the id), ``id`` (hex) and ``chars``.

    Null roles and texts are empty. Rows without a conversation's id belong to none.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role, text))
    rows = df.select(
        F.col(conv).cast("long").alias("conv"),
        F.col(turn).alias("turn"),
        F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("id"),
        F.length(text).cast("long").alias("chars"),
    ).filter("conv is not null")
    return ranked(rows, "conv", [F.col("turn").asc_nulls_first(), "id"], "at").select("conv", "at", "id", "chars")


def rebuilt(rows: DataFrame, every: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with turns of their hundred's first: turns, and conversations with their ``size``.

    ``rows`` as stored from ``turns``. Conversation c begins with the first
    ``crc32(c) % most`` turns of conversation ``c - c % every``, then goes on with
    its own turns after as many. Of negative ids the remainder is negative too.
    """
    sizes = rows.groupBy("conv").agg(F.count(F.lit(1)).alias("own"))
    base = F.expr(f"conv - conv % {every}")
    taken = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    convs = sizes.select("conv", "own", base.alias("base"), taken.alias("taken"))
    heads = rows.filter(f"conv % {every} = 0 and at < {most}")
    held = heads.groupBy(F.col("conv").alias("base")).agg(F.count(F.lit(1)).alias("held"))
    convs = convs.join(held, "base", "left").withColumn("lent", F.least("taken", F.coalesce("held", F.lit(0))))
    convs = stored(convs.drop("held"), "conversations")
    lent = convs.select("base", F.col("conv").alias("to"), "taken").join(heads, F.col("base") == F.col("conv"))
    lent = lent.filter("at <= taken").select(F.col("to").alias("conv"), "at", "id", "chars")
    own = spread_join(rows, convs.select("conv", "taken", "lent"), ["conv"]).filter("at > taken")
    own = own.select("conv", (F.col("at") - F.col("taken") + F.col("lent")).alias("at"), "id", "chars")
    size = F.col("lent") + F.greatest(F.col("own") - F.col("taken"), F.lit(0))
    return lent.unionByName(own), convs.select("conv", size.alias("size"))


def nodes(rows: DataFrame, convs: DataFrame) -> DataFrame:
    """The trie of conversations given as turns (``conv``, ``at`` from 1 without gaps, ``id``, ``chars``).

    ``convs``: all of them with their ``size``, those without a turn too. One row per
    node: ``conv_id`` (smallest member), ``depth``, ``parent_conv_id``, ``n_convs``,
    ``n_children``, ``n_leaves``, ``saved_tokens`` and ``ends_sha256``. No conversation,
    no node, not even the root.
    """
    spark = rows.sparkSession
    small_batches(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    root = F.lit(ROOT)

    one = F.sort_array(F.collect_list(F.struct("at", "id", "chars")))
    segments = (
        rows.withColumn("segment", F.expr(f"cast((at - 1) div {SEGMENT} as int)"))
        .groupBy("conv", "segment").agg(one.alias("t"))
        .select(
            "conv", "segment", F.unhex(F.array_join("t.id", "")).alias("ids"), F.col("t.chars").alias("chars"),
        )
    )
    segments = stored(segments, "segments")
    long = stored(segments.groupBy("conv").agg(F.max("segment").alias("last")).filter("last > 0"), "long")
    if long.isEmpty():
        segments = segments.withColumns({"start": root, "more": F.lit(False)})
    else:
        own = spread_join(segments, long, ["conv"], "left")
        digest = F.unhex(F.md5("ids"))
        starts = (
            own.filter("last is not null").select("conv", "segment", digest.alias("digest"))
            .repartition(parts, "conv").sortWithinPartitions("conv", "segment")
            .mapInArrow(_starts, "conv long, segment int, start binary")
        )
        own = spread_join(stored(own, "own"), stored(starts, "starts"), ["conv", "segment"], "left")
        segments = own.withColumns(
            {"start": F.coalesce("start", root), "more": F.coalesce(F.col("segment") < F.col("last"), F.lit(False))}
        )
    segments = stored(segments.select("conv", "segment", "start", "ids", "chars", "more"), "keys")

    runs = (
        segments.groupBy(F.concat("start", "ids").alias("key"), "segment")
        .agg(
            F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv"), F.any_value("chars").alias("chars"),
            F.bool_or("more").alias("more"),
        )
        .repartitionByRange(parts, "key").sortWithinPartitions("key")
        .mapInArrow(_tries, NODE)
    )
    made = stored(runs, "tries")
    kept = "name", "parent", "depth", "n", "conv", "children", "leaves", "saved"
    closed = made.filter("not open")
    whole = convs.agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv")).filter("n > 0")
    whole = whole.select(
        root.alias("name"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("long").alias("depth"), "n",
        "conv", *(F.lit(0).cast("long").alias(c) for c in ("chars", "children", "leaves", "saved")),
    )
    shares = made.filter("open").select(*whole.columns).unionByName(whole)
    opened = shares.groupBy("name").agg(
        F.max("parent").alias("parent"), F.max("depth").alias("depth"), F.sum("n").alias("n"), F.min("conv").alias("conv"),
        F.max("chars").alias("chars"), F.sum("children").alias("children"), F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"),
    )
    opened = stored(opened, "open")
    among = opened.filter("parent is not null").groupBy(F.col("parent").alias("name")).agg(F.count(F.lit(1)).alias("among"))
    opened = opened.join(among, "name", "left").select(
        "name", "parent", "depth", "n", "conv",
        (F.col("children") + F.coalesce("among", F.lit(0))).alias("children"),
        "leaves", (F.col("saved") + (F.col("n") - 1) * F.col("chars")).alias("saved"),
    )
    opened = opened.withColumn("leaves", F.when(F.col("children") == 0, 1).otherwise(F.col("leaves")))
    opened = carried_up(stored(opened, "open"))

    all_nodes = stored(
        closed.select(*kept, "parent_conv").unionByName(
            opened.select(*kept).withColumn("parent_conv", F.lit(None).cast("long"))
        ),
        "nodes",
    )
    asked = all_nodes.filter("parent_conv is null and parent is not null").drop("parent_conv")
    # Only open nodes are parents of these.
    named = opened.select(F.col("name").alias("parent"), F.col("conv").alias("parent_conv"))
    found = spread_join(asked, named, ["parent"])
    rest = all_nodes.filter("parent_conv is not null or parent is null")
    all_nodes = found.unionByName(rest)

    last = segments.filter("not more").select(
        "conv", F.unhex(F.md5(F.concat("start", F.unhex(F.md5("ids"))))).alias("name")
    )
    last = last.unionByName(convs.filter("size = 0").select("conv", root.alias("name")))
    ends = (
        last.select("name", "conv").repartitionByRange(parts, "name", "conv").sortWithinPartitions("name", "conv")
        .mapInArrow(_packed, "name binary, first long, ids string")
        .repartition(parts, "name").sortWithinPartitions("name", "first")
        .mapInArrow(_digests, "name binary, ends_sha256 string")
    )
    none = F.lit(hashlib.sha256(b"").hexdigest())
    return all_nodes.join(ends, "name", "left").select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"),
        F.col("n").alias("n_convs"), F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", none).alias("ends_sha256"),
    )


def carried_up(tree: DataFrame) -> DataFrame:
    """The nodes of a stored tree with ``leaves`` and ``saved`` summed over their subtrees.

    After k steps a node has the sums of all less than 2**k below it, and knows the
    node 2**k above.
    """
    tree = tree.withColumn("up", F.col("parent"))
    while True:
        lower = tree.filter("up is not null")
        if lower.isEmpty():
            return tree.drop("up")
        more = lower.groupBy(F.col("up").alias("name")).agg(F.sum("leaves").alias("l"), F.sum("saved").alias("s"))
        above = tree.filter("up is not null").select(F.col("name").alias("up"), F.col("up").alias("next"))
        moved = spread_join(lower, above, ["up"], "left").drop("up").withColumnRenamed("next", "up")
        top = tree.filter("up is null")
        tree = moved.unionByName(top).join(more, "name", "left")
        tree = stored(
            tree.withColumns({c: F.col(c) + F.coalesce(m, F.lit(0)) for c, m in (("leaves", "l"), ("saved", "s"))}).drop("l", "s"),
            "open",
        )


def conversation_trie(df: DataFrame) -> DataFrame:
    """``nodes`` of all conversations of a table, each rebuilt on its hundred's first."""
    rows, convs = rebuilt(stored(turns(df), "turns"))
    return nodes(rows, convs)
