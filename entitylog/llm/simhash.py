"""Near-duplicate groups by SimHash and a Gray-order hierarchical index.

A fingerprint has 64 bits, from the XXH64 hashes (seed 42) of a text's word
shingles, or ``width`` times as many from the same hashes mixed anew. Two texts
are linked if their fingerprints differ in few bits, and a group is what links
connect.

The index holds every 64 bits of a fingerprint once for each of several parts,
turned so that the part comes first. The turned bits are sorted by their rank in
the Gray code, in which those that share their first bits stand together: an
upper node is such a shared pattern, and a block is a run of at most
``Law.rows`` fingerprints of one node. A block keeps the mask of bits that all
its members share and their values. Two blocks of a node whose shared bits
already differ too often are never compared, nor are such groups inside a block.
Links leave a block as a spanning forest, so a group of any size emits no more
rows than it has members, and a node of any size is spread over its blocks.

With more parts than bits that may differ, two linked fingerprints agree in a
part, and no link is lost: ``EXACT`` has five parts for four bits. With six or seven
they agree in two or three, and the bits are ordered once for each choice of so many
(``FINER``); ``exact_law`` takes as many as the number of fingerprints asks for, so that
a node's size, and with it the work per fingerprint, does not grow with the table. ``SIMILAR`` is
for texts that share 0.8 of their shingles (Jaccard): 256 bits differ by 39 on
average with a deviation of nearly 6, 60 may, and one of 28 parts of 9 or 10 bits
agrees in all but about one of 1,000 such pairs. Its fingerprints count each shingle
once, and its links are checked: two texts stay linked only if the sets of their
shingles, as 32-bit hashes, share ``least``. That goes by rounds. A block, or two
blocks that meet, hands on spanning forests of its least differing pairs, each
without the pairs of those before: ``FORESTS`` in the first round, twice as many in
every later one. What passes the check is joined into groups, and the next round
takes only pairs not tried there whose ends are still in different groups, until
there are none: then every close pair was checked or has its ends in one group. A
crowd of near-duplicates is one group after the first round; one whose pairs are all
close and all fail has each of them checked, as nothing less decides it.

Empty and null texts have fingerprint zero and are linked like others. Rows of
one id and equal rows are one document. Rows with a null id link nothing; they
get the group of an equal fingerprint, or null.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entitylog.llm.common import BATCH_ROWS, components, drop, small_batches, stored

BITS = 64
#: Hashes whose bits are added up at once.
HASHES = 1 << 16
#: Neighbours in Gray order that form the lowest group of the hierarchy.
GROUP = 16
#: Forests of pairs that a block hands on to be checked in the first round.
FORESTS = 4

_SET = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.int64)


@dataclass(frozen=True)
class Law:
    """Words in a shingle, 64-bit words in a fingerprint, bits that may differ, bits of each part.

    ``least``: share of the shingles that linked texts have in common, checked
    exactly; 0 for no check. ``rows``: fingerprints in a block at most. ``agree``: parts
    that linked fingerprints surely agree in; as many come first in each order of bits.
    """

    words: int
    width: int
    most: int
    parts: tuple[int, ...]
    least: float = 0.0
    rows: int = BATCH_ROWS
    agree: int = 1

    def orders(self) -> list[tuple[int, tuple[int, ...]]]:
        """Orders of a fingerprint's bits: word, and its parts in order, those that agree first."""
        n = len(self.parts)
        return [
            (word, (*first, *((first[0] + k) % n for k in range(1, n) if (first[0] + k) % n not in first)))
            for word in range(self.width)
            for first in combinations(range(n), self.agree)
        ]

    def shared(self) -> list[int]:
        """Bits that the fingerprints of a node share, by order."""
        return [sum(self.parts[k] for k in order[: self.agree]) for _, order in self.orders()]


EXACT = Law(4, 1, 4, (13, 13, 13, 13, 12))
#: The same with more parts, of which more agree: nodes with 20 and 27 bits shared.
FINER = (Law(4, 1, 4, (11, 11, 11, 11, 10, 10), agree=2), Law(4, 1, 4, (10, 9, 9, 9, 9, 9, 9), agree=3))


def exact_law(n: int) -> Law:
    """The exact law for so many fingerprints: nodes stay of about a block's size, so work grows with the rows."""
    return next((x for x in (EXACT, *FINER) if n <= BATCH_ROWS << min(x.shared())), FINER[-1])
SIMILAR = Law(5, 4, 60, (10, 9, 9, 9, 9, 9, 9), 0.8, 2048)


def _mixed(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes anew for the n-th 64 bits; the first are as they are."""
    if n:
        h = (h ^ np.uint64(0x9E3779B97F4A7C15 * n % (1 << 64))) * np.uint64(0xBF58476D1CE4E5B9)
        h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        h = h ^ (h >> np.uint64(31))
    return h


def shingle_hashes(text: str | None, words: int) -> list[int]:
    """Hashes of a text's shingles in order, repeats included."""
    found = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not found:
        return []
    whole, digest = b" ".join(found), xxhash.xxh64_intdigest
    if len(found) <= words:
        return [digest(whole, 42)]
    ends = list(accumulate(len(w) + 1 for w in found))
    starts = [0, *ends]
    return [digest(whole[a : b - 1], 42) for a, b in zip(starts, ends[words - 1 :])]


def fingerprint_of(hashes, width: int = 1) -> np.ndarray:
    """The majority of each bit of the hashes; zero without any."""
    # Values of each byte are counted, and their bits then.
    values = np.zeros((width, 8 * 256), np.int64)
    for i in range(0, len(hashes), HASHES):
        part = np.array(hashes[i : i + HASHES], np.uint64)
        for n in range(width):
            each = _mixed(part, n).astype(">u8").view(np.uint8).reshape(-1, 8) + np.arange(0, 2048, 256)
            values[n] += np.bincount(each.ravel(), minlength=2048)
    counts = (values.reshape(width * 8, 256) @ _SET).reshape(width, BITS)
    return np.packbits(2 * counts > len(hashes), axis=1).view(">i8").astype(np.int64).ravel()


def fingerprints(
    df: DataFrame, text: str = "text", words: int = 4, width: int = 1, into: str = "fingerprint"
) -> DataFrame:
    """Adds the fingerprint of every whole text as an array of longs."""

    @F.pandas_udf("array<long>")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            yield pd.Series([fingerprint_of(shingle_hashes(t, words), width) for t in part], dtype=object)

    small_batches(df.sparkSession)
    return df.withColumn(into, of(text))


def sketches(df: DataFrame, text: str, law: Law) -> DataFrame:
    """Adds the fingerprint of a text's different shingles, and their sorted 32-bit hashes."""

    @F.pandas_udf("fingerprint array<long>, shingles array<int>")
    def of(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in texts:
            codes, sets = [], []
            for t in part:
                hashes = np.unique(np.array(shingle_hashes(t, law.words), np.uint64))
                codes.append(fingerprint_of(hashes, law.width))
                sets.append(np.unique(hashes.astype(np.uint32).view(np.int32)))
            yield pd.DataFrame(
                {"fingerprint": pd.Series(codes, dtype=object), "shingles": pd.Series(sets, dtype=object)}
            )

    small_batches(df.sparkSession)
    return df.withColumn("_of", of(text)).select("*", "_of.*").drop("_of")


BLOCK = "part int, pattern long, mask array<long>, bits array<long>, codes binary, ids binary"
EDGE = "a long, b long"


def _blocks(law: Law):
    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sorted entries as blocks: a node whole, or cut where it has more rows than a block or a task ends."""
        of_part = np.array(law.shared(), np.uint64)
        held: list[np.ndarray] = []

        def cut(rows: np.ndarray, last: bool) -> tuple[pa.RecordBatch, np.ndarray]:
            # Shared first bits of a Gray rank are shared first bits of the code.
            part = rows[:, 0]
            pattern = rows[:, 1] >> (np.uint64(64) - of_part[part.astype(np.int64)])
            starts = np.flatnonzero(np.r_[True, (part[1:] != part[:-1]) | (pattern[1:] != pattern[:-1])])
            ends = np.r_[starts[1:], len(rows)]
            cuts = [(a, min(a + law.rows, end)) for start, end in zip(starts, ends) for a in range(start, end, law.rows)]
            # The last node may go on.
            done = cuts if last else [c for c in cuts if c[1] <= starts[-1] or c[1] - c[0] == law.rows]
            rest = rows[done[-1][1] :] if done else rows
            code = rows[:, 3:].view(np.int64)
            every = [np.bitwise_and.reduce(code[a:b]) for a, b in done]
            some = [np.bitwise_or.reduce(code[a:b]) for a, b in done]
            longs = pa.list_(pa.int64())
            made = {
                "part": pa.array([int(part[a]) for a, _ in done], pa.int32()),
                "pattern": pa.array([int(pattern[a]) for a, _ in done], pa.int64()),
                "mask": pa.array([~(x ^ y) for x, y in zip(every, some)], longs),
                "bits": pa.array(every, longs),
                "codes": pa.array([rows[a:b, 3:].tobytes() for a, b in done], pa.binary()),
                "ids": pa.array([rows[a:b, 2].tobytes() for a, b in done], pa.binary()),
            }
            return pa.RecordBatch.from_pydict(made), rest

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.empty((batch.num_rows, 3 + law.width), np.uint64)
            rows[:, 0] = batch.column("part").to_numpy()
            # The sign was turned to sort by it.
            rows[:, 1] = batch.column("rank").to_numpy().view(np.uint64) ^ np.uint64(1 << 63)
            rows[:, 2] = batch.column("id").to_numpy().view(np.uint64)
            packed = b"".join(batch.column("code").to_pylist())
            rows[:, 3:] = np.frombuffer(packed, ">u8").reshape(-1, law.width)
            held.append(rows)
            if sum(map(len, held)) >= law.rows:
                found, rest = cut(np.concatenate(held), False)
                held = [rest]
                yield found
        if held and sum(map(len, held)):
            yield cut(np.concatenate(held), True)[0]

    return blocks


def _apart(a: np.ndarray, b: np.ndarray, mask_a=None, mask_b=None) -> np.ndarray:
    """Number of differing bits of every code of a from every code of b, under masks."""
    out = np.zeros((*np.broadcast_shapes(a.shape[:-1], b.shape[:-1]),), np.int16)
    for n in range(a.shape[-1]):
        differ = a[..., n] ^ b[..., n]
        if mask_a is not None:
            differ &= mask_a[..., n] & mask_b[..., n]
        out += np.bitwise_count(differ)
    return out


def _close_pairs(a: np.ndarray, b: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices of codes that differ in at most ``most`` bits, group by group."""

    def level(codes):
        starts = np.arange(0, len(codes), GROUP)
        every, some = np.bitwise_and.reduceat(codes, starts), np.bitwise_or.reduceat(codes, starts)
        return every, ~(every ^ some)

    if len(a) * len(b) <= 4096:
        return np.nonzero(_apart(a[:, None], b[None, :]) <= most)
    (bits_a, mask_a), (bits_b, mask_b) = level(a), level(b)
    differ = _apart(bits_a[:, None], bits_b[None, :], mask_a[:, None], mask_b[None, :])
    ga, gb = np.nonzero(differ <= most)
    i = (ga[:, None] * GROUP + np.arange(GROUP)).reshape(-1, GROUP, 1)
    j = (gb[:, None] * GROUP + np.arange(GROUP)).reshape(-1, 1, GROUP)
    there = (i < len(a)) & (j < len(b))
    i, j = np.minimum(i, len(a) - 1), np.minimum(j, len(b) - 1)
    pair, x, y = np.nonzero(there & (_apart(a[i], b[j]) <= most))
    return ga[pair] * GROUP + x, gb[pair] * GROUP + y


def forest(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest it is connected with by the pairs."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = np.minimum(new, new[new])
        if (new == root).all():
            return root
        root = new


def spanning(n: int, i: np.ndarray, j: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Places of the pairs that make a spanning forest of n nodes at the least cost."""
    order = np.argsort(cost, kind="stable")
    i, j = i[order], j[order]
    root, left, taken = np.arange(n), np.arange(len(i)), np.empty(0, np.int64)
    while len(left):
        cheapest = np.full(n, len(i))
        np.minimum.at(cheapest, root[i[left]], left)
        np.minimum.at(cheapest, root[j[left]], left)
        taken = np.union1d(taken, cheapest[cheapest < len(i)])
        root = forest(n, i[taken], j[taken])
        left = left[root[i[left]] != root[j[left]]]
    return order[taken]


def _pairs_of(row: dict, law: Law) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Ids of a block, or of two that meet, close pairs of them as places, and their differing bits."""
    # Unsigned, as bits of a negative number would be counted in its absolute value.
    a = np.frombuffer(row["codes"], np.uint64).reshape(-1, law.width)
    ids = np.frombuffer(row["ids"], np.int64)
    if row["codes2"] is None:
        i, j = _close_pairs(a, a, law.most)
        i, j = i[i < j], j[i < j]
        return ids, i, j, _apart(a[i], a[j])
    b = np.frombuffer(row["codes2"], np.uint64).reshape(-1, law.width)
    i, j = _close_pairs(a, b, law.most)
    return np.r_[ids, np.frombuffer(row["ids2"], np.int64)], i, j + len(a), _apart(a[i], b[j])


def _links(law: Law):
    def links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Pairs that connect what close pairs connect."""
        for batch in batches:
            out_a, out_b = [], []
            for row in batch.to_pylist():
                ids, i, j, _ = _pairs_of(row, law)
                root = forest(len(ids), i, j)
                moved = np.flatnonzero(root != np.arange(len(ids)))
                out_a.append(ids[moved])
                out_b.append(ids[root[moved]])
            if out_a:
                yield pa.RecordBatch.from_pydict({"a": np.concatenate(out_a), "b": np.concatenate(out_b)})

    return links


TRIES = (
    "codes binary, ids binary, codes2 binary, ids2 binary, tried binary, members array<long>,"
    " a array<long>, b array<long>"
)


def _tries(law: Law, forests: int):
    longs = pa.list_(pa.int64())
    # Given, as a batch may hold nothing but nulls.
    kinds = dict.fromkeys(("codes", "ids", "codes2", "ids2", "tried"), pa.binary()) | dict.fromkeys(("members", "a", "b"), longs)

    def tries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Forests of pairs not tried yet, of ends in different groups; the members of pairs that are left, with what was tried of them."""
        for batch in batches:
            out: dict = {n: [] for n in kinds}
            for row in batch.to_pylist():
                ids, i, j, cost = _pairs_of(row, law)
                n = len(ids)
                tried = np.frombuffer(row["tried"] or b"", np.int32).astype(np.int64)
                group = np.arange(n)
                if row["labels"] is not None:
                    # Groups are what is to be connected.
                    group = np.unique(np.array(row["labels"], np.int64), return_inverse=True)[1]
                    left = (group[i] != group[j]) & ~np.isin(i * n + j, tried)
                    i, j, cost = i[left], j[left], cost[left]
                if not len(i):
                    continue
                places = []
                for _ in range(forests):
                    tree = spanning(int(group.max()) + 1, group[i], group[j], cost)
                    places.append(i[tree] * n + j[tree])
                    i, j, cost = np.delete(i, tree), np.delete(j, tree), np.delete(cost, tree)
                    if not len(i):
                        break
                new = np.concatenate(places)
                out["a"].append(ids[new // n])
                out["b"].append(ids[new % n])
                if not len(i):
                    for name in ("codes", "ids", "codes2", "ids2", "tried", "members"):
                        out[name].append(None)
                    continue
                stay = np.unique(np.r_[i, j])
                at = np.full(n, -1)
                at[stay] = np.arange(len(stay))
                tried = np.r_[tried, new]
                x, y = at[tried // n], at[tried % n]
                both = (x >= 0) & (y >= 0)
                out["tried"].append((x[both] * len(stay) + y[both]).astype(np.int32).tobytes())
                out["members"].append(ids[stay])
                first = len(row["ids"]) // 8
                for side, places in (("", stay[stay < first]), ("2", stay[stay >= first] - first)):
                    whole = row["codes" + side]
                    code = None if whole is None else np.frombuffer(whole, np.uint64).reshape(-1, law.width)
                    out["codes" + side].append(None if code is None else code[places].tobytes())
                    of = row["ids" + side]
                    out["ids" + side].append(None if of is None else np.frombuffer(of, np.int64)[places].tobytes())
            if out["a"]:
                yield pa.RecordBatch.from_pydict({n: pa.array(out[n], kind) for n, kind in kinds.items()})

    return tries


def meetings(codes: DataFrame, law: Law) -> tuple[DataFrame, DataFrame]:
    """The blocks, each with a number ``block``, and the numbers ``x`` and ``y`` of those that meet."""
    small_batches(codes.sparkSession)
    starts = [sum(law.parts[:k]) for k in range(len(law.parts))]
    places = []
    for part, (word, order) in enumerate(law.orders()):
        to = {k: sum(law.parts[x] for x in order[:n]) for n, k in enumerate(order)}
        moves = F.array(*(F.lit(BITS - to[k] - bits) for k, bits in enumerate(law.parts)))
        places.append(F.struct(F.lit(part).alias("part"), F.lit(word).alias("word"), moves.alias("moves")))
    # Packed, as an array of longs would be more than half again as large.
    packed = F.concat(*(F.unhex(F.lpad(F.hex(F.col("code")[n]), 16, "0")) for n in range(law.width)))
    entries = codes.withColumn("packed", packed)
    entries = entries.select("code", "packed", "id", F.explode(F.array(*places)).alias("p")).select("code", "packed", "id", "p.*")
    # Each part of the word is cut out and put where the order has it.
    moved = " | ".join(
        f"shiftleft(shiftrightunsigned(code[word], {BITS - start - bits}) & {(1 << bits) - 1 if bits < BITS else -1}L, moves[{k}])"
        for k, (start, bits) in enumerate(zip(starts, law.parts))
    )
    entries = entries.withColumn("rank", F.expr(moved))
    # Step by step, as a single expression would double with every step.
    for shift in (1, 2, 4, 8, 16, 32):
        entries = entries.withColumn("rank", F.expr(f"rank ^ shiftrightunsigned(rank, {shift})"))
    # As a signed value that sorts like the unsigned one.
    entries = entries.withColumn("rank", F.col("rank").bitwiseXOR(F.lit(-(1 << 63))))
    entries = entries.select("part", "rank", F.col("packed").alias("code"), "id")
    parts = int(codes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    blocks = stored(
        entries.repartitionByRange(parts, "part", "rank", "id")
        .sortWithinPartitions("part", "rank", "id")
        .mapInArrow(_blocks(law), BLOCK)
        .withColumn("block", F.monotonically_increasing_id()),
        "blocks",
    )
    x, y = blocks.alias("x"), blocks.alias("y")
    differ = sum(
        F.bit_count(
            F.col("x.bits")[n].bitwiseXOR(F.col("y.bits")[n])
            .bitwiseAND(F.col("x.mask")[n])
            .bitwiseAND(F.col("y.mask")[n])
        )
        for n in range(law.width)
    )
    pairs = x.join(
        y,
        (F.col("x.part") == F.col("y.part"))
        & (F.col("x.pattern") == F.col("y.pattern"))
        & (F.col("x.block") < F.col("y.block"))
        & (differ <= law.most),
    )
    return blocks, pairs.select(F.col("x.block").alias("x"), F.col("y.block").alias("y"))


PLAIN = "block", "codes", "ids"


def _met(blocks: DataFrame, meet: DataFrame) -> DataFrame:
    """Meetings with what their blocks hold; nothing of a second block where ``y`` is null."""
    first = blocks.select(F.col("block").alias("x"), *(c for c in blocks.columns if c != "block"))
    second = blocks.select(F.col("block").alias("y"), *(F.col(c).alias(c + "2") for c in blocks.columns if c != "block"))
    return meet.join(first, "x").join(second, "y", "left")


def links(codes: DataFrame, law: Law = EXACT) -> DataFrame:
    """Edges that connect, directly or through others, all ids with close codes.

    ``codes``: a stored table of distinct fingerprints ``code``, each with its long ``id``.
    """
    blocks, meet = meetings(codes, law)
    none = F.lit(None).cast("binary")
    inside = blocks.select("codes", "ids", none.alias("codes2"), none.alias("ids2"))
    across = _met(blocks.select(*PLAIN), meet).select("codes", "ids", "codes2", "ids2")
    return inside.union(across).mapInArrow(_links(law), EDGE)


def checked_groups(codes: DataFrame, sets: DataFrame, law: Law) -> DataFrame:
    """Groups (``node``, ``component``) of ids that close codes link whose sets share ``law.least``.

    ``codes`` as in ``links``; ``sets``: rows of ``id``, ``digest`` and ``shingles``,
    repeats too.
    """
    blocks, meet = meetings(codes, law)
    plain, forests = blocks.select(*PLAIN), FORESTS
    # In the first round blocks are taken where they lie; only those that meet others are moved.
    none = F.lit(None).cast("binary")
    inside = plain.select("codes", "ids", none.alias("codes2"), none.alias("ids2"))
    work = inside.union(_met(plain, meet).select(*inside.columns)).select(
        "*", F.lit(None).cast("array<long>").alias("labels"), none.alias("tried")
    )
    groups = before = tries = None
    while True:
        last_tries, tries = tries, stored(
            work.mapInArrow(_tries(law, forests), TRIES).withColumn("row", F.monotonically_increasing_id()), "tries"
        )
        drop(last_tries)
        edges = tries.select(F.explode(F.arrays_zip("a", "b")).alias("e")).select("e.a", "e.b")
        ends = F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")
        edges = edges.filter("a <> b").select(*ends).distinct()
        if before is not None:
            # Tried in another block.
            edges = edges.join(before, ["a", "b"], "left_anti")
        edges = stored(edges, "candidates")
        before = edges if before is None else before.union(edges)
        if groups is None:
            # Every end of a later candidate is one of the first already, as a forest reaches all that are close to any.
            nodes = edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct()
            sets = stored(sets.join(nodes, "id", "left_semi").dropDuplicates(["id", "digest"]), "sets")
        new = checked(edges, sets, law.least)
        # What passed before is held by its groups; only new links can join these.
        links = new if groups is None else groups.select(F.col("node").alias("a"), F.col("component").alias("b")).union(new)
        groups = components(links)
        # Only the members of pairs that are left go on.
        left = tries.filter("members is not null")
        if left.isEmpty():
            return groups
        labels = (
            left.select("row", F.posexplode("members").alias("at", "node"))
            .join(groups, "node", "left")
            .groupBy("row")
            .agg(F.sort_array(F.collect_list(F.struct("at", F.coalesce("component", "node").alias("label")))).alias("l"))
            .select("row", F.col("l.label").alias("labels"))
            # Where all are in one group nothing is left.
            .filter(F.array_min("labels") != F.array_max("labels"))
        )
        work = left.join(labels, "row").select("codes", "ids", "codes2", "ids2", "labels", "tried")
        forests *= 2


def checked(edges: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    """The stored edges whose ends share ``least`` of their ``shingles`` (in common over all, no repeats).

    ``sets``: rows of ``id`` and ``shingles``, more than one where an id has several
    texts. Pairs whose sets differ too much in size fail before any set is moved.
    """
    sizes = sets.groupBy("id").agg(F.min(F.size("shingles")).alias("low"), F.max(F.size("shingles")).alias("high"))
    near = edges.join(sizes.select(F.col("id").alias("a"), F.col("low").alias("la"), F.col("high").alias("ha")), "a")
    near = near.join(sizes.select(F.col("id").alias("b"), F.col("low").alias("lb"), F.col("high").alias("hb")), "b")
    fits = (F.col("ha") + 1e-9 >= F.col("lb") * least) & (F.col("hb") + 1e-9 >= F.col("la") * least)
    edges = near.filter(fits).select("a", "b")
    both = edges.join(sets.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a").join(
        sets.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b"
    )
    common, sizes = F.size(F.array_intersect("x", "y")), F.size("x") + F.size("y")
    return both.filter(common * (1 + least) + 1e-9 >= sizes * least).select("a", "b")


def near_groups(df: DataFrame, id: str = "doc_id", text: str = "text", law: Law = EXACT) -> DataFrame:
    """One row per document: ``id``, ``fingerprint`` (longs), ``component`` (its group's smallest id)."""
    texts = df.select(F.col(id).cast("long").alias("id"), F.col(text).alias("_text"))
    key = ["fingerprint"]
    if law.least:
        key.append("digest")
        rows = sketches(texts, "_text", law).withColumn("digest", F.xxhash64("shingles")).drop("_text")
    else:
        rows = fingerprints(texts, "_text", law.words, law.width).select("id", "fingerprint")
    rows = stored(rows, "fingerprints")
    firsts = stored(rows.groupBy(*key).agg(F.min("id").alias("id")), "firsts")
    codes = firsts.filter("id is not null").select(F.col("fingerprint").alias("code"), "id")
    if law.least:
        groups = checked_groups(codes, rows.select("id", "digest", "shingles"), law)
    else:
        groups = components(links(codes, exact_law(firsts.count()) if law == EXACT else law))
    labels = firsts.join(groups, F.col("id") == F.col("node"), "left").select(
        *key, F.coalesce("component", "id").alias("component")
    )
    return rows.join(labels, key).select("id", "fingerprint", "component")
