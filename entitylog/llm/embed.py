"""Near-duplicate vectors by p-stable hashing and exact cosine checks.

Vectors are normalised and projected on Gaussian directions; a projection is
shifted and cut into intervals of one width, and ``bits`` such intervals form
the bucket of a vector in one of several tables. Both follow from the number of
vectors (``sized``): random directions share a bucket with 3 in 100,000 per table
at 8 bits and a quarter to a third of that with each further bit, so four times
the vectors get one more bit, which keeps a bucket's strangers few; and as many
tables as let pairs of cosine 0.98, 0.2 apart, share a bucket with a probability of
0.996, closer pairs more surely.

Only vectors with the same label and length meet; a label may be of any type that
has a text. Equal vectors of one label are one entry with a count, and an entry has
a number of its own: ids may repeat, within a label or not. Buckets of one entry are dropped before vectors are moved. The
others are cut into blocks of at most ``BATCH_ROWS`` entries, and every block
meets itself and the other blocks of its bucket, so a bucket of any size is
spread over tasks and no cap applies. A pair found in several tables counts in
the first only. Blocks emit counts and a spanning forest, never pairs.

Vectors that are null, zero or hold null or non-finite components, and rows
without label or id, link with nothing. Repeated rows are vectors of their own.
Extra columns are not read. An empty table gives none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entitylog.llm.common import components, small_batches, spread_join, stored
from entitylog.llm.simhash import forest

WIDTH, SEED = 1.0, 20240607
#: Bits of a bucket for so many vectors; each factor of four takes one more.
BITS, BITS_AT = 8, 60_000
#: Least probability that a pair of the least cosine shares a bucket.
RECALL = 0.996


def sized(n: int, least: float = 0.98, width: float = WIDTH) -> tuple[int, int]:
    """Bits of a bucket and number of tables for n vectors."""
    bits = BITS + max(0, math.ceil(math.log(n / BITS_AT, 4))) if n else BITS
    apart = math.sqrt(2 - 2 * least)
    # The chance that a Gaussian projection of two points so far apart stays in one interval.
    ratio = width / apart
    same = math.erf(ratio / math.sqrt(2)) - 2 / (math.sqrt(2 * math.pi) * ratio) * (1 - math.exp(-ratio * ratio / 2))
    return bits, math.ceil(math.log(1 - RECALL) / math.log(1 - same**bits))


def _unit(flat: np.ndarray, dim: int) -> np.ndarray:
    x = flat.astype(np.float64).reshape(-1, dim)
    # By the largest component first, so that no square overflows or vanishes.
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _hasher(width: float, bits: int, tables: int, seed: int):
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, tuple] = {}
        for batch in batches:
            lists = batch.column("embedding")
            lengths = np.asarray(lists.value_lengths())
            codes: list = [None] * len(lists)
            for dim in np.unique(lengths).tolist():
                if dim not in planes:
                    rng = np.random.default_rng([seed, dim])
                    planes[dim] = (
                        rng.standard_normal((dim, tables * bits)),
                        rng.uniform(0, width, tables * bits),
                        rng.integers(1, 1 << 62, (tables, bits)) * 2 + 1,
                    )
                directions, shift, odd = planes[dim]
                at = np.flatnonzero(lengths == dim)
                x = _unit(lists.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False), dim)
                cells = np.floor((x @ directions + shift) / width).astype(np.int64)
                with np.errstate(over="ignore"):
                    mixed = (cells.reshape(-1, tables, bits) * odd).sum(axis=2)
                for n, row in zip(at.tolist(), mixed):
                    codes[n] = row
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(codes, pa.list_(pa.int64()))], [*batch.schema.names, "codes"]
            )

    return hashed


BUCKET = ["label", "dim", "at", "code"]
BLOCK = "label string, dim int, at int, code long, first long, ids binary, counts binary, vectors binary, codes binary"


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = [batch.column(c).to_numpy(zero_copy_only=False) for c in BUCKET]
        new = np.zeros(batch.num_rows - 1, bool)
        for key in keys:
            new |= key[1:] != key[:-1]
        starts = np.flatnonzero(np.r_[True, new])
        ends = np.r_[starts[1:], batch.num_rows]
        ids, counts = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("id", "n"))
        vectors, codes = batch.column("embedding"), batch.column("codes")
        piece = lambda c, a, b: c.slice(a, b - a).flatten().to_numpy(zero_copy_only=False).tobytes()
        cuts = list(zip(starts.tolist(), ends.tolist()))
        yield pa.RecordBatch.from_pydict(
            {
                **{c: pa.array(k[starts], t) for c, k, t in zip(BUCKET, keys, (pa.string(), pa.int32(), pa.int32(), pa.int64()))},
                "first": ids[starts],
                "ids": [ids[a:b].tobytes() for a, b in cuts],
                "counts": [counts[a:b].tobytes() for a, b in cuts],
                "vectors": [piece(vectors, a, b) for a, b in cuts],
                "codes": [piece(codes, a, b) for a, b in cuts],
            }
        )


FOUND = "a long, b long, links long"


def _compare(least: float, tables: int):
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def block(dim, ids, counts, vectors, codes):
            return (
                np.frombuffer(ids, np.int64), np.frombuffer(counts, np.int64),
                _unit(np.frombuffer(vectors, np.float32), dim),
                np.frombuffer(codes, np.int64).reshape(-1, tables),
            )

        for batch in batches:
            out: list[tuple] = []
            for dim, at, *parts in zip(*(c.to_pylist() for c in batch.columns)):
                ids, counts, x, codes = block(dim, *parts[:4])
                if len(parts) > 4:
                    ids2, counts2, y, codes2 = block(dim, *parts[4:])
                    i, j = np.nonzero(x @ y.T >= least)
                    j = j + len(ids)
                    ids, counts, codes = np.r_[ids, ids2], np.r_[counts, counts2], np.r_[codes, codes2]
                elif len(ids) < 2:
                    continue
                else:
                    i, j = np.nonzero(np.triu(x @ x.T >= least, 1))
                if not len(i):
                    continue
                root = forest(len(ids), i, j)
                fresh = ~(codes[i, :at] == codes[j, :at]).any(axis=1)
                links = np.zeros(len(ids), np.int64)
                np.add.at(links, i[fresh], counts[j[fresh]])
                np.add.at(links, j[fresh], counts[i[fresh]])
                own = np.flatnonzero((links > 0) | (root != np.arange(len(ids))))
                out.append((ids[own], ids[root[own]], links[own]))
            if out:
                a, b, n = (np.concatenate(c) for c in zip(*out))
                yield pa.RecordBatch.from_pydict({"a": a, "b": b, "links": n})

    return compare


def near_vectors(
    df: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    least: float = 0.98,
    width: float = WIDTH,
    bits: int | None = None,
    tables: int | None = None,
    seed: int = SEED,
) -> DataFrame:
    """One row per vector: ``id``, ``n_links``, ``component`` (smallest id it reaches by links).

    ``bits`` and ``tables`` follow from the number of vectors if they are not given.
    """
    small_batches(df.sparkSession)
    rows = df.select(
        F.col(id).cast("long").alias("id"),
        F.col(vector).cast("array<float>").alias("embedding"),
        F.col(label).cast("string").alias("label"),
    )
    sound = F.col("id").isNotNull() & F.col("label").isNotNull() & F.expr(
        "embedding is not null and size(embedding) > 0"
        " and forall(embedding, x -> x is not null and not isnan(x) and abs(x) < float('infinity'))"
        " and exists(embedding, x -> x != 0)"
    )
    # Numbered where they are stored, so that a number stays with its entry.
    entries = stored(
        rows.filter(sound).groupBy("label", "embedding")
        .agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n"))
        .withColumn("id", F.monotonically_increasing_id()),
        "entries",
    )
    if bits is None or tables is None:
        found = sized(entries.count(), least, width)
        bits, tables = bits or found[0], tables or found[1]
    hashed = stored(
        entries.select("label", F.size("embedding").alias("dim"), "id", "n", "embedding").mapInArrow(
            _hasher(width, bits, tables, seed),
            "label string, dim int, id long, n long, embedding array<float>, codes array<long>",
        ),
        "vectors",
    )
    placed = hashed.select("label", "dim", "id", F.posexplode("codes").alias("at", "code"))
    busy = placed.groupBy(*BUCKET).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").drop("_n")
    members = placed.join(busy, BUCKET, "left_semi").join(hashed.drop("label", "dim"), "id")
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*BUCKET, "id"]
    blocks = stored(
        members.select(*order, "n", "embedding", "codes")
        .repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .mapInArrow(_blocks, BLOCK),
        "buckets",
    )
    content = ["ids", "counts", "vectors", "codes"]
    compare = _compare(least, tables)
    inside = blocks.select("dim", "at", *content).mapInArrow(compare, FOUND)
    x, y = blocks.alias("x"), blocks.alias("y")
    same = F.col("x.first") < F.col("y.first")
    for c in BUCKET:
        same = same & (F.col(f"x.{c}") == F.col(f"y.{c}"))
    across = (
        x.join(y, same)
        .select("x.dim", "x.at", *(f"x.{c}" for c in content), *(F.col(f"y.{c}").alias(f"{c}2") for c in content))
        .mapInArrow(compare, FOUND)
    )
    found = stored(inside.union(across), "found")
    groups = components(found.select("a", "b"))
    linked = found.groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    labels = (
        entries.join(linked, "id", "left")
        .join(groups, F.col("id") == F.col("node"), "left")
        .select(
            "label",
            "embedding",
            "first_id",
            "n",
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("component", "id").alias("group"),
        )
    )
    smallest = labels.groupBy("group").agg(F.min("first_id").alias("component"))
    # A group may hold any share of the entries.
    labels = stored(spread_join(stored(labels, "labels"), smallest, ["group"]), "labels")
    usable = rows.withColumn("_sound", sound)
    # So may the copies of one vector have any share of the rows.
    key = ["label", "embedding"]
    sizes, total = labels.select(*key, F.col("n").alias("_n")), labels.agg(F.sum("n")).first()[0] or 0
    to = labels.select(*key, "n_links", "component")
    return (
        spread_join(usable.filter("_sound"), to, key, "inner", sizes, total).select("id", "n_links", "component")
    ).union(
        usable.filter("not coalesce(_sound, false)").select(
            "id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component")
        )
    )
