"""Helpers shared by the text operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from entitylog.session import remove

#: White space that separates words: space and \x09 to \x0D.
SPACE = " \t\n\x0b\x0c\r"
#: One word, for Spark's and for Python's regular expressions alike.
WORD = "[^\\x20\\x09-\\x0D]+"
#: Rows of text in an Arrow batch, so that a batch stays small with long texts too.
BATCH_ROWS = 500


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it.

    A session on one machine that names none gets one below its warehouse.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir names no shared folder")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/scratch"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """The same rows, read from a table written to the shared folder.

    This cuts the lineage: a lost executor costs a read, not the work before.
    """
    path = f"{shared_folder(df.sparkSession)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if _WRITTEN:
        _WRITTEN[-1].append(path)
    rows = df.sparkSession.read.schema(df.schema).parquet(path)
    rows._stored_at = path
    return rows


#: Paths of the tables stored inside each open ``passing``, the innermost last.
_WRITTEN: list[list[str]] = []


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """Tables stored inside are removed at the end; what is to last must be stored outside, from rows computed by then."""
    _WRITTEN.append([])
    try:
        yield
    finally:
        for path in _WRITTEN.pop():
            remove(spark, path)


def lasting(df: DataFrame, name: str) -> DataFrame:
    """``stored`` beyond the end of ``passing``: of what surrounds it, if anything does."""
    here = _WRITTEN.pop() if _WRITTEN else None
    try:
        return stored(df, name)
    finally:
        if here is not None:
            _WRITTEN.append(here)


def drop(df: DataFrame | None) -> None:
    """Remove a stored table that nothing reads any more."""
    if df is not None:
        remove(df.sparkSession, df._stored_at)


def small_batches(spark: SparkSession) -> None:
    """Bound the rows of an Arrow batch for operators that take whole texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def source_key(source: str = "source") -> Column:
    """A key without nulls that sorts like the source, null last."""
    return F.when(F.col(source).isNull(), "1").otherwise(F.concat(F.lit("0"), F.col(source)))


def running(
    df: DataFrame, keys: Sequence[str], bucket: str, order: Sequence[str], value: Column, into: str
) -> DataFrame:
    """Adds the sum of ``value`` over a key's earlier rows, by ``bucket`` and then ``order``.

    A key with any share of the rows is spread over its buckets: rows are summed
    inside a bucket, and one row per key and bucket carries the sums on. The
    columns named must not be null.
    """
    rows = df.withColumn("_value", value.cast("long"))
    sums = rows.groupBy(*keys, bucket).agg(F.sum("_value").alias("_sum"))
    before = Window.partitionBy(*keys).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*keys, bucket, F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    inside = (
        Window.partitionBy(*keys, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    rows = rows.withColumn("_inside", F.coalesce(F.sum("_value").over(inside), F.lit(0)))
    return (
        rows.join(sums, [*keys, bucket])
        .withColumn(into, F.col("_before") + F.col("_inside"))
        .drop("_value", "_before", "_inside")
    )


#: A key is spread where it has over one of this many rows, so at most as many keys are.
SHARES = 1000


def spread_join(
    big: DataFrame, small: DataFrame, keys: Sequence[str], how: str = "inner", sizes: DataFrame | None = None, total: int | None = None
) -> DataFrame:
    """``big`` joined with ``small``, which has at most one row per key, whatever a key's share of ``big``.

    ``big`` should be stored, as it is read twice. Keys with over one of ``SHARES`` rows
    of ``big`` (and over eight) are dealt over salts in proportion to their rows, and
    ``small`` is repeated for these: at most ``SHARES`` keys and twice as many repeated
    rows at any size, so the list of them is broadcast. ``how`` is inner or left; null
    keys find nothing. ``sizes`` (keys and ``_n``) and ``total`` are the rows of each key
    and of all, where they are known.
    """
    least = max((big.count() if total is None else total) / SHARES, 8)
    sizes = big.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")) if sizes is None else sizes
    hot = (
        sizes.filter(F.col("_n") > least)
        .select(*keys, F.ceil(F.col("_n") / least).cast("int").alias("_salts"))
    )

    def marked(side: DataFrame) -> DataFrame:
        names = {k: f"_hot_{n}" for n, k in enumerate(keys)}
        same = None
        for key, name in names.items():
            one = side[key].eqNullSafe(F.col(name))
            same = one if same is None else same & one
        named = hot.select(*(F.col(k).alias(name) for k, name in names.items()), "_salts")
        return side.join(F.broadcast(named), same, "left").drop(*names.values())

    salt = F.pmod(F.monotonically_increasing_id(), F.coalesce("_salts", F.lit(1))).cast("int")
    left = marked(big).withColumn("_salt", salt).drop("_salts")
    right = marked(small).withColumn(
        "_salt", F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    ).drop("_salts")
    return left.join(right, [*keys, "_salt"], how).drop("_salt")


def ranked(df: DataFrame, key: str, order: Sequence[str | Column], into: str) -> DataFrame:
    """Adds the place, from 1, of each row inside its key in the given order; a key may have any share of the rows.

    Rows are sorted over all tasks and stored; a row's place is counted inside its
    task, and one row per key and task carries the counts on.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = stored(
        df.repartitionByRange(parts, key, *order)
        .sortWithinPartitions(key, *order)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.spark_partition_id()),
        "ranked",
    )
    runs = rows.groupBy(key, "_part").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select(key, "_part", (F.coalesce(before, F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    return spread_join(rows, runs, [key, "_part"]).withColumn(into, F.col("_at") + F.col("_shift")).drop(
        "_at", "_part", "_shift"
    )


def components(edges: DataFrame) -> DataFrame:
    """Connected components of an undirected graph given as columns ``a`` and ``b``.

    Returns one row per node that reaches a smaller one: ``node`` and
    ``component``, the smallest node it reaches. Edges with a null end are
    ignored. Large and small stars are made in turn until nothing changes, a
    number of rounds that grows with the logarithm of the longest path. Every
    round is written to the shared folder; nothing but its row count and a
    checksum comes to the driver.
    """
    a, b = F.col("a"), F.col("b")
    now = stored(
        edges.filter(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(),
        "edges",
    )
    seen = None
    least = (F.min("b").alias("m"), F.count(F.lit(1)).alias("_n"))
    while True:
        mark = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        if mark == seen or mark[0] == 0:
            return now.select(a.alias("node"), b.alias("component"))
        seen = mark
        # The centre of a large group has most of its edges: these are spread.
        both = now.union(now.select(b.alias("a"), a.alias("b")))
        ends = both.groupBy("a").agg(*least)
        joined = spread_join(both, ends.select("a", F.least("a", "m").alias("m")), ["a"], "inner", ends.select("a", "_n"), 2 * mark[0])
        large = stored(joined.filter(b > a).select(b.alias("a"), F.col("m").alias("b")).distinct(), "stars")
        ends = large.groupBy("a").agg(*least)
        small = spread_join(large, ends.select("a", "m"), ["a"], "inner", ends.select("a", "_n"), large.count()).select(
            F.explode(
                F.array(*(F.struct(end.alias("a"), F.col("m").alias("b")) for end in (a, b)))
            ).alias("e")
        )
        before, now = now, stored(small.select("e.a", "e.b").filter(a != b).distinct(), "edges")
        drop(before)
        drop(large)
