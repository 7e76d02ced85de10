"""Snapshot tables: what the polled system listed, round by round.

On disk a snapshot is a directory ``<root>/<kind>/data/snapshot_id=<n>``, and a
row in ``<root>/<kind>/rounds`` once it is complete. Rounds are numbered
consecutively. A round that listed nothing has a row there and no data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from entitylog.functions.canon import tidy
from entitylog.schema import LONG, PARTITION, SNAPSHOT, struct
from entitylog.session import scratch

ROUND = struct(snapshot_id=LONG)


def data_path(root: str, kind: str) -> str:
    return f"{root}/{kind.lower()}/data"


def rounds_path(root: str, kind: str) -> str:
    return f"{root}/{kind.lower()}/rounds"


def read_snapshots(
    spark: SparkSession,
    root: str,
    kind: str,
    rounds: tuple[int, int] | None = None,
    format: str = "parquet",
) -> DataFrame:
    """Snapshot rows of one kind, optionally of a range of rounds only.

    Other producers may store their rows as JSON; ours are parquet.
    """
    df = spark.read.schema(SNAPSHOT[kind]).format(format).load(data_path(root, kind))
    if rounds is not None:
        df = df.filter(F.col("snapshot_id").between(*rounds))
    return df


def write_snapshot(df: DataFrame, root: str, kind: str, round: int) -> None:
    """Store the rows of one round and then mark the round as complete.

    A round with no rows leaves an empty directory, so that it can be read.
    """
    spark = df.sparkSession
    rows = tidy(df, SNAPSHOT[kind]).drop("snapshot_id")
    rows.write.mode("overwrite").parquet(f"{data_path(root, kind)}/snapshot_id={round}")
    mark = spark.range(round, round + 1, 1, 1).toDF("snapshot_id")
    mark.write.mode("append").json(rounds_path(root, kind))


def write_snapshots(df: DataFrame, root: str, kind: str, rounds: tuple[int, int]) -> None:
    """Store the rows of several rounds, a directory each, and mark all of them.

    A round's directory is replaced, so a write may be tried again; a round marked
    twice counts once.
    """
    # Gathered by round into files of a useful size, a large round into several.
    rows = tidy(df, SNAPSHOT[kind]).hint("rebalance", "snapshot_id")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "snapshot_id"
    ).parquet(data_path(root, kind))
    first, last = rounds
    marks = df.sparkSession.range(first, last + 1, 1, 1).toDF("snapshot_id")
    marks.write.mode("append").json(rounds_path(root, kind))


def round_bounds(df: DataFrame, round: str = "snapshot_id") -> tuple[int, int] | None:
    """First and last round in a table: one row to the driver."""
    first, last = df.agg(F.min(round), F.max(round)).first()
    return None if first is None else (first, last)


def number_rounds(snaps: DataFrame, listed: DataFrame, round: str = "snapshot_id") -> DataFrame:
    """All rows with ``round_no`` 0, 1, ... for rounds whose ids are not consecutive.

    ``listed`` has one row per poll, also for polls that listed nothing. Ids are
    sorted in ranges and numbered in each; the ranges' few counts are added up.
    The ranges are stored, so that all that is made of them agrees. Rows of rounds
    that are not listed, or have no id, get no number: ``round_no`` is null.
    """
    spark = listed.sparkSession
    ids = listed.select(round).filter(F.col(round).isNotNull()).distinct()
    path = scratch(spark, "rounds")
    ids.repartitionByRange(round).withColumn("_part", F.spark_partition_id()).write.parquet(path)
    ids = spark.read.parquet(path)
    whole = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = ids.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(whole), F.lit(0)).alias("_before")
    )
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(round)) - 1
    numbered = ids.withColumn("_inside", inside).join(before, "_part")
    numbered = numbered.select(round, (F.col("_before") + F.col("_inside")).cast("long").alias("round_no"))
    return snaps.join(numbered, round, "left")


def topic_names(snap: DataFrame, name: str = "name") -> DataFrame:
    """The names a snapshot lists."""
    return snap.select(name).distinct()


def brokers_of(snap: DataFrame, nodes: str = "nodes") -> DataFrame:
    """One broker row per node of a cluster listing; its id is the node id as text."""
    others = [c for c in snap.columns if c in ("snapshot_id",)]
    return snap.select(*others, F.explode(nodes).alias("node")).select(
        *others, F.col("node.id").cast("string").alias("id"), "node"
    )


def replica_lists(
    rows: DataFrame, keys: Sequence[str], member: str, into: str = "replicas"
) -> DataFrame:
    """Distinct members per key as a sorted list.

    Repeats are removed first, on key and member together, so a key with any
    share of the rows reaches the grouping with its distinct members only.
    """
    return (
        rows.select(*keys, member)
        .distinct()
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_list(member)).alias(into))
    )


def build_descriptions(
    partitions: DataFrame,
    topic: str = "topic",
    internal: str = "internal",
    fields: Sequence[str] = tuple(PARTITION.fieldNames()),
) -> DataFrame:
    """Flat partition rows as one description per topic, partitions by id.

    The first field is the partition id. The description is one value in a row,
    so its size is that of the topic's partition list; jobs that need no such
    value use the flat rows instead.
    """
    return (
        partitions.groupBy(topic)
        .agg(
            F.max(internal).alias("internal"),
            F.sort_array(F.collect_list(F.struct(*fields))).alias("partitions"),
        )
        .select(topic, F.struct("internal", "partitions").alias("description"))
    )


def description_chunks(
    partitions: DataFrame,
    size: int = 1024,
    topic: str = "topic",
    internal: str = "internal",
    fields: Sequence[str] = tuple(PARTITION.fieldNames()),
) -> DataFrame:
    """Flat partition rows as pieces of descriptions: topic, ``chunk``, ``internal`` and ``partitions`` by id.

    A piece holds the partitions whose ids, the first field, fall into a range of
    ``size``, so that a topic with any share of all partitions is spread over its
    pieces. Comparing pieces finds the same changed topics as comparing descriptions.
    """
    chunk = F.floor(F.col(fields[0]) / size).cast("long")
    return partitions.groupBy(F.col(topic).alias("topic"), chunk.alias("chunk")).agg(
        F.max(internal).alias("internal"), F.sort_array(F.collect_list(F.struct(*fields))).alias("partitions")
    )


def assembled(chunks: DataFrame) -> DataFrame:
    """Pieces as one description per topic, for a sink that wants it whole: as large as the topic's list."""
    return (
        chunks.groupBy("topic")
        .agg(F.max("internal").alias("internal"), F.sort_array(F.collect_list(F.struct("chunk", "partitions"))).alias("c"))
        .select("topic", F.struct("internal", F.flatten(F.col("c.partitions")).alias("partitions")).alias("description"))
    )


def config_of_rows(
    entries: DataFrame,
    keys: Sequence[str],
    name: str = "name",
    value: str = "value",
    order: str = "ordinal",
) -> DataFrame:
    """Config entry rows as one map per key; of entries with one name the last wins."""
    last = entries.groupBy(*keys, name).agg(F.max_by(value, order).alias(value))
    return last.groupBy(*keys).agg(
        F.map_from_entries(F.collect_list(F.struct(name, value))).alias("config")
    )
