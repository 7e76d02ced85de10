"""Current state and counters kept up to date from a log stream.

Spark aggregates each micro-batch before shuffling it, so a key with any share
of the log reaches the state store as one row per input partition. The store
keeps, per key, the last event and whether it removed the key: an older event
that arrives later changes nothing.

The state can be read in two ways. ``keep_state`` writes nothing but the stream's own
checkpoint, and ``served_state`` reads the rows of any batch it still holds from the
state store, so what is read is as large as the state, however long the log. With
``write_changes`` each batch writes the rows it changed to ``<path>/batch=<n>``,
replacing an earlier attempt at the same batch, for readers that follow the changes;
reading takes the last row of each key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import StructType

from entitylog.operators.state import latest, one_by_one


def follow_state(
    log: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    op: str = "op",
    ignore: Sequence[str] = (),
    remove: Sequence[str] = (),
) -> DataFrame:
    """The last event per key of a log stream, with ``_gone`` for removed keys."""
    if ignore:
        log = log.filter(~F.col(op).isin(list(ignore)))
    gone = F.col(op).isin(list(remove)) if remove else F.lit(False)
    return latest(log.withColumn("_gone", gone), keys, order, [*values, "_gone"])


def follow_counters(log: DataFrame, by: Sequence[str] = ("entity_type", "op")) -> DataFrame:
    """Running event counts of a log stream."""
    return log.groupBy(*by).agg(F.sum(F.lit(1.0)).alias("total"))


def write_changes(
    rows: DataFrame, path: str, checkpoint: str, once: bool = False, interval: str = "30 seconds"
) -> StreamingQuery:
    """Keep the changed rows of a streaming aggregate, batch by batch."""

    def step(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{path}/batch={batch}")

    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return (
        rows.writeStream.outputMode("update")
        .foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def keep_state(
    rows: DataFrame, checkpoint: str, once: bool = False, interval: str = "30 seconds"
) -> StreamingQuery:
    """Keep a streaming aggregate in its state store alone."""
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return (
        rows.writeStream.outputMode("update")
        .format("noop")
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def served_state(
    spark: SparkSession,
    checkpoint: str,
    schema: StructType,
    keys: Sequence[str],
    order: Sequence[str],
    batch: int | None = None,
) -> DataFrame:
    """Current rows from the state store of a ``follow_state`` stream, without removed keys.

    ``schema`` is that stream's. ``batch`` reads the state as it was after a batch; the
    store keeps the last hundred unless it is set otherwise.
    """
    reader = spark.read.format("statestore")
    if batch is not None:
        reader = reader.option("batchId", batch)
    types = {f.name: f.dataType for f in schema.fields}
    values = [f.name for f in schema.fields if f.name not in (*keys, *order)]
    # The store names its fields after what the aggregates need: each value beside its
    # order, or one row beside its order. They are named anew by their places.
    if one_by_one(schema, order, values):
        held = StructType().add(order[0], types[order[0]])
        for value in values:
            held = held.add(value, types[value]).add(f"_{value}_at", types[order[0]])
        found = F.col("value").cast(held)
    else:
        last = StructType([schema[c] for c in (*order, *values)])
        at = types[order[0]] if len(order) == 1 else StructType([schema[c] for c in order])
        found = F.col("value").cast(StructType().add("_last", last).add("_at", at))["_last"]
    rows = reader.load(checkpoint).select(
        *(F.col("key")[k].alias(k) for k in keys), found.alias("_v")
    )
    rows = rows.select(*keys, *(F.col("_v")[c].alias(c) for c in (*order, *values)))
    return rows.filter(F.col(order[0]).isNotNull() & ~F.col("_gone")).drop("_gone")


def _changes(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    return spark.read.schema(StructType([*schema.fields]).add("batch", "long")).parquet(path)


def read_state(
    spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Current rows: the last written row of each key, without removed keys."""
    values = [f.name for f in schema.fields if f.name not in (*keys, *order)]
    rows = latest(_changes(spark, path, schema), keys, order, values)
    if not keys:
        rows = rows.filter(F.col(order[0]).isNotNull())
    return rows.filter(~F.col("_gone")).drop("_gone")


def read_counters(
    spark: SparkSession, path: str, schema: StructType, by: Sequence[str] = ("entity_type", "op")
) -> DataFrame:
    """Current counts: the last written total of each counter."""
    rows = latest(_changes(spark, path, schema), by, ["batch"], ["total"])
    return rows.drop("batch")


def compact(
    spark: SparkSession,
    path: str,
    into: str,
    schema: StructType,
    keys: Sequence[str],
    order: Sequence[str],
) -> None:
    """Rewrite the change files of a stopped stream's path as one, elsewhere.

    Removed keys are kept: they still outrank older events.
    """
    values = [f.name for f in schema.fields if f.name not in (*keys, *order)]
    rows = latest(_changes(spark, path, schema), keys, order, values)
    rows.write.mode("overwrite").parquet(f"{into}/batch=-1")
