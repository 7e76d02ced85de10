"""Event counters by entity type and operation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entitylog.schema import DOUBLE, LONG, STRING, struct


def produced(events: DataFrame) -> DataFrame:
    """Events published; a new topic's first Updated counts as Created."""
    return events.groupBy("entity_type", "op_tag").agg(F.sum(F.lit(1.0)).alias("total"))


def consumed(log: DataFrame) -> DataFrame:
    """Events read from the log, by what they are."""
    return log.groupBy("entity_type", "op").agg(F.sum(F.lit(1.0)).alias("total"))


def snapshot_sizes(snaps: DataFrame, round: str = "snapshot_id") -> DataFrame:
    """Keys listed per round."""
    return snaps.groupBy(round).agg(F.count(F.lit(1)).alias("n_keys"))


def write_counters(counters: DataFrame, path: str) -> None:
    """Counters as a table: at most one row per entity type and operation."""
    counters.coalesce(1).write.mode("overwrite").parquet(path)


COUNTED = struct(entity_type=STRING, op=STRING, total=DOUBLE, batch=LONG)


def count_batch(events: DataFrame, path: str, batch: int) -> None:
    """A batch's own counts in a ledger; a batch tried again replaces what it counted before."""
    consumed(events).coalesce(1).write.mode("overwrite").parquet(f"{path}/batch={batch}")


def counted(spark: SparkSession, path: str) -> DataFrame:
    """Counts of all batches in a ledger, each batch once."""
    rows = spark.read.schema(COUNTED).parquet(path)
    return rows.groupBy("entity_type", "op").agg(F.sum("total").alias("total"))


def roll_up(spark: SparkSession, path: str, into: str) -> None:
    """The counts of a ledger whose stream is stopped as a ledger of one batch, elsewhere."""
    counted(spark, path).coalesce(1).write.mode("overwrite").parquet(f"{into}/batch=-1")
