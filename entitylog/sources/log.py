"""The change log on storage.

Two layouts. The *table log* keeps events as columns, so that a job reads only
the entity types and columns it needs; it is the one to use between Spark jobs.
The *record log* keeps key, bytes and headers, as other consumers expect them.
A table log may be *committed*, batch by batch and writer by writer (``commits``).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from entitylog.functions import codec
from entitylog.functions.canon import tidy
from entitylog.operators.envelope import arms_set, kind_of, with_key
from entitylog.params import Params
from entitylog.schema import EVENT, LONG, RECORD, STRING, struct
from entitylog.sources import commits

#: Headers that carry an event's place in the log.
POSITION = ("round", "seq")


def append_log(events: DataFrame, path: str, writer: str = "batch", batch: int | None = None) -> None:
    """Append events to a table log, by writer and kind.

    The kind is the one arm that is set, null where that is none or several, so a
    fold of one kind reads its files alone. With a batch number the write replaces
    an earlier attempt at that batch.
    """
    rows = tidy(events, EVENT).withColumn("kind", F.when(arms_set() == 1, kind_of()))
    if batch is None:
        rows = rows.withColumns({"writer": F.lit(writer), "batch": F.lit(None).cast("long")})
        rows.write.mode("append").partitionBy("writer", "batch", "kind").parquet(path)
    else:
        target = f"{path}/writer={writer}/batch={batch}"
        rows.write.mode("overwrite").partitionBy("kind").parquet(target)


_FIELDS = {f.name: f.dataType for f in EVENT.fields}
LOGGED = struct(**_FIELDS, kind=STRING)


def read_log(spark: SparkSession, path: str, stream: bool = False) -> DataFrame:
    """All events of a table log from its beginning with their kind, as a table or a stream."""
    reader = spark.readStream if stream else spark.read
    stored = struct(**_FIELDS, writer=STRING, batch=LONG, kind=STRING)
    return tidy(reader.schema(stored).parquet(path), LOGGED)


def read_batch(spark: SparkSession, path: str, writer: str, batch: int) -> DataFrame:
    """The events of one batch of a table log; no other batch is looked at."""
    return tidy(spark.read.schema(LOGGED).parquet(f"{path}/writer={writer}/batch={batch}"), LOGGED)


def commit_log(events: DataFrame, path: str, writer: str, batch: int) -> DataFrame:
    """Append a batch to a writer's committed log, unless it is there already; the batch's events as stored.

    Unlike the plain table log, readers never see a batch that failed or a part of
    one, and those who follow it as a stream see every event once. Batch n is version
    2 n, which leaves a number for a merger after it.
    """
    spark, table = events.sparkSession, f"{path}/writer={writer}"
    if commits.entry(spark, table, 2 * batch) is None:
        name = commits.new_piece(batch)
        rows = tidy(events, EVENT).withColumn("kind", F.when(arms_set() == 1, kind_of()))
        rows.write.partitionBy("kind").parquet(f"{table}/{name}")
        commits.commit(spark, table, 2 * batch, [(name, 0)])
    return read_committed_batch(spark, path, writer, batch)


def _pieces(spark: SparkSession, table: str, names: Sequence[str]) -> DataFrame:
    if not names:
        return spark.createDataFrame([], LOGGED)
    reader = spark.read.schema(LOGGED).option("basePath", f"{table}/data")
    return tidy(reader.parquet(*(f"{table}/{name}" for name in names)), LOGGED)


def read_committed_batch(spark: SparkSession, path: str, writer: str, batch: int) -> DataFrame:
    """The events of one batch of a committed log; no other batch is looked at."""
    table = f"{path}/writer={writer}"
    return _pieces(spark, table, [p.name for p in commits.entry(spark, table, 2 * batch).adds])


def read_committed(
    spark: SparkSession, path: str, writers: Sequence[str], at: Mapping[str, int] | None = None
) -> DataFrame:
    """All events of the writers named; of those in ``at`` as their log was after that batch."""
    found = []
    for writer in writers:
        table = f"{path}/writer={writer}"
        version = 2 * at[writer] + 1 if at and writer in at else None
        names = [name for name, _ in commits.pieces(spark, table, version)]
        found.append(_pieces(spark, table, names))
    return reduce(DataFrame.unionByName, found)


def merge_log(spark: SparkSession, path: str, writer: str, batch: int) -> None:
    """Gather all that a writer committed up to a batch, its last, into files of a useful size.

    Those who read already keep the files they read until ``expire_log``.
    """
    table, version = f"{path}/writer={writer}", 2 * batch + 1
    if commits.entry(spark, table, version) is not None:
        return
    names = [name for name, _ in commits.pieces(spark, table, version)]
    name = commits.new_piece(batch)
    rows = _pieces(spark, table, names).hint("rebalance", "kind")
    rows.write.partitionBy("kind").parquet(f"{table}/{name}")
    commits.commit(spark, table, version, [(name, 1)], base=True)


def expire_log(spark: SparkSession, path: str, writer: str, batch: int) -> list[str]:
    """Remove what was merged after a batch: earlier versions can't be read any more, nor followed by new streams."""
    return commits.expire(spark, f"{path}/writer={writer}", 2 * batch + 1)


def follow_log(
    spark: SparkSession, path: str, writer: str, step: Callable[[DataFrame, int], None], checkpoint: str, **options
) -> StreamingQuery:
    """Calls ``step`` with the events of new commits, each event in exactly one batch, and the batch's number.

    Options are those of ``commits.follow``. The names of a batch's directories
    come to the driver, as many as commits are admitted to it.
    """
    table = f"{path}/writer={writer}"

    def taken(entries: DataFrame, batch: int) -> None:
        names = [r.name for r in entries.select(F.explode("adds.name").alias("name")).collect()]
        step(_pieces(entries.sparkSession, table, names), batch)

    return commits.follow(spark, table, taken, checkpoint, **options)


def to_records(events: DataFrame, format: str = "json") -> DataFrame:
    """Events as keyed records."""
    return tidy(codec.encode(with_key(events), format), RECORD)


def from_records(records: DataFrame, format: str = "json") -> DataFrame:
    """Keyed records as events."""
    return tidy(codec.decode(records, format), EVENT)


def append_records(events: DataFrame, path: str, format: str = "json", mode: str = "append") -> None:
    """Append events to a record log, by entity type."""
    records = to_records(events, format)
    records.withColumn("entity_type", F.decode(F.col("headers")[0]["value"], "UTF-8")).write.mode(
        mode
    ).partitionBy("entity_type").parquet(path)


def read_records(
    spark: SparkSession, path: str, format: str = "json", stream: bool = False
) -> DataFrame:
    """All events of a record log from its beginning, as a table or a stream."""
    reader = spark.readStream if stream else spark.read
    records = reader.schema(RECORD).parquet(path).select(*RECORD.fieldNames())
    return from_records(records, format)


def kafka_records(events: DataFrame, format: str = "protobuf") -> DataFrame:
    """Records as they are sent: a key's by one task and in order, their place in
    the log as headers, since offsets of different keys cannot be compared."""
    place = [
        F.struct(F.lit(name).alias("key"), F.encode(F.col(name).cast("string"), "UTF-8").alias("value"))
        for name in POSITION
    ]
    records = to_records(events, format).repartition("key").sortWithinPartitions("key", *POSITION)
    return records.select("key", "value", F.concat("headers", F.array(*place)).alias("headers"))


def from_kafka(rows: DataFrame, format: str = "protobuf") -> DataFrame:
    """Rows of the Kafka source as events. Records of other writers, without the
    headers, are ordered by offset."""

    def place(name: str) -> Column:
        found = F.get(F.filter("headers", lambda h: h["key"] == name), F.lit(0))
        return F.decode(found["value"], "UTF-8").cast("long")

    records = rows.select(
        "value",
        F.coalesce(place("round"), F.col("offset")).alias("round"),
        F.coalesce(place("seq").cast("int"), F.lit(0)).alias("seq"),
    )
    return from_records(records, format)


def write_kafka(events: DataFrame, params: Params, format: str = "protobuf") -> None:
    """Publish events to the event topic; needs Spark's Kafka connector."""
    kafka_records(events, format).write.format("kafka").options(
        **{
            "kafka.bootstrap.servers": params.bootstrap_servers,
            "topic": params.event_topic,
            "includeHeaders": "true",
        }
    ).save()


def read_kafka(
    spark: SparkSession, params: Params, format: str = "protobuf", stream: bool = False
) -> DataFrame:
    """The event topic from its beginning; needs Spark's Kafka connector."""
    reader = spark.readStream if stream else spark.read
    source = reader.format("kafka").options(
        **{
            "kafka.bootstrap.servers": params.bootstrap_servers,
            "subscribe": params.event_topic,
            "startingOffsets": "earliest",
            "includeHeaders": "true",
        }
    )
    return from_kafka(source.load(), format)
