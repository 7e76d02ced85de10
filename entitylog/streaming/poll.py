"""The poll loop as a stream: completed rounds in, events and state out.

The stream follows the tables of completed rounds, not the snapshot files, so a
round is only ever seen whole, and an empty round is seen too. Each batch takes the
rounds that follow the last one without a gap; rounds beyond a gap are kept with the
batch until it is filled, so marks are read once. A poll that joins several tables,
such as listings and the lookups that complete them, takes the rounds that all of
them have, as one bound.

Layout under ``out``: ``log`` (a committed log, one writer per poll), ``state/<kind>``
(layers of changes, see ``state_table``), ``waiting/<poll>/batch=<n>`` and
``progress/<poll>/batch=<n>``, and ``checkpoints``. Log and state of a batch are
committed once and stay as they are when the batch is tried again; the others are
replaced. Bytes written in a batch are in proportion to its changes, and what
earlier batches left is removed as ``KEPT`` more have been done.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from entitylog.operators.state import IGNORED, LOG_ORDER, REMOVED, arm
from entitylog.params import Params, duration
from entitylog.plans.poll import EVENTS, LISTED_EVENTS
from entitylog.schema import BROKER, CLUSTER, CONFIGS, DESCRIPTIONS, INT, KEYS, LONG, STATE, STRING, TOPIC, TOPICS, VALUES, struct
from entitylog.session import remove
from entitylog.sources import commits
from entitylog.sources.log import commit_log, read_committed
from entitylog.sources.snapshots import ROUND, read_snapshots, rounds_path
from entitylog.streaming import state_table

#: Batches whose state can still be read, the last included; the ones before are removed.
KEPT = 3


@dataclass(frozen=True)
class Poll:
    """A poll: its name, which is the log's writer, its tables, and the kinds it gives events of.

    ``events`` takes the tables' rows of a batch by name, the rounds, the parameters
    and the state of each kind, and gives the events of each kind.
    """

    name: str
    tables: tuple[str, ...]
    kinds: tuple[str, ...]
    events: Callable[[dict[str, DataFrame], tuple[int, int], Params, dict[str, DataFrame]], dict[str, DataFrame]]


def _single(kind: str) -> Poll:
    def events(tables, rounds, params, states):
        return {kind: EVENTS[kind](tables[kind], rounds, params, states.get(kind))}

    return Poll(kind.lower(), (kind,), (kind,), events)


#: Ready snapshots of one kind; listings that brokers and topics are derived from.
POLLS = {kind: _single(kind) for kind in EVENTS}
CLUSTER_LISTING = Poll("cluster-listing", (CLUSTER, CONFIGS), (CLUSTER, BROKER), LISTED_EVENTS["cluster"])
TOPIC_LISTING = Poll("topic-listing", (TOPICS, DESCRIPTIONS, CONFIGS), (TOPIC,), LISTED_EVENTS["topic"])


def log_path(out: str) -> str:
    return f"{out}/log"


def state_path(out: str, kind: str) -> str:
    return f"{out}/state/{kind.lower()}"


def progress_path(out: str, name: str) -> str:
    return f"{out}/progress/{name.lower()}"


def waiting_path(out: str, name: str, batch: int) -> str:
    return f"{out}/waiting/{name}/batch={batch}"


PROGRESS = struct(last=LONG, at=LONG)
MARK = struct(table=STRING, snapshot_id=LONG)


def _progress(spark: SparkSession, out: str, name: str, batch: int) -> tuple[int | None, int | None]:
    row = spark.read.schema(PROGRESS).parquet(f"{progress_path(out, name)}/batch={batch}").first()
    return row["last"], row["at"]


def read_progress(spark: SparkSession, out: str, name: str, batch: int) -> int | None:
    """Last round that was in the log after a batch: one row to the driver."""
    return _progress(spark, out, name, batch)[0]


def read_log(spark: SparkSession, out: str, polls: Sequence[str], at: dict[str, int] | None = None) -> DataFrame:
    """The events of the polls named; of those in ``at`` as their log was after that batch."""
    return read_committed(spark, log_path(out), [p.lower() for p in polls], {k.lower(): v for k, v in (at or {}).items()})


def _state(spark: SparkSession, out: str, kind: str, at: int) -> DataFrame:
    schema = struct(**{f.name: f.dataType for f in STATE[kind].fields}, round=LONG, seq=INT)
    return state_table.read(spark, state_path(out, kind), schema, KEYS[kind], LOG_ORDER, at).select(*STATE[kind].fieldNames())


def read_state(spark: SparkSession, out: str, kind: str, batch: int | None = None, name: str | None = None) -> DataFrame:
    """State of a kind after a batch of its poll (one of the last ``KEPT`` that had rounds), or as it is."""
    if batch is None:
        at = commits.last_version(spark, state_path(out, kind))
    else:
        at = _progress(spark, out, name or kind, batch)[1]
    return spark.createDataFrame([], STATE[kind]) if at is None else _state(spark, out, kind, at)


def _bound(marks: DataFrame, tables: Sequence[str], last: int | None) -> tuple[int, int] | None:
    """First and last of the rounds that follow ``last`` without a gap in every table: one row to the driver.

    Before anything was read, the least round marked is the first.
    """
    ids = marks.groupBy("snapshot_id").agg(F.count_distinct("table").alias("n")).filter(F.col("n") == len(tables))
    if last is None:
        first = marks.agg(F.min("snapshot_id")).first()[0]
    else:
        first = last + 1
        ids = ids.filter(F.col("snapshot_id") > last)
    if first is None:
        return None
    before = ids.select((F.col("snapshot_id") - 1).alias("snapshot_id"))
    # The ends of all runs; that of the run which begins at the first is the least.
    ends = ids.join(before, "snapshot_id", "left_anti")
    if ids.filter(F.col("snapshot_id") == first).isEmpty():
        return None
    return first, ends.agg(F.min("snapshot_id")).first()[0]


def _one(spark: SparkSession, path: str, **values: int | None) -> None:
    columns = [F.lit(v).cast("bigint").alias(k) for k, v in values.items()]
    spark.range(1).select(*columns).write.mode("overwrite").parquet(path)


def _step(root: str, out: str, poll: Poll | str, params: Params, fan: int = state_table.FAN):
    poll = POLLS[poll] if isinstance(poll, str) else poll

    def step(listed: DataFrame, batch: int) -> None:
        spark = listed.sparkSession
        if "table" not in listed.columns:
            listed = listed.withColumn("table", F.lit(poll.tables[0]))
        marks, last, at = listed.select(*MARK.fieldNames()).distinct(), None, None
        if batch > 0:
            last, at = _progress(spark, out, poll.name, batch - 1)
            marks = marks.unionByName(spark.read.schema(MARK).parquet(waiting_path(out, poll.name, batch - 1)))
        rounds = _bound(marks, poll.tables, last)
        end = rounds[1] if rounds else last
        waiting = marks if end is None else marks.filter(F.col("snapshot_id") > end)
        waiting.distinct().coalesce(1).write.mode("overwrite").parquet(waiting_path(out, poll.name, batch))
        if rounds:
            tables = {t: read_snapshots(spark, root, t, rounds) for t in poll.tables}
            known = {} if at is None else {kind: _state(spark, out, kind, at) for kind in poll.kinds}
            events = reduce(DataFrame.unionByName, poll.events(tables, rounds, params, known).values())
            # Few of the compared rows become events: gather them into few files.
            log = commit_log(events.hint("rebalance"), log_path(out), poll.name, batch)
            for kind in poll.kinds:
                keys, values = KEYS[kind], VALUES[kind]
                rows = state_table.changes_of(
                    arm(log, kind), keys, LOG_ORDER, values, ignore=IGNORED[kind], remove=REMOVED[kind]
                )
                state_table.append(rows, state_path(out, kind), batch, at, keys, LOG_ORDER, values, fan)
            last, at = rounds[1], batch
        _one(spark, f"{progress_path(out, poll.name)}/batch={batch}", last=last, at=at)
        _tidy_up(spark, out, poll, batch)

    return step


def _tidy_up(spark: SparkSession, out: str, poll: Poll, batch: int) -> None:
    """Remove what only batches more than ``KEPT`` before need."""
    if batch < KEPT:
        return
    keep = _progress(spark, out, poll.name, batch - KEPT + 1)[1]
    if keep is not None:
        for kind in poll.kinds:
            commits.expire(spark, state_path(out, kind), keep)
    remove(spark, waiting_path(out, poll.name, batch - KEPT))
    remove(spark, f"{progress_path(out, poll.name)}/batch={batch - KEPT}")


def snapshots_to_log(
    spark: SparkSession,
    root: str,
    out: str,
    poll: Poll | str = TOPIC,
    params: Params = Params(),
    rounds_per_batch: int = 64,
    once: bool = False,
    fan: int = state_table.FAN,
) -> StreamingQuery:
    """Follow the completed rounds of a poll and append its events to the log.

    Polls at the interval in the parameters, or with ``once`` takes what is
    there and ends. ``fan`` batches' changes of the state are merged at a time.
    """
    poll = POLLS[poll] if isinstance(poll, str) else poll
    interval = params.topic_poll_interval if poll.kinds == (TOPIC,) else params.cluster_poll_interval
    trigger = {"availableNow": True} if once else {"processingTime": duration(interval)}
    listed = [
        spark.readStream.schema(ROUND)
        .option("maxFilesPerTrigger", rounds_per_batch)
        .json(rounds_path(root, table))
        .withColumn("table", F.lit(table))
        for table in poll.tables
    ]
    return (
        reduce(DataFrame.unionByName, listed)
        .writeStream.foreachBatch(_step(root, out, poll, params, fan))
        .option("checkpointLocation", f"{out}/checkpoints/{poll.name}")
        .trigger(**trigger)
        .start()
    )


def stop(*queries: StreamingQuery) -> None:
    """Stop streams, letting the running batch be tried again at the next start."""
    for query in queries:
        query.stop()
