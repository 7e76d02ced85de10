"""Folding a change log into current state.

The last event of a key decides, by log order and not by arrival. Aggregation
happens before the shuffle, so a key with any share of the log leaves one row
per input partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    DateType,
    DoubleType,
    FloatType,
    IntegralType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

from entitylog.schema import ARM, BROKER, CLUSTER, CREATED, DELETED, KEYS, TOPIC, VALUES

# Types a hash aggregate can update in place.
FIXED_WIDTH = (
    BooleanType, DateType, DoubleType, FloatType, IntegralType, TimestampNTZType, TimestampType,
)

LOG_ORDER = ("round", "seq")


def one_by_one(schema: StructType, order: Sequence[str], values: Sequence[str]) -> bool:
    """Whether ``latest`` takes each value by itself: fixed-width ones under a single order column."""
    return len(order) == 1 and all(isinstance(schema[c].dataType, FIXED_WIDTH) for c in [*order, *values])


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str]) -> DataFrame:
    """The row with the greatest order of each key, with its order columns.

    ``order`` is unique per key. Fixed-width values under a single order column
    are aggregated one by one, which lets Spark hash instead of sort.
    """
    if one_by_one(df.schema, order, values):
        return df.groupBy(*keys).agg(
            F.max(order[0]).alias(order[0]),
            *[F.max_by(v, order[0]).alias(v) for v in values],
        )
    position = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    last = F.max_by(F.struct(*order, *values), position)
    return df.groupBy(*keys).agg(last.alias("_last")).select(*keys, "_last.*")


def fold(
    log: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    op: str = "op",
    ignore: Sequence[str] = (),
    remove: Sequence[str] = (),
) -> DataFrame:
    """Current rows of a log: events in ``ignore`` do nothing, the other events
    set the key's row, and a key whose last event is in ``remove`` has none."""
    if ignore:
        log = log.filter(~F.col(op).isin(list(ignore)))
    if not remove:
        rows = latest(log, keys, order, values)
    else:
        gone = log.withColumn("_gone", F.col(op).isin(list(remove)))
        rows = latest(gone, keys, order, [*values, "_gone"]).filter(~F.col("_gone")).drop("_gone")
    # Without keys an empty log still aggregates to one row.
    return rows if keys else rows.filter(F.col(order[0]).isNotNull())


def fold_topics(log: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str], op: str = "op") -> DataFrame:
    """A topic is there from its Updated to its Deleted; Created only announces it."""
    return fold(log, keys, order, values, op, ignore=[CREATED], remove=[DELETED])


def fold_brokers(log: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str], op: str = "op") -> DataFrame:
    """A broker, once seen, stays with its last value."""
    return fold(log, keys, order, values, op, ignore=[DELETED])


def fold_cluster(log: DataFrame, order: Sequence[str], values: Sequence[str], op: str = "op") -> DataFrame:
    """The cluster is one slot: the last event of the whole log, whatever its id."""
    return fold(log, [], order, values, op, ignore=[DELETED])


def arm(log: DataFrame, kind: str) -> DataFrame:
    """The events of one kind, its payload's fields as columns."""
    name = ARM[kind]
    if "kind" in log.columns:
        # Of a stored log only this kind's files are read, and those of no single kind.
        log = log.filter((F.col("kind") == kind) | F.col("kind").isNull())
    return log.filter(F.col(name).isNotNull()).select("op", *LOG_ORDER, f"{name}.*")


def topics_current(log: DataFrame) -> DataFrame:
    rows = fold_topics(arm(log, TOPIC), ["name"], LOG_ORDER, ["description", "config"])
    return rows.drop(*LOG_ORDER)


def brokers_current(log: DataFrame) -> DataFrame:
    rows = fold_brokers(arm(log, BROKER), ["id"], LOG_ORDER, ["node", "config"])
    return rows.drop(*LOG_ORDER)


def cluster_current(log: DataFrame) -> DataFrame:
    return fold_cluster(arm(log, CLUSTER), LOG_ORDER, ["id", "controller"]).drop(*LOG_ORDER)


CURRENT = {TOPIC: topics_current, BROKER: brokers_current, CLUSTER: cluster_current}


def apply(
    state: DataFrame,
    log: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    values: Sequence[str],
    op: str = "op",
    ignore: Sequence[str] = (),
    remove: Sequence[str] = (),
) -> DataFrame:
    """State after some more events.

    Unchanged rows only meet the changed keys; where those are few, Spark sends
    them to the state's partitions and the state is not shuffled.
    """
    changed = log.filter(~F.col(op).isin(list(ignore))) if ignore else log
    rows = fold(changed, keys, order, values, op, remove=remove).select(*keys, *values)
    if keys:
        untouched = state.join(changed.select(*keys).distinct(), list(keys), "left_anti")
    else:
        any_change = changed.select(F.max(F.lit(True))).scalar()
        untouched = state.filter(any_change.isNull())
    return untouched.select(*keys, *values).unionByName(rows)


IGNORED = {TOPIC: (CREATED,), BROKER: (DELETED,), CLUSTER: (DELETED,)}
REMOVED = {TOPIC: (DELETED,), BROKER: (), CLUSTER: ()}


def apply_events(state: DataFrame, log: DataFrame, kind: str) -> DataFrame:
    """State of one kind after some more events of the log."""
    return apply(
        state, arm(log, kind), KEYS[kind], LOG_ORDER, VALUES[kind],
        ignore=IGNORED[kind], remove=REMOVED[kind],
    )
