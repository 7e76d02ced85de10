"""The event envelope: one log row shape for all entity types.

Exactly one of the arms ``cluster``, ``broker`` and ``topic`` is set. Consumers
route by the set arm, whatever ``entity_type`` says.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitylog.functions.canon import tidy
from entitylog.schema import ARM, EVENT, OPERATIONS, STATE, TOPIC, UPDATED, VALUES


def wrap(df: DataFrame, kind: str) -> DataFrame:
    """Log rows of one kind (its state columns, op, op_tag, round, seq) as events.

    Of the topic events only an Updated carries a value.
    """
    state = STATE[kind]
    if kind == TOPIC:
        df = df.withColumns(
            {v: F.when(F.col("op") == UPDATED, F.col(v)) for v in VALUES[TOPIC] if v in df.columns}
        )
    payload = F.struct(
        *[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in state.fields
        ]
    )
    entity_id = "name" if kind == TOPIC else "id"
    rows = df.select(
        F.lit(kind).alias("entity_type"),
        F.col(entity_id).cast("string").alias("entity_id"),
        "op",
        F.col("op_tag") if "op_tag" in df.columns else F.col("op").alias("op_tag"),
        payload.alias(ARM[kind]),
        "round",
        "seq",
    )
    return tidy(rows, EVENT)


def wrap_mixed(df: DataFrame, kind: Column, payloads: dict[str, Column]) -> DataFrame:
    """Log rows of several kinds in one table as events, in one pass.

    ``payloads`` has the state of each kind as a struct; ``df`` has entity_id,
    op, op_tag, round and seq.
    """
    values = {ARM[k]: F.when(kind == k, payload) for k, payload in payloads.items()}
    return tidy(df.withColumns({"entity_type": kind, **values}), EVENT)


def merge(*events: DataFrame) -> DataFrame:
    """Events of several kinds as one log."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), events)


def entity_key(entity_type: Column | str = "entity_type", entity_id: Column | str = "entity_id") -> Column:
    """Record key of an entity."""
    return F.concat_ws("-", entity_type, entity_id)


def with_key(df: DataFrame) -> DataFrame:
    """Events with their record key and headers."""
    header = F.struct(
        F.lit("entity_type").alias("key"), F.encode("entity_type", "UTF-8").alias("value")
    )
    return df.withColumns({"key": entity_key(), "headers": F.array(header)})


def arms_set() -> Column:
    """How many arms of an event are set."""
    return reduce(
        lambda a, b: a + b, [F.col(arm).isNotNull().cast("int") for arm in ARM.values()]
    )


def kind_of() -> Column:
    """The kind whose arm is set."""
    return F.coalesce(*[F.when(F.col(arm).isNotNull(), kind) for kind, arm in ARM.items()])


def _has_operation() -> Column:
    fits = [
        (kind_of() == kind) & F.col("op").isin(list(ops)) for kind, ops in OPERATIONS.items()
    ]
    return F.coalesce(reduce(lambda a, b: a | b, fits), F.lit(False))


def route(events: DataFrame) -> dict[str, DataFrame]:
    """One table per kind: the payload of its events with op and log position."""
    position = [c for c in ("op", "op_tag", "round", "seq") if c in events.columns]
    return {
        kind: events.filter(F.col(arm).isNotNull()).select(*position, f"{arm}.*")
        for kind, arm in ARM.items()
    }


def quarantine(events: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Events that can be routed, and a report on those with something wrong.

    The report has a ``problem`` column. A wrong ``entity_type`` is reported but
    the event is still routed, by its arm; the others are not.
    """
    problem = (
        F.when(arms_set() == 0, "no payload")
        .when(arms_set() > 1, "several payloads")
        .when(~_has_operation(), "no such operation")
    )
    mismatch = F.when(~kind_of().eqNullSafe(F.col("entity_type")), "entity type differs")
    valid = events.filter(problem.isNull())
    report = events.withColumn("problem", F.coalesce(problem, mismatch)).filter(
        F.col("problem").isNotNull()
    )
    return valid, report
