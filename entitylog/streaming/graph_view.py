"""The graph kept up to date from a log stream, by counting who supports each fact.

A fact is an entity or a relation. Each topic, each broker and the cluster support
the facts that follow from their value; a rack, for one, is there while any broker
names it. For each of them the stream keeps what it supports and its place in the
log, so that an event is compared with that alone, and a batch emits only facts
gained and lost. These are added up in layers (``state_table``), and a fact is
there while its count is above zero. Neither the state nor the graph is read to
bring them up to date: a batch costs what its events cost.

The one relation that takes two values, of the cluster and its brokers, is made when
the graph is read. An event older than the last of its key changes nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from entitylog.operators.state import IGNORED, LOG_ORDER, REMOVED, arm
from entitylog.schema import BROKER, CLUSTER, LONG, STRING, TOPIC, struct
from entitylog.sources import commits
from entitylog.streaming import state_table

FACT = ["what", "name", "source", "destination"]
COUNTED = struct(what=STRING, name=STRING, source=STRING, destination=STRING, n=LONG)
FACTS = "array<struct<what:string,name:string,source:string,destination:string>>"


def _entity(kind: str, id: Column) -> Column:
    return F.struct(
        F.lit("entity").alias("what"), F.lit(kind).alias("name"), id.cast("string").alias("source"),
        F.lit(None).cast("string").alias("destination"),
    )


def _relation(name: str, source: Column, destination: Column) -> Column:
    return F.struct(
        F.lit("relation").alias("what"), F.lit(name).alias("name"), source.cast("string").alias("source"),
        destination.cast("string").alias("destination"),
    )


def _each(items: Column, facts) -> Column:
    """The facts of all items of an array, none if it is null."""
    return F.coalesce(F.flatten(F.transform(items, facts)), F.array().cast(FACTS))


def topic_facts() -> Column:
    def of_partition(p: Column) -> Column:
        id = F.concat_ws("-", "name", p["id"])
        replica = lambda r: F.concat_ws("-", "name", p["id"], r["id"])
        own = F.array(_entity("TopicPartition", id), _relation("partitions", F.col("name"), id))
        held = _each(
            p["replicas"],
            lambda r: F.array(
                _entity("TopicPartitionReplica", replica(r)), _relation("replicas", id, replica(r)),
                _relation("broker", replica(r), r["id"]),
            ),
        )
        in_sync = _each(p["isr"], lambda r: F.array(_relation("isr", id, replica(r))))
        return F.concat(own, held, in_sync)

    return F.concat(F.array(_entity("Topic", F.col("name"))), _each(F.col("description.partitions"), of_partition))


def broker_facts() -> Column:
    rack = F.nullif(F.col("node.rack"), F.lit(""))
    racked = F.array(_entity("Rack", rack), _relation("brokers", rack, F.col("id")))
    return F.concat(F.array(_entity("Broker", F.col("id"))), F.when(rack.isNotNull(), racked).otherwise(F.array().cast(FACTS)))


def cluster_facts() -> Column:
    return F.array(_entity("Cluster", F.col("id")))


#: The column that names each kind; the cluster is one slot.
KEY = {TOPIC: "name", BROKER: "id", CLUSTER: None}
OF = {TOPIC: topic_facts, BROKER: broker_facts, CLUSTER: cluster_facts}


def supported(log: DataFrame) -> DataFrame:
    """What each event's key supports from then on: ``kind``, ``key``, place in the log, ``facts``."""
    found = None
    for kind, key in KEY.items():
        rows = arm(log, kind).filter(~F.col("op").isin(list(IGNORED[kind])))
        facts = OF[kind]()
        if REMOVED[kind]:
            facts = F.when(F.col("op").isin(list(REMOVED[kind])), F.array().cast(FACTS)).otherwise(facts)
        rows = rows.select(
            F.lit(kind).alias("kind"), (F.col(key) if key else F.lit("")).alias("key"), *LOG_ORDER, facts.cast(FACTS).alias("facts")
        ).filter(F.col("key").isNotNull())
        found = rows if found is None else found.unionByName(rows)
    return found


def _compared(key: tuple, parts: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
    """Facts that a key's last event gains and loses, against what it supported before."""
    held, place = set(), None
    if state.exists:
        before, round, seq = state.get
        held, place = {tuple(f) for f in before}, (round, seq)
    now, last = held, place
    for rows in parts:
        for round, seq, facts in zip(rows["round"], rows["seq"], rows["facts"]):
            if last is None or (round, seq) > last:
                last = (int(round), int(seq))
                now = {tuple(f[c] for c in FACT) for f in facts}
    if last == place:
        return
    state.update(([list(f) for f in now], *last))
    changed = [(*f, 1) for f in now - held] + [(*f, -1) for f in held - now]
    if changed:
        yield pd.DataFrame(changed, columns=[*FACT, "n"])


def _summed(rows: DataFrame, bottom: bool = False) -> DataFrame:
    """Counts added up; what adds up to nothing says nothing at any level."""
    return rows.groupBy(*FACT).agg(F.sum("n").alias("n")).filter("n <> 0")


def follow(log: DataFrame, path: str, checkpoint: str, once: bool = False, interval: str = "30 seconds", fan: int = state_table.FAN) -> StreamingQuery:
    """Keep the counts of a log stream's facts below ``path``."""
    changed = supported(log).groupBy("kind", "key").applyInPandasWithState(
        _compared, COUNTED, "facts array<array<string>>, round long, seq int", "update", "NoTimeout"
    )

    def step(rows: DataFrame, batch: int) -> None:
        before = commits.last_version(rows.sparkSession, path, batch)
        state_table.append_layer(_summed(rows), path, batch, before, COUNTED, _summed, fan)
        if before is not None:
            commits.expire(rows.sparkSession, path, before)

    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return (
        changed.writeStream.outputMode("update").foreachBatch(step)
        .option("checkpointLocation", checkpoint).trigger(**trigger).start()
    )


def read(spark: SparkSession, path: str) -> DataFrame:
    """The facts that are there: ``what``, ``name``, ``source`` and ``destination``."""
    facts = _summed(state_table.layers(spark, path, COUNTED)).filter("n > 0").drop("n")
    entities = facts.filter("what = 'entity'")
    cluster = entities.filter("name = 'Cluster'").select("source").scalar()
    among = entities.filter("name = 'Broker'").select(
        F.lit("relation").alias("what"), F.lit("brokers").alias("name"), cluster.alias("source"), F.col("source").alias("destination")
    )
    return facts.unionByName(among.filter("source is not null"))
