"""Poll rounds to log events: snapshots in, events out."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entitylog.functions.canon import tidy
from entitylog.operators import changelog
from entitylog.operators.enrich import with_config, with_description
from entitylog.operators.envelope import wrap
from entitylog.operators.filters import allowed, visible
from entitylog.params import Params
from entitylog.schema import (
    BROKER,
    CLUSTER,
    CONFIGS,
    CREATED,
    DESCRIPTIONS,
    KEYS,
    SEQ,
    SNAPSHOT,
    TOPIC,
    TOPICS,
    UPDATED,
    VALUES,
)
from entitylog.sources.snapshots import brokers_of

Rounds = tuple[int, int]


def topic_events(
    snaps: DataFrame, rounds: Rounds, params: Params = Params(), state: DataFrame | None = None
) -> DataFrame:
    """Topic events of consecutive rounds.

    The lists and the internal flag keep a topic from being created or updated.
    They do not delete it, and they do not keep it from being deleted.
    """
    eligible = (
        allowed(F.col("name"), params.allow, params.deny)
        & visible(F.col("description.internal"), params.include_internal)
        & F.col("description").isNotNull()
        & ~F.coalesce("lookup_failed", F.lit(False))
    )
    changes = changelog.from_snapshots(
        snaps, KEYS[TOPIC], VALUES[TOPIC], rounds, eligible=eligible, state=state
    )
    return wrap(changelog.topic_steps(changes).withColumnRenamed("snapshot_id", "round"), TOPIC)


def broker_snapshot(cluster_snaps: DataFrame, configs: DataFrame) -> DataFrame:
    """Broker snapshot rows from cluster listings and configs per round and broker id."""
    return with_config(brokers_of(cluster_snaps), configs, ["snapshot_id", "id"])


def broker_events(
    snaps: DataFrame, rounds: Rounds, params: Params = Params(), state: DataFrame | None = None
) -> DataFrame:
    """Broker events of consecutive rounds; brokers no longer listed stay known."""
    eligible = ~F.coalesce("lookup_failed", F.lit(False))
    changes = changelog.from_snapshots(
        snaps, KEYS[BROKER], VALUES[BROKER], rounds,
        eligible=eligible, forget_absent=False, state=state,
    )
    return wrap(changelog.plain_steps(changes).withColumnRenamed("snapshot_id", "round"), BROKER)


def cluster_events(
    snaps: DataFrame, rounds: Rounds, params: Params = Params(), state: DataFrame | None = None,
    chunk: int | None = 2048,
) -> DataFrame:
    """Cluster events of consecutive rounds; a listing may come in several rows.

    Should its rows disagree, the least counts, so that every run gives the same.
    The slot's rounds are compared in groups of ``chunk``.
    """
    slots = (
        snaps.groupBy("snapshot_id")
        .agg(F.min(F.struct(*VALUES[CLUSTER])).alias("_slot"))
        .select("snapshot_id", "_slot.*")
    )
    changes = changelog.from_snapshots(
        slots, KEYS[CLUSTER], VALUES[CLUSTER], rounds, forget_absent=False, state=state, chunk=chunk
    )
    return wrap(changelog.plain_steps(changes).withColumnRenamed("snapshot_id", "round"), CLUSTER)


def _configs(tables: dict[str, DataFrame], name: str) -> DataFrame:
    return tables[CONFIGS].withColumnRenamed("name", name)


def cluster_listing_events(
    tables: dict[str, DataFrame], rounds: Rounds, params: Params = Params(), states: dict[str, DataFrame] | None = None
) -> dict[str, DataFrame]:
    """Cluster events of its listings, and broker events of the nodes they list, with each broker's config looked up."""
    states = states or {}
    listed = brokers_of(tables[CLUSTER])
    # A listing may be spread over rows that repeat a node; of its rows the least counts.
    one = listed.groupBy("snapshot_id", "id").agg(F.min("node").alias("node"))
    brokers = with_config(one, _configs(tables, "id"), ["snapshot_id", "id"], resource=BROKER)
    brokers = tidy(brokers, SNAPSHOT[BROKER])
    return {
        CLUSTER: cluster_events(tables[CLUSTER], rounds, params, states.get(CLUSTER)),
        BROKER: broker_events(brokers, rounds, params, states.get(BROKER)),
    }


def topic_listing_events(
    tables: dict[str, DataFrame], rounds: Rounds, params: Params = Params(), states: dict[str, DataFrame] | None = None
) -> dict[str, DataFrame]:
    """Topic events of listed names, described and with their config looked up.

    A listed topic without a description is there, but nothing is known of it.
    """
    key = ["snapshot_id", "name"]
    listed = tables[TOPICS].select(*key).distinct()
    described = with_description(listed, tables[DESCRIPTIONS], key, how="left")
    topics = with_config(described, _configs(tables, "name"), key, resource=TOPIC)
    topics = tidy(topics, SNAPSHOT[TOPIC])
    return {TOPIC: topic_events(topics, rounds, params, (states or {}).get(TOPIC))}


LISTED_EVENTS = {"cluster": cluster_listing_events, "topic": topic_listing_events}


EVENTS = {TOPIC: topic_events, BROKER: broker_events, CLUSTER: cluster_events}


def describe_created(log: DataFrame, descriptions: DataFrame) -> DataFrame:
    """First Updated of the topics a log (or log stream) announces as created.

    ``descriptions`` has name, description and config. A topic without one gets
    no event.
    """
    created = log.filter(F.col("topic").isNotNull() & (F.col("op") == CREATED))
    named = created.select(F.col("topic.name").alias("name"), "round")
    described = named.join(descriptions, "name", "inner")
    return wrap(
        described.select(
            "*", F.lit(UPDATED).alias("op"), F.lit(CREATED).alias("op_tag"), F.lit(SEQ[UPDATED]).alias("seq")
        ),
        TOPIC,
    )
