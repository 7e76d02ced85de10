"""The operators applied to a directory of parquet tables.

Roles: ``events`` is a change log keyed by user; ``orders`` counted per customer
and quarter are keyed snapshots, a quarter being a round; ``supplier`` rows are
brokers, ``lineitem`` rows say which supplier holds a replica of which order's
line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from entitylog.functions import canon
from entitylog.operators import changelog, counters, enrich, envelope, filters, graph, state
from entitylog.params import Params, duration
from entitylog.plans import poll, views
from entitylog.schema import (
    BROKER,
    CLUSTER,
    CONFIGS,
    CREATED,
    DELETED,
    NODE,
    TOPIC,
    TOPIC_STATE,
    UPDATED,
)
from entitylog.session import scratch
from entitylog.sources import commits
from entitylog.sources import log as logs
from entitylog.sources import snapshots
from entitylog.streaming import graph_view, materialise
from entitylog.streaming import poll as streaming_poll

K, O = ["k"], ["o"]
COUNT_AND_PRIORITY = ["n", "p"]
CONFIG = "map<string,string>"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Roles


def _as_log(events: DataFrame) -> DataFrame:
    event = F.col("event_type")
    third = F.col("user_id") % 3
    return events.select(
        F.col("user_id").alias("k"),
        F.col("event_id").alias("o"),
        "value",
        "props",
        event.alias("event_type"),
        F.when(event == "signup", CREATED).when(event == "error", DELETED).otherwise(UPDATED).alias("op"),
        F.when(third == 0, CLUSTER).when(third == 1, BROKER).otherwise(TOPIC).alias("entity_type"),
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _as_log(table(spark, sf_dir, "events"))


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log as a stream. A file stream wants a pattern, not a file."""
    schema = table(spark, sf_dir, "events").schema
    return _as_log(spark.readStream.schema(schema).parquet(f"{sf_dir}/event[s].parquet"))


def canonical_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as events with payloads; clusters and brokers know no Deleted, so
    such rows have an operation that does not exist."""
    log = event_log(spark, sf_dir)
    o = F.col("o")
    node = canon.node(
        o % 10,
        F.concat(F.lit("host-"), (o % 10).cast("string")),
        F.lit(9092),
        F.when(o % 3 == 0, "").otherwise(F.concat(F.lit("rack-"), (o % 3).cast("string"))),
    )
    config = F.from_json("props", CONFIG)
    partition = F.struct(
        (o % 7).cast("int").alias("id"), F.col("_node").alias("leader"),
        F.array("_node").alias("replicas"), F.array("_node").alias("isr"),
    )
    description = F.struct(
        (F.col("event_type") == "view").alias("internal"), F.array(partition).alias("partitions")
    )
    rows = log.withColumns(
        {"_node": node, "_config": config, "entity_id": F.col("k").cast("string"),
         "op_tag": F.col("op"), "round": o, "seq": F.lit(0)}
    )
    updated = F.col("op") == UPDATED
    payloads = {
        CLUSTER: F.struct(F.col("entity_id").alias("id"), F.col("_node").alias("controller")),
        BROKER: F.struct(
            F.col("entity_id").alias("id"), F.col("_node").alias("node"), F.col("_config").alias("config")
        ),
        TOPIC: F.struct(
            F.col("entity_id").alias("name"),
            F.when(updated, description).alias("description"),
            F.when(updated, F.col("_config")).alias("config"),
        ),
    }
    return envelope.wrap_mixed(rows, F.col("entity_type"), payloads)


def ordered(spark: SparkSession, sf_dir: str, where: Column | None = None) -> DataFrame:
    """Customers with the number of their orders and the last of their priorities."""
    orders = table(spark, sf_dir, "orders")
    return (
        (orders if where is None else orders.filter(where))
        .groupBy(F.col("o_custkey").alias("k"))
        .agg(F.count(F.lit(1)).alias("n"), F.max("o_orderpriority").alias("p"))
    )


def _cut(spark: SparkSession, sf_dir: str, bounds: tuple[int, int] | None = None) -> Column:
    """The start of the middle quarter: what was ordered before it is the state,
    all else the snapshot. ``bounds`` are the quarters, if they are known."""
    year, quarter = divmod(sum(bounds or quarters(spark, sf_dir)) // 2, 4)
    return F.to_timestamp_ntz(F.lit(f"{1995 + year}-{3 * quarter + 1:02}-01 00:00:00"))


def _sides(spark: SparkSession, sf_dir: str, bounds: tuple[int, int] | None = None) -> tuple[DataFrame, DataFrame]:
    """State and snapshot, the quarters asked for once."""
    cut = _cut(spark, sf_dir, bounds)
    return tuple(ordered(spark, sf_dir, side) for side in (F.col("o_orderdate") < cut, F.col("o_orderdate") >= cut))


def _quarter() -> Column:
    date = F.col("o_orderdate")
    return ((F.year(date) - 1995) * 4 + F.quarter(date) - 1).cast("long")


def quarterly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("k"), _quarter().alias("r"))
        .agg(F.count(F.lit(1)).alias("n"), F.max("o_orderpriority").alias("p"))
    )


def _topic_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as topics, their quarter's orders as config."""
    partitions = TOPIC_STATE["description"].dataType["partitions"].dataType
    return quarterly(spark, sf_dir).select(
        F.col("r").alias("snapshot_id"),
        F.col("k").cast("string").alias("name"),
        F.struct(
            F.lit(False).alias("internal"), F.array().cast(partitions).alias("partitions")
        ).alias("description"),
        F.create_map(F.lit("n"), F.col("n").cast("string"), F.lit("p"), F.col("p")).alias("config"),
    )


def quarters(spark: SparkSession, sf_dir: str) -> tuple[int, int]:
    """First and last quarter, read off one column."""
    return snapshots.round_bounds(table(spark, sf_dir, "orders").select(_quarter().alias("r")), "r")


def suppliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    rows = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return rows.select(
        F.col("s_suppkey").alias("id"),
        F.struct(
            F.col("s_suppkey").alias("id"),
            F.col("s_name").alias("host"),
            F.col("s_nationkey").alias("port"),
            F.when(F.col("s_suppkey") % 5 != 0, F.col("n_name")).alias("rack"),
        ).alias("node"),
        F.floor(F.col("s_acctbal") / 1000).cast("long").alias("tier"),
        F.col("n_regionkey").alias("region"),
    )


def brokers_before(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All suppliers but those that have not joined yet."""
    return suppliers(spark, sf_dir).filter(F.col("tier") != 0)


def brokers_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All suppliers but those that have left; one nation's got new hosts."""
    moved = F.when(F.col("node.port") == 7, F.concat("node.host", F.lit("-moved"))).otherwise(F.col("node.host"))
    return (
        suppliers(spark, sf_dir)
        .filter(F.col("tier") != 1)
        .withColumn("node", F.col("node").withField("host", moved))
    )


def replicas(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "lineitem")
        .select(
            F.col("l_orderkey").alias("topic"),
            F.col("l_linenumber").alias("partition_id"),
            F.col("l_suppkey").alias("broker"),
        )
        .distinct()
    )


# Folding the log


def topics_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = state.fold_topics(event_log(spark, sf_dir), K, O, ["value"])
    return rows.select("k", "o", "value")


def brokers_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = state.fold_brokers(event_log(spark, sf_dir), K, O, ["value"])
    return rows.select("k", "o", "value")


def cluster_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = state.fold_cluster(event_log(spark, sf_dir), O, ["k", "value"])
    return rows.select("k", "o", "value")


def consumed_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counters.consumed(event_log(spark, sf_dir))


def canonical_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _flat_topics(views.topics(canonical_log(spark, sf_dir)))


def _flat_topics(topics: DataFrame) -> DataFrame:
    return topics.select(
        "name",
        F.col("description.internal").alias("internal"),
        F.col("description.partitions")[0]["leader"]["host"].alias("leader_host"),
        F.col("config")["k"].alias("config_k"),
    )


def canonical_brokers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.brokers(canonical_log(spark, sf_dir))
    return rows.select("id", "node.host", "node.rack", F.col("config")["k"].alias("config_k"))


def canonical_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.cluster(canonical_log(spark, sf_dir))
    return rows.select("id", F.col("controller.host").alias("controller_host"))


# One round


def diff_created(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.created(*_sides(spark, sf_dir), K)


def diff_deleted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.deleted(*_sides(spark, sf_dir), K)


def diff_known(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.known(*_sides(spark, sf_dir), K).select("k")


def diff_updated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.updated(*_sides(spark, sf_dir), K, COUNT_AND_PRIORITY)


def _changes(
    spark: SparkSession, sf_dir: str, eligible: Column | None = None, bounds: tuple[int, int] | None = None
) -> DataFrame:
    return changelog.diff(*_sides(spark, sf_dir, bounds), K, COUNT_AND_PRIORITY, eligible)


def topic_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.topic_steps(_changes(spark, sf_dir)).select("k", "seq", "op")


def topic_changelog_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only some priorities may enter; all customers that vanish are deleted."""
    eligible = filters.allowed(
        F.col("p"), allow=["1-URGENT", "4-NOT SPECIFIED", "5-LOW"], deny=["4-NOT SPECIFIED"]
    )
    return changelog.topic_steps(_changes(spark, sf_dir, eligible)).select("k", "seq", "op")


def produced_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What one round of topics, brokers and the cluster would publish."""
    bounds = quarters(spark, sf_dir)
    steps = {
        TOPIC: changelog.topic_steps(_changes(spark, sf_dir, bounds=bounds)),
        BROKER: changelog.plain_steps(_broker_changes(spark, sf_dir)),
        CLUSTER: changelog.plain_steps(cluster_diff(spark, sf_dir, bounds)),
    }
    return counters.produced(
        graph.union(*[rows.select(F.lit(kind).alias("entity_type"), "op_tag") for kind, rows in steps.items()])
    )


def _broker_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.diff(
        brokers_before(spark, sf_dir), brokers_after(spark, sf_dir), ["id"], ["node", "tier"],
        forget_absent=False,
    )


def broker_diff(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = _broker_changes(spark, sf_dir)
    return changes.select(F.col("id").cast("string").alias("id"), "op", "node.host")


def missing_brokers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = changelog.missing_nodes(brokers_before(spark, sf_dir), brokers_after(spark, sf_dir))
    return rows.select("id", "node.host")


def cluster_diff(spark: SparkSession, sf_dir: str, bounds: tuple[int, int] | None = None) -> DataFrame:
    """The last two quarters' controllers as slot and snapshot."""
    last = (bounds or quarters(spark, sf_dir))[1]
    slots = _controllers(spark, sf_dir, last - 1)
    changes = changelog.diff_one(
        slots.filter(F.col("r") == last - 1), slots.filter(F.col("r") == last), ["id", "controller"]
    )
    return changes.select("op", "id", "controller")


def failed_lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a config lookup; where it failed there is no event."""
    configs = ordered(spark, sf_dir).select(
        F.col("k").alias("c_custkey"),
        F.create_map(F.lit("p"), F.col("p")).alias("config"),
        (F.col("n") % 2 == 1).alias("lookup_failed"),
    )
    customers = table(spark, sf_dir, "customer")
    known = customers.filter(F.col("c_acctbal") >= 5000).select(
        "c_custkey", "c_name", F.create_map().cast(CONFIG).alias("config")
    )
    rows = enrich.with_config(customers.select("c_custkey", "c_name"), configs, "c_custkey")
    changes = changelog.diff(
        known, rows, ["c_custkey"], ["c_name", "config"], eligible=~F.col("lookup_failed")
    )
    return changes.select("c_custkey", "op", F.coalesce(F.col("config")["p"], F.lit("")).alias("p"))


# Many rounds


def _quarterly_changes(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    return changelog.from_snapshots(
        quarterly(spark, sf_dir), K, COUNT_AND_PRIORITY, quarters(spark, sf_dir), "r", **options
    )


def multi_round_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quarterly_changes(spark, sf_dir).select("k", "r", "op")


def multi_round_chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with few rounds per window group, as for keys with very many rounds."""
    return _quarterly_changes(spark, sf_dir, chunk=4).select("k", "r", "op")


def multi_round_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers whose top priority is the internal one are listed but say nothing."""
    return _quarterly_changes(
        spark, sf_dir, eligible=filters.visible(F.col("p") == "5-LOW", include_internal=False)
    ).select("k", "r", "op")


def broker_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rounds of keys that are never forgotten."""
    return _quarterly_changes(spark, sf_dir, forget_absent=False, chunk=4).select("k", "r", "op", "n")


def _controllers(spark: SparkSession, sf_dir: str, first: int | None = None) -> DataFrame:
    """One cluster row per quarter: its id changes every two years, its
    controller is the customer of the quarter's dearest order."""
    orders = table(spark, sf_dir, "orders").withColumn("r", _quarter())
    if first is not None:
        orders = orders.filter(F.col("r") >= first)
    dearest = F.max_by("o_custkey", F.struct("o_totalprice", "o_orderkey"))
    return orders.groupBy("r").agg(dearest.alias("controller")).withColumn(
        "id", F.concat(F.lit("cluster-"), F.floor(F.col("r") / 8).cast("string"))
    )


def cluster_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changelog.from_snapshots(
        _controllers(spark, sf_dir), [], ["id", "controller"], quarters(spark, sf_dir), "r",
        forget_absent=False, chunk=8,
    ).select("r", "op", "id", "controller")


def replayed_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log of all quarters folded again: the last quarter."""
    steps = changelog.topic_steps(_quarterly_changes(spark, sf_dir))
    return state.fold_topics(steps, K, ["r", "seq"], COUNT_AND_PRIORITY).select("k", "n", "p")


def dated_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rounds known by their order date, numbered before they are compared."""
    daily = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_orderpriority").alias("k"), F.col("o_orderdate").cast("date").alias("d"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    numbered = snapshots.number_rounds(daily, daily.select("d"), "d")
    bounds = snapshots.round_bounds(numbered, "round_no")
    return changelog.from_snapshots(numbered, K, ["n"], bounds, "round_no").select("k", "round_no", "op")


def snapshot_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return counters.snapshot_sizes(quarterly(spark, sf_dir), "r")


def stored_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarters written as topic snapshots and read back as a range of rounds."""
    path, rounds = scratch(spark, "snapshots"), quarters(spark, sf_dir)
    snapshots.write_snapshots(_topic_snapshots(spark, sf_dir), path, TOPIC, rounds)
    rows = snapshots.read_snapshots(spark, path, TOPIC, rounds)
    return rows.select(
        F.col("name").cast("long").alias("k"), F.col("snapshot_id").alias("r"),
        F.col("config")["n"].cast("long").alias("n"), F.col("config")["p"].alias("p"),
    )


# Filters, lookups, projections


def allow_deny(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return filters.allow_deny(
        rows, "c_mktsegment", allow=["FURNITURE", "BUILDING", "MACHINERY"], deny=["FURNITURE"]
    )


def allow_deny_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists that are tables: customers who ordered, less those of one region's nations."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf_dir, "nation").filter(F.col("n_regionkey") == 1)
    buyers = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"))
    kept = filters.allow_deny(rows, "c_custkey", allow=buyers)
    return filters.allow_deny(
        kept, "c_nationkey", deny=nations.select(F.col("n_nationkey").alias("c_nationkey"))
    )


def csv_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = filters.csv_list(F.col("text"))
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.size(names).cast("bigint").alias("n_names"),
        F.when(F.size(names) > 0, F.element_at(names, -1)).alias("last_name"),
    )


def include_internal(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderpriority")
    return filters.include_internal(rows, F.col("o_orderpriority") == "5-LOW").select("o_orderkey")


def topic_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return snapshots.topic_names(table(spark, sf_dir, "lineitem"), "l_orderkey")


def brokers_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cluster listings, in pieces of two nodes, as broker rows."""
    listing = suppliers(spark, sf_dir).select(
        F.col("region").cast("long").alias("snapshot_id"),
        F.array("node", F.col("node").withField("id", F.col("node.id") + 1000000)).alias("nodes"),
    )
    rows = snapshots.brokers_of(listing)
    return rows.select("snapshot_id", "id", "node.host", "node.rack")


def config_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    configs = ordered(spark, sf_dir).select(F.col("k").alias("c_custkey"), F.col("p").alias("priority"))
    rows = enrich.with_config(
        table(spark, sf_dir, "customer").select("c_custkey"), configs, "c_custkey", "priority", F.lit("")
    )
    return rows.select("c_custkey", "priority")


def resource_configs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one table as configs of several resource types; only topics' are used."""
    configs = event_log(spark, sf_dir).select(
        F.col("k").alias("c_custkey"),
        F.initcap("entity_type").alias("resource_type"),
        "o",
        F.from_json("props", CONFIG).alias("config"),
    )
    last = state.latest(configs, ["c_custkey", "resource_type"], O, ["config"])
    rows = enrich.with_config(
        table(spark, sf_dir, "customer").select("c_custkey"), last, "c_custkey", resource="TOPIC"
    )
    return rows.select("c_custkey", F.col("config")["k"].alias("config_k"))


def config_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = canon.config(F.from_json("props", CONFIG))
    return event_log(spark, sf_dir).select("o", config["k"].alias("config_k"))


def config_last_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Config entry rows with repeated names as one map per key."""
    entries = event_log(spark, sf_dir).select(
        "k", F.col("event_type").alias("name"), F.col("value").cast("string").alias("value"), "o"
    )
    configs = snapshots.config_of_rows(entries, K, order="o")
    rows = configs.select("k", F.explode("config").alias("name", "value"))
    return rows.select("k", "name", F.col("value").cast("double").alias("value"))


def described_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with the number of their lines; orders without lines drop out."""
    names = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("name"), "o_orderpriority")
    lines = (
        replicas(spark, sf_dir).select("topic", "partition_id").distinct()
        .groupBy(F.col("topic").alias("name")).agg(F.count(F.lit(1)).alias("n_partitions"))
    )
    return enrich.with_description(names, lines)


def topic_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("topic"),
        F.col("l_linenumber").alias("partition_id"),
        F.col("l_suppkey").alias("broker"),
    )
    partitions = snapshots.replica_lists(rows, ["topic", "partition_id"], "broker")
    fields = ["partition_id", "leader", "replicas"]
    described = snapshots.build_descriptions(
        partitions.withColumns({"leader": F.col("replicas")[0], "internal": F.lit(False)}),
        fields=fields,
    )
    text = F.transform(
        "description.partitions",
        lambda p: F.concat_ws(
            ":", p["partition_id"].cast("string"), p["leader"].cast("string"),
            F.array_join(p["replicas"].cast("array<string>"), ","),
        ),
    )
    return described.select(
        "topic",
        F.size("description.partitions").cast("bigint").alias("n_partitions"),
        F.array_join(text, ";").alias("partitions"),
    )


def chunked_descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Suppliers as topics, order lines as their partitions, a few at a time."""
    rows = table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_suppkey").alias("topic"), F.col("l_orderkey").alias("partition_id")
    ).agg(F.max("l_quantity").alias("leader"))
    chunks = snapshots.description_chunks(
        rows.withColumn("internal", F.lit(False)), 500, fields=["partition_id", "leader"]
    )
    text = F.transform("partitions", lambda p: F.concat_ws(":", p["partition_id"].cast("string"), p["leader"].cast("int").cast("string")))
    return chunks.select("topic", "chunk", F.size("partitions").cast("long").alias("n_partitions"), F.array_join(text, ";").alias("partitions"))


def digest_changelog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes of all quarters found by digests of the values."""
    rounds = quarters(spark, sf_dir)
    return changelog.by_digest(quarterly(spark, sf_dir), K, COUNT_AND_PRIORITY, rounds, round="r").select("k", "r", "op", "n", "p")


def environment_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameters read from an environment, applied to the nations."""
    env = {
        "COLLECTOR_TOPIC_WHITELIST": "NATION_10,NATION_3,,NATION_9,NATION_19", "COLLECTOR_TOPIC_BLACKLIST": "NATION_19",
        "COLLECTOR_TOPIC_INCLUDE_INTERNAL": "off", "COLLECTOR_TOPIC_POLL_INTERVAL": "90s",
    }
    params = Params.from_env(env)
    rows = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    shown = filters.allowed(F.col("n_name"), params.allow, params.deny) & filters.visible(F.col("c_mktsegment") == "MACHINERY", params.include_internal)
    return rows.filter(shown).select("c_custkey", "n_name", F.lit(duration(params.topic_poll_interval)).alias("interval"))


# Envelope and log


def envelope_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = event_log(spark, sf_dir).withColumn("entity_id", F.col("k").cast("string"))
    return log.select(envelope.entity_key().alias("record_key"), "o")


def route_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    topics = envelope.route(canonical_log(spark, sf_dir))[TOPIC]
    return topics.select(F.col("name").cast("long").alias("k"), F.col("round").alias("o"), "op")


def merged_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events wrapped kind by kind and merged into one log."""
    log = event_log(spark, sf_dir)
    rows = log.select(
        "entity_type", "op", F.col("o").alias("round"), F.lit(0).alias("seq"),
        F.col("k").cast("string").alias("id"), F.col("k").cast("string").alias("name"),
        F.from_json("props", CONFIG).alias("config"),
        F.lit(None).alias("controller"), F.lit(None).alias("node"), F.lit(None).alias("description"),
    )
    kinds = [
        envelope.wrap(rows.filter(F.col("entity_type") == kind), kind) for kind in (CLUSTER, BROKER, TOPIC)
    ]
    merged = envelope.merge(*kinds)
    id = F.coalesce("cluster.id", "broker.id", "topic.name")
    return merged.select(envelope.kind_of().alias("kind"), "op", F.col("round").alias("o"), id.alias("id"))


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Valid and reported events; some lose their payload, some are mislabelled."""
    log = canonical_log(spark, sf_dir)
    emptied = F.col("round") % 11 == 0
    log = log.withColumns(
        {arm: F.when(~emptied, F.col(arm)) for arm in ("cluster", "broker", "topic")}
    ).withColumn("entity_type", F.when(F.col("round") % 13 == 0, CLUSTER).otherwise(F.col("entity_type")))
    valid, report = envelope.quarantine(log)
    return graph.union(
        *[
            rows.select("problem", "entity_type", F.col("round").alias("o"))
            for rows in (valid.withColumn("problem", F.lit("valid")), report)
        ]
    )


def _flat_events(events: DataFrame) -> DataFrame:
    node = F.coalesce("cluster.controller", "broker.node", F.col("topic.description.partitions")[0]["leader"])
    return events.select(
        F.col("round").alias("o"),
        "entity_type",
        "entity_id",
        "op",
        node["host"].alias("host"),
        node["rack"].alias("rack"),
        F.coalesce(F.col("broker.config"), F.col("topic.config"))["k"].alias("config_k"),
        F.col("topic.description.internal").alias("internal"),
        F.col("topic.description.partitions")[0]["id"].alias("partition_id"),
        F.size("topic.description.partitions").alias("n_partitions"),
    ).withColumn("n_partitions", F.when(F.col("internal").isNotNull(), F.col("n_partitions")))


def _valid_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return envelope.quarantine(canonical_log(spark, sf_dir))[0]


def _round_trip(spark: SparkSession, sf_dir: str, format: str) -> DataFrame:
    records = logs.to_records(_valid_events(spark, sf_dir), format)
    return _flat_events(logs.from_records(records, format))


def codec_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, sf_dir, "json")


def codec_protobuf(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _round_trip(spark, sf_dir, "protobuf")


def record_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written to a record log and read back from the beginning."""
    path = scratch(spark, "records")
    logs.append_records(_valid_events(spark, sf_dir), path)
    return _flat_events(logs.read_records(spark, path))


def record_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records by key and entity type header."""
    records = logs.to_records(_valid_events(spark, sf_dir))
    header = F.decode(F.col("headers")[0]["value"], "UTF-8")
    return records.groupBy("key", header.alias("header")).agg(
        F.count(F.lit(1)).alias("n"), F.max("round").alias("last")
    )


def table_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events written to a table log and read back."""
    path = scratch(spark, "log")
    logs.append_log(_valid_events(spark, sf_dir), path, batch=0)
    return _flat_events(logs.read_log(spark, path))


def stored_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics folded from the written log, of which only their own files are read."""
    path = scratch(spark, "log")
    logs.append_log(_valid_events(spark, sf_dir), path, batch=0)
    return _flat_topics(views.topics(logs.read_log(spark, path)))


def described_created(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Announced topics, each described by its last value in the log."""
    log = canonical_log(spark, sf_dir)
    events = poll.describe_created(log, views.topics(log))
    return events.select(
        F.col("topic.name").alias("name"), F.col("round").alias("o"), "op", "op_tag", "seq",
        F.col("topic.config")["k"].alias("config_k"),
    )


def json_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The topics view as JSON, parsed back."""
    shape = "struct<name:string,description:struct<internal:boolean,partitions:array<struct<leader:struct<host:string>>>>,config:struct<entries:map<string,string>>>"
    rows = views.to_json_view(views.topics(canonical_log(spark, sf_dir)))
    return rows.select(F.from_json("json", shape).alias("t")).select(
        "t.name",
        "t.description.internal",
        F.col("t.description.partitions")[0]["leader"]["host"].alias("leader_host"),
        F.col("t.config.entries")["k"].alias("config_k"),
    )


def stored_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The brokers view written as JSON lines and read back."""
    path = scratch(spark, "json")
    views.write_json_view(views.brokers(canonical_log(spark, sf_dir)), path)
    shape = "id string, node struct<host:string,rack:string>, config struct<entries:map<string,string>>"
    rows = spark.read.schema(shape).json(path)
    return rows.select("id", "node.host", "node.rack", F.col("config.entries")["k"].alias("config_k"))


def stored_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "counters")
    counters.write_counters(counters.consumed(event_log(spark, sf_dir)), path)
    return spark.read.parquet(path)


def sql_views(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered views queried in SQL: topics by configured value."""
    return _queried(
        spark, sf_dir,
        "select config['k'] as config_k, count(*) as n_topics,"
        " count_if(description.internal) as n_internal from log_topics group by 1",
    )


def sql_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events view queried in SQL: announced topics and moved controllers."""
    return _queried(
        spark, sf_dir,
        "select round as o, entity_id, op, coalesce(topic.name, cluster.id) as id,"
        " cluster.controller.host as host from log_events"
        " where (topic is not null and op = 'Created') or (cluster is not null and op = 'Updated')",
    )


def _queried(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    """SQL over the registered views, which are gone again afterwards."""
    views.register_views(canonical_log(spark, sf_dir), prefix="log_")
    rows = spark.sql(sql)
    for name in views.VIEWS:
        spark.catalog.dropTempView(f"log_{name}")
    return rows


# Graph


def graph_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    brokers = suppliers(spark, sf_dir).select("id", F.col("node.rack").alias("rack"))
    return graph.union(
        graph.held_entities(replicas(spark, sf_dir)),
        graph.broker_entities(brokers),
        graph.rack_entities(brokers),
    )


def graph_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.partition_replicas(replicas(spark, sf_dir))


def graph_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.topic_partitions(replicas(spark, sf_dir).select("topic", "partition_id").distinct())


def graph_replica_brokers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.replica_brokers(replicas(spark, sf_dir))


def graph_isr(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replicas with open lines are in sync, the lowest supplier leads."""
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("topic"), F.col("l_linenumber").alias("partition_id"),
        F.col("l_suppkey").alias("broker"), "l_linestatus",
    )
    at = ["topic", "partition_id"]
    flags = lines.groupBy(*at, "broker").agg(F.max(F.col("l_linestatus") == "O").alias("in_sync"))
    lowest = F.min("broker").over(Window.partitionBy(*at))
    return graph.replica_roles(flags.withColumn("leader", F.col("broker") == lowest))


def graph_from_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entities and relations of the folded canonical log."""
    path = scratch(spark, "views")
    views.write_views(canonical_log(spark, sf_dir), path)
    entities, relations = graph.from_state(
        *[views.read_view(spark, path, name) for name in ("topics", "brokers", "cluster")]
    )
    return entities.select(
        F.lit("entity").alias("what"), F.col("entity_type").alias("name"),
        F.col("entity_id").alias("source"), F.lit(None).cast("string").alias("destination"),
    ).unionByName(relations.withColumn("what", F.lit("relation")))


def kept_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The graph of the canonical log, kept up to date by a stream over its parts."""
    path = scratch(spark, "graph")
    events = _valid_events(spark, sf_dir)
    part = F.pmod(F.xxhash64("round"), F.lit(3))
    for batch in range(3):
        logs.append_log(events.filter(part == batch), f"{path}/log", batch=batch)
        graph_view.follow(logs.read_log(spark, f"{path}/log", stream=True), f"{path}/facts", f"{path}/c", once=True, fan=2).awaitTermination()
    return graph_view.read(spark, f"{path}/facts")


def rack_brokers(spark: SparkSession, sf_dir: str) -> DataFrame:
    brokers = suppliers(spark, sf_dir).select("id", F.col("node.rack").alias("rack"))
    return graph.member_brokers(brokers, "rack")


def cluster_brokers(spark: SparkSession, sf_dir: str) -> DataFrame:
    region = table(spark, sf_dir, "region")
    brokers = suppliers(spark, sf_dir).join(region, F.col("region") == F.col("r_regionkey"))
    return graph.member_brokers(brokers, "r_name")


def graph_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as clients producing to the topic named after their order; the
    suppliers of its lines consume it."""
    orders = table(spark, sf_dir, "orders")
    produce = orders.select(
        F.lit("producing").alias("role"), F.col("o_custkey").alias("client"), F.col("o_orderkey").alias("topic")
    )
    consume = (
        table(spark, sf_dir, "lineitem")
        .select("l_orderkey", "l_suppkey").distinct()
        .select(F.lit("consuming").alias("role"), F.col("l_suppkey").alias("client"), F.col("l_orderkey").alias("topic"))
    )
    return graph.client_topics(produce.unionByName(consume))


def graph_schemas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part brands as schemas, used by the suppliers who ship such parts."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    uses = (
        table(spark, sf_dir, "lineitem")
        .select("l_partkey", "l_suppkey").distinct()
        .join(part, F.col("l_partkey") == F.col("p_partkey"))
        .select(F.col("p_brand").alias("subject"), F.col("l_suppkey").alias("user"))
        .distinct()
    )
    return graph.schema_users(uses)


def graph_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Brokers with operational metadata for those in one half of the tiers."""
    rows = suppliers(spark, sf_dir)
    metadata = rows.filter(F.col("tier") >= 5).select(
        F.lit("Broker").alias("entity_type"),
        F.col("id").cast("string").alias("entity_id"),
        F.create_map(F.lit("tier"), F.col("tier").cast("string")).alias("op_metadata"),
        F.create_map(F.lit("host"), F.col("node.host")).alias("org_metadata"),
    )
    found = graph.with_metadata(graph.broker_entities(rows), metadata)
    return found.select(
        "entity_type", "entity_id",
        F.col("op_metadata")["tier"].alias("tier"), F.col("org_metadata")["host"].alias("host"),
    )


# Streams. Each takes what is there, ends, and returns what it wrote.


def _run(rows: DataFrame, path: str) -> None:
    query = materialise.write_changes(rows, f"{path}/state", f"{path}/checkpoint", once=True)
    query.awaitTermination()


def stream_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "stream-topics")
    rows = materialise.follow_state(
        event_stream(spark, sf_dir), K, O, ["value"], ignore=[CREATED], remove=[DELETED]
    )
    _run(rows, path)
    return materialise.read_state(spark, f"{path}/state", rows.schema, K, O).select("k", "o", "value")


def stream_brokers(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "stream-brokers")
    rows = materialise.follow_state(event_stream(spark, sf_dir), K, O, ["value"], ignore=[DELETED])
    _run(rows, path)
    return materialise.read_state(spark, f"{path}/state", rows.schema, K, O).select("k", "o", "value")


def stream_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "stream-cluster")
    rows = materialise.follow_state(event_stream(spark, sf_dir), [], O, ["k", "value"], ignore=[DELETED])
    _run(rows, path)
    return materialise.read_state(spark, f"{path}/state", rows.schema, [], O).select("k", "o", "value")


def stream_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "stream-counters")
    rows = materialise.follow_counters(event_stream(spark, sf_dir))
    _run(rows, path)
    return materialise.read_counters(spark, f"{path}/state", rows.schema)


def stream_snapshots_to_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarters written as topic snapshots, followed by the poll stream."""
    path = scratch(spark, "poll")
    snapshots.write_snapshots(
        _topic_snapshots(spark, sf_dir), f"{path}/in", TOPIC, quarters(spark, sf_dir)
    )
    streaming_poll.snapshots_to_log(
        spark, f"{path}/in", f"{path}/out", TOPIC, Params(include_internal=True), once=True
    ).awaitTermination()
    return _flat_topic_events(streaming_poll.read_log(spark, f"{path}/out", [TOPIC]))


def _flat_topic_events(log: DataFrame) -> DataFrame:
    return log.select(
        F.col("entity_id").cast("long").alias("k"), F.col("round").alias("r"), "seq", "op", "op_tag",
        F.col("topic.config")["n"].cast("long").alias("n"),
    )


def _served(spark: SparkSession, sf_dir: str, keys: list[str], values: list[str], **follow) -> DataFrame:
    rows = materialise.follow_state(event_stream(spark, sf_dir), keys, O, values, **follow)
    checkpoint = scratch(spark, "served")
    materialise.keep_state(rows, checkpoint, once=True).awaitTermination()
    return materialise.served_state(spark, checkpoint, rows.schema, keys, O).select("k", "o", "value")


def served_topics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topics from the state store of a stream over the log."""
    return _served(spark, sf_dir, K, ["value"], ignore=[CREATED], remove=[DELETED])


def served_brokers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _served(spark, sf_dir, K, ["value"], ignore=[DELETED])


def served_cluster(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _served(spark, sf_dir, [], ["k", "value"], ignore=[DELETED])


def _polled_in_parts(spark: SparkSession, sf_dir: str, parts: int = 4) -> str:
    """Quarters written and polled in several parts, the state's layers merged by two."""
    path = scratch(spark, "poll")
    snaps, (first, last) = _topic_snapshots(spark, sf_dir), quarters(spark, sf_dir)
    for n in range(parts):
        low, high = (first + (last - first + 1) * m // parts for m in (n, n + 1))
        part = snaps.filter(F.col("snapshot_id").between(low, high - 1))
        snapshots.write_snapshots(part, f"{path}/in", TOPIC, (low, high - 1))
        streaming_poll.snapshots_to_log(
            spark, f"{path}/in", f"{path}/out", TOPIC, Params(include_internal=True), once=True, fan=2
        ).awaitTermination()
    return f"{path}/out"


def poll_restarted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarters polled by a stream that is stopped while it runs, and by another that goes on from there."""
    path = scratch(spark, "poll")
    snaps, (first, last) = _topic_snapshots(spark, sf_dir), quarters(spark, sf_dir)
    middle = (first + last) // 2
    params = Params(include_internal=True, topic_poll_interval="200 ms")
    follow = lambda once: streaming_poll.snapshots_to_log(spark, f"{path}/in", f"{path}/out", TOPIC, params, once=once)
    snapshots.write_snapshots(snaps.filter(F.col("snapshot_id") <= middle), f"{path}/in", TOPIC, (first, middle))
    running = follow(False)
    running.processAllAvailable()
    streaming_poll.stop(running)
    snapshots.write_snapshots(snaps.filter(F.col("snapshot_id") > middle), f"{path}/in", TOPIC, (middle + 1, last))
    follow(True).awaitTermination()
    return _flat_topic_events(streaming_poll.read_log(spark, f"{path}/out", [TOPIC]))


def poll_state_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """State as it is after all polls, and as it was before the last."""
    out = _polled_in_parts(spark, sf_dir)
    batch = max(v for v in commits.versions(spark, streaming_poll.state_path(out, TOPIC)))
    found = [
        streaming_poll.read_state(spark, out, TOPIC, n).select(
            F.lit(when).alias("version"), F.col("name").cast("long").alias("k"), F.col("config")["n"].cast("long").alias("n")
        )
        for when, n in (("last", batch), ("before", batch - 1))
    ]
    return found[0].unionByName(found[1])


def poll_log_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as it was before the last poll, read after its files were merged."""
    out = _polled_in_parts(spark, sf_dir)
    log = streaming_poll.log_path(out)
    batch = max(commits.versions(spark, f"{log}/writer=topic")) // 2
    logs.merge_log(spark, log, "topic", batch)
    return _flat_topic_events(streaming_poll.read_log(spark, out, [TOPIC], {TOPIC: batch - 1}))


def followed_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events counted by following a committed log, each once, over a merger of its files."""
    path = scratch(spark, "followed")
    events = _valid_events(spark, sf_dir)
    at = F.pmod(F.xxhash64("entity_id"), F.lit(3))

    def follow() -> None:
        logs.follow_log(
            spark, f"{path}/log", "w",
            lambda rows, n: counters.count_batch(rows, f"{path}/counts", n), f"{path}/checkpoint", once=True,
        ).awaitTermination()

    for batch in range(3):
        logs.commit_log(events.filter(at == batch), f"{path}/log", "w", batch)
        if batch == 1:
            follow()
            logs.merge_log(spark, f"{path}/log", "w", batch)
    follow()
    return counters.counted(spark, f"{path}/counts")


def listed_brokers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Broker events of cluster listings and looked-up configs, polled together.

    Suppliers are nodes, listed in the quarters they ship in; their port is the number
    of lines and their config the last ship mode. Some have no config, some lookups fail.
    """
    path = scratch(spark, "listings")
    quarter = (F.year("l_shipdate") - 1992) * 4 + F.quarter("l_shipdate")
    listed = table(spark, sf_dir, "lineitem").groupBy(
        quarter.cast("long").alias("snapshot_id"), F.col("l_suppkey").cast("int").alias("s")
    ).agg(F.count(F.lit(1)).cast("int").alias("lines"), F.max("l_linestatus").alias("mode"))
    path_of = lambda name: f"{path}/{name}"
    listed.write.parquet(path_of("rows"))
    listed = spark.read.parquet(path_of("rows"))
    node = F.struct(
        F.col("s").alias("id"), F.concat(F.lit("host-"), F.col("s").cast("string")).alias("host"),
        F.col("lines").alias("port"), F.lit(None).cast("string").alias("rack"),
    )
    # A listing in parts, with any number of nodes in all.
    clusters = listed.groupBy("snapshot_id", (F.col("s") % 64).alias("part")).agg(F.collect_list(node).alias("nodes"))
    clusters = clusters.select(
        "snapshot_id", F.lit("c").alias("id"), F.lit(None).cast(NODE).alias("controller"), "nodes"
    )
    configs = listed.filter("s % 7 <> 0").select(
        "snapshot_id", F.lit("broker").alias("resource_type"), F.col("s").cast("string").alias("name"),
        F.create_map(F.lit("mode"), "mode").alias("config"), (F.col("s") % 11 == 3).alias("lookup_failed"),
    )
    rounds = snapshots.round_bounds(listed)
    snapshots.write_snapshots(configs, path_of("in"), CONFIGS, rounds)
    snapshots.write_snapshots(clusters, path_of("in"), CLUSTER, rounds)
    streaming_poll.snapshots_to_log(
        spark, path_of("in"), path_of("out"), streaming_poll.CLUSTER_LISTING, once=True
    ).awaitTermination()
    log = streaming_poll.read_log(spark, path_of("out"), [streaming_poll.CLUSTER_LISTING.name])
    return log.filter("broker is not null").select(
        F.col("broker.id").cast("long").alias("id"), F.col("round").alias("r"), "op",
        F.col("broker.node.port").cast("long").alias("port"), F.col("broker.config")["mode"].alias("mode"),
    )


def missing_broker_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of quarters in which a customer seen before does not order, or not as it last did."""
    listed, rounds = quarterly(spark, sf_dir), quarters(spark, sf_dir)
    return changelog.missing_rounds(listed, K, "p", rounds, round="r")


QUERIES = {
    f.__name__: f
    for f in (
        topics_current, brokers_current, cluster_current, consumed_counters,
        canonical_topics, canonical_brokers, canonical_cluster,
        diff_created, diff_deleted, diff_known, diff_updated,
        topic_changelog, topic_changelog_filtered, produced_counters,
        broker_diff, missing_brokers, cluster_diff, failed_lookups,
        multi_round_changelog, multi_round_chunked, multi_round_filtered,
        broker_changelog, cluster_changelog, replayed_state, dated_rounds, snapshot_sizes, stored_snapshots,
        allow_deny, allow_deny_tables, csv_lists, include_internal,
        topic_names, brokers_of, config_enrich, resource_configs, config_map, config_last_wins,
        topic_descriptions, described_topics,
        envelope_keys, route_topics, merged_kinds, quarantine,
        codec_json, codec_protobuf, record_log, record_keys, table_log, stored_topics, described_created,
        json_topics, stored_json, stored_counters, sql_views, sql_events,
        graph_entities, graph_relations, graph_partitions, graph_replica_brokers, graph_isr,
        graph_from_state, rack_brokers, cluster_brokers,
        graph_clients, graph_schemas, graph_metadata,
        stream_topics, stream_brokers, stream_cluster, stream_counters, stream_snapshots_to_log,
        kept_graph, chunked_descriptions, digest_changelog, environment_lists, poll_restarted,
        served_topics, served_brokers, served_cluster, poll_state_versions, poll_log_version, followed_counters, listed_brokers, missing_broker_rounds,
    )
}
