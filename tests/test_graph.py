"""Entities and relations of a small cluster."""

from __future__ import annotations

import random
from functools import reduce

from pyspark.sql import functions as F
from rows import description, events, node, partition, state, table, topic

from entitylog.operators import graph
from entitylog.operators import state as folds
from entitylog.schema import BROKER, CLUSTER, CREATED, DELETED, TOPIC, UPDATED
from entitylog.sources import commits
from entitylog.sources import log as logs
from entitylog.streaming import graph_view


def test_graph_of_state(spark):
    a, b = node(1, rack="r1"), node(2)
    topics = state(
        spark, TOPIC,
        topic("t", description(False, [partition(0, a, [a, b], [a]), partition(1, None, [b])])), topic("u", description()),
    )
    brokers = state(spark, BROKER, {"id": "1", "node": a}, {"id": "2", "node": b})
    cluster = state(spark, CLUSTER, {"id": "c", "controller": a})
    clients = spark.createDataFrame([("app",)], "id string")
    uses = spark.createDataFrame([("producing", "app", "t"), ("consuming", "app", "u")], "role string, client string, topic string")
    schemas = spark.createDataFrame([("subject",)], "subject string")
    users = spark.createDataFrame([("subject", "app")], "subject string, user string")
    entities, relations = graph.from_state(topics, brokers, cluster, clients, uses, schemas, users)
    assert table(entities, "entity_type", "entity_id") == [
        ("Broker", "1"), ("Broker", "2"), ("Client", "app"), ("Cluster", "c"), ("Rack", "r1"), ("Schema", "subject"),
        ("Topic", "t"), ("Topic", "u"), ("TopicPartition", "t-0"), ("TopicPartition", "t-1"),
        ("TopicPartitionReplica", "t-0-1"), ("TopicPartitionReplica", "t-0-2"), ("TopicPartitionReplica", "t-1-2"),
    ]
    assert table(relations, "name", "source", "destination") == [
        ("broker", "t-0-1", "1"), ("broker", "t-0-2", "2"), ("broker", "t-1-2", "2"),
        ("brokers", "c", "1"), ("brokers", "c", "2"), ("brokers", "r1", "1"),
        ("consuming", "app", "u"),
        ("isr", "t-0", "t-0-1"), ("isr", "t-1", "t-1-2"),
        ("partitions", "t", "t-0"), ("partitions", "t", "t-1"),
        ("producing", "app", "t"),
        ("replicas", "t-0", "t-0-1"), ("replicas", "t-0", "t-0-2"), ("replicas", "t-1", "t-1-2"),
        ("usedBy", "subject", "app"),
    ]
    flags = graph.replica_rows(graph.partition_rows(topics))
    assert table(flags, "partition_id", "broker", "leader", "in_sync") == [
        (0, 1, True, True), (0, 2, False, False), (1, 2, False, True)
    ]


def test_no_cluster_no_cluster_relations(spark):
    brokers = state(spark, BROKER, {"id": "1", "node": node(1)})
    assert graph.cluster_brokers(brokers, state(spark, CLUSTER).select("id")).count() == 0


def test_metadata(spark):
    entities = spark.createDataFrame([("Topic", "t"), ("Broker", "t")], "entity_type string, entity_id string")
    metadata = spark.createDataFrame(
        [("Topic", "t", {"a": "1"}, None)],
        "entity_type string, entity_id string, op_metadata map<string,string>, org_metadata map<string,string>",
    )
    got = {r["entity_type"]: (r["op_metadata"], r["org_metadata"]) for r in graph.with_metadata(entities, metadata).collect()}
    assert got == {"Topic": ({"a": "1"}, {}), "Broker": ({}, {})}


def test_kept_graph_equals_the_state_after_every_batch(spark, tmp_path):
    rng = random.Random(11)
    rows = []
    for _ in range(120):
        kind = rng.choice([TOPIC, TOPIC, BROKER, CLUSTER])
        n = node(rng.randrange(4), rack=rng.choice([None, "", "r1", "r2"]))
        if kind == TOPIC:
            op = rng.choice([CREATED, UPDATED, UPDATED, DELETED])
            parts = [partition(p, n, [n, node(5)][: rng.randrange(3)], [node(5)][: rng.randrange(2)]) for p in range(rng.randrange(3))]
            rows.append((kind, op, topic(f"t{rng.randrange(5)}", description(False, parts) if op == UPDATED else None)))
        elif kind == BROKER:
            rows.append((kind, rng.choice([CREATED, UPDATED]), {"id": str(rng.randrange(4)), "node": n, "config": {}}))
        else:
            rows.append((kind, UPDATED, {"id": rng.choice("cd"), "controller": n}))
    log = events(spark, *rows).cache()
    path = str(tmp_path / "log")
    done = []
    # Later events first: what comes late changes nothing.
    for batch, (low, high) in enumerate([(20, 49), (0, 19), (50, 79), (80, 99), (100, 119)]):
        logs.append_log(log.filter(F.col("round").between(low, high)), path, batch=batch)
        done.append(F.col("round").between(low, high))
        stream = logs.read_log(spark, path, stream=True)
        graph_view.follow(stream, str(tmp_path / "facts"), str(tmp_path / "c"), once=True, fan=2).awaitTermination()
        so_far = log.filter(reduce(lambda a, b: a | b, done))
        brokers = folds.brokers_current(so_far).withColumn("node", F.col("node").withField("rack", F.nullif("node.rack", F.lit(""))))
        entities, relations = graph.from_state(folds.topics_current(so_far), brokers, folds.cluster_current(so_far))
        want = {("entity", r.entity_type, r.entity_id, None) for r in entities.distinct().collect()}
        want |= {("relation", *r) for r in relations.distinct().collect()}
        got = [tuple(r) for r in graph_view.read(spark, str(tmp_path / "facts")).collect()]
        assert len(got) == len(set(got)) and set(got) == want
    assert commits.versions(spark, str(tmp_path / "facts")) == [3, 4]
