"""What a topic, broker and cluster poller is expected to do, as tables."""

from __future__ import annotations

import pytest
from rows import description, events, node, partition, snapshot, state, table, topic

from entitylog.operators import changelog
from entitylog.operators.state import brokers_current, cluster_current, topics_current
from entitylog.params import Params
from entitylog.plans import poll
from entitylog.schema import BROKER, CLUSTER, CREATED, DELETED, TOPIC, UPDATED

ALL = Params(include_internal=True)


def listed(spark, round, *names, internal=(), config=None):
    return snapshot(
        spark, TOPIC,
        *[{"snapshot_id": round, "name": n, "description": description(n in internal), "config": config or {}} for n in names],
    )


def created_names(df):
    return [r[0] for r in table(df.filter(df.op == CREATED), "entity_id")]


def test_each_round_is_compared(spark):
    snaps = listed(spark, 1, "a").union(listed(spark, 2, "a", "b")).union(listed(spark, 3, "b"))
    got = table(poll.topic_events(snaps, (1, 3), ALL), "round", "entity_id", "seq", "op", "op_tag")
    assert got == [
        (1, "a", 1, CREATED, CREATED), (1, "a", 2, UPDATED, CREATED),
        (2, "b", 1, CREATED, CREATED), (2, "b", 2, UPDATED, CREATED),
        (3, "a", 0, DELETED, DELETED),
    ]


def test_topic_state_follows_the_log(spark):
    log = [(TOPIC, CREATED, topic(f"topic-{i}")) for i in (1, 2, 3)]
    assert topics_current(events(spark, *log)).count() == 0
    d = description(partitions=[partition(0, node(0))])
    log += [(TOPIC, UPDATED, topic("topic-1", d, {})), (TOPIC, UPDATED, topic("topic-2", d, {}))]
    assert topics_current(events(spark, *log)).count() == 2
    log += [(TOPIC, DELETED, topic("topic-2"))]
    assert table(topics_current(events(spark, *log)), "name") == [("topic-1",)]


@pytest.mark.parametrize("include, n", [(True, 3), (False, 2)])
def test_internal_topics(spark, include, n):
    snaps = listed(spark, 1, "topic-1", "topic-2", "topic-3", internal=["topic-3"])
    got = poll.topic_events(snaps, (1, 1), Params(include_internal=include))
    assert len(created_names(got)) == n


@pytest.mark.parametrize(
    "params, names",
    [
        (Params(deny=("topic-3",)), ["topic-1", "topic-2"]),
        (Params(allow=("topic-3",)), ["topic-3"]),
        (Params(allow=("topic-3",), deny=("topic-3",)), []),
    ],
)
def test_allow_and_deny(spark, params, names):
    snaps = listed(spark, 1, "topic-1", "topic-2", "topic-3")
    assert created_names(poll.topic_events(snaps, (1, 1), params)) == names


def test_delete_detection(spark):
    known = state(spark, TOPIC, *[topic(f"topic-{i}", description(), {}) for i in (1, 2, 3)])
    snaps = listed(spark, 9, "topic-1", "topic-2")
    got = poll.topic_events(snaps, (9, 9), ALL, known)
    assert table(got, "round", "entity_id", "op") == [(9, "topic-3", DELETED)]


def test_denied_topic_in_state_is_deleted_only_when_gone(spark):
    known = state(spark, TOPIC, topic("a", description(), {}), topic("b", description(), {}))
    params = Params(deny=("a", "b"))
    snaps = listed(spark, 1, "a", config={"changed": "yes"})
    assert table(poll.topic_events(snaps, (1, 1), params, known), "entity_id", "op") == [("b", DELETED)]


def test_empty_round_deletes_everything(spark):
    snaps = listed(spark, 1, "a")
    got = poll.topic_events(snaps, (1, 2), ALL)
    assert table(got.filter("round = 2"), "entity_id", "op") == [("a", DELETED)]


def test_failed_lookup_says_nothing(spark):
    known = state(spark, TOPIC, topic("a", description(), {}))
    snaps = snapshot(
        spark, TOPIC,
        {"snapshot_id": 1, "name": "a", "description": description(), "config": {"x": "1"}, "lookup_failed": True},
        {"snapshot_id": 1, "name": "b", "description": None, "config": {}},
    )
    assert poll.topic_events(snaps, (1, 1), ALL, known).count() == 0


def broker_rows(spark, round, *rows):
    return snapshot(
        spark, BROKER,
        *[{"snapshot_id": round, "id": str(n["id"]), "node": n, "config": c} for n, c in rows],
    )


def test_new_broker_is_created(spark):
    got = poll.broker_events(broker_rows(spark, 1, (node(0), {})), (1, 1))
    assert table(got, "entity_id", "op", "broker.node.host") == [("0", CREATED, "localhost")]


def test_changed_broker_is_updated(spark):
    known = state(spark, BROKER, *[{"id": str(i), "node": node(i), "config": {}} for i in (0, 1, 2)])
    snaps = broker_rows(spark, 1, (node(1, "other-host"), {"a": "b"}))
    got = poll.broker_events(snaps, (1, 1), state=known)
    assert table(got, "entity_id", "op", "broker.node.host") == [("1", UPDATED, "other-host")]


def test_broker_state_follows_the_log(spark):
    log = [(BROKER, CREATED, {"id": str(i), "node": node(i), "config": None}) for i in (0, 1, 2)]
    log += [(BROKER, UPDATED, {"id": "0", "node": node(0, "host"), "config": None})]
    got = brokers_current(events(spark, *log))
    assert table(got, "id", "node.host") == [("0", "host"), ("1", "localhost"), ("2", "localhost")]


def test_broker_that_comes_back_unchanged_is_not_new(spark):
    snaps = broker_rows(spark, 1, (node(0), {})).union(broker_rows(spark, 4, (node(0), None)))
    assert table(poll.broker_events(snaps, (1, 4)), "round", "op") == [(1, CREATED)]


def test_missing_broker_is_reported(spark):
    known = state(spark, BROKER, *[{"id": str(i), "node": node(i, rack="" if i else None), "config": {}} for i in (0, 1, 2)])
    listed = broker_rows(spark, 1, (node(1), {}), (node(2, "moved"), {}))
    assert table(changelog.missing_nodes(known, listed), "id") == [("0",), ("2",)]


def cluster_rows(spark, *rows):
    return snapshot(
        spark, CLUSTER,
        *[{"snapshot_id": r, "id": id, "controller": c, "nodes": nodes} for r, id, c, nodes in rows],
    )


def test_cluster_rounds(spark):
    snaps = cluster_rows(
        spark, (1, "c", node(0), []), (2, "c", node(0, rack=""), []), (3, "c", node(1), []),
        (3, "c", node(1), [node(7)]), (4, "d", node(1), []),
    )
    got = poll.cluster_events(snaps, (1, 4))
    assert table(got, "round", "op", "entity_id", "cluster.controller.id") == [
        (1, CREATED, "c", 0), (3, UPDATED, "c", 1), (4, UPDATED, "d", 1),
    ]


def test_cluster_state_follows_the_log(spark):
    log = [
        (CLUSTER, CREATED, {"id": "cluster-1", "controller": node(0)}),
        (CLUSTER, UPDATED, {"id": "cluster-1", "controller": node(1)}),
    ]
    assert table(cluster_current(events(spark, *log)), "id", "controller.id") == [("cluster-1", 1)]
    assert cluster_current(events(spark, *log).filter("false")).count() == 0


def test_cluster_without_controller_is_created(spark):
    got = poll.cluster_events(cluster_rows(spark, (1, "cluster-1", None, [])), (1, 1))
    assert table(got, "op", "entity_id") == [(CREATED, "cluster-1")]


def test_lost_controller_is_an_update(spark):
    known = state(spark, CLUSTER, {"id": "cluster-1", "controller": node(0)})
    snap = cluster_rows(spark, (1, "cluster-1", None, []))
    assert table(poll.cluster_events(snap, (1, 1), state=known), "op") == [(UPDATED,)]
    one = changelog.diff_one(known, snap, ["id", "controller"])
    assert table(one, "op", "id") == [(UPDATED, "cluster-1")]


def test_fold_corner_cases(spark):
    d = description()
    log = events(
        spark,
        (TOPIC, DELETED, topic("never seen")),
        (TOPIC, UPDATED, topic("back", d)), (TOPIC, DELETED, topic("back")), (TOPIC, UPDATED, topic("back", d)),
        (TOPIC, UPDATED, topic("again", d)), (TOPIC, CREATED, topic("again")),
    )
    assert table(topics_current(log), "name") == [("again",), ("back",)]


def test_created_topic_is_described(spark):
    log = events(spark, (TOPIC, CREATED, topic("a")), (TOPIC, CREATED, topic("unknown")))
    described = state(spark, TOPIC, topic("a", description(True), {"k": "v"}))
    got = poll.describe_created(log, described)
    assert table(got, "entity_id", "op", "op_tag", "seq", "topic.description.internal") == [
        ("a", UPDATED, CREATED, 2, True)
    ]
