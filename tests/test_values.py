"""Canonical values, configs, descriptions, parameters and filters."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from rows import node, snapshot, table

from entitylog.functions import canon
from entitylog.operators import enrich, filters
from entitylog.params import Params, csv_list
from entitylog.plans import poll
from entitylog.schema import BOOL, BROKER, CLUSTER, PARTITION, STRING, TOPIC, struct
from entitylog.sources import snapshots

ENTRIES = "e array<struct<name:string,value:string>>"


def test_config_of_entries(spark):
    df = spark.createDataFrame(
        [([("k1", "v1"), ("k2", "v2"), ("k3", "v3")],), ([("a", "1"), ("b", None), ("a", "2")],), (None,), ([],)],
        ENTRIES,
    )
    got = [r[0] for r in df.select(canon.config_from_entries(F.col("e"))).collect()]
    assert got == [{"k1": "v1", "k2": "v2", "k3": "v3"}, {"a": "2", "b": None}, {}, {}]


def test_config_to_entries_and_back(spark):
    df = spark.createDataFrame([({"b": "2", "a": None},), (None,)], "c map<string,string>")
    entries = df.select(canon.config_to_entries(F.col("c")).alias("e"))
    assert [[tuple(e) for e in r.e] for r in entries.collect()] == [[("a", ""), ("b", "2")], []]
    assert [r[0] for r in entries.select(canon.config_from_entries(F.col("e"))).collect()] == [{"a": "", "b": "2"}, {}]


def test_config_of_rows(spark):
    df = spark.createDataFrame(
        [("t", "a", "1", 0), ("t", "a", "2", 5), ("t", "b", None, 1), ("u", "a", "3", 0)],
        "id string, name string, value string, ordinal int",
    )
    got = {r["id"]: r["config"] for r in snapshots.config_of_rows(df, ["id"]).collect()}
    assert got == {"t": {"a": "2", "b": None}, "u": {"a": "3"}}


def test_node_without_rack(spark):
    df = spark.range(1).select(canon.node(F.lit(1), F.lit("h"), F.lit(2), F.lit("")).alias("n"))
    assert df.first()["n"].asDict() == node(1, "h", 2)


def test_description_of_flat_rows(spark):
    flat = struct(topic=STRING, internal=BOOL, **{f.name: f.dataType for f in PARTITION.fields})
    rows = [
        {"topic": "t", "internal": False, "id": i, "leader": node(i) if i else None, "replicas": [node(1), node(0)], "isr": []}
        for i in (2, 0, 1)
    ]
    got = snapshots.build_descriptions(spark.createDataFrame(rows, flat)).first()
    assert got["description"]["internal"] is False
    assert [p["id"] for p in got["description"]["partitions"]] == [0, 1, 2]
    assert got["description"]["partitions"][0]["leader"] is None
    assert [n["id"] for n in got["description"]["partitions"][1]["replicas"]] == [1, 0]


def test_snapshot_is_described_and_configured(spark):
    names = snapshot(spark, TOPIC, *[{"snapshot_id": 1, "name": f"t{i}"} for i in (1, 2, 3)]).select("snapshot_id", "name")
    descriptions = spark.createDataFrame(
        [("t1", (False, [])), ("t2", (False, []))], "name string, description struct<internal:boolean,partitions:array<int>>"
    )
    configs = spark.createDataFrame(
        [("Topic", "t1", {"cleanup.policy": "compact"}, False), ("Broker", "t2", {"x": "y"}, False), ("Topic", "t3", {}, True)],
        "resource_type string, name string, config map<string,string>, lookup_failed boolean",
    )
    assert table(snapshots.topic_names(names), "name") == [("t1",), ("t2",), ("t3",)]
    assert table(enrich.with_description(names, descriptions), "name") == [("t1",), ("t2",)]
    got = enrich.with_config(
        enrich.with_description(names, descriptions, how="left"), configs, "name", resource="TOPIC"
    )
    rows = {r["name"]: (r["config"], r["lookup_failed"], r["description"] is None) for r in got.collect()}
    assert rows == {
        "t1": ({"cleanup.policy": "compact"}, False, False), "t2": ({}, False, False), "t3": ({}, True, True),
    }


def test_resource_types(spark):
    df = spark.createDataFrame([("broker",), ("Topic",), ("acl",), (None,)], "t string")
    got = [r[0] for r in df.select(enrich.resource_type(F.col("t"))).collect()]
    assert got == ["BROKER", "TOPIC", "UNKNOWN", "UNKNOWN"]


def test_broker_snapshot_from_cluster_listing(spark):
    listing = snapshot(
        spark, CLUSTER,
        {"snapshot_id": 1, "id": "c", "nodes": [node(1), node(2)]}, {"snapshot_id": 1, "id": "c", "nodes": [node(10)]},
    )
    configs = spark.createDataFrame(
        [(1, "1", {"a": "b"}, False), (1, "10", None, True), (2, "2", {"x": "y"}, False)],
        "snapshot_id long, id string, config map<string,string>, lookup_failed boolean",
    )
    got = poll.broker_snapshot(listing, configs)
    rows = {r["id"]: (r["config"], r["lookup_failed"]) for r in got.collect()}
    assert rows == {"1": ({"a": "b"}, False), "2": ({}, False), "10": ({}, True)}
    assert table(poll.broker_events(got, (1, 1)), "entity_id") == [("1",), ("2",)]


def test_lists_are_split_not_trimmed(spark):
    text = ",a,, b,"
    assert csv_list(text) == ("a", " b") and csv_list("") == ()
    df = spark.createDataFrame([(text,), ("",)], "s string")
    assert [r[0] for r in df.select(filters.csv_list(F.col("s"))).collect()] == [["a", " b"], []]


def test_params_from_environment():
    assert Params.from_env({}) == Params()
    got = Params.from_env(
        {
            "KAFKA_BOOTSTRAP_SERVERS": "host:1", "COLLECTOR_EVENT_TOPIC": "log",
            "COLLECTOR_TOPIC_INCLUDE_INTERNAL": "true", "COLLECTOR_TOPIC_BLACKLIST": "a,,b",
            "COLLECTOR_TOPIC_POLL_INTERVAL": "5 seconds",
        }
    )
    assert got == Params("host:1", "log", "5 seconds", include_internal=True, deny=("a", "b"))
    with pytest.raises(ValueError):
        Params.from_env({"COLLECTOR_TOPIC_INCLUDE_INTERNAL": "maybe"})


def test_lists_as_tables(spark):
    names = spark.createDataFrame([("a",), ("b",), ("c",)], "name string")
    none, other = names.filter("false"), spark.createDataFrame([("z",)], "name string")
    for allow, deny, left in (
        (none, none, ["a", "b", "c"]), (names.filter("name = 'a'"), none, ["a"]),
        (names, names.filter("name = 'a'"), ["b", "c"]), (other, none, []),
        (["a"], ["a"], []), ([], [], ["a", "b", "c"]), (["a", "b"], ["b"], ["a"]),
    ):
        got = filters.allow_deny(names, "name", allow, deny)
        assert [r[0] for r in table(got, "name")] == left


def test_rounds_are_numbered_in_order(spark):
    snaps = spark.createDataFrame([(30, "a"), (10, "a"), (30, "b")], "snapshot_id long, name string")
    polls = spark.createDataFrame([(30,), (10,), (20,)], "snapshot_id long")
    got = snapshots.number_rounds(snaps, polls)
    assert table(got, "snapshot_id", "name", "round_no") == [(10, "a", 0), (30, "a", 2), (30, "b", 2)]
    assert snapshots.round_bounds(snaps) == (10, 30)
    assert snapshots.round_bounds(snaps.filter("false")) is None


def test_snapshot_round_trip(spark, tmp_path):
    root = str(tmp_path)
    rows = snapshot(spark, BROKER, {"snapshot_id": 5, "id": "0", "node": node(0), "config": {"a": "b"}})
    snapshots.write_snapshot(rows, root, BROKER, 5)
    snapshots.write_snapshot(rows.filter("false"), root, BROKER, 6)
    back = snapshots.read_snapshots(spark, root, BROKER)
    assert table(back, "snapshot_id", "id", "node.host") == [(5, "0", "localhost")]
    assert snapshots.read_snapshots(spark, root, BROKER, (6, 6)).count() == 0


def test_durations_in_their_usual_spellings():
    from entitylog.params import duration

    spelled = {"10s": 10_000_000, "30 seconds": 30_000_000, "1m": 60_000_000, "500ms": 500_000, "250": 250_000, "1.5 h": 5_400_000_000}
    assert {text: duration(text) for text in spelled} == {text: f"{n} microseconds" for text, n in spelled.items()}


def test_pieces_of_descriptions_assemble_to_the_whole(spark):
    rows = [(t, p, p % 3, False) for t in ("a", "b") for p in range(0, 70 if t == "a" else 3)]
    df = spark.createDataFrame(rows, "topic string, id int, leader int, internal boolean")
    chunks = snapshots.description_chunks(df, 16, fields=["id", "leader"])
    assert {(r.topic, r.chunk): len(r.partitions) for r in chunks.collect()} == {
        ("a", 0): 16, ("a", 1): 16, ("a", 2): 16, ("a", 3): 16, ("a", 4): 6, ("b", 0): 3
    }
    whole = snapshots.build_descriptions(df, fields=["id", "leader"])
    assert sorted(map(str, snapshots.assembled(chunks).collect())) == sorted(map(str, whole.collect()))
