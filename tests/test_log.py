"""Envelope, record encoding, log tables, views and counters."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from rows import description, events, node, partition, state, table, topic

from entitylog.functions import codec
from entitylog.functions.canon import canon
from entitylog.operators import counters, envelope
from entitylog.params import Params
from entitylog.plans import views
from entitylog.schema import BROKER, CLUSTER, CREATED, DELETED, EVENT, TOPIC, UPDATED
from entitylog.sources import log as logs

FORMATS = ["json", pytest.param("protobuf", marks=pytest.mark.skipif(not codec.has_protobuf(), reason="needs google.protobuf"))]


@pytest.fixture(scope="module")
def every_event(spark):
    n = node(1, "h", 9092, "r")
    d = description(True, [partition(0, n, [n, node(2, rack="")], []), partition(1, None, [])])
    return events(
        spark,
        (CLUSTER, CREATED, {"id": "c", "controller": None}),
        (CLUSTER, UPDATED, {"id": "c", "controller": n}),
        (BROKER, CREATED, {"id": "1", "node": n, "config": {"a": "1", "b": None}}),
        (BROKER, UPDATED, {"id": "1", "node": node(-1, "", 0), "config": {}}),
        (TOPIC, CREATED, topic("t")),
        (TOPIC, UPDATED, topic("t", d, {"k": "v", "é": "ü"})),
        (TOPIC, UPDATED, topic("empty", description(), {})),
        (TOPIC, DELETED, topic("t")),
    ).cache()


def canonical(df):
    return sorted(
        str(r.asDict(True))
        for r in df.select([canon(F.col(f.name), f.dataType).alias(f.name) for f in EVENT.fields]).collect()
    )


@pytest.mark.parametrize("format", FORMATS)
def test_records_give_the_events_back(every_event, format):
    records = logs.to_records(every_event, format)
    assert canonical(logs.from_records(records, format)) == canonical(every_event)


@pytest.mark.skipif(not codec.has_protobuf(), reason="needs google.protobuf")
def test_protobuf_bytes(spark):
    """Field by field: type 2, id "t", arm 5 with name "t" and an empty field 2."""
    one = events(spark, (TOPIC, CREATED, topic("t")))
    value = logs.to_records(one, "protobuf").first()["value"]
    assert bytes(value) == bytes.fromhex("0802" "120174" "2a05" "0a0174" "1200")
    # Unknown fields and no arm: nothing to route, nothing lost.
    odd = spark.createDataFrame([(bytearray.fromhex("0801" "120133" "7a0161"),)], "value binary")
    row = codec.decode(odd, "protobuf").first()
    assert (row.entity_type, row.entity_id, row.op, row.broker) == (BROKER, "3", None, None)


def test_record_key_and_header(every_event):
    row = logs.to_records(every_event).filter("round = 2").first()
    assert row["key"] == "BROKER-1"
    assert [(h["key"], bytes(h["value"])) for h in row["headers"]] == [("entity_type", b"BROKER")]


@pytest.mark.parametrize("format", FORMATS)
def test_record_log_round_trip(spark, every_event, tmp_path, format):
    path = str(tmp_path / "records")
    logs.append_records(every_event.filter("round < 4"), path, format)
    logs.append_records(every_event.filter("round >= 4"), path, format)
    assert canonical(logs.read_records(spark, path, format)) == canonical(every_event)


def test_table_log_batches_replace_themselves(spark, every_event, tmp_path):
    path = str(tmp_path / "log")
    logs.append_log(every_event.filter("round < 6"), path, "w", 0)
    logs.append_log(every_event.filter("round < 4"), path, "w", 0)
    logs.append_log(every_event.filter("round >= 4"), path, "w", 1)
    assert canonical(logs.read_log(spark, path).drop("kind")) == canonical(every_event)
    logs.append_log(every_event, path)
    assert logs.read_log(spark, path).count() == 2 * every_event.count()


def test_routing_goes_by_payload(every_event):
    mislabelled = every_event.withColumn("entity_type", F.lit(CLUSTER))
    sizes = {kind: rows.count() for kind, rows in envelope.route(mislabelled).items()}
    assert sizes == {CLUSTER: 2, BROKER: 2, TOPIC: 4}


def test_quarantine(every_event):
    odd = every_event.withColumns(
        {
            "topic": F.when(F.col("round") != 4, F.col("topic")),
            "broker": F.when(F.col("round") == 5, F.struct(F.lit("1").alias("id"), F.lit(None).alias("node"), F.lit(None).alias("config")).cast(EVENT["broker"].dataType)).otherwise(F.col("broker")),
            "op": F.when(F.col("round") == 1, DELETED).when(F.col("round") == 3, F.lit(None)).otherwise(F.col("op")),
            "entity_type": F.when(F.col("round") == 7, "BROKER").otherwise(F.col("entity_type")),
        }
    )
    valid, report = envelope.quarantine(odd)
    assert table(valid, "round") == [(0,), (2,), (6,), (7,)]
    assert table(report, "round", "problem") == [
        (1, "no such operation"), (3, "no such operation"), (4, "no payload"),
        (5, "several payloads"), (7, "entity type differs"),
    ]


def test_counters(every_event, tmp_path, spark):
    got = counters.consumed(every_event)
    assert table(got, "entity_type", "op", "total") == [
        (BROKER, CREATED, 1.0), (BROKER, UPDATED, 1.0), (CLUSTER, CREATED, 1.0), (CLUSTER, UPDATED, 1.0),
        (TOPIC, CREATED, 1.0), (TOPIC, DELETED, 1.0), (TOPIC, UPDATED, 2.0),
    ]
    path = str(tmp_path / "counters")
    counters.write_counters(got, path)
    assert spark.read.parquet(path).count() == got.count()


def test_json_views(spark, every_event, tmp_path):
    topics = state(spark, TOPIC, topic("t", description(False, [partition(0, node(1))]), {"a": None}), topic("u", description()))
    path = str(tmp_path / "topics")
    views.write_json_view(topics, path)
    got = sorted((json.loads(r.value) for r in spark.read.text(path).collect()), key=lambda r: r["name"])
    n = {"id": 1, "host": "localhost", "port": 9092}
    assert got == [
        {"name": "t", "description": {"internal": False, "partitions": [{"id": 0, "leader": n, "replicas": [n], "isr": [n]}]}, "config": {"entries": {"a": None}}},
        {"name": "u", "description": {"internal": False, "partitions": []}, "config": {"entries": {}}},
    ]
    cluster = views.to_json_view(views.cluster(every_event)).first()["json"]
    assert json.loads(cluster) == {"id": "c", "controller": {"id": 1, "host": "h", "port": 9092, "rack": "r"}}


def test_registered_views(spark, every_event):
    views.register_views(every_event, "my_")
    got = spark.sql("select (select count(*) from my_topics), (select count(*) from my_brokers), (select count(*) from my_cluster), (select count(*) from my_events)")
    assert tuple(got.first()) == (1, 1, 1, 8)


def test_kafka_needs_its_connector(every_event):
    with pytest.raises(Exception, match="kafka"):
        logs.write_kafka(every_event, Params())


def test_kafka_keeps_the_order_of_the_log(spark):
    """Records carry their place, and a task holds a key's records in order."""
    rows = [("t", "Updated", r, 2, {"round": str(r)}) for r in range(9)] + [("u", "Deleted", 3, 0, None), ("u", "Updated", 1, 2, {})]
    made = spark.createDataFrame(rows[::-1], "name string, op string, round long, seq int, config map<string,string>")
    mixed = envelope.wrap(made.withColumn("description", F.lit(None)), TOPIC)
    sent = logs.kafka_records(mixed, "json")
    assert sent.columns == ["key", "value", "headers"]
    part = sent.withColumns({"part": F.spark_partition_id(), "at": F.monotonically_increasing_id()}).collect()
    assert len({r["part"] for r in part if r["key"] == "TOPIC-t"}) == 1
    place = [[bytes(h["value"]).decode() for h in r["headers"]] for r in sorted(part, key=lambda r: r["at"]) if r["key"] == "TOPIC-t"]
    assert place == [["TOPIC", str(r), "2"] for r in range(9)]
    # Offsets that run the other way do not matter.
    got = logs.from_kafka(sent.withColumn("offset", F.lit(100) - F.monotonically_increasing_id()), "json")
    assert [(r["name"], r["config"]) for r in views.topics(got).collect()] == [("t", {"round": "8"})]
    bare = sent.withColumns({"headers": F.filter("headers", lambda h: h["key"] == "entity_type"), "offset": F.lit(7).cast("long")})
    assert {(r["round"], r["seq"]) for r in logs.from_kafka(bare, "json").collect()} == {(7, 0)}
