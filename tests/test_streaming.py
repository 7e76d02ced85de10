"""Streams give what the batch jobs give, over restarts and repeated batches."""

from __future__ import annotations

import random

from pyspark.sql import functions as F
from rows import description, events, node, snapshot, table, topic

from entitylog.operators import counters, state
from entitylog.params import Params
from entitylog.plans import poll as poll_plans
from entitylog.schema import BROKER, CLUSTER, CREATED, DELETED, STATE, TOPIC, UPDATED
from entitylog.sources import log as logs
from entitylog.sources import snapshots
from entitylog.streaming import materialise, poll

ALL = Params(include_internal=True)


def made_up_log(spark, n=200):
    rng = random.Random(1)
    rows = []
    for i in range(n):
        name = f"t{0 if rng.random() < 0.3 else rng.randrange(20)}"
        op = rng.choice([CREATED, UPDATED, UPDATED, DELETED])
        value = description(rng.random() < 0.5) if op == UPDATED else None
        rows.append((TOPIC, op, topic(name, value, {"i": str(i)} if value else None)))
    return events(spark, *rows).cache()


def test_state_and_counters_follow_the_log_over_a_restart(spark, tmp_path):
    log = made_up_log(spark)
    path = str(tmp_path / "log")
    keys, order, values = ["name"], ["round", "seq"], ["description", "config"]

    def run():
        stream = logs.read_log(spark, path, stream=True)
        arm = stream.filter(F.col("topic").isNotNull()).select("op", *order, "topic.*")
        rows = materialise.follow_state(arm, keys, order, values, ignore=[CREATED], remove=[DELETED])
        totals = materialise.follow_counters(stream)
        for what, df in (("state", rows), ("totals", totals)):
            materialise.write_changes(df, str(tmp_path / what), str(tmp_path / f"{what}-checkpoint"), once=True).awaitTermination()
        now = materialise.read_state(spark, str(tmp_path / "state"), rows.schema, keys, order)
        return rows.schema, now, materialise.read_counters(spark, str(tmp_path / "totals"), totals.schema)

    # Later events first: what arrives late must not win over what is newer.
    for batch, part in enumerate(("round >= 150", "round < 50", "round between 50 and 149")):
        logs.append_log(log.filter(part), path, batch=batch)
        schema, now, totals = run()
    assert table(now.select(*keys, F.to_json("config").alias("c")), "name", "c") == table(
        state.topics_current(log).select("name", F.to_json("config").alias("c")), "name", "c"
    )
    assert table(totals, "entity_type", "op", "total") == table(counters.consumed(log), "entity_type", "op", "total")

    materialise.compact(spark, str(tmp_path / "state"), str(tmp_path / "small"), schema, keys, order)
    small = materialise.read_state(spark, str(tmp_path / "small"), schema, keys, order)
    assert table(small, "name", "round") == table(now, "name", "round")


def test_state_is_served_from_the_store_batch_by_batch(spark, tmp_path):
    log = made_up_log(spark)
    path, checkpoint = str(tmp_path / "log"), str(tmp_path / "c")
    keys, order, values = ["name"], ["round", "seq"], ["description", "config"]
    for batch, part in enumerate(("round < 90", "round >= 90")):
        logs.append_log(log.filter(part), path, batch=batch)
        arm = logs.read_log(spark, path, stream=True).filter(F.col("topic").isNotNull()).select("op", *order, "topic.*")
        rows = materialise.follow_state(arm, keys, order, values, ignore=[CREATED], remove=[DELETED])
        materialise.keep_state(rows, checkpoint, once=True).awaitTermination()
    for batch, events_so_far in ((0, log.filter("round < 90")), (1, log), (None, log)):
        now = materialise.served_state(spark, checkpoint, rows.schema, keys, order, batch)
        assert table(now.select("name", "description", F.to_json("config").alias("c")), "name", "description", "c") == table(
            state.topics_current(events_so_far).select("name", "description", F.to_json("config").alias("c")), "name", "description", "c"
        )
    plan = now._jdf.queryExecution().executedPlan().toString()
    assert "StateScan" in plan and "FileScan" not in plan


def test_cluster_and_brokers_follow_the_log(spark, tmp_path):
    log = events(
        spark,
        (CLUSTER, CREATED, {"id": "c", "controller": node(0)}), (BROKER, CREATED, {"id": "0", "node": node(0)}),
        (CLUSTER, UPDATED, {"id": "d", "controller": node(1)}), (BROKER, UPDATED, {"id": "0", "node": node(0, "h")}),
        (BROKER, CREATED, {"id": "1", "node": node(1)}),
    )
    path, order = str(tmp_path / "log"), ["round", "seq"]
    logs.append_log(log, path, batch=0)
    stream = logs.read_log(spark, path, stream=True)
    for kind, keys, values, batch in (
        (CLUSTER, [], ["id", "controller"], state.cluster_current(log)),
        (BROKER, ["id"], ["node", "config"], state.brokers_current(log)),
    ):
        arm = kind.lower()
        rows = materialise.follow_state(
            stream.filter(F.col(arm).isNotNull()).select("op", *order, f"{arm}.*"), keys, order, values, ignore=[DELETED]
        )
        materialise.write_changes(rows, str(tmp_path / arm), str(tmp_path / f"{arm}-c"), once=True).awaitTermination()
        got = materialise.read_state(spark, str(tmp_path / arm), rows.schema, keys, order)
        assert table(got, "id", values[0] if keys else values[1]) == table(batch, "id", values[0] if keys else values[1])


def test_created_topics_are_described_in_a_stream(spark, tmp_path):
    log = events(spark, (TOPIC, CREATED, topic("a")), (TOPIC, CREATED, topic("unknown")))
    path = str(tmp_path / "log")
    logs.append_log(log, path, batch=0)
    known = spark.createDataFrame([topic("a", description(), {"k": "v"})], STATE[TOPIC])
    described = poll_plans.describe_created(logs.read_log(spark, path, stream=True), known)
    out = str(tmp_path / "described")
    described.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).trigger(
        availableNow=True
    ).start(out).awaitTermination()
    assert table(spark.read.parquet(out), "entity_id", "op", "op_tag") == [("a", UPDATED, CREATED)]


def rounds_of(spark, n=12):
    rng = random.Random(2)
    return {
        r: [
            {"snapshot_id": r, "name": f"t{k}", "description": description(), "config": {"v": str(rng.randrange(2))}}
            for k in range(8)
            if r != 6 and rng.random() < 0.7
        ]
        for r in range(n)
    }


def test_poll_stream_equals_one_job(spark, tmp_path):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    rounds = rounds_of(spark)
    rows = [row for listed in rounds.values() for row in listed]
    whole = poll_plans.topic_events(snapshot(spark, TOPIC, *rows), (0, 11), ALL)
    for start in (0, 5, 6, 9):
        end = {0: 4, 5: 5, 6: 8, 9: 11}[start]
        for r in range(start, end + 1):
            snapshots.write_snapshot(snapshot(spark, TOPIC, *rounds[r]), root, TOPIC, r)
        poll.snapshots_to_log(spark, root, out, TOPIC, ALL, rounds_per_batch=2, once=True).awaitTermination()
    columns = ["round", "seq", "entity_id", "op", "op_tag"]
    log = poll.read_log(spark, out, [TOPIC])
    assert table(log, *columns) == table(whole, *columns)
    assert table(state.topics_current(log), "name") == sorted((r["name"],) for r in rounds[11])

    # A batch tried again gives the same log, state and progress.
    query = spark.createDataFrame([(9,), (10,)], "snapshot_id long")
    last = max(int(p.name.split("=")[1]) for p in (tmp_path / "out/progress/topic").iterdir())
    step = poll._step(root, out, TOPIC, ALL)
    again = table(poll.read_state(spark, out, TOPIC, last), "name")
    before = poll.read_progress(spark, out, TOPIC, last - 1)
    step(query.filter(F.col("snapshot_id") > before).union(spark.range(before + 1, 12)).distinct(), last)
    assert table(poll.read_log(spark, out, [TOPIC]), *columns) == table(whole, *columns)
    assert table(poll.read_state(spark, out, TOPIC, last), "name") == again
    assert poll.read_progress(spark, out, TOPIC, last) == 11


def test_brokers_and_cluster_are_polled_too(spark, tmp_path):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    clusters = snapshot(spark, CLUSTER, *[{"snapshot_id": r, "id": "c", "controller": node(r // 2), "nodes": []} for r in range(4)])
    brokers = snapshot(spark, BROKER, *[{"snapshot_id": r, "id": str(b), "node": node(b), "config": {"r": str(r // 3)}} for r in range(4) for b in range(r + 1)])
    for kind, rows in ((CLUSTER, clusters), (BROKER, brokers)):
        snapshots.write_snapshots(rows.filter("snapshot_id < 2"), root, kind, (0, 1))
        poll.snapshots_to_log(spark, root, out, kind, once=True).awaitTermination()
        snapshots.write_snapshots(rows.filter("snapshot_id >= 2"), root, kind, (2, 3))
        poll.snapshots_to_log(spark, root, out, kind, once=True).awaitTermination()
    log = poll.read_log(spark, out, [CLUSTER, BROKER])
    assert table(log, "round", "entity_type", "entity_id", "op") == [
        (0, BROKER, "0", CREATED), (0, CLUSTER, "c", CREATED), (1, BROKER, "1", CREATED), (2, BROKER, "2", CREATED),
        (2, CLUSTER, "c", UPDATED), (3, BROKER, "0", UPDATED), (3, BROKER, "1", UPDATED), (3, BROKER, "2", UPDATED),
        (3, BROKER, "3", CREATED),
    ]


def test_rounds_beyond_a_gap_wait_until_it_is_filled(spark, tmp_path):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    rounds = rounds_of(spark, 5)

    def run(*marked):
        for r in marked:
            snapshots.write_snapshot(snapshot(spark, TOPIC, *rounds[r]), root, TOPIC, r)
        poll.snapshots_to_log(spark, root, out, TOPIC, ALL, once=True).awaitTermination()
        return {r.round for r in poll.read_log(spark, out, [TOPIC]).select("round").distinct().collect()}

    assert run(0, 2) <= {0}
    assert run(4) <= {0}
    run(1)
    assert max(run(3)) == 4
    rows = [row for listed in rounds.values() for row in listed]
    whole = poll_plans.topic_events(snapshot(spark, TOPIC, *rows), (0, 4), ALL)
    columns = ["round", "seq", "entity_id", "op", "op_tag"]
    assert table(poll.read_log(spark, out, [TOPIC]), *columns) == table(whole, *columns)


def test_snapshots_can_be_written_again(spark, tmp_path):
    rows = snapshot(spark, TOPIC, *rounds_of(spark, 2)[0])
    for _ in range(2):
        snapshots.write_snapshots(rows, str(tmp_path), TOPIC, (0, 1))
    assert snapshots.read_snapshots(spark, str(tmp_path), TOPIC).count() == rows.count()


def test_streams_can_be_stopped(spark, tmp_path):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    snapshots.write_snapshot(snapshot(spark, TOPIC, *rounds_of(spark)[0]), root, TOPIC, 0)
    query = poll.snapshots_to_log(spark, root, out, TOPIC, ALL)
    query.processAllAvailable()
    assert query.isActive
    poll.stop(query)
    assert not query.isActive
    assert poll.read_log(spark, out, [TOPIC]).count() > 0
