"""Committed logs, layered state, chained listings and missing rounds against plain versions."""

from __future__ import annotations

import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from rows import description, events, node, snapshot, table, topic

from entitylog.operators import changelog, counters, state
from entitylog.params import Params
from entitylog.schema import BROKER, CLUSTER, CONFIGS, CREATED, DELETED, DESCRIPTIONS, TOPIC, TOPICS, UPDATED
from entitylog.sources import commits, snapshots
from entitylog.sources import log as logs
from entitylog.streaming import poll, state_table

POSITION = ["round", "seq", "entity_id", "op"]


def made_up(spark, n=60):
    rng = random.Random(7)
    rows = []
    for i in range(n):
        op = rng.choice([CREATED, UPDATED, UPDATED, DELETED])
        rows.append((TOPIC, op, topic(f"t{rng.randrange(9)}", description() if op == UPDATED else None, {"i": str(i)} if op == UPDATED else None)))
    return events(spark, *rows).cache()


def test_committed_log_has_whole_batches_once(spark, tmp_path):
    log, path = made_up(spark), str(tmp_path / "log")
    part = lambda n: log.filter(F.col("round").between(20 * n, 20 * n + 19))
    seen, fail = [], [True]

    def step(rows, batch):
        seen.append((batch, table(rows, *POSITION)))
        if fail[0]:
            raise RuntimeError("stop")

    def follow():
        logs.follow_log(spark, path, "w", step, str(tmp_path / "c"), once=True, commits_per_batch=1).awaitTermination()

    # An attempt that wrote its rows and failed before it was committed.
    part(0).write.partitionBy("entity_type").parquet(f"{path}/writer=w/{commits.new_piece(0)}/x")
    assert logs.read_committed(spark, path, ["w"]).count() == 0
    stored = logs.commit_log(part(0), path, "w", 0)
    assert table(stored, *POSITION) == table(part(0), *POSITION)
    with pytest.raises(Exception, match="stop"):
        follow()
    # Tried again, even with other rows, a committed batch stays.
    logs.commit_log(part(1), path, "w", 0)
    logs.commit_log(part(1), path, "w", 1)
    fail[0] = False
    follow()
    logs.merge_log(spark, path, "w", 1)
    logs.commit_log(part(2), path, "w", 2)
    follow()
    whole = table(log, *POSITION)
    done = dict(seen)
    assert sorted(x for rows in done.values() for x in rows) == sorted(whole) and len(seen) == len(done) + 1
    assert table(logs.read_committed(spark, path, ["w"]), *POSITION) == whole
    assert table(logs.read_committed(spark, path, ["w"], {"w": 0}), *POSITION) == table(part(0), *POSITION)
    before = logs.read_committed(spark, path, ["w"], {"w": 1})
    assert table(before, *POSITION) == table(log.filter("round < 40"), *POSITION)
    # Merged files serve later versions; what only earlier ones need goes.
    gone = logs.expire_log(spark, path, "w", 1)
    assert len(gone) == 2 and not any((tmp_path / "log/writer=w" / g).exists() for g in gone)
    assert table(logs.read_committed(spark, path, ["w"]), *POSITION) == whole
    assert table(logs.read_committed(spark, path, ["w"], {"w": 1}), *POSITION) == table(log.filter("round < 40"), *POSITION)
    assert commits.versions(spark, f"{path}/writer=w") == [3, 4]


KEYS, ORDER, VALUES = ["name"], ["round", "seq"], ["description", "config"]


def test_layers_give_the_fold_and_writes_follow_the_changes(spark, tmp_path, monkeypatch):
    log, path = made_up(spark, 90), str(tmp_path / "state")
    schema = state.arm(log, TOPIC).select(*KEYS, *ORDER, *VALUES).schema
    before, levels = None, set()
    for n in range(9):
        part = log.filter(F.col("round").between(10 * n, 10 * n + 9))
        changes = state_table.changes_of(state.arm(part, TOPIC), KEYS, ORDER, VALUES, ignore=[CREATED], remove=[DELETED])
        add = lambda: state_table.append(changes, path, n, before, KEYS, ORDER, VALUES, fan=2)  # noqa: E731, B023
        if n == 5:
            # Fails after its merger is written, before the commit: nothing has changed then.
            with monkeypatch.context() as m:
                m.setattr(commits, "commit", lambda *a, **k: 1 / 0)
                with pytest.raises(ZeroDivisionError):
                    add()
            assert commits.last_version(spark, path) == 4
        add()
        add()
        before = n
        for version in {n, max(n - 1, 0)}:
            now = state_table.read(spark, path, schema, KEYS, ORDER, version)
            want = state.topics_current(log.filter(F.col("round") < 10 * version + 10))
            assert table(now.select("name", F.to_json("config").alias("c")), "name", "c") == table(
                want.select("name", F.to_json("config").alias("c")), "name", "c"
            )
        pieces = {p.name: p.level for p in commits.entry(spark, path, n).adds}
        levels |= set(pieces.values())
        assert len(pieces) <= 4
    assert levels == {0, 1, 2, 3}
    # The lowest layer holds no removed keys; a batch's own layer holds its changes alone.
    bottom = max(pieces, key=pieces.get)
    assert spark.read.parquet(f"{path}/{bottom}").filter("_gone").count() == 0
    own = [p for p in Path(path, "data").iterdir() if p.name.startswith("piece=8-")]
    assert min(spark.read.parquet(str(p)).count() for p in own) == changes.count()
    gone = commits.expire(spark, path, 8)
    left = {f"data/{p.name}" for p in Path(path, "data").iterdir()}
    assert not left & set(gone) and set(pieces) <= left and commits.versions(spark, path) == [8]


def test_brokers_follow_cluster_listings_and_configs(spark, tmp_path):
    rng = random.Random(3)
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    listings, lookups, last, want = [], [], {}, []
    for r in range(8):
        here = [] if r == 3 else [b for b in range(5) if rng.random() < 0.8]
        nodes = [node(b, f"h{rng.randrange(2)}") for b in here]
        listings += [{"snapshot_id": r, "id": "c", "controller": node(0), "nodes": part} for part in (nodes[:2], nodes[1:])]
        for n in nodes:
            b = n["id"]
            found, failed = rng.random() < 0.7, rng.random() < 0.2
            config = {"v": str(rng.randrange(2))} if found else {}
            if found:
                lookups.append({"snapshot_id": r, "resource_type": "broker", "name": str(b), "config": config, "lookup_failed": failed})
                lookups.append({"snapshot_id": r, "resource_type": "topic", "name": str(b), "config": {"other": "1"}, "lookup_failed": False})
            if found and failed:
                continue
            if b not in last:
                want.append((r, str(b), CREATED))
            elif last[b] != (n, config):
                want.append((r, str(b), UPDATED))
            last[b] = (n, config)
    run = lambda: poll.snapshots_to_log(spark, root, out, poll.CLUSTER_LISTING, once=True).awaitTermination()
    clusters, configs = snapshot(spark, CLUSTER, *listings), snapshot(spark, CONFIGS, *lookups)
    for first, end, ready in ((0, 2, 1), (3, 4, 3), (5, 7, 7)):
        # Configs of a round may come later than its listing: the round waits for them.
        snapshots.write_snapshots(clusters.filter(F.col("snapshot_id").between(first, end)), root, CLUSTER, (first, end))
        low = {0: 0, 3: 2, 5: 4}[first]
        snapshots.write_snapshots(configs.filter(F.col("snapshot_id").between(low, ready)), root, CONFIGS, (low, ready))
        run()
        log = poll.read_log(spark, out, [poll.CLUSTER_LISTING.name])
        got = table(log.filter("broker is not null"), "round", "entity_id", "op")
        assert got == sorted(x for x in want if x[0] <= ready)
    now = poll.read_state(spark, out, BROKER)
    assert {(r.id, r.config.get("v")) for r in now.collect()} == {(str(b), c.get("v")) for b, (_, c) in last.items()}
    assert table(log.filter("cluster is not null"), "round", "op") == [(0, CREATED)]


def test_topics_follow_listed_names(spark, tmp_path):
    root, out = str(tmp_path / "in"), str(tmp_path / "out")
    names = [{"snapshot_id": r, "name": n} for r, listed in enumerate(["ab", "abc", "bc", "bc"]) for n in listed]
    described = [{**x, "description": description()} for x in names if (x["snapshot_id"], x["name"]) != (1, "c")]
    configs = [{"snapshot_id": 3, "resource_type": "topic", "name": "b", "config": {"k": "v"}, "lookup_failed": False}]
    for kind, rows in ((TOPICS, names), (DESCRIPTIONS, described), (CONFIGS, configs)):
        snapshots.write_snapshots(snapshot(spark, kind, *rows), root, kind, (0, 3))
    poll.snapshots_to_log(spark, root, out, poll.TOPIC_LISTING, Params(deny=("x",)), once=True).awaitTermination()
    assert table(poll.read_log(spark, out, [poll.TOPIC_LISTING.name]), *POSITION) == [
        (0, 1, "a", CREATED), (0, 1, "b", CREATED), (0, 2, "a", UPDATED), (0, 2, "b", UPDATED),
        (2, 0, "a", DELETED), (2, 1, "c", CREATED), (2, 2, "c", UPDATED), (3, 2, "b", UPDATED),
    ]


@pytest.mark.parametrize("chunk", [2048, 3])
def test_missing_rounds_equal_a_loop(spark, chunk):
    rng = random.Random(5)
    rows, want = [], []
    for key in range(30):
        last, runs = None, []
        rate = rng.choice([0.1, 0.5, 0.9])
        for r in range(20):
            listed = rng.random() < rate
            value = rng.choice([1, 1, 2, None])
            if listed:
                rows.append((key, r, value))
            kind = None
            if last is not None:
                kind = False if not listed else (True if value != last[0] else None)
            if listed:
                last = (value,)
            if kind is not None:
                if runs and runs[-1][1] == r - 1 and runs[-1][2] == kind:
                    runs[-1][1] = r
                else:
                    runs.append([r, r, kind])
        want += [(key, a, b, moved) for a, b, moved in runs]
    rows += [(None, 3, 1), (4, None, 1), (5, 25, 1)]
    df = spark.createDataFrame(rows, "id int, snapshot_id long, node int").repartition(4)
    got = changelog.missing_rounds(df, ["id"], "node", (0, 19), chunk=chunk)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)
    assert changelog.missing_rounds(df.limit(0), ["id"], "node", (0, 19)).collect() == []


def test_ledger_counts_a_batch_once(spark, tmp_path):
    log, path = made_up(spark), str(tmp_path / "counts")
    for batch, part in enumerate(("round < 30", "round < 45", "round >= 30")):
        # The second attempt at batch 1 replaces the first.
        counters.count_batch(log.filter(part), path, min(batch, 1))
    want = table(counters.consumed(log), "entity_type", "op", "total")
    assert table(counters.counted(spark, path), "entity_type", "op", "total") == want
    counters.roll_up(spark, path, f"{path}-all")
    assert table(counters.counted(spark, f"{path}-all"), "entity_type", "op", "total") == want
