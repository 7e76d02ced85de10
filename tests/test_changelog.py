"""The change operators against a round-by-round loop in plain Python."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F
from rows import table

from entitylog.operators import changelog, state

SCHEMA = "k long, r long, ok boolean, a int, m map<string,string>"


def loop(rows, rounds, known, forget_absent):
    """Changes as (key, round, op, value), one round after the other."""
    known, changes = dict(known), []
    for r in range(rounds[0], rounds[1] + 1):
        listed = {row[0]: row for row in rows if row[1] == r}
        if forget_absent:
            for k in [k for k in known if k not in listed]:
                changes.append((k, r, "Deleted", None))
                del known[k]
        for k, (_, _, ok, a, m) in listed.items():
            value = (a, tuple(sorted((x, y or "") for x, y in (m or {}).items())))
            if not ok or known.get(k) == value:
                continue
            changes.append((k, r, "Updated" if k in known else "Created", a))
            known[k] = value
    return changes, known


def made_up(seed, keys=12, rounds=(3, 30)):
    rng = random.Random(seed)
    rows = []
    for k in range(keys):
        here, value = rng.random() < 0.5, 0
        for r in range(rounds[0], rounds[1] + 1):
            if rng.random() < 0.25:
                here = not here
            if rng.random() < 0.3:
                value = rng.randrange(3)
            # The first key is in every round: a hot key.
            if here or k == 0:
                m = rng.choice([None, {}, {"x": None}, {"x": ""}, {"x": "1", "y": "2"}, {"y": "2", "x": "1"}])
                rows.append((k, r, rng.random() < 0.8, value, m))
    return rows, rounds


def sort(rows):
    return sorted(rows, key=str)


@pytest.mark.parametrize("chunk", [1, 2, 5, 1000])
@pytest.mark.parametrize("forget_absent", [True, False])
@pytest.mark.parametrize("with_state", [True, False])
def test_rounds_equal_the_loop(spark, chunk, forget_absent, with_state):
    rows, rounds = made_up(chunk)
    known = {k: (k % 3, ()) for k in range(4, 20)} if with_state else {}
    before = spark.createDataFrame([(k, v[0], {}) for k, v in known.items()], "k long, a int, m map<string,string>")
    got = changelog.from_snapshots(
        spark.createDataFrame(rows, SCHEMA), ["k"], ["a", "m"], rounds, "r",
        eligible=F.col("ok"), forget_absent=forget_absent,
        state=before if with_state else None, chunk=chunk,
    )
    expected, _ = loop(rows, rounds, known, forget_absent)
    assert sort(tuple(r) for r in got.select("k", "r", "op", "a").collect()) == sort(expected)


@pytest.mark.parametrize("chunk", [1, 3, 1000])
@pytest.mark.parametrize("forget_absent", [True, False])
def test_rounds_where_all_speak(spark, chunk, forget_absent):
    rows, rounds = made_up(chunk + 20)
    rows = [(k, r, True, a, m) for k, r, _, a, m in rows]
    known = {k: (k % 3, ()) for k in range(4, 20)}
    before = spark.createDataFrame([(k, v[0], {}) for k, v in known.items()], "k long, a int, m map<string,string>")
    got = changelog.from_snapshots(
        spark.createDataFrame(rows, SCHEMA), ["k"], ["a", "m"], rounds, "r",
        forget_absent=forget_absent, state=before, chunk=chunk,
    )
    expected, _ = loop(rows, rounds, known, forget_absent)
    assert sort(tuple(r) for r in got.select("k", "r", "op", "a").collect()) == sort(expected)


@pytest.mark.parametrize("chunk", [2, 100])
def test_rounds_of_one_slot(spark, chunk):
    rows, rounds = made_up(7, keys=1)
    got = changelog.from_snapshots(
        spark.createDataFrame(rows, SCHEMA), [], ["k", "a", "m"], rounds, "r",
        eligible=F.col("ok"), forget_absent=False, chunk=chunk,
    )
    expected, _ = loop(rows, rounds, {}, False)
    assert sort(tuple(r) for r in got.select("k", "r", "op", "a").collect()) == sort(expected)


def test_one_round_equals_the_loop(spark):
    rows, _ = made_up(3, keys=30, rounds=(1, 1))
    known = {k: (k % 3, ()) for k in range(10, 40)}
    before = spark.createDataFrame([(k, v[0], {}) for k, v in known.items()], "k long, a int, m map<string,string>")
    snap = spark.createDataFrame(rows, SCHEMA)
    for forget_absent in (True, False):
        got = changelog.diff(before, snap, ["k"], ["a", "m"], F.col("ok"), forget_absent)
        expected, _ = loop(rows, (1, 1), known, forget_absent)
        assert sort(tuple(r) for r in got.select("k", "op", "a").collect()) == sort(
            (k, op, a) for k, _, op, a in expected
        )
    # The single-operation forms agree with the whole.
    whole = changelog.diff(before, snap, ["k"], ["a", "m"])
    for op, part in (
        ("Created", changelog.created(before, snap, ["k"])),
        ("Deleted", changelog.deleted(before, snap, ["k"])),
        ("Updated", changelog.updated(before, snap, ["k"], ["a", "m"])),
    ):
        assert table(part, "k") == table(whole.filter(F.col("op") == op), "k")
    assert changelog.known(before, snap, ["k"]).count() == len(
        {r[0] for r in rows} & set(known)
    )


def test_folding_the_changes_gives_the_last_snapshot(spark):
    rows, rounds = made_up(11)
    snaps = spark.createDataFrame(rows, SCHEMA)
    changes = changelog.from_snapshots(snaps, ["k"], ["a", "m"], rounds, "r")
    steps = changelog.topic_steps(changes)
    now = state.fold_topics(steps, ["k"], ["r", "seq"], ["a", "m"])
    last = snaps.filter(F.col("r") == rounds[1])
    assert table(now, "k", "a") == table(last, "k", "a")
    assert changelog.diff(now, last, ["k"], ["a", "m"]).count() == 0


def test_applying_changes_in_batches_gives_the_same_state(spark):
    rows, rounds = made_up(5)
    snaps = spark.createDataFrame(rows, SCHEMA)
    known = snaps.filter("false").select("k", "a", "m")
    for first in range(rounds[0], rounds[1] + 1, 7):
        last = min(first + 6, rounds[1])
        part = snaps.filter(F.col("r").between(first, last))
        changes = changelog.from_snapshots(part, ["k"], ["a", "m"], (first, last), "r", state=known)
        after = state.apply(
            known, changelog.topic_steps(changes), ["k"], ["r", "seq"], ["a", "m"],
            ignore=["Created"], remove=["Deleted"],
        )
        known = spark.createDataFrame(after.collect(), after.schema)
    _, expected = loop([(k, r, True, a, m) for k, r, _, a, m in rows], rounds, {}, True)
    assert table(known, "k", "a") == sort((k, v[0]) for k, v in expected.items())


def test_order_of_values(spark):
    """List order matters, map order does not, and nulls in maps are ''."""
    schema = "k int, l array<int>, m map<string,string>, rack struct<rack:string>"
    old = spark.createDataFrame(
        [(1, [1, 2], {"a": "1", "b": "2"}, ("",)), (2, [1, 2], {"a": None}, None), (3, [], None, (None,))], schema
    )
    new = spark.createDataFrame(
        [(1, [1, 2], {"b": "2", "a": "1"}, (None,)), (2, [2, 1], {"a": ""}, None), (3, [], {}, None)], schema
    )
    values = ["l", "m", "rack"]
    # A missing struct is not a struct without a rack.
    assert table(changelog.updated(old, new, ["k"], values), "k") == [(2,), (3,)]
    assert table(changelog.updated(old, new, ["k"], ["m"]), "k") == []


def test_rows_without_a_key_are_reported_and_no_change(spark):
    snap = spark.createDataFrame([(None, 0, "x"), ("a", 0, "x"), ("b", None, "x")], "k string, r long, v string")
    none = snap.filter("false")
    assert table(changelog.diff(none, snap, ["k"], ["v"]), "k", "op") == [("a", "Created"), ("b", "Created")]
    assert table(changelog.from_snapshots(snap, ["k"], ["v"], (0, 0), "r"), "k", "op") == [("a", "Created")]
    assert changelog.created(none, snap, ["k"]).count() == changelog.deleted(snap, none, ["k"]).count() == 2
    assert changelog.keyless(snap, ["k", "r"]).count() == 2


def shuffled(spark):
    """Bytes written to shuffles by all stages so far."""
    sc = spark.sparkContext
    stages = sc._jsc.sc().statusStore().stageList(None, False, False, sc._gateway.new_array(sc._jvm.double, 0), sc._jvm.java.util.ArrayList())
    return sum(stages.apply(n).shuffleWriteBytes() for n in range(stages.size()))


def test_digests_find_the_same_changes_and_move_less(spark, tmp_path):
    rng = random.Random(4)
    value = {}
    rows = []
    for r in range(10):
        for k in range(150):
            if rng.random() < 0.03:
                value.pop(k, None)
            if k not in value or rng.random() < 0.03:
                value[k] = (str(rng.random()) * 120, {"a": rng.choice(["1", None, ""]), "b": str(k)})
            if rng.random() < 0.97:
                a = dict(reversed(value[k][1].items())) if rng.random() < 0.5 else value[k][1]
                rows.append((k, r, value[k][0], a, rng.random() < 0.9))
    df = spark.createDataFrame(rows, "k int, snapshot_id long, text string, config map<string,string>, ok boolean")
    df.repartition(3).write.parquet(str(tmp_path / "s"))
    df = spark.read.parquet(str(tmp_path / "s"))
    state = spark.createDataFrame([(1, "old", {}), (999, "gone", None)], "k int, text string, config map<string,string>")
    flat = lambda x: sorted(tuple(map(str, (r.k, r.snapshot_id, r.op, r.text, sorted((r.config or {}).items())))) for r in x)
    moved = []
    for how in (changelog.from_snapshots, changelog.by_digest):
        before = shuffled(spark)
        got = [flat(how(df, ["k"], ["text", "config"], (1, 9), eligible=e, state=s).collect()) for e, s in ((None, None), (F.col("ok"), state))]
        moved.append((shuffled(spark) - before, got))
    assert moved[0][1] == moved[1][1] and len(moved[0][1][0]) > 100
    assert moved[1][0] < moved[0][0] / 2
