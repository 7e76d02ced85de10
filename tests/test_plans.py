"""What the plans may and may not do, whatever the size of the tables."""

from __future__ import annotations

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from entitylog.operators import changelog, filters, state
from entitylog.plans import tables

SF_DIR = "/root/testdata/sf0.001"


def plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.fixture()
def no_broadcast(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield spark
    for name in names:
        spark.conf.unset(name)


@pytest.mark.parametrize("name", tables.QUERIES)
def test_no_cross_joins_and_no_forced_broadcasts(no_broadcast, name):
    text = plan(tables.QUERIES[name](no_broadcast, SF_DIR))
    for word in ("CartesianProduct", "NestedLoop", "BroadcastExchange", "BatchEvalPython"):
        assert word not in text
    assert ("ArrowEvalPython" in text) == (name == "codec_protobuf")


def test_a_single_task_only_merges_partial_results(no_broadcast):
    for name in tables.QUERIES:
        text = plan(tables.QUERIES[name](no_broadcast, SF_DIR))
        for at in re.finditer(r"Exchange SinglePartition", text):
            below = text[at.end():].split("\n")[1]
            # The rest is one row per chunk of the cluster's rounds, and per range of round ids.
            assert "partial_" in below or name in ("cluster_changelog", "dated_rounds"), (name, below)


def test_filters_and_columns_reach_the_scan(spark):
    text = plan(tables.diff_created(spark, SF_DIR))
    assert "GreaterThanOrEqual(o_orderdate," in text and "LessThan(o_orderdate," in text
    assert "o_totalprice" not in text
    for name in ("graph_isr", "graph_entities"):
        assert plan(tables.QUERIES[name](spark, SF_DIR)).count("l_linenumber#") and plan(
            tables.QUERIES[name](spark, SF_DIR)
        ).count("/lineitem.parquet") == 1
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in plan(tables.consumed_counters(spark, SF_DIR))
    assert "props" not in plan(tables.topics_current(spark, SF_DIR))


def test_fixed_width_folds_hash_and_others_combine_before_the_shuffle(spark):
    text = plan(tables.topics_current(spark, SF_DIR))
    assert "SortAggregate" not in text and "partial_max_by" in text
    assert "partial_max_by" in plan(tables.canonical_topics(spark, SF_DIR))


def test_a_fold_of_the_stored_log_reads_its_own_kind(spark):
    text = plan(tables.stored_topics(spark, SF_DIR))
    assert "PartitionFilters: [((kind#" in text and "= TOPIC) OR isnull(kind#" in text


def test_one_join_or_one_shuffle_per_round(no_broadcast):
    spark = no_broadcast
    snaps = spark.read.parquet(f"{SF_DIR}/orders.parquet").select(
        F.col("o_custkey").alias("k"), F.col("o_orderkey").alias("r"), F.col("o_totalprice").alias("v")
    )
    one = plan(changelog.diff(snaps, snaps, ["k"], ["v"]))
    assert one.count("Join") == 1
    few = plan(changelog.from_snapshots(snaps, ["k"], ["v"], (0, 100), "r"))
    assert few.count("Exchange") == 1 and "GreaterThanOrEqual(o_orderkey,0)" in few
    many = changelog.from_snapshots(snaps, ["k"], ["v"], (0, 10**6), "r", chunk=256)
    many.write.format("noop").mode("overwrite").save()
    many.collect()
    assert "ReusedExchange" in plan(many)


def test_changed_keys_are_what_meets_the_state(spark):
    """With few events the state is not shuffled when they are applied."""
    old = spark.range(0, 200000, 1, 8).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    log = spark.createDataFrame([(1, 0, "Updated", "y"), (2, 1, "Deleted", "y")], "k long, o long, op string, v string")
    after = state.apply(old, log, ["k"], ["o"], ["v"], remove=["Deleted"])
    assert sorted(after.filter("v = 'y' or k < 4").collect()) == [(0, "x"), (1, "y"), (3, "x")]
    after.collect()
    final = plan(after).split("Initial Plan")[0]
    assert "BroadcastHashJoin" in final and "LeftAnti" in final


def test_empty_lists_build_no_filter(spark):
    df = spark.range(3).withColumn("name", F.lit("a"))
    assert "Filter" not in plan(filters.allow_deny(df, "name"))
    assert "Filter" not in plan(filters.include_internal(df, F.col("id") == 1, include=True))
