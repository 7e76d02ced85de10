"""Current state as tables, temporary views and JSON lines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entitylog.operators.state import brokers_current, cluster_current, topics_current
from entitylog.schema import BROKER_STATE, CLUSTER_STATE, TOPIC_STATE

STATES = {"topics": TOPIC_STATE, "brokers": BROKER_STATE, "cluster": CLUSTER_STATE}
VIEWS = (*STATES, "events")


def topics(log: DataFrame) -> DataFrame:
    return topics_current(log)


def brokers(log: DataFrame) -> DataFrame:
    return brokers_current(log)


def cluster(log: DataFrame) -> DataFrame:
    """One row, or none before the first cluster event."""
    return cluster_current(log)


def events(log: DataFrame) -> DataFrame:
    return log


def write_views(log: DataFrame, path: str) -> None:
    """Fold the log once per view and keep the state as tables."""
    for name, view in zip(STATES, (topics, brokers, cluster)):
        view(log).write.mode("overwrite").parquet(f"{path}/{name}")


def read_view(spark: SparkSession, path: str, name: str) -> DataFrame:
    """A kept view, as it was when it was written."""
    return spark.read.schema(STATES[name]).parquet(f"{path}/{name}")


def register_views(log: DataFrame, prefix: str = "") -> None:
    """Make the views available to SQL under their names, optionally prefixed."""
    for name, view in zip(VIEWS, (topics, brokers, cluster, events)):
        view(log).createOrReplaceTempView(f"{prefix}{name}")


def to_json_view(view: DataFrame) -> DataFrame:
    """One JSON object per row, as ``json``.

    Absent optional fields are left out; null config values stay. A config is an
    object with its map under ``entries``.
    """
    columns: list[Column] = [
        F.struct(F.coalesce("config", F.create_map().cast("map<string,string>")).alias("entries")).alias("config")
        if name == "config"
        else F.col(name)
        for name in view.columns
    ]
    return view.select(F.to_json(F.struct(*columns)).alias("json"))


def write_json_view(view: DataFrame, path: str) -> None:
    to_json_view(view).withColumnRenamed("json", "value").write.mode("overwrite").text(path)
