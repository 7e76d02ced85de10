"""Lookups that complete listed keys with their description and config."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Resource types a config can belong to.
RESOURCE_TYPES = {"broker": "BROKER", "topic": "TOPIC"}


def resource_type(col: Column) -> Column:
    """The resource type named in a column, UNKNOWN when it is no known one."""
    known = F.lit("UNKNOWN")
    for word, name in RESOURCE_TYPES.items():
        known = F.when(F.lower(col) == word, name).otherwise(known)
    return known


def with_description(
    names: DataFrame, descriptions: DataFrame, key: str = "name", how: str = "inner"
) -> DataFrame:
    """Listed keys with their description.

    A key without one drops out. With ``how="left"`` it stays, with nulls: it is
    listed, so it is not deleted, but nothing can be said about its value.
    """
    return names.join(descriptions, key, how)


def with_config(
    df: DataFrame,
    configs: DataFrame,
    key: str | Sequence[str],
    config: str = "config",
    default: Column | None = None,
    resource: str | None = None,
) -> DataFrame:
    """Rows with their config, the default (an empty map) where there is none.

    ``configs`` has the key, the config and optionally ``lookup_failed``; with
    ``resource`` only its rows of that ``resource_type`` are used. A failed
    lookup is not an absent config: the flag is passed on, and the change log
    says nothing about such a row in that round.
    """
    if resource is not None:
        configs = configs.filter(resource_type(F.col("resource_type")) == resource)
    failed = F.col("lookup_failed") if "lookup_failed" in configs.columns else F.lit(False)
    keys = [key] if isinstance(key, str) else list(key)
    found = configs.select(*keys, F.col(config).alias("_config"), failed.alias("_failed"))
    if default is None:
        default = F.create_map().cast("map<string,string>")
    rows = df.drop(config).join(found, keys, "left")
    return rows.withColumns(
        {
            config: F.coalesce("_config", default),
            "lookup_failed": F.coalesce("_failed", F.lit(False)),
        }
    ).drop("_config", "_failed")
