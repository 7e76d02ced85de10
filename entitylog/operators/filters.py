"""Which keys may enter the log.

Lists given as parameters reach the plan as literals. Lists given as tables are
joined on the key; Spark decides from their measured size how.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def csv_list(col: Column) -> Column:
    """Names between commas, empty ones dropped, blanks kept as they are."""
    return F.filter(F.split(col, ","), lambda name: name != "")


def allowed(name: Column, allow: Sequence[str] = (), deny: Sequence[str] = ()) -> Column:
    """True for names that are not denied and, where a list is given, allowed.

    Deny is looked at first, so a name on both lists stays out.
    """
    passes = F.lit(True)
    if deny:
        passes = passes & ~F.coalesce(name.isin(list(deny)), F.lit(False))
    if allow:
        passes = passes & name.isin(list(allow))
    return passes


def allow_deny(
    df: DataFrame,
    key: str,
    allow: Sequence[str] | DataFrame = (),
    deny: Sequence[str] | DataFrame = (),
) -> DataFrame:
    """Rows whose key passes the lists; an empty list filters nothing.

    A null key is on no list: never denied, and not allowed where a list is given.

    A table given as a list has the key column of ``df``. An empty allow table
    counts as no list, which the plan finds out by itself.
    """
    if isinstance(deny, DataFrame):
        df = df.join(deny.select(key), key, "left_anti")
    elif deny:
        df = df.filter(~F.coalesce(F.col(key).isin(list(deny)), F.lit(False)))
    if isinstance(allow, DataFrame):
        listed = allow.select(key).filter(F.col(key).isNotNull())
        any_listed = listed.select(F.max(F.lit(True)).alias("any")).scalar()
        df = (
            df.join(listed.distinct().withColumn("_listed", F.lit(True)), key, "left")
            .filter(F.col("_listed") | any_listed.isNull())
            .drop("_listed")
        )
    elif allow:
        df = df.filter(F.col(key).isin(list(allow)))
    return df


def visible(internal: Column, include_internal: bool) -> Column:
    """True unless the row is internal and internal rows are left out."""
    return F.lit(True) if include_internal else ~F.coalesce(internal, F.lit(False))


def include_internal(df: DataFrame, internal: Column, include: bool = False) -> DataFrame:
    return df if include else df.filter(visible(internal, include))
