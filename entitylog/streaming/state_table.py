"""State kept as sorted-out layers of changes, so that a batch writes what it changed.

A version consists of layers: the changes of the last batches at level 0, and at
every further level the merger of ``fan`` layers of the one before. A layer has the
last event of each of its keys with its place in the log and, in ``_gone``, whether
it removed the key. Reading takes each key's last event over all layers. A removed
key is dropped when its layer is merged with all that lies below it.

With n batches there are at most ``fan`` layers on each of log(n) levels, and a
row is written again log(n) times in all, whatever the size of the state. A batch's
layers and mergers are one commit: a batch that fails in the middle of a merger
leaves the version before it as it was.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from entitylog.operators.state import latest
from entitylog.schema import BOOL
from entitylog.sources import commits

FAN = 8
GONE = "_gone"


def changes_of(
    log: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str],
    op: str = "op", ignore: Sequence[str] = (), remove: Sequence[str] = (),
) -> DataFrame:
    """The last event of each key of a piece of a log, with ``_gone``."""
    if ignore:
        log = log.filter(~F.col(op).isin(list(ignore)))
    gone = F.col(op).isin(list(remove)) if remove else F.lit(False)
    rows = latest(log.withColumn(GONE, gone), keys, order, [*values, GONE])
    # Without keys nothing still aggregates to one row.
    return rows if keys else rows.filter(F.col(GONE).isNotNull())


def _layers(spark: SparkSession, path: str, names: Sequence[str], schema: StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(*(f"{path}/{name}" for name in names))


def append(
    changes: DataFrame, path: str, version: int, before: int | None,
    keys: Sequence[str], order: Sequence[str], values: Sequence[str], fan: int = FAN,
) -> None:
    """Commit the changes of a batch on top of version ``before`` (None: of nothing).

    A version that is committed already stays as it is.
    """
    schema = StructType([changes.schema[c] for c in (*keys, *order, *values)]).add(GONE, BOOL)

    def merge(rows: DataFrame, bottom: bool) -> DataFrame:
        rows = latest(rows, keys, order, [*values, GONE])
        return rows.filter(~F.col(GONE)) if bottom else rows.filter(F.col(GONE).isNotNull())

    append_layer(changes, path, version, before, schema, merge, fan)


def append_layer(
    rows: DataFrame, path: str, version: int, before: int | None, schema: StructType,
    merge: Callable[[DataFrame, bool], DataFrame], fan: int = FAN,
) -> None:
    """Commit a layer on top of version ``before``, with the mergers it makes due.

    ``merge`` makes one layer of the rows of several, whether it is the lowest or not.
    A version that is committed already stays as it is.
    """
    spark, columns = rows.sparkSession, schema.fieldNames()
    if commits.entry(spark, path, version) is not None:
        return
    # Oldest first; a level's layers are newer than those of the levels above it.
    live = [] if before is None else [(p.name, p.level) for p in commits.entry(spark, path, before).adds]
    name, level = commits.new_piece(version), 0
    rows.select(*columns).write.parquet(f"{path}/{name}")
    live.append((name, level))
    while True:
        full = [n for n, l in live if l == level]
        if len(full) < fan:
            break
        rest = [(n, l) for n, l in live if l != level]
        merged = merge(_layers(spark, path, full, schema), not any(l > level for _, l in rest))
        name, level = commits.new_piece(version), level + 1
        merged.select(*columns).write.parquet(f"{path}/{name}")
        # Behind the older layers of the next level, before the newer levels.
        live = [(n, l) for n, l in rest if l >= level] + [(name, level)] + [(n, l) for n, l in rest if l < level]
    commits.commit(spark, path, version, live, base=True)


def layers(spark: SparkSession, path: str, schema: StructType, version: int | None = None) -> DataFrame:
    """The rows of all layers of a version, the last one if none is given."""
    if version is None:
        version = commits.last_version(spark, path)
    row = None if version is None else commits.entry(spark, path, version)
    if row is None:
        return spark.createDataFrame([], schema)
    return _layers(spark, path, [p.name for p in row.adds], schema)


def read(
    spark: SparkSession, path: str, schema: StructType, keys: Sequence[str], order: Sequence[str], version: int | None = None,
) -> DataFrame:
    """Rows of a version, the last one if none is given, with their place in the log."""
    values = [f.name for f in schema.fields if f.name not in (*keys, *order)]
    rows = layers(spark, path, StructType([*schema.fields]).add(GONE, BOOL), version)
    rows = latest(rows, keys, order, [*values, GONE])
    return rows.filter(~F.col(GONE)).select(*schema.fieldNames())
