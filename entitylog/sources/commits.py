"""Tables that change by commits: readers see whole versions and nothing else.

A version is written as one or more directories of its own and counts once its
entry is there, ``<path>/_commits/version=<n>``, one row that says which
directories it adds and removes, or, as a *base*, all that it consists of. A
writer that failed before leaves directories which no entry names and no reader
looks at. A version is committed once: tried again, its rows stay as they are, so
those who follow the entries as a stream get every row exactly once.

A table has one writer. Versions need not be consecutive. Readers pick a version
and keep it while later commits merge or replace directories; what no version in
use needs any more is removed by ``expire``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery
from pyspark.sql.types import ArrayType

from entitylog.schema import BOOL, INT, LONG, STRING, struct
from entitylog.session import remove

PIECE = struct(name=STRING, level=INT)
ENTRY = struct(base=BOOL, adds=ArrayType(PIECE), removes=ArrayType(STRING))


def commits_path(path: str, version: int | None = None) -> str:
    return f"{path}/_commits" if version is None else f"{path}/_commits/version={version}"


def new_piece(batch: int) -> str:
    """A directory name that no other attempt has."""
    return f"data/piece={batch}-{uuid.uuid4().hex}"


def _found(df: Callable[[], DataFrame]) -> DataFrame | None:
    try:
        return df()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def entry(spark: SparkSession, path: str, version: int) -> Row | None:
    """The entry of one version, if it is committed; no other is looked at."""
    rows = _found(lambda: spark.read.schema(ENTRY).json(commits_path(path, version)))
    return None if rows is None else rows.first()


def commit(
    spark: SparkSession,
    path: str,
    version: int,
    adds: Iterable[tuple[str, int]],
    removes: Iterable[str] = (),
    base: bool = False,
) -> None:
    """Make a version of directories that are already written (name and level of each)."""
    row = (base, [tuple(piece) for piece in adds], list(removes))
    # An entry's directory may be left without its row; it is no entry then.
    spark.createDataFrame([row], ENTRY).coalesce(1).write.mode("overwrite").json(commits_path(path, version))


def entries(spark: SparkSession, path: str) -> DataFrame | None:
    """All entries with their version, if there are any."""
    schema = struct(**{f.name: f.dataType for f in ENTRY.fields}, version=LONG)
    return _found(lambda: spark.read.schema(schema).json(commits_path(path)))


def pieces(spark: SparkSession, path: str, version: int | None = None) -> list[tuple[str, int]]:
    """Name and level of each directory of the last version, or of the last not after the one given.

    The entries since the last base come to the driver: names, as file listings do.
    """
    found = entries(spark, path)
    if found is None:
        return []
    if version is not None:
        found = found.filter(F.col("version") <= version)
    base = found.filter("base").agg(F.max("version")).first()[0]
    if base is not None:
        found = found.filter(F.col("version") >= base)
    live: dict[str, int] = {}
    for row in found.orderBy("version").collect():
        live = {} if row.base else live
        live |= {piece.name: piece.level for piece in row.adds}
        live = {name: level for name, level in live.items() if name not in row.removes}
    return list(live.items())


def versions(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the committed versions."""
    found = entries(spark, path)
    return [] if found is None else [r.version for r in found.select("version").orderBy("version").collect()]


def last_version(spark: SparkSession, path: str, before: int | None = None) -> int | None:
    """The last version, or the last before another."""
    found = entries(spark, path)
    if found is not None and before is not None:
        found = found.filter(F.col("version") < before)
    return None if found is None else found.agg(F.max("version")).first()[0]


def follow(
    spark: SparkSession, path: str, step: Callable[[DataFrame, int], None], checkpoint: str, once: bool = False,
    interval: str = "30 seconds", commits_per_batch: int = 64,
) -> StreamingQuery:
    """Calls ``step`` with the entries that add rows, from the first on, each in one batch, and the batch's number.

    At most ``commits_per_batch`` entries are admitted to a batch. Entries that only
    replace directories add no rows and are left out.
    """
    new = spark.readStream.schema(ENTRY).option("maxFilesPerTrigger", commits_per_batch).json(f"{commits_path(path)}/version=*")
    trigger = {"availableNow": True} if once else {"processingTime": interval}
    return (
        new.filter(~F.col("base"))
        .writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )


def expire(spark: SparkSession, path: str, keep: int) -> list[str]:
    """Remove versions before ``keep`` and the directories that only they need; their names.

    ``keep`` must be a base: what it consists of, and what later entries add, stays.
    """
    row = entry(spark, path, keep)
    if row is None or not row.base:
        raise ValueError(f"version {keep} is no base")
    old = entries(spark, path).filter(F.col("version") < keep).collect()
    stays = {piece.name for piece in row.adds}
    gone = sorted({piece.name for r in old for piece in r.adds} - stays)
    # Entries first, so that none is left that names a removed directory.
    for r in old:
        remove(spark, commits_path(path, r.version))
    for name in gone:
        remove(spark, f"{path}/{name}")
    return gone
