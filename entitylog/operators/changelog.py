"""Differences between states and snapshots, as Created / Updated / Deleted rows.

Everything here is generic over key and value columns. A *change* row has the
key columns, ``op`` and the new values (null for Deleted). Topic changes become
log rows with ``topic_steps``.

``present`` rows of a snapshot that are not ``eligible`` (deny-listed, internal,
failed lookup) say nothing about their key: no change, and no delete either.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from entitylog.functions.canon import digest, same
from entitylog.schema import CREATED, DELETED, SEQ, UPDATED


def keyless(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows with a null among ``keys``. They are no entity: every comparison here
    leaves them out, so report them with this (for rounds, name that column too)."""
    return df.filter(reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys], F.lit(False)))


def _keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    for key in keys:
        df = df.filter(F.col(key).isNotNull())
    return df


def _value_type(df: DataFrame, values: Sequence[str]) -> StructType:
    return StructType([df.schema[name] for name in values])


def created(state: DataFrame, snap: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Snapshot rows whose key is not in the state."""
    return _keyed(snap, keys).join(state.select(*keys), list(keys), "left_anti")


def deleted(state: DataFrame, snap: DataFrame, keys: Sequence[str]) -> DataFrame:
    """State keys that the snapshot does not list (pass it unfiltered)."""
    return _keyed(state.select(*keys), keys).join(snap.select(*keys), list(keys), "left_anti")


def known(state: DataFrame, snap: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Snapshot rows whose key is in the state."""
    return snap.join(state.select(*keys), list(keys), "left_semi")


def updated(
    state: DataFrame, snap: DataFrame, keys: Sequence[str], values: Sequence[str]
) -> DataFrame:
    """Snapshot rows whose key is in the state with another value."""
    dtype = _value_type(snap, values)
    old = state.select(*keys, F.struct(*values).alias("_old"))
    return (
        snap.join(old, list(keys), "inner")
        .filter(~same(F.struct(*values), F.col("_old"), dtype))
        .drop("_old")
    )


def diff(
    state: DataFrame,
    snap: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    eligible: Column | None = None,
    forget_absent: bool = True,
) -> DataFrame:
    """All changes of one round in one join.

    ``forget_absent=False`` keeps keys the snapshot no longer lists, so that the
    join only has to follow the snapshot's side.
    """
    dtype = _value_type(snap, values)
    new = _keyed(snap, keys).select(
        *keys,
        F.struct(*values).alias("_new"),
        (F.lit(True) if eligible is None else F.coalesce(eligible, F.lit(False))).alias("_ok"),
    )
    old = _keyed(state, keys).select(*keys, F.struct(*values).alias("_old"))
    both = new.join(old, list(keys), "full" if forget_absent else "left")
    op = (
        F.when(F.col("_ok").isNull(), DELETED)
        .when(F.col("_ok") & F.col("_old").isNull(), CREATED)
        .when(F.col("_ok") & ~same(F.col("_new"), F.col("_old"), dtype), UPDATED)
    )
    return (
        both.withColumn("op", op)
        .filter(F.col("op").isNotNull())
        .select(*keys, "op", *[F.col("_new")[v].alias(v) for v in values])
    )


def diff_one(state: DataFrame, snap: DataFrame, values: Sequence[str]) -> DataFrame:
    """The change of a single slot: both sides hold at most one row.

    Another id in the slot is an update like any other change of value.
    """
    new, old = F.struct(*values), F.col("_old")
    op = F.when(old.isNull(), CREATED).when(~same(new, old, _value_type(snap, values)), UPDATED)
    return (
        snap.withColumn("_old", state.select(F.struct(*values)).scalar())
        .withColumn("op", op)
        .filter(F.col("op").isNotNull())
        .select("op", *values)
    )


def missing_nodes(state: DataFrame, nodes: DataFrame, key: str = "id", node: str = "node") -> DataFrame:
    """State rows whose exact node value is not among the listed nodes.

    A report only; nothing is removed. A moved node counts as missing too.
    """
    dtype = nodes.schema[node].dataType
    left, right = state.alias("state"), nodes.select(key, node).alias("nodes")
    match = (F.col(f"state.{key}") == F.col(f"nodes.{key}")) & same(
        F.col(f"state.{node}"), F.col(f"nodes.{node}"), dtype
    )
    return left.join(right, match, "left_anti")


def missing_rounds(
    listed: DataFrame, keys: Sequence[str], node: str, rounds: tuple[int, int], round: str = "snapshot_id",
    chunk: int = 2048,
) -> DataFrame:
    """Runs of rounds in which a known key was not listed as it was: keys, ``first``, ``last``, ``moved``.

    ``listed`` has one row per key and round. A key is known from its first listing
    on. Missing is a round that does not list it; and, with ``moved``, one that lists
    it with another node than its last listing before, which is known from then on.
    Runs of absent rounds are gaps between a key's rows, so no round is made up for
    them, and ``moved`` rounds that follow each other are one run. Rounds after a
    key's last listing are missing up to the last round polled.

    A key's rounds are compared in groups of ``chunk``, and one row per group carries
    its last listing on, so that a key may have any number of rounds. Rows with a null
    key or round are no entity.
    """
    first, last = rounds
    dtype = listed.schema[node].dataType
    rows = _keyed(listed, [*keys, round]).filter(F.col(round).between(first, last)).select(
        *keys, F.col(round).cast("long").alias("_r"), F.struct(F.col(node).alias("node")).alias("_v")
    )
    rows = rows.withColumn("_chunk", F.expr(f"(_r - {first}) div {chunk}"))
    group = [*keys, "_chunk"]
    # Said here, so that both uses below share one shuffle.
    rows = rows.repartition(*group)
    ends = rows.groupBy(*group).agg(F.max_by(F.struct("_r", "_v"), "_r").alias("_last"), F.min("_r").alias("_begin"))
    w = Window.partitionBy(*keys).orderBy("_chunk")
    carry = ends.select(*group, F.lag("_last").over(w).alias("_carried"), F.lead("_begin").over(w).alias("_following"))
    inside = Window.partitionBy(*group).orderBy("_r")
    rows = rows.join(carry, group).withColumns(
        {
            "_before": F.coalesce(F.lag(F.struct("_r", "_v")).over(inside), "_carried"),
            "_next": F.coalesce(F.lead("_r").over(inside), "_following", F.lit(last + 1)),
        }
    )
    absent = rows.filter(F.col("_next") > F.col("_r") + 1).select(
        *keys, (F.col("_r") + 1).alias("first"), (F.col("_next") - 1).alias("last"), F.lit(False).alias("moved")
    )
    moved = rows.filter(
        F.col("_before").isNotNull() & ~same(F.col("_v.node"), F.col("_before._v.node"), dtype)
    ).select(*keys, "_r")
    # Consecutive rounds have one distance from their place in the key's order.
    place = F.row_number().over(Window.partitionBy(*keys, F.expr(f"(_r - {first}) div {chunk}")).orderBy("_r"))
    runs = moved.withColumns({"_chunk": F.expr(f"(_r - {first}) div {chunk}"), "_island": F.col("_r") - place})
    runs = runs.groupBy(*keys, "_chunk", "_island").agg(F.min("_r").alias("first"), F.max("_r").alias("last"))
    # Runs that touch across the border of two groups are one: few rows a key.
    w = Window.partitionBy(*keys).orderBy("first")
    opens = F.coalesce(F.col("first") > F.lag("last").over(w) + 1, F.lit(True))
    runs = runs.withColumn("_run", F.sum(opens.cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    runs = runs.groupBy(*keys, "_run").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    return absent.unionByName(runs.select(*keys, "first", "last", F.lit(True).alias("moved")))


def topic_steps(changes: DataFrame) -> DataFrame:
    """Change rows of topics as log rows with ``seq`` and ``op_tag``.

    A new topic is announced by an empty Created and then described by an
    Updated, which the produced counter still counts as Created.
    """
    values = [c for c in changes.columns if c != "op"]

    def step(op: str, tag: str) -> Column:
        return F.struct(
            F.lit(op).alias("op"), F.lit(tag).alias("op_tag"), F.lit(SEQ[op]).alias("seq")
        )

    steps = (
        F.when(F.col("op") == CREATED, F.array(step(CREATED, CREATED), step(UPDATED, CREATED)))
        .when(F.col("op") == UPDATED, F.array(step(UPDATED, UPDATED)))
        .otherwise(F.array(step(DELETED, DELETED)))
    )
    return changes.withColumn("_step", F.explode(steps)).select(*values, "_step.*")


def plain_steps(changes: DataFrame) -> DataFrame:
    """Change rows as log rows, one each."""
    seq = F.create_map(*[F.lit(x) for pair in SEQ.items() for x in pair])
    return changes.withColumns({"op_tag": F.col("op"), "seq": seq[F.col("op")]})


def from_snapshots(
    snaps: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    rounds: tuple[int, int],
    round: str = "snapshot_id",
    eligible: Column | None = None,
    forget_absent: bool = True,
    state: DataFrame | None = None,
    chunk: int | None = None,
) -> DataFrame:
    """All changes of many consecutive rounds in one job.

    ``rounds`` is the first and last round polled; other rows are left out, and
    a round without rows is a poll that listed nothing. ``snaps`` has one row
    per key and round. ``state`` is what was known before the first round. The
    result equals applying ``diff`` round by round.

    Rows are shuffled once, by key. For keys with very many rounds, ``chunk``
    splits each key's rounds into window groups of so many: rows are then
    shuffled by key and chunk, and one row per key and chunk once more, to carry
    the last known value from one chunk into the next. Without keys there is one
    slot, so its rounds are one group unless they are split.
    """
    first, last = rounds
    dtype = _value_type(snaps, values)
    value = F.struct(*values)
    # A row that says nothing keeps its place but not its value.
    placed = snaps.filter(F.col(round).between(first, last)).select(
        *keys,
        F.col(round).cast("long").alias("_r"),
        (value if eligible is None else F.when(eligible, value)).alias("_v"),
    )
    start = first
    if state is not None:
        # The state before the first round acts as one more round.
        start = first - 1
        placed = placed.union(
            state.select(
                *keys,
                F.lit(start).cast("long"),
                # Field by field, as a field that may be null casts to none that may not.
                F.struct(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in dtype.fields)),
            )
        )
    chunked = chunk is not None
    group = list(keys)
    if chunked:
        placed = placed.withColumn("_chunk", F.expr(f"(_r - {start}) div {chunk}"))
        group = [*keys, "_chunk"]
    # Said here, so that Spark need not say it for one of the two uses below
    # only and shuffle twice.
    placed = _keyed(placed, [*group, "_r"])
    if chunked:
        placed = placed.repartition(*group)

    w = Window.partitionBy(*group).orderBy("_r")
    rows = placed.withColumns({"_prev": F.lag("_r").over(w), "_next": F.lead("_r").over(w)})
    follows = F.col("_prev") == F.col("_r") - 1
    # _seen_r and _seen_v: the last row that said something. _run: where the run
    # of consecutive rounds began, or any of its rounds up to the last row seen.
    if eligible is None:
        rows = rows.withColumns(
            {
                "_seen_r": F.col("_prev"),
                "_seen_v": F.lag("_v").over(w),
                "_run": F.when(follows, F.col("_prev")).otherwise(F.col("_r")),
            }
        )
    else:
        so_far = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        before = w.rowsBetween(Window.unboundedPreceding, -1)
        spoken = F.when(F.col("_v").isNotNull(), F.col("_r"))
        begins = F.when(F.coalesce(~follows, F.lit(True)), F.col("_r"))
        rows = rows.withColumns(
            {
                "_seen_r": F.max(spoken).over(before),
                "_seen_v": F.last("_v", ignorenulls=True).over(before),
            }
        ).withColumn("_run", F.max(begins).over(so_far))
    if chunked:
        rows = _carried(rows, keys, group)

    is_known = F.col("_seen_r").isNotNull()
    if forget_absent:
        is_known = is_known & (F.col("_seen_r") >= F.col("_run"))
    speaks = F.col("_v").isNotNull()
    op = F.when(
        speaks,
        F.when(~is_known, CREATED).when(~same(F.col("_v"), F.col("_seen_v"), dtype), UPDATED),
    )
    rows = rows.withColumn("_op", op)
    if forget_absent:
        gone = (
            (F.col("_r") < last)
            & (F.col("_next").isNull() | (F.col("_next") > F.col("_r") + 1))
            & (speaks | is_known)
        )
        # A key's last row before an absence stands for the delete after it too.
        own = F.struct(F.col("_r").alias("r"), F.col("_op").alias("op"))
        delete = F.struct((F.col("_r") + 1).alias("r"), F.lit(DELETED).alias("op"))
        both = F.when(F.col("_op").isNull(), F.array(delete)).otherwise(F.array(own, delete))
        rows = (
            rows.withColumn("_gone", gone)
            .filter(F.col("_op").isNotNull() | F.col("_gone"))
            .select(*keys, "_v", F.explode(F.when(F.col("_gone"), both).otherwise(F.array(own))).alias("_c"))
            .select(
                *keys,
                F.col("_c.r").alias("_r"),
                F.col("_c.op").alias("_op"),
                F.when(F.col("_c.op") != DELETED, F.col("_v")).alias("_v"),
            )
        )
    return rows.filter(F.col("_op").isNotNull() & (F.col("_r") >= first)).select(
        *keys,
        F.col("_r").alias(round),
        F.col("_op").alias("op"),
        *[F.col("_v")[v].alias(v) for v in values],
    )


def by_digest(
    snaps: DataFrame,
    keys: Sequence[str],
    values: Sequence[str],
    rounds: tuple[int, int],
    round: str = "snapshot_id",
    eligible: Column | None = None,
    forget_absent: bool = True,
    state: DataFrame | None = None,
    chunk: int | None = None,
) -> DataFrame:
    """What ``from_snapshots`` gives, with digests in place of the values in its shuffle and windows.

    The values of what changed are fetched afterwards, by key and round. Where few rows
    change and values are large, such as partition lists, this moves a fraction of
    the bytes: the changed keys are sent to the snapshots where they lie. The snapshots
    are read twice.
    """
    dtype = _value_type(snaps, values)
    speaks = F.lit(True) if eligible is None else eligible
    short = snaps.select(*keys, round, digest(F.struct(*values), dtype).alias("_digest"), speaks.alias("_speaks"))
    if state is not None:
        state = state.select(*keys, digest(F.struct(*values), dtype).alias("_digest"))
    changes = from_snapshots(
        short, keys, ["_digest"], rounds, round, None if eligible is None else F.col("_speaks"), forget_absent, state, chunk
    ).drop("_digest")
    told = changes.filter(F.col("op") != DELETED)
    told = told.join(snaps.select(*keys, round, *values), [*keys, round])
    gone = changes.filter(F.col("op") == DELETED)
    gone = gone.select("*", *(F.lit(None).cast(snaps.schema[v].dataType).alias(v) for v in values))
    columns = [*keys, round, "op", *values]
    return told.select(*columns).union(gone.select(*columns))


def _carried(rows: DataFrame, keys: Sequence[str], group: Sequence[str]) -> DataFrame:
    """Fill what a chunk cannot know by itself from the chunks around it."""
    edges = rows.filter(F.col("_prev").isNull() | F.col("_next").isNull())
    closing = F.struct(
        "_run",
        F.coalesce(F.when(F.col("_v").isNotNull(), F.col("_r")), F.col("_seen_r")).alias("_seen_r"),
        F.coalesce("_v", "_seen_v").alias("_seen_v"),
    )
    chunks = (
        edges.groupBy(*group)
        .agg(
            F.min("_r").alias("_begin"),
            F.max("_r").alias("_end"),
            F.max_by(closing, "_r").alias("_last"),
        )
        .select(*group, "_begin", "_end", "_last.*")
    )
    w = Window.partitionBy(*keys).orderBy("_chunk")
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    opens = F.coalesce(F.lag("_end").over(w) < F.col("_begin") - 1, F.lit(True))
    carry = (
        chunks.withColumns(
            {
                "_opens": opens,
                "_next0": F.lead("_begin").over(w),
                "_seen_r0": F.max("_seen_r").over(before),
                "_seen_v0": F.last("_seen_v", ignorenulls=True).over(before),
            }
        )
        # A chunk that only goes on with a run knows nothing of its beginning.
        .withColumn("_own", F.when(F.col("_opens") | (F.col("_run") > F.col("_begin")), F.col("_run")))
        .withColumn("_earlier", F.last("_own", ignorenulls=True).over(before))
        .select(
            *group,
            "_begin",
            F.when(F.col("_opens"), F.col("_begin")).otherwise(F.col("_earlier")).alias("_run0"),
            "_next0",
            "_seen_r0",
            "_seen_v0",
        )
    )
    return rows.join(carry, list(group), "left").withColumns(
        {
            "_run": F.when(F.col("_run") == F.col("_begin"), F.col("_run0")).otherwise(F.col("_run")),
            "_next": F.coalesce("_next", "_next0"),
            "_seen_r": F.coalesce("_seen_r", "_seen_r0"),
            "_seen_v": F.coalesce("_seen_v", "_seen_v0"),
        }
    )
