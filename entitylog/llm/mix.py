"""Mixing sources to target weights by a low-discrepancy schedule of token blocks.

Sources are weighted 1, 2, 3, 1, 2, 3, ... in code point order, null last, and
share all words by weight. A target stops at ``MOST`` times its source's size,
and what is over is shared again by weight until no target is above.

The documents of a source are shuffled by a seeded hash of their id and laid end
to end; that stream is cut into blocks of equal numbers of words (one apart), of
``BLOCK`` words at most and at least ``FINE`` blocks a source where it has as
many words. Each source is due a number of slots, its target in blocks. The
slots' golden-ratio points, mapped through the cumulative numbers due, give every
slot its source; the slots of a source are ranked, and slot ``r`` takes block
``r`` modulo the number of blocks. Ranks of ``MOST`` rounds or more are left out.
Blocks and slots grow with the words, and meet in a join.

Null texts and texts without words have size 0 and are never taken; a source
without words has target 0. Rows of one id stand together; equal rows in any
order. Everything is built-in DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from entitylog.llm.common import SPACE, running, source_key, stored

BLOCK, FINE, MOST, SEED = 2048, 1000, 3, "mix-1"
#: Modulus and step of the integer golden-ratio sequence: 2^31 and its golden part, odd.
MODULUS, GOLDEN = 1 << 31, 1327217885
#: Parts of the schedule that slots and sources meet in and are ranked in.
CELLS = 1024


def word_count(text: str) -> Column:
    """Number of words: the places where a word starts."""
    flat = F.concat(F.lit(" "), F.translate(F.coalesce(F.col(text), F.lit("")), SPACE[1:], " " * 5))
    return F.size(F.filter(F.split(flat, " "), lambda x: x != "")).cast("long")


def documents_of(df: DataFrame, id: str, text: str, source: str, seed: str) -> DataFrame:
    """Id, size and place in its source's stream of every row, without the texts."""
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id).cast("string"), F.lit(""))))
    rows = stored(
        df.select(
            F.col(id).alias("doc_id"),
            word_count(text).alias("size"),
            source_key(source).alias("stratum"),
            order.alias("order"),
            F.substring(order, 1, 3).alias("bucket"),
        ),
        "sizes",
    )
    return running(rows, ["stratum"], "bucket", ["order", "doc_id", "size"], F.col("size"), "start").select(
        "doc_id", "size", "stratum", "start"
    )


def targets(sizes: DataFrame, block: int = BLOCK, fine: int = FINE, most: int = MOST) -> DataFrame:
    """One row per source: weight, size, target, number of blocks, slots due and their cumulative range.

    A source is full if its limit is reached at the share its weight has when
    all sources with a lower limit per weight are full.
    """
    each = sizes.groupBy("stratum").agg(F.sum("size").alias("source_size"))
    whole = Window.partitionBy()
    by_name = Window.orderBy("stratum")
    each = each.withColumn("weight", ((F.row_number().over(by_name) - 1) % 3 + 1).cast("long"))
    each = each.withColumn("total", F.sum("source_size").over(whole)).withColumn("limit", most * F.col("source_size"))
    by_limit = Window.orderBy(F.col("limit") / F.col("weight"), "stratum")
    earlier = by_limit.rowsBetween(Window.unboundedPreceding, -1)
    later = by_limit.rowsBetween(0, Window.unboundedFollowing)
    rest = F.col("total") - F.coalesce(F.sum("limit").over(earlier), F.lit(0))
    each = each.withColumn("full", F.col("limit") * F.sum("weight").over(later) <= F.col("weight") * rest)
    unfilled = F.col("total") - F.sum(F.when(F.col("full"), F.col("limit")).otherwise(0)).over(whole)
    weights = F.sum(F.when(F.col("full"), 0).otherwise(F.col("weight"))).over(whole)
    each = each.withColumn("unfilled", unfilled).withColumn("weights", weights)
    share = F.col("unfilled").cast("double") * F.col("weight") / F.greatest("weights", F.lit(1))
    each = each.withColumn("target", F.when(F.col("full"), F.col("limit").cast("double")).otherwise(share))
    blocks = F.expr(f"least(source_size, greatest((source_size + {block - 1}) div {block}, {fine}))")
    each = each.withColumn("blocks", blocks)
    due = F.when(F.col("source_size") > 0, F.round(F.col("target") / F.col("source_size") * F.col("blocks")))
    each = each.withColumn("due", F.coalesce(due, F.lit(0)).cast("long"))
    before = by_name.rowsBetween(Window.unboundedPreceding, -1)
    return each.withColumn("low", F.coalesce(F.sum("due").over(before), F.lit(0))).select(
        "stratum", "weight", "source_size", "target", "blocks", "due", "low"
    )


def schedule(strata: DataFrame, most: int = MOST) -> DataFrame:
    """One row per slot: ``slot``, ``stratum``, ``rank`` in it, and the ``block`` it takes."""
    slots = strata.agg(F.coalesce(F.sum("due"), F.lit(0))).first()[0]
    width = max(-(-slots // CELLS), 1)
    point = F.expr(f"cast(floor((id % {MODULUS}) * {GOLDEN} % {MODULUS} / double({MODULUS}) * {slots}) as bigint)")
    each = strata.sparkSession.range(slots).select(F.col("id").alias("slot"), point.alias("point"))
    each = each.withColumn("cell", F.expr(f"point div {width}"))
    spans = strata.filter("due > 0").withColumn(
        "cell", F.explode(F.expr(f"sequence(low div {width}, (low + due - 1) div {width})"))
    )
    drawn = each.join(spans, "cell").filter("point >= low and point < low + due")
    drawn = drawn.select("slot", "stratum", "blocks", F.expr(f"slot div {width}").alias("part"))
    ranked = running(drawn, ["stratum"], "part", ["slot"], F.lit(1), "rank")
    return ranked.filter(F.col("rank") < most * F.col("blocks")).select(
        "slot", "stratum", "rank", F.expr("rank % blocks").alias("block")
    )


def pieces(documents: DataFrame, strata: DataFrame) -> DataFrame:
    """The blocks' content: ``stratum``, ``block``, and the words ``low`` to ``high`` of a document."""
    # Block k begins at floor(k * words / blocks), so longer blocks lie evenly among the others.
    rows = documents.filter("size > 0").join(strata.select("stratum", "source_size", "blocks"), "stratum")
    at = "cast((cast({0} + 1 as decimal(20, 0)) * blocks - 1) div source_size as bigint)"
    rows = rows.withColumn(
        "block", F.explode(F.expr(f"sequence({at.format('start')}, {at.format('(start + size - 1)')})"))
    )
    begin = "cast(cast({0} as decimal(20, 0)) * source_size div blocks as bigint)"
    rows = rows.withColumn("begin", F.expr(begin.format("block"))).withColumn(
        "end", F.expr(begin.format("(block + 1)"))
    )
    return rows.select(
        "stratum",
        "block",
        "doc_id",
        "start",
        "size",
        (F.greatest("begin", "start") - F.col("start")).alias("low"),
        (F.least(F.col("end"), F.col("start") + F.col("size")) - F.col("start")).alias("high"),
    )


def mixed(
    df: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", seed: str = SEED
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The mix, its documents, and its sources.

    The mix has a row per slot and document in it, with the words it takes of
    the document; sorted by ``slot`` and ``start`` it is the order to read in.
    """
    documents = stored(documents_of(df, id, text, source, seed), "documents")
    # A table whose size Spark knows: it is sent to the tasks only if small.
    strata = stored(targets(documents), "sources")
    mix = schedule(strata).join(pieces(documents, strata), ["stratum", "block"])
    return mix, documents, strata


def taken(
    df: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: str = SEED,
    keep: str | None = None,
) -> DataFrame:
    """Per document its size, its source's size and target, and the words the mix takes of it."""
    mix, documents, strata = mixed(df, id, text, source, seed)
    words = mix.groupBy("stratum", "start").agg(F.sum(F.col("high") - F.col("low")).alias("words"))
    rows = documents.withColumn("from", F.when(F.col("size") > 0, F.col("start")))
    return (
        rows.join(words.withColumnRenamed("start", "from"), ["stratum", "from"], "left")
        .join(strata.select("stratum", "source_size", "target"), "stratum")
        .select(
            "doc_id",
            "size",
            "source_size",
            "target",
            F.coalesce("words", F.lit(0)).alias("taken"),
            *([keep] if keep else []),
        )
    )


def repeated(
    df: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source", seed: str = SEED
) -> DataFrame:
    """Whole rows, each as often as the mix takes its words, rounded.

    Rows alike in id, source and size share what is taken of them.
    """
    key = ["doc_id", "_size", "_stratum"]
    words = stored(taken(df, id, text, source, seed, keep="stratum"), "taken")
    times = words.groupBy("doc_id", F.col("size").alias("_size"), F.col("stratum").alias("_stratum")).agg(
        F.floor(F.sum("taken") / F.greatest(F.sum("size"), F.lit(1)) + 0.5).cast("int").alias("_times")
    )
    rows = df.withColumns({"_size": word_count(text), "_stratum": source_key(source), "_id": F.col(id)})
    same = F.col("_id").eqNullSafe(F.col("t.doc_id"))
    for name in key[1:]:
        same = same & (F.col(f"d.{name}") == F.col(f"t.{name}"))
    joined = rows.alias("d").join(times.filter("_times > 0").alias("t"), same)
    return joined.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(
        *(F.col(f"d.{c}") for c in df.columns)
    )
