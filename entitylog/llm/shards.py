"""Shards that each hold the mixture of sources, by fractional ranks.

Rows are shuffled inside their source by a seeded hash of their id and ranked.
The rank ``r`` of ``n`` becomes the fraction ``(r + 1/2) / n``; sorted by it, the
sources interleave in proportion everywhere, and the sorted rows are cut into
shards whose row counts differ by at most one.

Both ranks are made in buckets, by hash and by fraction, so neither a source of
any size nor the whole table is sorted in one task. Null sources are a source of
their own, null texts are empty, rows of one id stand together, equal rows in
any order. No shard is empty unless there are fewer rows than shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entitylog.llm.common import running, source_key, stored

SEED = "shards-1"
#: Buckets of fractions that rows are sorted in.
FRACTIONS = 1024


def slim(df: DataFrame, id: str, text: str, source: str, seed: str) -> DataFrame:
    """Ids, sizes and a shuffling key of every row, without the texts."""
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id).cast("string"), F.lit(""))))
    return df.select(
        F.col(id).alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit(""))).alias("text_crc32"),
        source_key(source).alias("stratum"),
        order.alias("order"),
        F.substring(order, 1, 3).alias("bucket"),
    )


def interleaved(
    df: DataFrame,
    shards: int = 40,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    seed: str = SEED,
) -> DataFrame:
    """Every row's ``doc_id``, ``size``, ``text_crc32``, ``stratum``, ``shard`` and ``slot`` in it."""
    rows = stored(slim(df, id, text, source, seed), "rows")
    # A table whose size Spark knows: it is sent to the tasks only if small.
    counts = stored(rows.groupBy("stratum").agg(F.count(F.lit(1)).alias("n")), "strata")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    ranked = running(rows, ["stratum"], "bucket", ["order", "doc_id", "size", "text_crc32"], F.lit(1), "rank")
    placed = ranked.join(counts, "stratum").withColumn("fraction", (F.col("rank") + 0.5) / F.col("n"))
    placed = stored(placed.withColumn("bucket", F.floor(F.col("fraction") * FRACTIONS)), "fractions")
    sorted_ = running(placed, [], "bucket", ["fraction", "stratum", "rank"], F.lit(1), "place")
    shard = F.expr(f"cast(place * {shards} div {max(total, 1)} as int)")
    first = F.expr(f"(cast(shard as bigint) * {total} + {shards - 1}) div {shards}")
    return (
        sorted_.withColumn("shard", shard)
        .withColumn("slot", F.col("place") - first)
        .select("doc_id", "size", "text_crc32", "stratum", "shard", "slot")
    )
