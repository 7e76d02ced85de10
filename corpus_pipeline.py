"""The corpus pipeline: five stages over the documents, each with one text operator.

A stage takes the rows its predecessor kept and returns rows with the same
columns; the last adds the ids. ``run`` writes what a stage returns to the
shared folder and reads it again for the next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from entitylog.llm import bpe, mix, quality, repeats, simhash
from entitylog.llm.common import lasting, passing, small_batches, stored, table
from entitylog.llm.queries import VOCABULARY


#: The columns of a document that its stage does not read, as one, so that none clashes with what an operator adds.
REST = "_rest"


def apart(docs: DataFrame, *used: str) -> DataFrame:
    """The columns named, and all others as one."""
    rest = [c for c in docs.columns if c not in used]
    return docs.select(*used, *([F.struct(*rest).alias(REST)] if rest else []))


def whole(docs: DataFrame, **changed: Column) -> list[Column]:
    """The columns of ``docs`` in their order from rows of ``apart``, some of them changed."""
    used = {c for c in docs.columns if c in changed}
    found = []
    for c in docs.columns:
        value = changed[c] if c in used else F.col(f"{REST}.{c}")
        found.append(value.alias(c))
    return found


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor their host's verdict reject.

    A null text has no word and goes; documents without a source are one host. Equal
    rows are judged alike and all stay or go. Of no documents none stay.
    """
    used = ("text", "source")
    judged = quality.judge(apart(docs, *used), keep=(*used, *apart(docs, *used).columns[2:]))
    return judged.filter("kept").select(*whole(docs, text=F.col("text"), source=F.col("source")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest id.

    Near are documents that share 0.8 or more of their five-word shingles. Texts are
    compared and kept, not ids: rows of one id or of none with different texts are
    different documents. Of equal ids the least digest of the text and then of the
    row decides, null ids come last, and of rows equal in all columns one stays.
    What is written on the way is removed before the stage's rows are read.
    """
    null = [F.col(c).isNull() for c in docs.columns]
    rows = docs.select(
        "doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("_text"),
        F.xxhash64(*docs.columns, *null).alias("_row"), F.struct(*docs.columns).alias("_doc"),
    )
    with passing(spark):
        texts = rows.select("_text", F.col("_doc.text").alias("text"))
        groups = simhash.near_groups(texts, id="_text", law=simhash.SIMILAR).select("id", "component").distinct()
        first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_text", "_row")).alias("first")
        firsts = rows.groupBy("_text").agg(first)
        kept = groups.join(firsts, F.col("id") == F.col("_text")).groupBy("component").agg(F.min("first").alias("first"))
        kept = lasting(kept.select("first._row"), "kept")
    return rows.dropDuplicates(["_row"]).join(kept, "_row", "left_semi").select("_doc.*")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that stand elsewhere too; those that keep no word go.

    Passages are strings of 400 bytes, judged on the texts as they come in: of rows
    with one text each loses what the others have, so all of it. Null and empty texts
    go. ``n_chars`` is that of what is kept; a character cut in two is left out.
    """
    rows = repeats.without_repeats(apart(docs, "text"))
    kept = rows.filter(F.expr("kept rlike '[^ \\\\x09-\\\\x0D]'"))
    return kept.select(*whole(docs, text=F.col("kept"), n_chars=F.length("kept").cast("long")))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, whole: words taken over words, rounded.

    Null sources are one, the last. Rows alike in id, source and size share what is
    taken of them; texts without a word are not taken. Null ids are one id.
    """
    used = ("doc_id", "text", "source")
    return mix.repeated(apart(docs, *used)).select(*whole(docs, **{c: F.col(c) for c in used}))


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their ids, and the text the ids decode to as a digest.

    Null and empty texts have no ids and the digest of nothing. Rows are taken one by
    one, so equal rows get equal ids.

    Where a document has a column of such a name already, it keeps it, and the new
    one's name begins with ``new_``.
    """
    small_batches(spark)
    rows = bpe.both_ways(apart(docs, "text"), VOCABULARY)
    digest = F.sha2(F.col("decoded").cast("binary"), 256)
    added = {"ids": F.col("ids"), "n_tokens": F.size("ids").cast("long"), "decoded_sha256": digest}
    named = [value.alias(f"new_{name}" if name in docs.columns else name) for name, value in added.items()]
    return rows.select(*whole(docs, text=F.col("text")), *named)


STAGES = [
    ("quality", quality_rules),
    ("near_duplicates", near_duplicates),
    ("repeated_passages", repeated_passages),
    ("mixture", mixture),
    ("token_ids", token_ids),
]

#: Fingerprints, suffixes and ids are beyond SQL; the tests hold every stage against a plain one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        rows = stored(stage(spark, rows, sf_dir), name)
    return rows
