"""The text operators over the given tables, with production parameters."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from entitylog.llm import (
    bpe, embed, langid, licenses, lm, mix, quality, repeats, shards, simhash, spelling, tries, warc,
)
from entitylog.llm.common import shared_folder, small_batches, stored, table

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every whole text and the text they decode to, as digests."""
    small_batches(spark)
    rows = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = bpe.decode(bpe.encode(rows, VOCABULARY).drop("text"), VOCABULARY)
    ids = F.array_join(F.col("ids").cast("array<string>"), " ")
    return rows.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(ids.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence of every document, its own or that of the nearest directory above.

    Documents have no path: they are laid out by source, ten thousands and hundreds
    of their id. A document that opens with its licence's line is a licence file.
    """
    rows = table(spark, sf_dir, "documents")
    match = licenses.matcher(rows)
    place = [F.coalesce("source", F.lit("none")), F.expr("doc_id div 10000"), F.expr("doc_id div 100"), F.col("doc_id")]
    rows = rows.select("doc_id", "text", F.concat_ws("/", *(p.cast("string") for p in place)).alias("path"))
    found = stored(licenses.scan(rows, match).drop("text"), "licenses")
    found = licenses.inherit(found.withColumn("is_file", F.coalesce(F.col("line") == 0, F.lit(False))))
    return found.select(
        "doc_id", "path", "license", F.round("cosine", 6).alias("cosine"), "line", "unit", "effective", "basis", "from_dir"
    )


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and the groups of near ones."""
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    digits = F.lower(F.lpad(F.hex(F.col("fingerprint")[0]), 16, "0"))
    return groups.select(
        F.col("id").alias("doc_id"), digits.alias("fingerprint"), F.col("component").alias("component_id")
    )


def op4_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links and groups of near vectors of one label."""
    found = embed.near_vectors(table(spark, sf_dir, "embeddings"))
    return found.select(
        F.col("id").alias("vec_id"),
        "n_links",
        F.col("component").alias("component_id"),
        F.col("id").eqNullSafe(F.col("component")).alias("kept"),
    )


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mix.taken(table(spark, sf_dir, "documents"))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text, learned from two thirds of the ids."""
    rows = table(spark, sf_dir, "documents")
    held_out = langid.remainder("doc_id", 3) == 1
    model = langid.learn(rows.filter(~held_out))
    rows = rows.select("doc_id", "text").withColumn("held_out", held_out)
    return langid.identify(rows, model).select("doc_id", "held_out", "lang_pred", "score", "ambiguous")


def op7_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of every whole text, learned from six sevenths of the ids.

    Blocks are runs of rows of a file.
    """
    rows = table(spark, sf_dir, "documents")
    at = F.xxhash64(F.col("_metadata.file_path"), F.expr(f"_metadata.row_index div {lm.BLOCK}"))
    rows = rows.select("doc_id", "text", at.alias("block"))
    rows = rows.withColumn("held_out", langid.remainder("doc_id", 7) == 2)
    model = lm.train(rows.filter(~F.col("held_out")), VOCABULARY)
    return lm.scores(rows, model, VOCABULARY, block=F.col("block"))


def op8_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every text keeps without its passages of 400 bytes that stand elsewhere too."""
    rows = repeats.without_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), readable=False)
    return rows.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept_bytes", 256).alias("kept_sha256"),
        (F.col("n_removed") / F.greatest("n_bytes", F.lit(1))).alias("removed_share"),
        (F.col("n_removed") > 0).alias("has_repeats"),
    )


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measures of all documents, base verdict, and verdict with their host's."""
    judged = quality.judge(table(spark, sf_dir, "documents"), keep=("doc_id",))
    return judged.select("doc_id", *quality.MEASURES, "kept")


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, row counts at most one apart."""
    return shards.interleaved(table(spark, sf_dir, "documents")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What an archive of all pages gives when it is read back."""
    path = f"{shared_folder(spark)}/llm/archive-{uuid.uuid4().hex}"
    warc.write(table(spark, sf_dir, "pages"), path)
    return warc.read(spark, path).select(
        F.col("page").alias("page_id"),
        F.length("payload").cast("long").alias("payload_bytes"),
        F.sha2("payload", 256).alias("payload_digest"),
        "record_type",
        F.col("refers_to_page").alias("refers_to"),
    )


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their near words, forms and roots."""
    found = spelling.variants(table(spark, sf_dir, "documents"))
    return found.select("word", "n", "n_near", "form", "form_n", "root")


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the prefix trie of all conversations."""
    return tries.conversation_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_bpe, op2_licenses, op3_simhash, op4_embeddings, op5_mixing, op6_language, op7_lm, op8_suffixes,
        op9_quality, op10_sharding, op11_warc, op12_spelling, op13_conversations,
    )
}
