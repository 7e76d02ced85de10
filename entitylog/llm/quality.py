"""Quality rules on whole texts, and verdicts on the hosts they come from.

``measure`` counts words, symbols, repeated lines and repeated eight-word
windows of every text. ``judge`` adds up the failures of each host, shrinks the
hosts' rates towards the rate of all with a beta prior fitted to the hosts
themselves, and rejects hosts whose shrunk rate is too high, so a handful of
documents hardly moves a host from the rate of all.

Null texts have no words, and fail. Null hosts are one host. Columns with a
measure's name are replaced. Everything is built-in DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entitylog.llm.common import SPACE, stored

WINDOW = 8
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
#: A host goes if more than this share of its documents fails, after shrinking.
MAX_RATE = 0.5


def measure(df: DataFrame, text: str = "text", least_words: int = 20, repeat_percent: int = 30) -> DataFrame:
    """Adds the measures of every whole text and whether it fails the base rules."""
    whole, blanks = F.coalesce(F.col(text), F.lit("")), " " * (len(SPACE) - 1)
    bare = F.length(F.translate(whole, SPACE, ""))
    lines = F.filter(F.split(whole, "\n"), lambda x: F.length(F.translate(x, SPACE, "")) > 0)
    words = F.filter(F.split(F.translate(whole, SPACE[1:], blanks), " "), lambda x: x != "")
    rows = (
        df.withColumn("word_chars", bare.cast("long"))
        .withColumn("n_symbols", (F.length(whole) - F.length(F.translate(whole, "#*$%&|<>", ""))).cast("long"))
        .withColumn("_lines", lines)
        .withColumn("n_dup_lines", (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long"))
        .withColumn("_words", F.transform(words, lambda x: F.xxhash64(x)))
        .withColumn("n_words", F.size("_words").cast("long"))
    )
    at = lambda i: F.xxhash64(*(F.get("_words", i + n) for n in range(WINDOW)))
    starts = F.sequence(F.lit(0), F.size("_words") - WINDOW)
    rows = rows.withColumn(
        "_windows",
        F.when(F.col("n_words") >= WINDOW, F.transform(starts, at)).otherwise(F.array().cast("array<long>")),
    )
    # Most texts repeat no window, and only the others are sorted.
    repeats = F.size(F.array_distinct("_windows")) < F.size("_windows")
    rows = rows.withColumn(
        "_sorted",
        F.when(repeats, F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))),
    )

    def twice(x, i):
        near = lambda n: F.coalesce(F.get("_sorted", i + n)["h"] == x["h"], F.lit(False))
        return near(-1) | near(1)

    rows = rows.withColumn(
        "_places", F.sort_array(F.transform(F.filter("_sorted", twice), lambda x: x["i"]))
    )
    covered = F.transform(
        "_places",
        lambda p, i: F.least(F.lit(WINDOW), p - F.coalesce(F.get("_places", i - 1), p - WINDOW)),
    )
    rows = rows.withColumn(
        "n_repeat_words",
        F.coalesce(F.aggregate(covered, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long"),
    )
    failed = (F.col("n_words") < least_words) | (
        100 * F.col("n_repeat_words") > repeat_percent * F.col("n_words")
    )
    return rows.withColumn("base_failed", failed).drop("_lines", "_words", "_windows", "_sorted", "_places")


def hosts(measured: DataFrame, host: str = "source", max_rate: float = MAX_RATE) -> DataFrame:
    """One row per host: ``documents``, ``failures``, shrunk ``rate`` and ``host_failed``.

    The prior's mean is the rate of all documents; its weight follows from how
    far the hosts' rates spread (method of moments), between 20 and a million
    documents. The prior's two sums are all that comes to the driver.
    """
    each = stored(
        measured.groupBy(F.col(host).alias("host")).agg(
            F.count(F.lit(1)).alias("documents"), F.sum(F.col("base_failed").cast("long")).alias("failures")
        ),
        "hosts",
    )
    total, failures = each.agg(F.sum("documents"), F.sum("failures")).first()
    mean = failures / total if total else 0.0
    off = F.col("failures") / F.col("documents") - F.lit(mean)
    spread = (each.agg(F.sum(F.col("documents") * off * off)).first()[0] or 0.0) / (total or 1)
    weight = min(max(mean * (1 - mean) / spread - 1, 20.0), 1e6) if spread > 0 else 1e6
    rate = (F.col("failures") + F.lit(mean * weight)) / (F.col("documents") + F.lit(weight))
    return stored(
        each.withColumn("rate", rate).withColumn("host_failed", F.col("rate") > max_rate), "verdicts"
    )


def judge(df: DataFrame, text: str = "text", host: str = "source", max_rate: float = MAX_RATE, keep: tuple = ()) -> DataFrame:
    """Every document with its measures, its host's verdict and ``kept``.

    ``keep``: the columns to carry along; all if empty. They are written once
    with the measures, so that texts are measured once.
    """
    rows = measure(df, text)
    if keep:
        rows = rows.select(*dict.fromkeys([*keep, host, *MEASURES]))
    rows = stored(rows.drop("host_failed", "kept"), "measured")
    verdicts = hosts(rows, host, max_rate).select(F.col("host").alias("_host"), "host_failed")
    # The verdicts are a table whose size Spark knows: it is sent to the tasks only if small.
    return (
        rows.join(verdicts, F.col(host).eqNullSafe(F.col("_host")), "left")
        .withColumn("host_failed", F.coalesce("host_failed", F.lit(False)))
        .withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed"))
        .drop("_host")
    )
