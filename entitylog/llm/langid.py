"""Language identification by error-correcting output codes.

Every language has a codeword, a row of a Hadamard matrix. For each bit a binary
classifier tells the languages with a one from those with a minus one: the
logarithm of the ratio of their byte three-gram rates, averaged over a text.
Decoding sums a loss over the bits for each codeword, weighted by how well the
bit's classifier separates that language, and takes the least; ties go to the
first language in code point order. A text is flagged as ambiguous if the second
codeword is nearly as close.

The rates come from all labelled training rows. The model holds a number per
gram cell and bit, so its size depends on the number of languages only; counts
per language and cell are what the driver sees. Null texts and texts without a
letter are ``und``, score 0, ambiguous; with nothing learned all texts are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitylog.llm.common import small_batches

#: Cells that grams are hashed to.
CELLS = 1 << 15
#: A text is ambiguous if the two least losses differ by less than this share.
NEAR = 0.1
NONE = "und"

_LETTERS = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def grams(text: str) -> np.ndarray:
    """Cells of the three-grams of a lower-cased text, signs and digits as blanks."""
    data = (" " + text.lower() + " ").encode("utf-8", "surrogatepass").translate(_LETTERS)
    b = np.frombuffer(data, np.uint8).astype(np.uint32)
    h = (b[:-2] * np.uint32(0x9E3779B1)) ^ (b[1:-1] * np.uint32(0x85EBCA6B)) ^ (b[2:] * np.uint32(0xC2B2AE35))
    return (h ^ (h >> np.uint32(15))) * np.uint32(0x27D4EB2F) >> np.uint32(32 - CELLS.bit_length() + 1)


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def remainder(id: str, by: int) -> Column:
    """crc32 of the id as text, modulo ``by``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id).cast("string"), F.lit(""))) % by


@dataclass
class Codes:
    """``languages``, ``words`` (language by bit), ``weights`` (same), ``cells`` (cell by bit), ``unit`` by bit."""

    languages: list[str]
    words: np.ndarray
    weights: np.ndarray
    cells: np.ndarray
    unit: np.ndarray

    def of(self, text: str | None) -> tuple[str, float, bool]:
        if not self.languages or not has_letter(text):
            return NONE, 0.0, True
        if len(self.languages) == 1:
            return self.languages[0], 1.0, False
        found = grams(text)
        if len(found) > CELLS // 4:
            margins = np.bincount(found, minlength=CELLS) @ self.cells / len(found)
        else:
            margins = self.cells[found].sum(axis=0) / len(found)
        z = np.clip(self.words * (margins / self.unit), -30, 30)
        losses = (self.weights * np.exp(-z)).sum(axis=1)
        best = int(losses.argmin())
        odds = np.exp(losses[best] - losses)
        second = np.partition(losses, 1)[1]
        return self.languages[best], float(1 / odds.sum()), bool(second - losses[best] < NEAR * second)


def codewords(n: int) -> np.ndarray:
    """Codewords of n languages, at least eight bits, without bits that are equal for all."""
    order = max(8, 1 << n.bit_length())
    i, j = np.arange(1, n + 1)[:, None], np.arange(order)[None, :]
    words = 1 - 2 * (np.bitwise_count(i & j) % 2).astype(np.int64)
    return words[:, (words != words[0]).any(axis=0)]


def learn(df: DataFrame, text: str = "text", language: str = "lang") -> Codes:
    """The model of all rows with a language and a text."""
    small_batches(df.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for t, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if has_letter(t):
                    seen = sums.setdefault(name, np.zeros(CELLS, np.int64))
                    seen += np.bincount(grams(t), minlength=CELLS)
        for name, seen in sums.items():
            cells = np.flatnonzero(seen)
            yield pa.RecordBatch.from_pydict(
                {"name": pa.array([name] * len(cells), pa.string()), "cell": cells, "n": seen[cells]}
            )

    rows = df.filter(F.col(text).isNotNull() & F.col(language).isNotNull()).select(text, language)
    counts = rows.mapInArrow(count, "name string, cell long, n long").groupBy("name", "cell").agg(
        F.sum("n").alias("n")
    )
    seen = counts.toPandas()
    languages = sorted(seen["name"].unique().tolist(), key=lambda s: s.encode("utf-8", "surrogatepass"))
    if len(languages) < 2:
        none = np.zeros((len(languages), 0))
        return Codes(languages, none, none, np.zeros((CELLS, 0)), np.zeros(0))
    table = np.full((len(languages), CELLS), 0.5)
    at = {name: n for n, name in enumerate(languages)}
    np.add.at(table, (seen["name"].map(at).to_numpy(), seen["cell"].to_numpy()), seen["n"].to_numpy())
    rates = table / table.sum(axis=1, keepdims=True)
    words = codewords(len(languages))
    ones, others = (words > 0).astype(float), (words < 0).astype(float)
    cells = np.log((ones / ones.sum(axis=0)).T @ rates) - np.log((others / others.sum(axis=0)).T @ rates)
    # What a text of each language is expected to score, in the direction of its codeword.
    expected = np.maximum(words * (rates @ cells.T), 1e-6)
    return Codes(
        languages,
        words,
        expected / expected.sum(axis=1, keepdims=True),
        np.ascontiguousarray(cells.T.astype(np.float32)),
        expected.mean(axis=0),
    )


def identify(df: DataFrame, model: Codes, text: str = "text") -> DataFrame:
    """Adds ``lang_pred``, ``score`` (0 to 1) and ``ambiguous`` for every whole text."""
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, ambiguous boolean")
    def predicted(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for part in texts:
            yield pd.DataFrame(
                [shared.value.of(t) for t in part], columns=["lang_pred", "score", "ambiguous"]
            )

    out = df.withColumn("_found", predicted(text))
    for name in ("lang_pred", "score", "ambiguous"):
        out = out.withColumn(name, F.col("_found")[name])
    return out.drop("_found")
