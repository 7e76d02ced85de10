"""Licences of texts, by TF-IDF similarity of their lines, headers and wholes to templates and by directory.

Every line of a text, its header (the lines up to the first one without a word,
comment signs aside) and the text as a whole are sparse vectors of their words, ``1 +
ln(count)`` times the word's inverse document frequency ``1 + ln((documents + 1) /
(frequency + 1))``, counted over all documents. Templates are usual statements of one
line and notices and licences of many. What is nearest to a template by cosine gives
the text's licence, if near enough; of equals what begins first, a line before a
header before the whole, then the first licence by name.

Candidates are the lines, headers and wholes that would be near enough if each word that no template
has stood in every document, which weighs least; no other can be. The words
of their distinct kinds are joined to the counts, and a kind is weighed once.

A text without a licence of its own inherits that of the nearest directory above
it with a licence file in it; of several there, the one of the least path.

Null and empty texts have no licence of their own. Rows with a null path inherit
nothing. Columns named like the results are replaced.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entitylog.llm.common import small_batches, spread_join, stored

#: Least cosine of a line to a template.
LEAST = 0.7
#: Words a task counts before it sends what it has.
KEPT_WORDS = 1_000_000

# Usual statements and headings of licences, by SPDX name.
TEMPLATES = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0"),
    ("Apache-2.0", "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/"),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License"),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License"),
    ("BSD-3-Clause", "Redistribution and use in source and binary forms, with or without modification, are permitted"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0"),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0"),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License"),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0"),
    ("CC0-1.0", "Released under CC0 1.0 Universal, public domain dedication"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3"),
    ("LGPL-3.0", "This work is licensed under the GNU Lesser General Public License, version 3"),
    ("MIT", "Released under the MIT License"),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
)

_PERMISSION = (
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated"
    ' documentation files (the "Software"), to deal in the Software without restriction, including without limitation'
    " the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and"
    " to permit persons to whom the Software is furnished to do so, subject to the following conditions: The above"
    " copyright notice and this permission notice shall be included in all copies or substantial portions of the"
    ' Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT'
    " LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT"
    " SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION"
    " OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER"
    " DEALINGS IN THE SOFTWARE."
)
_REDISTRIBUTION = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the"
    " following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this"
    " list of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above"
    " copyright notice, this list of conditions and the following disclaimer in the documentation and/or other"
    " materials provided with the distribution."
)
_NAMES = (
    " 3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote"
    " products derived from this software without specific prior written permission."
)
_DISCLAIMER = (
    ' THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED'
    " WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A"
    " PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY"
    " DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO,"
    " PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER"
    " CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR"
    " OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."
)

# Whole licences, and the notices that longer ones ask for.
TEXTS = (
    ("MIT", "MIT License " + _PERMISSION),
    ("BSD-2-Clause", "BSD 2-Clause License " + _REDISTRIBUTION + _DISCLAIMER),
    ("BSD-3-Clause", "BSD 3-Clause License " + _REDISTRIBUTION + _NAMES + _DISCLAIMER),
    (
        "ISC",
        "ISC License Permission to use, copy, modify, and/or distribute this software for any purpose with or without"
        " fee is hereby granted, provided that the above copyright notice and this permission notice appear in all"
        ' copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE'
        " INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR"
        " ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE,"
        " DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN"
        " CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE.",
    ),
    (
        "Zlib",
        "zlib License This software is provided 'as-is', without any express or implied warranty. In no event will the"
        " authors be held liable for any damages arising from the use of this software. Permission is granted to anyone"
        " to use this software for any purpose, including commercial applications, and to alter it and redistribute it"
        " freely, subject to the following restrictions: 1. The origin of this software must not be misrepresented; you"
        " must not claim that you wrote the original software. If you use this software in a product, an acknowledgment"
        " in the product documentation would be appreciated but is not required. 2. Altered source versions must be"
        " plainly marked as such, and must not be misrepresented as being the original software. 3. This notice may not"
        " be removed or altered from any source distribution.",
    ),
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance'
        " with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless"
        " required by applicable law or agreed to in writing, software distributed under the License is distributed on"
        ' an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License'
        " for the specific language governing permissions and limitations under the License.",
    ),
    (
        "GPL-3.0",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General"
        " Public License as published by the Free Software Foundation, either version 3 of the License, or (at your"
        " option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY"
        " WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the"
        " GNU General Public License for more details. You should have received a copy of the GNU General Public"
        " License along with this program. If not, see http://www.gnu.org/licenses/.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was"
        " not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
    ),
)

#: What a vector is of.
LINE, HEADER, WHOLE = 0, 1, 2
UNITS = ("line", "header", "whole")

WORD = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")


def words_of(line: str) -> list[str]:
    return WORD.findall(line.lower())


class Matcher:
    """Templates as weighted vectors, for documents of which ``seen`` had each word."""

    def __init__(self, templates: tuple, documents: int, seen: dict[str, int]) -> None:
        counts = [Counter(words_of(t)) for _, t in templates]
        self.names = [name for name, _ in templates]
        self.documents = documents
        self.idf = {w: 1 + math.log((documents + 1) / (seen.get(w, 0) + 1)) for c in counts for w in c}
        self.rows: dict[str, np.ndarray] = {w: np.zeros(len(counts)) for w in self.idf}
        for n, c in enumerate(counts):
            vector = {w: (1 + math.log(k)) * self.idf[w] for w, k in c.items()}
            norm = math.sqrt(sum(x * x for x in vector.values()))
            for w, x in vector.items():
                self.rows[w][n] = x / norm

    def __getstate__(self) -> dict:
        return {name: value for name, value in self.__dict__.items() if name != "counts"}

    def cosines(self, words: list[str], rest: float | None = None) -> np.ndarray | None:
        """Of a line to the templates; ``rest``: squares of its other words, the least possible if not given."""
        count = Counter(words)
        common = count.keys() & self.idf.keys()
        if not common:
            return None
        vector = {w: (1 + math.log(count[w])) * self.idf[w] for w in common}
        if rest is None:
            rest = sum((1 + math.log(k)) ** 2 for w, k in count.items() if w not in common)
        norm = math.sqrt(sum(x * x for _, x in sorted(vector.items())) + rest)
        return sum(x * self.rows[w] for w, x in sorted(vector.items())) / norm

    def candidates(self, text: str | None, least: float) -> list[tuple[int, int, str]]:
        """What may be near enough: the number of its first line, its unit, and its words in order."""
        found = []

        def weigh(number: int, unit: int, words: list[str]) -> None:
            cosines = self.cosines(words)
            if cosines is not None and cosines.max() >= least - 1e-9:
                found.append((number, unit, " ".join(sorted(words))))

        lines = [words_of(line) for line in (text or "").split("\n")]
        first = next((n for n, words in enumerate(lines) if words), 0)
        last = next((n for n in range(first, len(lines)) if not lines[n]), len(lines))
        for number, words in enumerate(lines):
            weigh(number, LINE, words)
        if last - first > 1:
            weigh(first, HEADER, list(chain.from_iterable(lines[first:last])))
        if last < len(lines):
            weigh(first, WHOLE, list(chain.from_iterable(lines)))
        return found

    def named(self, words: list[str], rest: float, least: float) -> tuple[str | None, float | None]:
        """Licence and cosine of what has these words."""
        cosines = self.cosines(words, rest)
        top = float(cosines.max())
        if top < least:
            return None, None
        return min(n for n, c in zip(self.names, cosines) if c >= top - 1e-12), top


def matcher(df: DataFrame, text: str = "text", templates: tuple = TEMPLATES + TEXTS) -> Matcher:
    """The templates weighted by all documents: a count per template word reaches the driver.

    ``counts`` of the result is the stored table of every word's document frequency.
    """
    small_batches(df.sparkSession)
    known = {w for _, t in templates for w in words_of(t)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter = Counter()

        def sent() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"word": list(seen), "n": list(seen.values())})

        for batch in batches:
            for t in batch.column(0).to_pylist():
                seen[""] += 1
                seen.update(set(words_of(t or "")))
                if len(seen) > KEPT_WORDS:
                    yield sent()
                    seen.clear()
        yield sent()

    rows = df.select(text).mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    counts = stored(rows, "frequencies")
    seen = dict(counts.filter(F.col("word").isin("", *sorted(known))).collect())
    match = Matcher(templates, seen.get("", 0), seen)
    match.counts = counts
    return match


def scan(df: DataFrame, match: Matcher, text: str = "text", least: float = LEAST) -> DataFrame:
    """Adds the licence each text names: ``license``, ``cosine``, ``line`` (its first, from 0) and ``unit``, or nulls."""
    small_batches(df.sparkSession)
    shared = df.sparkSession.sparkContext.broadcast(match)
    digest = F.sha2(F.coalesce(F.col(text), F.lit("")).cast("binary"), 256)

    def candidates(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [
                (key, *line)
                for key, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())
                for line in shared.value.candidates(t, least)
            ]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(zip(*rows), (pa.string(), pa.int32(), pa.int32(), pa.string()))],
                    ["digest", "line", "unit", "words"],
                )

    @F.pandas_udf("license string, cosine double")
    def named(words: pd.Series, rest: pd.Series) -> pd.DataFrame:
        found = [shared.value.named(w.split(" "), r, least) for w, r in zip(words, rest)]
        return pd.DataFrame(
            {
                "license": pd.Series([f[0] for f in found], dtype=object),
                "cosine": pd.Series([f[1] for f in found], dtype="Float64"),
            }
        )

    lines = df.select(digest.alias("digest"), text).mapInArrow(candidates, "digest string, line int, unit int, words string")
    lines = stored(lines, "lines")
    kinds = lines.select("words").distinct()
    others = (
        kinds.select("words", F.explode(F.split("words", " ")).alias("word"))
        .filter(~F.col("word").isin(*match.idf))
        .groupBy("words", "word")
        .agg(F.count(F.lit(1)).alias("k"))
        .join(match.counts, "word")
    )
    weight = (1 + F.log("k")) * (1 + F.log(F.lit(match.documents + 1.0) / (F.col("n") + 1)))
    rests = others.groupBy("words").agg(F.sum(weight * weight).alias("rest"))
    kinds = kinds.join(rests, "words", "left").withColumn("_of", named("words", F.coalesce("rest", F.lit(0.0))))
    kinds = stored(kinds.select("words", "_of.*").filter("license is not null"), "kinds")
    # Sums of one line's weights may differ in their last digits.
    order = F.struct(-F.round("cosine", 12), "line", "unit")
    best = (
        spread_join(lines, kinds, ["words"])
        .groupBy("digest")
        .agg(F.min_by(F.struct("license", "cosine", "line", F.array(*map(F.lit, UNITS))[F.col("unit")].alias("unit")), order).alias("_named"))
        .withColumnRenamed("digest", "_digest")
    )
    out = df.withColumn("_digest", digest).join(best, "_digest", "left")
    for name in ("license", "cosine", "line", "unit"):
        out = out.withColumn(name, F.col("_named")[name])
    return out.drop("_named", "_digest")


def inherit(df: DataFrame, path: str = "path", is_file: str = "is_file") -> DataFrame:
    """Adds ``effective`` and ``basis``: ``header`` (its own), ``inherited`` with ``from_dir``, or null.

    ``df``: rows with ``license``, a path, and whether the row is a licence file.
    Directories are resolved once each, whatever the number of rows in them.
    """
    rows = df.withColumn("_dir", F.regexp_replace(F.col(path), "/?[^/]*$", ""))
    held = (
        rows.filter(F.col(is_file) & F.col("license").isNotNull() & F.col("_dir").isNotNull())
        .groupBy(F.col("_dir").alias("from_dir"))
        .agg(F.min_by("license", F.struct(path, "license")).alias("_held"))
    )
    parts = F.split("_dir", "/")
    above = F.transform(
        F.sequence(F.lit(0), F.when(F.col("_dir") == "", 0).otherwise(F.size(parts))),
        lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("from_dir")),
    )
    nearest = (
        rows.select("_dir").filter("_dir is not null").distinct()
        .select("_dir", F.explode(above).alias("a")).select("_dir", "a.*")
        .join(held, "from_dir")
        .groupBy("_dir")
        .agg(F.max_by(F.struct("from_dir", "_held"), "depth").alias("_near"))
    )
    out = rows.drop("effective", "basis", "from_dir").join(nearest, "_dir", "left")
    own = F.col("license").isNotNull()
    return out.select(
        *(c for c in out.columns if c not in ("_dir", "_near")),
        F.coalesce("license", F.col("_near._held")).alias("effective"),
        F.when(own, "header").when(F.col("_near").isNotNull(), "inherited").alias("basis"),
        F.when(~own, F.col("_near.from_dir")).alias("from_dir"),
    )
