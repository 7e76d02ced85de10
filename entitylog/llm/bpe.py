"""BPE encoding and decoding by an automaton compiled from the merges.

A merge list is compiled, rule by rule, into a deterministic automaton whose
arcs are labelled with tokens and which accepts exactly the token sequences the
merges lead to. It starts as one state with a loop for every base symbol. The
gadget for a rule ``u v -> w`` takes the arc ``v`` out of the state behind
``u``, and adds an arc ``w`` wherever ``u`` and then ``v`` could be taken; the
arc leads to a copy of the state behind ``v`` as it is at that moment. Arcs with
one label all lead to one state, so the state behind a token is known by the
token, and is held as the arcs taken out of it, its base state and the moment of
the copy. Words are encoded by walking the arcs; a text is decoded by emitting
the labels of its ids.

Nulls and empty texts have no ids. Ids that are null or unknown are skipped in
decoding. Other columns are left as they are; the output column replaces one of
its name.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import chain

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words whose ids a worker keeps; it starts anew beyond.
KEPT_WORDS = 250_000
#: Arcs whose answer is kept, about 200 bytes each.
KEPT_ARCS = 500_000


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in plain}
    for n, b in enumerate(b for b in range(256) if b not in out):
        out[b] = chr(256 + n)
    return [out[b] for b in range(256)]


class Automaton:
    """Token arcs compiled from merges.

    ``symbols``: ids of the base symbols, the first the state loops on.
    ``merges``: pairs of ids and the id they make, in order of application.
    """

    def __init__(self, symbols: list[int], merges: list[tuple[int, int, int]]) -> None:
        self.born = dict.fromkeys(symbols, -1)
        self.parts: dict[int, tuple[int, int]] = {}
        self.removed: dict[int, dict[int, int]] = {t: {} for t in symbols}
        self.base: dict[int, tuple[int, int] | None] = dict.fromkeys(symbols)
        self.arcs: dict[tuple[int, int], bool] = {}
        for step, (u, v, w) in enumerate(merges):
            self.gadget(step, u, v, w)

    def gadget(self, step: int, u: int, v: int, w: int) -> None:
        if w in self.born or u not in self.born or v not in self.born:
            raise ValueError(f"rule {step} makes a token anew or of unknown ones")
        self.born[w] = step
        self.parts[w] = (u, v)
        # The state behind w is the state behind v as it is now.
        self.removed[w] = {}
        self.base[w] = (v, step)
        self.removed[u].setdefault(v, step)

    def _taken_out(self, state: int, label: int) -> int | None:
        """The step at which an arc was taken out of a state."""
        until = None
        while True:
            step = self.removed[state].get(label)
            if step is not None and (until is None or step < until):
                return step
            if self.base[state] is None:
                return None
            state, copied = self.base[state]
            until = copied if until is None else min(until, copied)

    def arc(self, state: int, label: int) -> bool:
        """Whether the state behind one token has an arc for another.

        It has if the arc was added, that is if the first part's arc was still
        there then, and was not taken out after. Kept once known.
        """
        known = self.arcs.get((state, label))
        if known is None:
            part, until, known = label, None, True
            while known:
                step = self._taken_out(state, part)
                known = step is None or (until is not None and step > until)
                if part not in self.parts:
                    break
                until = self.born[part] if until is None else min(until, self.born[part])
                part = self.parts[part][0]
            if len(self.arcs) > KEPT_ARCS:
                self.arcs.clear()
            self.arcs[state, label] = known
        return known


class _Words(dict):
    """Ids of words, found when first asked for."""

    def __init__(self, find) -> None:
        super().__init__()
        self.find = find

    def __missing__(self, word: str) -> tuple[int, ...]:
        ids = self[word] = self.find(word)
        return ids


class Vocabulary:
    """Words to ids and back, from the model part of a tokenizer file.

    ``rules`` keeps the first merges only, which is a coarser vocabulary of the
    same kind.
    """

    def __init__(self, model: dict, rules: int | None = None, special: dict[str, int] | None = None) -> None:
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"][:rules]]
        self.suffix = suffix
        made = [(vocab[u], vocab[v], vocab[(u.removesuffix(suffix) if suffix else u) + v]) for u, v in pairs]
        shown = byte_symbols()
        self.shown = {b: s for b, s in enumerate(shown)}
        symbols = [vocab[s] for s in shown] + ([vocab[s + suffix] for s in shown] if suffix else [])
        self.automaton = Automaton(symbols, made)
        known = self.automaton.born
        self.inner = {s: i for s, i in vocab.items() if i in known and not (suffix and s.endswith(suffix))}
        self.final = (
            {s.removesuffix(suffix): i for s, i in vocab.items() if i in known and s.endswith(suffix)}
            if suffix
            else self.inner
        )
        self.special = special or {}
        self.labels = {i: s for s, i in vocab.items()} | {i: s for s, i in self.special.items()}
        self.longest = max(map(len, [*self.inner, *self.final]))
        self.words = _Words(self._word)
        if self.special:
            names = sorted(self.special, key=len, reverse=True)
            self.split = re.compile("(" + "|".join(map(re.escape, names)) + ")").split
        else:
            self.split = lambda text: [text]

    def _word(self, word: str) -> tuple[int, ...]:
        """Ids of one non-empty pre-split word: the accepted path that spells it."""
        return self.spell(word.encode())

    def spell(self, word: bytes) -> tuple[int, ...]:
        return self._walk("".join([self.shown[b] for b in word]))

    def ids(self, words: list[str]) -> list[int]:
        if len(self.words) >= KEPT_WORDS:
            self.words.clear()
        return list(chain.from_iterable(map(self.words.__getitem__, words)))

    def forget(self) -> None:
        """Drop the words and arcs that are kept."""
        self.words.clear()
        self.automaton.arcs.clear()

    def _walk(self, s: str) -> tuple[int, ...]:
        """Take the longest arc first; where none leads on, take a shorter one before.

        A prefix is spelled by one path only, so a place left without an arc is
        never come back to, and the walk is linear.
        """
        n, longest, inner, final, arc = len(s), self.longest, self.inner, self.final, self.automaton.arc
        path: list[tuple[int, int]] = []
        dead: set[int] = set()
        at, state, to = 0, -1, min(n, longest)
        while at < n:
            found = None
            while to > at:
                if to not in dead:
                    found = final.get(s[at:]) if to == n else inner.get(s[at:to])
                    if found is not None and (state < 0 or arc(state, found)):
                        break
                    found = None
                to -= 1
            if found is not None:
                path.append((found, at))
                at, state, to = to, found, min(n, to + longest)
            else:
                dead.add(at)
                _, back = path.pop()
                at, to, state = back, at - 1, path[-1][0] if path else -1
        return tuple(token for token, _ in path)


# Letters, contractions, single numerals, and other signs: fixed values of the vocabulary.
PRESPLIT = regex.compile(r"\p{L}+|'s|'t|'re|'ve|'m|'ll|'d|\p{N}|[^\s\p{L}\p{N}]+")
#: The same for Latin texts, by the faster of the two libraries.
PRESPLIT_LATIN = re.compile(
    r"[^\W\d_\xb2\xb3\xb9\xbc-\xbe]+|'s|'t|'re|'ve|'m|'ll|'d|[\d\xb2\xb3\xb9\xbc-\xbe]|(?:[^\w\s]+|_+)+"
)
_NOT_LATIN = re.compile("[^\x00-\x1b\x20-\u024f]")


def presplit(text: str) -> list[str]:
    """Lower-cased words in composed form, as the vocabulary's normaliser makes them."""
    text = unicodedata.normalize("NFC", text)
    # One character at a time, unlike Python's own rule for a final sigma.
    text = text.replace("\u03a3", "\u03c3").lower()
    return (PRESPLIT if _NOT_LATIN.search(text) else PRESPLIT_LATIN).findall(text)


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a tokenizer file, compiled once per process."""
    if path not in _loaded:
        with open(path, encoding="utf-8") as file:
            parts = json.load(file)
        special = {t["content"]: t["id"] for t in parts["added_tokens"]}
        _loaded[path] = Vocabulary(parts["model"], special=special)
    return _loaded[path]


def encode_text(vocab: Vocabulary, text: str | None) -> list[int]:
    ids: list[int] = []
    if text:
        for part in vocab.split(text):
            if part in vocab.special:
                ids.append(vocab.special[part])
            else:
                ids += vocab.ids(presplit(part))
    return ids


def encode(df: DataFrame, path: str, text: str = "text", into: str = "ids") -> DataFrame:
    """Adds the ids of every whole text as an array of integers.

    ``path``: the tokenizer file, at the same place on every machine.
    """

    @F.pandas_udf("array<int>")
    def ids(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        vocab = vocabulary(path)
        for part in texts:
            yield pd.Series([encode_text(vocab, t) for t in part], dtype=object)

    return df.withColumn(into, ids(text))


def decode_ids(labels: dict[int, str], ids: Iterable[int] | None) -> str:
    return "" if ids is None else " ".join([labels[i] for i in ids if i in labels])


def decode(df: DataFrame, path: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """Adds the text the ids stand for: their labels joined by single spaces.

    The vocabulary has no decoder of its own, so this is its plain form.
    """

    @F.pandas_udf("string")
    def labels(lists: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = vocabulary(path).labels
        for part in lists:
            yield pd.Series([decode_ids(known, None if x is None else x.tolist()) for x in part], dtype=object)

    return df.withColumn(into, labels(ids))


def both_ways(df: DataFrame, path: str, text: str = "text", ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """What ``decode`` adds to ``encode``, in one pass: a task has one worker and one vocabulary for both.

    The worker's words and arcs go with the task, as Spark keeps workers that wait.
    """

    @F.pandas_udf("ids array<int>, decoded string")
    def found(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        vocab = vocabulary(path)
        try:
            for part in texts:
                lists = [encode_text(vocab, t) for t in part]
                yield pd.DataFrame({"ids": lists, "decoded": [decode_ids(vocab.labels, x) for x in lists]}, dtype=object)
        finally:
            vocab.forget()

    rows = df.withColumn("_found", found(text))
    return rows.withColumn(ids, F.col("_found.ids")).withColumn(decoded, F.col("_found.decoded")).drop("_found")
