"""Language-model scores of whole texts, beside those of a plain word count.

The model predicts the next subword. Subwords are ids of a fixed vocabulary, cut
to its first merges, over lower-cased words; an end follows the last. One head
of causal self-attention looks at the last ``CONTEXT`` subwords and at the last
two as a pair. Query and key vectors and a bias by distance give the weights
(the pair's key goes by how often and how variously it was seen), and the values
are tables of what followed a subword at that distance, or the pair. The weighted
sum of the values is the prediction, so probabilities add up to one without a sum
over the vocabulary. The tables are counted from all training texts; the vectors
and biases are trained by gradient steps in numpy on every window of every training
text, in each task, and averaged by the number of windows.

Texts are scored in windows of ``WINDOW`` subwords that overlap by ``CONTEXT``,
many at once; what stands before a text's start is masked, and the overlap gives
context only, so each subword is scored once.

Many texts are taken together: their distinct words are found and spelled once, and
ids, windows and look-ups are made for all of them at once, up to ``AT_ONCE`` bytes.

Words are counted exactly. Documents are dealt into blocks; each block sends its
distinct words once, in lists by bucket, so the commonest word meets its count once
per block. A bucket adds up its words and gives each block back the counts that its
own do not give, beside its documents.

The model has a size bound: subwords squared for the tables by distance, and
subwords times ``PAIRS`` for that of pairs, which share ``PAIRS`` rows by hash.

Null texts are empty: an end alone. Null ids count as empty text where training
texts are chosen. Without training texts the tables are uniform and N is 0.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from entitylog.llm.bpe import Vocabulary
from entitylog.llm.common import small_batches, stored

RULES, CONTEXT, WINDOW, WIDTH = 1024, 4, 256, 8
#: Rows of the pairs' table, and kinds of pair keys.
PAIRS, KINDS = 1 << 16, 32
#: Documents in a block, on average.
BLOCK = 2048
#: Bytes of text whose words are looked up at once, bytes of words held before some are sent early.
AT_ONCE, HELD_BYTES = 1 << 22, 1 << 25
#: Bytes of a word that is spelled beside others; longer ones are spelled alone. Words beside each other.
LONG, BESIDE = 64, 1 << 16
#: Weight of the next subword's overall rate in each row of a table by distance.
SMOOTH = 0.5
#: Learning: subwords of a window, windows of a step, step size, windows gathered before the steps.
SPAN, STEP, RATE, HELD = 64, 64, 0.1, 4096
#: Steps whose tables are looked up at once, and windows scored at once.
STEPS, SCORED_AT_ONCE = 8, 64
TABLES = 3

_loaded: dict[tuple[str, int], "Subwords"] = {}


class Subwords:
    """Dense ids of the vocabulary's first merges; then the end, then the start.

    Distinct words are spelled many at once: each step makes, in every word, the
    earliest of the merges that its neighbours allow, at the first place where it
    can be made. A merge needs what it joins to be made before, so what a step makes
    allows later merges only, and this is what the automaton's path spells.
    """

    def __init__(self, path: str, rules: int) -> None:
        with open(path, encoding="utf-8") as file:
            self.vocab = Vocabulary(json.load(file)["model"], rules)
        made = self.vocab.automaton
        self.dense = {t: n for n, t in enumerate(sorted(made.born))}
        self.end = len(self.dense)
        self.start = self.end + 1
        self.size = self.end + 2
        shown = self.vocab.shown
        kind = np.int16 if self.size < 1 << 15 else np.int32
        self.inner, self.final = (
            np.array([self.dense[of[shown[b]]] for b in range(256)], kind) for of in (self.vocab.inner, self.vocab.final)
        )
        #: The merge that two neighbours allow, and what each merge makes; ``never`` stands for none.
        self.never = len(made.parts)
        self.merge = np.full(self.end**2, self.never, np.min_scalar_type(self.never))
        self.makes = np.zeros(self.never + 1, kind)
        for t, (u, v) in made.parts.items():
            self.merge[self.dense[u] * self.end + self.dense[v]] = made.born[t]
            self.makes[made.born[t]] = self.dense[t]

    def ids(self, words: list[bytes]) -> np.ndarray:
        """Ids of one text's words and its end."""
        return self.laid_out(np.arange(len(words)), np.array([len(words)]), *self.spelled(pa.array(words, pa.binary())))[0][CONTEXT:]

    def spelled(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all words, and where each word's begin and how many they are."""
        ids, first, counts, n = [], np.zeros(len(words), np.int64), np.zeros(len(words), np.int64), 0

        def add(place: np.ndarray, found: np.ndarray) -> None:
            nonlocal n
            size = found.shape[1]
            first[place], counts[place] = np.arange(n, n + found.size, size), size
            ids.append(found.ravel())
            n += found.size

        for a in range(0, len(words), BESIDE):
            part = words[a : a + BESIDE]
            data, lengths = flat_bytes(part)
            for place, found in self._merged(data, lengths):
                add(a + place, found)
            for i in np.flatnonzero(lengths > LONG).tolist():
                add(np.array([a + i]), np.array([[self.dense[t] for t in self.vocab.spell(part[i].as_py())]]))
        return np.concatenate([np.zeros(0, np.int64), *ids]), first, counts

    def _merged(self, data: np.ndarray, lengths: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Places of words of up to ``LONG`` bytes that have as many ids, and these, a row a word.

        Words with as many ids are columns of one table, those with most first. A
        step takes one from each, so words it leaves meet those that begin with as many.
        """
        begin = np.cumsum(lengths) - lengths
        order = np.argsort(np.minimum(lengths, LONG + 1).astype(np.int8), kind="stable")
        ends = np.searchsorted(lengths[order], np.arange(LONG + 2))
        ids, place = np.zeros((LONG + 1, 0), self.inner.dtype), np.zeros(0, np.int64)
        for size in range(LONG, 0, -1):
            new = order[ends[size] : ends[size + 1]]
            raw = data[begin[new] + np.arange(size)[:, None]]
            ids = np.concatenate([ids[:size], self.inner[raw]], axis=1)
            ids[-1, len(place) :] = self.final[raw[-1]]
            place = np.r_[place, new]
            if size == 1 or not len(place):
                if len(place):
                    yield place, ids.T
                continue
            key = ids[:-1].astype(np.int64)
            key *= self.end
            key += ids[1:]
            allowed = self.merge.take(key)
            least = allowed.min(axis=0)
            more, done = np.flatnonzero(least < self.never), np.flatnonzero(least == self.never)
            if len(done):
                yield place[done], ids.take(done, axis=1).T
            # The first place where the earliest merge can be made; from there on ids move up by one.
            moved = (allowed == least).view(np.int8)
            for k in range(1, size - 1):
                moved[k] |= moved[k - 1]
            at = np.minimum(size - 1 - np.add.reduce(moved, axis=0, dtype=np.int8), size - 2)
            left = ids[1:] - ids[:-1]
            left *= moved
            left += ids[:-1]
            left[at, np.arange(len(at))] = self.makes.take(least)
            ids, place = left.take(more, axis=1), place[more]

    def laid_out(
        self, at: np.ndarray, counts: np.ndarray, ids: np.ndarray, first: np.ndarray, size: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of texts one after another, ``CONTEXT`` starts before each and its end behind; where each begins, and its ids.

        ``at``: the words of all texts, by place in ``first`` and ``size``; ``counts``: words of each text.
        """
        ids = np.r_[ids, np.full(CONTEXT, self.start), self.end]
        first, size = np.r_[first, len(ids) - CONTEXT - 1, len(ids) - 1], np.r_[size, CONTEXT, 1]
        words = np.empty(len(at) + 2 * len(counts), np.int64)
        ends = np.cumsum(counts + 2)
        words[ends - counts - 2], words[ends - 1] = len(size) - 2, len(size) - 1
        inside = np.ones(len(words), bool)
        inside[ends - counts - 2] = inside[ends - 1] = False
        words[inside] = at
        n = size[words]
        upto = np.cumsum(n)
        flat = ids[np.repeat(first[words] - upto + n, n) + np.arange(upto[-1] if len(upto) else 0)]
        starts = (upto - n)[ends - counts - 2]
        return flat, starts, np.diff(np.r_[starts, len(flat)]) - CONTEXT

    def of_texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``laid_out`` of whole texts."""
        flat, counts = words_in(texts)
        found = flat.dictionary_encode()
        return self.laid_out(found.indices.to_numpy(), counts, *self.spelled(found.dictionary))


def subwords(path: str, rules: int) -> Subwords:
    if (path, rules) not in _loaded:
        _loaded[path, rules] = Subwords(path, rules)
    return _loaded[path, rules]


def words_of(text: str | None) -> list[bytes]:
    """Words, with A to Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def flat_bytes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all words, and the length of each."""
    _, offsets, data = words.buffers()
    ends = np.frombuffer(offsets, np.int32, len(words) + 1, 4 * words.offset).astype(np.int64)
    return np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]], np.diff(ends)


def words_in(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """``words_of`` many texts, one after another, and their number in each."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.cast(pa.string()), "")))
    counts, words = pc.list_value_length(lists).to_numpy(), lists.flatten().cast(pa.binary())
    there = pc.binary_length(words).to_numpy() > 0
    if not there.all():
        # White space at a text's ends, and an empty text, leave an empty word.
        ends = np.r_[0, np.cumsum(there)][np.cumsum(counts)]
        counts, words = np.diff(np.r_[0, ends]), words.filter(pa.array(there))
    return words, counts.astype(np.int64)


def gathered(batches: Iterable[pa.RecordBatch], text: int | str = 0) -> Iterator[pa.Table]:
    """Rows put together up to ``AT_ONCE`` bytes of text, or one, so that words are looked up once and memory is bounded."""
    held, size = [], 0
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy().astype(np.int64) + 8
        begin = 0
        for n, length in enumerate(lengths.tolist()):
            if size and size + length > AT_ONCE:
                yield pa.Table.from_batches([*held, batch.slice(begin, n - begin)]).combine_chunks()
                held, size, begin = [], 0, n
            size += length
        held.append(batch.slice(begin))
    if any(batch.num_rows for batch in held):
        yield pa.Table.from_batches(held).combine_chunks()


def pair_row(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    h = (first.astype(np.uint64) << np.uint64(32) | second.astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
    return (h >> np.uint64(64 - PAIRS.bit_length() + 1)).astype(np.int64)


def windows_of(ids: np.ndarray, span: int, start: int) -> np.ndarray:
    """A text's ids in windows of ``span``, each after the ``CONTEXT`` ids before it; the last is filled up."""
    return all_windows(np.r_[np.full(CONTEXT, start), ids], np.zeros(1, np.int64), np.array([len(ids)]), span, start)[0]


def all_windows(
    flat: np.ndarray, first: np.ndarray, lengths: np.ndarray, span: int, start: int
) -> tuple[np.ndarray, np.ndarray]:
    """``windows_of`` each of the texts that ``Subwords.laid_out`` gives, and their number."""
    counts = -(-lengths // span)
    ends = np.cumsum(counts)
    nth = np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)
    views = np.lib.stride_tricks.sliding_window_view(np.r_[flat, np.full(CONTEXT + span, start)], CONTEXT + span)
    x = views[np.repeat(first, counts) + nth * span]
    last = x[ends - 1]
    last[np.arange(CONTEXT + span) >= (CONTEXT + lengths - (counts - 1) * span)[:, None]] = start
    x[ends - 1] = last
    return x, counts


class Sparse:
    """A table of positive numbers by keys of 31 bits; a slot is a key before its number's bits, or -1.

    A slot holds one key; keys that find theirs taken go to the next level, a smaller
    table with a hash of its own, so few levels are looked at however keys fall.
    """

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        self.levels: list[np.ndarray] = []
        whole = keys << 32 | values.astype(np.float32).view(np.uint32)
        while len(whole) or not self.levels:
            self.levels.append(np.full(1 << max(int(2 * len(whole)).bit_length(), 4), -1, np.int64))
            slot = self._slot(whole >> 32, len(self.levels) - 1)
            self.levels[-1][slot] = whole
            whole = whole[self.levels[-1][slot] != whole]

    def _slot(self, keys: np.ndarray, level: int) -> np.ndarray:
        h = keys.astype(np.uint64) * np.uint64(pow(0xD6E8FEB86659FD93, 2 * level + 1, 1 << 64))
        h >>= np.uint64(65 - len(self.levels[level]).bit_length())
        return h.view(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values by key, 0 where there is none."""
        flat, out, left = keys.ravel(), None, slice(None)
        for level, slots in enumerate(self.levels):
            there = slots.take(self._slot(flat, level))
            key = there >> 32
            hit = key == flat
            if out is None:
                out = np.where(hit, there.astype(np.uint32).view(np.float32), np.float32(0))
                left = np.flatnonzero(~hit & (key >= 0))
                flat = flat[left]
            else:
                out[left[hit]] = there[hit].astype(np.uint32).view(np.float32)
                more = ~hit & (key >= 0)
                left, flat = left[more], flat[more]
            if not len(left):
                break
        return out.reshape(keys.shape)


def summed(at: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    """Rows added up by place."""
    return np.stack([np.bincount(at, column, n) for column in rows.T], axis=1).astype(np.float32)


class Tables:
    """What follows a subword or a pair, from counts.

    Travels as the counts that are not zero; ``ready`` lays them out: ``values``
    by distance, subword and next subword, ``pairs`` by pair row and next
    subword, ``times`` a pair row was seen, and its ``kinds``, -1 if never.
    """

    def __init__(self, cells: np.ndarray, counts: np.ndarray, size: int) -> None:
        self.cells, self.counts, self.size = cells, counts, size

    def __getstate__(self) -> dict:
        return {name: self.__dict__[name] for name in ("cells", "counts", "size")}

    def ready(self) -> "Tables":
        if "values" in self.__dict__:
            return self
        size, dense = self.size, self.cells < TABLES * self.size**2
        flat = np.zeros(TABLES * size * size, np.float32)
        flat[self.cells[dense]] = self.counts[dense]
        values = flat.reshape(TABLES, size, size)
        overall = values[0].sum(axis=0) + 1.0
        overall[size - 1] = 0.0  # no start follows
        overall /= overall.sum()
        total = values.sum(axis=2, keepdims=True) + SMOOTH
        values += (SMOOTH * overall).astype(np.float32)
        values /= total
        cells, counts = self.cells[~dense] - TABLES * size * size, self.counts[~dense]
        row = cells // size
        times, variety = np.bincount(row, counts, PAIRS), np.bincount(row, minlength=PAIRS)
        self.kinds = np.full(PAIRS, -1, np.int16)
        known = np.flatnonzero(variety)
        self.kinds[known] = np.minimum(3 * np.log2(times[known] / variety[known]), KINDS - 1)
        self.pairs = Sparse(cells, (counts / times[row]).astype(np.float32))
        self.times, self.values = times.astype(np.float32), values
        return self


@dataclass
class Model:
    """The tables, shared with all tasks, and the weights that are trained.

    ``query`` and ``key``: vectors of the subwords, keys also of the kinds of
    pairs; ``bias``: of the pair and the distances.
    """

    tables: Broadcast
    query: np.ndarray
    key: np.ndarray
    bias: np.ndarray

    def affinity(self) -> np.ndarray:
        """Of all subwords to all keys, kept."""
        if "_affinity" not in self.__dict__:
            self._affinity = (self.query @ self.key.T / np.sqrt(np.float32(self.query.shape[1]))).ravel()
        return self._affinity

    def looked_up(self, x: np.ndarray, start: int, counted: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What no weight changes, for windows of ids: the keys, minus infinity where one is not there, and the target's
        probability under each value."""
        size = len(self.query)
        tables = self.tables.value.ready()
        span = x.shape[1] - CONTEXT
        target, own = x[:, CONTEXT:], x[:, CONTEXT - 1 : -1]
        seen = np.empty((CONTEXT + 1, *target.shape), np.int64)
        shut, found = np.zeros(seen.shape, np.float32), np.empty(seen.shape, np.float32)
        row, rows = pair_row(x[:, CONTEXT - 2 : -2], own), x * size
        kind = tables.kinds.take(row)
        np.maximum(kind, 0, out=seen[0])
        seen[0] += size
        shut[0][kind < 0] = -np.inf
        found[0] = tables.pairs.get(row * size + target)
        if counted:
            times = tables.times.take(row)
            found[0] = np.maximum(found[0] * times - 1, 0) / np.maximum(times - 1, 1)
        for o in range(CONTEXT):
            past = x[:, CONTEXT - 1 - o : CONTEXT - 1 - o + span]
            seen[o + 1] = past
            if o:
                shut[o + 1][past == start] = -np.inf
            found[o + 1] = tables.values[min(o, TABLES - 1)].take(rows[:, CONTEXT - 1 - o : CONTEXT - 1 - o + span] + target)
        after = target == start  # after a text's end
        if after.any():
            found[:, after] = 1
        return seen, shut, found

    def weighed(self, own: np.ndarray, seen: np.ndarray, shut: np.ndarray, vectors: bool) -> tuple[np.ndarray, ...]:
        """The keys' weights, for one row of subwords; ``vectors``: with the vectors of queries and keys."""
        query = key = None
        if vectors:
            # Rows of both kinds of vectors are fetched once, for the weights and for the step after.
            query, key = self.query.take(own, axis=0), self.key.take(seen, axis=0)
            weights = np.einsum("nd,ond->on", query / np.sqrt(np.float32(query.shape[-1])), key)
        else:
            weights = self.affinity().take(own * len(self.key) + seen)
        weights += self.bias[:, None]
        weights += shut
        weights -= weights.max(axis=0)
        np.exp(weights, out=weights)
        weights /= weights.sum(axis=0)
        return weights, query, key

    def attend(self, x: np.ndarray, start: int, counted: bool = False) -> tuple:
        """Weights, the target's probability under each value, and the keys, for windows of ids.

        ``counted``: the windows are from the texts that were counted, and each
        subword is left out of the count it meets; the keys then come with the
        vectors of queries and keys.
        """
        seen, shut, found = self.looked_up(x, start, counted)
        own = x[:, CONTEXT - 1 : -1].ravel()
        weights, query, key = self.weighed(own, seen.reshape(len(seen), -1), shut.reshape(len(seen), -1), counted)
        return weights.reshape(found.shape), found, (seen, query, key) if counted else seen

    def score(self, flat: np.ndarray, first: np.ndarray, lengths: np.ndarray, start: int) -> np.ndarray:
        """log10 probability of each text that ``Subwords.laid_out`` gives."""
        x, counts = all_windows(flat, first, lengths, WINDOW, start)
        sums = np.empty(len(x))
        for a in range(0, len(x), SCORED_AT_ONCE):
            weights, found, _ = self.attend(x[a : a + SCORED_AT_ONCE], start)
            p = np.log10(np.einsum("owl,owl->wl", weights, found), dtype=np.float64)
            sums[a : a + SCORED_AT_ONCE] = p.sum(axis=1)
        return np.add.reduceat(sums, np.cumsum(counts) - counts) if len(counts) else np.zeros(0)

    def learn(self, windows: np.ndarray, start: int) -> None:
        """Gradient steps over windows of ids, one pass (adaptive steps per weight)."""
        scale = 1 / np.sqrt(self.query.shape[1])
        past_squares = [np.full_like(p, 1e-6) for p in (self.query, self.key, self.bias)]
        for a in range(0, len(windows), STEPS * STEP):
            some = windows[a : a + STEPS * STEP]
            looked = [part.reshape(CONTEXT + 1, -1) for part in self.looked_up(some, start, counted=True)]
            owns, reals = some[:, CONTEXT - 1 : -1].ravel(), (some[:, CONTEXT:] != start).ravel()
            for at in range(0, len(owns), STEP * SPAN):
                own, real = owns[at : at + STEP * SPAN], reals[at : at + STEP * SPAN]
                seen, shut, found = (part[:, at : at + STEP * SPAN] for part in looked)
                weights, query, key = self.weighed(own, seen, shut, vectors=True)
                blame = weights * found
                blame = (weights - blame / blame.sum(axis=0)) * (real / np.float32(len(own)))
                g = blame * scale
                # What the keys of one place pull is added up before places of one subword are.
                pull_q = summed(own, np.einsum("on,ond->nd", g, key), len(self.query))
                columns = g * np.ascontiguousarray(query.T)[:, None]
                pull_k = summed(seen.ravel(), columns.reshape(len(columns), -1).T, len(self.key))
                pulls = (pull_q, pull_k, blame.sum(axis=1))
                for weight, pull, square in zip((self.query, self.key, self.bias), pulls, past_squares):
                    square += pull * pull
                    weight -= RATE * pull / np.sqrt(square)


def in_lists(values: pa.Array, ends: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)


def dealt(bucket: np.ndarray, buckets: int, **columns: pa.Array) -> dict[str, pa.Array]:
    """Values in lists, one for each bucket that has some."""
    order = np.argsort(bucket.astype(np.min_scalar_type(buckets)), kind="stable")
    ends = np.searchsorted(bucket[order], np.arange(buckets + 1))
    there = np.flatnonzero(np.diff(ends))
    ends, order = np.r_[ends[there], len(order)], pa.array(order)
    return {"bucket": pa.array(there, pa.int64())} | {name: in_lists(c.take(order), ends) for name, c in columns.items()}


def _pairs(path: str, rules: int, buckets: int):
    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts of subwords and what follows them, by table, over a task's texts, in buckets."""
        sub = subwords(path, rules)
        n = sub.size
        sums = np.zeros((TABLES, n * n), np.int64)

        def sent(cells: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(dealt(cells % buckets, buckets, cells=pa.array(cells), n=pa.array(times)))

        for texts in gathered(batches):
            x, _, _ = sub.of_texts(texts.column(0).chunk(0))
            real = np.flatnonzero(x[CONTEXT:] != sub.start) + CONTEXT
            key = pair_row(x[real - 2], x[real - 1]) * n + x[real]
            cells, times = np.unique(key.astype(np.min_scalar_type(PAIRS * n)), return_counts=True)
            for o in range(CONTEXT):
                past, target = x[CONTEXT - 1 - o : len(x) - 1 - o], x[CONTEXT:]
                real = target != sub.start
                if o:
                    real &= past != sub.start
                sums[min(o, TABLES - 1)] += np.bincount(past[real] * n + target[real], minlength=n * n)
            yield sent(cells.astype(np.int64) + TABLES * n * n, times)
        for k in range(TABLES):
            cells = np.flatnonzero(sums[k])
            if len(cells):
                yield sent(cells + k * n * n, sums[k][cells])

    return pairs


def _bucket_cells(part: pa.Table) -> pa.Table:
    """Cells of a bucket and the sums of their counts."""
    cells, n = (part.column(name).combine_chunks().flatten().to_numpy() for name in ("cells", "n"))
    order = np.argsort(cells)
    cells = cells[order]
    first = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
    return pa.table({"cell": cells[first], "n": np.add.reduceat(n[order], first)})


def _trained(start: int, path: str, rules: int, base: Model):
    def trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Weights learned from all windows of a task's texts, times the windows."""
        sub = subwords(path, rules)
        own = replace(base, query=base.query.copy(), key=base.key.copy(), bias=base.bias.copy())
        windows, held, rows = 0, [], 0
        for texts in gathered(batches):
            x, counts = all_windows(*sub.of_texts(texts.column(0).chunk(0)), SPAN, start)
            begin = end = 0
            for n in counts.tolist():
                end += n
                rows += n
                if rows >= HELD:
                    own.learn(np.concatenate([*held, x[begin:end]]), start)
                    windows, held, rows, begin = windows + rows, [], 0, end
            held.append(x[begin:])
        if rows:
            own.learn(np.concatenate(held), start)
            windows += rows
        if windows:
            flat = np.concatenate([p.ravel() for p in (own.query, own.key, own.bias)]).astype(np.float64)
            yield pa.RecordBatch.from_pydict(
                {"at": np.arange(len(flat)), "value": flat * windows, "windows": np.full(len(flat), windows)}
            )

    return trained


def train(df: DataFrame, path: str, text: str = "text", rules: int = RULES) -> Model:
    """The model of all rows of ``df``."""
    spark = df.sparkSession
    small_batches(spark)
    sub = subwords(path, rules)
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = df.select(text).mapInArrow(_pairs(path, rules, buckets), "bucket long, cells array<long>, n array<long>")
    counts = counts.groupBy("bucket").applyInArrow(_bucket_cells, "cell long, n long")
    rng = np.random.default_rng(7)
    query, key = (rng.normal(0, 0.1, (n, WIDTH)).astype(np.float32) for n in (sub.size, sub.size + KINDS))
    bias = np.r_[1.0, -np.arange(CONTEXT)].astype(np.float32)
    seen = counts.toArrow()
    tables = Tables(seen.column("cell").to_numpy(), seen.column("n").to_numpy().astype(np.float32), sub.size)
    model = Model(spark.sparkContext.broadcast(tables), query, key, bias)
    learned = (
        df.select(text)
        .mapInArrow(_trained(sub.start, path, rules, model), "at long, value double, windows long")
        .groupBy("at")
        .agg(F.sum("value").alias("value"), F.sum("windows").alias("windows"))
        .toPandas()
        .sort_values("at")
    )
    if len(learned):
        flat = (learned["value"] / learned["windows"]).to_numpy(np.float32)
        parts = np.split(flat, [query.size, query.size + key.size])
        model = replace(model, query=parts[0].reshape(query.shape), key=parts[1].reshape(key.shape), bias=parts[2])
    return model


def learned_from(texts: pa.Table) -> np.ndarray:
    """Whether a text is not held out."""
    return ~np.array(pc.fill_null(texts.column("held_out"), False).to_numpy(), bool)


def added_up(words: list[pa.Array], counts: list[np.ndarray]) -> tuple[pa.Array, np.ndarray]:
    """Distinct words of some lists of words, and the sum of each one's counts."""
    if len(words) == 1:
        return words[0], counts[0]
    found = pa.concat_arrays([pa.array([], pa.binary()), *words]).dictionary_encode()
    n = np.bincount(found.indices.to_numpy(), np.concatenate([*counts, np.zeros(0, np.int64)]), len(found.dictionary))
    return found.dictionary, n.astype(np.int64)


def buckets_of(words: pa.Array, n: int) -> np.ndarray:
    """A number under ``n`` for each word, by a polynomial of its bytes."""
    powers = np.cumprod(np.full(1 << 12, 0x9E3779B97F4A7C15, np.uint64))
    out = np.zeros(len(words), np.int64)
    for a in range(0, len(words), BESIDE):
        data, lengths = flat_bytes(words[a : a + BESIDE])
        begin = np.cumsum(lengths) - lengths
        place = (np.arange(len(data)) - np.repeat(begin, lengths)) % len(powers)
        h = np.add.reduceat((data + np.uint64(1)) * powers[place], begin)
        h ^= h >> np.uint64(29)
        out[a : a + BESIDE] = (h * np.uint64(0xD6E8FEB86659FD93) >> np.uint64(32)) % np.uint64(n)
    return out


def summed_by(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums over runs of values, some of them empty."""
    sums, some = np.zeros(len(counts), np.int64 if values.dtype == bool else values.dtype), counts > 0
    if some.any():
        sums[some] = np.add.reduceat(values, (np.cumsum(counts) - counts)[some], dtype=sums.dtype)
    return sums


SCORED = "doc_id long, held_out boolean, n_tokens long, n_known long, known_log double, score double"


def scores(
    df: DataFrame,
    model: Model,
    path: str,
    held_out: str = "held_out",
    id: str = "doc_id",
    text: str = "text",
    rules: int = RULES,
    block: Column | None = None,
) -> DataFrame:
    """Per document the model's score, and that of a count of the words that are not held out.

    ``block``: a long by which documents are dealt into blocks, always the same
    for a document; best one that documents read together share. By default a
    hash of id and text.
    """
    spark = df.sparkSession
    small_batches(spark)
    if block is None:
        blocks = max(-(-df.count() // BLOCK), 1)
        block = F.pmod(F.xxhash64(id, text), F.lit(blocks))
    rows = df.select(
        F.col(id).cast("long").alias("doc_id"), F.col(text).alias("text"), F.col(held_out).alias("held_out"),
        block.cast("long").alias("block"),
    )

    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def block_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Distinct words of a task's blocks, with their number in training texts, by bucket."""

        def sent(of: int | None) -> pa.RecordBatch:
            pieces = held.pop(of)
            words, n = added_up([w for w, _ in pieces], [n for _, n in pieces])
            at = buckets_of(words, buckets)
            lists = dealt(at, buckets, words=words, n=pa.array(n))
            return pa.RecordBatch.from_pydict({**lists, "block": pa.array([of] * len(lists["bucket"]), pa.int64())})

        held: dict[int | None, list[tuple[pa.Array, np.ndarray]]] = {}
        for texts in gathered(batches, "text"):
            words, counts = words_in(texts.column("text").chunk(0))
            found = words.dictionary_encode()
            at, words = found.indices.to_numpy(), found.dictionary
            learned = np.repeat(learned_from(texts), counts)
            of = texts.column("block").chunk(0).dictionary_encode("encode")
            block = np.repeat(of.indices.to_numpy(), counts)
            if len(of.dictionary) > 1:
                order = np.argsort(block.astype(np.min_scalar_type(len(of.dictionary))), kind="stable")
                at, learned, block = at[order], learned[order], block[order]
            ends = np.searchsorted(block, np.arange(len(of.dictionary) + 1)).tolist()
            for name, begin, end in zip(of.dictionary.to_pylist(), ends, ends[1:]):
                here, known = np.unique(at[begin:end]), at[begin:end][learned[begin:end]]
                if len(known) > len(words) / 8:
                    n = np.bincount(known, minlength=len(words))[here]
                else:
                    n = np.bincount(np.searchsorted(here, known), minlength=len(here))
                held.setdefault(name, []).append((words.take(pa.array(here)), n))
            # A task that meets many words at once sends some early.
            while len(held) and sum(w.nbytes for pieces in held.values() for w, _ in pieces) > HELD_BYTES:
                yield sent(next(iter(held)))
        for name in list(held):
            yield sent(name)

    def bucket_counts(part: pa.Table) -> pa.Table:
        """To each block the words it does not count rightly by itself; with the sums over a bucket, in one row."""
        lists = part.column("words").combine_chunks()
        n = part.column("n").combine_chunks().flatten().to_numpy()
        found = lists.flatten().dictionary_encode()
        at = found.indices.to_numpy()
        c = np.bincount(at, n, len(found.dictionary)).astype(np.int64)
        other = c[at] != n
        ends = np.r_[0, np.cumsum(other)][np.r_[0, np.cumsum(pc.list_value_length(lists).to_numpy())]]
        once = np.zeros(len(part), np.int64)
        once[0] = 1
        return pa.table(
            {
                "block": part.column("block"),
                "words": in_lists(lists.flatten().filter(pa.array(other)), ends),
                "c": in_lists(pa.array(c[at[other]]), ends),
                "total": once * c.sum(), "distinct": once * np.count_nonzero(c),
            }
        )

    used = rows.select("block", "text", "held_out").mapInArrow(
        block_words, "bucket long, words array<binary>, n array<long>, block long"
    )
    counts = stored(
        used.groupBy("bucket").applyInArrow(
            bucket_counts, "block long, words array<binary>, c array<long>, total long, distinct long"
        ),
        "counts",
    )
    total, distinct = counts.agg(F.coalesce(F.sum("total"), F.lit(0)), F.coalesce(F.sum("distinct"), F.lit(0))).first()
    texts = rows.filter(~F.col("held_out")).count()
    total, distinct = total + texts, distinct + (texts > 0)
    # What a block counted by itself it counts again; sent are the counts that differ.
    lookup = counts.filter(F.size("words") > 0).select("block", "words", "c")

    def block_scores(part: pa.Table, looked: pa.Table) -> pa.Table:
        sub = subwords(path, rules)
        pieces, ids = [], []
        for some in gathered(part.to_batches(), "text"):
            words, counts = words_in(some.column("text").chunk(0))
            found = words.dictionary_encode()
            at = found.indices.to_numpy()
            n = np.bincount(at[np.repeat(learned_from(some), counts)], minlength=len(found.dictionary))
            pieces.append((found.dictionary, n, at, counts))
            ids.append(model.score(*sub.laid_out(at, counts, *sub.spelled(found.dictionary)), sub.start))
        words = pa.concat_arrays([looked.column("words").combine_chunks().flatten(), *(w for w, *_ in pieces)]).dictionary_encode()
        place, sent = words.indices.to_numpy(), looked.column("c").combine_chunks().flatten().to_numpy()
        counted = np.concatenate([np.zeros(len(sent)), *(n for _, n, *_ in pieces)])
        c = np.bincount(place, counted, len(words.dictionary))
        c[place[: len(sent)]] = sent
        places = np.split(place[len(sent) :], np.cumsum([len(w) for w, *_ in pieces]))
        n_tokens, n_known, logs = [], [], []
        for (_, _, at, counts), place in zip(pieces, places):
            of = c[place]
            n_tokens.append(counts + 1)
            n_known.append(summed_by(of[at] > 0, counts) + (texts > 0))
            logs.append(summed_by(np.log10(of + 1.0)[at], counts) + np.log10(texts + 1.0))
        whole = lambda parts, kind: pa.array(np.concatenate([*parts, np.zeros(0)]).astype(kind))
        return pa.table(
            {
                "doc_id": part.column("doc_id"), "held_out": part.column("held_out"),
                "n_tokens": whole(n_tokens, np.int64), "n_known": whole(n_known, np.int64),
                "known_log": whole(logs, np.float64), "score": whole(ids, np.float64),
            }
        )

    scored = rows.groupBy("block").cogroup(lookup.groupBy("block")).applyInArrow(block_scores, SCORED)
    base = F.col("known_log") - F.col("n_tokens") * F.log10(F.lit(float(total + distinct + 1)))
    return scored.select(
        "doc_id", "held_out", "n_tokens", "n_known",
        F.lit(total).cast("long").alias("train_tokens"), base.alias("base_score"), "score",
    )
