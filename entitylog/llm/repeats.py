"""Removal of passages that stand in several places, by suffix intervals.

A byte goes if a string of ``LEAST`` bytes that covers it also starts anywhere
else, in the same text or another. Texts are compared as UTF-8 bytes.

1. Every string of ``LEAST`` bytes is given an anchor, its 64-byte gram with the
   least hash (the first of equals). Strings with one anchor follow each other,
   so a text is a list of anchors, one in about 170 bytes, each with the range of
   starts that it stands for and a hash of the stretch they span. Equal strings
   have equal anchors.
2. Anchors are counted by gram, and by gram and stretch. A stretch that stands
   twice is repeated as a whole; a gram with a single stretch that stands once
   is not. What is left are grams with several stretches.
3. Such a stretch is split by where its strings lie about the anchor, and each
   part gets a core, the bytes that all its strings share: 344 bytes with parts
   of 56 strings. Parts are counted like stretches, by core and by part, so what
   is left are parts of one core, a few bytes apart. Cores with more than
   ``GROUP`` different parts are split again, into parts of 8 and at last of single
   strings, where parts of a core are equal; so no group grows without bound.
4. The others are gathered by core, many cores together, and for each such set a
   suffix array and its Burrows-Wheeler transform are made. Starting from the
   interval of all suffixes, intervals are extended backwards, breadth first: an
   interval met for the first time at depth ``l`` ends where neighbouring
   suffixes share ``l`` bytes, so common prefixes are found by increasing length.
   It stops at ``LEAST``: boundaries not met by then lie between suffixes that
   share as much. Such suffixes are repeated if they stand at different places.

Copies of one text share a key (its MD5) and are handled once. Null texts are
empty; texts shorter than ``LEAST`` lose nothing. Rows of one id are documents
of their own. Output columns replace those of their name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entitylog.llm.common import small_batches, stored

LEAST, GRAM = 400, 64
#: Starts of a text that are hashed at once.
STARTS = 1 << 18
#: Strings about an anchor in one part, level by level, and parts of a core that are compared at once.
STEPS, GROUP = (56, 8, 1), 512
#: Parts whose suffixes are sorted together, on average.
TOGETHER = 2048
#: Bits of a packed value that hold a position.
PLACE = 24

_rng = np.random.default_rng(771_2024)
_BYTE = _rng.integers(0, 1 << 64, 256, np.uint64)
_STEP = int(_rng.integers(0, 1 << 62)) * 2 + 1
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash's step and of its inverse."""
    if n not in _powers:
        inverse = pow(_STEP, -1, 1 << 64)
        tables = []
        for step in (_STEP, inverse):
            steps = np.full(n, step, np.uint64)
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        _powers[n] = tuple(tables)
    return _powers[n]


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return h ^ (h >> np.uint64(29))


def anchors_of(data: bytes, least: int, gram: int) -> tuple[np.ndarray, ...]:
    """Gram hash, stretch hash, first and last start, and place of every anchor of a text."""
    out: list[tuple] = []
    total = len(data) - least + 1
    width = least - gram + 1
    up, down = _power_tables(STARTS + least + 1)
    for begin in range(0, max(total, 0), STARTS):
        starts = min(STARTS, total - begin)
        piece = np.frombuffer(data, np.uint8, starts + least - 1, begin)
        n = len(piece)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE[piece] * up[:n], out=sums[1:])
        grams = _mixed((sums[gram:] - sums[: n - gram + 1]) * down[: n - gram + 1])
        low = grams >> np.uint64(PLACE) << np.uint64(PLACE) | np.arange(len(grams), dtype=np.uint64)
        span = 1
        while 2 * span <= width:
            low = np.minimum(low[span:], low[:-span])
            span *= 2
        if span < width:
            low = np.minimum(low[width - span :], low[: len(low) - width + span])
        at = (low & np.uint64((1 << PLACE) - 1)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        last = np.r_[first[1:], starts] - 1
        stretch = _mixed((sums[last + least] - sums[first]) * down[first])
        out.append((grams[at[first]].view(np.int64), stretch.view(np.int64), first + begin, last + begin, at[first] + begin))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(c) for c in zip(*out))


ANCHOR = "gram long, stretch long, key binary, low int, high int, at int"


def _anchors(least: int, gram: int):
    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, texts = batch.column(0), batch.column(1)
            found = [anchors_of(text.as_buffer().to_pybytes(), least, gram) for text in texts]
            if not found:
                continue
            grams, stretches, *places = (np.concatenate(c) for c in zip(*found))
            key = keys.take(pa.array(np.repeat(np.arange(len(found)), [len(f[0]) for f in found])))
            places = dict(zip(("low", "high", "at"), (p.astype(np.int32) for p in places)))
            yield pa.RecordBatch.from_pydict({"gram": grams, "stretch": stretches, "key": key, **places})

    return anchors


def suffix_array(symbols: np.ndarray, ends: np.ndarray, least: int) -> np.ndarray:
    """Suffixes sorted by at least ``least + 1`` symbols, by prefix doubling.

    ``symbols``: below 256, and at ``ends`` what ends a stretch, which sorts first
    and differs from all others.
    """
    n, m = len(symbols), len(ends)
    letters = np.unique(symbols)
    dense = np.zeros(257, np.int64)
    dense[letters] = np.arange(1, len(letters) + 1)
    codes = dense[symbols]
    codes[ends] = 0
    bits, spare = int(len(letters)).bit_length(), int(m).bit_length()
    length = min((63 - spare) // bits, n)
    left = np.repeat(ends, np.diff(np.r_[-1, ends])) - np.arange(n)
    key = np.zeros(n, np.int64)
    for k in range(length):
        moved = np.zeros(n, np.int64)
        moved[: n - k] = codes[k:]
        moved[left < k] = 0
        key = key << bits | moved
    # What reaches its stretch's end is told apart by the stretch.
    short = left < length
    key = key << spare
    key[short] |= np.repeat(np.arange(m), np.diff(np.r_[-1, ends]))[short]
    while True:
        order = np.argsort(key)
        sorted_ = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.cumsum(np.r_[0, sorted_[1:] != sorted_[:-1]])
        if length > least or rank[order[-1]] == n - 1:
            return order
        key = rank * n
        key[: n - length] += rank[length:]
        length *= 2


def shared(symbols: np.ndarray, ends: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array, and for each of its places a number equal where ``least`` symbols are.

    Intervals are extended backwards through the transform, as steps of the
    suffixes to those one symbol longer.
    """
    n = len(symbols)
    order = suffix_array(symbols, ends, least)
    rank = np.empty(n, np.int64)
    rank[order] = np.arange(n)
    symbols = symbols.copy()
    symbols[ends] = np.arange(256, 256 + len(ends))
    before = order - 1
    before[before < 0] = n - 1
    # The place of the suffix that is one symbol longer, the symbol, and the way back.
    step, symbol = rank[before], symbols[before]
    back = np.empty(n, np.int64)
    back[step] = np.arange(n)
    met = np.zeros(n + 1, bool)
    met[0] = met[n] = True
    interval = np.zeros(n, np.int64)
    low, high = np.array([0]), np.array([n])
    for _ in range(least):
        if not len(low):
            break
        sizes = high - low
        own = np.repeat(np.arange(len(low)), sizes)
        places = np.arange(len(own)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + low[own]
        interval[places] = own
        to = np.sort(step[places])
        origin = back[to]
        own, sign = interval[origin], symbol[origin]
        new = np.r_[True, (to[1:] != to[:-1] + 1) | (own[1:] != own[:-1]) | (sign[1:] != sign[:-1])]
        begin = np.flatnonzero(new)
        lows, highs = to[begin], to[np.r_[begin[1:], len(to)] - 1] + 1
        fresh = ~met[highs]
        met[highs] = True
        low, high = lows[fresh], highs[fresh]
    return order, np.cumsum(met[:n])


def repeated_starts(
    stretches: list[bytes], texts: np.ndarray, lows: np.ndarray, whole: np.ndarray, least: int
) -> list[tuple[int, int, int]]:
    """Runs of repeated starts: index of the stretch, first and last start in its text.

    ``texts``: a number of each stretch's text; ``lows``: the place of its first
    byte; ``whole``: stretches known to stand twice, for which nothing is returned.
    """
    n = len(stretches)
    lengths = np.array([len(s) for s in stretches])
    data = np.frombuffer(b"\0".join([*stretches, b""]), np.uint8).astype(np.int64)
    ends = np.cumsum(lengths + 1) - 1
    order, group = shared(data, ends, least)
    of = np.repeat(np.arange(n), lengths + 1)[order]
    place = order - (ends - lengths)[of]
    # A place in a text; what stands twice as a whole counts as two places.
    where = texts[of] * (1 << 40) + lows[of] + place
    first = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    differs = np.minimum.reduceat(where, first) != np.maximum.reduceat(where, first)
    differs |= np.logical_or.reduceat(whole[of], first) & (np.diff(np.r_[first, len(order)]) > 1)
    hit = np.zeros(len(order), bool)
    hit[order] = np.repeat(differs, np.diff(np.r_[first, len(order)]))
    hit &= ~np.repeat(whole, lengths + 1)
    hit[ends] = False
    edges = np.flatnonzero(np.diff(np.r_[False, hit, False].astype(np.int8))).reshape(-1, 2)
    stretch = np.searchsorted(ends, edges[:, 0])
    offset = edges - (ends - lengths)[stretch][:, None] + lows[stretch][:, None]
    return list(zip(stretch.tolist(), offset[:, 0].tolist(), (offset[:, 1] - 1).tolist()))


PART = "core long, part long, whole boolean, key binary, low int, high int, at int, text binary"
SPAN = "key binary, low int, high int"


def _parts(least: int, step: int):
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Stretches cut by the place of their strings about the anchor, with core and content hashes."""
        digest = xxhash.xxh64_intdigest
        signed = lambda h: h - (1 << 64) if h >> 63 else h
        for batch in batches:
            out = []
            for key, low, high, at, whole, text in zip(*(c.to_pylist() for c in batch.columns)):
                for n in range((at - high) // step, (at - low) // step + 1):
                    first, last = max(low, at - n * step - step + 1), min(high, at - n * step)
                    core = at - n * step - low
                    content = text[first - low : last - low + least]
                    out.append(
                        (
                            signed(digest(text[core : core + least - step], n)), signed(digest(content)),
                            whole, key, first, last, at, content,
                        )
                    )
            if out:
                names = [f.split()[0] for f in PART.split(", ")]
                types = (pa.int64(), pa.int64(), pa.bool_(), pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)

    return parts


def _compare(least: int):
    def compare(part: pa.Table) -> pa.Table:
        keys, lows, whole, texts = (part.column(c).to_pylist() for c in ("key", "low", "whole", "text"))
        numbers = {k: n for n, k in enumerate(dict.fromkeys(keys))}
        runs = repeated_starts(
            texts, np.array([numbers[k] for k in keys]), np.array(lows, np.int64), np.array(whole, bool), least
        )
        stretch, low, high = zip(*runs) if runs else ((), (), ())
        return pa.table(
            {
                "key": pa.array([keys[n] for n in stretch], pa.binary()),
                "low": pa.array(low, pa.int32()),
                "high": pa.array(high, pa.int32()),
            }
        )

    return compare


def repeated_spans(texts: DataFrame, least: int = LEAST, gram: int = GRAM) -> DataFrame:
    """Ranges of repeated starts, one row per ``key`` and range ``low`` to ``high``.

    ``texts``: rows of ``key`` and binary ``text``, equal keys for equal texts.
    """
    small_batches(texts.sparkSession)
    long = texts.filter(F.octet_length("text") >= least)
    anchors = long.mapInArrow(_anchors(least, gram), ANCHOR)
    # Grams first, by themselves: most stand once, and their anchors go no further.
    grams = stored(
        anchors.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram"), "grams"
    )
    anchors = stored(anchors.join(grams, "gram", "left_semi"), "anchors")
    stretches = stored(
        anchors.groupBy("gram", "stretch").agg(
            F.count(F.lit(1)).alias("n"), F.min(F.struct("key", "low", "high", "at")).alias("place")
        ),
        "stretches",
    )
    grams = stretches.groupBy("gram").agg(F.count(F.lit(1)).alias("d")).filter("d > 1")
    twice = stretches.filter("n > 1").select("gram", "stretch")
    found = [anchors.join(twice, ["gram", "stretch"], "left_semi").select("key", "low", "high")]
    left = stretches.join(grams, "gram", "left_semi").select((F.col("n") > 1).alias("whole"), "place.*")
    content = F.expr(f"substring(text, low + 1, high - low + {least})")
    left = left.join(long, "key").select("key", "low", "high", "at", "whole", content.alias("text"))
    # Copies of a text give the same stretch again.
    left = left.groupBy("key", "low", "high", "at", "whole").agg(F.first("text").alias("text"))
    for step in STEPS:
        parts = stored(left.mapInArrow(_parts(least, min(step, least)), PART), "parts")
        each = stored(
            parts.groupBy("core", "part").agg(
                F.sum(F.when(F.col("whole"), 2).otherwise(1)).alias("n"),
                F.min(F.struct("key", "low", "high", "at")).alias("place"),
            ),
            "each",
        )
        twice = each.filter("n > 1").select("core", "part")
        found.append(parts.join(twice, ["core", "part"], "left_semi").select("key", "low", "high"))
        cores = each.groupBy("core").agg(F.count(F.lit(1)).alias("d")).filter("d > 1")
        open_ = each.join(cores, "core").select("core", "part", "d", (F.col("n") > 1).alias("whole"), "place.*")
        place = ["core", "part", "key", "low", "high", "at"]
        open_ = stored(open_.join(parts.select(*place, "text"), place), "open")
        few = open_.filter(F.col("d") <= GROUP)
        sets = max(few.count() // TOGETHER, 1)
        few = few.withColumn("set", F.pmod(F.col("core"), F.lit(sets)))
        found.append(few.groupBy("set").applyInArrow(_compare(least), SPAN))
        left = open_.filter(F.col("d") > GROUP).select("key", "low", "high", "at", "whole", "text")
        if left.isEmpty():
            break
    return reduce(DataFrame.union, found).distinct()


REMOVED = "n_bytes long, n_removed long, n_spans long, kept_bytes binary"
KEPT = "kept string"


def _cut(data: bytes, lows, highs, least: int) -> tuple[int, int, int, bytes]:
    parts, at, removed, spans, end = [], 0, 0, 0, -1
    for low, high in zip(lows, highs):
        to = high + least
        if low > end:
            parts.append(data[at:low])
            removed += to - low
            spans += 1
            end = at = to
        elif to > end:
            removed += to - end
            end = at = to
    parts.append(data[at:])
    return len(data), removed, spans, b"".join(parts)


def without_repeats(df: DataFrame, text: str = "text", least: int = LEAST, gram: int = GRAM, readable: bool = True) -> DataFrame:
    """Every row with what its text keeps.

    Adds ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs),
    ``kept_bytes``, and if ``readable``, ``kept``, the same as text; there, a
    character cut in two is left out.
    """
    spark = df.sparkSession
    small_batches(spark)
    whole = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = df.drop("_key", "_spans").withColumn("_key", F.unhex(F.md5(whole)))
    spans = repeated_spans(rows.select(F.col("_key").alias("key"), whole.alias("text")), least, gram)
    lists = spans.groupBy(F.col("key").alias("_key")).agg(
        F.sort_array(F.collect_list(F.struct("low", "high"))).alias("_spans")
    )

    fields = f"{REMOVED}, {KEPT}" if readable else REMOVED
    names = [f.split()[0] for f in fields.split(", ")]

    def row(data: bytes, lows, highs) -> tuple:
        found = _cut(data, () if lows is None else lows.tolist(), () if highs is None else highs.tolist(), least)
        return (*found, found[-1].decode("utf-8", "ignore")) if readable else found

    @F.pandas_udf(fields)
    def cut(texts: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for data, lows, highs in texts:
            yield pd.DataFrame([row(bytes(t), a, b) for t, a, b in zip(data, lows, highs)], columns=names)

    out = rows.join(lists, "_key", "left")
    # Not to be moved, as a filter on what is kept would cut every text once more, in workers of its own.
    once = cut.asNondeterministic()
    out = out.withColumn("_cut", once(whole, F.col("_spans")["low"], F.col("_spans")["high"]))
    for name in names:
        out = out.withColumn(name, F.col("_cut")[name])
    return out.drop("_key", "_spans", "_cut")
