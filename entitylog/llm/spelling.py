"""Groups of spelling variants: words one edit apart, by composed automata.

Words are counted over all texts, inside tasks first. Near words are what the
composition accepts of the vocabulary's minimised acceptor, a transducer that
inserts, deletes or replaces one code point, and the acceptor again.

The composition is cut by its initial states. Before the edit both sides read the
same letters and stand in the same state, so a pair that shares a prefix is accepted
from the state after it, where only the acceptor of what follows is needed. Of two
words with at most L letters, one edit apart, the first or the last ``L // 2``
letters are equal. So a word starts in the state after its first letters, and,
reversed, in the state after its last; a pair found in both counts in the first.

A state that more than ``MOST`` words pass is expanded, arc by arc, until none is:
copying the next letter leads to the state behind it, and an edit at this place leads
to a state where both sides have the same rest, which at most as many words share as
there are letters, and one more. So no task holds more than ``MOST`` words, and no
word or link is left out. Pairs are not emitted: of each word the number of its near
words and the best of them leave a state, and are added up by word.

A word's form is its near word of largest count, if that is twice its own at least.
Forms are followed to the last by doubling, as each has a larger count than the one
before.

Null texts hold no word and a null id is the empty text before the colon. Repeated
rows count again. Ties go to the word that is smaller in code-point order.
"""

from __future__ import annotations

import sys
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from entitylog.llm.common import small_batches, spread_join, stored

# Executors get the functions of this module with the job, and need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Letters of a run are A-Z, a-z and U+00C0 to U+00FF; only A-Z is lowered.
LETTERS = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))
#: One occurrence in so many, by checksum, loses a letter.
ONE_IN = 97
LEAST_LETTERS, LEAST_COUNT = 5, 3
#: Different words that a task counts before it passes them on.
HELD = 300_000
#: Words of one initial state.
MOST = 4096


def occurrences(text: str | None, id: int | None) -> Counter:
    """How often each word occurs in a text, letters lost included; words as Latin-1."""
    found = Counter((text or "").encode("latin-1", "replace").translate(LETTERS).split())
    before = zlib.crc32(b"%d:" % id if id is not None else b":")
    lost = []
    for word in found:
        coded = word if word.isascii() else word.decode("latin-1").encode()
        mark = zlib.crc32(coded, before)
        if mark % ONE_IN == 0:
            lost.append((word, mark % len(word)))
    # All at once, as a word without a letter may be one of the others.
    moved = [(word[:at] + word[at + 1 :], found.pop(word)) for word, at in lost]
    for word, n in moved:
        found[word] += n
    return found


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: dict[bytes, int] = {}

    def out() -> pa.RecordBatch:
        words = [w.decode("latin-1") for w in held]
        return pa.RecordBatch.from_pydict({"word": pa.array(words, pa.string()), "n": pa.array(list(held.values()), pa.int64())})

    for batch in batches:
        for id, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
            for word, n in occurrences(text, id).items():
                if len(word) >= LEAST_LETTERS:
                    held[word] = held.get(word, 0) + n
            if len(held) > HELD:
                yield out()
                held.clear()
    if held:
        yield out()


def vocabulary(df: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Words of enough letters with their count ``n`` over all texts, those that occur often enough."""
    small_batches(df.sparkSession)
    rows = df.select(F.col(id).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    counts = rows.mapInArrow(_counted, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    return counts.filter(F.col("n") >= LEAST_COUNT)


class State:
    """A state of a minimised acceptor: arcs by letter to a state and the number of words before it."""

    __slots__ = ("arcs", "final")

    def __init__(self):
        self.arcs: dict[str, tuple[State, int]] = {}
        self.final = False


def acceptor(words: list[str]) -> State:
    """The least acceptor of sorted different words; the numbers along a word's arcs add up to its place."""
    register: dict[tuple, State] = {}
    start = State()
    way: list[tuple[State, str, State]] = []

    def settle(depth: int) -> None:
        # States that get no more arcs are exchanged for an equal one.
        while len(way) > depth:
            above, letter, state = way.pop()
            key = (state.final, tuple((c, id(s), n) for c, (s, n) in state.arcs.items()))
            same = register.setdefault(key, state)
            if same is not state:
                above.arcs[letter] = (same, above.arcs[letter][1])

    before, firsts = "", [0]
    for place, word in enumerate(words):
        shared = 0
        for a, b in zip(before, word):
            if a != b:
                break
            shared += 1
        settle(shared)
        del firsts[shared + 1 :]
        state = way[-1][2] if way else start
        for letter in word[shared:]:
            state.arcs[letter] = (State(), place - firsts[-1])
            way.append((state, letter, state.arcs[letter][0]))
            state = way[-1][2]
            firsts.append(place)
        state.final = True
        before = word
    settle(0)
    return start


def shared_rests(x: State, y: State, i: int, j: int, barred: str = "") -> Iterator[tuple[int, int]]:
    """Places of the words that go on alike from two states, unless with a barred letter."""
    stack = [(x, y, i, j, barred)]
    while stack:
        x, y, i, j, barred = stack.pop()
        if x.final and y.final:
            yield i, j
        few, many, turned = (x.arcs, y.arcs, False) if len(x.arcs) <= len(y.arcs) else (y.arcs, x.arcs, True)
        for letter, (state, n) in few.items():
            other = many.get(letter)
            if other is not None and letter != barred:
                if turned:
                    stack.append((other[0], state, i + other[1], j + n, ""))
                else:
                    stack.append((state, other[0], i + n, j + other[1], ""))


def one_edit(long: State, short: State) -> tuple[Iterator, Iterator]:
    """Accepted pairs: of two long words, and of a long and a short one, as places, each once.

    ``long`` accepts words of one length, ``short`` those of one letter less. The
    composition reads equal letters, then one edit, then equal letters again; the edit
    stands where the words first differ.
    """

    def replaced():
        stack = [(long, 0)]
        while stack:
            state, i = stack.pop()
            arcs = list(state.arcs.values())
            for n, (a, x) in enumerate(arcs):
                stack.append((a, i + x))
                for b, y in arcs[n + 1 :]:
                    yield from shared_rests(a, b, i + x, i + y)

    def deleted():
        stack = [(long, short, 0, 0)]
        while stack:
            x, y, i, j = stack.pop()
            for letter, (state, n) in x.arcs.items():
                yield from shared_rests(state, y, i + n, j, letter)
                other = y.arcs.get(letter)
                if other is not None:
                    stack.append((state, other[0], i + n, j + other[1]))

    return replaced(), deleted()


STATE = ["back", "long", "at", "edited", "key"]


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near words of each initial state, summed up by word; rows of a state stand together, sorted by word."""
    held: list[tuple] = []
    state = None
    for batch in batches:
        out: list[tuple] = []
        columns = [batch.column(c).to_pylist() for c in STATE]
        for now, word, n in zip(zip(*columns), batch.column("word").to_pylist(), batch.column("n").to_pylist()):
            if now != state:
                if len(held) > 1:
                    out += _of_state(state, held)
                state, held = now, []
            held.append((word, n))
        yield _found(out)
    if len(held) > 1:
        yield _found(_of_state(state, held))


FOUND = "word string, near long, n long, best string"


def _found(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * 4
    kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["word", "near", "n", "best"])


def _of_state(state: tuple, rows: list[tuple]) -> list[tuple]:
    back, length, at, edited, _ = state
    longs, shorts = ([r for r in rows if len(r[0]) == n] for n in (length, length - 1))
    if len(longs) + bool(shorts) < 2:
        return []
    if edited:
        # The rest behind the edit is equal in all; the letter at this place is not.
        pairs = [(a, b) for n, a in enumerate(longs) for b in longs[n + 1 :]]
        pairs += [(a, b) for a in longs for b in shorts if a[0][at : at + 1] != b[0][at : at + 1]]
    else:
        x, y = (acceptor([w[at:] for w, _ in side]) for side in (longs, shorts))
        replaced, deleted = one_edit(x, y)
        pairs = [(longs[i], longs[j]) for i, j in replaced]
        pairs += [(longs[i], shorts[j]) for i, j in deleted]
    half = length // 2
    near: dict[str, list] = {}
    for (a, n), (b, m) in pairs:
        if back:
            a, b = a[::-1], b[::-1]
            if a[:half] == b[:half]:
                continue
        for word, other, count in ((a, b, m), (b, a, n)):
            best = near.setdefault(word, [0, 0, ""])
            best[0] += 1
            if count > best[1] or count == best[1] and other < best[2]:
                best[1:] = count, other
    return [(word, *found) for word, found in near.items()]


def near_words(words: DataFrame, most: int = MOST) -> DataFrame:
    """``words`` (stored: ``word`` and ``n``) with ``n_near`` and, null without any, ``best`` and ``best_n``."""
    small_batches(words.sparkSession)
    placed = words.select(
        F.explode(F.array(*(F.struct(F.lit(b).alias("back"), F.lit(more).alias("more")) for b in (False, True) for more in (0, 1)))).alias("p"),
        "word", "n",
    )
    word = F.when(F.col("p.back"), F.reverse("word")).otherwise(F.col("word"))
    placed = placed.select("p.back", (F.length("word") + F.col("p.more")).alias("long"), word.alias("word"), "n")
    placed = placed.withColumns({"at": F.expr("long div 2").cast("int"), "edited": F.lit(False)})
    placed = placed.withColumn("key", F.expr("substring(word, 1, at)")).select(*STATE, "word", "n")
    ready = None
    while True:
        crowded = placed.filter("not edited").groupBy(*STATE).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > most)
        crowded = stored(crowded.select(*STATE, F.lit(True).alias("crowded")), "crowded")
        if crowded.isEmpty():
            ready = placed if ready is None else ready.unionByName(placed)
            break
        marked = stored(spread_join(stored(placed, "states"), crowded, STATE, "left"), "marked")
        rest, hot = marked.filter("crowded is null").drop("crowded"), marked.filter("crowded").drop("crowded")
        ready = rest if ready is None else ready.unionByName(rest)
        left_out = F.expr("concat(substring(word, 1, at), substring(word, at + 2))")
        edits = hot.withColumns(
            {"edited": F.lit(True), "key": F.when(F.length("word") == F.col("long"), left_out).otherwise(F.col("word"))}
        )
        ready = ready.unionByName(edits)
        copied = hot.filter("length(word) > at").withColumn("at", F.expr("at + 1"))
        placed = copied.withColumn("key", F.expr("substring(word, 1, at)"))
    parts = int(words.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = (
        ready.repartition(parts, *STATE).sortWithinPartitions(*STATE, "word").mapInArrow(_near, FOUND)
        .groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("n")).alias("n"), "best")).alias("b"))
        .select("word", "n_near", F.col("b.best").alias("best"), (-F.col("b.n")).alias("best_n"))
    )
    return words.join(found, "word", "left").withColumn("n_near", F.coalesce("n_near", F.lit(0)))


def roots(forms: DataFrame) -> DataFrame:
    """The last form of each word of a stored table of ``word`` and ``form``, none of which leads in a circle."""
    now = forms.select("word", F.col("form").alias("root"))
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = stored(spread_join(now, further, ["root"], "left"), "roots")
        if now.filter("next is not null").isEmpty():
            return now.select("word", "root")
        now = now.select("word", F.coalesce("next", "root").alias("root"))


def variants(df: DataFrame, id: str = "doc_id", text: str = "text", most: int = MOST) -> DataFrame:
    """One row per word: ``word``, ``n``, ``n_near``, ``form`` and ``form_n`` (null without one), ``root`` (the word itself then)."""
    words = near_words(stored(vocabulary(df, id, text), "words"), most)
    better = F.col("best_n") >= 2 * F.col("n")
    words = words.select(
        "word", "n", "n_near", F.when(better, F.col("best")).alias("form"), F.when(better, F.col("best_n")).alias("form_n")
    )
    words = stored(words, "forms")
    last = roots(words.filter("form is not null").select("word", "form"))
    return words.join(last, "word", "left").withColumn("root", F.coalesce("root", "word"))
