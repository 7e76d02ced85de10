"""Many texts at once against one at a time: words, spelling, windows, table look-ups."""

from __future__ import annotations

import random
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from entitylog.llm import lm
from entitylog.llm.queries import VOCABULARY

TEXTS = [
    None, "", " \t", "one", "  The the\x0bof\x0cstation \r\nend ", "a\x1cb\x85c é É  x", "Straße ÉTÉ 中文 \U0001f600",
    "aaaa aaaaa ababab", "x" * 700, "中" * 300 + " of", "the " * 500,
]


def words():
    rng = random.Random(3)
    found = [bytes(rng.choice(b"aabhteing\xc3\xa9") for _ in range(rng.randrange(1, 90))) for _ in range(1500)]
    found += [bytes(rng.randrange(256) for _ in range(rng.randrange(1, 70))) for _ in range(500)]
    found += [b"a" * n for n in range(1, 70)] + [bytes([b]) for b in range(256)]
    found += [w for t in TEXTS for w in lm.words_of(t)]
    return list(dict.fromkeys(found))


def test_words_spelled_beside_each_other_are_what_the_automaton_accepts(monkeypatch):
    sub, made, alone = lm.subwords(VOCABULARY, lm.RULES), words(), []
    want = [[sub.dense[t] for t in sub.vocab.spell(w)] for w in made]
    monkeypatch.setattr(sub.vocab, "spell", lambda w, of=sub.vocab.spell: alone.append(w) or of(w))
    for beside in (lm.BESIDE, 7):
        monkeypatch.setattr(lm, "BESIDE", beside)
        for part in (pa.array(made, pa.binary()), pa.array([b"first", *made], pa.binary())[1:]):
            ids, first, size = sub.spelled(part)
            assert [ids[a : a + n].tolist() for a, n in zip(first, size)] == want
    # Only long words are walked one at a time, however many others there are.
    assert set(alone) == {w for w in made if len(w) > lm.LONG} and len(alone) < len(made)
    assert [len(x) for x in sub.spelled(pa.array([], pa.binary()))] == [0, 0, 0]


def test_texts_laid_out_are_each_text_by_itself():
    sub = lm.subwords(VOCABULARY, lm.RULES)
    for texts in (TEXTS, [None], ["", "a b", ""], []):
        flat, first, lengths = sub.of_texts(pa.array(texts, pa.string()))
        assert [lengths.tolist(), len(first)] == [[len(sub.ids(lm.words_of(t))) for t in texts], len(texts)]
        spelled = [[sub.dense[i] for w in lm.words_of(t) for i in sub.vocab.spell(w)] + [sub.end] for t in texts]
        for a, n, want in zip(first, lengths, spelled):
            assert flat[a : a + lm.CONTEXT + n].tolist() == [sub.start] * lm.CONTEXT + want
        for span in (5, lm.SPAN):
            x, counts = lm.all_windows(flat, first, lengths, span, sub.start)
            want = [lm.windows_of(np.array(ids), span, sub.start) for ids in spelled]
            assert counts.tolist() == [len(w) for w in want]
            assert x.tolist() == [r for w in want for r in w.tolist()]


def test_words_of_many_texts_and_their_sums():
    found, counts = lm.words_in(pa.array(["first", *TEXTS], pa.string())[1:])
    ends = np.cumsum(counts)
    assert [found[a:b].to_pylist() for a, b in zip(ends - counts, ends)] == [lm.words_of(t) for t in TEXTS]
    assert lm.summed_by(np.arange(5.0), np.array([0, 2, 0, 3, 0])).tolist() == [0, 1, 0, 9, 0]
    pieces = [Counter(lm.words_of(t)) for t in TEXTS if t]
    given, n = lm.added_up([pa.array(list(p), pa.binary()) for p in pieces], [np.array(list(p.values()), np.int64) for p in pieces])
    assert dict(zip(given.to_pylist(), n.tolist())) == dict(sum(pieces, Counter()))
    made = words()
    at = lm.buckets_of(pa.array(made, pa.binary()), 8)
    assert at.tolist() == [int(lm.buckets_of(pa.array([w], pa.binary()), 8)[0]) for w in made]
    assert min(Counter(at.tolist())[k] for k in range(8)) > len(made) / 16
    # Later bytes of long words count too.
    assert len(set(lm.buckets_of(pa.array([b"x" * 9000 + b"%d" % n for n in range(50)], pa.binary()), 1000).tolist())) > 40


def test_rows_are_put_together_up_to_a_bound_and_all_stay(monkeypatch):
    monkeypatch.setattr(lm, "AT_ONCE", 1000)
    rows = [(n, t) for n, t in enumerate(TEXTS * 3)]
    batches = [
        pa.RecordBatch.from_pydict({"n": pa.array([n for n, _ in part], pa.int64()), "text": pa.array([t for _, t in part], pa.string())})
        for part in (rows[:4], [], rows[4:20], rows[20:])
    ]
    tables = list(lm.gathered(batches, "text"))
    assert [(r["n"], r["text"]) for t in tables for r in t.to_pylist()] == rows
    sizes = [sum(len((r["text"] or "").encode()) for r in t.to_pylist()) for t in tables]
    assert all(s <= 1000 or sum(bool(r["text"]) for r in t.to_pylist()) == 1 for s, t in zip(sizes, tables))
    assert len(tables) < len(rows) / 2 and list(lm.gathered(batches[1:2], "text")) == []


def test_numbers_by_key_are_found_and_others_are_none():
    rng = np.random.default_rng(2)
    keys = np.r_[rng.choice(1 << 20, 5000, replace=False), lm.PAIRS * 1538 - 1]
    values = rng.random(len(keys)).astype(np.float32)
    table, known = lm.Sparse(keys, values), dict(zip(keys.tolist(), values.tolist()))
    asked = np.r_[keys, rng.integers(0, 1 << 20, 5001)].reshape(2, -1)
    assert table.get(asked).tolist() == [[known.get(k, 0.0) for k in row] for row in asked.tolist()]
    assert lm.Sparse(keys[:0], values[:0]).get(asked[:, :3]).tolist() == [[0.0] * 3] * 2


def test_cells_of_all_tasks_are_added_up_by_bucket(monkeypatch):
    texts = [t for t in TEXTS for _ in range(2)] + ["the station of the station"] * 3
    tasks = [pa.RecordBatch.from_pydict({"text": pa.array(part, pa.string())}) for part in (texts[:9], texts[9:])]
    sub, want = lm.subwords(VOCABULARY, lm.RULES), Counter()
    for t in texts:
        ids = [sub.start] * lm.CONTEXT + [sub.dense[i] for w in lm.words_of(t) for i in sub.vocab.spell(w)] + [sub.end]
        for k in range(lm.CONTEXT, len(ids)):
            row = int(lm.pair_row(np.array([ids[k - 2]]), np.array([ids[k - 1]]))[0])
            want[(lm.TABLES * sub.size + row) * sub.size + ids[k]] += 1
            for o in range(lm.CONTEXT):
                if not o or ids[k - 1 - o] != sub.start:
                    want[(min(o, lm.TABLES - 1) * sub.size + ids[k - 1 - o]) * sub.size + ids[k]] += 1
    for at_once in (lm.AT_ONCE, 300):
        monkeypatch.setattr(lm, "AT_ONCE", at_once)
        sent = pa.Table.from_batches([b for t in tasks for b in lm._pairs(VOCABULARY, lm.RULES, 5)(iter([t]))])
        got = {}
        for bucket in range(5):
            part = lm._bucket_cells(sent.filter(pa.array([b == bucket for b in sent.column("bucket").to_pylist()])))
            new = dict(zip(*(part.column(name).to_pylist() for name in ("cell", "n"))))
            assert len(new) == len(part) and not got.keys() & new.keys()
            got |= new
        assert got == want


def test_blocks_and_tasks_make_no_difference(spark):
    rng = random.Random(8)
    rows = [(n, " ".join(rng.choice("ab cd ef gh Ij kl mn".split()) + rng.choice(["", "s", str(n)]) for _ in range(n % 9)), n % 5 == 2) for n in range(90)]
    rows += [(None, "ab ab", False), (3, None, False), (None, None, True)]
    df = spark.createDataFrame(rows, "doc_id long, text string, held_out boolean")
    model = lm.train(df.filter("not held_out"), VOCABULARY)
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[2], r[6])
    one, many, own = (
        sorted((tuple(r) for r in lm.scores(df.repartition(parts), model, VOCABULARY, block=F.expr(block)).collect()), key=key)
        for parts, block in ((1, "1"), (4, "if(doc_id % 7 = 1, null, doc_id % 4)"), (2, "doc_id"))
    )
    assert len(one) == len(rows) and one[-1][4] > 200
    for a, b in [*zip(one, many), *zip(one, own)]:
        assert a[:5] == b[:5] and np.allclose(a[5:], b[5:], rtol=1e-9, atol=1e-9)
