"""Language-model scores against a plain loop over positions, and word counts of whole texts."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter
from types import SimpleNamespace

import numpy as np
from pyspark.sql import functions as F

from entitylog.llm import lm
from entitylog.llm.queries import VOCABULARY


def plain_score(model, ids, start):
    tables, total = model.tables.value.ready(), 0.0
    size, scale = len(model.query), math.sqrt(model.query.shape[1])
    before = [start] * lm.CONTEXT
    for target in ids.tolist():
        own = before[-1]
        row = int(lm.pair_row(np.array([before[-2]]), np.array([own]))[0])
        kind = int(tables.kinds[row])
        weights, found = [], []
        if kind >= 0:
            weights.append(float(model.query[own] @ model.key[size + kind]) / scale + float(model.bias[0]))
            found.append(float(tables.pairs.get(np.array([row * size + target]))[0]))
        for o in range(lm.CONTEXT):
            past = before[-1 - o]
            if o and past == start:
                continue
            weights.append(float(model.query[own] @ model.key[past]) / scale + float(model.bias[o + 1]))
            found.append(float(tables.values[min(o, lm.TABLES - 1)][past, target]))
        top = max(weights)
        weights = [math.exp(w - top) for w in weights]
        total += math.log10(sum(w * f for w, f in zip(weights, found)) / sum(weights))
        before = before[1:] + [target]
    return total


def documents():
    rng = random.Random(13)
    words = ["The", "the", "of", "station", "Straße", "été", "中文", "x1", "(a)", "hm."]
    made = lambda n: " ".join(rng.choice(words) + rng.choice(["", "", "s", "ed"]) for _ in range(n))
    texts = [None, "", " \t", "one", made(3), made(900)] + [made(rng.randrange(1, 120)) for _ in range(60)]
    return [(n, t) for n, t in enumerate(texts)] + [(6, texts[6]), (None, made(5))]


def test_scores_equal_a_loop_and_counts_are_plain(spark):
    rows = documents()
    out = lambda n: zlib.crc32(("" if n is None else str(n)).encode()) % 7 == 2
    df = spark.createDataFrame([(n, t, out(n), 1, 2) for n, t in rows], "doc_id long, text string, held_out boolean, block int, n int")
    model = lm.train(df.filter(~F.col("held_out")).repartition(2), VOCABULARY)
    got = sorted(lm.scores(df, model, VOCABULARY).collect(), key=str)
    plain = lambda t: [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in re.findall("[^\\x20\\x09-\\x0D]+", t or "")] + [None]
    counts = Counter(w for n, t in rows if not out(n) for w in plain(t))
    total, distinct = sum(counts.values()), len(counts)
    sub = lm.subwords(VOCABULARY, lm.RULES)
    want = []
    for n, t in rows:
        tokens = plain(t)
        base = sum(math.log10((counts[w] + 1) / (total + distinct + 1)) for w in tokens)
        score = plain_score(model, sub.ids(lm.words_of(t)), sub.start)
        want.append((n, out(n), len(tokens), sum(counts[w] > 0 for w in tokens), total, base, score))
    key = lambda r: (str(r[0]), r[2])
    for a, b in zip(sorted(map(tuple, got), key=key), sorted(want, key=key)):
        assert a[:5] == b[:5]
        assert math.isclose(a[5], b[5], rel_tol=1e-9, abs_tol=1e-9) and math.isclose(a[6], b[6], rel_tol=1e-4, abs_tol=1e-4)
    assert len(got) == len(want)


def test_windows_hold_every_id_once_with_its_context():
    for n in (1, 63, 64, 65, 200):
        ids = np.arange(n)
        rows = lm.windows_of(ids, lm.SPAN, -1)
        assert rows.shape == (-(-n // lm.SPAN), lm.CONTEXT + lm.SPAN)
        assert [i for r in rows for i in r[lm.CONTEXT :] if i >= 0] == ids.tolist()
        for r in rows[1:]:
            assert r[: lm.CONTEXT].tolist() == list(range(r[lm.CONTEXT] - lm.CONTEXT, r[lm.CONTEXT]))


def test_a_step_equals_a_loop_and_adds_up_the_pulls_of_a_place_first(monkeypatch):
    rng = np.random.default_rng(5)
    size, windows = 40, 6
    cells = rng.choice(lm.TABLES * size * size, 900, replace=False)
    x = np.full((windows, lm.CONTEXT + lm.SPAN), size - 1, np.int64)
    x[:, lm.CONTEXT :] = rng.integers(0, size - 1, (windows, lm.SPAN))
    x[-1, -9:] = size - 1
    pairs = np.unique(lm.pair_row(x[:, :-2].ravel(), x[:, 1:-1].ravel()) * size + x[:, 2:].ravel())
    cells = np.r_[cells, pairs + lm.TABLES * size * size]
    tables = lm.Tables(cells, rng.integers(2, 9, len(cells)).astype(np.float32), size)
    query, key = (rng.normal(0, 0.3, (n, lm.WIDTH)).astype(np.float32) for n in (size, size + lm.KINDS))
    model = lm.Model(SimpleNamespace(value=tables), query, key, np.zeros(lm.CONTEXT + 1, np.float32))
    weights, found, (seen, _, _) = model.attend(x, size - 1, counted=True)
    pulls = np.zeros(query.shape), np.zeros(key.shape)
    for w in range(windows):
        for p in range(lm.SPAN):
            if x[w, lm.CONTEXT + p] == size - 1:
                continue
            a, f, own = weights[:, w, p].astype(float), found[:, w, p].astype(float), x[w, lm.CONTEXT + p - 1]
            blame = (a - a * f / (a @ f)) / (windows * lm.SPAN) / np.sqrt(lm.WIDTH)
            for o, g in enumerate(blame):
                pulls[0][own] += g * key[seen[o][w, p]]
                pulls[1][seen[o][w, p]] += g * query[own]
    rows = []
    monkeypatch.setattr(lm, "summed", lambda at, part, n, of=lm.summed: rows.append((len(at), of(at, part, n))) or rows[-1][1])
    model.learn(x, size - 1)
    assert [n for n, _ in rows] == [windows * lm.SPAN, (lm.CONTEXT + 1) * windows * lm.SPAN]
    for (_, got), want in zip(rows, pulls):
        assert abs(want).max() > 1e-4 and np.allclose(got, want, rtol=1e-3, atol=1e-7)
