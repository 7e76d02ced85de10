"""Language decoding against a plain one, on texts whose languages share most of their words."""

from __future__ import annotations

import math
import random
from collections import Counter

from entitylog.llm import langid


def rows_of():
    rng = random.Random(23)
    own = {"aa": ["kra", "moto", "zel"], "bb": ["kro", "mota", "zil"], "cc": ["été", "naïf", "zul"], "dd": ["ωρα", "νυν"]}
    shared = ["ta", "tan", "lor", "per", "sol"]
    made = lambda name, n: " ".join(rng.choice(shared * 3 + own[name]) for _ in range(n))
    rows = [(n, made(name, rng.randrange(3, 60)), name) for n, name in enumerate("aa bb cc dd".split() * 12)]
    mixed = [f"{made('aa', 8)} {made('bb', 8)}" for _ in range(12)] + [made("aa", 1), "ta tan", "x", "ta " * 9000]
    rows += [(100 + n, t, None) for n, t in enumerate(mixed)]
    return rows + [(None, None, "aa"), (200, "", "bb"), (201, "12 --", None), rows[0], rows[0]]


def plain(rows):
    cells = langid.CELLS
    counts: dict[str, Counter] = {}
    for _, text, name in rows:
        if name and text and any(c.isalpha() for c in text):
            counts.setdefault(name, Counter()).update(langid.grams(text).tolist())
    names = sorted(counts)
    totals = {x: sum(counts[x].values()) + 0.5 * cells for x in names}
    rate = {x: [0.5 / totals[x]] * cells for x in names}
    for x in names:
        for cell, n in counts[x].items():
            rate[x][cell] = (n + 0.5) / totals[x]
    order = max(8, 1 << len(names).bit_length())
    word = {x: [-1 if bin(i & j).count("1") % 2 else 1 for j in range(order)] for i, x in enumerate(names, 1)}
    bits = [j for j in range(order) if len({word[x][j] for x in names}) > 1]
    ratio = {}
    for j in bits:
        ones, others = ([x for x in names if word[x][j] == s] for s in (1, -1))
        ratio[j] = [
            math.log(sum(rate[x][c] for x in ones) / len(ones)) - math.log(sum(rate[x][c] for x in others) / len(others))
            for c in range(cells)
        ]
    hoped = {x: {j: max(word[x][j] * sum(r * g for r, g in zip(rate[x], ratio[j])), 1e-6) for j in bits} for x in names}
    out = []
    for n, text, _ in rows:
        if not text or not any(c.isalpha() for c in text):
            out.append((n, "und", 0.0, True))
            continue
        found = langid.grams(text).tolist()
        margin = {j: sum(ratio[j][c] for c in found) / len(found) for j in bits}
        unit = {j: sum(hoped[x][j] for x in names) / len(names) for j in bits}
        loss = {
            x: sum(
                hoped[x][j] / sum(hoped[x].values()) * math.exp(-max(-30, min(30, word[x][j] * margin[j] / unit[j])))
                for j in bits
            )
            for x in names
        }
        best = min(names, key=lambda x: (loss[x], x))
        second = sorted(loss.values())[1]
        out.append((n, best, 1 / sum(math.exp(loss[best] - v) for v in loss.values()), second - loss[best] < langid.NEAR * second))
    return out


def test_decoding_equals_a_plain_one(spark):
    rows = rows_of()
    df = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "doc_id long, text string, lang string, lang_pred string, score double")
    got = langid.identify(df.repartition(3), langid.learn(df)).collect()
    key = lambda r: (str(r[0]), r[1])
    got = sorted(((r.doc_id, r.lang_pred, r.score, r.ambiguous) for r in got), key=key)
    want = sorted(plain(rows), key=key)
    assert [(a[0], a[1], a[3]) for a in got] == [(a[0], a[1], a[3]) for a in want]
    assert all(math.isclose(a[2], b[2], rel_tol=1e-4) for a, b in zip(got, want))
    assert any(a[3] and a[1] != "und" for a in want), "an ambiguous text"
