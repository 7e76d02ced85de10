"""Near vectors where ids repeat, over labels and over more than one block of a bucket."""

from __future__ import annotations

from collections import Counter

import numpy as np

from entitylog.llm import embed, simhash


def plain(rows):
    """Links and smallest id reached of each row, in order."""
    x = np.array([r[1] for r in rows], np.float32).astype(float)
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    near = (u @ u.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    root = simhash.forest(len(rows), *np.nonzero(near))
    ids = np.array([r[0] for r in rows])
    least = np.full(len(rows), 1 << 60)
    np.minimum.at(least, root, ids)
    return [(int(i), int(n), int(c)) for i, n, c in zip(ids, near.sum(axis=1), least[root])]


def test_ids_that_repeat_over_labels(spark):
    rng = np.random.default_rng(1)
    u, w = rng.standard_normal((2, 16))
    about = lambda v: v + rng.normal(0, 0.02, 16)
    rows = [(1, u, "a"), (5, about(u), "a"), (1, u, "b"), (9, w, "b"), (2, about(u), "a"), (1, w, "b"), (3, about(w), "b"), (3, u, "c")]
    rows += [(n % 7, v, "abc"[n % 3]) for n, v in enumerate(rng.standard_normal((60, 16)))]
    rows += [(30, rows[20][1], rows[20][2])] * 3
    rows = [(i, np.asarray(v, np.float32).tolist(), k) for i, v, k in rows]
    df = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "vec_id long, embedding array<float>, label string, n int, at int, code string")
    got = Counter((r.id, r.n_links, r.component) for r in embed.near_vectors(df.repartition(3)).collect())
    assert got == Counter(plain(rows))
    assert embed.near_vectors(df.limit(0)).collect() == []


def test_buckets_of_more_than_one_block(spark):
    rng = np.random.default_rng(2)
    seeds = rng.standard_normal((2, 24))
    rows = [(int(n % 300), (seeds[n % 2] + rng.normal(0, 0.06, 24)).astype(np.float32).tolist(), n % 3) for n in range(1500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(5)
    # One wide bucket: all entries of a label meet.
    got = Counter((r.id, r.n_links, r.component) for r in embed.near_vectors(df, width=1e6, bits=1, tables=1).collect())
    assert got == Counter(plain(rows))


def test_tables_follow_the_number_of_vectors():
    sizes = [embed.sized(n) for n in (0, 10, 60_000, 240_000, 10**9)]
    assert sizes[0] == sizes[1] == sizes[2] and sizes[3][0] == sizes[2][0] + 1
    rng = np.random.default_rng(3)
    for bits, tables in sizes[2:]:
        x = rng.standard_normal((1500, 32))
        x /= np.linalg.norm(x, axis=1, keepdims=True)
        t = rng.standard_normal(x.shape)
        t -= (t * x).sum(axis=1, keepdims=True) * x
        t /= np.linalg.norm(t, axis=1, keepdims=True)
        y = 0.98 * x + np.sqrt(1 - 0.98**2) * t
        hit = np.zeros(len(x), bool)
        for _ in range(tables):
            d, shift = rng.standard_normal((32, bits)), rng.uniform(0, 1, bits)
            hit |= (np.floor(x @ d + shift) == np.floor(y @ d + shift)).all(axis=1)
        assert hit.mean() > 0.99
