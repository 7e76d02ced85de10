"""Text operators against plain versions, and on awkward tables."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from entitylog.llm import bpe, embed, langid, licenses, lm, mix, quality, repeats, shards, simhash
from entitylog.llm.common import components
from entitylog.llm.queries import VOCABULARY

AWKWARD = "doc_id long, text string, lang string, source string, n_chars long, size long, low int, block int, at int"


def texts() -> list:
    rng = random.Random(5)
    words = ["the", "of", "ering", "tion", "and", "Ha", "une", "été", "straße", "x"]
    prose = lambda n: " ".join(rng.choice(words) + str(rng.randrange(50)) for _ in range(n))
    passage = prose(120)
    out = [None, "", " \t\n", "one", "a b c", "é" * 900, "ab" * 600, "word " * 300, prose(6000)]
    out += [prose(80) for _ in range(12)] + [f"{prose(30)}\n{passage}\n{prose(30)}" for _ in range(4)]
    out += [out[-1]] * 3 + ["Licensed under CC BY-NC 4.0.\n" + prose(40), "<|endoftext|> 's  İΣ 中文 12!!"]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        (n, t, [None, "en", "fr"][n % 3], [None, "a", "a", "b"][n % 4], n, 7, 1, 2, 3) for n, t in enumerate(texts())
    ]
    rows += [rows[9], rows[9], (None, "no id at all " * 12, None, None, None, 0, 0, 0, 0)]
    return spark.createDataFrame(rows, AWKWARD)


def plain_words(text):
    return re.findall("[^\\x20\\x09-\\x0D]+", text or "")


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(1)
    edges = [(n, n + 1) for n in range(100, 140)] + [(7, n) for n in range(10, 60)] + [(3, 3), (200, 201), (201, 200)]
    rng.shuffle(edges)
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {n: 100 for n in range(101, 141)} | {n: 7 for n in range(10, 60)} | {201: 200}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_bpe_equals_the_library_and_decodes(docs):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(VOCABULARY)
    for row in bpe.decode(bpe.encode(docs, VOCABULARY), VOCABULARY).collect():
        ids = library.encode(row.text or "", add_special_tokens=False).ids
        assert row.ids == ids and row.decoded == library.decode(ids, skip_special_tokens=False)


def test_licences_are_found_and_inherited(spark):
    line = "This work is licensed under the GNU General Public License, version 3."
    rows = [
        ("a/LICENSE", line, True), ("a/b/x.py", "nothing here", False), ("a/b/c/y.py", None, False),
        ("a/b/LICENSE", "Released under the MIT License.\nmore", True), ("z/q.py", "", False),
        ("z/r.py", "text\nLicensed under the Apache License, Version 2.0.", False), (None, "the of", False),
    ]
    df = spark.createDataFrame(rows, "path string, text string, is_file boolean")
    found = licenses.inherit(licenses.scan(df, licenses.matcher(df)))
    got = {r.path: (r.effective, r.basis, r.from_dir) for r in found.collect()}
    assert got == {
        "a/LICENSE": ("GPL-3.0", "header", None), "a/b/x.py": ("MIT", "inherited", "a/b"),
        "a/b/c/y.py": ("MIT", "inherited", "a/b"), "a/b/LICENSE": ("MIT", "header", None),
        "z/q.py": (None, None, None), "z/r.py": ("Apache-2.0", "header", None), None: (None, None, None),
    }


def test_licence_lines_are_weighed_with_all_words_counted(spark):
    line = "Released under the MIT License for all"
    rows = [(n, "for all of us the day is under way" + (" x" if n % 2 else "")) for n in range(1000)]
    rows += [(5000, line), (5001, "q\n" + line), (None, line), (5002, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = licenses.scan(df, licenses.matcher(df)).filter("license is not null").collect()
    n, seen = len(rows), Counter(w for _, t in rows for w in set(licenses.words_of(t or "")))
    weigh = lambda t: {w: (1 + math.log(k)) * (1 + math.log((n + 1) / (seen[w] + 1))) for w, k in Counter(licenses.words_of(t)).items()}
    norm = lambda v: math.sqrt(sum(x * x for x in v.values()))
    a, b = weigh(line), weigh("Released under the MIT License")
    cosine = sum(x * b.get(w, 0) for w, x in a.items()) / norm(a) / norm(b)
    assert {(r.doc_id, r.license, r.line) for r in got} == {(5000, "MIT", 0), (5001, "MIT", 1), (None, "MIT", 0)}
    assert cosine > 0.9 and all(math.isclose(r.cosine, cosine, rel_tol=1e-9) for r in got)


def test_simhash_groups_equal_all_pairs(docs):
    def plain(text):
        words = plain_words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        each = [" ".join(words[n : n + 4]) for n in range(max(len(words) - 3, 1))] if words else []
        hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in each]
        return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))

    rows = {r.id: r for r in simhash.near_groups(docs).collect() if r.id is not None}
    prints = {r.doc_id: plain(r.text) for r in docs.collect() if r.doc_id is not None}
    group = {n: n for n in prints}
    for _ in prints:
        for a in prints:
            group[a] = min(group[b] for b in prints if (prints[a] ^ prints[b]).bit_count() <= 4)
    assert {n: (r.fingerprint[0] % (1 << 64), r.component) for n, r in rows.items()} == {
        n: (prints[n], group[n]) for n in prints
    }


def test_simhash_index_loses_no_link_in_crowded_nodes(spark):
    rng = random.Random(3)
    seeds = [rng.getrandbits(64) for _ in range(3)]
    codes = {s ^ sum(1 << rng.randrange(64) for _ in range(rng.randrange(6))) for s in seeds for _ in range(400)}
    codes = sorted(c % (1 << 64) for c in codes)
    signed = [c - (1 << 64) if c >> 63 else c for c in codes]
    df = spark.createDataFrame([([c], n) for n, c in enumerate(signed)], "code array<long>, id long")
    bits = np.array(codes, np.uint64)
    root = simhash.forest(len(bits), *np.nonzero(np.bitwise_count(bits[:, None] ^ bits[None, :]) <= 4))
    for law in (simhash.EXACT, *simhash.FINER):
        got = dict(components(simhash.links(df, law)).collect())
        assert {n: got.get(n, n) for n in range(len(bits))} == dict(enumerate(root.tolist()))


def test_the_exact_law_follows_the_number_of_fingerprints():
    laws = [simhash.exact_law(n) for n in (0, 2 * 10**6, 10**7, 10**9, 10**13)]
    assert [x.agree for x in laws] == [1, 1, 2, 3, 3]
    for law in laws:
        # Any four bits that differ leave enough parts alike.
        assert len(law.parts) - law.most >= law.agree and sum(law.parts) == 64
        assert all(sorted(order) == list(range(len(law.parts))) for _, order in law.orders())


def test_blocks_of_equal_rank_meet(spark):
    # Far more entries than a block holds, all with one first word.
    df = spark.createDataFrame([([5, n], n) for n in range(1600)], "code array<long>, id long").repartition(3)
    blocks, meet = simhash.meetings(df, simhash.Law(4, 2, 128, (64,)))
    held = [r.block for r in blocks.filter("part = 0").collect()]
    assert len(held) > 3
    assert {(r.x, r.y) for r in meet.collect()} >= {(a, b) for a in held for b in held if a < b}


def test_similar_texts_are_near_and_others_not(spark):
    rng = random.Random(9)
    base = [f"w{rng.randrange(5000)}" for _ in range(400)]
    rows = [(n, " ".join(w if n == 0 or rng.random() > 0.01 else "other" for w in base)) for n in range(20)]
    rows += [(100 + n, " ".join(f"v{rng.randrange(5000)}" for _ in range(400))) for n in range(20)]
    found = simhash.near_groups(spark.createDataFrame(rows, "doc_id long, text string"), law=simhash.SIMILAR)
    assert all(r.component == (0 if r.id < 100 else r.id) for r in found.collect())


def test_similar_groups_equal_checked_pairs(spark):
    rng = random.Random(12)
    fresh = lambda n: [f"w{rng.randrange(100000)}" for _ in range(n)]
    rows, made = [], []
    for _ in range(12):
        base = fresh(300)
        # Shares of 1, 0.9, 0.75, 0.6 and 0.5 with the base.
        for tail in (0, 16, 43, 75, 100):
            made.append(base[: 300 - tail] + fresh(tail))
    hot = " ".join(f"h{n}" for n in range(6))
    made += [(" ".join([hot] * 200) + " " + " ".join(fresh(60))).split() for _ in range(3)]
    made += [[], [], ["a"], ["a"], ["a", "b"], made[0], made[1]]
    rows = [(n, " ".join(w)) for n, w in enumerate(made)] + [(0, " ".join(made[0]))] * 50 + [(None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    sets = [{" ".join(w[k : k + 5]) for k in range(max(len(w) - 4, min(len(w), 1)))} for w in made]
    near = [
        (a, b)
        for a in range(len(sets))
        for b in range(a)
        if sets[a] == sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    ]
    root = simhash.forest(len(sets), np.array([a for a, _ in near]), np.array([b for _, b in near]))
    found = simhash.near_groups(df, law=simhash.SIMILAR).collect()
    assert len(found) == len(rows)
    assert {r.id: r.component for r in found if r.id is not None} == dict(enumerate(root.tolist()))


def test_similar_pairs_are_candidates():
    rng, law = np.random.default_rng(1), simhash.SIMILAR
    starts = np.r_[0, np.cumsum(law.parts)]
    lost = 0
    for _ in range(1500):
        # 90 shingles each, 80 in common: 0.8.
        h = rng.integers(0, 1 << 64, 100, dtype=np.uint64)
        differ = simhash.fingerprint_of(h[:90], law.width) ^ simhash.fingerprint_of(h[10:], law.width)
        bits = np.unpackbits(differ.astype(">i8").view(np.uint8)).reshape(law.width, 64)
        agree = not all(row[a:b].any() for row in bits for a, b in zip(starts, starts[1:]))
        lost += bits.sum() > law.most or not agree
    assert lost <= 6


def test_similar_pairs_in_a_crowd_just_below_are_checked(spark):
    rng = random.Random(4)
    fresh = lambda n: [f"w{rng.randrange(10**6)}" for _ in range(n)]
    shared = fresh(270)
    made = [shared + fresh(34) for _ in range(120)]
    # A few share more with one of the crowd than the crowd does among itself.
    for n in range(0, 24, 2):
        made[n + 1] = made[n][:274] + fresh(30)
    sets = [{" ".join(w[k : k + 5]) for k in range(len(w) - 4)} for w in made]
    share = np.array([[len(a & b) / len(a | b) for b in sets] for a in sets])
    assert 0.77 < np.median(share) < 0.8 and ((share >= 0.8) & (share < 1)).any()
    root = simhash.forest(len(sets), *np.nonzero(share >= 0.8))
    prints = [simhash.fingerprint_of(np.unique(np.array(simhash.shingle_hashes(" ".join(w), 5), np.uint64)), 4) for w in made]
    codes = spark.createDataFrame([(c.tolist(), n) for n, c in enumerate(prints)], "code array<long>, id long")
    found = spark.createDataFrame(
        [(n, n, [hash_of(s) for s in t]) for n, t in enumerate(sets)], "id long, digest long, shingles array<int>"
    )
    # Every pair is close enough to be a candidate, so nothing but the check decides.
    law = simhash.Law(5, 4, 256, (1, 63), 0.8)
    got = dict(simhash.checked_groups(codes, found, law).collect())
    assert {n: got.get(n, n) for n in range(len(sets))} == dict(enumerate(root.tolist()))


def test_tries_have_one_schema():
    codes = np.zeros((3, 4), np.uint64).tobytes()
    ids = lambda n: np.arange(n, n + 3).tobytes()
    none = dict.fromkeys(("labels", "labels2", "tried"))
    rows = [
        {"x": 0, "y": None, "codes": codes, "ids": ids(0), "codes2": None, "ids2": None} | none,
        {"x": 0, "y": 1, "codes": codes, "ids": ids(0), "codes2": codes, "ids2": ids(3)} | none,
    ]
    batches = [pa.RecordBatch.from_pylist([r]) for r in rows]
    got = list(simhash._tries(simhash.SIMILAR, 1)(iter(batches)))
    assert len(got) == 2 and got[0].schema == got[1].schema


def hash_of(shingle):
    return int(np.uint64(xxhash.xxh64_intdigest(shingle.encode(), 42)).astype(np.uint32).view(np.int32))


def test_vectors_equal_all_pairs(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((40, 16)).astype(np.float32)
    x = np.concatenate([x, x[:10] + rng.normal(0, 0.02, (10, 16)), x[:5], 3 * x[:3]]).astype(np.float32)
    label = [n % 2 for n in range(40)] + [n % 2 for n in range(10)] + [n % 2 for n in range(5)] + [1, 1, 1]
    rows = [(n, v.tolist(), k) for n, (v, k) in enumerate(zip(x, label))]
    odd = [None, [0.0] * 16, [float("nan")] + [1.0] * 15, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, []]
    rows += [(100 + n, v, 1) for n, v in enumerate(odd)] + [(200, x[0].tolist(), None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    near = (u @ u.T >= 0.98) & (np.array(label)[:, None] == np.array(label)[None, :])
    np.fill_diagonal(near, False)
    root = simhash.forest(len(x), *np.nonzero(near))
    want = {n: (int(near[n].sum()), int(root[n])) for n in range(len(x))}
    want |= {r[0]: (0, r[0]) for r in rows[len(x) :]}
    assert {r.id: (r.n_links, r.component) for r in embed.near_vectors(df).collect()} == want


def test_mix_meets_targets_and_repeats_within_bounds(spark):
    rng = random.Random(2)
    rows = [(n, "w " * rng.randrange(400), rng.choice("aaaaab") if n % 9 else None) for n in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mix.taken(df).collect()
    assert sorted(r.doc_id for r in got) == list(range(900))
    source = {r[0]: r[2] for r in rows}
    by = defaultdict(list)
    for r in got:
        by[source[r.doc_id]].append(r)
        assert 0 <= r.taken <= 3 * r["size"]
    total = sum(r["size"] for r in got)
    assert math.isclose(sum(rs[0].target for rs in by.values()), total)
    for rs in by.values():
        assert rs[0].target <= 3 * rs[0].source_size + 1e-6
        assert abs(sum(r.taken for r in rs) - rs[0].target) <= 0.02 * rs[0].target
    assert sorted(map(tuple, got)) == sorted(map(tuple, mix.taken(df).collect()))


def test_language_is_learned_from_given_rows_only(docs, spark):
    rng = random.Random(6)
    sets = {"aa": ["tion", "the", "ing"], "bb": ["eau", "él", "que"], "cc": ["sch", "ung", "ß"]}
    rows = [
        (n, " ".join("".join(rng.choices(sets[k], k=2)) for _ in range(30)), k)
        for n, k in enumerate(rng.choices(list(sets), k=150))
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    held = langid.remainder("doc_id", 3) == 1
    model = langid.learn(df.filter(~held))
    got = langid.identify(df.withColumn("held", held), model).collect()
    assert all(r.lang_pred == r.lang and 0 <= r.score <= 1 for r in got)
    assert all(r.held == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in got)
    for r in langid.identify(docs, model).collect():
        letters = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred in sets) == letters and (letters or r.score == 0)
    nothing = langid.learn(df.limit(0))
    assert {r.lang_pred for r in langid.identify(df, nothing).collect()} == {"und"}


def test_scores_count_words_exactly_and_sum_to_one(docs):
    rows = docs.withColumn("held_out", langid.remainder("doc_id", 7) == 2)
    model = lm.train(rows.filter(~F.col("held_out")), VOCABULARY)
    known: Counter = Counter()
    for r in rows.collect():
        if not r.held_out:
            known.update([w.lower() if w.isascii() else w for w in plain_words(r.text)] + [""])
    n, v = sum(known.values()), len(known)
    for r in lm.scores(rows, model, VOCABULARY).collect():
        assert r.train_tokens == n and math.isfinite(r.score) and r.score < 0 and r.n_known <= r.n_tokens
        if r.doc_id is not None and r.doc_id in (0, 1, 2):
            assert r.n_tokens == 1 and math.isclose(r.base_score, math.log10((known[""] + 1) / (n + v + 1)))
    # The weighted values are a distribution over what may follow.
    sub, tables = lm.subwords(VOCABULARY, lm.RULES), model.tables.value.ready()
    context = sub.ids([b"the", b"ering"])[: lm.CONTEXT]
    x = np.full((sub.size - 1, lm.CONTEXT + 1), sub.start)
    x[:, lm.CONTEXT - len(context) : lm.CONTEXT] = context
    x[:, -1] = np.arange(sub.size - 1)
    weights, found, _ = model.attend(x, sub.start)
    assert math.isclose(float((weights * found).sum()), 1, rel_tol=1e-3) and len(tables.kinds) == lm.PAIRS


def test_repeated_passages_equal_all_substrings(docs):
    rows = docs.collect()
    data = [(r.text or "").encode() for r in rows]
    seen = Counter(d[n : n + 400] for d in data for n in range(len(d) - 399))
    want = []
    for r, d in zip(rows, data):
        gone = np.zeros(len(d), bool)
        for n in range(len(d) - 399):
            if seen[d[n : n + 400]] > 1:
                gone[n : n + 400] = True
        runs = int((np.diff(np.r_[0, gone.astype(int)]) == 1).sum())
        want.append((r.doc_id or -1, len(d), int(gone.sum()), runs, bytes(np.frombuffer(d, np.uint8)[~gone])))
    got = [
        (r.doc_id or -1, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept_bytes))
        for r in repeats.without_repeats(docs).collect()
    ]
    assert sorted(got) == sorted(want)


def test_suffix_intervals_and_crowded_cores(spark, monkeypatch):
    rng = random.Random(8)
    for _ in range(60):
        least = rng.choice([2, 3, 5, 8])
        parts = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(1, 30))) for _ in range(rng.randrange(1, 6))]
        runs = repeats.repeated_starts(
            parts, np.arange(len(parts)), np.zeros(len(parts), int), np.zeros(len(parts), bool), least
        )
        got = {(n, p) for n, a, b in runs for p in range(a, b + 1)}
        seen = Counter(s[p : p + least] for s in parts for p in range(len(s) - least + 1))
        assert got == {
            (n, p) for n, s in enumerate(parts) for p in range(len(s) - least + 1) if seen[s[p : p + least]] > 1
        }
    # A passage in many texts, with few parts allowed to a core.
    monkeypatch.setattr(repeats, "GROUP", 4)
    made = lambda n: bytes(rng.randrange(97, 123) for _ in range(n)).decode()
    passage = made(430)
    rows = [(n, made(200) + passage + made(200)) for n in range(30)]
    seen = Counter(t[p : p + 400] for _, t in rows for p in range(len(t) - 399))
    starts = {n: [p for p in range(len(t) - 399) if seen[t[p : p + 400]] > 1] for n, t in rows}
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_removed, r.n_spans) for r in repeats.without_repeats(df).collect()}
    assert got == {n: (at[-1] + 400 - at[0], 1) for n, at in starts.items()}


def test_quality_measures_and_hosts(docs, spark):
    for r in quality.judge(docs).collect():
        words, text = plain_words(r.text), r.text or ""
        seen = Counter(tuple(words[n : n + 8]) for n in range(len(words) - 7))
        again = {n + k for n in range(len(words) - 7) if seen[tuple(words[n : n + 8])] > 1 for k in range(8)}
        lines = [x for x in text.split("\n") if plain_words(x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again)
        )
        assert r.base_failed == (len(words) < 20 or 100 * len(again) > 30 * len(words))
    good = " ".join(f"w{n}" for n in range(40))
    rows = [(n, good if n % 10 else "bad", f"fine{n % 5}") for n in range(2000)]
    rows += [(3000 + n, good if n % 10 == 0 else "bad", "junk") for n in range(400)] + [(5000, "bad", "new")]
    got = quality.judge(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    assert {r.source for r in got if r.host_failed} == {"junk"}


def test_shards_hold_the_mixture(docs, spark):
    rows = [(n, "x" * (n % 7), "abbb"[n % 4]) for n in range(1003)]
    got = shards.interleaved(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    counts = Counter(r.shard for r in got)
    assert set(counts) == set(range(40)) and max(counts.values()) - min(counts.values()) <= 1
    for shard in range(40):
        assert sorted(r.slot for r in got if r.shard == shard) == list(range(counts[shard]))
    strata = Counter((r.stratum, r.shard) for r in got)
    for name, n in Counter(r.stratum for r in got).items():
        assert all(abs(strata[name, shard] - n / 40) < 2 for shard in range(40))
    assert all(r.text_crc32 == zlib.crc32(b"x" * (r.doc_id % 7)) for r in got)
    assert len(shards.interleaved(docs).collect()) == docs.count()


def test_empty_tables(docs):
    none = docs.limit(0)
    assert bpe.encode(none, VOCABULARY).count() == 0
    assert licenses.scan(none, licenses.matcher(none)).count() == 0
    assert simhash.near_groups(none).count() == 0
    assert mix.taken(none).count() == 0 and mix.repeated(none).count() == 0
    assert lm.scores(none.withColumn("held_out", F.lit(False)), lm.train(none, VOCABULARY), VOCABULARY).count() == 0
    assert repeats.without_repeats(none).count() == 0
    assert quality.judge(none).count() == 0 and shards.interleaved(none).count() == 0


def test_pipeline_stages_keep_columns_and_clean_documents(docs):
    import corpus_pipeline

    rows = docs.withColumn("source", F.lit("a"))
    for name, stage in corpus_pipeline.STAGES:
        columns, rows = rows.columns, stage(docs.sparkSession, rows, "")
        assert rows.columns[: len(columns)] == columns, name
    assert rows.count() > 0


def test_near_duplicates_drop_texts_not_ids(spark):
    import corpus_pipeline

    rng = random.Random(21)
    made = [" ".join(f"w{rng.randrange(10**6)}" for _ in range(60)) for _ in range(6)]
    near = made[0] + " end"
    rows = [(None, made[1], "a"), (None, made[2], "a"), (7, made[3], "a"), (7, made[4], "b"), (7, near, "b")]
    rows += [(1, made[0], "a"), (1, made[0], "a"), (1, made[0], None), (None, made[3], "a"), (9, made[5], "a"), (8, made[5], "a")]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    want = {(None, made[1]), (None, made[2]), (7, made[3]), (7, made[4]), (1, made[0]), (8, made[5])}
    for parts in (1, 5):
        got = corpus_pipeline.near_duplicates(spark, df.repartition(parts), "").collect()
        assert len(got) == len(want) and {(r.doc_id, r.text) for r in got} == want
