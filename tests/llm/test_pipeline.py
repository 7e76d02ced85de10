"""The pipeline end to end: every stage against a plain version of it on what the stage before kept."""

from __future__ import annotations

import hashlib
import random
import re
from collections import Counter, defaultdict

import duckdb
import pandas as pd
import pytest

from entitylog.llm import expected
from entitylog.llm.queries import VOCABULARY

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_words int, kept string, ids string"


def documents():
    rng = random.Random(17)
    made = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    passage = made(90)
    texts = [None, "", "too short", "again and again " * 30]
    texts += [made(rng.randrange(30, 200)) for _ in range(30)]
    texts += [f"{made(40)}\n{passage}\n{made(40)}" for _ in range(3)]
    texts += [texts[8] + " end", texts[9] + " more words", texts[10], texts[10], texts[11].upper()]
    rows = [(n, t, "en", ["a", "b", None, "a"][n % 4], len(t or ""), 7, "mine", "own") for n, t in enumerate(texts)]
    return rows + [rows[12], rows[12], (None, made(50), None, "b", 1, None, None, None), (13, made(60), "fr", "a", 2, 1, "x", "y")]


def query(rows, sql):
    con = duckdb.connect()
    frame = pd.DataFrame(rows, columns=["doc_id", "text", "lang", "source", "n_chars", "n_words", "kept", "ids"])
    frame["doc_id"] = frame["doc_id"].astype("Int64")
    con.register("frame", frame)
    con.execute("create view documents as select doc_id, text, source from frame")
    return con.sql(sql).fetchall()


def quality(rows):
    kept = Counter((r[0], r[1]) for r in query(rows, f"select doc_id, n_words, kept from ({expected.QUALITY}) q where kept"))
    size = lambda r: len(re.findall("[^\\x20\\x09-\\x0D]+", r[1] or ""))
    return [r for r in rows if kept[r[0], size(r)]]


def near(rows):
    def shingles(text):
        words = re.sub("[A-Z]", lambda m: m[0].lower(), text or "").split()
        return {" ".join(words[n : n + 5]) for n in range(max(len(words) - 4, 1))}

    rows = list(dict.fromkeys(rows))
    sets = [shingles(r[1]) for r in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if rows[a][1] == rows[b][1] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                low, high = sorted((group[a], group[b]))
                group = [low if g == high else g for g in group]
    found = defaultdict(list)
    for r, g in zip(rows, group):
        found[g].append(r)
    # Of a group the least id stays, null last; the texts of one id here are of different groups.
    return [min(g, key=lambda r: (r[0] is None, r[0] or 0)) for g in found.values()]


def repeats(rows):
    data = [(r[1] or "").encode() for r in rows]
    seen = Counter(d[p : p + 400] for d in data for p in range(len(d) - 399))
    out = []
    for r, d in zip(rows, data):
        gone = {q for p in range(len(d) - 399) if seen[d[p : p + 400]] > 1 for q in range(p, p + 400)}
        text = bytes(b for n, b in enumerate(d) if n not in gone).decode("utf-8", "ignore")
        if text.split():
            out.append((r[0], text, r[2], r[3], len(text), *r[5:]))
    return out


def mixture(rows):
    taken = query(rows, f"select doc_id, size, taken from ({expected.MIXING}) m")
    sums = defaultdict(lambda: [0, 0])
    for doc, size, words in taken:
        sums[doc, size][0] += words
        sums[doc, size][1] += size
    times = {k: int(t / max(s, 1) + 0.5) for k, (t, s) in sums.items()}
    return [r for r in rows for _ in range(times[r[0], len(r[1].split())])]


def test_every_stage_equals_its_plain_version(spark):
    tokenizers = pytest.importorskip("tokenizers")
    import corpus_pipeline

    plain = [quality, near, repeats, mixture]
    rows = documents()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    for (name, stage), version in zip(corpus_pipeline.STAGES, plain):
        docs = stage(spark, docs, "")
        got = [tuple(r) for r in docs.collect()]
        want = version(rows)
        assert docs.columns == [f.split()[0] for f in SCHEMA.split(", ")], name
        assert Counter(got) == Counter(want), name
        rows = got
        docs = spark.createDataFrame(rows, SCHEMA)
    assert 20 < len(rows)
    library = tokenizers.Tokenizer.from_file(VOCABULARY)
    last = corpus_pipeline.token_ids(spark, docs, "")
    assert last.columns == [*docs.columns, "new_ids", "n_tokens", "decoded_sha256"]
    for r in last.collect():
        ids = library.encode(r.text, add_special_tokens=False).ids
        assert (r.ids, r.new_ids, r.n_tokens) == ("own", ids, len(ids)) or r.ids is None and r.new_ids == ids
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()


def test_stages_of_an_empty_table(spark):
    import corpus_pipeline

    docs = spark.createDataFrame([], SCHEMA)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    assert docs.collect() == []


def test_a_task_of_a_stage_has_one_worker_that_keeps_no_words(spark):
    import corpus_pipeline
    from entitylog.llm import bpe

    docs = spark.createDataFrame(documents(), SCHEMA)
    for stage in (corpus_pipeline.repeated_passages, corpus_pipeline.token_ids):
        plan = stage(spark, docs, "")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython") == 1
    once = bpe.both_ways(docs.select("doc_id", "text"), VOCABULARY)
    twice = bpe.decode(bpe.encode(docs.select("doc_id", "text"), VOCABULARY), VOCABULARY)
    assert once.columns == twice.columns
    plain = lambda df: sorted(map(repr, df.collect()))
    assert plain(once) == plain(twice)
    vocab = bpe.vocabulary(VOCABULARY)
    assert bpe.encode_text(vocab, "zqxvwkrel") and vocab.words and vocab.automaton.arcs
    vocab.forget()
    assert not vocab.words and not vocab.automaton.arcs
