"""Web archive, spelling variants and conversation tries against plain versions."""

from __future__ import annotations

import gzip
import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from entitylog.llm import common, spelling, tries, warc
from entitylog.llm.common import ranked, spread_join


def sha(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()


# --- joins and ranks over hot keys


def test_spread_join_and_ranks_of_hot_keys(spark, monkeypatch):
    monkeypatch.setattr(common, "SHARES", 10)
    rng = random.Random(4)
    rows = [(rng.choice([1, 1, 1, 1, None, 2, 3, n]), n, rng.randrange(5)) for n in range(600)]
    big = spark.createDataFrame(rows, "k int, n int, t int").repartition(5)
    small = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (None, "z")], "k int, v string")
    named = {1: "a", 2: "b", 3: "c"}
    got = spread_join(big, small, ["k"], "left")
    assert sorted((r.n, r.v) for r in got.collect()) == [(n, named.get(k)) for k, n, _ in rows]
    assert sorted(r.n for r in spread_join(big, small, ["k"]).collect()) == [n for k, n, _ in rows if k in named]
    got = ranked(big.filter("k is not null"), "k", ["t", "n"], "place")
    want = {}
    for k in {k for k, _, _ in rows if k is not None}:
        for place, (_, n) in enumerate(sorted((t, n) for key, n, t in rows if key == k), 1):
            want[n] = place
    assert {r.n: r.place for r in got.collect()} == want


# --- archive

PAGES = "page_id long, url string, html string, digest int, payload string, at int, header string, first string"


@pytest.fixture(scope="module")
def pages(spark):
    long, other = "x" * 120, "é" * 50
    texts = [long, None, "", "short", "short", other, long, "WARC/1.1\r\nWARC-Type: response\r\n\r\n" * 9, long, long, other + "\r\n\r\n"]
    rows = [(n + 5, f"http://a/{n}", t) for n, t in enumerate(texts)]
    rows += [(3, None, other), (None, "http://n", long), (None, None, None), (9, "http://a\r\nWARC-Type: x", "y" * 300)]
    rows += [(20, "http://t/b", "z" * 200), (20, "http://t/a", "z" * 200), (20, "http://t/a", "z" * 200)] + [(n, None, long) for n in range(40, 90)]
    return spark.createDataFrame([(*r, 1, "p", 2, "h", "f") for r in rows], PAGES).repartition(4)


def archived(pages, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('archive')}/a"
    warc.write(pages, path)
    return path


def test_archive_gives_back_every_page(pages, spark, tmp_path_factory):
    path = archived(pages, tmp_path_factory)
    rows = warc.read(spark, path).collect()
    given = [(r.page_id, r.url, (r.html or "").encode()) for r in pages.collect()]
    clean = lambda u: u and u.replace("\r", "%0D").replace("\n", "%0A")
    assert Counter((r.page, r.url, bytes(r.payload)) for r in rows) == Counter((p, clean(u), c) for p, u, c in given)
    by_id = {r.record_id: r for r in rows}
    assert len(by_id) == len(rows)
    last = lambda p: (p is None, p or 0)
    for r in rows:
        copies = [x for x in rows if x.payload == r.payload]
        first = min(copies, key=lambda x: last(x.page))
        if len(r.payload) < 100:
            assert (r.record_type, r.refers_to, r.refers_to_page) == ("response", None, None)
            continue
        responses = [x for x in copies if x.record_type == "response"]
        assert len(responses) == 1 and responses[0].page == first.page
        if r.record_type == "revisit":
            assert by_id[r.refers_to] is responses[0] and r.refers_to_page == first.page
            assert len(r.record) == len(r.header) + len(r.http) + 4
    ties = [r for r in rows if r.page == 20]
    assert sorted((r.record_type, r.url) for r in ties) == [("response", "http://t/a"), ("revisit", "http://t/a"), ("revisit", "http://t/b")]
    stored = spark.read.parquet(f"{path}/payloads").collect()
    assert {r.digest: bytes(r.payload) for r in stored} == {sha(c): c for _, _, c in given} and len(stored) == len({c for _, _, c in given})


def plain_records(data: bytes):
    at = 0
    while at < len(data):
        head, _, _ = data[at:].partition(b"\r\n\r\n")
        fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
        body = at + len(head) + 4
        yield fields, data[body : body + int(fields["Content-Length"])]
        at = body + int(fields["Content-Length"])
        assert data[at : at + 4] == b"\r\n\r\n"
        at += 4


def test_archive_files_are_standard_and_read_back(pages, spark, tmp_path_factory):
    path = archived(pages, tmp_path_factory)
    records = warc.read(spark, path)
    files = f"{tmp_path_factory.mktemp('files')}/w"
    warc.write_files(records, files, rows=7)
    exact = Counter(bytes(r.record) for r in records.collect())
    parts = [gzip.decompress(p.read_bytes()) for p in Path(files).glob("*.gz")]
    assert sum(exact.values()) == pages.count() == sum(len(list(plain_records(d))) for d in parts)
    for fields, block in (x for d in parts for x in plain_records(d)):
        http, _, payload = block.partition(b"\r\n\r\n")
        assert fields["WARC-Type"] == "revisit" and not payload or fields["WARC-Payload-Digest"] == f"sha256:{sha(payload)}"
    assert Counter(bytes(r.record) for r in warc.read_files(spark, files).collect()) == exact


def test_archive_fails_on_a_payload_that_is_not_its_digests(pages, spark, tmp_path_factory):
    path = archived(pages, tmp_path_factory)
    bad = spark.read.parquet(f"{path}/payloads").withColumn("payload", F.lit(b"other")).limit(1)
    bad.write.parquet(f"{path}-bad/payloads")
    spark.read.parquet(f"{path}/records").write.parquet(f"{path}-bad/records")
    with pytest.raises(Exception, match="payload"):
        warc.read(spark, f"{path}-bad").collect()


def test_archive_of_no_pages(pages, spark, tmp_path_factory):
    assert warc.read(spark, archived(pages.limit(0), tmp_path_factory)).collect() == []


# --- spelling


def plain_variants(rows):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            counts[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}

    def near(a, b):
        a, b = sorted((a, b), key=len)
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        return len(b) == len(a) + 1 and any(b[:n] + b[n + 1 :] == a for n in range(len(b)))

    out = {}
    for w, n in words.items():
        close = [x for x in words if x != w and near(w, x)]
        best = min(close, key=lambda x: (-words[x], x), default=None)
        form = best if best and words[best] >= 2 * n else None
        out[w] = [n, len(close), form, words.get(form)]
    for w, row in out.items():
        root = w
        while out[root][2]:
            root = out[root][2]
        row.append(root)
    return {w: tuple(row) for w, row in out.items()}


@pytest.fixture(scope="module")
def misspelt(spark):
    rng = random.Random(8)
    base = ["station", "stations", "übung", "übungen", "aaaaaa", "aaaaa", "Nation", "notion", "abcde", "bcdef", "ñandúes", "ÀÉÎÕÜ", "×÷×÷×"]
    words = base + ["".join(rng.choice("aab") for _ in range(rng.randrange(5, 9))) for _ in range(120)]
    changed = []
    for w in base * 4:
        k = rng.randrange(len(w) + 1)
        changed.append(rng.choice([w[:k] + w[k + 1 :], w[:k] + "q" + w[k:], w[:k] + "z" + w[k + 1 :]]))
    pool = [w for w in words for _ in range(rng.choice([1, 2, 6, 20]))] + changed
    rows = [(n, " ".join(rng.choice(pool) for _ in range(60)) + rng.choice(["", "中文word!", "1abc2 İstanbul"])) for n in range(150)]
    rows += [(None, "nothing nothing nothing thing's"), (7, None), (8, ""), (9, " \t"), rows[3], rows[3], (11, "longer" * 4000), (-5, "x" * 9)]
    return rows


@pytest.mark.parametrize("most", [spelling.MOST, 3])
def test_spelling_variants_equal_all_pairs(spark, misspelt, most):
    rows = [(d, t, "w", 1, "k") for d, t in misspelt]
    df = spark.createDataFrame(rows, "doc_id long, text string, word string, n int, key string").repartition(4)
    got = spelling.variants(df, most=most).collect()
    assert {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in got} == plain_variants(misspelt)
    assert len(got) == len({r.word for r in got})
    want = plain_variants(misspelt)
    assert any(r[2] and want[r[2]][2] for r in want.values()), "a chain of forms"


def test_acceptor_is_least_and_numbers_its_words():
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("ab") for _ in range(6)) for _ in range(40)})
    start = spelling.acceptor(words)
    for place, word in enumerate(words):
        state, at = start, 0
        for letter in word:
            state, n = state.arcs[letter]
            at += n
        assert state.final and at == place
    seen, rights = {}, defaultdict(set)

    def right(state):
        if id(state) not in seen:
            mine = {""} if state.final else set()
            for letter, (other, _) in state.arcs.items():
                mine |= {letter + rest for rest in right(other)}
            seen[id(state)] = mine
            rights[frozenset(mine)].add(id(state))
        return seen[id(state)]

    assert right(start) == set(words)
    # No two states accept the same rests, but for the numbers on their arcs, which then are equal too.
    assert all(len(states) == 1 for states in rights.values())


def test_spelling_of_no_documents(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(none).collect() == []
    assert spelling.variants(spark.createDataFrame([(1, None), (2, "a b c")], none.schema)).collect() == []


# --- tries


def plain_trie(rows):
    said = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            mark = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            said[conv].append(((turn is not None, turn or 0), mark, (role, text)))
    said = {c: [t for _, _, t in sorted(x)] for c, x in said.items()}
    whole = {}
    for c, own in said.items():
        h = zlib.crc32(str(c).encode()) % 6
        whole[c] = tuple(said.get(c - c % 100, [])[:h] + own[h:])
    members = defaultdict(list)
    for c, way in whole.items():
        for d in range(len(way) + 1):
            members[way[:d]].append(c)
    children = Counter(way[:-1] for way in members if way)
    out = []
    for way, convs in members.items():
        below = [w for w in members if w[: len(way)] == way]
        ends = sorted(c for c in convs if whole[c] == way)
        out.append((
            min(convs), len(way), min(members[way[:-1]]) if way else None, len(convs), children[way],
            sum(not children[w] for w in below), sum((len(members[w]) - 1) * len(w[-1][1]) for w in below if w),
            sha(",".join(map(str, ends)).encode()),
        ))
    return sorted(out, key=str)


def talks():
    rng = random.Random(6)
    rows = []
    for conv in [*range(0, 40), *range(100, 180), 300, 512, 513, 699]:
        for turn in range(rng.randrange(1, 8)):
            rows.append((conv, turn, rng.choice(["user", "assistant", None]), rng.choice(["hi", "yes", "no", "é中", None, ""])))
    rows += [(n, t, "user", f"same {t}") for n in range(700, 760) for t in range(3)]
    rows += [(20, None, "system", "first"), (20, None, "system", "first"), (30, 1, "user", "tie a"), (30, 1, "user", "tie b")]
    rows += [(None, 1, "user", "lost"), (800, 0, "a", "b"), (801, 0, "a:b", ""), (802, 0, "a", ":b")]
    rows += [(n, t, "r", str(t % 3)) for n in (902, 905) for t in range(23)]
    return rows


CONVERSATIONS = "conv_id long, turn long, role string, text string, id int, at int, conv int, name string"


@pytest.mark.parametrize("segment, chunk", [(64, 20_000), (2, 3)])
def test_trie_equals_all_prefixes(spark, monkeypatch, segment, chunk):
    monkeypatch.setattr(tries, "SEGMENT", segment)
    monkeypatch.setattr(tries, "CHUNK", chunk)
    rows = talks()
    df = spark.createDataFrame([(*r, 1, 2, 3, "n") for r in rows], CONVERSATIONS).repartition(5)
    got = [tuple(r) for r in tries.conversation_trie(df).collect()]
    assert sorted(got, key=str) == plain_trie(rows)


def test_trie_of_no_conversations_and_of_turnless_ones(spark):
    none = spark.createDataFrame([], CONVERSATIONS)
    assert tries.conversation_trie(none).collect() == []
    empty = next(c for c in range(101, 199) if zlib.crc32(str(c).encode()) % 6 >= 1)
    df = spark.createDataFrame([(empty, 0, "user", "gone", 1, 2, 3, "n")], CONVERSATIONS)
    got = [tuple(r) for r in tries.conversation_trie(df).collect()]
    assert got == [(empty, 0, None, 1, 0, 1, 0, sha(str(empty).encode()))]


def test_nodes_grow_through_all_layouts():
    rng = random.Random(1)
    keys = sorted({bytes(rng.choices(range(256), k=4)) for _ in range(3000)} | {bytes([7, n, 1, 1]) for n in range(60)})
    shuffled = list(enumerate(keys))
    rng.shuffle(shuffled)
    root = tries.Node(b"")
    for n, key in shuffled:
        tries.insert(root, key, n)
    layouts, found = set(), {}

    def walk(node, way):
        layouts.add(node.layout)
        assert len(node.below()) <= node.layout
        if node.end >= 0:
            found[way] = node.end
        for byte in range(256):
            child = node.child(byte)
            if child is not None:
                walk(child, way + bytes([byte]) + child.path)

    walk(root, b"")
    assert found == {key: n for n, key in enumerate(keys)} and layouts == {4, 16, 48, 256}
