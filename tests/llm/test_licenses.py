"""Whole licence texts, headers, and inheritance against a plain walk up the directories."""

from __future__ import annotations

import random
import textwrap

from entitylog.llm import licenses


def test_whole_texts_and_headers(spark):
    rng = random.Random(3)
    prose = lambda n: " ".join(f"w{rng.randrange(4000)}" for _ in range(n))
    texts = dict(licenses.TEXTS)
    wrapped = lambda name: "\n".join(textwrap.wrap(texts[name], 60))
    commented = "\n".join("# " + line for line in textwrap.wrap(texts["Apache-2.0"], 50))
    rows = [
        (1, "Copyright (c) 2020 A. Person\n\n" + wrapped("MIT"), "MIT", "whole"),
        (2, commented + "\n\nimport this\n" + prose(300), "Apache-2.0", "header"),
        (3, wrapped("BSD-2-Clause"), "BSD-2-Clause", "header"), (4, wrapped("BSD-3-Clause"), "BSD-3-Clause", "header"),
        (5, "\n\n" + wrapped("ISC") + "\n\n" + prose(3), "ISC", "header"),
        (6, prose(500), None, None), (7, None, None, None), (8, "", None, None), (9, prose(5) + "\n\n" + prose(9), None, None),
        (10, texts["Zlib"], "Zlib", "line"), (10, texts["Zlib"], "Zlib", "line"), (None, wrapped("MPL-2.0"), "MPL-2.0", "header"),
    ]
    rows += [(100 + n, f"{prose(40)}\n{prose(30)}", None, None) for n in range(60)]
    df = spark.createDataFrame([(n, t, "x", 1) for n, t, _, _ in rows], "doc_id long, text string, words string, digest int")
    got = licenses.scan(df, licenses.matcher(df)).collect()
    assert sorted(((r.doc_id, r.license) for r in got), key=str) == sorted(((n, k) for n, _, k, _ in rows), key=str)
    # Without templates of one line, lines are too short to be near.
    alone = licenses.scan(df, licenses.matcher(df, templates=licenses.TEXTS)).collect()
    assert sorted(((r.doc_id, r.license, r.unit) for r in alone), key=str) == sorted(((n, k, u) for n, _, k, u in rows), key=str)
    assert all((r.cosine is None) == (r.license is None) for r in got)


def test_inheritance_equals_a_walk_up(spark):
    rng = random.Random(9)
    made = lambda: "/".join(rng.choice("ab") for _ in range(rng.randrange(0, 5)))
    rows = []
    for n in range(300):
        directory = made()
        path = f"{directory}/f{n}" if directory else f"f{n}"
        rows.append((n, None if rng.random() < 0.05 else path, rng.choice([None, None, "MIT", "ISC"]), rng.random() < 0.2))
    rows += [rows[7], rows[8]]
    df = spark.createDataFrame([(*r, "x") for r in rows], "n int, path string, license string, is_file boolean, basis string")
    held = {}
    for _, path, name, is_file in rows:
        if path is not None and name and is_file:
            directory = path.rpartition("/")[0]
            held[directory] = min(held.get(directory, (path, name)), (path, name))
    want = []
    for n, path, name, _ in rows:
        effective, basis, found = name, "header" if name else None, None
        if not name and path is not None:
            parts = path.split("/")[:-1]
            for depth in range(len(parts), -1, -1):
                above = "/".join(parts[:depth])
                if above in held:
                    effective, basis, found = held[above][1], "inherited", above
                    break
        want.append((n, effective, basis, found))
    got = [(r.n, r.effective, r.basis, r.from_dir) for r in licenses.inherit(df).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert licenses.inherit(df.limit(0)).collect() == []
