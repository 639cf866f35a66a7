"""The corpus operators against plain Python on small fixtures and edge cases."""
import collections
import random
import re
import zlib
from html import unescape

import numpy as np
import pytest
from pyspark.sql import functions as F

from slipway.llm import (arrays, bestfit, components, encode, html_density, langmix, license_rules, neighbour_graph,
                         pivotal, queries, repetition, resampling, shingle_join, token_store)
from slipway.llm.stored import workers_import
from slipway.session import scratch_path
from tests.oracle_compare import compare, duck

SF = "/root/testdata/sf0.001"
WORD = r"[^\x20\x09-\x0D]+"


@pytest.fixture(autouse=True)
def _imports(spark):
    workers_import(spark)


def frame(spark, rows, extra=False):
    """doc_id, text rows; ``extra`` adds columns whose names the operators use inside."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("n", "key", "ids", "bucket", "part", "size", "copies", "number", "head", "lang", "source") if extra else ():
        df = df.withColumn(name, F.lit("x"))
    return df


ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (4, "a"), (5, "ü " * 3000), (None, "no id here at all"),
       (6, " 　 x"), (7, "word " * 20000)]


# --- 1

def repeats(words, least):
    cover, longest = [False] * len(words), 0
    for i in range(len(words)):
        best = 0
        for j in range(len(words)):
            k = 0
            while i != j and max(i, j) + k < len(words) and words[i + k] == words[j + k]:
                k += 1
            best = max(best, k)
        if best >= least:
            longest = max(longest, best)
            cover[i:i + best] = [True] * best
    return sum(len(w) for w, c in zip(words, cover) if c), longest


def test_repetition_against_brute_force(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(rng.choice(["a", "bb", "ccc#"]) for _ in range(rng.randrange(60))) + "\n" * (i % 3))
            for i in range(60)]
    rows += [(100, "x y\nx y\n\n \nz\nx y"), (101, "q " * 50), (102, "a b c d e f g h i j " * 3)]
    got = {r.doc_id: r for r in repetition.repetition_rules(frame(spark, rows, True)).collect()}
    for i, text in rows:
        words, r = re.findall(WORD, text), got[i]
        counts = collections.Counter(tuple(words[k:k + 8]) for k in range(len(words) - 7))
        flags = [any(counts[tuple(words[k:k + 8])] > 1 for k in range(max(0, p - 7), min(p, len(words) - 8) + 1))
                 for p in range(len(words))]
        lines = [x for x in text.split("\n") if re.search(WORD, x)]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (
            len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)),
            sum(flags))
        assert (r.covered_chars, r.longest_repeat) == repeats(words, 8)
        assert r.base_failed == (len(words) < 20 or 100 * sum(flags) > 30 * len(words))
        assert not (r.kept and r.base_failed)


def test_repetition_edges(spark):
    df = frame(spark, ODD, True)
    got = repetition.repetition_rules(df).collect()
    assert len(got) == len(ODD) and not any(r.kept for r in got if r.n_words < 20)
    assert repetition.keep(df).columns == df.columns
    assert repetition.repetition_rules(df.limit(0)).count() == 0


# --- 2

@pytest.mark.parametrize("html, text", [
    (None, ""), ("", ""), ("<p>a<p>b &amp; c&nbsp;d<br>e", "a\n\nb & c d e"), ("just text", "just text"),
    ("<body><nav><a href=x>menu</a></nav><article><h1>T</h1><p>One <b>two</b>\n three.<p>Four</article><footer>f</footer>",
     "T\n\nOne two three.\n\nFour"),
    ("<body><div class='cookie-notice'>We use cookies and more cookies every day.</div><div class=post-content><h1>T</h1>"
     "<p>" + "word " * 30 + "</p><form><p>Sign up now</p></form><div id=comments><p>Nice one</p></div></div>"
     "<aside>More here</aside>", "T\n\n" + " ".join(["word"] * 30)),
    ("<article><script>var t='</p>';</script><!-- <p>no</p> --><p>yes</p></article>", "yes"),
])
def test_html(html, text):
    assert html_density.main_text(html) == text


LONG = " ".join(["word"] * 60)


@pytest.mark.parametrize("html, text", [
    *((f"<body><nav><a href=x>menu</a></nav><div {name}><h1>T</h1><p>{LONG}</p></div></body>", f"T\n\n{LONG}")
      for name in ("class='content has-sidebar'", "id='page' class='no-comments'", "class='with-sidebar'", "class='widget'")),
    (f"<article><p>{LONG}</p><section class='related-work'><p>Others did this before us.</p></section></article>",
     f"{LONG}\n\nOthers did this before us."),
    (f"<article><p>{LONG}</p><div class='related'><a href=a>One</a> <a href=b>Two</a></div></article>", LONG),
    (f"<body><form id=aspnetForm><div><p>{LONG}</p><p>{LONG}</p></div></form></body>", f"{LONG}\n\n{LONG}"),
    (f"<body><div id=all><p>{LONG}</p></div><form><p>Sign up now</p></form><div id=comments><p>Nice</p></div></body>", LONG),
    (f"<main><article><p>{LONG}</p></article><article><p>{LONG} b</p></article></main>", f"{LONG}\n\n{LONG} b"),
    (f"<article><p>{LONG}</p></article><div id=comments><p>{LONG} {LONG}</p></div>", LONG),
])
def test_html_wrappers_forms_and_several_articles(html, text):
    assert html_density.main_text(html) == text


def test_pages_give_their_article(spark):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = {r.page_id: r for r in html_density.extract(pages.withColumn("text", F.lit(1))).collect()}
    for p in pages.collect():
        inside = re.sub(r"</?b>", "", re.search(r"<article>(.*?)</article>", p.html, re.S)[1]).replace("<br>", " ")
        want = "\n\n".join(filter(None, (" ".join(unescape(x).split()) for x in re.split(r"</?(?:p|h1)>", inside))))
        assert (got[p.page_id].text, got[p.page_id].n_chars) == (want, len(want))


# --- 3 and 6

ALPHABET = ["a", "B", " ", "  ", "\n", "\t", "'s", "é", "́", " ", "　", "1", "!", "$$", "Σ", "İ", "\x1c",
            "\u0085", "日本", "<|endoftext|>", ",", "Ñ"]


@pytest.mark.parametrize("name, cut", [("word_bpe_49k.json", encode.WORDS), ("byte_bpe_50k.json", encode.SPACES)])
def test_memo_encoding_equals_the_library(name, cut):
    import pyarrow as pa
    rng = random.Random(1)
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(40))) for _ in range(1500)] + [None, ""]
    e = encode.Encoder(queries.tokenizer(name), cut, memo=3000)
    for lo, hi, data, offsets in arrays.chunks(pa.array(texts), 9000):
        ids, rows = e.encode(data, offsets)
        for k, t in enumerate(texts[lo:hi]):
            assert ids[rows[k]:rows[k + 1]].tolist() == e.tokenizer.encode(t or "", add_special_tokens=False).ids, t


@pytest.mark.parametrize("name, cut", [("word_bpe_49k.json", encode.WORDS), ("byte_bpe_50k.json", encode.SPACES)])
def test_memo_smaller_than_the_pieces_of_a_document(name, cut):
    import pyarrow as pa
    texts = ["the a1 b2", " ".join(f"x{k} the" for k in range(300)), "the a1 y9", " ".join(f"y{k}" for k in range(300))]
    e = encode.Encoder(queries.tokenizer(name), cut, memo=50)
    for t in texts:
        (_, _, data, offsets), = arrays.chunks(pa.array([t]))
        ids, _ = e.encode(data, offsets)
        assert ids.tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer
    path = queries.tokenizer("word_bpe_49k.json")
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(frame(spark, [(-1, None), (-2, "")]))
    rows = bestfit.pack_documents(docs, path).collect()
    plain, found = Tokenizer.from_file(path), collections.defaultdict(list)
    for r in rows:
        found[r.doc_id].append(r)
    for d in docs.collect():
        ids = plain.encode(d.text or "", add_special_tokens=False).ids + [0]
        parts = sorted(found[d.doc_id], key=lambda r: r.piece)
        assert [(r.start, r.length) for r in parts] == [(k, min(2048, len(ids) - k)) for k in range(0, len(ids), 2048)]
        assert [r.ids_crc32 for r in parts] == [crc(ids[k:k + 2048]) for k in range(0, len(ids), 2048)]
    bins = collections.defaultdict(list)
    for r in rows:
        bins[r.sequence_id].append((r.offset, r.length))
    for b in bins.values():
        at = 0
        for offset, length in sorted(b):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r.length for r in rows)
    assert len(bins) <= 1.05 * -(-total // 2048) + 1
    assert bestfit.pack_documents(docs.limit(0), path).count() == 0


def test_packer_keeps_few_bins_open():
    p = bestfit.Packer(10, 2)
    assert [p.add(n) for n in (6, 7, 8, 3, 2, 10)] == [(0, 0), (1, 0), (2, 0), (0, 6), (2, 8), (3, 0)]
    assert p.open <= 2


def test_sequences_hold_the_ids(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40)
    path = queries.tokenizer("word_bpe_49k.json")
    placed = bestfit.pack(bestfit.pieces(docs, path, with_ids=True).persist())
    whole = {r.sequence_id: r.ids for r in bestfit.sequences(placed).collect()}
    for r in placed.collect():
        assert crc(whole[r.sequence_id][r.offset:r.offset + r.length]) == r.ids_crc32


def test_token_store_round_trip(spark):
    from tokenizers import Tokenizer
    path = queries.tokenizer("byte_bpe_50k.json")
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").unionByName(
        frame(spark, [(-5, None), (-4, ""), (None, "null key"), (7_000_000, "x"), (7_000_000, "xy")]))
    where = scratch_path(spark, "tokens")
    token_store.write_store(docs, where, path, rows_per_shard=64, keys_per_part=50)
    store = token_store.TokenStore(spark, where)
    assert store.shards.count() > 2
    got = sorted(store.places(docs.select("doc_id")).join(store.documents(), ["shard", "ordinal"]).collect(),
                 key=lambda r: r.start)
    plain = Tokenizer.from_file(path)
    ids = lambda d: plain.encode(d.text or "", add_special_tokens=False).ids + [0]
    want = sorted(docs.collect(), key=lambda d: (d.doc_id is not None, d.doc_id, np.array(ids(d), "<u2").tobytes()))
    at = 0
    assert len(got) == len(want)
    for r, d in zip(got, want):
        assert (r.key, r.start, r.n_tokens, r.ids_crc32) == (d.doc_id, at, len(ids(d)), crc(ids(d)))
        at += r.n_tokens
    some = spark.createDataFrame([(-5,), (7_000_000,), (123_456_789,)], "k long")
    assert sorted((r.key, r.ids) for r in store.ids(some).collect()) == [
        (-5, [0]), *sorted((7_000_000, plain.encode(t, add_special_tokens=False).ids + [0]) for t in ("x", "xy"))]
    assert token_store.stored_documents(docs.limit(0), scratch_path(spark, "tokens"), path).count() == 0


def test_minimal_perfect_hash():
    h = arrays.mix(np.arange(5000, dtype=np.uint64))
    sizes, bits = token_store.build_hash(h)
    assert sorted(token_store.slots(h, sizes, bits)) == list(range(5000))


# --- 4

def test_neighbours_reach_recall(spark):
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    got = neighbour_graph.nearest(df, links=24, beam=128, rounds=4).collect()
    data = {r.vec_id: np.array(r.embedding, float) for r in df.collect()}
    ids = np.array(sorted(data))
    x = np.stack([data[i] for i in ids])
    hit = total = 0
    found = collections.defaultdict(dict)
    for r in got:
        found[r.query_id][r.rank] = r
    for q in ids[ids % 20 == 0]:
        score = x @ data[q]
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != q][:20]
        rows = [found[q][k] for k in range(1, 21)]
        assert all(abs(r.score - float(data[r.vec_id] @ data[q])) < 1e-9 for r in rows)
        assert [(-r.score, r.vec_id) for r in rows] == sorted((-r.score, r.vec_id) for r in rows)
        hit += len({r.vec_id for r in rows} & {int(ids[i]) for i in order})
        total += 20
    assert hit / total >= 0.9


def test_neighbours_edges(spark):
    rows = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [3.0, 0.0]), (3, [0.0, 0.0]), (4, None),
            (5, [float("nan"), 1.0]), (6, [1.0]), (7, [None, 1.0]), (None, [1.0, 1.0]), (8, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in neighbour_graph.nearest(df).collect())
    assert got == [(0, 1, 2, 3.0), (0, 2, 1, 1.0), (0, 3, 20, 1.0), (20, 1, 2, 3.0), (20, 2, 0, 1.0), (20, 3, 1, 1.0)]
    assert neighbour_graph.nearest(df.limit(0)).count() == 0


@pytest.mark.parametrize("kind", ["near", "outlier", "norms"])
def test_neighbours_of_near_equal_vectors_and_uneven_norms(spark, kind):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    if kind == "near":
        x[:1000] = x[0] + rng.normal(size=(1000, 32)) * 1e-4
        x[:1000] /= np.linalg.norm(x[:1000], axis=1, keepdims=True)
    elif kind == "outlier":
        x[7] *= 1000
    else:
        x *= np.exp(rng.normal(size=(3000, 1)))
        x[7] *= 1000
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = collections.defaultdict(set)
    for r in neighbour_graph.nearest(df, query_step=50, rounds=5).collect():
        found[r.query_id].add(r.vec_id)
    recall = []
    for q in range(0, 1000, 50):
        score = x @ x[q]
        score[q] = -np.inf
        recall.append(len(found[q] & set(np.argsort(-score)[:20].tolist())) / 20)
    print(kind, "recall", np.mean(recall))
    assert np.mean(recall) >= 0.9


@pytest.mark.parametrize("radius,jitter", [(1.7, 1e-5), (50.0, 1e-6)])
def test_neighbours_of_nearly_one_vector_at_any_radius(spark, radius, jitter):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(1, 32)) + rng.normal(size=(2500, 32)) * jitter
    x = (x / np.linalg.norm(x, axis=1, keepdims=True) * radius).astype(np.float32).astype(float)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<float>")
    best = collections.defaultdict(list)
    for r in neighbour_graph.nearest(df, query_step=125).collect():
        best[r.query_id].append(r.score)
    recall = []
    for q in range(0, 2500, 125):
        score = np.delete(x @ x[q], q)
        least = np.sort(score)[-20] - 1e-12 * radius * radius
        recall.append(sum(s >= least for s in best[q]) / 20)
    assert np.mean(recall) >= 0.9


def test_neighbours_of_repeated_ids_and_clashing_names(spark):
    rows = [(0, [1.0, 0.0], 1, 2, 3), (1, [5.0, 0.0], 1, 2, 3), (1, [2.0, 9.0], 1, 2, 3), (1, [2.0, 9.0], 1, 2, 3),
            (2, [1.5, 1.0], 1, 2, 3)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, node int, vec int, bucket int")
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in neighbour_graph.nearest(df).orderBy("rank").collect()]
    assert got == [(0, 1, 1, 2.0), (0, 2, 2, 1.5)]


def test_neighbours_take_few_tasks_and_one_worker_each(spark, monkeypatch):
    """Small partitions are joined however many are asked for, and no task runs two Python steps at once."""
    rng, plans, kept = np.random.default_rng(7), [], neighbour_graph.stored
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(rng.normal(size=(600, 16)))],
                               "vec_id long, embedding array<float>")

    def planned(frame, kind):
        plans.append(frame._jdf.queryExecution().sparkPlan().toString())
        return kept(frame, kind)

    monkeypatch.setattr(neighbour_graph, "stored", planned)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "97")
    spark.sparkContext.setJobGroup("few tasks", "")
    try:
        neighbour_graph.nearest(df).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    jobs = [tracker.getJobInfo(j) for j in tracker.getJobIdsForGroup("few tasks")]
    stages = [tracker.getStageInfo(s) for j in jobs for s in j.stageIds]
    assert max(s.numCompletedTasks for s in stages if s) < 97
    steps = [re.findall(r"MapInArrow|Exchange", plan) for plan in plans if "Union" not in plan]
    assert any("MapInArrow" in step for step in steps)
    assert not any(a == b == "MapInArrow" for step in steps for a, b in zip(step, step[1:]))


def test_best_of_slices_is_best_of_all():
    rng = np.random.default_rng(8)
    parts = [(rng.integers(0, 40, n), rng.integers(0, 3000, n), rng.integers(0, 500, n) / 500.0)
             for n in (0, 70_000, 5, 90_000, 40_000, 0, 100_000)]
    got = neighbour_graph._best_of(iter(parts), 32)
    want = neighbour_graph._best(*(np.concatenate(x) for x in zip(*parts)), 32)
    assert all((a == b).all() for a, b in zip(got, want))


# --- 5

def test_licences(spark):
    con = duck(SF)
    r = compare(queries.op5_licence_rules(spark, SF), con, queries.oracle_sql()["op5_licence_rules"])
    assert r["cols_match"] and r["values_match"], r
    mit = license_rules.LICENCE_TEXTS["MIT"][0].replace("conditions: ", "conditions:\n\n").replace("copies of the", "copies\nof the")
    rows = [(1, mit), (2, "X\nReleased under the MIT License.\nmore"), (3, "Permission is hereby granted"), (4, None), (5, ""),
            (9, "SPDX-License-Identifier: Apache-2.0")]
    got = {r.doc_id: r.licences for r in license_rules.scan(frame(spark, rows, True)).collect()}
    assert got[1] == got[2] == "MIT" and got[3] == got[4] == got[5] == ""
    assert "Apache-2.0" in got[9] and license_rules.scan(frame(spark, []).limit(0)).count() == 0


def licences(spark, texts):
    """Of each text in Spark, after the DuckDB form gave the same."""
    import duckdb
    rows = list(enumerate(texts))
    got = {r.doc_id: tuple(r)[1:] for r in license_rules.scan(frame(spark, rows)).collect()}
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert got == {r[0]: r[1:] for r in con.execute(license_rules.scan_sql()).fetchall()}
    return [got[i][-1] for i in range(len(texts))]


def test_licence_notices_in_any_usual_wording(spark):
    wanted = {
        "This work is licensed under the GNU General Public License, version 3.": "GPL-3.0",
        "x y. Licensed under CC BY-NC 4.0. More.": "CC-BY-NC-4.0",
        "This library is distributed under the terms of the GNU LGPL v2.1 or later.": "LGPL-2.1",
        "This project is licensed under the MIT License - see the LICENSE.md file for details.": "MIT",
        "// SPDX-License-Identifier: AGPL-3.0-or-later\ncode": "AGPL-3.0",
        "Released under version 2 of the GNU General Public License.": "GPL-2.0",
        "Distributed under the GPL.": "GPL", "Licensed under the Mozilla Public License, v. 2.0.": "MPL-2.0",
        "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 3.0 Unported License.":
            "CC-BY-NC-SA-3.0",
        "This program and the accompanying materials are made available under the terms of the Eclipse Public License "
        "2.0 which is available at https://www.eclipse.org/legal/epl-2.0/": "EPL-2.0",
        "Distributed by the GPL team.": "", "He is licensed under the new law.": "", "MIT": ""}
    assert licences(spark, wanted) == list(wanted.values())
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    noticed = docs.where(F.col("text").rlike("(?i)(licensed|released) under (the )?(GNU|CC|MIT|Apache)"))
    assert license_rules.scan(noticed).where("licences = ''").count() == 0


MIT_FILE = """MIT License

Copyright (c) 2023 A. Author

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
copies of the Software, and to permit persons to whom the Software is
furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all
copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND.
"""
GPL_HEADER = """a tool that does things
Copyright (C) 2020  A. Author

This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful."""
ISC_FILE = """ISC License

Copyright 2019, A. Author

Permission to use, copy, modify, and/or distribute this software for any
purpose with or without fee is hereby granted, provided that the above
copyright notice and this permission notice appear in all copies.
"""


def test_licence_files_with_title_copyright_and_wraps(spark):
    marked = ["".join(f"{m} {line}".rstrip() + "\n" for line in GPL_HEADER.splitlines()) for m in ("#", " *", "//", ";;")]
    texts = [MIT_FILE, MIT_FILE.replace("\n", "\r\n"), MIT_FILE.replace("\n\n", "\n", 2), GPL_HEADER, *marked, ISC_FILE]
    assert licences(spark, texts) == ["MIT"] * 3 + ["GPL-3.0"] * 5 + ["ISC"]


# --- 7

def brute_components(rows, words, percent):
    sets = {}
    for i, t in rows:
        w = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets[i] = frozenset(tuple(w[k:k + words]) for k in range(max(1, len(w) - words + 1))) if w else frozenset()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    ids = sorted(sets)
    for a, i in enumerate(ids):
        for j in ids[a + 1:]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * len(sets[i] | sets[j]):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: (len(sets[i]), find(i)) for i in ids}


@pytest.mark.parametrize("words, percent", [(4, 85), (5, 80)])
def test_shingle_join_against_brute_force(spark, words, percent, monkeypatch):
    rng = random.Random(words)
    rows = []
    for _ in range(25):
        base = [rng.choice("abcdefghij") + str(rng.randrange(40)) for _ in range(rng.randrange(1, 90))]
        for _ in range(rng.randrange(1, 12)):
            w = list(base)
            for _ in range(rng.randrange(4)):
                w[rng.randrange(len(w))] = "X" + str(rng.randrange(9))
            rows.append((len(rows), " ".join(w)))
    rows += [(900, None), (901, ""), (902, "a b"), (903, "A  B\n")]
    got = {r.doc_id: (r.n_shingles, r.component_id)
           for r in shingle_join.near_duplicates(frame(spark, rows, True), words, percent).collect()}
    assert got == brute_components(rows, words, percent)


def test_shingle_join_blocks_and_repeated_ids(spark, monkeypatch):
    monkeypatch.setattr(shingle_join, "BLOCK_DOCUMENTS", 4)
    base = [f"w{k}" for k in range(80)]
    rows = [(i, " ".join([*base[:i], f"x{i}", *base[i + 1:]])) for i in range(23)] + [(30, "p q r s t")] * 2
    rows += [(31, "one text of this id here"), (31, "p q r s t"), (None, "p q r s t")]
    got = {(r.doc_id, r.component_id) for r in shingle_join.near_duplicates(frame(spark, rows)).collect()}
    assert got == {(i, 0) for i in range(23)} | {(30, 30), (31, 30), (None, None)}
    assert shingle_join.near_duplicates(frame(spark, rows).limit(0)).count() == 0


def test_rows_without_an_id_hide_no_near_copies(spark):
    base = [f"w{k}" for k in range(80)]
    same, near = " ".join(base), " ".join([*base[:-1], "x"])
    df = frame(spark, [(None, same), (1, same), (None, same), (2, near), (3, "other words")]).coalesce(1)
    got = [(r.doc_id, r.component_id) for r in shingle_join.near_duplicates(df).collect()]
    assert sorted(got, key=str) == sorted([(None, None)] * 2 + [(1, 1), (2, 1), (3, 3)], key=str)


def test_unlike_documents_that_share_passages_are_no_cluster(spark):
    part = [" ".join(f"p{k}w{i}" for i in range(30)) for k in range(41)]
    rows = [(k, f"{part[k]} {part[k + 1]}") for k in range(40)] + [(40, f"{part[0]} {part[1]} end")]
    links = shingle_join.candidates(shingle_join.described(frame(spark, rows), 4, 85, "doc_id", "text"), 85)
    assert links.distinct().count() == 1  # the chain links each document with the next
    got = {r.doc_id: r.component_id for r in shingle_join.near_duplicates(frame(spark, rows)).collect()}
    assert got == {k: k for k in range(40)} | {40: 0}


def test_near_copies_of_one_text_are_copied_a_few_times(spark, monkeypatch):
    monkeypatch.setattr(shingle_join, "BLOCK_DOCUMENTS", 4)
    dealt, met = [], shingle_join.met
    monkeypatch.setattr(shingle_join, "met", lambda sets, percent: dealt.append(sets.count()) or met(sets, percent))
    base = [f"w{k}" for k in range(400)]
    rows = [(i, " ".join([*base[:5 * i], f"x{i}", *base[5 * i + 1:]])) for i in range(64)]
    got = {(r.doc_id, r.component_id) for r in shingle_join.near_duplicates(frame(spark, rows)).collect()}
    assert got == {(i, 0) for i in range(64)}
    assert dealt[0] == 64 and sum(dealt) <= 4 * 64  # once in every block but its own: 16 times


def test_large_clusters_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(shingle_join, "BLOCK_DOCUMENTS", 4)
    rng = random.Random(7)
    rows = []
    for length in (40, 90, 300):
        base = [f"b{length}w{k}" for k in range(length)]
        for _ in range(45):
            w = base[:length - rng.randrange(length // 6)]
            for _ in range(rng.randrange(1 + length // 45)):
                w[rng.randrange(len(w))] = "X" + str(rng.randrange(99))
            rows.append((len(rows), " ".join(w)))
    rng.shuffle(rows)
    want = brute_components(rows, 4, 85)
    assert 3 < len({c for _, c in want.values()}) < len(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in shingle_join.near_duplicates(frame(spark, rows, True)).collect()}
    assert got == want


@pytest.mark.parametrize("percent", [50, 80, 85])
def test_bitmaps_part_no_similar_sets(percent, monkeypatch):
    rng = np.random.default_rng(percent)
    sets = []
    for n in (3, 40, 130, 300, 2500):
        base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        for share in rng.uniform(0.3, 1, 30):
            sets.append(np.unique(np.append(base[rng.random(n) < share], rng.integers(0, 1 << 63, int(n * rng.uniform(0, .3)),
                                                                                      dtype=np.uint64))))
    sets = sorted((x for x in sets if len(x)), key=len)
    n = np.array([len(x) for x in sets])
    width = shingle_join.bitmap_words(n, percent)
    words = shingle_join.bitmaps(np.concatenate(sets), np.repeat(np.arange(len(sets)), n), width)
    maps = shingle_join.Bitmaps(n, words, np.cumsum(width) - width, width, percent)
    x, y = np.triu_indices(len(sets), 1)
    ok = maps.similar(x, y)
    both = np.array([len(np.intersect1d(sets[a], sets[b], True)) for a, b in zip(x, y)])
    similar = 100 * both >= percent * (n[x] + n[y] - both)
    assert similar.any() and ok[similar].all() and ok[both == 0].mean() < 0.01

    def joined(pairs):
        return components_of(len(sets), [tuple(p) for p in np.concatenate(pairs).tolist()])
    # lists longer than some are read another way, with the same result
    toks = np.zeros(len(sets), np.uint64)
    monkeypatch.setattr(shingle_join, "SHORT_LIST", 1)
    long_ = joined(list(shingle_join.compatible(np.arange(len(sets)), toks, maps)))
    monkeypatch.setattr(shingle_join, "SHORT_LIST", 1000)
    assert long_ == joined(list(shingle_join.compatible(np.arange(len(sets)), toks, maps)))


def components_of(n, pairs):
    root = list(range(n))
    for x, y in pairs:
        a, b = sorted((root[x], root[y]))
        root = [a if r == b else r for r in root]
    return root


def test_components_follow_paths(spark):
    links = [(i, i + 1) for i in range(9)] + [(20, 21), (22, 21), (5, 5)]
    got = {r.id: r.component for r in components.components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {i: 0 for i in range(10)} | {20: 20, 21: 20, 22: 20}


# --- 8

def test_language_accuracy_and_edges(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = langmix.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").toPandas()
    assert len(got) > 100 and (got.lang == got.lang_pred).mean() > 0.97 and got.score.between(0, 1).all()
    odd = frame(spark, ODD).withColumn("lang", F.lit("de"))
    und = {r.doc_id: r.lang_pred for r in langmix.identify(odd).collect()}
    assert und[1] == und[2] == und[3] == "und" and und[5] == "de"
    assert {r.lang_pred for r in langmix.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert langmix.identify(odd.limit(0)).count() == 0


def test_mixture_finds_two_languages():
    like = np.array([[1, 1e-6]] * 50 + [[1e-6, 1]] * 30)
    share, chosen = langmix.choose(like, np.array([0, 50]), 4.0)
    assert chosen.tolist() == [[True, False], [False, True]]
    share, chosen = langmix.choose(like, np.array([0]), 4.0)
    assert chosen.all() and abs(share[0, 0] - 50 / 80) < 1e-3


# --- 9

def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s))
    w, out, left = {s: weights[k % 3] for k, s in enumerate(names)}, {}, share * sum(sizes.values())
    open_ = list(names)
    while open_:
        unit = left / sum(w[s] for s in open_)
        over = [s for s in open_ if unit * w[s] > most * sizes[s]]
        if not over:
            return out | {s: unit * w[s] for s in open_}
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
            open_.remove(s)
    return out


@pytest.mark.parametrize("seed", range(4))
def test_targets_against_reshared_excess(spark, seed):
    rng = random.Random(seed)
    sizes = {rng.choice("abcdefghijk") + str(k): rng.randrange(0, 1000) for k in range(rng.randrange(1, 12))} | {None: 50}
    df = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    got = {r.source: r.target for r in pivotal.targets(df).collect()}
    want = brute_targets(sizes)
    assert got.keys() == want.keys() and all(abs(got[s] - want[s]) < 1e-6 for s in want)


def test_mix_comes_near_targets_and_agrees(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    docs = docs.unionByName(docs.limit(5)).withColumn("source", F.expr("nullif(source, 'src3')"))
    run = lambda: pivotal.mix_sources(docs, group=16, fan_in=4).toPandas()
    got, again = run(), run()
    order = ["doc_id", "source", "taken"]
    assert got.sort_values(order)[order].reset_index(drop=True).equals(again.sort_values(order)[order].reset_index(drop=True))
    assert len(got) == docs.count() and (got.taken <= 2 * got["size"]).all() and (got.taken >= 0).all()
    by = got.groupby("source", dropna=False).agg(taken=("taken", "sum"), target=("target", "first"), most=("size", "max"))
    assert ((by.taken - by.target).abs() <= by.most).all()
    odd = frame(spark, ODD).withColumn("source", F.lit("s"))
    assert pivotal.mix_sources(odd).count() == len(ODD) and pivotal.mix_sources(odd.limit(0)).count() == 0


# --- 10

def test_resampling_keeps_good_documents(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    scored, model = resampling.resample(docs, labels, queries.good())
    got = scored.join(labels, "doc_id").toPandas()
    assert got[(got.quality == 1) & (got.toxic == 0)].kept.mean() > 0.97 and got[got.quality == 0].kept.mean() < 0.3
    drawn = {r.doc_id for r in model.sample(docs).select("doc_id").collect()}
    assert drawn == {r.doc_id for r in scored.where("kept").collect()}


def test_kth_largest(spark):
    values = [random.Random(2).gauss(0, 1e4) for _ in range(3000)] + [5.0] * 40
    df = spark.createDataFrame([(x,) for x in values], "x double")
    for k in (1, 2, 700, len(values)):
        assert resampling.kth_largest(df, "x", k, bins=16) == sorted(values, reverse=True)[k - 1]
    assert resampling.kth_largest(df.limit(0), "x", 3) == float("inf")


def test_resampling_edges(spark):
    odd, labels = frame(spark, ODD, True), spark.createDataFrame([(4, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    scored, model = resampling.resample(odd, labels, queries.good(), max_labelled=5)
    assert scored.count() == len(ODD) and model.sample(odd).columns == odd.columns
    none, _ = resampling.resample(odd.limit(0), labels.limit(0), queries.good())
    assert none.count() == 0


# --- pipeline

def test_pipeline_stages(spark):
    import corpus_pipeline as P
    from slipway.llm.stored import stored
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names, counts = docs.columns, [docs.count()]
    for name, stage in P.STAGES[:-1]:
        before, docs = docs, stored(stage(spark, docs, sf))
        assert docs.columns == names, name
        counts.append(docs.count())
        if name == "quality rules":
            kept = {r.doc_id for r in repetition.repetition_rules(before).where("kept").collect()}
            assert kept == {r.doc_id for r in docs.collect()}
        if name.startswith("n-gram"):
            want = brute_components([(r.doc_id, r.text) for r in before.collect()], 5, 80)
            assert {r.doc_id for r in docs.collect()} == {i for i, (_, c) in want.items() if i == c}
        if name.startswith("mixing"):
            taken = {r.doc_id: r.copies for r in pivotal.mix_sources(before).collect()}
            assert collections.Counter(r.doc_id for r in docs.collect()) == collections.Counter(
                {i: c for i, c in taken.items() if c})
    assert counts[0] > counts[1] > counts[2] > counts[3] > 0 and counts[4] > 0
    packed = P.pack(spark, docs, sf)
    assert packed.where("piece = 0").count() == counts[4]


def test_licence_rules_within_longer_ones(spark):
    two, three = (license_rules.LICENCE_TEXTS[f"BSD-{n}-Clause"][0] for n in (2, 3))
    gap = three.replace("Neither the name", "Released under the MIT License. Neither the name")
    texts = [two, three, f"{two}\n\n{three}", f"{three}\n\n{two}", f"{three}\n\n{three}", gap, license_rules.LICENCE_TEXTS["Apache-2.0"][1]]
    wanted = ["BSD-2-Clause", "BSD-3-Clause", "BSD-2-Clause,BSD-3-Clause", "BSD-2-Clause,BSD-3-Clause", "BSD-3-Clause",
              "BSD-3-Clause,MIT", "Apache-2.0"]
    assert licences(spark, texts) == wanted


def test_licence_expressions_titles_and_fields(spark):
    wanted = {"SPDX-License-Identifier: MIT OR Apache-2.0": "Apache-2.0,MIT", "SPDX-License-Identifier: (MIT OR Apache-2.0)": "Apache-2.0,MIT",
              "Licensed under either of Apache License, Version 2.0 or MIT license at your option.": "Apache-2.0,MIT",
              "Dual licensed under the MIT and GPL licenses.": "GPL,MIT", "MIT License": "MIT", "The MIT License\n\nCopyright (c) 2020": "MIT",
              "License: MIT": "MIT", "name: x\nLicense: Apache-2.0\nauthor: y": "Apache-2.0", '{\n  "license": "ISC",\n': "ISC",
              "Mozilla Public License 2.0": "MPL-2.0", "GPL-2.0": "", "See the license.": "", "the license": "", "license": "",
              "License: see the file": "", "He asked about the licence and left.": "", "Licensed under the sea and the stars.": "",
              "MIT": "", "": ""}
    assert licences(spark, list(wanted)) == list(wanted.values())
