"""Substring deduplication, periodic runs and tokenizer alignment against plain Python."""
import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from slipway.llm import encode, periodic_runs, queries, substring_dedup, token_alignment
from slipway.llm.arrays import hash_spans, tokens
from slipway.llm.stored import workers_import

SF = "/root/testdata/sf0.001"
WORD = r"[^\x20\x09-\x0D]+"
ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "a"), (4, "a"), (5, "ü " * 3000), (None, "no id here at all " * 9),
       (None, "no id here at all " * 9), (6, " 　 x"), (7, "word " * 20000), (8, "no id here at all " * 9)]


@pytest.fixture(autouse=True)
def _imports(spark):
    workers_import(spark)


def frame(spark, rows):
    """doc_id, text rows and columns whose names the operators use inside."""
    df = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("pack", "ids", "texts", "bucket", "found", "words", "at", "h", "pair", "n", "start", "period"):
        df = df.withColumn(name, F.lit("x"))
    return df.repartition(3)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def sample(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# --- 11

def removed(rows):
    least, docs = {}, [(i, re.findall(WORD, t or "")) for i, t in rows]
    for i, w in docs:
        for k in range(len(w) - 12) if i is not None else ():
            key = tuple(w[k:k + 13])
            least[key] = min(least.get(key, i), i)
    out = []
    for i, w in docs:
        gone = [False] * len(w)
        for k in range(len(w) - 12) if i is not None else ():
            if least[tuple(w[k:k + 13])] < i:
                gone[k:k + 13] = [True] * 13
        out.append((i, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return sorted(out, key=str)


def passages(seed):
    rng = random.Random(seed)
    base = [[rng.choice("abcdefgh") for _ in range(40)] for _ in range(6)]
    rows = []
    for i in range(120):
        words = []
        for _ in range(rng.randrange(4)):
            b, a = rng.choice(base), rng.randrange(30)
            words += b[a:a + rng.randrange(8, 25)] + [str(rng.random()) for _ in range(rng.randrange(4))]
        rows.append((i if rng.random() < .9 else rng.choice([None, 3, 7]), " ".join(words)))
    return rows


def test_any_two_words_have_an_offset_where_both_are_cover_positions():
    p, cover = substring_dedup.PERIOD, substring_dedup.COVER
    for i in range(p):
        for j in range(p):
            assert any((i + d) % p in cover and (j + d) % p in cover for d in range(p))


@pytest.mark.parametrize("seed", [1, 2])
def test_substring_dedup_against_brute_force(spark, seed):
    rows = passages(seed) + ODD
    assert rows_of(substring_dedup.dedup(frame(spark, rows))) == removed(rows)


def test_substring_dedup_of_documents(spark):
    assert rows_of(substring_dedup.dedup(spark.read.parquet(f"{SF}/documents.parquet"))) == removed(sample(spark))
    assert substring_dedup.dedup(frame(spark, ODD).limit(0)).count() == 0


def test_packs_of_a_few_words_and_many_buckets_give_the_same(spark, monkeypatch):
    rows = passages(3)
    df, packed = frame(spark, rows), substring_dedup.packed
    monkeypatch.setattr(substring_dedup, "PER_BUCKET", 64)
    monkeypatch.setattr(substring_dedup, "packed", lambda docs, i, t: packed(docs, i, t, size=500))
    assert rows_of(substring_dedup.dedup(df)) == removed(rows)


# --- 12

def runs(words):
    out = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i >= q and j - i + q >= 12:
                out.setdefault((i, j + q), q)
            i = j
    return sorted((a, b - a, q) for (a, b), q in out.items())


def planted(i, words):
    if i is None or not words or (h := zlib.crc32(str(i).encode())) % 10:
        return words
    g, n = h // 10, len(words)
    a, p = g % n, 1 + (n - g % n) // (3 + g % 8)
    return [words[k] if k < a else words[a + (k - a) % p] for k in range(n)]


def collapsed(rows):
    out = []
    for i, t in rows:
        w = planted(i, re.findall(WORD, t or ""))
        keep, found = [True] * len(w), runs(w)
        for s, n, q in found:
            keep[s + q:s + n] = [False] * (n - q)
        best = min(found, key=lambda r: (-r[1], r[0], r[2])) if found else None
        out.append((i, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                    sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(x for x, k in zip(w, keep) if k))))
    return sorted(out, key=str)


def repetitive(rng):
    kind, n = rng.randrange(7), rng.randrange(1, 500)
    if kind == 0:
        return [rng.choice("ab") for _ in range(n)]
    if kind == 1:  # Fibonacci and Thue-Morse words are full of runs, or of squares without one
        a, b = "a", "ab"
        while len(b) < n:
            a, b = b, b + a
        return list(b[:n])
    if kind == 2:
        return ["ab"[bin(i).count("1") & 1] for i in range(n)]
    if kind == 3:  # squares of a word that is itself periodic
        out = []
        for _ in range(rng.randrange(1, 4)):
            block, size = [rng.choice("abc") for _ in range(rng.randrange(1, 8))], rng.randrange(1, 150)
            out += (block * (size + 2))[rng.randrange(len(block)):][:size] * rng.choice([1, 2, 2, 3])
        return out
    if kind == 4:
        block = [str(rng.randrange(50)) for _ in range(rng.randrange(1, 150))]
        return [str(rng.randrange(9)) for _ in range(30)] + (block * 4)[:rng.randrange(len(block), 4 * len(block))] + ["z"] * 13
    if kind == 5:
        block, out = [rng.choice("abcdefg") for _ in range(rng.randrange(20, 90))], []
        for _ in range(5):
            out += block
            if rng.random() < .4:
                out[rng.randrange(len(out))] = "q"
        return out
    return (["a"] * rng.randrange(5, 90) + ["b"] + ["a"] * rng.randrange(5, 90) + ["c"] * rng.randrange(3)) * rng.randrange(2, 4)


@pytest.mark.parametrize("seed", range(6))
def test_runs_against_brute_force(seed):
    rng = random.Random(seed)
    docs = [repetitive(rng) for _ in range(12)] + [[]]
    raw = [" ".join(d).encode() for d in docs]
    data = np.frombuffer(b"".join(raw), np.uint8)
    starts, ends, rows = tokens(data, np.cumsum([0] + [len(x) for x in raw]))
    found = periodic_runs.all_runs(hash_spans(data, starts, ends), rows)
    for d, a, b in zip(docs, rows[:-1], rows[1:]):
        mine = found[(found[:, 0] >= a) & (found[:, 0] < b)]
        assert [(s - a, e - s, q) for s, e, q in mine.tolist()] == runs(d)


def test_runs_of_documents_with_planted_periods(spark):
    rows = sample(spark) + ODD + [(10, "a " * 50), (40, None), (41, ""), (43, "é　x " * 20)]
    got = periodic_runs.periodic_runs(periodic_runs.with_planted_periods(frame(spark, rows)), slice_bytes=20000)
    assert rows_of(got.where("doc_id is null or doc_id <> 7")) == collapsed([r for r in rows if r[0] != 7])


def test_runs_edges(spark):
    df = frame(spark, ODD)
    got = {r.doc_id: r for r in periodic_runs.periodic_runs(df, spans=True).collect()}
    assert (got[7].n_runs, got[7].start, got[7].length, got[7].period) == (1, 0, 20000, 1)
    assert got[7].collapsed_sha256 == sha("word") and [tuple(x) for x in got[7].runs] == [(0, 20000, 1)]
    assert (got[1].n_runs, got[1].start, got[1].runs_sha256, got[1].collapsed_sha256) == (0, None, sha(""), sha(""))
    assert periodic_runs.periodic_runs(df.limit(0)).count() == 0


def test_long_repetitive_texts_take_time_in_proportion():
    rng = np.random.default_rng(0)
    for seq in (np.tile([7, 9], 100_000), np.tile(rng.integers(0, 1 << 60, 5000), 40), rng.integers(0, 1 << 60, 200_000)):
        found = periodic_runs.all_runs(seq.astype(np.uint64), np.array([0, len(seq)]))
        assert len(found) <= 1


# --- 13

def decoders():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(queries.tokenizer("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    table = token_alignment.byte_table()
    bytes_a = {i: bytes(table[c] for c in t) for t, i in a.get_vocab().items() if i != 50256}
    b = sentencepiece.SentencePieceProcessor(model_file=queries.tokenizer("piece_bpe_32k.model"))
    bytes_b = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()
               for i in range(b.vocab_size())]
    return a, bytes_a, b, bytes_b


def ends(ids, size):
    return np.cumsum([len(size[i]) for i in ids]).tolist()


def aligned(rows):
    a, bytes_a, b, bytes_b = decoders()
    docs, count = [], collections.Counter()
    for i, t in rows:
        x = y = []
        if t:
            x, y = a.encode(" " + t, add_special_tokens=False).ids, b.encode(t)
            whole = (" " + t).encode()
            if b"".join(bytes_a[k] for k in x) != whole or b"".join(bytes_b[k] for k in y) != whole:
                x = y = []
        ex, ey = ends(x, bytes_a), ends(y, bytes_b)
        links, j = [], 0
        for k, e in enumerate(ex):
            while ey[j] <= (ex[k - 1] if k else 0):
                j += 1
            m = j
            while m < len(y) and (ey[m - 1] if m else 0) < e:
                links.append((x[k], y[m]))
                m += 1
        groups, k, m = [], 0, 0
        for cut in sorted(set(ex) & set(ey)):
            k2, m2 = ex.index(cut, k) + 1, ey.index(cut, m) + 1
            groups.append(",".join(map(str, x[k:k2])) + "|" + ",".join(map(str, y[m:m2])))
            k, m = k2, m2
        docs.append((i, x, y, links, groups))
        count.update(set(links))
    best = collections.Counter()
    for (p, _), n in count.items():
        best[p] = max(best[p], n)
    return sorted([(i, len(x), len(y), len(g), len(k), sum(count[p] == best[p[0]] for p in k), sum(count[p] for p in k),
                    sha(";".join(g)) if x else "") for i, x, y, k, g in docs], key=str)


PARTS = ["a", "B", " ", "  ", "\n", "\t", "'s", "é", "é", " ", "　", "1", "!", "$$", "Σ", "𝄞", "日本", "<|endoftext|>",
         "<0x41>", "<s>", ",", "Ñ", "word", "The", "\r\n", "\x00", "\u0085", "ﬁ", "👩‍👧", "﻿"]


def test_alignment_against_whole_texts(spark):
    rng = random.Random(3)
    rows = [(i, "".join(rng.choice(PARTS) for _ in range(rng.randrange(40)))) for i in range(600)]
    rows += [*ODD, (20, "a ▁b"), (21, "▁"), (22, "日本" * 4000), (23, "   ")]
    got = token_alignment.align(frame(spark, rows), queries.tokenizer("byte_bpe_50k.json"),
                                queries.tokenizer("piece_bpe_32k.model"), pack_bytes=3000)
    assert rows_of(got) == aligned(rows)


def test_alignment_of_documents(spark):
    assert rows_of(queries.op13_token_alignment(spark, SF)) == aligned(sample(spark))
    empty = frame(spark, ODD).limit(0)
    assert token_alignment.align(empty, queries.tokenizer("byte_bpe_50k.json"),
                                 queries.tokenizer("piece_bpe_32k.model")).count() == 0


# --- ids of texts that hold special tokens (3 and 6)

@pytest.mark.parametrize("name, cut", [("word_bpe_49k.json", encode.WORDS), ("byte_bpe_50k.json", encode.SPACES)])
def test_special_strings_are_those_of_the_library(name, cut):
    from tokenizers import Tokenizer

    end, start, upper = "<|endoftext|>", "<|startoftext|>", "<|EndOfText|>"
    texts = [f"see {end} here", end, f"{end}{end}", f"{start} a{end}", f"at the end {end}", "plain text", "", f"{upper} x",
             f"a{start[:-1]}", "é" + end + "ü", f" {end} ", f"{end}\n{start}\n"]
    plain, e = Tokenizer.from_file(queries.tokenizer(name)), encode.Encoder(queries.tokenizer(name), cut)
    raw = [t.encode() for t in texts]
    ids, rows = e.encode(np.frombuffer(b"".join(raw), np.uint8), np.cumsum([0] + [len(x) for x in raw]))
    for k, t in enumerate(texts):
        assert ids[rows[k]:rows[k + 1]].tolist() == plain.encode(t, add_special_tokens=False).ids, t
