"""Alignment of two tokenizers over the same text, from their spans.

A is a byte-level BPE of the tokenizers library, B a sentencepiece model with
byte fallback. Both see one space and the text (B adds its space itself). A's
character offsets and B's spans in the model's proto are coarse cuts: a token
whose span has as many bytes as the token is cut there. Tokens that share a
character, as byte-fallback tokens and parts of a multibyte character do, have
the same span or an empty one; their cuts are refined by the bytes that each
token decodes to. Coarse and refined cuts must agree, and the decoded bytes
must be those of the text, else the text has no tokens.

Texts are cut at single spaces between solid characters: no pre-token of A and
no entry of B's vocabulary (checked when it is loaded) reaches across, so both
tokenizers give there what they give in the whole text, and both have a token
end. Each distinct piece is tokenised and aligned once, ``JOIN`` of them as one
text, as they were cut, and kept by the worker with its groups and links, up to
``MEMO`` pieces or those of one slice, then afresh.

The number of documents that hold a linked pair of ids is counted over all
documents: each pack of about ``PACK`` bytes of text sends each of its pairs
once, with the number of its documents, so the most frequent pair is one row per
pack; counts and each A id's highest come back by a join on the pair, which AQE
can split, and are summed up per document in its pack.

Edge cases: null and empty texts, and texts that don't come back from both
tokenizers (U+2581), have no tokens: zeros, and an empty ``groups_sha256``;
strings of special tokens are plain text; a text of any length is taken whole;
repeated rows count as documents of their own; an empty table gives an empty
result; only id and text are read, other columns can have any name.
"""

from __future__ import annotations

import hashlib
import os
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slipway.llm.arrays import chunks, distinct, hash_spans
from slipway.llm.encode import SOLID, ragged
from slipway.llm.stored import stored
from slipway.llm.texts import listed

PACK = 4 << 20
JOIN = 200
MEMO = 500_000
MARK = "▁".encode()
ALIGNED = ("pack long, ids array<bigint>, n_a array<bigint>, n_b array<bigint>, n_groups array<bigint>, "
           "n_links array<bigint>, groups array<string>, pairs array<bigint>, holders array<int>, "
           "links binary, repeats binary, rows binary")
FIELDS = "n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def byte_table() -> dict[str, int]:
    """The byte of each character of a byte-level vocabulary: printable ones stand for themselves."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Decoded:
    """The bytes of each token of a vocabulary, one after the other."""

    def __init__(self, tokens: list[bytes]):
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.at = np.cumsum(self.size) - self.size
        self.data = np.frombuffer(b"".join(tokens), np.uint8)

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        return self.data[ragged(self.at[ids], self.size[ids])]


class Tokens:
    """Tokens of all pieces in order: ids, ends as bytes of the joined pieces, token offsets of pieces, good pieces."""

    def __init__(self, ids, ends, rows, good):
        self.ids, self.ends, self.rows, self.good = ids, ends, rows, good


def refined(ids, begins, stops, rows, vocabulary: Decoded, data: np.ndarray, offsets: np.ndarray) -> Tokens:
    """Cuts from coarse spans (bytes of ``data``) and decoded bytes.

    A piece is good if its tokens decode to its bytes and no whole token's span says otherwise.
    """
    size = vocabulary.size[ids]
    total = np.zeros(len(ids) + 1, np.int64)
    np.cumsum(size, out=total[1:])
    inside = total[1:] - np.repeat(total[rows[:-1]], np.diff(rows)) + np.repeat(offsets[:-1], np.diff(rows))
    whole = stops - begins == size
    wrong = whole & (stops != inside)
    total_wrong = np.concatenate([[0], np.cumsum(wrong)])
    length = total[rows[1:]] - total[rows[:-1]]
    good = (length == np.diff(offsets)) & (total_wrong[rows[1:]] == total_wrong[rows[:-1]])
    if not good.all():  # compare the bytes of the pieces whose lengths fit
        some = np.flatnonzero(good)
    else:
        some = np.arange(len(good))
    tokens = ragged(rows[some], np.diff(rows)[some])
    differ = vocabulary.bytes_of(ids[tokens]) != data[ragged(offsets[some], np.diff(offsets)[some])]
    if differ.any():
        bad = np.searchsorted(np.cumsum(np.diff(offsets)[some]), np.flatnonzero(differ), "right")
        good[some[np.unique(bad)]] = False
    return Tokens(ids, np.where(whole, stops, inside), rows, good)


class Aligner:
    """Both tokenizers of a Python worker."""

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        table, vocab = byte_table(), self.a.get_vocab()
        names = [""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            names[i] = token
        self.bytes_a = Decoded([bytes(table[c] for c in t) if all(c in table for c in t) else t.encode() for t in names])
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        if any("▁" in p.lstrip("▁") for p in pieces):
            raise ValueError("an entry of the vocabulary reaches across a space")
        self.bytes_b = Decoded([bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                                for i, p in enumerate(pieces)])

    def tokens_a(self, pieces: list[str], data: np.ndarray, offsets: np.ndarray) -> Tokens:
        ids, spans, sizes = [], [], []
        for k in range(0, len(pieces), 64):
            for e in self.a.encode_batch(pieces[k:k + 64], add_special_tokens=False):
                ids += e.ids
                spans += e.offsets
                sizes.append(len(e))
        rows = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        ids, spans = np.array(ids, np.int64), np.array(spans, np.int64).reshape(-1, 2)
        # characters to bytes: the place of each character's first byte, over all pieces
        first = np.append(np.flatnonzero((data & 0xC0) != 0x80), len(data))
        base = np.repeat(np.searchsorted(first, offsets[:-1]), np.diff(rows))
        return refined(ids, first[base + spans[:, 0]], first[base + spans[:, 1]], rows, self.bytes_a, data, offsets)

    def tokens_b(self, pieces: list[str], data: np.ndarray, offsets: np.ndarray) -> Tokens:
        found, rows = [], [0]
        for text in pieces:
            found += [(p.id, p.begin, p.end) for p in self.b.encode(text[1:], return_type="proto").pieces]
            rows.append(len(found))
        ids, begins, stops = np.array(found, np.int64).reshape(-1, 3).T
        rows = np.array(rows, np.int64)
        # spans count from behind the space that the model adds; the first token's begins with it
        at = np.repeat(offsets[:-1], np.diff(rows)) + 1
        begins, stops = begins + at, stops + at
        full = np.diff(rows) > 0
        begins[rows[:-1][full]] = offsets[:-1][full]
        return refined(ids, begins, stops, rows, self.bytes_b, data, offsets)


def spaced(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every row after one space; empty rows stay empty."""
    size = np.diff(offsets)
    more = np.concatenate([[0], np.cumsum(size > 0)])
    out = np.full(len(data) + int(more[-1]), 32, np.uint8)
    out[np.arange(len(data)) + np.repeat(more[1:], size)] = data
    return out, offsets + more


def pieces_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where pieces start (and the end of all), and the piece offsets of rows."""
    cut = np.zeros(len(data) + 1, bool)
    cut[offsets] = True
    if len(data) > 2:
        cut[1:-2] |= (data[1:-1] == 32) & (data[:-2] != 32) & SOLID[data[2:]]
    at = np.flatnonzero(cut)
    return at, np.searchsorted(at, offsets)


def overlaps(a: Tokens, b: Tokens, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token numbers of all pairs whose bytes overlap. ``start`` is where the pieces begin."""
    def begins(t):
        out = np.zeros(len(t.ends), np.int64)
        out[1:] = t.ends[:-1]
        full = np.diff(t.rows) > 0
        out[t.rows[:-1][full]] = start[:-1][full]
        return out

    first = np.searchsorted(b.ends, begins(a), "right")
    last = np.searchsorted(begins(b), a.ends, "left")
    count = np.maximum(last - first, 0)
    return np.repeat(np.arange(len(a.ids)), count), ragged(first, count)


def by_piece(t: Tokens, cuts: np.ndarray, offsets: np.ndarray) -> Tokens | None:
    """Tokens of joined pieces by piece, none of bad ones; None if good and bad pieces were joined or a cut is no end."""
    size = np.diff(t.rows)
    if not t.good.all():
        if (np.diff(cuts)[~t.good] > 1).any():
            return None
        some = ragged(t.rows[:-1], np.where(t.good, size, 0))
        t = Tokens(t.ids[some], t.ends[some], t.rows, t.good)
    rows, good = np.searchsorted(t.ends, offsets, "right"), np.repeat(t.good, np.diff(cuts))
    if (np.append(0, t.ends)[rows[1:]][good] != offsets[1:][good]).any():
        return None
    return Tokens(t.ids, t.ends, rows, good)


class Aligned:
    """Groups and links of the distinct pieces of a slice."""

    def __init__(self, both: Aligner, raw: list[bytes], plain: int):
        """The first ``plain`` pieces are a space, a solid character and more, without a space at the end or U+2581."""
        data = np.frombuffer(b"".join(raw), np.uint8)
        offsets = np.concatenate([[0], np.cumsum([len(x) for x in raw])]).astype(np.int64)
        for joined in (plain, 0):
            cuts = np.concatenate([np.arange(0, joined, JOIN), np.arange(joined, len(raw) + 1)])
            ends = offsets[cuts]
            whole = data.tobytes()
            texts = [whole[x:y].decode() for x, y in zip(ends[:-1].tolist(), ends[1:].tolist())]
            a, b = (by_piece(t(texts, data, ends), cuts, offsets) for t in (both.tokens_a, both.tokens_b))
            if a is not None and b is not None:
                break
        self.good = a.good & b.good
        self._keep(a)
        self._keep(b)
        self.n_a, self.n_b = np.diff(a.rows), np.diff(b.rows)
        x, y = overlaps(a, b, offsets)
        self.links = a.ids[x] << 32 | b.ids[y]
        self.rows = np.searchsorted(x, a.rows)
        self._group(a, b)

    def _keep(self, t: Tokens) -> None:
        """Only tokens of good pieces are left."""
        if not self.good.all():
            size = np.where(self.good, np.diff(t.rows), 0)
            some = ragged(t.rows[:-1], size)
            t.ids, t.ends, t.rows = t.ids[some], t.ends[some], np.concatenate([[0], np.cumsum(size)])

    def _group(self, a: Tokens, b: Tokens) -> None:
        """Per piece, the number of its groups and their text."""
        shared = np.intersect1d(a.ends, b.ends, assume_unique=True)
        cut_a, cut_b = np.searchsorted(a.ends, shared) + 1, np.searchsorted(b.ends, shared) + 1
        names_a, names_b = list(map(str, a.ids.tolist())), list(map(str, b.ids.tolist()))
        lo_a, lo_b = [0, *cut_a[:-1].tolist()], [0, *cut_b[:-1].tolist()]
        groups = [",".join(names_a[i:j]) + "|" + ",".join(names_b[k:m])
                  for i, j, k, m in zip(lo_a, cut_a.tolist(), lo_b, cut_b.tolist())] if len(shared) else []
        rows = np.searchsorted(cut_a, a.rows, "right")
        rows[0] = 0
        self.n_groups = np.diff(rows)
        self.texts = [";".join(groups[i:j]) for i, j in zip(rows[:-1].tolist(), rows[1:].tolist())]


class Found(NamedTuple):
    """The pieces of a slice: ``links`` from ``rows[k]`` on are those of piece k."""

    good: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    rows: np.ndarray
    links: np.ndarray
    texts: list[str]


class Memo:
    """Aligned pieces that a worker has seen, found by their hash."""

    def __init__(self, both: Aligner, most: int = MEMO):
        self.both, self.most = both, most
        self.clear()

    def clear(self) -> None:
        self.keys, self.slot = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.counts = np.zeros((5, 0), np.int64)  # good, n_a, n_b, n_groups, n_links
        self.at, self.links, self.texts = np.zeros(0, np.int64), np.zeros(0, np.int64), []

    def found(self, keys: np.ndarray, bytes_of) -> Found:
        """What is known of the pieces of these distinct keys in order; ``bytes_of`` gives those at some places."""
        new = np.flatnonzero(~np.isin(keys, self.keys, assume_unique=True))
        if len(self.keys) + len(new) > self.most:  # afresh, with all pieces of this slice
            self.clear()
            new = np.arange(len(keys))
        if len(new):
            self.learn(keys[new], bytes_of(new))
        slot = self.slot[np.searchsorted(self.keys, keys)]
        counts = self.counts[:, slot]
        rows = np.concatenate([[0], np.cumsum(counts[4])])
        texts = self.texts
        return Found(counts[0] > 0, *counts[1:4], rows, self.links[ragged(self.at[slot], counts[4])],
                     [texts[k] for k in slot.tolist()])

    def learn(self, keys: np.ndarray, pieces: list[bytes]) -> None:
        plain = np.array([SOLID[p[1]] and p[-1] != 32 and MARK not in p if len(p) > 1 else False for p in pieces], bool)
        order = np.argsort(~plain, kind="stable")
        x = Aligned(self.both, [pieces[k] for k in order.tolist()], int(plain.sum()))
        slot = np.empty(len(order), np.int64)
        slot[order] = np.arange(len(self.texts), len(self.texts) + len(order))
        where = np.searchsorted(self.keys, keys)
        self.keys, self.slot = np.insert(self.keys, where, keys), np.insert(self.slot, where, slot)
        self.at = np.concatenate([self.at, x.rows[:-1] + len(self.links)])
        self.links = np.concatenate([self.links, x.links])
        self.counts = np.concatenate([self.counts, [x.good, x.n_a, x.n_b, x.n_groups, np.diff(x.rows)]], 1)
        self.texts += x.texts


_MEMOS: dict = {}


def memo_of(path_a: str, path_b: str) -> Memo:
    """The worker's memo; a worker keeps one at a time."""
    if (path_a, path_b) not in _MEMOS:
        _MEMOS.clear()
        _MEMOS[path_a, path_b] = Memo(Aligner(path_a, path_b))
    return _MEMOS[path_a, path_b]


def align_slice(memo: Memo, data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray | list]:
    """Columns per row of a slice, and its distinct linked pairs by row."""
    data, offsets = spaced(data, offsets)
    at, rows = pieces_of(data, offsets)
    keys, some, number = distinct(hash_spans(data, at[:-1], at[1:]))
    raw = data.tobytes()
    found = memo.found(keys, lambda which: [raw[x:y] for x, y in zip(at[some[which]].tolist(), at[some[which] + 1].tolist())])
    owner = np.repeat(np.arange(len(rows) - 1), np.diff(rows))
    bad = np.zeros(len(rows) - 1, bool)
    bad[owner[~found.good[number]]] = True
    keep = ~bad[owner]

    def total(values):
        return np.bincount(owner[keep], values[number[keep]], len(rows) - 1).astype(np.int64)

    out = {"n_a": total(found.n_a), "n_b": total(found.n_b), "n_groups": total(found.n_groups),
           "n_links": total(np.diff(found.rows))}
    numbers, out["groups"] = number.tolist(), []
    for a, b, no in zip(rows[:-1].tolist(), rows[1:].tolist(), bad.tolist()):
        text = ";".join([found.texts[k] for k in numbers[a:b]]) if b > a and not no else None
        out["groups"].append(hashlib.sha256(text.encode()).hexdigest() if text is not None else "")
    keys, pair_of = np.unique(found.links, return_inverse=True)
    # a piece's links count as often as the row holds the piece
    held, times = np.unique(owner[keep] * np.int64(len(some)) + number[keep], return_counts=True)
    row, piece = held // max(1, len(some)), held % max(1, len(some))
    size = np.diff(found.rows)[piece]
    link = np.repeat(row, size) * np.int64(max(1, len(keys))) + pair_of[ragged(found.rows[piece], size)]
    link, back = np.unique(link, return_inverse=True)
    repeats = np.bincount(back, np.repeat(times, size), len(link)).astype(np.int64)
    out |= {"pairs": keys, "row": link // max(1, len(keys)), "link": link % max(1, len(keys)), "repeats": repeats}
    return out


def align(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text",
          pack_bytes: int = PACK) -> DataFrame:
    """One row per row of ``docs``: id and ``FIELDS``."""
    kind = docs.schema[id_col].dataType.simpleString()

    def first(batches):
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch.column(1), pack_bytes):
                x = align_slice(memo_of(path_a, path_b), data, offsets)
                used, link = np.unique(x["link"], return_inverse=True)
                holders = np.bincount(link, minlength=len(used))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), listed(batch.column(0).slice(lo, hi - lo)),
                     *(listed(pa.array(x[c])) for c in ("n_a", "n_b", "n_groups", "n_links")),
                     listed(pa.array(x["groups"], pa.string())), listed(pa.array(x["pairs"][used])),
                     listed(pa.array(holders, pa.int32())), pa.array([link.astype("<u4").tobytes()]),
                     pa.array([x["repeats"].astype("<u4").tobytes()]),
                     pa.array([np.searchsorted(x["row"], np.arange(hi - lo + 1)).astype("<i8").tobytes()])],
                    ["pack", "ids", "n_a", "n_b", "n_groups", "n_links", "groups", "pairs", "holders", "links", "repeats",
                     "rows"])
                number += 1

    def last(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                def column(name):
                    return batch.column(name).slice(k, 1).flatten()

                def numbers(name, kind):
                    return np.frombuffer(batch.column(name)[k].as_buffer(), kind).astype(np.int64)

                links, repeats, rows = numbers("links", "<u4"), numbers("repeats", "<u4"), numbers("rows", "<i8")
                told = column("told")
                place, count = (told.field(f).to_numpy(zero_copy_only=False) for f in ("place", "n"))
                counts, best = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
                counts[place] = count
                best[place] = told.field("best").to_numpy(zero_copy_only=False).astype(np.int64)

                def total(values):
                    sums = np.zeros(len(links) + 1, np.int64)
                    np.cumsum(values[links] * repeats, out=sums[1:])
                    return pa.array(sums[rows[1:]] - sums[rows[:-1]])

                yield pa.RecordBatch.from_arrays(
                    [column("ids"), *(column(c) for c in ("n_a", "n_b", "n_groups", "n_links")), total(best), total(counts),
                     column("groups")], [id_col, *(f.split()[0] for f in FIELDS.split(", "))])

    packs = stored(docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(first, ALIGNED),
                   "aligned")
    pairs = packs.select("pack", F.posexplode(F.arrays_zip("pairs", "holders")).alias("place", "x")) \
        .select("pack", "place", F.col("x.pairs").alias("pair"), F.col("x.holders").alias("holders"))
    counts = stored(pairs.groupBy("pair").agg(F.sum("holders").alias("n")), "counts")
    a = F.shiftright("pair", 32)
    highest = counts.groupBy(a.alias("a")).agg(F.max("n").alias("most"))
    counts = counts.withColumn("a", a).join(highest, "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))
    told = pairs.join(counts, "pair").groupBy("pack").agg(F.collect_list(F.struct("place", "n", "best")).alias("told"))
    return packs.drop("pairs", "holders").join(told, "pack", "left") \
        .mapInArrow(last, f"{id_col} long, {FIELDS}").withColumn(id_col, F.col(id_col).cast(kind))
