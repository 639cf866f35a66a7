"""Token ids of whole texts, each distinct piece encoded once per worker.

The library's ``encode`` of a text equals the joined ``encode`` of its pieces
when the cuts are places no pre-token spans. The pieces repeat, so a memo of
(piece hash, ids) kept by the Python worker encodes each of them once. It is
bounded by ``MEMO`` pieces, or by the distinct pieces of one slice if these are
more, then starts afresh. Texts that hold the string of a
special token, in any case, go to the library whole, so it gets its id or not
just as there.
"""

from __future__ import annotations

import os

import numpy as np

from slipway.llm.arrays import LOWER, SPACE, distinct, hash_spans

MEMO = 1_000_000
JOIN = 500

#: bytes that surely start a character other than white space
SOLID = np.zeros(256, bool)
SOLID[[*range(0x21, 0x7F), *range(0xC3, 0xE0), *range(0xE4, 0xF5)]] = True
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(65, 91), *range(97, 123)]] = True
_SIGN = np.zeros(256, bool)
_SIGN[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True


def letters(data: np.ndarray) -> np.ndarray:
    """Bytes of ASCII letters and of the letters among U+00C0 to U+00FF."""
    found = _ASCII_LETTER[data]
    lead = np.flatnonzero(data[:-1] == 0xC3)
    lead = lead[(data[lead + 1] != 0x97) & (data[lead + 1] != 0xB7)]
    found[lead] = found[lead + 1] = True
    return found


class Cut:
    """Pieces (starts, ends, piece offsets of rows), and which are of letters alone.

    A letter and an ASCII sign after it never share a pre-token.
    """

    def at(self, data, offsets, letter):
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        if len(data):
            cut[1:-1] |= letter[:-1] & _SIGN[data[1:]]
        return cut


class WordCut(Cut):
    """For pre-tokenizers that drop white space and lower the case: ASCII white space separates pieces."""

    glue, mark_at_end = b" ", True

    def marks(self, token: str) -> bool:
        return token.endswith("</w>")

    def __call__(self, data, offsets):
        data = LOWER[data]
        letter, cut, space = letters(data), None, SPACE[data]
        cut = self.at(data, offsets, letter)
        cut[1:-1] |= space[1:] != space[:-1]
        at = np.flatnonzero(cut)
        starts, ends = at[:-1], at[1:]
        full = ~space[starts] if len(starts) else np.zeros(0, bool)
        starts, ends = starts[full], ends[full]
        total = np.concatenate([[0], np.cumsum(letter)])
        return data, starts, ends, np.searchsorted(starts, offsets), total[ends] - total[starts] == ends - starts


class SpaceCut(Cut):
    """For byte-level pre-tokenizers whose pre-tokens take at most one space, in front.

    Cuts also stand before a space that a solid character follows, and on
    both sides of a line end between two solid characters.
    """

    glue, mark_at_end = b"", False

    def marks(self, token: str) -> bool:
        return token.startswith("\u0120")  # the sign of a space

    def __call__(self, data, offsets):
        letter = letters(data)
        cut = self.at(data, offsets, letter)
        if len(data) > 2:
            solid = SOLID[data]
            cut[:-2] |= (data[:-1] == 32) & solid[1:]
            line = np.flatnonzero((data[1:-1] == 10) & solid[2:] & solid[:-2] & (data[:-2] < 0x7F)) + 1
            cut[line] = cut[line + 1] = True
        at = np.flatnonzero(cut)
        starts, ends = at[:-1], at[1:]
        total = np.concatenate([[0], np.cumsum(letter)])
        plain = (ends - starts > 1) & (total[ends] - total[starts] == ends - starts - 1)
        plain &= data[starts] == 32 if len(starts) else False
        return data, starts, ends, np.searchsorted(at, offsets), plain


WORDS, SPACES = WordCut(), SpaceCut()


def ragged(starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions starts[i] .. starts[i] + size[i] - 1 for all i, one after the other."""
    first = np.cumsum(size) - size
    return np.arange(int(size.sum())) + np.repeat(starts - first, size)


class Encoder:
    def __init__(self, path: str, cut: Cut, memo: int = MEMO):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.cut, self.memo = cut, memo
        vocab = self.tokenizer.get_vocab()
        if max(vocab.values()) >= 1 << 16:
            raise ValueError("ids are kept in 16 bits")
        self.marks = np.zeros(1 << 16, bool)
        self.marks[[i for t, i in vocab.items() if cut.marks(t)]] = True
        self.clear()

    def clear(self):
        self.keys, self.at = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.size, self.ids, self.used = np.zeros(0, np.int32), np.zeros(1 << 16, np.uint16), 0

    def learn(self, keys: np.ndarray, pieces: list[bytes], plain: np.ndarray) -> None:
        """Keeps the ids of pieces, whose keys are new and in order."""
        ids, size = self.fresh(pieces, plain)
        total = len(ids)
        if self.used + total > len(self.ids):
            self.ids = np.resize(self.ids, max(2 * len(self.ids), self.used + total))
        self.ids[self.used:self.used + total] = ids
        at = self.used + np.cumsum(size) - size
        self.used += total
        where = np.searchsorted(self.keys, keys)
        self.keys, self.at, self.size = (np.insert(a, where, b) for a, b in
                                         ((self.keys, keys), (self.at, at), (self.size, size)))

    def fresh(self, pieces: list[bytes], plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces, and how many each has.

        A plain piece is one pre-token with one marked id, the first or the
        last. So ``JOIN`` of them are encoded at a time, joined as they were cut.
        """
        rest, plain = np.flatnonzero(~plain), np.flatnonzero(plain)
        here = [pieces[i] for i in plain.tolist()]
        joined = [self.cut.glue.join(here[k:k + JOIN]).decode() for k in range(0, len(here), JOIN)]
        got = [np.array(x.ids, np.uint16) for x in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)]
        ids = np.concatenate(got) if got else np.zeros(0, np.uint16)
        mark = np.flatnonzero(self.marks[ids])
        if len(mark) != len(plain):
            raise ValueError("joined pieces can't be told apart")
        sizes = np.zeros(len(pieces), np.int64)
        sizes[plain] = np.diff(mark, prepend=-1) if self.cut.mark_at_end else np.diff(mark, append=len(ids))
        other = [x.ids for x in self.tokenizer.encode_batch_fast([pieces[i].decode() for i in rest.tolist()],
                                                                 add_special_tokens=False)]
        sizes[rest] = [len(x) for x in other]
        out, first = np.zeros(int(sizes.sum()), np.uint16), np.cumsum(sizes) - sizes
        out[ragged(first[plain], sizes[plain])] = ids
        out[ragged(first[rest], sizes[rest])] = np.fromiter((i for x in other for i in x), np.uint16)
        return out, sizes

    def with_special(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Rows that hold the string of a special token."""
        raw, rows = LOWER[data].tobytes(), set()
        for token in self.special:
            at = raw.find(token)
            while at >= 0:
                row = int(np.searchsorted(offsets, at, "right")) - 1
                if inside := at + len(token) <= offsets[row + 1]:
                    rows.add(row)
                at = raw.find(token, int(offsets[row + 1]) if inside else at + 1)
        return np.array(sorted(rows), np.int64)

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the rows in order, and the offsets of the rows in them."""
        special = self.with_special(data, offsets)
        if not len(special):
            return self._encode(data, offsets)
        size = np.diff(offsets)
        size[special] = 0
        ids, rows = self._encode(data[ragged(offsets[:-1], size)], np.concatenate([[0], np.cumsum(size)]))
        parts, done = [], 0
        for row in special.tolist():
            text = data[offsets[row]:offsets[row + 1]].tobytes().decode()
            got = np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint16)
            parts += [ids[done:rows[row]], got]
            done = rows[row]
        count = np.diff(rows)
        count[special] = [len(x) for x in parts[1::2]]
        return np.concatenate([*parts, ids[done:]]), np.concatenate([[0], np.cumsum(count)])

    def _encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        data, starts, ends, rows, plain = self.cut(data, offsets)
        keys, some, number = distinct(hash_spans(data, starts, ends))
        raw = data.tobytes()

        def learn(which):
            i = some[which]
            self.learn(keys[which], [raw[a:b] for a, b in zip(starts[i].tolist(), ends[i].tolist())], plain[i])

        new = np.flatnonzero(~self._known(keys))
        if len(self.keys) + len(new) > self.memo:  # the memo starts afresh, with all pieces of this slice
            self.clear()
            new = np.arange(len(keys))
        if len(new):
            learn(new)
        slot = np.searchsorted(self.keys, keys)[number]
        size = self.size[slot].astype(np.int64)
        total = np.zeros(len(size) + 1, np.int64)
        np.cumsum(size, out=total[1:])
        return self.ids[ragged(self.at[slot], size)], total[rows]

    def _known(self, keys):
        if not len(self.keys):
            return np.zeros(len(keys), bool)
        return self.keys[np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)] == keys


_ENCODERS: dict = {}


def encoder(path: str, cut: Cut) -> Encoder:
    """The worker's encoder; a worker keeps one memo at a time."""
    key = path, type(cut)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = Encoder(path, cut)
    return _ENCODERS[key]
