"""N-gram Jaccard self-join of documents by T-occurrence search.

A document is its set of word shingles (64-bit hashes). Documents with equal
sets form a class, searched once. Every class takes part; exact bounds decide
where classes meet:

1. Two sets that are similar enough share, among the smallest hashes of each
   (its head), a known number of hashes. Heads are dealt by hash into inverted
   lists; a class with too few hashes in lists of two or more has no partner.
2. The rest meet in the shortest lists that any partner must share one of.
   Two classes of a list may be similar only if their sizes allow it and their
   bitmaps (parities of the hashes of the whole set by their last bits) differ
   in no more places than the sets may differ in hashes. Classes connected
   through such pairs form a cluster.
3. The whole sets of a cluster are dealt in blocks of a bounded size, each to
   one task. There the T-occurrence search runs (DivideSkip): for each set, the
   shortest of its inverted lists are merged and counted, the longest are only
   probed by binary search for the candidates that can still reach the required
   overlap.
4. Clusters of several blocks go on. Some members of each large component meet
   the same way, until that links no more of them. Then every two blocks whose
   sizes allow a link meet in one task, but for two blocks of one component:
   a group of d near copies of one text is copied for the few members that are
   not linked yet, not d times.

A task gives the links that connect its documents, and none between documents
already connected there, so a group of g near copies gives about g links and
not g * g. No link between two components is lost.

Edge cases: a null or empty text has no shingles and is linked with nothing; a
text with fewer words than a shingle has one, all of them; equal rows are one
class; a null id gets a null component and is linked with nothing; rows that
share an id count as one document in ``component_id``; an empty table gives an
empty result; only the id and text are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slipway.llm.arrays import LOWER, chunks, hash_spans, mix, tokens, windows
from slipway.llm.components import components
from slipway.llm.stored import stored

BLOCK_DOCUMENTS = 512
BLOCK_SHINGLES = 1_000_000
POSTINGS_PER_BUCKET = 1 << 17
SPEAKERS = 4
_A, _B = np.uint64(0x8EBC6AF09C88C6E3), np.uint64(0x589965CC75374CC3)
BITMAP_WORDS = 64
PAIRS_AT_ONCE = 1 << 18
SHORT_LIST = 64


# --- bounds ---------------------------------------------------------------------

def least_overlap(n, percent: int):
    """Shingles that a set of n shares with any partner."""
    return -(-percent * n // 100)


def pair_overlap(a, b, percent: int):
    """Shingles that sets of a and b must share."""
    return -(-percent * (a + b) // (100 + percent))


def head(n, percent: int):
    """(prefix, extra): a partner shares one of the ``prefix`` smallest hashes, and more than
    ``min(extra of both)`` of the ``prefix + extra`` smallest."""
    prefix = n - least_overlap(n, percent) + 1
    return prefix, np.minimum(-(-prefix // 2), n - prefix)


def may_differ(a, b, percent: int):
    """Hashes that are in one of two similar sets of a and b alone, at most."""
    return a + b - 2 * pair_overlap(a, b, percent)


def bitmap_words(n, percent: int):
    """64-bit words of the bitmap of a set of n, a power of two: wide enough that bitmaps of unlike sets, which differ
    in about half their bits, differ in more than similar sets may."""
    bits = 64 << np.arange(BITMAP_WORDS.bit_length())
    return 1 << np.minimum(np.searchsorted(bits / 2 - 2 * np.sqrt(bits), 1.1 * may_differ(n, n, percent)),
                           BITMAP_WORDS.bit_length() - 1)


# --- sets -----------------------------------------------------------------------

def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each row, ascending, and their row offsets."""
    data = LOWER[data]
    starts, ends, rows = tokens(data, offsets)
    h, at = windows(hash_spans(data, starts, ends), rows, words)
    row = np.repeat(np.arange(len(at) - 1, dtype=np.uint16), np.diff(at))
    order = np.argsort(h)
    order = order[np.argsort(row[order], kind="stable")]
    h, row = h[order], row[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    h, row = h[new], row[new]
    return h, np.searchsorted(row, np.arange(len(at)))


def digests(h: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    out = np.zeros(len(at) - 1, np.uint64), np.zeros(len(at) - 1, np.uint64)
    full = np.flatnonzero(np.diff(at))
    if len(full):
        out[0][full] = np.add.reduceat(mix(h ^ _A), at[full])
        out[1][full] = np.bitwise_xor.reduceat(mix(h ^ _B), at[full])
    return out


def spans(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Places of ``size`` cells from ``first`` on, one span after the other."""
    return np.arange(int(size.sum())) + np.repeat(first - np.cumsum(size) + size, size)


def bitmaps(h: np.ndarray, row: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Bitmaps of the rows one after the other: bit k is the parity of the row's hashes that are k modulo its bits.

    A bitmap folds to half the bits by xor of its halves.
    """
    out = np.zeros(int(width.sum()), np.uint64)
    bit = h & (width[row].astype(np.uint64) * np.uint64(64) - np.uint64(1))
    np.bitwise_xor.at(out, (np.cumsum(width) - width)[row] + (bit >> np.uint64(6)).astype(np.int64),
                      np.uint64(1) << (bit & np.uint64(63)))
    return out


def described(docs: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n, two digests of the set, and the head and bitmap of the first row with an id and that set in a task."""
    def describe(batches):
        seen: set = set()
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch.column(1)):
                h, at = shingle_sets(data, offsets, words)
                n = np.diff(at)
                a, b = digests(h, at)
                prefix, extra = head(n, percent)
                take = np.where(n > 0, prefix + extra, 0)
                named = batch.column(0).slice(lo, hi - lo).is_valid().to_pylist()
                for i, k in enumerate(zip(a.tolist(), b.tolist())):
                    if k in seen or not named[i]:  # rows without an id are in no class
                        take[i] = 0
                    elif len(seen) < 1_000_000:  # only saves work: classes are found below
                        seen.add(k)
                cells = spans(at[:-1], take)
                width = np.where(take > 0, bitmap_words(n, percent), 0)
                whole = np.where(take > 0, n, 0)
                bits = bitmaps(h[spans(at[:-1], whole)], np.repeat(np.arange(len(n)), whole), width).view(np.int64)
                listed = lambda size, x: pa.ListArray.from_arrays(
                    pa.array(np.append(0, np.cumsum(size)).astype(np.int32)), pa.array(x))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), pa.array(n), pa.array(a.view(np.int64)),
                     pa.array(b.view(np.int64)), listed(take, h[cells].view(np.int64)), listed(width, bits)],
                    ["doc_id", "n", "a", "b", "head", "bits"])

    return docs.select(F.col(id_col).cast("long"), text_col).mapInArrow(
        describe, "doc_id long, n long, a long, b long, head array<long>, bits array<long>")


# --- where classes meet -----------------------------------------------------------

PACKED = "bucket int, keys binary, tokens binary, counts binary, bits binary"


def _dealt(by: np.ndarray, buckets: int, keys, tokens_=None, counts=None, bits=None, first=None, width=None):
    """Rows of ``PACKED``: the arrays split by ``by`` modulo ``buckets``; of ``bits``, spans of ``width`` from ``first``."""
    bucket = (by % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    full, cut = np.unique(bucket[order], return_index=True)
    ranges = list(zip(cut.tolist(), [*cut[1:].tolist(), len(order)]))
    parts = lambda x: pa.array([None if x is None else x[order[a:b]].tobytes() for a, b in ranges],
                               pa.binary())
    maps = pa.array([None if bits is None else bits[spans(first[order[a:b]], width[order[a:b]])].tobytes()
                     for a, b in ranges], pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(full.astype(np.int32)), parts(keys), parts(tokens_), parts(counts), maps],
        ["bucket", "keys", "tokens", "counts", "bits"])


def _buckets(batches):
    """Bucket by bucket, the rows of a partition sorted by bucket."""
    last, rows = None, []
    for batch in batches:
        for b, *row in zip(*(batch.column(c).to_pylist() for c in ("bucket", "keys", "tokens", "counts", "bits"))):
            if b != last and rows:
                yield rows
                rows = []
            last = b
            rows.append(row)
    if rows:
        yield rows


def _join(parts, kind):
    return np.frombuffer(b"".join(parts), kind)


def _groups(sorted_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and sizes of runs."""
    first = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1])) if len(sorted_) else np.zeros(0, np.int64)
    return first, np.diff(np.append(first, len(sorted_)))


class Bitmaps:
    """Sizes and bitmaps of some sets."""

    def __init__(self, n, words, first, width, percent: int):
        self.n, self.words, self.first, self.width, self.percent = n, words, first, width, percent

    def similar(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether sets x and y, pair by pair, may be similar; x are no larger than y."""
        ok = self.percent * self.n[y] <= 100 * self.n[x]
        least = may_differ(self.n[x], self.n[y], self.percent)
        for w in np.unique(self.width[x[ok]]).tolist():
            for wide in (w, 2 * w):  # sizes of similar sets are near each other, so bitmaps are as wide or twice that
                here = np.flatnonzero(ok & (self.width[x] == w) & (self.width[y] == wide))
                for lo in range(0, len(here), step := max(1, PAIRS_AT_ONCE // w)):
                    part = here[lo:lo + step]
                    a = self.words[self.first[x[part], None] + np.arange(w)]
                    b = self.words[self.first[y[part], None] + np.arange(wide)]
                    b = b[:, :w] ^ b[:, w:] if wide > w else b
                    ok[part] = np.bitwise_count(a ^ b).sum(1, dtype=np.int64) <= least[part]
        return ok


def compatible(keys: np.ndarray, toks: np.ndarray, maps: Bitmaps):
    """Pairs of keys that connect all in a list that may be similar; lists are runs of toks, ascending in size."""
    first, size = _groups(toks)
    yield np.zeros((0, 2), np.int64)
    short = np.flatnonzero((size > 1) & (size <= SHORT_LIST))
    later = np.cumsum(size[short] * (size[short] - 1) // 2)
    cuts = np.searchsorted(later, np.arange(0, int(later[-1]) if len(short) else 0, PAIRS_AT_ONCE))
    for lo, hi in zip(cuts, [*cuts[1:], len(short)]):
        lists = short[lo:hi]
        x = spans(first[lists], size[lists])
        after = np.repeat(first[lists] + size[lists], size[lists]) - x - 1
        x, y = np.repeat(x, after), spans(x + 1, after)
        ok = maps.similar(x, y)
        yield np.stack([keys[x[ok]], keys[y[ok]]], 1)
    for k in np.flatnonzero(size > SHORT_LIST):
        # what one reaches is not looked at again, so a list of near copies is read a few times
        left, reached = np.arange(first[k], first[k] + size[k]), []
        while len(left) or reached:
            if not reached:
                reached, left = [int(left[0])], left[1:]
            x = reached.pop()
            n = maps.n[left]
            lo = np.searchsorted(100 * n, maps.percent * maps.n[x])
            hi = np.searchsorted(maps.percent * n, 100 * maps.n[x], "right")
            y = left[lo:hi]
            same = np.full(len(y), x)
            ok = maps.similar(np.minimum(same, y), np.maximum(same, y))
            found = y[ok]
            if len(found):
                yield np.stack([np.full(len(found), keys[x]), keys[found]], 1)
                reached += found.tolist()
                left = np.concatenate([left[:lo], y[~ok], left[hi:]])


def candidates(sets: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) between digests of classes that connect every two classes that may be similar."""
    spark = sets.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    postings = sets.agg(F.sum(F.size("head"))).first()[0] or 0
    buckets = max(1, -(-postings // POSTINGS_PER_BUCKET))

    def post(batches):
        for batch in batches:
            heads = batch.column("head")
            n = np.diff(heads.offsets.to_numpy())
            yield _dealt(t := heads.flatten().to_numpy().view(np.uint64), buckets,
                         np.repeat(batch.column("a").to_numpy(), n), t)

    def shared(batches):
        for rows in _buckets(batches):
            keys, toks = _join((r[0] for r in rows), np.int64), _join((r[1] for r in rows), np.uint64)
            order = np.lexsort((keys, toks))
            keys, toks = keys[order], toks[order]
            new = np.ones(len(keys), bool)
            new[1:] = (keys[1:] != keys[:-1]) | (toks[1:] != toks[:-1])
            keys, toks = keys[new], toks[new]
            first, size = _groups(toks)
            size = np.repeat(size, size)
            two = size > 1
            if two.any():
                yield _dealt(keys[two].view(np.uint64), buckets, keys[two], toks[two], size[two].astype(np.int32))

    def sizes(batches):
        for batch in batches:
            keys, bits = batch.column("a").to_numpy(), batch.column("bits")
            if len(keys):
                at = bits.offsets.to_numpy().astype(np.int64)
                yield _dealt(keys.view(np.uint64), buckets, keys, None, batch.column("n").to_numpy().astype(np.int32),
                             bits.flatten().to_numpy(), at[:-1] - at[0], np.diff(at))

    def route(batches):
        for rows in _buckets(batches):
            posts, sized = [r for r in rows if r[1] is not None], [r for r in rows if r[1] is None]
            keys, toks = _join((r[0] for r in posts), np.int64), _join((r[1] for r in posts), np.uint64)
            count = _join((r[2] for r in posts), np.int32)
            if not len(keys):
                continue
            order = np.lexsort((toks, count, keys))
            keys, toks = keys[order], toks[order]
            first, found = _groups(keys)
            sk, sn = _join((r[0] for r in sized), np.int64), _join((r[2] for r in sized), np.int32).astype(np.int64)
            bits, width = _join((r[3] for r in sized), np.uint64), bitmap_words(sn, percent)
            order = np.argsort(sk)
            own = order[np.searchsorted(sk[order], keys[first])]
            n = sn[own]
            need = head(least_overlap(n, percent), percent)[1] + 1  # with the smallest partner
            take = np.maximum(found - need + 1, 0)
            cells, own = spans(first, take), np.repeat(own, take)
            if len(cells):
                yield _dealt(toks[cells], buckets, keys[cells], toks[cells], sn[own].astype(np.int32), bits,
                             (np.cumsum(width) - width)[own], width[own])

    def meet(batches):
        for rows in _buckets(batches):
            keys, toks = _join((r[0] for r in rows), np.int64), _join((r[1] for r in rows), np.uint64)
            n, bits = _join((r[2] for r in rows), np.int32).astype(np.int64), _join((r[3] for r in rows), np.uint64)
            width = bitmap_words(n, percent)
            at = np.cumsum(width) - width
            order = np.lexsort((keys, n, toks))
            pairs = np.concatenate(list(compatible(keys[order], toks[order], Bitmaps(n[order], bits, at[order], width[order],
                                                                                     percent))))
            pairs = np.unique(pairs, axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["u", "v"])

    deal = lambda df: df.repartition(parts, "bucket").sortWithinPartitions("bucket")
    heads = sets.where(F.size("head") > 0)
    posts = deal(heads.select("a", "head").mapInArrow(post, PACKED)).mapInArrow(shared, PACKED)
    sized = heads.select("a", "n", "bits").mapInArrow(sizes, PACKED)
    routed = deal(posts.unionByName(sized)).mapInArrow(route, PACKED)
    return deal(routed).mapInArrow(meet, "u long, v long")


# --- T-occurrence search within a task ---------------------------------------------

class Lists:
    """Inverted lists over the sets of some documents, numbered by ascending set size."""

    def __init__(self, sets: list[np.ndarray]):
        self.size = np.array([len(s) for s in sets], np.int64)
        self.at = np.append(0, np.cumsum(self.size))
        doc = np.repeat(np.arange(len(sets)), self.size)
        order = np.argsort(np.concatenate(sets), kind="stable")
        toks = np.concatenate(sets)[order]
        first, n = _groups(toks)
        self.docs, self.first, self.length = doc[order], first, n
        self.list_of = np.empty(len(toks), np.int64)
        self.list_of[order] = np.repeat(np.arange(len(first)), n)
        self.probe = np.repeat(np.arange(len(first)), n) * len(sets) + self.docs

    def merged(self, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Documents in any of the lists, and in how many; the lists are sorted runs for the merge sort."""
        n = self.length[lists]
        cells = np.arange(int(n.sum())) + np.repeat(self.first[lists] - np.cumsum(n) + n, n)
        docs = np.sort(self.docs[cells], kind="stable")
        first, count = _groups(docs)
        return docs[first], count

    def probed(self, lists: np.ndarray, doc: int) -> int:
        """How many of the lists hold the document, by binary search."""
        key = lists * len(self.size) + doc
        at = np.minimum(np.searchsorted(self.probe, key), len(self.probe) - 1)
        return int((self.probe[at] == key).sum())


def linked(sets: list[np.ndarray], side: np.ndarray, percent: int, mu: float = 0.01,
           root: np.ndarray | None = None) -> list[tuple[int, int]]:
    """Links among sets in ascending order of size that connect all similar ones.

    ``side`` is 0 throughout to join all, else only sets of side 1 and 2 are joined with each other. Sets of one
    ``root`` are connected already.
    """
    lists = Lists(sets)
    root, out = np.arange(len(sets)) if root is None else root.copy(), []
    for x in range(len(sets)):
        n = int(lists.size[x])
        need = least_overlap(n, percent)
        mine = lists.list_of[lists.at[x]:lists.at[x + 1]]
        length = lists.length[mine]
        mine = mine[np.argsort(length, kind="stable")]
        longest = int(length.max())
        long_ = min(need - 1, int(need / (mu * np.log2(longest + 1) + 1)))
        short, long_ = mine[:n - long_], mine[n - long_:]
        docs, count = lists.merged(short)
        size = lists.size[docs]
        ok = (docs > x) & (percent * size <= 100 * n) & (root[docs] != root[x]) & ((side[docs] != side[x]) | (side[x] == 0))
        want = pair_overlap(n, size, percent)
        ok &= count >= want - len(long_)
        for y, c, w in zip(docs[ok].tolist(), count[ok].tolist(), want[ok].tolist()):
            if root[y] != root[x] and (c >= w or c + lists.probed(long_, y) >= w):
                out.append((x, y))
                root[root == root[y]] = root[x]
    return out


LINKS = "cluster long, u long, v long"


def whole_sets(members: DataFrame, docs: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """members (cluster, blocks, key, rep, n) with the hashes of their sets."""
    def read(batches):
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch.column("text")):
                h, at = shingle_sets(data, offsets, words)
                part = batch.slice(lo, hi - lo)
                same = digests(h, at)[0].view(np.int64) == part.column("key").to_numpy()  # ids can be repeated
                made = pa.array([h[a:b].tobytes() for a, b in zip(at[:-1].tolist(), at[1:].tolist())], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("cluster", "blocks", "key", "rep", "n")), made],
                    ["cluster", "blocks", "key", "rep", "n", "hashes"]).filter(pa.array(same))

    texts = docs.select(F.col(id_col).cast("long").alias("rep"), F.col(text_col).alias("text"))
    # members grow with the documents: the same join at every size, none that gathers them in one place
    return texts.join(members.hint("merge"), "rep").mapInArrow(
        read, "cluster long, blocks long, key long, rep long, n long, hashes binary")


def met(dealt: DataFrame, percent: int) -> DataFrame:
    """LINKS of each root to the one it meets, in blocks i and j of a cluster. dealt: cluster, i, j, block, key, root, hashes.

    Sets of one root are connected already; a root is the id of a document that is connected with them.
    """
    parts = int(dealt.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def join(batches):
        group, rows = None, {}

        def out():
            order = sorted(rows.values(), key=lambda r: len(r[2]))
            side = np.array([0 if group[1] == group[2] else 1 + (r[0] == group[2]) for r in order])
            roots, own = np.unique(np.array([r[1] for r in order]), return_inverse=True)
            to = np.arange(len(roots))
            for x, y in linked([np.frombuffer(r[2], np.uint64) for r in order], side, percent, root=own):
                to[to == to[own[y]]] = to[own[x]]
            gone = np.flatnonzero(to != np.arange(len(roots)))
            return pa.RecordBatch.from_arrays([pa.array(np.full(len(gone), group[0])), pa.array(roots[gone]),
                                               pa.array(roots[to[gone]])], ["cluster", "u", "v"])

        for batch in batches:
            for c, i, j, block, key, root, h in zip(*(x.to_pylist() for x in batch.columns)):
                if (c, i, j) != group and rows:
                    if len(rows) > 1:
                        yield out()
                    rows = {}
                group = c, i, j
                rows[key] = block, root, h
        if len(rows) > 1:
            yield out()

    return dealt.select("cluster", "i", "j", "block", "key", "root", "hashes") \
        .repartition(parts, "cluster", "i", "j").sortWithinPartitions("cluster", "i", "j", "key").mapInArrow(join, LINKS)


def blocks_of(count, shingles):
    return F.greatest(F.ceil(count / BLOCK_DOCUMENTS), F.ceil(shingles / BLOCK_SHINGLES))


def same_block(dealt: DataFrame) -> DataFrame:
    return dealt.select("*", F.col("block").alias("i"), F.col("block").alias("j"))


def search(members: DataFrame, docs: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """Links (u, v) of document ids within clusters. members: cluster, key, rep, n."""
    blocks = members.groupBy("cluster").agg(blocks_of(F.count(F.lit(1)), F.sum("n")).alias("blocks"))
    found = stored(whole_sets(members.join(blocks, "cluster").select("cluster", "blocks", "key", "rep", "n"),
                              docs, words, id_col, text_col), "found")
    links = stored(met(same_block(found.select("*", F.pmod(F.xxhash64("key"), "blocks").alias("block"),
                                               F.col("rep").alias("root"))), percent), "links")
    hot = found.where("blocks > 1")
    if hot.isEmpty():
        return links.select("u", "v")
    members = hot.select("cluster", "key", "n", F.col("rep").alias("root")).distinct()
    members = stored(moved(members, links), "rooted")
    while True:
        some = speakers(members)
        most = some.agg(F.max("dealt")).first()[0]
        if most is None:  # no cluster has several large components
            break
        some = some.select("cluster", "key", "root", F.pmod(F.xxhash64("key"), "dealt").alias("block"))
        more = stored(met(same_block(hot.join(some, ["cluster", "key"])), percent), "links")
        links, members = links.unionByName(more), stored(moved(members, more), "rooted")
        if most == 1 or more.isEmpty():
            break
    return links.unionByName(met(apart(hot, members, percent), percent)).select("u", "v")


def moved(members: DataFrame, links: DataFrame) -> DataFrame:
    """members with the root that theirs meets."""
    to = links.groupBy("cluster", F.col("u").alias("root")).agg(F.min("v").alias("v"))
    return members.join(to, ["cluster", "root"], "left").select(
        "cluster", "key", "n", F.coalesce("v", "root").alias("root"))


def speakers(members: DataFrame) -> DataFrame:
    """Some members of each large component (cluster, key, root) and the blocks to deal them to, where a cluster has
    several."""
    chosen = [F.min(F.struct(F.xxhash64("key", F.lit(k)), "key", "n")) for k in range(SPEAKERS)]
    large = members.groupBy("cluster", "root").agg(F.count(F.lit(1)).alias("d"), F.array(*chosen).alias("chosen")) \
        .where(F.col("d") >= max(2, BLOCK_DOCUMENTS // 8))
    some = large.select("cluster", "root", F.explode("chosen").alias("c")).select("cluster", "root", "c.key", "c.n").distinct()
    several = some.groupBy("cluster").agg(F.min("root").alias("least"), F.max("root").alias("most"),
                                          blocks_of(F.count(F.lit(1)), F.sum("n")).alias("dealt")) \
        .where("least < most").select("cluster", "dealt")
    return some.join(several, "cluster").select("cluster", "key", "root", "dealt")


def apart(hot: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Every two blocks whose sizes allow a link, but for two of one component; components of a block or more have their
    own blocks. Sizes fall into bands so that similar sets are in one or in neighbouring ones."""
    large = members.groupBy("cluster", "root").agg(F.count(F.lit(1)).alias("d"))
    band = F.floor(F.log(F.col("n").cast("double")) / (1.0001 * float(np.log(100 / percent)))) if percent < 100 else F.col("n")
    placed = members.join(large, ["cluster", "root"]).select(
        "cluster", "key", "root", "n", F.when(F.col("d") >= BLOCK_DOCUMENTS, F.col("root")).alias("own"), band.alias("band"))
    counted = placed.groupBy("cluster", "own", "band").agg(blocks_of(F.count(F.lit(1)), F.sum("n")).alias("dealt"))
    number = lambda no: F.xxhash64("own", "band", no).alias("block")
    p, c = placed.alias("p"), counted.alias("c")
    same = [F.col(f"p.{x}").eqNullSafe(F.col(f"c.{x}")) for x in ("cluster", "own", "band")]
    placed = p.join(c, same[0] & same[1] & same[2]).select("p.*", "dealt") \
        .select("cluster", "key", "root", number(F.pmod(F.xxhash64("key"), "dealt")))
    all_ = counted.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("dealt") - 1)).alias("no")) \
        .select("cluster", "own", "band", number(F.col("no")))
    a, b = all_.alias("a"), all_.alias("b")
    pairs = a.join(b, F.col("a.cluster") == F.col("b.cluster")) \
        .where((F.abs(F.col("a.band") - F.col("b.band")) <= 1)
               & (F.col("a.own").isNull() | F.col("b.own").isNull() | (F.col("a.own") != F.col("b.own")))) \
        .select("a.cluster", "a.block", F.least("a.block", "b.block").alias("i"), F.greatest("a.block", "b.block").alias("j"))
    pairs = pairs.groupBy("cluster", "block").agg(F.collect_set(F.struct("i", "j")).alias("pairs"))
    placed = placed.join(pairs, ["cluster", "block"])
    return hot.join(placed, ["cluster", "key"]).select("*", F.explode("pairs").alias("pair")).select(
        "*", F.col("pair.i").alias("i"), F.col("pair.j").alias("j"))


def near_duplicates(docs: DataFrame, words: int = 4, percent: int = 85, id_col: str = "doc_id",
                    text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every row."""
    sets = stored(described(docs, words, percent, id_col, text_col), "sets")
    classes = sets.where((F.col("n") > 0) & F.col("doc_id").isNotNull()).groupBy("a", "b") \
        .agg(F.min("doc_id").alias("rep"), F.min("n").alias("n"))
    clusters = components(candidates(sets.where(F.col("doc_id").isNotNull()), percent))
    members = stored(clusters.join(classes, clusters["id"] == classes["a"])
                     .select(F.col("component").alias("cluster"), F.col("id").alias("key"), "rep", "n"), "members")
    links = search(members, docs, words, percent, id_col, text_col)
    # a row's set leads to its class, and rows with one id count as one document
    ids = sets.where(F.col("n") > 0).select("doc_id", "a", "b").distinct()
    again = ids.groupBy("doc_id").agg(F.count(F.lit(1)).alias("sets")).where("sets > 1")
    same_id = ids.join(again, "doc_id", "left_semi").join(classes, ["a", "b"]) \
        .select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
    found = components(links.unionByName(same_id))
    rep = classes.join(found, classes["rep"] == found["id"], "left") \
        .select("a", "b", F.coalesce("component", "rep").alias("component_id"))
    return sets.select("doc_id", F.col("n").alias("n_shingles"), "a", "b").join(rep, ["a", "b"], "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
