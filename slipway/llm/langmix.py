"""Language identification as a mixture of languages.

Every language gets a model of hashed character (byte) trigrams, counted over
all rows to learn from. A document is a bag of words, each from one language;
the likelihood of a word in a language is the product of its trigrams'
probabilities. Expectation-maximisation estimates the share of each language.
Languages are then added in the order of their shares while the log likelihood
gains more than ``penalty * log(words)`` for each; the largest share among
those chosen gives the prediction.

Edge cases: a null text, or one without a letter, gets ``und`` with score 0,
as does every row when there is nothing to learn from; a text with letters
but no word to score takes the first language by name, score 1 / languages; ties go to the smaller name; a text of any length is scored
whole; only the id and the text are read to predict.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from slipway.llm.arrays import LOWER, WORD_OR_PUNCTUATION, chunks, mix, tokens
from slipway.llm.counts import count_vectors

CELLS = 1 << 16
SMOOTHING = 0.5
ROUNDS = 12
FOLDED = np.where(WORD_OR_PUNCTUATION == 1, LOWER, 32).astype(np.uint8)
FOLDED[48:58] = 32  # digits


def trigrams(data: np.ndarray, offsets: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cell of the trigram around each byte, and the words' starts and their row offsets; a space closes a word."""
    folded = FOLDED[data]
    starts, ends, rows = tokens(folded, offsets, FOLDED != 32)
    n = ends - starts + 1  # one trigram for each byte of a word, and one for its end
    first = np.cumsum(n) - n
    at = np.arange(int(n.sum())) - np.repeat(first, n) + np.repeat(starts, n)
    begin, end = np.repeat(starts, n), np.repeat(ends, n)
    byte = lambda i: np.where((i >= begin) & (i < end), folded[np.clip(i, 0, max(0, len(folded) - 1))], 32)
    code = (byte(at - 1).astype(np.uint64) << np.uint64(16)) | (byte(at).astype(np.uint64) << np.uint64(8)) \
        | byte(at + 1).astype(np.uint64) if len(at) else np.zeros(0, np.uint64)
    return (mix(code) % np.uint64(size)).astype(np.int64), first, rows


def has_letter(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    lower = LOWER[data]
    total = np.concatenate([[0], np.cumsum((lower > 96) & (lower < 123))])
    wide = np.concatenate([[0], np.cumsum(data > 127)])
    found = total[offsets[1:]] > total[offsets[:-1]]
    for i in np.flatnonzero(~found & (wide[offsets[1:]] > wide[offsets[:-1]])):
        found[i] = any(map(str.isalpha, data[offsets[i]:offsets[i + 1]].tobytes().decode()))
    return found


def learn(rows: DataFrame, lang_col: str = "lang", text_col: str = "text", size: int = CELLS
          ) -> tuple[list[str], np.ndarray]:
    """Languages by name, and log probabilities (language, cell)."""
    def count(batch):
        langs = batch.column(1).to_pylist()
        for lo, hi, data, offsets in chunks(batch.column(0)):
            cells, first, words = trigrams(data, offsets, size)
            at = np.concatenate([first, [len(cells)]])[words]
            for lang in set(langs[lo:hi]):
                mine = np.repeat([x == lang for x in langs[lo:hi]], np.diff(at))
                yield lang, cells[mine]

    used = rows.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(text_col, lang_col)
    found = count_vectors(used, size, count)
    names = sorted(found)
    if not names:
        return [], np.zeros((0, size), np.float32)
    table = np.stack([found[x] for x in names]) + SMOOTHING
    return names, np.log(table / table.sum(1, keepdims=True)).astype(np.float32)


def _sums(x: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.add.reduceat(x, first, axis=0) if len(first) else np.zeros((0, x.shape[1]))


def mixture(like: np.ndarray, first: np.ndarray, allowed: np.ndarray, rounds: int = ROUNDS
            ) -> tuple[np.ndarray, np.ndarray]:
    """EM over words (rows of ``like``) of documents that begin at ``first``: shares and log likelihoods.

    ``like`` holds each word's likelihoods, the largest being 1.
    """
    n = np.diff(np.append(first, len(like)))
    row = np.repeat(np.arange(len(n)), n)
    share = allowed / allowed.sum(1, keepdims=True)
    for _ in range(rounds):
        part = like * share[row]
        part /= np.maximum(part.sum(1, keepdims=True), 1e-300)
        share = _sums(part, first) / n[:, None]
    fit = np.log(np.maximum((like * share[row]).sum(1), 1e-300))
    return share, np.add.reduceat(fit, first) if len(first) else np.zeros(0)


def choose(like: np.ndarray, first: np.ndarray, penalty: float) -> tuple[np.ndarray, np.ndarray]:
    """Full-mixture shares and the chosen languages (flags) of each document, which has words."""
    n = np.diff(np.append(first, len(like)))
    docs, langs = len(first), like.shape[1]
    share, full = mixture(like, first, np.ones((docs, langs)))
    order = np.argsort(-share, axis=1, kind="stable")
    price = penalty * np.log(n + 1)
    best = np.zeros((docs, langs), bool)
    best[np.arange(docs), order[:, 0]] = True
    value = _sums(np.log(np.maximum(like, 1e-300)), first)[np.arange(docs), order[:, 0]]
    open_ = np.arange(docs)
    for m in range(2, langs + 1):
        # no m languages explain more than all of them do
        open_ = open_[full[open_] - (m - 1) * price[open_] > value[open_]]
        if not len(open_):
            break
        allowed = np.zeros((len(open_), langs))
        np.put_along_axis(allowed, order[open_, :m], 1, axis=1)
        words = np.concatenate([np.arange(first[d], first[d] + n[d]) for d in open_])
        starts = np.cumsum(n[open_]) - n[open_]
        _, fit = mixture(like[words], starts, allowed)
        better = fit - (m - 1) * price[open_] > value[open_]
        best[open_[better]] = allowed[better] > 0
        value[open_[better]] = (fit - (m - 1) * price[open_])[better]
    return share, best


def predict(docs: DataFrame, names: list[str], table: np.ndarray, id_col: str = "doc_id", text_col: str = "text",
            penalty: float = 4.0, extra: dict[str, Column] | None = None) -> DataFrame:
    """id, the ``extra`` columns, lang_pred, score and langs (the chosen set) of every row."""
    model = docs.sparkSession.sparkContext.broadcast(table)
    extra = extra or {}
    keep = [id_col, *extra]

    def score(batches):
        logs = model.value
        for batch in batches:
            for lo, hi, data, offsets in chunks(batch.column(len(keep)), 1 << 19):
                pred, best, sets = ["und"] * (hi - lo), np.zeros(hi - lo), [[] for _ in range(hi - lo)]
                letter = has_letter(data, offsets)
                if names:
                    cells, at, rows = trigrams(data, offsets, logs.shape[1])
                    word = np.stack([np.add.reduceat(x[cells], at) if len(at) else np.zeros(0) for x in logs], 1) \
                        .astype(np.float64)
                    word = np.exp(word - word.max(1, keepdims=True)) if len(word) else word
                    full = np.flatnonzero((np.diff(rows) > 0) & letter)
                    words = np.repeat(letter, np.diff(rows))
                    n = np.diff(rows)[full]
                    share, chosen = choose(word[words], np.cumsum(n) - n, penalty)
                    first = np.where(chosen, share, -1).argmax(1)
                    for k, i in enumerate(full.tolist()):
                        pred[i], best[i] = names[first[k]], share[k, first[k]]
                        sets[i] = [names[j] for j in np.flatnonzero(chosen[k])]
                    for i in np.flatnonzero(letter & (np.diff(rows) == 0)).tolist():
                        pred[i], best[i], sets[i] = names[0], 1 / len(names), names[:1]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(lo, hi - lo) for k in range(len(keep))), pa.array(pred, pa.string()),
                     pa.array(np.clip(best, 0, 1)), pa.array(sets, pa.list_(pa.string()))],
                    [*keep, "lang_pred", "score", "langs"])

    from_docs = docs.select(id_col, *(c.alias(k) for k, c in extra.items()), text_col)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in from_docs.schema.fields[:-1])
    return from_docs.mapInArrow(score, schema + ", lang_pred string, score double, langs array<string>")


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             folds: int = 4, held_out_fold: int = 2) -> DataFrame:
    """Learns from the rows of the other folds, predicts every row."""
    fold = F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % folds
    names, table = learn(docs.where(fold != held_out_fold), lang_col, text_col)
    return predict(docs, names, table, id_col, text_col, extra={"held_out": fold == held_out_fold})
