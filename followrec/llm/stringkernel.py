"""Toxicity by a subsequence string-kernel machine with Nystroem landmarks (operator 7).

The kernel of two strings counts the subsequences of three symbols that they
share, each weighted by ``decay`` to the length it spans in either string;
``a..c`` inside ``abxc`` still counts, so inserted characters and gaps only
lower a match. Spans beyond ``reach`` symbols have a negligible weight and are
left out. Strings are scaled by the norm of a string of their length without
repeats.

Learning, from rows whose id is not held out:

1. Spark counts, for every word of the labelled documents' sentences, the toxic
   and the other documents it is in.
2. A toxic document is toxic by one of its words at least. Of the words with a
   significantly higher toxic share (G-test), those nearly as strong as the
   strongest in a document are its witnesses; its other words prove nothing.
3. Landmarks are witnesses, taken greedily so that no two are alike, and as many
   of the commonest other words.
4. Examples are the witnesses, the same words with characters inserted, and words
   of documents that are not toxic: common ones, a hash sample, and those that a
   first fit scores highest. All have documented bounds; the counts cover all rows.
5. The Nystroem map ``K(x, landmarks) K_ll^(-1/2)`` makes the kernel linear; a
   hinge-loss model is fitted by dual coordinate descent.

A linear function of the map is one weight per three-symbol subsequence, so a
word is scored by table look-ups. A sentence scores as its worst word, where
runs of single characters count as one word, and a document as its worst
sentence. A logistic curve fitted on documents makes it a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from followrec.llm.common import stage
from followrec.llm.linear import dual_coordinate_descent, fit_scaling, probability
from followrec.llm.nbsvm import held_out, labelled
from followrec.llm.textvec import LOWER, SPACE, RangeHash, Texts, Words, slices, words_of


@dataclass(frozen=True)
class KernelParams:
    decay: float = 0.7
    reach: int = 9
    landmarks: int = 96  # of either kind
    nearly: float = 0.7  # a witness has this share of the strongest word's evidence
    alike: float = 0.6  # landmarks of one kind are less alike than this
    examples: int = 1500  # significant words, and each kind of other words
    scaling_rows: int = 2000  # documents a class for the logistic curve
    cost: float = 4.0
    threshold: float = 0.5


#: Symbols: 1-26 letters, 27 digits, 28 marks, 32-63 bytes of multi-byte characters.
_SYMBOL = np.full(256, 28, np.int32)
_SYMBOL[97:123] = np.arange(1, 27)
_SYMBOL[65:91] = np.arange(1, 27)
_SYMBOL[48:58] = 27
_SYMBOL[128:] = 32 + np.arange(128) % 32
TABLE = 1 << 18  # three symbols of six bits

#: Marks do not belong to a word as it is learnt and scored.
_MARK = np.zeros(256, bool)
_MARK[33:48] = _MARK[58:65] = _MARK[91:97] = _MARK[123:127] = True


def _norms(p: KernelParams, longest: int) -> np.ndarray:
    """Norm of a string of each length without repeated subsequences."""
    out = np.zeros(longest + 1)
    for a in range(1, p.reach):
        for b in range(a + 1, p.reach):
            n = np.maximum(np.arange(longest + 1) - b, 0)
            out += n * p.decay ** (2 * (b + 1))
    return np.sqrt(out)


def subsequences(buf: np.ndarray, start: np.ndarray, end: np.ndarray,
                 p: KernelParams) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """For each pair of distances: word index, table index and weight of the subsequences."""
    symbol = _SYMBOL[buf]
    size = end - start
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    word = np.repeat(np.arange(len(start)), size)
    left = np.repeat(size, size) - at
    at = at + np.repeat(start, size)
    for b in range(2, p.reach):
        fits = left > b
        at, word, left = at[fits], word[fits], left[fits]
        if not len(at):
            return
        ends = (symbol[at] << 12) + symbol[at + b]
        for a in range(1, b):
            yield word, ends + (symbol[at + a] << 6), p.decay ** (b + 1)


Row = tuple[np.ndarray, np.ndarray]  # table columns, ascending, and their values


def sparse(words: list[bytes], p: KernelParams) -> list[Row]:
    """Kernel map of a few strings, as the columns that are not zero."""
    out: list[Row] = []
    for lo in range(0, len(words), 128):
        part = words[lo:lo + 128]
        size = np.array([len(w) for w in part])
        end = np.cumsum(size)
        buf = np.frombuffer(b"".join(part), np.uint8)
        keys, values = [np.zeros(0, np.int64)], [np.zeros(0)]
        for word, column, weight in subsequences(buf, end - size, end, p):
            keys.append(word.astype(np.int64) * TABLE + column)
            values.append(np.full(len(word), weight))
        key, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        value = np.bincount(inverse, np.concatenate(values), minlength=len(key))
        norm = _norms(p, int(size.max(initial=0)))[size]
        value = value / np.where(norm > 0, norm, 1)[key // TABLE]
        first = np.searchsorted(key, np.arange(len(part) + 1) * TABLE)
        out += [(key[i:j] % TABLE, value[i:j]) for i, j in zip(first[:-1], first[1:], strict=True)]
    return out


def _columns(rows: list[Row]) -> np.ndarray:
    return np.unique(np.concatenate([np.zeros(0, np.int64), *(c for c, _ in rows)]))


@dataclass
class Landmarks:
    """Kernel maps of the landmarks, over the columns that any of them has."""

    columns: np.ndarray
    rows: np.ndarray

    @classmethod
    def of(cls, words: list[bytes], p: KernelParams) -> Landmarks:
        sparse_rows = sparse(words, p)
        columns = _columns(sparse_rows)
        rows = np.zeros((len(words), len(columns)), np.float32)
        for i, (c, v) in enumerate(sparse_rows):
            rows[i, np.searchsorted(columns, c)] = v
        return cls(columns, rows)

    def kernel(self, words: list[bytes], p: KernelParams) -> np.ndarray:
        """Kernel of strings with every landmark."""
        out = np.zeros((len(words), len(self.rows)))
        for i, (c, v) in enumerate(sparse(words, p)):
            shared = np.isin(c, self.columns, assume_unique=True)
            out[i] = self.rows[:, np.searchsorted(self.columns, c[shared])] @ v[shared]
        return out


def score_strings(buf: np.ndarray, start: np.ndarray, end: np.ndarray, table: np.ndarray,
                  p: KernelParams) -> np.ndarray:
    """Weighted subsequence sums of byte ranges; very long ones are cut into shares."""
    size = end - start
    total = np.zeros(len(start))
    for word, column, weight in subsequences(buf, start, end, p):
        total += weight * np.bincount(word, table[column], minlength=len(start))
    norm = _norms(p, int(size.max(initial=0)))[size]
    return total / np.where(norm > 0, norm, 1)


def strings_of(texts: Texts) -> tuple[Texts, Words]:
    """Lower-cased words without marks; three or more words of one character in a
    row also form one more string, put behind the text."""
    words = words_of(texts)
    solid = ~(_MARK | SPACE)[texts.buf]
    place = np.concatenate([[0], np.cumsum(solid)])
    low = Texts(LOWER[texts.buf[solid]], place[texts.offs])
    start, end = place[words.start], place[words.end]
    lead = np.concatenate([[0], np.cumsum((low.buf & 0xC0) != 0x80)])
    single = (lead[end] - lead[start] == 1)
    owner = words.text
    edge = np.flatnonzero(np.diff(np.concatenate([[0], single.astype(np.int8), [0]])))
    extra, where = [], []
    for lo, hi in edge.reshape(-1, 2):
        for a, b in _same(owner, lo, hi):
            if b - a >= 3:
                extra.append(b"".join(low.buf[start[k]:end[k]].tobytes() for k in range(a, b)))
                where.append(owner[a])
    keep = end > start
    start, end, owner = start[keep], end[keep], owner[keep]
    if extra:
        size = np.array([len(x) for x in extra])
        tail = len(low.buf) + np.cumsum(size)
        buf = np.concatenate([low.buf, np.frombuffer(b"".join(extra), np.uint8)])
        start = np.concatenate([start, tail - size])
        end = np.concatenate([end, tail])
        owner = np.concatenate([owner, where])
        order = np.argsort(owner, kind="stable")
        start, end, owner = start[order], end[order], owner[order]
        low = Texts(buf, low.offs)
    return low, Words(start, end, np.searchsorted(owner, np.arange(len(texts) + 1)))


def _same(owner: np.ndarray, lo: int, hi: int) -> Iterator[tuple[int, int]]:
    cut = [lo, *(lo + 1 + np.flatnonzero(np.diff(owner[lo:hi]))).tolist(), hi]
    yield from zip(cut[:-1], cut[1:], strict=True)


def word_counts(train: DataFrame) -> DataFrame:
    """Words of labelled documents with their document counts by label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in slices(batch):
                low, words = strings_of(texts)
                size = words.end - words.start
                fit_ = (size >= 3) & (size <= 64)
                start, end, owner = words.start[fit_], words.end[fit_], words.text[fit_]
                label = rows.column(0).to_numpy().astype(np.int64)
                hashes = RangeHash(low.buf)(start, end)
                order = np.lexsort([owner, hashes])
                h, o = hashes[order], owner[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
                order = order[new]
                h, first, inverse = np.unique(hashes[order], return_index=True,
                                              return_inverse=True)
                toxic = np.bincount(inverse, label[owner[order]], minlength=len(h))
                every = np.bincount(inverse, minlength=len(h))
                at = order[first]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([low.buf[s:e].tobytes() for s, e in zip(start[at], end[at],
                                                                      strict=True)], pa.binary()),
                     pa.array(toxic.astype(np.int64)),
                     pa.array((every - toxic).astype(np.int64))], ["word", "n1", "n0"])

    return (train.select("label", "text").mapInArrow(run, "word binary, n1 bigint, n0 bigint")
            .groupBy("word").agg(F.sum("n1").alias("n1"), F.sum("n0").alias("n0")))


def _inserted(word: bytes, k: int) -> list[bytes]:
    """The word with one, and with two, further characters inside, varied by k."""
    filler = b"xeq0zh1n"
    out = []
    for more in (1, 2):
        spoilt = bytearray(word)
        for step in range(more):
            spoilt.insert(1 + (5 * k + 3 * step + more) % (len(spoilt) - 1),
                          filler[(k + step + more) % len(filler)])
        out.append(bytes(spoilt))
    return out


@dataclass
class ToxicModel:
    table: np.ndarray
    slope: float
    offset: float
    params: KernelParams

    def margins(self, texts: Texts) -> np.ndarray:
        """Highest word score per text; -1 for a text without words."""
        low, words = strings_of(texts)
        hashes = RangeHash(low.buf)(words.start, words.end)
        _, first, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        each = score_strings(low.buf, words.start[first], words.end[first], self.table,
                             self.params)[inverse]
        out = np.full(len(texts), -1.0)
        np.maximum.at(out, words.text, each)
        return out

    def score(self, texts: Texts) -> np.ndarray:
        return probability(self.margins(texts), self.slope, self.offset)


def _diverse(words: list[bytes], n: int, p: KernelParams) -> list[bytes]:
    rows = sparse(words, p)
    columns = _columns(rows)
    kept = np.zeros((n, len(columns)), np.float32)
    keep: list[int] = []
    for i, (c, v) in enumerate(rows):
        at = np.searchsorted(columns, c)
        if not keep or (kept[:len(keep), at] @ v).max() < p.alike:
            kept[len(keep), at] = v
            keep.append(i)
        if len(keep) == n:
            break
    return [words[i] for i in keep]


def _fit_table(marks: Landmarks, positive: list[bytes], negative: list[bytes],
               p: KernelParams) -> np.ndarray:
    """Subsequence weights of the hinge-loss model in Nystroem space."""
    values, vectors = np.linalg.eigh((marks.rows @ marks.rows.T).astype(float))
    root = vectors * np.where(values > 1e-6, 1 / np.sqrt(np.maximum(values, 1e-6)), 0)
    root = root @ vectors.T
    z = marks.kernel(positive + negative, p) @ root
    z = np.concatenate([z, np.ones((len(z), 1))], 1)
    y = np.array([1] * len(positive) + [-1] * len(negative))
    at = np.arange(z.shape[1])
    cost = np.where(y > 0, p.cost * max(1.0, len(negative) / len(positive)), p.cost)
    w = dual_coordinate_descent([(at, row) for row in z], y, z.shape[1], cost, epochs=100)
    table = np.zeros(TABLE)
    table[marks.columns] = marks.rows.T @ (root @ w[:-1])
    return table


def fit(docs: DataFrame, labels: DataFrame, p: KernelParams = KernelParams()) -> ToxicModel:
    """Model of ``labels(doc_id, label)`` on ``docs(doc_id, text)``."""
    train = labelled(docs, labels)
    total = {r.label: r["count"] for r in train.groupBy("label").count().collect()}
    share = min(max(total.get(1, 0) / max(sum(total.values()), 1), 1e-6), 1 - 1e-6)
    flat = ToxicModel(np.zeros(TABLE, np.float32), 0.0, float(np.log(share / (1 - share))), p)
    if len(total) < 2:
        return flat
    counts = stage(word_counts(train), "word-counts")
    d1, d0 = float(total[1]), float(total[0])
    n1, n0 = F.col("n1").cast("double"), F.col("n0").cast("double")
    both = n1 + n0

    def part(seen, expected):
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    g = 2 * (part(n1, both * d1 / (d1 + d0)) + part(n0, both * d0 / (d1 + d0)))
    sure = 2 * np.log(max(counts.count(), 2))
    picked = (counts.where((n1 / d1 > 3 * n0 / d0) & (g > sure)).orderBy(F.desc(g), "word")
              .limit(p.examples).select("word", g.alias("g")).collect())
    rank = {bytes(r.word): k for k, r in enumerate(picked)}
    strength = np.array([r.g for r in picked])

    def witness(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = []
            for _, texts in slices(batch):
                low, words = strings_of(texts)
                for i in range(len(texts)):
                    at = range(words.first[i], words.first[i + 1])
                    found = {rank[w] for k in at if (w := low.buf[
                        words.start[k]:words.end[k]].tobytes()) in rank}
                    top = strength[min(found)] if found else 0
                    best += [k for k in found if strength[k] >= p.nearly * top]
            yield pa.RecordBatch.from_arrays([pa.array(best, pa.int32())], ["rank"])

    chosen = (train.where("label = 1").select("text").mapInArrow(witness, "rank int")
              .groupBy("rank").count().where("count > 1")
              .orderBy(F.desc("count"), "rank").collect())  # at most ``examples`` ranks
    if not chosen:
        return flat
    positive = [bytes(picked[r["rank"]].word) for r in chosen]
    others = counts.where((F.col("n0") > 0) & ~((n1 / d1 > 3 * n0 / d0) & (g > sure / 2)))
    common = [bytes(r.word) for r in
              others.orderBy(F.desc("n0"), "word").limit(p.examples).collect()]
    mixed = [bytes(r.word) for r in
             others.orderBy(F.xxhash64("word"), "word").limit(p.examples).collect()]
    marks = Landmarks.of(_diverse(positive, p.landmarks, p)
                         + _diverse(common, p.landmarks, p), p)
    examples = positive + [x for k, w in enumerate(positive) for x in _inserted(w, k)]
    table = _fit_table(marks, examples, common + mixed, p)

    def hardest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.array([len(w.as_py()) for w in batch.column(0)], np.int64)
            buf = np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint8)
            end = np.cumsum(size)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(score_strings(buf, end - size, end, table, p))],
                ["word", "margin"])

    hard = [bytes(r.word) for r in others.select("word").mapInArrow(
        hardest, "word binary, margin double").orderBy(F.desc("margin"), "word")
        .limit(p.examples).collect()]
    table = _fit_table(marks, examples, common + mixed + hard, p).astype(np.float32)

    rough = ToxicModel(table, 1.0, 0.0, p)

    def margins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in slices(batch):
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns[:2], pa.array(rough.margins(texts))],
                    ["doc_id", "label", "margin"])

    seen = stage(train.select("doc_id", "label", "text").mapInArrow(
        margins, "doc_id bigint, label int, margin double"), "margins")
    rows = [r for label in (0, 1) for r in seen.where(F.col("label") == label)
            .orderBy(F.xxhash64("doc_id"), "margin").limit(p.scaling_rows).collect()]
    margin = np.array([r.margin for r in rows])
    y = np.array([2 * r.label - 1 for r in rows])
    weight = np.where(y > 0, d1 / (y > 0).sum(), d0 / (y < 0).sum())
    slope, offset = fit_scaling(margin, y, weight * len(y) / weight.sum())
    return ToxicModel(table, slope, offset, p)


def score_documents(docs: DataFrame, labels: DataFrame,
                    p: KernelParams = KernelParams()) -> DataFrame:
    """doc_id, held_out, score, predicted per row of ``docs(doc_id, text)``.

    Null and empty texts score as the least toxic text does. Without labelled
    rows of both classes, or without significant words, all texts score alike.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, p))  # one table

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in slices(batch):
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(model.value.score(texts))], ["doc_id", "score"])

    return (docs.select("doc_id", "text").mapInArrow(run, "doc_id bigint, score double")
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= p.threshold).cast("int").alias("predicted")))
