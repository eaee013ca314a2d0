"""Benchmark decontamination by latent semantic retrieval (operator 1).

1. Words become 32-bit hashes, staged once; a word's column is its hash modulo
   ``columns``. Document frequencies of columns are counted over all passages
   (consecutive ``window`` words).
2. A randomised SVD of the TF-IDF matrix of all passages in one distributed
   pass: every task adds up its share of ``A' (A Omega)`` for a fixed random
   ``Omega``, Spark sums the shares by column, and the driver takes the leading
   right singular vectors from that sketch (its size depends on parameters only).
3. Every window of every document (windows start every ``window / 4`` words) is
   folded into the latent space, and so are the passages of the benchmark items,
   which are taken in blocks of bounded size. Pairs above a cosine are candidates.
4. Candidates are confirmed on the words: the longest common subsequence of the
   whole item with the region around the window, and of the item's answer (its
   last sentence, five words at least) with that region, so changed and inserted
   words are tolerated. A (nearly) verbatim copy needs no answer: the answer tells
   a paraphrase of the item from a text on the same matter.

Words are compared in ASCII lower case without ASCII marks at their ends, so marks
glued to a word do not hide it; a word of marks only is left as it is.

Items shorter than ``window`` words are searched with windows of 16 or 8 words;
items of fewer than ``least`` words are too short to be evidence and match nothing.
Null and empty texts match nothing. Rows with equal id and text give one row.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from followrec.llm.common import stage
from followrec.llm.textvec import LOWER, RangeHash, Texts, slices, words_of


@dataclass(frozen=True)
class LeakParams:
    columns: int = 4096
    rank: int = 32
    extra: int = 8  # further random directions of the sketch
    window: int = 32
    min_cosine: float = 0.55
    min_common: float = 0.4  # share of a window's words that are in the item
    min_lcs: float = 0.6  # share of the item's words
    min_answer: float = 0.5  # share of the answer's words
    verbatim: float = 0.9  # share of the item's words from which the answer is not asked for
    least: int = 5
    items: int = 1000  # benchmark items searched at a time


#: Windows compared with all passages at a time.
BLOCK = 1024

#: ASCII marks, which are stripped from the ends of words.
_MARK = np.zeros(256, bool)
_MARK[[ord(c) for c in string.punctuation]] = True
_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def _bare(buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ranges of words without marks at their ends; a word of marks only stays whole."""
    inner = np.flatnonzero(~_MARK[buf])
    lo, hi = np.searchsorted(inner, start), np.searchsorted(inner, end)
    some = hi > lo
    start, end = start.copy(), end.copy()
    start[some], end[some] = inner[lo[some]], inner[hi[some] - 1] + 1
    return start, end


def word_ids(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """32-bit hashes of the words (lower case, no marks) and the first word of each text."""
    low = Texts(LOWER[texts.buf], texts.offs)
    words = words_of(low)
    start, end = _bare(low.buf, words.start, words.end)
    return (RangeHash(low.buf)(start, end) >> np.uint64(32)).astype(np.uint32), words.first


def _encode(text: str) -> np.ndarray:
    raw = np.frombuffer(text.encode(), np.uint8)
    return word_ids(Texts(raw, np.array([0, len(raw)])))[0]


def tokens(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, words (uint32 hashes as bytes) of texts with words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in slices(batch):
                ids, first = word_ids(texts)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1),
                     pa.array([ids[a:b].tobytes() for a, b in zip(first[:-1], first[1:],
                                                                  strict=True)], pa.binary())],
                    ["doc_id", "text_key", "words"])

    return (docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
            .mapInArrow(run, "doc_id bigint, text_key bigint, words binary")
            .where(F.octet_length("words") > 0))


def _chunks(batch: pa.RecordBatch, at: int, limit: int = 200_000) -> Iterator[tuple[int, list]]:
    """Row ranges of a batch with about ``limit`` words: first row and word arrays."""
    rows: list[np.ndarray] = []
    total = first = 0
    for i, raw in enumerate(batch.column(at)):
        rows.append(np.frombuffer(raw.as_buffer(), np.uint32))
        total += len(rows[-1])
        if total >= limit:
            yield first, rows
            rows, total, first = [], 0, i + 1
    if rows:
        yield first, rows


def _passages(rows: list[np.ndarray], p: LeakParams) -> np.ndarray:
    """Columns of the words of each passage (a row), filled up with ``p.columns``."""
    first = np.cumsum([0, *(-(-len(r) // p.window) * p.window for r in rows)])
    out = np.full(first[-1], p.columns, np.min_scalar_type(p.columns))
    for r, lo in zip(rows, first[:-1], strict=True):
        out[lo:lo + len(r)] = r % p.columns
    return out.reshape(-1, p.window)


def row_sums(table: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """``table[rows].sum(1)``, added up in place without an array of all rows."""
    total = table.take(rows[:, 0], axis=0)
    for k in range(1, rows.shape[1]):
        total += table.take(rows[:, k], axis=0)
    return total


def _sum_by_column(words: DataFrame, share, width: int, p: LeakParams) -> np.ndarray:
    """Sum over all tasks of the (columns, width) matrix that ``share`` gives a batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((p.columns, width))
        for batch in batches:
            for _, rows in _chunks(batch, 0):
                share(total, rows)
        used = np.flatnonzero(total.any(1))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(list(total[used]), pa.list_(pa.float64()))], ["c", "v"])

    sums = (words.select("words").mapInArrow(run, "c bigint, v array<double>").groupBy("c")
            .agg(*(F.sum(F.col("v")[k]).alias(f"v{k}") for k in range(width))).toArrow())
    out = np.zeros((p.columns, width))  # ``columns`` rows at most came to the driver
    for k in range(width):
        out[sums["c"].to_numpy(), k] = sums[f"v{k}"].to_numpy()
    return out


def latent_space(words: DataFrame, p: LeakParams) -> np.ndarray:
    """Vector of every column in the latent space, times its inverse document frequency.

    With the sketch ``Y = A'A Omega``, ``A'A`` is close to ``Y (Omega'Y)^-1 Y'``,
    whose eigenvectors are the right singular vectors; queries and windows are
    folded in by ``V / sigma``.
    """

    width = p.columns + 1

    def frequency(total: np.ndarray, rows: list[np.ndarray]) -> None:
        column = _passages(rows, p)
        key = np.sort((np.arange(len(column))[:, None] * width + column).ravel())
        distinct = key[np.diff(key, prepend=-1) > 0] % width
        total[:, 0] += np.bincount(distinct, minlength=width)[:-1]
        total[:, 1] += len(column) / p.columns

    seen = _sum_by_column(words, frequency, 2, p)
    n = max(seen[:, 1].sum(), 1.0)
    idf = np.log((n + 1) / (seen[:, 0] + 1)).astype(np.float32)
    sketched = p.rank + p.extra
    omega = np.random.default_rng(7).standard_normal((p.columns, sketched)).astype(np.float32)
    scaled = np.concatenate([idf[:, None] * omega, np.zeros((1, sketched), np.float32)])

    def sketch(total: np.ndarray, rows: list[np.ndarray]) -> None:
        passages = _passages(rows, p)
        z = row_sums(scaled, passages)  # rows of A Omega
        order = np.argsort(passages.ravel(), kind="stable")
        column = passages.ravel()[order]
        real = np.searchsorted(column, p.columns)
        column, order = column[:real], order[:real]
        begins = np.flatnonzero(np.diff(column.astype(np.int64), prepend=-1))
        total[column[begins]] += np.add.reduceat(z[order // p.window], begins, axis=0)

    y = idf[:, None] * _sum_by_column(words, sketch, sketched, p)
    q, r = np.linalg.qr(y)
    core = np.linalg.pinv((omega.T @ y + y.T @ omega) / 2, rcond=1e-10, hermitian=True)
    values, vectors = np.linalg.eigh(r @ core @ r.T)
    top = np.argsort(values)[::-1][:p.rank]
    top = top[values[top] > 1e-9 * max(values.max(), 1e-300)]
    v = q @ vectors[:, top] / np.sqrt(values[top])
    return (idf[:, None] * v).astype(np.float32)


@dataclass
class Queries:
    """Benchmark items and their passages of one window length."""

    ids: list[int]
    words: list[np.ndarray]
    answers: list[np.ndarray]
    item: np.ndarray  # item of each passage
    offset: np.ndarray  # its first word in the item
    vectors: np.ndarray
    vocabulary: np.ndarray  # (item << 32 | word), sorted
    columns: np.ndarray  # (column, item): 1 if the item has a word of that column
    slots: np.ndarray  # (item, column): the column's number in the item, from 1; 0 for none
    times: list[np.ndarray]  # how often each numbered column stands in the item
    masks: list[dict[int, int]]  # of each item and of each answer, as lcs takes them
    answer_masks: list[dict[int, int]]
    window: int


def answer_of(text: str) -> str:
    """The last sentence of an item; its last five words if that is shorter or the whole item."""
    parts = [s for s in re.split(r"(?<=[.?!])\s+", text.strip()) if s]
    n = len(_WORD.findall(parts[-1])) if len(parts) > 1 else 0
    return " ".join(_WORD.findall(text)[-max(n, 5):])


def _unit(v: np.ndarray) -> np.ndarray:
    n = np.sqrt((v * v).sum(1, keepdims=True))
    return v / np.where(n > 0, n, 1)


def queries_of(items: list, space: np.ndarray, p: LeakParams) -> list[Queries]:
    out = []
    encoded = [(r.item_id, _encode(r.text), _encode(answer_of(r.text))) for r in items]
    for window, most in ((p.window, None), (16, p.window), (8, 16)):
        mine = [e for e in encoded if len(e[1]) >= (window if window > 8 else p.least)
                and (most is None or len(e[1]) < most)]
        item, offset, vectors = [], [], []
        for k, (_, words, _) in enumerate(mine):
            last = max(len(words) - window, 0)
            for at in sorted({*range(0, last, max(window // 2, 1)), last}):
                item.append(k)
                offset.append(at)
                vectors.append(space[words[at:at + window] % p.columns].sum(0))
        if mine:
            vocabulary = np.unique(np.concatenate([
                (np.uint64(k) << np.uint64(32)) | w.astype(np.uint64)
                for k, (_, w, _) in enumerate(mine)]))
            slots = np.zeros((len(mine), p.columns + 1), np.int32)  # the last one is padding
            times = []
            for k, (_, words, _) in enumerate(mine):
                used, n = np.unique(words % p.columns, return_counts=True)
                slots[k, used] = np.arange(1, len(used) + 1)
                times.append(n)
            out.append(Queries([e[0] for e in mine], [e[1] for e in mine], [e[2] for e in mine],
                               np.array(item), np.array(offset), _unit(np.array(vectors)),
                               vocabulary,
                               (slots.T > 0).astype(np.min_scalar_type(window), order="C"),
                               slots, times,
                               [places(e[1]) for e in mine],
                               [places(e[2]) for e in mine], window))
    return out


def places(pattern: np.ndarray) -> dict[int, int]:
    """Positions of every word of a pattern, one bit each."""
    where: dict[int, int] = {}
    for k, w in enumerate(pattern.tolist()):
        where[w] = where.get(w, 0) | (1 << k)
    return where


def lcs(where: dict[int, int], n: int, region: list[int], least: float = 0) -> int:
    """Length of the longest common subsequence of a pattern of ``n`` words and a region.

    It is at most the number of region words that the pattern has, and at most the
    number of its positions whose word the region has. Where either is below
    ``least`` the sequence is too, and 0 is returned.
    """
    hits = [m for m in map(where.get, region) if m]
    if len(hits) < least:
        return 0
    seen = 0
    for m in hits:
        seen |= m
    if seen.bit_count() < least:
        return 0
    full = (1 << n) - 1
    row = full
    for m in hits:
        hit = row & m
        row = ((row + hit) | (row - hit)) & full
    return n - row.bit_count()


def _search(rows: list[np.ndarray], q: Queries, space: np.ndarray,
            p: LeakParams) -> Iterator[tuple[int, int, float, float, float, int]]:
    """(row, item id, cosine, lcs share, answer share, first word) of confirmed matches."""
    step = q.window // 4
    # three empty cells end each text, so that none of its windows reaches into the next one
    padded = [np.concatenate([r, np.zeros(-len(r) % step + 3 * step, np.uint32)]) for r in rows]
    words = np.concatenate(padded)
    real = np.concatenate([np.arange(len(a)) < len(r) for a, r in zip(padded, rows, strict=True)])
    # padding has a column of its own that is zero in the space and in no item
    column = np.where(real, words % p.columns, p.columns)
    padded_space = np.concatenate([space, np.zeros_like(space[:1])])
    cells = row_sums(padded_space, column.reshape(-1, step))
    cell_row = np.repeat(np.arange(len(rows)), [len(a) // step for a in padded])
    sums = cells.copy()
    for k in range(1, 4):  # a window is four cells
        sums[:-k] += cells[k:]
    sums[~real[::step]] = 0  # no window starts in an empty cell
    sums = _unit(sums)
    begin = np.concatenate([[0], np.cumsum([len(a) // step for a in padded])])
    size = np.array([len(r) for r in rows])
    lengths = np.array([len(w) for w in q.words])
    floor = np.ceil(p.min_common * np.minimum(q.window, lengths)).astype(q.columns.dtype)
    best: dict[tuple[int, int], tuple] = {}
    asked: dict[tuple[int, int, int], tuple[float, float]] = {}  # lcs and answer of a region
    for lo in range(0, len(sums), BLOCK):
        cosine = sums[lo:lo + BLOCK] @ q.vectors.T
        likely = cosine >= p.min_cosine
        if not likely.any():
            continue
        # columns hold every word of an item, so their count is a bound of the exact one
        likely &= (_window_counts(column, q, lo, len(cosine)) >= floor).take(q.item, axis=1)
        cell, passage = np.divmod(np.flatnonzero(likely), cosine.shape[1])
        close = cosine[cell, passage]
        item = q.item[passage]
        need = lengths[item]
        cell = cell + lo
        at = cell[:, None] * step + np.arange(q.window)
        key = (item.astype(np.uint64)[:, None] << np.uint64(32)) | words[at].astype(np.uint64)
        place = np.minimum(np.searchsorted(q.vocabulary, key), len(q.vocabulary) - 1)
        common = ((q.vocabulary[place] == key) & real[at]).sum(1)
        hit = np.flatnonzero(common >= floor[item])
        row, k, n = cell_row[cell[hit]], item[hit], need[hit]
        first = (cell[hit] - begin[row]) * step
        begins = first - q.offset[passage[hit]]
        # the item may have grown or shrunk by inserted or dropped words
        slack = q.window // 2 + n // 2
        start, stop = np.maximum(begins - slack, 0), np.minimum(begins + n + slack, size[row])
        shared = _item_words(column, q, k, begin[row] * step + start, stop - start)
        for j in np.flatnonzero(shared >= p.min_lcs * n):
            _keep_best(best, asked, rows, q, p, int(row[j]), int(k[j]), int(begins[j]),
                       (int(start[j]), int(stop[j])), float(close[hit[j]]), int(first[j]))
    for (row, k), (share, close_, answer, first) in best.items():
        yield row, q.ids[k], close_, share, answer, first


def _window_counts(column: np.ndarray, q: Queries, lo: int, n: int) -> np.ndarray:
    """For the ``n`` windows from cell ``lo`` on, how many of their words' columns each item has.

    Counted once for each cell and added up, whatever the number of passages near a window.
    """
    step = q.window // 4
    count = row_sums(q.columns, column[lo * step:(lo + n + 3) * step].reshape(-1, step))
    total = count[:n].copy()
    for k in range(1, 4):
        more = count[k:k + n]  # shorter after the last cell
        total[:len(more)] += more
    return total


def _item_words(column: np.ndarray, q: Queries, item: np.ndarray, start: np.ndarray,
                size: np.ndarray, limit: int = 1_000_000) -> np.ndarray:
    """For each region ``start``, ``size`` how many words it and its item may share.

    Of each column the smaller of its two counts; columns hold every word, so no longest
    common subsequence is longer. Equal regions are counted once, about ``limit`` words
    at a time.
    """
    out = np.zeros(len(item), np.int64)
    order = np.lexsort((size, start, item))
    same = np.zeros(len(order), bool)
    same[1:] = ((np.diff(item[order]) == 0) & (np.diff(start[order]) == 0)
                & (np.diff(size[order]) == 0))
    which = np.cumsum(~same) - 1
    one = order[~same]
    upto = np.cumsum(size[one])
    count = np.zeros(len(one), np.int64)
    lo = 0
    while lo < len(one):
        done = upto[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(upto, done + limit, side="right")))
        length = size[one[lo:hi]]
        at = np.cumsum(length) - length
        words = np.arange(at[-1] + length[-1]) + np.repeat(start[one[lo:hi]] - at, length)
        has = q.slots.ravel().take(
            np.repeat(item[one[lo:hi]] * q.slots.shape[1], length) + column[words])
        times = [q.times[k] for k in item[one[lo:hi]].tolist()]
        slots = np.array([len(t) for t in times])
        base = np.cumsum(slots) - slots
        seen = np.flatnonzero(has)
        cell = np.repeat(base, length)[seen] + has[seen] - 1
        count[lo:hi] = np.add.reduceat(np.minimum(
            np.bincount(cell, minlength=slots.sum()), np.concatenate(times)), base)
        lo = hi
    out[order] = count[which]
    return out


def _keep_best(best: dict, asked: dict, rows: list[np.ndarray], q: Queries, p: LeakParams,
               row: int, k: int, begins: int, bounds: tuple[int, int], close: float,
               first: int) -> None:
    """Ask for one alignment of item ``k`` with a text; windows of one alignment ask once."""
    n, m = len(q.words[k]), len(q.answers[k])
    if (row, k, begins) not in asked:
        region = rows[row][bounds[0]:bounds[1]].tolist()
        share = lcs(q.masks[k], n, region, p.min_lcs * n) / n
        asked[row, k, begins] = (share, 0.0 if share < p.min_lcs else
                                 lcs(q.answer_masks[k], m, region) / max(m, 1))
    share, answer = asked[row, k, begins]
    if share >= p.min_lcs and (share >= p.verbatim or answer >= p.min_answer):
        best[row, k] = max(best.get((row, k), (0.0,)), (share, close, answer, first))


def leaks(docs: DataFrame, benchmark: DataFrame, p: LeakParams = LeakParams()) -> DataFrame:
    """One row per document and benchmark item that it holds.

    Columns doc_id, text_key, item_id, cosine, lcs, answer, first_word.
    """
    spark = docs.sparkSession
    schema = ("doc_id bigint, text_key bigint, item_id bigint, cosine double, lcs double, "
              "answer double, first_word bigint")
    words = stage(tokens(docs), "words")
    space = latent_space(words, p)
    bench = benchmark.where("text is not null").select("item_id", "text")
    blocks = -(-bench.count() // p.items)
    out = spark.createDataFrame([], schema)
    for block in range(blocks):
        some = bench.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        # about ``items`` items and the latent space, whatever the size of the corpus
        shared = spark.sparkContext.broadcast((queries_of(some.collect(), space, p), space))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            queries, space = shared.value
            for batch in batches:
                found = [(first + m[0], *m[1:]) for first, rows in _chunks(batch, 2)
                         for q in queries for m in _search(rows, q, space, p)]
                row = pa.array([m[0] for m in found], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(row), batch.column(1).take(row),
                     *(pa.array([m[k] for m in found], t) for k, t in enumerate(
                         (pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64()), 1))],
                    ["doc_id", "text_key", "item_id", "cosine", "lcs", "answer", "first_word"])

        out = out.union(words.mapInArrow(run, schema))
    return (out.groupBy("doc_id", "text_key", "item_id")
            .agg(F.max(F.struct("lcs", "cosine", "answer", "first_word")).alias("m"))
            .select("doc_id", "text_key", "item_id", "m.cosine", "m.lcs", "m.answer",
                    "m.first_word"))


def without_leaks(docs: DataFrame, benchmark: DataFrame,
                  p: LeakParams = LeakParams()) -> DataFrame:
    """Rows of ``docs`` that hold no benchmark item."""
    bad = stage(leaks(docs, benchmark, p).select(F.col("doc_id").alias("d"), "text_key")
                .distinct(), "leaks")
    return docs.join(bad, docs.doc_id.eqNullSafe(bad.d)
                     & (F.xxhash64(docs.text) == bad.text_key), "left_anti")
