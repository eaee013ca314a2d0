"""Quality rules by distribution divergence (operator 2).

Two histograms of a document are compared with references of its language by
Jensen-Shannon distance (base 2, 0 to 1): its byte classes, and its common
words. References are made from all documents of a language that pass the base
rules; the common words are the language's words with the highest document
counts. A language with fewer than ``min_reference`` such documents, or none,
is compared with every reference, and the closest counts. Histograms over fewer
than ``min_chars`` characters or ``min_common`` common words are not judged: a
short text says too little about a distribution.

Null texts have no words and fail the base rules. A null doc_id or lang is kept
as it is; repeated rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from followrec.llm.common import stage
from followrec.llm.textvec import (LOWER, RangeHash, Texts, gram, lines_of, mix64, slices,
                                   words_of)

#: Byte classes: lower, upper, digit, space, sentence marks, other ASCII, multi-byte.
CLASSES = 7
_CLASS = np.full(256, 5, np.uint8)
_CLASS[97:123] = 0
_CLASS[65:91] = 1
_CLASS[48:58] = 2
_CLASS[[32, 9, 10, 11, 12, 13]] = 3
_CLASS[[ord(c) for c in ".,;:!?'\"-"]] = 4
_CLASS[128:] = 6

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True


@dataclass(frozen=True)
class DivergenceParams:
    min_words: int = 50
    max_repeat_percent: int = 50
    common_words: int = 64  # per language
    max_class_distance: float = 0.22
    max_word_distance: float = 0.7
    min_chars: int = 200
    min_common: int = 20
    min_reference: int = 20


def base_counts(texts: Texts) -> dict[str, np.ndarray]:
    """Per text: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    words = words_of(texts)
    chars = np.concatenate([[0], np.cumsum((texts.buf & 0xC0) != 0x80)])
    per = np.diff(words.first)
    out = {"n_words": per.astype(np.int64)}
    sizes = np.concatenate([[0], np.cumsum(chars[words.end] - chars[words.start])])
    out["word_chars"] = sizes[words.first[1:]] - sizes[words.first[:-1]]
    marks = np.concatenate([[0], np.cumsum(_SYMBOL[texts.buf])])
    out["n_symbols"] = marks[texts.offs[1:]] - marks[texts.offs[:-1]]
    ranged = RangeHash(texts.buf)
    text = words.text

    lines = lines_of(texts)
    full = np.searchsorted(words.start, lines.end) > np.searchsorted(words.start, lines.start)
    start, end, owner = lines.start[full], lines.end[full], lines.text[full]
    keys = mix64(ranged(start, end) + mix64(owner.astype(np.uint64)))
    again = np.ones(len(keys), bool)
    again[np.unique(keys, return_index=True)[1]] = False
    out["n_dup_lines"] = np.bincount(owner[again], minlength=len(texts)).astype(np.int64)

    threes, at = gram(ranged(words.start, words.end), words.first, 3)
    keys = mix64(threes + mix64(text[at].astype(np.uint64)))
    _, inverse, count = np.unique(keys, return_inverse=True, return_counts=True)
    hit = at[count[inverse] > 1]
    cover = np.zeros(len(text) + 1, bool)
    for k in range(3):
        cover[hit + k] = True
    out["n_repeat_words"] = np.bincount(text[cover[:-1]], minlength=len(texts)).astype(np.int64)
    return out


def base_failed(c: dict[str, np.ndarray], p: DivergenceParams) -> np.ndarray:
    return (c["n_words"] < p.min_words) | (
        100 * c["n_repeat_words"] > p.max_repeat_percent * c["n_words"])


def class_histogram(texts: Texts) -> np.ndarray:
    """Characters per class; a multi-byte character counts once."""
    lead = (texts.buf & 0xC0) != 0x80
    owner = np.repeat(np.arange(len(texts)), np.diff(texts.offs))
    cell = owner[lead] * CLASSES + _CLASS[texts.buf[lead]]
    return np.bincount(cell, minlength=len(texts) * CLASSES).reshape(len(texts), CLASSES)


def word_hashes(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased word hashes (ASCII letters) and their text's index."""
    low = Texts(LOWER[texts.buf], texts.offs)
    words = words_of(low)
    return RangeHash(low.buf)(words.start, words.end).view(np.int64), words.text


def js_distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Square root of the Jensen-Shannon divergence (base 2) of each row of a with b."""
    pa_ = a / np.maximum(a.sum(1, keepdims=True), 1e-300)
    q = b / max(b.sum(), 1e-300)
    m = (pa_ + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        kl = (np.where(pa_ > 0, pa_ * np.log2(pa_ / m), 0).sum(1)
              + np.where(q > 0, q * np.log2(q / m), 0).sum(1)) / 2
    return np.sqrt(np.clip(kl, 0, 1))


def references(docs: DataFrame, p: DivergenceParams) -> dict[str, dict]:
    """Per language: documents, class histogram, common words and their counts.

    Word and class counts are summed by Spark over all documents that pass the
    base rules; only ``common_words`` words a language come to the driver.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in slices(batch):
                good = ~base_failed(base_counts(texts), p)
                langs = rows.column(0).to_pylist()
                hist = class_histogram(texts)
                words, owner = word_hashes(texts)
                for lang in {x for x, ok in zip(langs, good, strict=True) if ok and x is not None}:
                    mine = good & np.array([x == lang for x in langs])
                    pick = mine[owner]
                    seen, which, n_all = np.unique(words[pick], return_inverse=True,
                                                   return_counts=True)
                    # each word and text once, then the texts of each word
                    pairs = np.unique(which * len(texts) + owner[pick])
                    n_docs = np.bincount(pairs // len(texts), minlength=len(seen))
                    item = np.concatenate([np.arange(-1, CLASSES), seen])
                    n = np.concatenate([[mine.sum()], hist[mine].sum(0), n_all])
                    n_docs = np.concatenate([np.zeros(CLASSES + 1, np.int64), n_docs])
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat(pa.scalar(lang, pa.string()), len(item)), pa.array(item),
                         pa.array(n), pa.array(n_docs)], ["lang", "item", "n", "n_docs"])

    got = stage(docs.select("lang", "text").mapInArrow(
        run, "lang string, item bigint, n bigint, n_docs bigint")
        .groupBy("lang", "item", (F.col("n_docs") > 0).alias("word"))
        .agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs")), "references")
    refs: dict[str, dict] = {}
    for r in got.where("not word").collect():  # CLASSES + 1 rows a language
        ref = refs.setdefault(r.lang, {"classes": np.zeros(CLASSES), "docs": 0})
        if r["item"] < 0:
            ref["docs"] = r.n
        else:
            ref["classes"][r["item"]] = r.n
    refs = {k: v for k, v in refs.items() if v["docs"] >= p.min_reference}
    order = Window.partitionBy("lang").orderBy(F.desc("n_docs"), F.desc("n"), "item")
    top: dict[str, list] = {}
    for r in (got.where("word").withColumn("place", F.row_number().over(order))
              .where(F.col("place") <= p.common_words).orderBy("lang", "item").collect()):
        top.setdefault(r.lang, []).append(r)
    for lang, ref in refs.items():
        ref["words"] = np.array([r["item"] for r in top.get(lang, [])], np.int64)
        ref["counts"] = np.array([r.n for r in top.get(lang, [])], float)
    return refs


def quality_rules(docs: DataFrame, p: DivergenceParams = DivergenceParams()) -> DataFrame:
    """Counts, distances and verdict per row of ``docs(doc_id, text, lang)``.

    ``class_distance`` and ``word_distance`` are null where the text is too
    short to judge, or where there is no reference.
    """
    refs = references(docs, p)

    def distances(hist: np.ndarray, texts: Texts, langs: list) -> tuple[np.ndarray, np.ndarray]:
        words, owner = word_hashes(texts)
        by_class = np.full(len(texts), np.nan)
        by_word = np.full(len(texts), np.nan)
        for lang, ref in refs.items():
            mine = np.array([x == lang or x not in refs for x in langs], bool)
            d = np.where(hist.sum(1) >= p.min_chars, js_distance(hist, ref["classes"]), np.nan)
            by_class[mine] = np.fmin(by_class[mine], d[mine])
            at = np.searchsorted(ref["words"], words)
            at[at == len(ref["words"])] = 0
            found = ref["words"][at] == words
            k = len(ref["words"])
            cells = np.bincount(owner[found] * k + at[found], minlength=len(texts) * k)
            cells = cells.reshape(len(texts), k)
            d = np.where(cells.sum(1) >= p.min_common, js_distance(cells, ref["counts"]), np.nan)
            by_word[mine] = np.fmin(by_word[mine], d[mine])
        return by_class, by_word

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in slices(batch):
                c = base_counts(texts)
                failed = base_failed(c, p)
                by_class, by_word = distances(class_histogram(texts), texts,
                                              rows.column(1).to_pylist())
                with np.errstate(invalid="ignore"):
                    far = (by_class > p.max_class_distance) | (by_word > p.max_word_distance)
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), *(pa.array(v, pa.int64()) for v in c.values()),
                     pa.array(failed), pa.array(~failed & ~far),
                     pa.array(by_class, from_pandas=True), pa.array(by_word, from_pandas=True)],
                    ["doc_id", *c, "base_failed", "kept", "class_distance", "word_distance"])

    return docs.select("doc_id", "lang", "text").mapInArrow(
        run, "doc_id bigint, n_words bigint, word_chars bigint, n_symbols bigint, "
             "n_dup_lines bigint, n_repeat_words bigint, base_failed boolean, kept boolean, "
             "class_distance double, word_distance double")
