"""Quality classifier: naive Bayes support vectors (operator 5).

A document is a set of n-gram indicators: word 1- and 2-grams, 1- to 3-grams of
word shapes (letter case, digits and marks, runs collapsed), and two indicators
of size and repetition. Indicators are hashed to ``2**bits`` columns and scaled
by the class log-count ratio, which Spark counts over all labelled rows that may
be learnt from. On a bounded sample of them (``sample`` rows a class, the first
by hash of the id), a linear hinge-loss model is fitted by dual coordinate
descent; a fifth of the sample, kept apart, scales margins to probabilities.

Null and empty texts have only the size indicator and get a score like any
other. Without labelled rows of both classes every score is the share of
label 1 (0.5 without any). Labels that are null, and rows without an id, are
not learnt from.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from followrec.llm.common import stage
from followrec.llm.linear import HELD_OUT, dual_coordinate_descent, fit_scaling, probability
from followrec.llm.textvec import LOWER, RangeHash, Texts, gram, mix64, slices, words_of


@dataclass(frozen=True)
class NbsvmParams:
    bits: int = 18
    sample: int = 1500  # labelled rows a class for the hinge-loss fit
    smooth: float = 1.0
    cost: float = 1.0
    threshold: float = 0.3


#: Shape of a byte: letters by case (multi-byte counts as lower), digits, marks themselves.
_SHAPE = np.arange(256, dtype=np.uint8)
_SHAPE[97:123] = _SHAPE[128:] = ord("a")
_SHAPE[65:91] = ord("A")
_SHAPE[48:58] = ord("0")


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves no remainder; false for a null id."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % HELD_OUT == 0, F.lit(False))


def indicators(texts: Texts, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (text index, column) pairs, sorted by text."""
    low = Texts(LOWER[texts.buf], texts.offs)
    words = words_of(low)
    owner = words.text
    shape = _SHAPE[texts.buf]
    fresh = np.ones(len(shape), bool)
    fresh[1:] = shape[1:] != shape[:-1]
    fresh[words.start] = True
    kept = np.concatenate([[0], np.cumsum(fresh)])
    shapes = RangeHash(shape[fresh])(kept[words.start], kept[words.end])
    plain = RangeHash(low.buf)(words.start, words.end)
    owners, grams = [], []
    for family, (hashes, n) in enumerate(((plain, 1), (plain, 2), (shapes, 1), (shapes, 2),
                                          (shapes, 3))):
        g, at = gram(hashes, words.first, n)
        owners.append(owner[at])
        grams.append(mix64(g + np.uint64(family)))
    count = np.diff(words.first)
    threes, at = gram(plain, words.first, 3)
    distinct = np.unique(mix64(threes + mix64(owner[at].astype(np.uint64))), return_index=True)[1]
    fresh3 = np.bincount(owner[at[distinct]], minlength=len(texts))
    share = np.floor(10 * fresh3 / np.maximum(count - 2, 1)).astype(np.uint64)
    for family, level in ((7, np.floor(np.log2(count + 1)).astype(np.uint64)), (8, share)):
        owners.append(np.arange(len(texts)))
        grams.append(mix64(level * np.uint64(16) + np.uint64(family)))
    column = np.concatenate(grams) >> np.uint64(64 - bits)
    key = np.unique((np.concatenate(owners).astype(np.int64) << bits) | column.astype(np.int64))
    return key >> bits, key & ((1 << bits) - 1)


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Staged (doc_id, text, label) of the labelled rows that may be learnt from.

    Labels grow with the documents, so they are never broadcast: both sides are
    sorted by id at every size, and only learnable documents are shuffled.
    """
    labels = (labels.where(F.col("label").isin(0, 1) & ~held_out(F.col("doc_id")))
              .select("doc_id", F.col("label").cast("int")))
    return stage(docs.select("doc_id", "text").join(labels.hint("merge"), "doc_id"), "labelled")


def _first_by_hash(train: DataFrame, label: int, n: int) -> pa.Table:
    """label and text of the n rows of a label that come first by hash of id and text.

    They are chosen by hashes and row positions of the staged table, so that no
    task sends texts to the driver that are not chosen. They come as Arrow batches,
    without an object for every row in the driver.
    """
    place = [F.col("_metadata.file_name").alias("file"), F.col("_metadata.row_index").alias("row")]
    hashes = [F.xxhash64("doc_id").alias("h"), F.xxhash64("text").alias("t")]
    rows = train.where(F.col("label") == label)
    keys = ["h", "t", "file", "row"]
    first = rows.select(*hashes, *place).orderBy(*keys).limit(n)
    got = (rows.select("label", F.coalesce("text", F.lit("")).alias("text"), *place)
           .join(F.broadcast(first), ["file", "row"]).toArrow())  # n rows
    return got.sort_by([(k, "ascending") for k in keys]).select(["label", "text"])


def _log_ratio(train: DataFrame, p: NbsvmParams) -> np.ndarray:
    """Class log-count ratio of every column, counted over all learnable rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros((2, 1 << p.bits), np.int64)
        for batch in batches:
            for rows, texts in slices(batch):
                label = rows.column(0).to_numpy().astype(int)
                owner, column = indicators(texts, p.bits)
                np.add.at(count, (label[owner], column), 1)
        used = np.flatnonzero(count.sum(0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(count[0, used]), pa.array(count[1, used])],
            ["item", "n0", "n1"])

    got = (train.select("label", "text").mapInArrow(run, "item bigint, n0 bigint, n1 bigint")
           .groupBy("item").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow())
    n = np.full((2, 1 << p.bits), p.smooth)  # at most 2**bits rows came to the driver
    for k in range(2):
        n[k, got["item"].to_numpy()] += got[f"n{k}"].to_numpy()
    return np.log((n[1] / n[1].sum()) / (n[0] / n[0].sum()))


def _scaled(owner: np.ndarray, column: np.ndarray, ratio: np.ndarray,
            n: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Per text its columns and their log-count ratios, scaled to length 1."""
    first = np.searchsorted(owner, np.arange(n + 1))
    for i in range(n):
        at = column[first[i]:first[i + 1]].astype(np.int32)
        v = ratio[at]
        yield at, v / (np.sqrt(v @ v) or 1.0)


@dataclass
class NbsvmModel:
    weights: np.ndarray  # hinge-loss weight times log-count ratio
    ratio: np.ndarray
    slope: float
    offset: float
    bits: int

    def score(self, texts: Texts) -> np.ndarray:
        owner, column = indicators(texts, self.bits)
        n = len(texts)
        dot = np.bincount(owner, self.weights[column], minlength=n)
        size = np.sqrt(np.bincount(owner, self.ratio[column] ** 2, minlength=n))
        return probability(dot / np.where(size > 0, size, 1), self.slope, self.offset)


def fit(docs: DataFrame, labels: DataFrame, p: NbsvmParams = NbsvmParams()) -> NbsvmModel:
    """Model of ``labels(doc_id, label)`` on ``docs(doc_id, text)``."""
    train = labelled(docs, labels)
    ratio = _log_ratio(train, p)
    both = pa.concat_tables([_first_by_hash(train, k, p.sample) for k in (0, 1)])
    y = 2 * both["label"].to_numpy() - 1
    if len(set(y.tolist())) < 2:
        share = (y > 0).mean() if len(y) else 0.5
        share = np.clip(share, 1e-6, 1 - 1e-6)
        return NbsvmModel(np.zeros(1 << p.bits), ratio, 1.0, float(np.log(share / (1 - share))),
                          p.bits)
    rows: list[tuple[np.ndarray, np.ndarray]] = []
    for batch in both.to_batches():
        for _, texts in slices(batch):
            rows += _scaled(*indicators(texts, p.bits), ratio, len(texts))
    apart = np.arange(len(rows)) % 5 == 0
    learn = np.flatnonzero(~apart)
    cost = np.where(y > 0, p.cost * (y < 0).sum() / (y > 0).sum(), p.cost)
    w = dual_coordinate_descent([rows[i] for i in learn], y[learn], 1 << p.bits, cost[learn])
    margin = np.array([w[at] @ v for at, v in rows])
    total = {r.label: r["count"] for r in train.groupBy("label").count().collect()}
    weight = np.where(y > 0, total[1] / (y > 0).sum(), total[0] / (y < 0).sum())
    weight = weight * apart.sum() / weight[apart].sum()
    slope, offset = fit_scaling(margin[apart], y[apart], weight[apart])
    return NbsvmModel(w * ratio, ratio, slope, offset, p.bits)


def score_documents(docs: DataFrame, labels: DataFrame,
                    p: NbsvmParams = NbsvmParams()) -> DataFrame:
    """All columns of ``docs`` with held_out, score and predicted added.

    Columns of these three names that ``docs`` already has are replaced.
    """
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, p))  # 2**bits weights
    fields = [f for f in docs.schema.fields
              if f.name.lower() not in ("held_out", "score", "predicted")]
    names = [f.name for f in fields]
    docs = docs.select(*(F.col(f"`{n}`") for n in names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in slices(batch):
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(model.value.score(texts))],
                    [*names, "score"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in fields)
    return (docs.mapInArrow(run, f"{schema}, score double")
            .withColumn("held_out", held_out(F.col("doc_id")))
            .withColumn("predicted", (F.col("score") >= p.threshold).cast("int"))
            .select(*(F.col(f"`{n}`") for n in names), "held_out", "score", "predicted"))
