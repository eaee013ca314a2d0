"""Phrase collocation mining by best-first branch-and-bound growth (operator 12).

Phrases of two to four words are scored by their lowest cut: 2,000,000 * a over the sum of
the counts of the two parts. Counting all phrases of four words is what this operator
avoids. Words and pairs are counted; longer phrases grow from a prefix only while they can
matter. A prefix p that begins with the word w bounds every phrase that grows from it:

    score <= 2,000,000 * f(p) / (f(w) + f(p))

since the phrase occurs at most f(p) times, its rest at least as often as itself, and the
cut after w is one of its cuts. Each round takes, per language, the score of the last of
the first ``keep`` surviving phrases known so far as the floor and expands every unexpanded
prefix whose bound reaches it (ties included). It also expands the prefixes of longer
phrases that could drop a phrase above the floor, and of the rests needed for a score. When
no such prefix is left the floor is settled: nothing unexpanded can reach it. A round opens
the frontier a little below the floor, each time twice as far, which only saves rounds.

One round is one pass over the texts, whatever the number of prefixes: tasks look phrases up
in bitmaps of a fixed size (hash of language and phrase), count what they let through and
hand it to Spark's partial aggregation. A phrase passes by its own hash and those of its
parts, in every task or in none, so counts are exact; wrong bits only cost time. Prefixes
and counts never pass through the driver, which sees the bitmaps (2 MB each) alone. Inside
a task words and phrases are told apart by exact dictionary ids, not by hashes. A language
that holds all rows is no hot key: only its top ``keep`` per task are ranked, and floors of
large languages are broadcast (fewer than 1,000).

Defined results: null texts are empty, a null language is ``und``; repeated rows count each
time; ties go by a, then by the phrase's bytes; empty tables give no rows; other columns are
ignored. Texts are read whole, in slices of about 1.5 MB or one longer text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from followrec.llm.common import join_groups, stage
from followrec.llm.textvec import LOWER, RangeHash, Texts, mix64, ranges, slices, texts_of

LONGEST = 4


@dataclass(frozen=True)
class PhraseParams:
    least: int = 30  # occurrences of a candidate
    keep: int = 2000  # phrases per language
    cover: int = 80  # a phrase goes with a longer one that has this percentage of it
    bits: int = 1 << 24  # of a bitmap
    slack: float = 0.5  # of the floor, by which the first round goes below it


# ---------------------------------------------------------------- phrases of a slice of texts
#: 1 between words, 2 between pieces.
GAP = np.zeros(256, np.uint8)
GAP[[0x20, 0x09]] = 1
GAP[[*b".,;:!?", *range(0x0A, 0x0E)]] = 2

_STEP = np.uint64(0x9E3779B97F4A7C15)


def _hashes(strings: pa.Array) -> np.ndarray:
    t = texts_of(strings)
    return RangeHash(t.buf)(t.offs[:-1], t.offs[1:])


def _dense(ids: np.ndarray, bound: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct ids below ``bound`` in order, and the number of each id among them."""
    if bound > 4 * len(ids) + 1024:  # many languages: sorting is smaller than a table
        return np.unique(ids, return_inverse=True)
    there = np.zeros(bound, bool)
    there[ids] = True
    return np.flatnonzero(there), (np.cumsum(there) - 1)[ids]


class Slice:
    """Words of a slice: ``word`` numbers distinct (language, word), ``run`` the pieces."""

    def __init__(self, langs: pa.Array, texts: Texts):
        gap = GAP[texts.buf]
        inside = gap == 0
        start, end = ranges(inside, texts.offs)
        text = np.searchsorted(texts.offs, start, side="right") - 1
        ends = np.concatenate([[0], np.cumsum(end - start)])
        data = LOWER[texts.buf][inside]
        words = pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(ends.astype(np.int64)),
                                                 pa.py_buffer(data)).dictionary_encode()
        langs = langs.dictionary_encode()
        known = max(len(words.dictionary), 1)
        lang = langs.indices.to_numpy(zero_copy_only=False).astype(np.int64)[text]
        both, self.word = _dense(lang * known + words.indices.to_numpy(), known *
                                 max(len(langs.dictionary), 1))
        self.spelling = words.dictionary.take(pa.array(both % known))
        self.lang = langs.dictionary.take(pa.array(both // known))
        self.run = np.cumsum(gap == 2)[start] + text  # grows by 1 at least at every border
        self.lang_hash = _hashes(langs.dictionary)[both // known]
        self.word_hash = _hashes(words.dictionary)[both % known]

    def same_piece(self, n: int) -> np.ndarray:
        """Positions where a phrase of n words stands."""
        last = len(self.run) - n + 1
        if last <= 0:
            return np.empty(0, np.int64)
        return np.flatnonzero(self.run[:last] == self.run[n - 1:])

    def hash(self, at: np.ndarray, n: int) -> np.ndarray:
        out = self.lang_hash[self.word[at]]
        for k in range(n):
            out = out * _STEP + self.word_hash[self.word[at + k]]
        return mix64(out)

    def counted(self, at: np.ndarray, ids: np.ndarray, n: int) -> pa.RecordBatch:
        """Phrases of n words at ``at``, equal where their ``ids`` are, with their counts."""
        _, first, count = np.unique(ids, return_index=True, return_counts=True)
        at = at[first]
        parts = [self.spelling.take(pa.array(self.word[at + k])) for k in range(n)]
        phrase = pc.binary_join_element_wise(*parts, pa.scalar(" ", pa.large_string()))
        return pa.RecordBatch.from_arrays(
            [self.lang.take(pa.array(self.word[at])).cast(pa.string()), phrase.cast(pa.string()),
             pa.array(np.full(len(at), n, np.int32)), pa.array(count.astype(np.int64))],
            ["lang", "phrase", "size", "a"])


COUNTS = "lang string, phrase string, size int, a bigint"
SLICE_BYTES = 1_500_000


def _numbered(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Equal ids by number: (number of each, a position of each number, how many)."""
    _, first, number = np.unique(ids, return_index=True, return_inverse=True)
    return number, first, len(first)


def count_words(s: Slice) -> Iterator[pa.RecordBatch]:
    at = np.arange(len(s.word))
    yield s.counted(at, s.word, 1)


def count_pairs(s: Slice, common: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Pairs of words that the bitmap has both."""
    seen = np.zeros(len(s.spelling), np.int64)
    seen[s.word] = np.arange(len(s.word))
    good = _has(common, s.hash(seen, 1))
    at = s.same_piece(2)
    at = at[good[s.word[at]] & good[s.word[at + 1]]]
    yield s.counted(at, s.word[at] * len(s.spelling) + s.word[at + 1], 2)


def count_grown(s: Slice, common: np.ndarray, two: np.ndarray,
                three: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Phrases of three words grown from the prefixes in ``two``, of four from ``three``,
    as far as all their pairs are in ``common``."""
    at = s.same_piece(2)
    at = at[_has(common, s.hash(at, 2))]  # before numbering: few pairs are common
    number, first, pairs = _numbered(s.word[at] * len(s.spelling) + s.word[at + 1])
    grows = _has(two, s.hash(at[first], 2))
    pair = np.full(len(s.word) + 3, -1)  # number of the common pair at each position
    pair[at] = number
    at = at[pair[at + 1] >= 0]  # three words, of one piece as both pairs are
    ids = pair[at] * pairs + pair[at + 1]
    chosen = grows[pair[at]]
    yield s.counted(at[chosen], ids[chosen], 3)
    chosen = pair[at + 2] >= 0
    at, ids = at[chosen], ids[chosen]
    number, first, _ = _numbered(ids)
    chosen = _has(three, s.hash(at[first], 3))[number]
    at, number = at[chosen], number[chosen]
    yield s.counted(at, number * pairs + pair[at + 2], 4)


def _has(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = (hashes % np.uint64(len(bitmap) * 8)).astype(np.int64)
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def _passes(docs: DataFrame, count, *bitmaps: np.ndarray) -> DataFrame:
    """Counts of the phrases that ``count`` finds in every slice, all over the texts."""
    sent = [docs.sparkSession.sparkContext.broadcast(b) for b in bitmaps]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in slices(batch, limit=SLICE_BYTES):
                s = Slice(part.column(0), texts)
                for out in count(s, *(b.value for b in sent)):
                    if out.num_rows:
                        yield out

    return (docs.mapInArrow(run, COUNTS).groupBy("lang", "phrase", "size")
            .agg(F.sum("a").alias("a")))


def _phrase_hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hash of every (lang, phrase), the same as :meth:`Slice.hash` gives."""
    for batch in batches:
        phrases = batch.column(1).to_pylist()
        out = _hashes(batch.column(0)) if phrases else np.empty(0, np.uint64)
        words = [p.split(" ") for p in phrases]
        for k in range(LONGEST):
            have = np.array([i for i, w in enumerate(words) if len(w) > k], np.int64)
            if len(have):
                h = _hashes(pa.array([words[i][k] for i in have], pa.large_string()))
                out[have] = out[have] * _STEP + h
        yield pa.RecordBatch.from_arrays([pa.array(mix64(out).view(np.int64))], ["hash"])


def _bitmap(phrases: DataFrame, bits: int) -> np.ndarray:
    """Bitmap of ``phrases(lang, phrase)``: ``bits`` / 8 bytes, whatever their number."""
    hashes = phrases.select("lang", "phrase").mapInArrow(_phrase_hashes, "hash bigint")
    # the unsigned hash modulo a power of two is its lowest bits
    at = F.col("hash").bitwiseAND(F.lit(bits - 1)) + 1
    rows = (hashes.groupBy(F.bitmap_bucket_number(at).alias("bucket"))
            .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect())
    out = np.zeros(bits // 8, np.uint8)
    for r in rows:
        lo = (r.bucket - 1) * 4096
        out[lo:lo + 4096] = np.frombuffer(r.bits, np.uint8)[:len(out) - lo]
    return out


# ---------------------------------------------------------------- scores and the frontier
#: All words of a phrase but the last, or but the first.
HEAD = "array_join(slice(split(phrase, ' '), 1, size - 1), ' ')"
TAIL = "array_join(slice(split(phrase, ' '), 2, size - 1), ' ')"
#: Products pass 64 bits, hence decimals.
SCORE = "cast(a as decimal(20, 0)) * 2000000 div (cast(l as decimal(20, 0)) + r)"


def _scored(new: DataFrame, counts: DataFrame) -> DataFrame:
    """``new(lang, phrase, size, a)`` with l, r, score of its lowest cut and its bound."""
    cuts = new.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("cut"))
    cuts = cuts.withColumns({
        "left": F.expr("array_join(slice(split(phrase, ' '), 1, cut), ' ')"),
        "right": F.expr("array_join(slice(split(phrase, ' '), cut + 1, size), ' ')")})
    left = counts.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l"))
    right = counts.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r"))
    cuts = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    low = F.min(F.struct(F.expr(SCORE).alias("score"), "cut", "l", "r")).alias("low")
    out = cuts.groupBy("lang", "phrase", "size", "a").agg(
        low, F.max(F.when(F.col("cut") == 1, F.col("l"))).alias("begin"))
    bound = "cast(a as decimal(20, 0)) * 2000000 div (cast(begin as decimal(20, 0)) + a)"
    return out.select("lang", "phrase", "size", "a", "low.l", "low.r", "low.score",
                      F.expr(bound).alias("bound"))


def _covers(a: str, b: str, p: PhraseParams) -> Column:
    """Whether a count ``b`` of a longer phrase is enough to drop one of ``a``."""
    return F.expr(f"cast({b} as decimal(20, 0)) * 100 >= cast({a} as decimal(20, 0)) * {p.cover}")


def _surviving(known: DataFrame, p: PhraseParams) -> DataFrame:
    """The candidates that no known longer phrase drops; one more word is enough to look at,
    since a longer phrase with a count as high holds such a one."""
    longer = known.where("size > 2").select("lang", F.explode(F.expr(f"array({HEAD}, {TAIL})")).alias("phrase"),
                                            F.col("a").alias("most"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("most").alias("most"))
    return (known.join(longer, ["lang", "phrase"], "left")
            .where(F.col("most").isNull() | ~_covers("a", "most", p)).drop("most"))


def _first(phrases: DataFrame, p: PhraseParams) -> DataFrame:
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return phrases.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= p.keep)


def _frontier(known: DataFrame, expanded: DataFrame, p: PhraseParams, slack: float) -> DataFrame:
    """Unexpanded prefixes (lang, phrase, size, must) that may matter; ``must`` marks those
    without which the floor is not settled."""
    alive = stage(_surviving(known, p), "alive")
    sizes = known.groupBy("lang").agg(F.count("*").alias("in_lang"))
    full = (_first(alive, p).groupBy("lang")
            .agg(F.when(F.count("*") >= p.keep, F.min("score")).otherwise(0).alias("floor")))
    floors = stage(sizes.join(full, "lang", "left")
                   .select("lang", "in_lang", F.coalesce("floor", F.lit(0)).alias("floor")),
                   "floors")
    total = known.count()
    above = stage(join_groups(alive, floors, ["lang"], "in_lang", total)
                  .where(F.col("score") >= F.col("floor"))
                  .select("lang", "phrase", "size", "a"), "above")
    # a longer phrase that drops one above the floor begins one word earlier
    word = (above.where("size < 4").groupBy("lang", F.split("phrase", " ")[0].alias("tail"))
            .agg(F.min("a").alias("needs")))
    pair = (above.where("size = 3").groupBy("lang", F.expr(HEAD).alias("tail"))
            .agg(F.min("a").alias("needs")))
    needs = word.unionByName(pair)
    open_ = (known.where("size < 4")
             .select("lang", "phrase", "size", "a", "bound", F.expr(TAIL).alias("tail"))
             .join(expanded, ["lang", "phrase"], "left_anti"))
    judged = (join_groups(open_, floors, ["lang"], "in_lang", total)
              .join(needs, ["lang", "tail"], "left")
              .withColumn("must", (F.col("bound") >= F.col("floor")) | F.coalesce(
                  _covers("needs", "a", p), F.lit(False)))
              .where(F.col("must") | (F.col("bound") >= F.col("floor") * (1 - slack))))
    judged = stage(judged.select("lang", "phrase", "size", "must", "tail"), "judged")
    # the score of abcd needs the count of bcd, which grows from bc
    rests = (judged.where("size = 3").groupBy("lang", F.col("tail").alias("phrase"))
             .agg(F.max("must").alias("must"))
             .select("lang", "phrase", F.lit(2).alias("size"), "must")
             .join(expanded, ["lang", "phrase"], "left_anti"))
    return stage(judged.drop("tail").unionByName(rests).groupBy("lang", "phrase", "size")
                 .agg(F.max("must").alias("must")), "frontier")


def mine(docs: DataFrame, p: PhraseParams = PhraseParams()) -> DataFrame:
    """The first ``keep`` phrases of every language of ``docs(lang, text)``.

    Columns: lang, rank, phrase, a, l, r, n, score.
    """
    docs = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    words = stage(_passes(docs, count_words), "words")
    totals = words.groupBy("lang").agg(F.sum("a").alias("n"))
    words = words.where(F.col("a") >= p.least)
    pairs = _passes(docs, count_pairs, _bitmap(words, p.bits)).where(F.col("a") >= p.least)
    pairs = stage(pairs, "pairs")
    known = stage(_scored(pairs, words), "known")
    expanded = known.select("lang", "phrase").limit(0)
    common, slack = _bitmap(pairs, p.bits), p.slack
    while True:
        frontier = _frontier(known, expanded, p, min(slack, 1.0))
        if frontier.where("must").isEmpty():
            break
        found = _passes(docs, count_grown, common, _bitmap(frontier.where("size = 2"), p.bits),
                        _bitmap(frontier.where("size = 3"), p.bits))
        # what wrong bits let through is left to the round that expands it
        grown = stage(found.where(F.col("a") >= p.least).withColumn("head", F.expr(HEAD))
                      .join(frontier.select("lang", F.col("phrase").alias("head")),
                            ["lang", "head"], "left_semi").drop("head"), "grown")
        counts = (words.select("lang", "phrase", "a").unionByName(known.select("lang", "phrase", "a"))
                  .unionByName(grown.select("lang", "phrase", "a")))
        known = known.unionByName(stage(_scored(grown, counts), "known"))
        expanded = expanded.unionByName(frontier.select("lang", "phrase"))
        slack *= 2
    top = _first(_surviving(known, p), p)
    return top.join(totals, "lang").select(
        "lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


#: DuckDB SQL of the query.
ORACLE_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
           translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), spelt AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), starts AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM spelt
), counts AS (
  SELECT lang, array_to_string(w[i:i + k - 1], ' ') AS phrase, k::BIGINT AS size, count(*) AS f
  FROM starts, range(1, 5) AS sizes(k) WHERE i + k - 1 <= len(w) GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM counts WHERE size = 1 GROUP BY lang
), candidates AS (
  SELECT lang, phrase, size, f AS a, string_split(phrase, ' ') AS w
  FROM counts WHERE size > 1 AND f >= 30
), cuts AS (
  SELECT lang, phrase, size, a, k, array_to_string(w[:k], ' ') AS head,
         array_to_string(w[k + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates)
), scored AS (
  SELECT c.*, x.f AS l, y.f AS r, (2000000::HUGEINT * a // (x.f::HUGEINT + y.f))::BIGINT AS score
  FROM cuts c JOIN counts x ON x.lang = c.lang AND x.phrase = c.head
              JOIN counts y ON y.lang = c.lang AND y.phrase = c.rest
), lowest AS (
  SELECT * FROM scored
  QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_phrases AS (
  SELECT lang, a, size, array_to_string(w[i:i + m - 1], ' ') AS phrase
  FROM candidates, range(1, 4) AS begins(i), range(2, 4) AS lengths(m)
  WHERE m < size AND i + m - 1 <= size
), dropped AS (
  SELECT DISTINCT s.lang, s.phrase FROM lowest s JOIN inner_phrases i
    ON s.lang = i.lang AND s.phrase = i.phrase AND 100::HUGEINT * i.a >= 80::HUGEINT * s.a
), ranked AS (
  SELECT l.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM lowest l ANTI JOIN dropped d ON l.lang = d.lang AND l.phrase = d.phrase
)
SELECT lang, rank, phrase, a, l, r, n, score
FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""
