"""Exact removal of repeated byte strings by suffix arrays (operator 4).

Every byte covered by a string of ``length`` bytes that also starts anywhere
else, in the same document or another, is removed; overlaps count, and all
strings are judged on the input.

1. The *anchor* of a string is the position of its least 64-byte hash (the
   leftmost one on a tie). It depends on the string alone, so equal strings have
   equal anchors at equal distances. Runs of strings with one anchor form a
   segment. Anchors that occur once are done. Of the others Spark counts equal
   segments: all strings of a segment that occurs twice are repeats, which settles
   whole copies without looking at them.
2. Different segments with the same anchor are cut into pieces in a second scan of
   the texts, which never leave the tasks that read them: one occurrence of each such
   segment is let through by a bitmap of fixed size. (An occurrence let through by
   chance changes nothing: its pieces are true strings at places of their own.) The
   strings whose anchor is at one of ``PIECE`` neighbouring distances share a core,
   and differ in fewer than ``PIECE`` bytes at either side. Pieces with equal cores
   meet in one task, many small groups to a block.
3. A block is one text: left bytes, one symbol for the core, right bytes, a
   separator, piece by piece. Its suffix array is built without recursive
   renaming (see :func:`suffix_array`); a string is a repeat if its suffix agrees
   in ``PIECE`` symbols with a neighbour in the array.
4. Cores with more pieces than a block takes are settled exactly by counting the
   hashes of their strings, aggregated map-side.
5. Only texts with a repeat are shuffled, to meet their ranges.

Null texts are empty. Rows with equal id and text get equal results and count as
two places. Hashes have 64 bits, and equal strings are always judged by two of
them together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from followrec.llm.common import (bitmap_of, in_bitmap, join_groups, marked_among, maybe_among,
                                  stage)
from followrec.llm.textvec import RangeHash, Texts, mix64, slices

LENGTH = 400
GRAM = 64
PIECE = 32
#: Bits of every bitmap (8 MiB), whatever the size of the input.
BITS = 1 << 26
#: Pieces of one block; larger groups are settled by counting.
BLOCK = 2_000


def suffix_array(text: list[int]) -> list[int]:
    """Suffix array of integers whose last one is unique and smaller than all others.

    Phase 1 groups suffixes by their longest Lyndon prefix. Groups, begun by first
    symbol, are taken in descending order. Every suffix of a group points to the
    nearest suffix before it in a smaller group; what it points to is followed by
    this group's prefix, so it moves to a new group just above its old one, the
    higher the more of the group's suffixes point to it. A group is named by the
    first place it takes in the array, so names keep the order.

    Phase 2 reads the array from its start. The suffix before the one just read,
    and those along the pointers from there, are the next of their groups.
    """
    n = len(text)
    order = np.argsort(np.asarray(text), kind="stable")
    ranked = np.asarray(text)[order]
    first = np.maximum.accumulate(np.where(
        np.concatenate([[True], ranked[1:] != ranked[:-1]]), np.arange(n), 0))
    group = np.empty(n, np.int64)
    group[order] = first
    group = group.tolist()
    members: list[list[int] | None] = [None] * n
    size = np.bincount(first, minlength=n).tolist()
    for start in np.unique(first).tolist():
        members[start] = order[start:start + size[start]].tolist()
    before = [-1] * n
    for start in range(n - 1, -1, -1):
        if members[start] is None:
            continue
        points: dict[int, int] = {}
        for i in sorted(i for i in members[start] if group[i] == start):
            j = i - 1
            while j >= 0 and group[j] >= start:
                j = before[j]
            before[i] = j
            if j >= 0:
                points[j] = points.get(j, 0) + 1
        by_count: dict[int, dict[int, list[int]]] = {}
        for j, count in points.items():
            by_count.setdefault(count, {}).setdefault(group[j], []).append(j)
        for count in sorted(by_count, reverse=True):
            for old, moved in by_count[count].items():
                if len(moved) == size[old]:
                    continue  # the whole group moves: its place stays the same
                size[old] -= len(moved)
                new = old + size[old]
                size[new] = len(moved)
                members[new] = moved
                for j in moved:
                    group[j] = new
    place = list(range(n))
    out = [-1] * n
    done = [False] * n
    out[0], done[n - 1] = n - 1, True
    for k in range(n):
        j = out[k] - 1
        while j >= 0 and not done[j]:
            at = place[group[j]]
            place[group[j]] = at + 1
            out[at] = j
            done[j] = True
            j = before[j]
    return out


def anchors(hashes: np.ndarray, width: int) -> np.ndarray:
    """For every window of ``width`` hashes the position of its leftmost least one.

    Least values from the start and to the end of fixed blocks are combined, so
    the cost does not depend on the width. Hashes are compared in 54 bits.
    """
    n = len(hashes)
    blocks = -(-n // width)
    key = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    spot = np.tile(np.arange(width, dtype=np.uint64), blocks)
    key[:n] = (hashes & ~np.uint64(1023)) | spot[:n]
    rows = key.reshape(blocks, width)
    head = np.minimum.accumulate(rows, axis=1).ravel()
    tail = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    i = np.arange(n - width + 1)
    a, b = tail[i], head[i + width - 1]
    left = (a >> np.uint64(10)) <= (b >> np.uint64(10))
    block = np.where(left, i // width, (i + width - 1) // width)
    return block * width + (np.where(left, a, b) & np.uint64(1023)).astype(np.int64)


def segments_of(buf: np.ndarray, grams: np.ndarray, ranged: RangeHash, lo: int,
                hi: int) -> tuple[np.ndarray, ...]:
    """Of the text ``buf[lo:hi]``: anchor hash, segment hash, first and last string, anchor."""
    at = anchors(grams[lo:hi - GRAM + 1], LENGTH - GRAM + 1)
    first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    last = np.append(first[1:], len(at)) - 1
    lead = (at[first] - first).astype(np.uint64)
    return (grams[lo + at[first]], mix64(ranged(lo + first, lo + last + LENGTH) + lead), first,
            last, at[first])


def _gram_hashes(texts: Texts, ranged: RangeHash) -> np.ndarray:
    i = np.arange(max(len(texts.buf) - GRAM + 1, 0))
    return ranged(i, i + GRAM)


def _slice_segments(texts: Texts, ranged: RangeHash) -> list[np.ndarray] | None:
    """Segments of a slice of texts, with the text of each in front."""
    grams = _gram_hashes(texts, ranged)
    found, owner = [], []
    for i in range(len(texts)):
        lo, hi = int(texts.offs[i]), int(texts.offs[i + 1])
        if hi - lo >= LENGTH:
            found.append(segments_of(texts.buf, grams, ranged, lo, hi))
            owner.append(np.full(len(found[-1][0]), i))
    if not found:
        return None
    return [np.concatenate(owner), *map(np.concatenate, zip(*found, strict=True))]


#: Multiplier of a position inside a row's hash; positions have fewer than 31 bits.
_PLACE = 2654435761


def segments(docs: DataFrame) -> DataFrame:
    """Segments of all texts: doc_id, text_key, row, anchor, segment, first, more.

    ``docs`` has doc_id, text_key, row (a hash of both) and text.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in slices(batch):
                found = _slice_segments(texts, RangeHash(texts.buf))
                if found is None:
                    continue
                owner, anchor, seg, first, last, _ = found
                row = pa.array(owner)
                yield pa.RecordBatch.from_arrays(
                    [*(rows.column(k).take(row) for k in range(3)),
                     pa.array(anchor.view(np.int64)), pa.array(seg.view(np.int64)),
                     pa.array(first.astype(np.int32)), pa.array((last - first).astype(np.int32))],
                    ["doc_id", "text_key", "row", "anchor", "segment", "first", "more"])

    return docs.select("doc_id", "text_key", "row", "text").mapInArrow(
        run, "doc_id bigint, text_key bigint, row bigint, anchor bigint, segment bigint, "
             "first int, more int")


def pieces(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Pieces of the segments at the places ``wanted(place, single)``.

    Rows: anchor, core (hash), left and right bytes, the strings it covers as a
    range of bytes taken from the left, and where the first string starts. A task
    cuts equal places (repeated rows) once, unless the segment is single.
    """
    spark = docs.sparkSession
    every = spark.sparkContext.broadcast(bitmap_of(wanted, "place", BITS))
    alone = spark.sparkContext.broadcast(bitmap_of(wanted.where("single"), "place", BITS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for rows, texts in slices(batch):
                ranged = RangeHash(texts.buf)
                found = _slice_segments(texts, ranged)
                if found is None:
                    continue
                owner, anchor, _, first, last, at = found
                place = rows.column(2).to_numpy()[owner] ^ (first * _PLACE)
                hit = np.flatnonzero(in_bitmap(every.value, place))
                single = in_bitmap(alone.value, place)
                ids, keys = rows.column(0).to_pylist(), rows.column(1).to_pylist()
                out: list[list] = [[] for _ in range(10)]
                for k in hit.tolist():
                    if not single[k]:
                        if int(place[k]) in seen:
                            continue
                        seen.add(int(place[k]))
                    i, a, i0, i1 = int(owner[k]), int(at[k]), int(first[k]), int(last[k])
                    lo, hi = int(texts.offs[i]), int(texts.offs[i + 1])
                    p = np.arange((a - i1) // PIECE, (a - i0) // PIECE + 1)
                    begin = a - PIECE * p  # first byte of the core
                    end = begin - (PIECE - 1) + LENGTH
                    core = mix64(ranged(lo + begin, lo + end) + p.astype(np.uint64))
                    part = texts.buf[lo + i0:min(lo + i1 + LENGTH, hi)].tobytes()
                    for b, e, h in zip(begin.tolist(), end.tolist(),
                                       core.view(np.int64).tolist(), strict=True):
                        start = max(i0, b - PIECE + 1)
                        stop = min(i1, b)
                        for column, value in zip(out, (
                                ids[i], keys[i], int(anchor[k].view(np.int64)), h,
                                bool(single[k]), part[start - i0:b - i0],
                                part[e - i0:stop + LENGTH - i0], b - stop, b - start, b),
                                strict=True):
                            column.append(value)
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_(),
                         pa.binary(), pa.binary(), pa.int32(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, t) for v, t in zip(out, kinds, strict=True)],
                    ["doc_id", "text_key", "anchor", "core", "single", "lhs", "rhs", "fewest",
                     "most", "begin"])

    return docs.select("doc_id", "text_key", "row", "text").mapInArrow(
        run, "doc_id bigint, text_key bigint, anchor bigint, core bigint, single boolean, "
             "lhs binary, rhs binary, fewest int, most int, begin int")


def repeated_in_block(cores: np.ndarray, left: list[bytes], right: list[bytes],
                      fewest: np.ndarray, most: np.ndarray) -> np.ndarray:
    """Per piece the strings (bit x: x bytes from the left) that another piece has too."""
    n = len(left)
    kinds, core = np.unique(cores, return_inverse=True)
    parts, window_at, owner, taken = [], [], [], []
    at = 0
    for i in range(n):
        mark = n + 1 + 256 + int(core[i])
        parts += [np.frombuffer(left[i], np.uint8).astype(np.int64) + n + 1, [mark],
                  np.frombuffer(right[i], np.uint8).astype(np.int64) + n + 1, [n - i]]
        middle = at + len(left[i])
        x = np.arange(fewest[i], most[i] + 1)
        window_at.append(middle - x)
        owner.append(np.full(len(x), i))
        taken.append(x)
        at = middle + 1 + len(right[i]) + 1
    parts.append([0])
    text = np.concatenate(parts)
    array = np.array(suffix_array(text.tolist()))
    is_window = np.full(len(text), -1)
    window_at = np.concatenate(window_at)
    is_window[window_at] = np.arange(len(window_at))
    # only suffixes that start a string matter; the others never agree so far
    array = array[is_window[array] >= 0]
    span = np.arange(PIECE)
    padded = np.concatenate([text, np.full(PIECE, -1)])
    same = np.zeros(len(array) + 1, bool)
    for lo in range(0, len(array) - 1, 50_000):
        a, b = array[lo:lo + 50_001][:-1], array[lo + 1:lo + 50_001]
        same[lo + 1:lo + 1 + len(a)] = (padded[a[:, None] + span]
                                        == padded[b[:, None] + span]).all(1)
    hit = is_window[array[same[:-1] | same[1:]]]
    out = np.zeros(n, np.int64)
    np.bitwise_or.at(out, np.concatenate(owner)[hit], 1 << np.concatenate(taken)[hit])
    return out


_FOUND = "doc_id bigint, text_key bigint, begin int, strings bigint"


def repeats_by_suffix_array(rows: DataFrame) -> DataFrame:
    """Repeated strings of pieces; rows of one core are together and in sequence."""

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        kept: list[pa.RecordBatch] = []
        count = 0
        for batch in batches:
            while batch.num_rows:
                take = min(batch.num_rows, max(BLOCK - count, 1))
                kept.append(batch.slice(0, take))
                batch = batch.slice(take)
                count += take
                if count >= BLOCK:
                    whole = pa.Table.from_batches(kept).combine_chunks()
                    core, anchor = (whole.column(c).to_numpy() for c in ("core", "anchor"))
                    cut = np.flatnonzero((core[1:] != core[:-1]) | (anchor[1:] != anchor[:-1]))
                    if len(cut):  # a core that may go on stays for the next block
                        yield whole.slice(0, cut[-1] + 1)
                        whole = whole.slice(cut[-1] + 1)
                    kept, count = whole.to_batches(), whole.num_rows
        if count:
            yield pa.Table.from_batches(kept).combine_chunks()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in blocks(b for b in batches if b.num_rows):
            cores = mix64(t.column("core").to_numpy().view(np.uint64)
                          + mix64(t.column("anchor").to_numpy().view(np.uint64)))
            found = repeated_in_block(
                cores, t.column("lhs").to_pylist(), t.column("rhs").to_pylist(),
                t.column("fewest").to_numpy(), t.column("most").to_numpy())
            keep = pa.array((found != 0) & t.column("single").to_numpy())
            out = t.select(["doc_id", "text_key", "begin"]).append_column(
                "strings", pa.array(found)).filter(keep)
            yield from out.to_batches()

    # a stated number: suffix arrays cost far more than their bytes, so tasks are not merged
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return (rows.repartition(parts, "anchor", "core").sortWithinPartitions("anchor", "core")
            .mapInArrow(run, _FOUND))


def repeats_by_count(rows: DataFrame) -> DataFrame:
    """Repeated strings of pieces with a core of too many pieces, by counting hashes."""
    strings = (rows.withColumn("x", F.explode(F.sequence("fewest", "most")))
               .withColumn("string", F.xxhash64(
                   F.expr("substring(lhs, octet_length(lhs) - x + 1, x)"), F.lit(0),
                   F.expr(f"substring(rhs, 1, {PIECE - 1} - x)"), "x"))
               .select("doc_id", "text_key", "begin", "single", "anchor", "core", "x", "string"))
    strings = stage(strings, "strings")
    key = ["anchor", "core", "x", "string"]
    often = stage(strings.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                  .drop("n"), "often")
    return (strings.where("single").join(often, key)
            .groupBy("doc_id", "text_key", "begin")
            .agg(F.bit_or(F.expr("shiftleft(1L, x)")).alias("strings")))


def repeated_ranges(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, first, last, strings): starts of repeated strings.

    They are ``first`` to ``last``, or if ``strings`` is not 0, ``first`` - x for every
    bit x of it.
    """
    found = stage(segments(docs), "segments")
    often = stage(found.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("n"), (F.min("segment") < F.max("segment")).alias("shared"))
        .where("n > 1").drop("n"), "anchors")
    place = F.col("row").bitwiseXOR(F.col("first").cast("long") * _PLACE)
    kinds = stage(maybe_among(found, often, ["anchor"], BITS).groupBy("anchor", "segment").agg(
        F.count(F.lit(1)).alias("n"), F.min(place).alias("place")), "kinds")
    twice = kinds.where("n > 1").select("anchor", "segment", "n")
    copied = (join_groups(maybe_among(found, twice, ["anchor", "segment"], BITS), twice,
                          ["anchor", "segment"], "n", found.count())
              .select("doc_id", "text_key", "first", (F.col("first") + F.col("more")).alias("last"),
                      F.lit(0).cast("long").alias("strings")))
    wanted = (maybe_among(kinds, often.where("shared"), ["anchor"], BITS)
              .select("place", (F.col("n") == 1).alias("single")))
    part = stage(pieces(docs, wanted), "pieces")
    per = stage(part.groupBy("anchor", "core").agg(
        F.count(F.lit(1)).alias("n"), F.max("single").alias("any")).where("n > 1 and any")
        .drop("any"), "cores")
    part = marked_among(maybe_among(part, per, ["anchor", "core"], BITS),
                        per.where(F.col("n") > BLOCK), ["anchor", "core"], "crowded", BITS)
    strings = repeats_by_suffix_array(part.where("not crowded").drop("crowded"))
    if not per.where(F.col("n") > BLOCK).isEmpty():
        strings = strings.unionByName(repeats_by_count(part.where("crowded").drop("crowded")))
    return copied.unionByName(strings.select(
        "doc_id", "text_key", F.col("begin").alias("first"), F.col("begin").alias("last"),
        "strings"))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 per row of ``docs(doc_id, text)``."""
    docs = docs.select("doc_id", F.xxhash64("text").alias("text_key"),
                       F.xxhash64("doc_id", "text").alias("row"),
                       F.coalesce("text", F.lit("")).alias("text"))
    ranges = (repeated_ranges(docs).groupBy("doc_id", "text_key")
              .agg(F.collect_list(F.struct("first", "last", "strings")).alias("ranges")))
    ranges = stage(ranges, "ranges")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size, removed, spans, digest = [], [], [], []
            for text, cuts in zip(batch.column(1), batch.column(2), strict=True):
                data = text.as_buffer()
                data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
                gone = np.zeros(len(data) + 1, np.int32)
                if cuts.is_valid:
                    flat = cuts.values
                    first, last, strings = (flat.field(c).to_numpy()
                                            for c in ("first", "last", "strings"))
                    whole = strings == 0
                    k, x = np.nonzero(strings[:, None] >> np.arange(PIECE) & 1)
                    start = np.concatenate([first[whole], first[k] - x])
                    stop = np.concatenate([last[whole], first[k] - x]) + LENGTH
                    np.add.at(gone, start, 1)
                    np.add.at(gone, stop, -1)
                gone = np.cumsum(gone)[:-1] > 0
                size.append(len(data))
                removed.append(int(gone.sum()))
                spans.append(int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum()))
                digest.append(hashlib.sha256(data[~gone].tobytes()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(v, pa.int64()) for v in (size, removed, spans)),
                 pa.array(digest, pa.string())],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    docs = marked_among(docs.drop("row"), ranges, ["doc_id", "text_key"], "repeats", BITS)
    met = ranges.withColumnsRenamed({"doc_id": "d", "text_key": "k"})
    return (docs.where("repeats")
            .join(met, docs.doc_id.eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")),
                  "left")
            .select("doc_id", "text", "ranges")
            .unionByName(docs.where("not repeats").select("doc_id", "text"),
                         allowMissingColumns=True)
            .mapInArrow(run, "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, "
                             "kept_sha256 string"))
