"""Near-duplicate documents by SetSketch registers (operator 9).

Documents are sets of distinct five-word shingles. A SetSketch keeps, per
register, ``floor(1 - log_b(x))`` of the smallest exponential value ``x`` that
any shingle gives: exponentially spaced, truncated minima, which merge by
``max``. Registers of one band, hashed together, are the locality-sensitive key.

1. Equal sets form one class, so copies are never compared.
2. Classes that share a band key form a bucket; each bucket's leader is paired
   with its members (a star, not all pairs). The joint maximum-likelihood
   estimate over all registers tells which members are far from the leader;
   these get a further leader, or are compared by estimate in bounded blocks.
3. Each kept star pair is confirmed on the full sets, which also gives the exact
   difference of member and leader.
4. Where a bucket still holds more than one component, its members outside the
   largest one are compared with all of it, in blocks of bounded size, exactly,
   on these differences.
5. Components of all confirmed links.

Null, empty and blank texts have an empty set and stay alone. A null doc_id is
left out of the minimum; a component of null ids only has a null component_id
and its documents count as kept.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from followrec.llm.common import components, maybe_among, stage
from followrec.llm.textvec import LOWER, RangeHash, Texts, gram, mix64, slices, words_of


@dataclass(frozen=True)
class SketchParams:
    """Sketch size and similarity.

    25 bands of 5 registers miss a pair of similarity 0.85 with probability
    (1 - 0.85**5)**25, less than one in a million.
    """

    words: int = 5
    bands: int = 25
    rows: int = 5
    base: float = 1.001
    rate: float = 20.0
    percent: int = 85  # link if 100 * intersection >= percent * union
    near: float = 0.15  # star pairs estimated below this are not confirmed
    far: float = 0.5  # members estimated below this are compared among themselves
    maybe: float = 0.68  # pairs estimated below this are not confirmed (five deviations)
    small: int = 64  # far members that are compared at once, without a further leader
    block: int = 512  # members compared at a time

    @property
    def registers(self) -> int:
        return self.bands * self.rows


def shingle_sets(texts: Texts, n: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct hashes of its n-word shingles."""
    low = Texts(LOWER[texts.buf], texts.offs)
    words = words_of(low)
    hashes = RangeHash(low.buf)(words.start, words.end)
    grams, at = gram(hashes, words.first, n)
    cut = np.searchsorted(at, words.first)
    for i in range(len(texts)):
        lo, hi = words.first[i], words.first[i + 1]
        if hi - lo >= n or hi == lo:
            yield np.unique(grams[cut[i]:cut[i + 1]])
        else:
            yield gram(hashes[lo:hi], np.array([0, hi - lo]), int(hi - lo))[0]


def _hash_family(m: int) -> tuple[np.ndarray, np.ndarray]:
    seeds = mix64(np.arange(1, 2 * m + 1, dtype=np.uint64))
    return seeds[:m], seeds[m:] | np.uint64(1)


def registers(items: np.ndarray, p: SketchParams) -> np.ndarray:
    """SetSketch registers of a set of 64-bit hashes."""
    flip, odd = _hash_family(p.registers)
    least = np.full(p.registers, np.iinfo(np.uint64).max, np.uint64)
    for lo in range(0, len(items), 4096):
        part = (items[lo:lo + 4096, None] ^ flip) * odd
        np.minimum(least, part.min(axis=0), out=least)
    u = (least.astype(np.float64) + 0.5) / 2.0**64
    x = -np.log1p(-np.minimum(u, 1 - 1e-16)) / p.rate
    k = np.floor(1.0 - np.log(x) / np.log(p.base))
    return np.clip(k, 0, 65535).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def band_keys(regs: np.ndarray, p: SketchParams) -> np.ndarray:
    out = np.arange(1, p.bands + 1, dtype=np.uint64)
    for k in regs.reshape(p.bands, p.rows).astype(np.uint64).T:
        out = mix64(out * np.uint64(0x9E3779B97F4A7C15) + k)
    return out


def joint_estimate(ra: np.ndarray, rb: np.ndarray, na: np.ndarray, nb: np.ndarray,
                   base: float) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity of row pairs of register matrices.

    The counts of larger, smaller and equal registers are trinomial; their
    probabilities follow from the similarity and the two known set sizes. The
    log-likelihood is evaluated on a grid of similarities.
    """
    up, down = (ra > rb).sum(1), (ra < rb).sum(1)
    same = ra.shape[1] - up - down
    u = (na / (na + nb))[:, None]
    v = 1.0 - u
    most = np.minimum(u / v, v / u)
    j = np.linspace(0.0, 1.0, 201)[None, :] * most

    def p(x: np.ndarray) -> np.ndarray:
        return -np.log1p(-np.clip(x, 0, 1) * (base - 1) / base) / np.log(base)

    pu, pd_ = p(u - v * j), p(v - u * j)
    tiny = 1e-12
    ll = (up[:, None] * np.log(np.maximum(pu, tiny))
          + down[:, None] * np.log(np.maximum(pd_, tiny))
          + same[:, None] * np.log(np.maximum(1 - pu - pd_, tiny)))
    return j[np.arange(len(j)), ll.argmax(1)]


def sketches(docs: DataFrame, p: SketchParams) -> DataFrame:
    """Per row: doc_id, n_shingles, and of a non-empty set its signature, band keys, registers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in slices(batch):
                n, sig, keys, regs = [], [], [], []
                for s in shingle_sets(texts, p.words):
                    n.append(len(s))
                    if not len(s):
                        sig.append(None), keys.append(None), regs.append(None)
                        continue
                    r = registers(s, p)
                    place = mix64(s + np.arange(len(s), dtype=np.uint64))
                    sig.append(np.array([np.bitwise_xor.reduce(place), s.sum(dtype=np.uint64)
                                         + np.uint64(len(s))]).tobytes())
                    keys.append(band_keys(r, p).view(np.int64))
                    regs.append(r.tobytes())
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), rows.column(1), pa.array(n, pa.int64()),
                     pa.array(sig, pa.binary()), pa.array(keys, pa.list_(pa.int64())),
                     pa.array(regs, pa.binary())],
                    ["doc_id", "text_key", "n_shingles", "sig", "keys", "regs"])

    return (docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
            .mapInArrow(run, "doc_id bigint, text_key bigint, n_shingles bigint, "
                             "sig binary, keys array<bigint>, regs binary"))


def _estimates(pairs: DataFrame, classes: DataFrame, p: SketchParams) -> DataFrame:
    """Adds ``est`` to pairs (lead, sig) from the registers of both classes."""
    used = pairs.select("sig").union(pairs.select("lead"))
    c = maybe_among(classes.select("sig", "regs", F.col("n_shingles").alias("n")), used, ["sig"])
    both = (pairs.distinct().join(c, "sig")
            .join(c.select(F.col("sig").alias("lead"), F.col("regs").alias("lead_regs"),
                           F.col("n").alias("lead_n")), "lead"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            got = {k: b.column(b.schema.get_field_index(k)) for k in
                   ("lead", "sig", "regs", "lead_regs", "n", "lead_n")}
            ra, rb = (np.frombuffer(b"".join(got[k].to_pylist()), np.uint16)
                      .reshape(b.num_rows, p.registers) for k in ("lead_regs", "regs"))
            est = joint_estimate(ra, rb, got["lead_n"].to_numpy().astype(float),
                                 got["n"].to_numpy().astype(float), p.base)
            yield pa.RecordBatch.from_arrays(
                [got["lead"], got["sig"], pa.array(est)], ["lead", "sig", "est"])

    return both.mapInArrow(run, "lead binary, sig binary, est double")


def _far_links(pdf: pd.DataFrame, p: SketchParams) -> pd.DataFrame:
    """Pairs of one block whose estimated similarity may reach the threshold."""
    pdf = pdf.drop_duplicates(["block", "sig"])
    left = pdf[pdf.block == pdf.i] if (pdf.i != pdf.j).any() else pdf
    right = pdf[pdf.block == pdf.j]
    regs = np.frombuffer(b"".join(right.regs), np.uint16).reshape(len(right), p.registers)
    sigs, sizes = right.sig.to_numpy(), right.n.to_numpy().astype(float)
    out = []
    for sig, mine, n in zip(left.sig, left.regs, left.n, strict=True):
        own = np.frombuffer(mine, np.uint16)
        # equal registers alone rule out most; the likelihood decides the rest
        close = np.flatnonzero((regs == own).mean(1) >= p.maybe - 0.2)
        if len(close):
            est = joint_estimate(np.broadcast_to(own, (len(close), p.registers)), regs[close],
                                 np.full(len(close), float(n)), sizes[close], p.base)
            out += [(sig, sigs[k]) for k in close[est >= p.maybe] if sigs[k] != sig]
    return pd.DataFrame(out, columns=["lead", "sig"], dtype=object)


def far_pairs(far: DataFrame, classes: DataFrame, p: SketchParams) -> DataFrame:
    """Pairs among members (bucket, depth, n_far, sig) far from their leader, by registers.

    Members are cut into blocks of bounded size and every two blocks of a bucket
    are compared; only pairs that may be linked leave a task.
    """
    regs = maybe_among(classes.select("sig", "regs", F.col("n_shingles").alias("n")), far, ["sig"])
    rows = far.drop("n").join(regs, "sig")
    blocks = F.ceil(F.col("n_far") / p.block).cast("int")
    rows = (rows.withColumn("block", F.pmod(F.xxhash64("sig"), blocks).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")))
    return (rows.select("bucket", "depth", "i", "j", "block", "sig", "regs", "n")
            .groupBy("bucket", "depth", "i", "j")
            .applyInPandas(lambda pdf: _far_links(pdf, p), "lead binary, sig binary"))


def star_pairs(classes: DataFrame, p: SketchParams) -> tuple[DataFrame, DataFrame]:
    """Leader-member rows (bucket, depth, lead, sig) and the distinct pairs (lead, sig).

    Two linked documents are at most ``1 - percent / 100`` apart in distance to
    any leader, so they are both near it or both among those far from it.
    """
    members = (classes.select("sig", F.explode("keys").alias("bucket"))
               .select("bucket", F.lit(0).alias("depth"), "sig"))
    stars = pairs = None
    depth = 0
    while True:
        lead = members.groupBy("bucket", "depth").agg(
            F.min("sig").alias("lead"), F.count(F.lit(1)).alias("n")).where("n > 1")
        lead = stage(lead, "leads")
        # most buckets have one member, which needs no shuffle to meet nobody
        shared = maybe_among(members.drop("depth"), lead, ["bucket"])
        star = stage(shared.join(lead, "bucket").where("sig <> lead"), "star")
        est = stage(_estimates(star.select("lead", "sig"), classes, p), "est")
        star = star.join(est, ["lead", "sig"])
        near = star.where(F.col("est") >= p.near).select("bucket", "depth", "lead", "sig")
        found = est.where(F.col("est") >= p.near).select("lead", "sig")
        depth += 1
        far = star.where(F.col("est") < p.far).select(
            "bucket", F.lit(depth).alias("depth"), "n", "sig")
        size = far.groupBy("bucket").agg(F.count(F.lit(1)).alias("n_far"))
        far = stage(far.join(size.where("n_far > 1"), "bucket"), "far")
        # a large rest that the leader did split gets a further leader
        again = (F.col("n_far") > p.small) & (F.col("n_far") < 0.9 * F.col("n"))
        found = found.union(far_pairs(far.where(~again), classes, p))
        stars = near if stars is None else stars.unionByName(near)
        pairs = found if pairs is None else pairs.unionByName(found)
        members = far.where(again).select("bucket", "depth", "sig")
        if members.isEmpty():
            return stage(stars, "stars"), stage(pairs.distinct(), "pairs")


def confirmed(docs: DataFrame, classes: DataFrame, pairs: DataFrame,
              p: SketchParams) -> DataFrame:
    """Pairs with exact sizes and the exact difference of member and leader."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in slices(batch):
                sets = [s.view(np.int64) for s in shingle_sets(texts, p.words)]
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(sets, pa.list_(pa.int64()))], ["sig", "items"])

    # every lead also meets its own set, as the row that its members are compared with
    wanted = pairs.select("lead", "sig").union(
        pairs.select("lead", F.col("lead").alias("sig")).distinct())
    used = wanted.select("sig").distinct()
    reps = stage(maybe_among(classes, used, ["sig"]).join(used, "sig").select("sig", "rep.doc_id", "rep.text_key"), "reps")
    # texts of classes in no pair stay where they are
    rows = maybe_among(docs.select("doc_id", "text", F.xxhash64("text").alias("text_key")),
                       reps, ["doc_id", "text_key"])
    full = (rows.join(reps, rows.doc_id.eqNullSafe(reps.doc_id)
                      & (rows.text_key == reps.text_key))
            # a representative row may be repeated
            .select("sig", "text").dropDuplicates(["sig"])
            .mapInArrow(run, "sig binary, items array<bigint>"))
    full = stage(wanted.join(full, "sig"), "sets")
    lead = full.where("sig = lead").select("lead", F.col("items").alias("lead_items"))
    return (full.where("sig <> lead").join(lead, "lead")
            .select("lead", "sig", F.size("lead_items").alias("lead_n"), F.size("items").alias("n"),
                    F.concat(F.array_except("items", "lead_items"),
                             F.array_except("lead_items", "items")).alias("delta")))


def _linked(differ: np.ndarray, total: np.ndarray, percent: int) -> np.ndarray:
    """Exact test from |A ^ B| and |A| + |B|."""
    inter, union = (total - differ) // 2, (total + differ) // 2
    return 100 * inter >= percent * union


def _block_links(pdf: pd.DataFrame, percent: int) -> pd.DataFrame:
    """Links between the left and the right rows of one block: a spanning forest."""
    pdf = pdf.drop_duplicates(["side", "sig"])
    left, right = pdf[pdf.side == 0], pdf[pdf.side == 1]
    if left.empty or right.empty:
        return pd.DataFrame({"a": [], "b": []}, dtype=object)

    def cells(rows: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
        sizes = rows.delta.map(len).to_numpy()
        flat = np.concatenate([np.asarray(d, np.int64) for d in rows.delta])
        return np.repeat(np.arange(len(rows)), sizes), flat

    (li, lx), (ri, rx) = cells(left), cells(right)
    common = np.intersect1d(lx, rx)
    sizes = [s.delta.map(len).to_numpy() for s in (left, right)]
    shared = np.zeros((len(left), len(right)), np.float32)
    for lo in range(0, len(common), 4096):
        part = common[lo:lo + 4096]
        dense = []
        for i, x, rows in ((li, lx, len(left)), (ri, rx, len(right))):
            at = np.searchsorted(part, x)
            hit = (at < len(part)) & (part[np.minimum(at, len(part) - 1)] == x)
            m = np.zeros((rows, len(part)), np.float32)
            m[i[hit], at[hit]] = 1
            dense.append(m)
        shared += dense[0] @ dense[1].T
    differ = sizes[0][:, None] + sizes[1][None, :] - 2 * shared.astype(np.int64)
    total = left.n.to_numpy()[:, None] + right.n.to_numpy()[None, :]
    a, b = np.nonzero(_linked(differ, total, percent)
                      & (left.comp.to_numpy()[:, None] != right.comp.to_numpy()[None, :]))
    lk, rk = left.sig.to_numpy(), right.sig.to_numpy()
    parent: dict = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    keep = []
    for i, j in zip(a.tolist(), b.tolist(), strict=True):
        x, y = find(lk[i]), find(rk[j])
        if x != y:
            parent[x] = y
            keep.append((lk[i], rk[j]))
    return pd.DataFrame(keep, columns=["a", "b"], dtype=object)


def residual_links(stars: DataFrame, exact: DataFrame, comps: DataFrame,
                   p: SketchParams) -> DataFrame:
    """Links inside buckets between members that the leaders did not connect."""
    confirmed_stars = stars.join(exact.select("lead", "sig"), ["lead", "sig"])
    members = confirmed_stars.unionByName(
        confirmed_stars.withColumn("sig", F.col("lead")).dropDuplicates(["bucket", "depth"]))
    members = (members.join(comps.select(F.col("node").alias("sig"), "comp"), "sig", "left")
               .withColumn("comp", F.coalesce("comp", "sig")))
    members = stage(members.select("bucket", "depth", "lead", "sig", "comp"), "members")
    per = members.groupBy("bucket", "depth", "comp").agg(F.count(F.lit(1)).alias("k"))
    bucket = (per.groupBy("bucket", "depth")
              .agg(F.count(F.lit(1)).alias("comps"), F.sum("k").alias("n_all"),
                   F.max(F.struct("k", "comp")).alias("top"))
              .where("comps > 1")
              .select("bucket", "depth", F.col("top.comp").alias("main"), "n_all",
                      (F.col("n_all") - F.col("top.k")).alias("n_rest")))
    rows = members.join(stage(bucket, "open-buckets"), ["bucket", "depth"])

    def blocks(n: str):
        return F.ceil(F.col(n) / p.block).cast("int")

    def own(n: str):
        return F.pmod(F.xxhash64("sig"), blocks(n)).cast("int")

    rest = (rows.where("comp <> main")
            .withColumn("i", own("n_rest"))
            .withColumn("j", F.explode(F.sequence(F.lit(0), blocks("n_all") - 1)))
            .withColumn("side", F.lit(0)))
    every = (rows.withColumn("j", own("n_all"))
             .withColumn("i", F.explode(F.sequence(F.lit(0), blocks("n_rest") - 1)))
             .withColumn("side", F.lit(1)))
    cols = ["bucket", "depth", "i", "j", "side", "lead", "sig", "comp"]
    cells = stage(rest.select(cols).unionByName(every.select(cols)), "blocks")
    # differences are long: only rows of blocks get theirs
    percent = p.percent
    return (cells.join(differences(exact, cells), ["lead", "sig"])
            .select("bucket", "depth", "i", "j", "side", "sig", "n", "delta", "comp")
            .groupBy("bucket", "depth", "i", "j")
            .applyInPandas(lambda pdf: _block_links(pdf, percent), "a binary, b binary"))


def differences(exact: DataFrame, used: DataFrame) -> DataFrame:
    """lead, sig, n, delta of the pairs ``used(lead, sig)``; a leader has no difference to itself."""
    pairs = exact.select("lead", "sig", "n", "delta")
    own = (exact.select("lead", F.col("lead").alias("sig"), F.col("lead_n").alias("n"),
                        F.array().cast("array<bigint>").alias("delta"))
           .dropDuplicates(["lead"]))
    return maybe_among(pairs, used, ["lead", "sig"]).unionByName(own)


def near_duplicates(docs: DataFrame, p: SketchParams = SketchParams()) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs(doc_id, text)``."""
    return _labelled(docs, p).drop("text_key", "comp")


def without_near_duplicates(docs: DataFrame, p: SketchParams = SketchParams()) -> DataFrame:
    """One row of ``docs`` of each component, and every row with an empty set.

    Of several rows with the component's least id (or without any id) one text is
    taken, and of rows with equal id and text any one. Columns may have any name.
    """
    kept = (_labelled(docs, p).where("kept")
            .groupBy(F.col("doc_id").alias("d"), "text_key", "comp")
            .agg((F.count(F.lit(1)) > 1).alias("many")))
    kept = stage(kept, "kept-keys")
    key = F.struct("d", "text_key", "many")
    one = (kept.where("comp is not null").groupBy("comp")
           .agg(F.min_by(key, "text_key").alias("k")).select("k.*"))
    alone = kept.where("comp is null").select("d", "text_key", F.lit(False).alias("many"))
    kept = stage(one.unionByName(alone), "kept")
    rows = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"),
                       F.col("doc_id").alias("id"), F.xxhash64("text").alias("key"))
    found = rows.join(kept, F.col("id").eqNullSafe(F.col("d"))
                      & (F.col("key") == F.col("text_key")))
    several = found.where("many").dropDuplicates(["d", "text_key"])
    return found.where("not many").select("row.*").unionByName(several.select("row.*"))


def _labelled(docs: DataFrame, p: SketchParams) -> DataFrame:
    sk = stage(sketches(docs, p), "sketches")
    classes = stage(sk.where("sig is not null").groupBy("sig").agg(
        F.min(F.struct("doc_id", "text_key")).alias("rep"), F.min("doc_id").alias("least"),
        F.first("n_shingles").alias("n_shingles"), F.first("keys").alias("keys"),
        F.first("regs").alias("regs")), "classes")
    stars, pairs = star_pairs(classes, p)
    exact = stage(confirmed(docs, classes, pairs, p), "exact")
    inter2 = F.col("lead_n") + F.col("n") - F.size("delta")  # twice the intersection
    union2 = F.col("lead_n") + F.col("n") + F.size("delta")
    links = exact.where(100 * inter2 >= p.percent * union2).select(
        F.col("lead").alias("a"), F.col("sig").alias("b"))
    first = components(links, "star-components")
    more = stage(residual_links(stars, exact, first, p), "residual")
    comps = first if more.isEmpty() else components(
        first.select(F.col("node").alias("a"), F.col("comp").alias("b")).union(more), "comps")
    ids = (classes.select("sig", "least").join(comps, classes.sig == comps.node, "left")
           .withColumn("comp", F.coalesce("comp", "sig")))
    ids = stage(ids.select("comp", "sig", "least"), "labelled")
    least = stage(ids.groupBy("comp").agg(F.min("least").alias("component_id")), "least")
    ids = stage(ids.join(least, "comp").select("sig", "comp", "component_id"), "ids")
    return (sk.select("doc_id", "text_key", "n_shingles", "sig").join(ids, "sig", "left")
            .select("doc_id", "text_key", "n_shingles", "comp",
                    F.when(F.col("sig").isNull(), F.col("doc_id"))
                    .otherwise(F.col("component_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"),
                                           F.col("component_id").isNull(), F.lit(False))))
