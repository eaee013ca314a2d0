"""Mixing sources to target weights by Efraimidis-Spirakis sampling (operator 8).

Built-in DataFrame functions only. Sources in code-point order, null last, weigh
5, 2, 1, repeating, and share the sum of all sizes; no source gets more than
``max_epochs`` times its size, and the excess is shared again by weight.

A source's target is met by complete epochs first. For the rest its documents
are taken in the order of the keys ``-ln(u) / w``: ``u`` is uniform and comes
from the id alone, so reruns agree, and ``w`` is the document's quality weight,
which falls with the share of mark-up characters. A document is taken while at
least half of it fits.

The running sum over a source is made in three levels, since a source may hold
any share of all rows: sums of 1,024 key ranges, of 1,024 parts of the one range
where the target is reached, and a window over the documents of that one part,
about a millionth of the source.

Null texts have size 0 and take no part. Null ids count as the empty id. Rows
with equal keys are ordered by id and size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from followrec.llm.common import stage

WEIGHTS = (5, 2, 1)
MAX_EPOCHS = 3
_RANGES = 1024


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def quality_weight(text: Column, size: Column) -> Column:
    """1 for plain text, less with every mark-up character per word."""
    marks = F.length(text) - F.length(F.translate(text, "#*$%&|<>", ""))
    return F.coalesce(1 / (1 + 4 * marks / F.greatest(size, F.lit(1))), F.lit(1.0))


def sampling_key(doc_id: Column, weight: Column) -> Column:
    digits = F.substring(F.sha2(F.coalesce(doc_id.cast("string"), F.lit("")), 256), 1, 13)
    u = (F.conv(digits, 16, 10).cast("double") + 0.5) / 2.0**52
    return -F.log(u) / weight


def targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, target) of ``sizes(source, source_size)``, one row a source."""
    order = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(WEIGHTS)
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), turn + 1)
    cap = (MAX_EPOCHS * F.col("source_size")).cast("double")
    full = Window.orderBy("fill", F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    upto = full.rowsBetween(Window.unboundedPreceding, -1)
    return (sizes.withColumn("weight", weight).withColumn("cap", cap)
            .withColumn("fill", F.col("cap") / F.col("weight"))
            .withColumn("all", F.sum("source_size").over(everything))
            # with the sources before this one at their caps, a unit of weight is worth
            # "unit"; the largest one that fills no further source is the level sought
            .withColumn("unit", (F.col("all") - F.coalesce(F.sum("cap").over(upto), F.lit(0.0)))
                        / (F.sum("weight").over(everything)
                           - F.coalesce(F.sum("weight").over(upto), F.lit(0))))
            .withColumn("unit", F.max(F.when(F.col("unit") <= F.col("fill"), F.col("unit")))
                        .over(everything))
            .select("source", "source_size",
                    F.when(F.col("unit").isNull(), F.col("cap"))
                    .otherwise(F.least("cap", F.col("unit") * F.col("weight"))).alias("target")))


def _reached(rows: DataFrame, part: str) -> DataFrame:
    """Per source the part in which the running sum reaches ``need``, and the sum before it."""
    run = Window.partitionBy("source").orderBy(part)
    return (rows.groupBy("source", part).agg(F.sum("size").alias("sum"),
                                             F.first("need").alias("need"))
            .withColumn("upto", F.sum("sum").over(run))
            # a need at the end of a part is reached in it
            .where((F.col("upto") >= F.col("need"))
                   & (F.col("upto") - F.col("sum") < F.col("need")))
            .select(F.col("source").alias("s"), F.col(part).alias(f"cut_{part}"),
                    (F.col("need") - F.col("upto") + F.col("sum")).alias(f"need_{part}")))


def _with(rows: DataFrame, cut: DataFrame, how: str) -> DataFrame:
    return rows.join(cut, rows.source.eqNullSafe(F.col("s")), how).drop("s")


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken per row of ``docs(doc_id, text, source)``."""
    size = word_count(F.col("text"))
    rows = (docs.select("doc_id", "source", size.alias("size"), "text")
            .withColumn("key", sampling_key(F.col("doc_id"),
                                            quality_weight(F.col("text"), F.col("size"))))
            .withColumn("place", 1 - F.exp(-F.col("key")))
            .withColumn("coarse", F.least(F.floor(F.col("place") * _RANGES),
                                          F.lit(_RANGES - 1)))
            .withColumn("fine", F.least(F.floor(F.col("place") * _RANGES**2),
                                        F.lit(_RANGES**2 - 1)))
            .select("doc_id", "source", "size", "key", "coarse", "fine"))
    rows = stage(rows, "sized")
    plan = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")))
    epochs = F.floor(F.try_divide(F.col("target"), F.col("source_size").cast("double")))
    plan = stage(plan.withColumn("epochs", F.coalesce(epochs, F.lit(0)))
                 .withColumn("need", F.col("target") - F.col("epochs") * F.col("source_size"))
                 .withColumnRenamed("source", "s"), "targets")
    rows = _with(rows, plan, "inner")
    cut = stage(_reached(rows, "coarse"), "coarse")
    inside = _with(rows.drop("need"), cut, "inner").where("coarse = cut_coarse")
    fine = stage(_reached(inside.withColumnRenamed("need_coarse", "need"), "fine"), "fine")
    rows = _with(_with(rows, cut, "left"), fine, "left")
    # a source that has a cut has all of these set; the others take no fraction
    edge = F.col("fine") == F.col("cut_fine")
    part = (F.col("coarse") < F.col("cut_coarse")) | (
        (F.col("coarse") == F.col("cut_coarse")) & (F.col("fine") < F.col("cut_fine")))
    edge_is = F.coalesce(edge, F.lit(False))
    run = Window.partitionBy("source").orderBy("key", "doc_id", "size")
    before = F.sum("size").over(run.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    last = (rows.where(edge_is).withColumn("upto", before)
            .withColumn("part", F.col("upto") - F.col("size") / 2 <= F.col("need_fine")).drop("upto"))
    rest = rows.where(~edge_is).withColumn("part", F.coalesce(part, F.lit(False)))
    return rest.unionByName(last).select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * (F.col("epochs") + F.col("part").cast("long"))).cast("long")
        .alias("taken"))


ORACLE_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, text,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM {docs}
), keyed AS (
  SELECT doc_id, source, size,
         -ln((('0x' || substr(sha256(coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT::DOUBLE + 0.5)
             / 4503599627370496.0)
         / coalesce(1 / (1 + 4 * (length(text) - length(translate(text, '#*$%&|<>', '')))::DOUBLE
                     / greatest(size, 1)), 1.0) AS key
  FROM sized
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
              WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM keyed GROUP BY source
), units AS (
  SELECT *, 3.0 * source_size::DOUBLE AS cap,
         (sum(source_size) OVER ()::DOUBLE - coalesce(sum(3.0 * source_size::DOUBLE) OVER f, 0.0))
         / (sum(weight) OVER () - coalesce(sum(weight) OVER f, 0))::DOUBLE AS unit
  FROM sources
  WINDOW f AS (ORDER BY 3.0 * source_size::DOUBLE / weight, source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), targets AS (
  SELECT source, source_size,
         least(cap, coalesce((SELECT max(unit) FROM units WHERE unit <= cap / weight) * weight,
                             cap)) AS target
  FROM units
), plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS epochs
  FROM targets
), placed AS (
  SELECT k.doc_id, k.size, p.source_size, p.target, p.epochs,
         p.target - p.epochs * p.source_size AS need,
         sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id NULLS FIRST, k.size
                           ROWS UNBOUNDED PRECEDING) AS upto
  FROM keyed k JOIN plan p ON k.source IS NOT DISTINCT FROM p.source
)
SELECT doc_id, size, source_size, target,
       (size * (epochs + CASE WHEN upto - size / 2.0 <= need THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed
"""
