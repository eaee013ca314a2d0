"""From raw documents to a training mix, in five stages.

Each stage works on all documents its predecessor kept and returns the columns
of ``documents``; the last one returns the mix. Between stages the documents are
written as Parquet in the shared folder and read again, so a lost executor never
costs an earlier stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from followrec.llm import decontaminate, mixing, nbsvm, sitelines
from followrec.llm.common import stage, table
from followrec.llm.setsketch import SketchParams, without_near_duplicates

#: 35 bands miss a pair of similarity 0.8 with probability (1 - 0.8**5)**35, about one in
#: a million; the estimates that rule pairs out keep five deviations below 0.8.
NEAR = SketchParams(percent=80, bands=35, near=0.1, maybe=0.62)


#: Columns that the stages read.
DOCUMENTS = {"doc_id", "text", "lang", "source", "n_chars"}


def _set_aside(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` with all other columns under names that no operator adds, and these names."""
    names = [c if c in DOCUMENTS else f"aside_{i}" for i, c in enumerate(docs.columns)]
    return docs.toDF(*names), names


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier accepts, with all their columns as they were."""
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    rows, names = _set_aside(docs)
    scored = nbsvm.score_documents(rows, labels)
    return scored.where("predicted = 1").select(names).toDF(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that are boilerplate of their source.

    Copies and near copies count once and a line must stand on three different
    documents, so that they reach the next stage whole.
    """
    rows, names = _set_aside(docs)
    cleaned = sitelines.drop_site_lines(rows, F.col("source"),
                                        p=sitelines.SiteParams(least=3, distinct=True))
    return (cleaned.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
            .select(names).toDF(*docs.columns))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, of a similarity of 0.8 or more."""
    return without_near_duplicates(docs, NEAR)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    return mixing.mix(docs)


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mix", mix),
]

#: SQL cannot express the learnt and the sketch-based stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mix of all stages over ``documents``: doc_id, size, source_size, target, taken.

    Null and empty texts are scored like others and, where the classifier keeps them, pass
    every later stage: they have no lines, near copies or benchmark items, and a size of 0.
    Of repeated rows one stays. Long texts are read whole. Further columns, whatever their
    names, come through all stages but the last unchanged. Empty tables give no rows.
    """
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
