"""Registered queries of the numbered operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from followrec.llm import (collocations, decontaminate, digestindex, mixing, nbsvm, sitelines,
                           stringkernel, suffixgroups, turnrepair)
from followrec.llm.common import table
from followrec.llm.divergence import quality_rules
from followrec.llm.secrets import scan_secrets
from followrec.llm.setsketch import near_duplicates
from followrec.llm.wordpiece import VOCABULARY, count_tokens, read_vocabulary

Query = Callable[[SparkSession, str], DataFrame]


def op1_latent_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item: one row per document and item."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"),
                               table(spark, sf_dir, "benchmark")).drop("text_key")


def op2_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op3_confirmed_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_secrets(table(spark, sf_dir, "documents"))


def op4_suffix_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixgroups.remove_repeats(table(spark, sf_dir, "documents"))


def _labels(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select("doc_id", F.col(label).alias("label"))


def op5_nbsvm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return nbsvm.score_documents(docs, _labels(spark, sf_dir, "quality")).drop("text")


def op6_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as text lines, without the lines that are boilerplate of their host."""
    pages = table(spark, sf_dir, "pages").select(
        "page_id", sitelines.host_of(F.col("url")).alias("host"),
        sitelines.html_lines(F.col("html")).alias("text"))
    return sitelines.drop_site_lines(pages, F.col("host"))


def op7_string_kernel(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return stringkernel.score_documents(docs, _labels(spark, sf_dir, "toxic"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op9_setsketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def op10_longest_match(spark: SparkSession, sf_dir: str,
                       vocabulary: str = VOCABULARY) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), read_vocabulary(vocabulary))


def op11_digest_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digestindex.exact_duplicates(table(spark, sf_dir, "documents"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


def op13_interval_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations repaired after the contract's damage."""
    return turnrepair.repair(turnrepair.damaged(table(spark, sf_dir, "conversations")))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    op1_latent_leaks, op2_divergence, op3_confirmed_secrets, op4_suffix_groups, op5_nbsvm,
    op6_site_lines, op7_string_kernel, op8_mixing, op9_setsketch, op10_longest_match,
    op11_digest_index, op12_collocations, op13_interval_repair)}

#: DuckDB SQL over the same tables, where SQL can express the operator.
ORACLE: dict[str, str] = {
    "op8_mixing": mixing.ORACLE_SQL.replace("{docs}", "documents"),
    "op6_site_lines": sitelines.ORACLE_SQL,
    "op11_digest_index": digestindex.ORACLE_SQL,
    "op12_collocations": collocations.ORACLE_SQL,
}
