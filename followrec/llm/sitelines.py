"""Line dedup by site-relative frequency (operator 6).

A line that stands on more than ``max_ratio`` of a host's pages is boilerplate
of that host and is dropped from its pages. Lines are compared without space at
their ends; a line counts once per page; blank lines are never dropped. Hosts
with fewer than ``min_pages`` pages keep all lines, since a ratio of a few pages
says nothing. Rows with a null host are one host; a null text has no lines and
stays null.

With ``distinct`` the copies and near copies of a page count as one page of their
host, in the line's count and in the host's: they are no evidence of boilerplate,
and a group of them would else lose its lines in every copy, the one to be kept
included. Pages are told apart by the least hash of their five-word shingles, which
two pages share with the probability of their similarity: exact copies are always
one, and of near copies of similarity s to the first about 1 - s count again.
``least`` is the number of pages that a line must stand on whatever the ratio says.
Texts are hashed whole, in slices of about 1 MB or one longer text.

Counting is map-side aggregated, so neither a large host nor a common line is
ever gathered. The lines dropped for one host number at most the distinct lines
of its average page divided by ``max_ratio``, which bounds the array that the
second pass looks them up in.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from followrec.llm.common import stage
from followrec.llm.setsketch import shingle_sets
from followrec.llm.textvec import mix64, slices


@dataclass(frozen=True)
class SiteParams:
    max_ratio: float = 0.1
    min_pages: int = 10
    least: int = 1  # pages with the line
    distinct: bool = False  # copies and near copies of a page count once
    words: int = 5  # of a shingle


def host_of(url: Column) -> Column:
    """Lower-case host of a URL without port; null without one."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1))
    return F.when(host != "", host)


def html_lines(html: Column) -> Column:
    """Text of a page, one line per run between tags; scripts, styles, comments left out."""
    text = F.regexp_replace(html, r"(?s)<!--.*?-->|<script.*?</script>|<style.*?</style>", "\n")
    return F.regexp_replace(text, r"<[^>]*>", "\n")


def _key(line: Column) -> Column:
    """128-bit identity of a line without space at its ends; null for a blank line."""
    bare = F.trim(F.regexp_replace(line, r"[\x09-\x0D]", " "))
    return F.when(bare != "", F.unhex(F.md5(bare)))


def with_page(pages: DataFrame, words: int) -> DataFrame:
    """host, text, page: the least hash of the page's shingles, 0 for a page without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in slices(batch):
                page = [int(mix64(s).min()) if len(s) else 0 for s in shingle_sets(texts, words)]
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(np.array(page, np.uint64).view(np.int64))],
                    ["host", "text", "page"])

    return (pages.select(F.col("host").cast("string"), "text")
            .mapInArrow(run, "host string, text string, page bigint"))


def boilerplate(pages: DataFrame, p: SiteParams = SiteParams()) -> DataFrame:
    """(host, drop) per host with boilerplate lines in ``pages(host, text)``."""
    count = (F.count_distinct if p.distinct else F.count)(F.col("page"))
    pages = (stage(with_page(pages, p.words), "site-pages") if p.distinct
             else pages.withColumn("page", F.lit(1)))
    total = pages.groupBy("host").agg(count.alias("pages"))
    keys = F.array_distinct(F.transform(F.split("text", "\n"), _key))
    seen = (pages.select("host", "page", F.explode(keys).alias("key")).where("key is not null")
            .groupBy("host", "key").agg(count.alias("n"))
            .withColumnRenamed("host", "h"))
    common = (seen.where((F.col("n") >= p.max_ratio * p.min_pages) & (F.col("n") >= p.least))
              .join(total, F.col("h").eqNullSafe(total.host))
              .where((F.col("pages") >= p.min_pages)
                     & (F.col("n") > p.max_ratio * F.col("pages"))))
    return common.groupBy("host").agg(F.collect_set("key").alias("drop"))


def drop_site_lines(pages: DataFrame, host: Column, text: str = "text",
                    p: SiteParams = SiteParams()) -> DataFrame:
    """``pages`` with its text column cleaned, plus long columns n_lines and n_dropped.

    Columns of these two names that ``pages`` already has are replaced.
    """
    names = [c for c in pages.columns if c.lower() not in ("n_lines", "n_dropped")]
    rows = pages.select(F.struct(*(F.col(f"`{c}`") for c in names)).alias("row"),
                        host.alias("host"), F.col(f"`{text}`").alias("text"))
    drop = stage(boilerplate(rows.select("host", "text"), p).withColumnRenamed("host", "h"),
                 "boilerplate")
    lines = F.split("text", "\n")
    kept = F.filter(lines, lambda x: F.coalesce(~F.array_contains("drop", _key(x)), F.lit(True)))
    out = (rows.join(drop, rows.host.eqNullSafe(F.col("h")), "left")
           .withColumn("lines", lines)
           .withColumn("kept", F.when(F.col("drop").isNull(), F.col("lines")).otherwise(kept)))
    return out.select(
        *((F.array_join("kept", "\n") if c == text else F.col("row")[c]).alias(c) for c in names),
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("lines") - F.size("kept"), F.lit(0)).cast("long").alias("n_dropped"))


#: DuckDB SQL of the query over ``pages`` with the default parameters.
ORACLE_SQL = r"""
WITH plain AS (
  SELECT page_id, nullif(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)', 1)),
                         '') AS host,
         regexp_replace(regexp_replace(html,
             '(?s)<!--.*?-->|<script.*?</script>|<style.*?</style>', chr(10), 'g'),
             '<[^>]*>', chr(10), 'g') AS text
  FROM pages
), lines AS (
  SELECT *, trim(regexp_replace(line, '[\x09-\x0D]', ' ', 'g'), ' ') AS bare
  FROM (SELECT page_id, host, unnest(string_split(text, chr(10))) AS line,
               generate_subscripts(string_split(text, chr(10)), 1) AS i FROM plain)
), counts AS (
  SELECT host, bare, count(DISTINCT page_id) AS n FROM lines WHERE bare <> '' GROUP BY host, bare
), hosts AS (
  SELECT host, count(*) AS pages FROM plain GROUP BY host
), dropped AS (
  SELECT c.host, c.bare FROM counts c JOIN hosts h ON c.host IS NOT DISTINCT FROM h.host
  WHERE h.pages >= 10 AND c.n > 0.1 * h.pages
), judged AS (
  SELECT l.*, d.bare IS NOT NULL AS gone
  FROM lines l LEFT JOIN dropped d
    ON l.host IS NOT DISTINCT FROM d.host AND l.bare = d.bare AND l.bare <> ''
)
SELECT p.page_id, p.host,
       CASE WHEN p.text IS NULL THEN NULL ELSE
         coalesce(string_agg(j.line, chr(10) ORDER BY j.i) FILTER (WHERE NOT j.gone), '') END
         AS text,
       count(j.i)::BIGINT AS n_lines,
       (count(j.i) FILTER (WHERE j.gone))::BIGINT AS n_dropped
FROM plain p LEFT JOIN judged j ON p.page_id = j.page_id
GROUP BY p.page_id, p.host, p.text
"""
