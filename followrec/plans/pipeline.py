"""End-to-end daily run: closest connections, reputation, recommendations,
publish, checks.

Stage outputs that are read more than once (closest connections feed both
sides of the self join and the publish; the ranked candidates feed both the
recommendations and the reasons) are written once to the shared checkpoint
folder and read back. That cuts lineage, so a lost executor re-runs one
stage, not the whole day. Independent work (closest connections and scores;
the three table publishes) is submitted as concurrent jobs.
"""

from __future__ import annotations

import logging
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from followrec.operators import closest as cl
from followrec.operators import recommend as rc
from followrec.operators import reputation as rp
from followrec.operators import quality as dq
from followrec.operators import tables as tb
from followrec.params import Params
from followrec.session import prepare, scratch_path
from followrec.sources.feeds import Feeds
from followrec.sources.feeds import daily_folder
from followrec.sources.sinks import (
    commit_manifest,
    cut_lineage,
    latest_manifest,
    read_published,
    write_csv,
    write_snapshot,
)


def published_batch(name: str, rows: DataFrame) -> DataFrame:
    """Stage output in the staging layout of one published table: closest
    connections, ranked candidates or their reasons."""
    if name == "closest_connections":
        return rows.select("user_id", F.col("engaged_with_user_id").alias("closest_connection"),
                           cl.weight_decimal("w8").alias("weight"))
    if name == "recommendations":
        return rows.select("user_id", "rec_id")
    return rc.reason_rows(rows)


def daily_batches(spark: SparkSession, feeds: Feeds, messages: DataFrame, params: Params,
                  scorer: rp.Scorer = rp.label_share_scorer, stage_dir: str | None = None,
                  observe: bool = False, training_messages: DataFrame | None = None,
                  scores: DataFrame | None = None):
    """Compute the day's three batches (lazy unless `stage_dir` is given).

    `scores` (user_id, pred) may be passed in when already computed: the
    reputation does not depend on the run time.

    With `stage_dir`, closest connections, scores and ranked candidates are
    materialized there. With `observe`, stage row counts are collected as
    metrics while the stages run (no extra job).
    """
    obs = {}

    def track(name: str, df: DataFrame) -> DataFrame:
        if not observe:
            return df
        o = Observation(name)
        obs[name] = o
        return df.observe(o, F.count(F.lit(1)).alias("rows"))

    closest = track("closest", cl.closest_connections(feeds, params))
    given = scores is not None
    if not given:
        scores = track("scores", rp.reputation_scores(spark, messages, params, scorer,
                                                      training_messages))
    if stage_dir:
        # independent branches: materialized as concurrent jobs
        jobs = [lambda: cut_lineage(spark, closest, f"{stage_dir}/closest")]
        if not given:
            jobs.append(lambda: cut_lineage(spark, scores, f"{stage_dir}/scores"))
        done = concurrently(*jobs)
        closest = done[0]
        if not given:
            scores = done[1]
    active = rc.active_sources(closest, feeds.user)
    if stage_dir:
        active = cut_lineage(spark, active, f"{stage_dir}/active")
    top = rc.keep_high_scores(
        rc.ranked_from_active(active, feeds.follow, params), scores, params)
    top = track("recommendations", top)
    if stage_dir:
        top = cut_lineage(spark, top, f"{stage_dir}/top")
    reasons = rc.winners_reasons(top, active)
    if stage_dir:
        reasons = cut_lineage(spark, reasons, f"{stage_dir}/reasons")
    stages = {"closest": closest, "top": top, "reasons": reasons}
    batches = {name: published_batch(name, rows)
               for name, rows in zip(tb.TABLES, (closest, top, reasons))}
    return batches, scores, obs, stages


def write_daily_outputs(stages: dict, scores: DataFrame, root: str, params: Params) -> str:
    """The day's files in the reference's layouts, CSV with header, under
    root/yyyyMMdd: closest lists (wide), closest data (long), scores (sorted
    by user), recommendations and their reasons (after the score filter)."""
    folder = daily_folder(root, params.as_of)
    top, reasons = stages["top"], stages["reasons"]
    files = {
        "closest_connections.csv": cl.closest_lists(stages["closest"]),
        "closest_connections_data.csv": cl.closest_long(stages["closest"]),
        "score.csv": scores.orderBy("user_id"),
        "user_rec.csv": top.select("user_id", F.col("rec_id").alias("user_rec")),
        "user_rec_reasons.csv": rc.reason_rows(reasons).select(
            "user_id", F.col("rec_id").alias("user_rec"),
            F.col("reason_id").alias("reason"), "weight"),
    }
    concurrently(*[lambda n=n, df=df: write_csv(df, f"{folder}/{n}") for n, df in files.items()])
    return folder


def publish(spark: SparkSession, batches: dict, publish_root: str, params: Params) -> dict:
    """Upsert + expire all tables and publish them as one step; returns paths.

    Each table is written as a new bucketed snapshot next to the old one. Then
    one manifest names the snapshots of all tables: readers follow the latest
    manifest, so they see all of a publish or nothing of it. The manifest's
    number follows the one this publish started from; when another publish
    has taken that number meanwhile, this one fails and changes nothing.
    """
    root = publish_root.rstrip("/")
    base = latest_manifest(spark, root)
    version = f"{params.as_of:%Y%m%dT%H%M%S}-{uuid.uuid4().hex}"

    def one(name: str, staged: DataFrame) -> str:
        target = read_published(spark, root, name, tb.table_schema(name), tb.bucket_keys(name), base)
        out = tb.publish_table(name, target, staged, params)
        return write_snapshot(out, f"{root}/{name}", version, tb.bucket_keys(name))

    names = list(batches)
    written = concurrently(*[lambda n=n: one(n, batches[n]) for n in names])
    paths = dict(base.tables if base else {}) | dict(zip(names, written))
    commit_manifest(spark, root, base, paths)
    return dict(zip(names, written))


def concurrently(*thunks):
    """Run independent Spark actions as concurrent jobs; results in order."""
    with ThreadPoolExecutor(max_workers=len(thunks)) as pool:
        return [f.result() for f in [pool.submit(t) for t in thunks]]


LOG = logging.getLogger("followrec")


def run_daily(spark: SparkSession, feeds: Feeds, messages: DataFrame, params: Params,
              publish_root: str, scorer: rp.Scorer = rp.label_share_scorer,
              stage_counts: dict | None = None,
              training_messages: DataFrame | None = None,
              outputs_root: str | None = None) -> DataFrame:
    """X4: compute, publish and check one day; returns the check report.

    Stage row counts are observed while the stages run and logged (and put
    into `stage_counts` when a dict is given). With `outputs_root`, the day's
    CSV files are also written in the reference's layouts. Raises DataQualityError when a
    check fails (after publishing, like the reference's last task), ValueError
    on a duplicate key before publishing.
    """
    prepare(spark)
    stage_dir = scratch_path(spark, f"run-{params.as_of:%Y%m%d}")
    batches, scores, obs, stages = daily_batches(
        spark, feeds, messages, params, scorer, stage_dir, observe=True,
        training_messages=training_messages)
    if outputs_root:
        write_daily_outputs(stages, scores, outputs_root, params)
    for name, o in obs.items():
        rows = o.get.get("rows")
        LOG.info("stage %s: %s rows", name, rows)
        if stage_counts is not None:
            stage_counts[name] = rows
    paths = publish(spark, batches, publish_root, params)
    published = {n: spark.read.parquet(p) for n, p in paths.items()}
    return dq.run_table_checks(published, params)
