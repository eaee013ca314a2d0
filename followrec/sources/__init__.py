"""Scans and sinks: feeds at rest, staging, snapshots."""

from followrec.sources.feeds import (  # noqa: F401
    Feeds,
    daily_folder,
    parse_closest_lists,
    preview,
    read_closest_lists,
    read_daily_partition,
    read_engagement,
    read_feeds,
    read_follow,
    read_messages,
    read_scores,
    read_user,
    require_not_null,
    write_daily_partitioned,
    write_feeds_csv,
)
from followrec.sources.sinks import (  # noqa: F401
    STAGING_SCHEMAS,
    commit_manifest,
    cut_lineage,
    latest_manifest,
    load_staging,
    read_bucketed,
    read_published,
    write_bucketed,
    write_csv,
    write_jdbc,
    write_snapshot,
)
