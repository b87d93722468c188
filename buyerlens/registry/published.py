"""The stored segments that the queries on published tables read: two as-of dates, scored once per session."""

from __future__ import annotations

from pyspark.sql import SparkSession

from buyerlens.operators import scoring
from buyerlens.oracle_base import AS_OF, PRIOR
from buyerlens.plans import feature_table as plan
from buyerlens.plans import pipelines
from buyerlens.registry.given import STAMP, given_model
from buyerlens.session import scratch_path
from buyerlens.sources import adapters, partitions
from buyerlens.sources.versions import VersionedTable

_ROOTS: dict[tuple[str, str], str] = {}


def published_root(spark: SparkSession, sf_dir: str) -> str:
    """Folder with the features, segments and log of both dates; the later one is published last.

    Scoring is a weekly job, its readers come all the time: the first query on an input stores the tables,
    the others in the session read them."""
    found = (spark.sparkContext.applicationId, sf_dir)
    if found not in _ROOTS:
        root = scratch_path(spark)
        for day in (PRIOR, AS_OF):
            # at the end of 2000 some customers bought on the as-of day, which the strict form refuses
            pipelines.persist_features(
                plan.feature_table(adapters.retail(spark, sf_dir), day), f"{root}/features", f"{root}/log", strict=False)
            features, commit = partitions.stored_features(spark, f"{root}/features", day, "1.0.0")
            scored = scoring.assign_segments(features, given_model(features), scored_at=STAMP, strict=False)
            scoring.persist_segments(scored, f"{root}/segments", f"{root}/log", expected_rows=commit["row_count"])
            scoring.publish_current(spark, f"{root}/segments", day)
        _ROOTS[found] = root
    return _ROOTS[found]


def published(spark: SparkSession, sf_dir: str) -> VersionedTable:
    return scoring.segment_store(spark, f"{published_root(spark, sf_dir)}/segments")
