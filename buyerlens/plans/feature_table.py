"""The feature table: sources to scored customers in one plan."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from buyerlens.contracts import FEATURE_COLUMNS, FEATURE_SET_VERSION
from buyerlens.functions.scalars import as_date, rfm_score
from buyerlens.operators import cleaning, joins, ranking, rollup
from buyerlens.session import checkpointed
from buyerlens.sources.adapters import Sources


def windowed_sources(
    sources: Sources, as_of: str | date, window_days: int = 365,
    statuses: tuple[str, ...] = ("delivered",),
) -> Sources:
    """Cleaned sources restricted to the observation window.

    Children are restricted before they are cleaned, so that only the window is
    deduplicated. Any copy of an order inside the window lets its children pass
    here: that needs a scan of the orders but not their deduplication, and the
    join with the cleaned orders decides in the end."""
    orders = cleaning.observation_window(
        cleaning.clean_orders(sources.orders), as_of, window_days, statuses
    )
    seen = cleaning.observation_window(
        cleaning.parse_timestamps(sources.orders), as_of, window_days, statuses
    )
    return Sources(
        orders,
        cleaning.clean_customers(sources.customers),
        cleaning.clean_order_items(joins.restrict_children(sources.items, seen)),
        cleaning.clean_order_payments(joins.restrict_children(sources.payments, seen)),
    )


def enriched_items(sources: Sources, as_of: str | date, window_days: int = 365,
                   statuses: tuple[str, ...] = ("delivered",)) -> DataFrame:
    kept = windowed_sources(sources, as_of, window_days, statuses)
    return joins.join_sources(kept.orders, kept.customers, kept.items, kept.payments)


def score_customers(customers: DataFrame) -> DataFrame:
    scored = ranking.add_quintile_scores(
        customers, "customer_unique_id",
        {
            "r_score": ("recency_days", False),
            "f_score": ("frequency", True),
            "m_score": ("monetary", True),
        },
    )
    return scored.withColumn("rfm_score", rfm_score(F.col("r_score"), F.col("f_score"), F.col("m_score")))


def _finish(order_level: DataFrame, as_of: str | date, version: str, built_at: str | None) -> DataFrame:
    # scoring reads the customers twice; the joins above must run once
    customers = checkpointed(rollup.customer_rfm(order_level, as_of))
    stamp = F.lit(built_at).cast("timestamp") if built_at else F.current_timestamp()
    return (
        score_customers(customers)
        .withColumn("as_of_date", F.lit(as_date(as_of).isoformat()))
        .withColumn("feature_set_version", F.lit(version))
        .withColumn("built_at", stamp)
        .select(*FEATURE_COLUMNS)
    )


def features_from_enriched(enriched: DataFrame, as_of: str | date,
                           version: str = FEATURE_SET_VERSION, built_at: str | None = None) -> DataFrame:
    """Feature table from persisted enriched items; an empty input is an error."""
    features = _finish(rollup.order_rollup(enriched), as_of, version, built_at)
    if features.isEmpty():
        raise ValueError("no enriched items: features cannot be built")
    return features


def feature_table(sources: Sources, as_of: str | date, window_days: int = 365,
                  statuses: tuple[str, ...] = ("delivered",),
                  version: str = FEATURE_SET_VERSION, built_at: str | None = None) -> DataFrame:
    """Feature table straight from the sources, without the item-level join."""
    kept = windowed_sources(sources, as_of, window_days, statuses)
    order_level = rollup.order_rollup_from_sources(kept.orders, kept.customers, kept.items, kept.payments)
    return _finish(order_level, as_of, version, built_at)
