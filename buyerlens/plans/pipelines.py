"""The persisting pipelines: landing to features, features to published segments."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from buyerlens.contracts import CONTRACTS, CUSTOMER_FEATURES, FEATURE_SET_VERSION
from buyerlens.functions.scalars import as_date
from buyerlens.operators import cleaning, quality, scoring
from buyerlens.operators.scoring import SegmentModel, assign_segments, persist_segments, publish_current, segment_store
from buyerlens.plans import checked, feature_table
from buyerlens.session import checkpointed
from buyerlens.sources import partitions
from buyerlens.sources.adapters import Sources
from buyerlens.sources.partitions import append_log, feature_store
from buyerlens.sources.versions import VersionedTable


def load_sources(spark: SparkSession, processed: str, as_of: str | date, window_days: int = 365) -> Sources:
    """The processed months of the window and the customer snapshot."""
    months = partitions.month_list(as_of, window_days)

    def months_of(dataset: str) -> DataFrame:
        # year and month stay: of several copies of a row, that of the earliest month is the first
        return partitions.load_partitions(spark, processed, dataset, months)

    return Sources(
        months_of("orders"), partitions.load_snapshot(spark, processed), months_of("order_items"), months_of("order_payments"))


def check_sources(sources: Sources) -> None:
    """Raise when a raw table breaks its contract or a cleaned one a foreign key.

    Both look at all loaded rows, before any business filter. This is the stand-alone form, with samples of
    invalid values; ``build_enriched`` takes the same counts while it writes."""
    named = {"orders": sources.orders, "order_items": sources.items,
             "order_payments": sources.payments, "customers": sources.customers}
    for name, table in named.items():
        quality.assert_valid(quality.validate(table, CONTRACTS[name]), name)
    # the cleaned orders take part in all three keys
    orders = checkpointed(cleaning.clean_orders(sources.orders).select("order_id", "customer_id"))
    quality.assert_valid(
        quality.foreign_key_chain(
            orders, cleaning.clean_customers(sources.customers),
            cleaning.clean_order_items(sources.items), cleaning.clean_order_payments(sources.payments),
        ),
        "referential_integrity",
    )


def enriched_store(spark: SparkSession, path: str, like: DataFrame) -> VersionedTable:
    return VersionedTable(spark, path, like.schema, "orders_enriched")


def build_enriched(sources: Sources, path: str, as_of: str | date, window_days: int = 365,
                   statuses: tuple[str, ...] = ("delivered",), strict: bool = True) -> tuple[DataFrame, int]:
    """Clean, join and store the enriched items of one as-of date; return them and their number.

    With ``strict`` the one job that writes them also counts what breaks a contract or a foreign key, and
    rows that do are dropped again."""
    spark = sources.items.sparkSession
    if strict:
        items, watched = checked.checked_items(sources, as_of, window_days, statuses)
        store = enriched_store(spark, path, items)

        def report() -> list[tuple]:
            found = watched.report()
            if found is None:
                # an empty branch was planned away with its counters
                check_sources(sources)
            return found or []

        commit = store.write(items, as_date(as_of).isoformat(), upstream=report)
    else:
        items = feature_table.enriched_items(sources, as_of, window_days, statuses)
        store = enriched_store(spark, path, items)
        commit = store.write(items, as_date(as_of).isoformat())
    return store.read(commit), commit["row_count"]


def persist_features(features: DataFrame, path: str, log_path: str | None = None, strict: bool = True,
                     expected_rows: int | None = None) -> int:
    """Store a feature table as the new version of its (feature set, as-of date) and return its rows.

    The write validates on the way; with ``strict`` a table that fails leaves nothing but its report. Rows
    of one feature set and date are expected. ``expected_rows`` sets the number of buckets."""
    spark, store = features.sparkSession, feature_store(features.sparkSession, path)
    quality.assert_valid(quality.schema_columns(features, CUSTOMER_FEATURES), "customer_features")

    def name(facts: dict) -> str:
        if facts["first"] is None or facts["first"] != facts["last"]:
            raise ValueError(f"one feature set and as-of date expected, found {facts['first']} to {facts['last']}")
        return facts["first"]

    commit = store.write(
        features, name, quality.feature_counters(features),
        {"first": F.min(partitions.feature_key()), "last": F.max(partitions.feature_key())},
        lambda check, n: quality.detail_text(CUSTOMER_FEATURES, check, n), strict=strict, expected_rows=expected_rows)
    if log_path:
        version, day = commit["partition"].split("/")
        append_log(
            spark, log_path, dataset="customer_features", row_count=commit["row_count"], passed=commit["passed"],
            version=version, as_of_date=day, partition={"as_of_date": day}, report=commit["report"])
    return commit["row_count"]


def run_feature_table(spark: SparkSession, root: str, as_of: str | date, window_days: int = 365,
                      version: str = FEATURE_SET_VERSION, statuses: tuple[str, ...] = ("delivered",),
                      strict: bool = True) -> dict:
    """Landing files of the window to a validated, versioned feature table.

    ``root`` holds ``landing``, ``processed``, ``enriched``, ``features`` and ``log``.
    The enriched items are written once and the features are built from them."""
    ingested = partitions.ingest_window(spark, f"{root}/landing", f"{root}/processed", as_of, window_days)
    sources = load_sources(spark, f"{root}/processed", as_of, window_days)
    enriched, items = build_enriched(sources, f"{root}/enriched", as_of, window_days, statuses, strict)
    if not items:
        raise ValueError("no enriched items: features cannot be built")
    features = feature_table.features_from_enriched(enriched, as_of, version)
    rows = persist_features(features, f"{root}/features", f"{root}/log", strict, expected_rows=items)
    return {**ingested, "enriched_rows": items, "feature_rows": rows, "feature_set_version": version}


def run_batch_scoring(spark: SparkSession, root: str, as_of: str | date, model: SegmentModel,
                      version: str = FEATURE_SET_VERSION, scored_at: str | None = None) -> dict:
    """Score one feature table, store its segments as a new version and publish that as current."""
    features, commit = partitions.stored_features(spark, f"{root}/features", as_of, version)
    # what was validated when it was stored is not validated again
    scored = assign_segments(
        features, model, feature_set_version=version, scored_at=scored_at, strict=not (commit["passed"] and commit["row_count"]))
    summary = persist_segments(scored, f"{root}/segments", f"{root}/log", expected_rows=commit["row_count"])
    publish_current(spark, f"{root}/segments", as_of, dataset="customer_segments",
                    model_name=model.name, model_version=model.version)
    return summary


def current_segments(spark: SparkSession, root: str) -> DataFrame:
    """The published segments; the newest as-of date when nothing was published."""
    return segment_store(spark, f"{root}/segments").current()


def lookup_segments(spark: SparkSession, root: str, ids: DataFrame) -> DataFrame:
    """The current segment of each requested id, from the files that can hold them."""
    store = segment_store(spark, f"{root}/segments")
    return scoring.segment_lookup(ids, store.matching(ids, store.snapshot().current))
