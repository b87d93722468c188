"""Partitioned tables: landing files, monthly and as-of partitions, current pointer."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from buyerlens.contracts import CONTRACTS, INCREMENTAL_DATASETS, Contract
from buyerlens.functions.scalars import as_date, month_key
from buyerlens.sources import ledger
from buyerlens.sources.versions import REPORT, VersionedTable

LOG_SCHEMA = (
    "dataset string, version string, as_of_date string, partition map<string,string>, "
    f"row_count bigint, passed boolean, n_segments bigint, report {REPORT}"
)

def read_landing_csv(spark: SparkSession, path: str, contract: Contract) -> DataFrame:
    """CSV with header under the contract's column types; a missing path is an error.

    Timestamps stay text until they are cleaned, codes keep their leading zeros."""
    return (
        spark.read.schema(contract.landing_schema)
        .option("header", True).option("enforceSchema", False).option("escape", '"').csv(path)
    )


def with_month(df: DataFrame, ts_column: str) -> DataFrame:
    """Add ``year`` and ``month``; rows whose timestamp text is too short are dropped."""
    key = month_key(F.col(ts_column).cast("string"))
    return (
        df.withColumn("_month", key).where("_month IS NOT NULL")
        .withColumn("year", F.substring("_month", 1, 4).try_cast("int"))
        .withColumn("month", F.substring("_month", 6, 2).try_cast("int"))
        .drop("_month")
    )


def order_months(orders: DataFrame, ts_column: str = "order_purchase_timestamp") -> DataFrame:
    """The month every order belongs to; the last mention of an order wins."""
    dated = with_month(orders.select("order_id", ts_column), ts_column)
    return dated.groupBy("order_id").agg(
        F.max_by(F.struct("year", "month"), ts_column).alias("m")
    ).select("order_id", "m.year", "m.month")


def inherit_month(children: DataFrame, months: DataFrame) -> DataFrame:
    """Child rows with their order's month; orphans are dropped."""
    return children.join(months, "order_id")


def land_sources(orders: DataFrame, customers: DataFrame, items: DataFrame, payments: DataFrame,
                 landing: str) -> None:
    """Split raw tables into landing files: three monthly datasets and the customer snapshot.

    Children go to the month of their order and those without one are dropped."""
    months = order_months(orders)
    dated = {
        "orders": with_month(orders, "order_purchase_timestamp"),
        "order_items": inherit_month(items, months), "order_payments": inherit_month(payments, months),
    }
    for dataset, rows in dated.items():
        texts = CONTRACTS[dataset].landing_schema
        (
            rows.select(*[F.col(f.name).cast(f.dataType) for f in texts], "year",
                        F.lpad(F.col("month").cast("string"), 2, "0").alias("month"))
            .hint("rebalance", "year", "month").write.mode("overwrite").option("header", True)
            .partitionBy("year", "month").csv(f"{landing}/{dataset}")
        )
    customers.write.mode("overwrite").option("header", True).csv(f"{landing}/customers/snapshot=full")


def orphan_count(children: DataFrame, months: DataFrame) -> DataFrame:
    per_order = children.groupBy("order_id").count()
    return per_order.join(months, "order_id", "left_anti").agg(
        F.coalesce(F.sum("count"), F.lit(0)).cast("bigint").alias("orphans")
    )


def partition_row_counts(df: DataFrame, dataset: str) -> DataFrame:
    return df.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(dataset).alias("dataset"), "year", "month", "n_rows"
    )


def month_list(as_of: str | date, window_days: int) -> list[tuple[int, int]]:
    """(year, month) pairs that cover ``[as_of - window_days, as_of]``, ascending."""
    end = as_date(as_of)
    start = end - timedelta(days=window_days)
    count = (end.year - start.year) * 12 + end.month - start.month + 1
    first = start.year * 12 + start.month - 1
    return [((first + i) // 12, (first + i) % 12 + 1) for i in range(count)]


def months_frame(as_of_rows: DataFrame, window_days: int) -> DataFrame:
    """Rows ``as_of_date, year, month`` for every as-of date of the input."""
    start = F.trunc(F.date_sub("as_of_date", window_days), "MM")
    months = F.sequence(start, F.trunc("as_of_date", "MM"), F.expr("INTERVAL 1 MONTH"))
    return as_of_rows.select("as_of_date", F.explode(months).alias("m")).select(
        "as_of_date", F.year("m").alias("year"), F.month("m").alias("month")
    )


def missing_partitions(months: DataFrame, observed: DataFrame,
                       datasets: Sequence[str] = INCREMENTAL_DATASETS) -> DataFrame:
    """Expected (dataset, year, month) that ``observed`` does not hold."""
    expected = months.select("year", "month").withColumn(
        "dataset", F.explode(F.array(*[F.lit(d) for d in datasets]))
    )
    return expected.join(observed.distinct(), ["dataset", "year", "month"], "left_anti").select(
        "dataset", "year", "month",
        F.format_string("%s/%04d-%02d", "dataset", "year", "month").alias("partition"),
    )


def write_partitions(df: DataFrame, path: str, partition_by: list[str]) -> int:
    """Replace exactly the partitions present in ``df``; return the rows written.

    Writing the same rows twice leaves the same table. A month or date may hold
    most of the rows, so partitions are balanced by size, not one task each. The
    count comes from the write itself."""
    seen = Observation()
    balanced = df.hint("rebalance", *partition_by) if partition_by else df
    (
        balanced.observe(seen, F.count(F.lit(1)).alias("n"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by).parquet(path)
    )
    return seen.get["n"]


def is_partition_complete(spark: SparkSession, path: str, **partition) -> bool:
    """Whether a partition was committed.

    Files are staged and moved into the partition when the job commits, so a
    failed write leaves nothing to be found here."""
    try:
        table = spark.read.parquet(path)
    except AnalysisException:
        return False
    for column, value in partition.items():
        table = table.where(F.col(column) == value)
    return not table.isEmpty()


def ingest_months(spark: SparkSession, landing: str, processed: str, dataset: str,
                  months: Sequence[tuple[int, int]]) -> int:
    """Bring the given months of one dataset up to their newest delivery in one job; return their stored rows."""
    if dataset not in INCREMENTAL_DATASETS:
        raise ValueError(f"{dataset} is not delivered by month")
    wanted = [ledger.month_name(y, m) for y, m in months]
    live = ledger.refresh(spark, landing, processed, dataset, wanted)
    return sum(live[name]["row_count"] for name in wanted if name in live)


def ingest_snapshot(spark: SparkSession, landing: str, processed: str) -> int:
    """Bring the customer snapshot up to its newest delivery; without any it is an error."""
    stored = ledger.refresh(spark, landing, processed, "customers", [ledger.SNAPSHOT]).get(ledger.SNAPSHOT)
    if stored is None:
        raise FileNotFoundError(f"no customer snapshot has landed in {landing}")
    return stored["row_count"]


def ingest_window(spark: SparkSession, landing: str, processed: str, as_of: str | date,
                  window_days: int = 365) -> dict:
    """Ingest every landed month of the window; months that are not stored then are reported."""
    wanted = month_list(as_of, window_days)
    rows, missing = {}, []
    for dataset in INCREMENTAL_DATASETS:
        names = [ledger.month_name(y, m) for y, m in wanted]
        stored = ledger.refresh(spark, landing, processed, dataset, names)
        rows[dataset] = sum(stored[name]["row_count"] for name in names if name in stored)
        missing += [f"{dataset}/{name}" for name in names if name not in stored]
    rows["customers"] = ingest_snapshot(spark, landing, processed)
    return {"as_of_date": as_date(as_of).isoformat(), "window_days": window_days,
            "months": wanted, "rows": rows, "missing_partitions": sorted(missing)}


def load_partitions(spark: SparkSession, processed: str, dataset: str,
                    months: Sequence[tuple[int, int]]) -> DataFrame:
    """Rows of the given months in one read of their files alone; absent months are skipped and
    no month at all gives an empty table."""
    store = ledger.dataset_store(spark, processed, dataset)
    live = store.snapshot().live
    return store.read(*[live.get(ledger.month_name(y, m)) for y, m in months])


def load_snapshot(spark: SparkSession, processed: str) -> DataFrame:
    return ledger.dataset_store(spark, processed, "customers").current()


def feature_store(spark: SparkSession, path: str) -> VersionedTable:
    """Feature tables by feature set and as-of date."""
    contract = CONTRACTS["customer_features"]
    return VersionedTable(spark, path, contract.schema, "customer_features", key="customer_unique_id")


def feature_key():
    """The partition of a row of features."""
    return F.concat_ws("/", "feature_set_version", F.col("as_of_date").cast("string"))


def stored_features(spark: SparkSession, path: str, as_of: str | date, version: str) -> tuple[DataFrame, Row]:
    """One feature table by version and as-of date, and its commit; an absent one is an error."""
    store, day = feature_store(spark, path), as_date(as_of).isoformat()
    commit = store.snapshot().live.get(f"{version}/{day}")
    if commit is None:
        raise FileNotFoundError(f"feature table {version} of {day} is absent from {path}")
    return store.read(commit), commit


def load_features(spark: SparkSession, path: str, as_of: str | date, version: str) -> DataFrame:
    return stored_features(spark, path, as_of, version)[0]


def current_partition(table: DataFrame, pointer: DataFrame | None = None) -> DataFrame:
    """Rows of the published as-of date, or of the greatest one without a pointer.

    The pointer's one date is read first, so that it prunes the stored partitions."""
    if pointer is not None:
        dates = [row["as_of_date"] for row in pointer.select("as_of_date").distinct().limit(2).collect()]
        if len(dates) > 1:
            raise ValueError("the pointer names several as-of dates")
        return table.where(F.col("as_of_date").isin(dates))
    newest = table.agg(F.max("as_of_date").alias("as_of_date"))
    return table.join(newest, "as_of_date", "left_semi")


def append_log(spark: SparkSession, path: str, **entry) -> None:
    """Append one record about a written partition to the dataset log, with its validation report."""
    schema = T.StructType.fromDDL(LOG_SCHEMA)
    row = tuple(entry.get(c) for c in schema.names)
    (
        spark.createDataFrame([row], schema).withColumn("created_at", F.current_timestamp())
        .coalesce(1).write.mode("append").parquet(path)
    )


def dataset_summary(table: DataFrame, dataset: str, version_column: str | None = None) -> DataFrame:
    """Rows and segments per (version, as-of date) of a table."""
    version = F.col(version_column) if version_column else F.lit(None).cast("string")
    segments = (
        F.count_distinct("segment_id") if "segment_id" in table.columns else F.lit(None).cast("bigint")
    )
    return table.groupBy(version.alias("version"), "as_of_date").agg(
        F.count(F.lit(1)).alias("row_count"), segments.alias("n_segments")
    ).select(F.lit(dataset).alias("dataset"), "version", "as_of_date", "row_count", "n_segments")
