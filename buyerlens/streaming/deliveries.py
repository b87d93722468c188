"""Incremental ingest: a file stream that names the months with news, and the ledger that brings them up to date."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from buyerlens.contracts import INCREMENTAL_DATASETS
from buyerlens.sources import ledger


def delivery_stream(spark: SparkSession, landing: str, dataset: str) -> DataFrame:
    """Lines of new files under ``landing/<dataset>`` with the folder columns that they came with.

    A file rewritten under its old name is not seen again; the batch ingest sees it by its time."""
    if dataset in INCREMENTAL_DATASETS:
        schema = "value string, year int, month int"
    elif dataset == "customers":
        schema = "value string, snapshot string"
    else:
        raise ValueError(f"{dataset} is not delivered")
    return spark.readStream.schema(schema).option("pathGlobFilter", "*.csv*").text(f"{landing}/{dataset}")


def ingest_deliveries(spark: SparkSession, landing: str, processed: str, dataset: str, checkpoint: str) -> None:
    """Process all deliveries that have arrived, then stop.

    A micro-batch only says which months, or that the snapshot, got files; :func:`ledger.refresh` decides and
    writes. Replaying a batch after a failure finds nothing new or does what is left to do."""
    monthly = dataset in INCREMENTAL_DATASETS

    def bring_up_to_date(batch: DataFrame, _: int) -> None:
        if monthly:
            touched = batch.select("year", "month").distinct().collect()  # a row per month
            names = [ledger.month_name(r["year"], r["month"]) for r in touched]
        else:
            names = [] if batch.isEmpty() else [ledger.SNAPSHOT]
        ledger.refresh(spark, landing, processed, dataset, names)

    query = (
        delivery_stream(spark, landing, dataset)
        .writeStream.foreachBatch(bring_up_to_date).trigger(availableNow=True)
        .option("checkpointLocation", f"{checkpoint}/{dataset}").start()
    )
    query.awaitTermination()
