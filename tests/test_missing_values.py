from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from buyerlens.contracts import CONTRACTS
from buyerlens.operators.clustering import first_smallest
from buyerlens.operators.preprocess import fit_preprocessor
from buyerlens.sources.partitions import ingest_months


def test_nan_is_missing_as_null_is(spark):
    def fitted(missing):
        rows = spark.createDataFrame([(float(i),) for i in range(1, 9)] + [(missing,)], "x double")
        return fit_preprocessor(rows, ["x"], [])

    nan, null = fitted(math.nan), fitted(None)
    assert nan.medians == null.medians == {"x": 4.5}
    assert nan.means == null.means and nan.stds == null.stds


def test_a_row_without_a_score_has_no_label(spark):
    rows = spark.createDataFrame([(2.0, 1.0), (1.0, 1.0), (None, 1.0), (1.0, math.nan)], "a double, b double")
    assert [r[0] for r in rows.select(first_smallest([F.col("a"), F.col("b")])).collect()] == [1, 0, None, None]


def test_reordered_landing_columns_are_an_error(spark, tmp_path):
    names = [f.name for f in CONTRACTS["order_payments"].landing_schema.fields] if hasattr(
        CONTRACTS["order_payments"].landing_schema, "fields") else None
    if names is None:
        pytest.skip("schema is text")
    folder = tmp_path / "landing" / "order_payments" / "year=2018" / "month=01"
    folder.mkdir(parents=True)
    (folder / "a.csv").write_text(",".join(reversed(names)) + "\n" + ",".join("1" for _ in names) + "\n")
    with pytest.raises(Exception):
        ingest_months(spark, str(tmp_path / "landing"), str(tmp_path / "processed"), "order_payments", [(2018, 1)])
