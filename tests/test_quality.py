from __future__ import annotations

import pytest

from buyerlens.contracts import CONTRACTS, CUSTOMER_SEGMENTS, ORDERS, Contract, Field
from buyerlens.operators import quality


def report(df):
    return {r["check"]: r for r in df.collect()}


def orders(spark, ids, status="delivered"):
    return spark.createDataFrame(
        [(i, "c", status, None, None, None, None, None) for i in ids], ORDERS.schema
    )


def test_duplicate_key(spark):
    rows = report(quality.validate(orders(spark, ["o1", "o1"]), ORDERS))
    assert not rows["primary_key_unique"].passed and rows["primary_key_unique"].violations == 1
    with pytest.raises(ValueError, match="primary_key_unique"):
        quality.assert_valid(quality.validate(orders(spark, ["o1", "o1"]), ORDERS), "orders")


def test_null_keys_equal_each_other(spark):
    rows = report(quality.count_violations(orders(spark, [None, None, "o"]), ORDERS, "key"))
    assert rows["primary_key_unique"].violations == 1


def test_nullish_texts(spark):
    rows = report(quality.count_violations(orders(spark, ["o", " nan ", "", "None", "NaT", None, "nano"]), ORDERS, "nulls"))
    assert rows["not_null:order_id"].violations == 5
    assert rows["not_null:order_purchase_timestamp"].violations == 7


def test_allowed_values_sample_at_most_five(spark):
    frame = orders(spark, ["o"]).unionByName(orders(spark, ["p"], None))
    for k in range(7):
        frame = frame.unionByName(orders(spark, [f"q{k}"], f"bad{k}"))
    row = report(quality.validate(frame, ORDERS))["allowed_values:order_status"]
    assert row.violations == 7
    assert row.detail == "7 inválidos; amostra=[bad0, bad1, bad2, bad3, bad4]"


def test_missing_column_and_empty_table(spark):
    frame = orders(spark, []).drop("customer_id")
    rows = report(quality.validate(frame, ORDERS))
    assert not rows["schema_columns"].passed and "customer_id" in rows["schema_columns"].detail
    assert not rows["row_count_min"].passed and "not_null:customer_id" not in rows
    keyless = report(quality.validate(frame.drop("order_id"), ORDERS))
    assert not keyless["primary_key"].passed
    assert quality.column_differences(frame, ["order_id", "x"])[0] == ["x"]


def test_foreign_keys(spark):
    parent = spark.createDataFrame([("o1",), (None,)], "order_id string")
    child = spark.createDataFrame([("o1",), ("o2",), ("o2",), (None,)], "order_id string")
    row = quality.referential_integrity(child, parent, ["order_id"], ["order_id"], "fk").first()
    assert (row.passed, row.violations) == (False, 2)
    strict = quality.referential_integrity(child, parent.dropna(), ["order_id"], ["order_id"], "fk").first()
    assert strict.violations == 3
    lost = quality.referential_integrity(child, parent, ["x"], ["order_id"], "fk").first()
    assert not lost.passed and "ausente no filho" in lost.detail


def test_composite_foreign_key(spark):
    parent = spark.createDataFrame([("a", 1), ("a", None)], "x string, y int")
    child = spark.createDataFrame([("a", 1), ("a", None), ("a", 2), ("b", None)], "x string, y int")
    assert quality.referential_integrity(child, parent, ["x", "y"], ["x", "y"], "fk").first().violations == 2


def test_features(toy_features):
    assert quality.report_passed(quality.validate_features(toy_features)).first()[0]
    bad = toy_features.selectExpr(*[
        "0 AS frequency" if c == "frequency" else "-1 AS recency_days" if c == "recency_days" else c
        for c in toy_features.columns
    ])
    rows = report(quality.validate_features(bad))
    assert rows["frequency_positive"].violations == 90 and not rows["frequency_positive"].passed
    assert rows["recency_non_negative"].detail == "90 recency negativas"
    assert rows["monetary_non_negative"].passed


def test_contract_expressions(spark, toy_features):
    rows = report(quality.contract_expressions(toy_features, CONTRACTS["customer_features"]))
    assert rows["one_row_per_customer"].passed and not rows["min_customers"].passed
    doubled = toy_features.unionByName(toy_features)
    assert report(quality.contract_expressions(doubled, CONTRACTS["customer_features"]))["one_row_per_customer"].measure == 90
    empty = report(quality.contract_expressions(toy_features.limit(0), CONTRACTS["customer_features"]))
    assert not empty["frequency_positive"].passed


def test_smallest_group(spark):
    segments = spark.createDataFrame(
        [(f"c{i}", "2018-01-01", 1, 1, 1.0, 1, 1, 1, 0 if i else 1, "x", "m", "1", "1", None) for i in range(5)],
        CUSTOMER_SEGMENTS.schema,
    )
    rows = report(quality.contract_expressions(segments, CUSTOMER_SEGMENTS))
    assert rows["no_empty_segment"].measure == 1 and not rows["segment_cardinality"].passed


def test_contracts_are_complete():
    for name, contract in CONTRACTS.items():
        assert contract.name == name and contract.primary_key and contract.consumers
        assert set(contract.primary_key) <= set(contract.columns)
        for key in contract.foreign_keys:
            assert set(key.parent_columns) <= set(CONTRACTS[key.parent].columns)


def test_optional_value_rules(spark):
    contract = Contract("x", (Field("a", "integer"),), ("a",), ())
    rows = report(quality.validate(spark.createDataFrame([(1,)], "a int"), contract))
    assert set(rows) == {"schema_columns", "not_null:a", "primary_key_unique"}


def test_reconcile(spark):
    counts = quality.reconcile_counts({"a": spark.range(3), "b": spark.range(3)}).collect()
    assert all(r.reconciled for r in counts)
    assert not quality.reconcile_counts({"a": spark.range(3), "b": spark.range(4)}).first().reconciled
