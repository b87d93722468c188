from __future__ import annotations

import math
import random

import pytest
from conftest import ENRICHED, at
from pyspark.sql import functions as F

from buyerlens.functions import scalars as S
from buyerlens.operators import cleaning, joins, ranking, rollup
from buyerlens.plans import feature_table as plan
from buyerlens.sources.adapters import Sources


def by_id(df, key="customer_unique_id"):
    return {r[key]: r for r in df.collect()}


def test_rfm_basic(basic_enriched):
    rows = by_id(plan.features_from_enriched(basic_enriched, "2018-08-31"))
    u1, u2 = rows["u1"], rows["u2"]
    assert (u1.recency_days, u1.frequency, u1.monetary, u1.avg_ticket) == (30, 2, 150.0, 75.0)
    assert (u1.avg_items_per_order, u1.avg_freight, u1.avg_installments) == (1.0, 7.5, 1.5)
    assert (u1.customer_age_days, u1.avg_days_between_orders) == (61, 61.0)
    assert (u1.preferred_payment_type, u1.rfm_score) == ("boleto", "555")
    assert (u2.recency_days, u2.monetary, u2.customer_age_days, u2.rfm_score) == (47, 80.0, 0, "111")
    assert u2.avg_days_between_orders is None


def test_one_order_scores_one(spark):
    one = spark.createDataFrame([("u", "o", 1, at("2018-08-01"), 10.0, 1.0, 11.0, 1.0, None, None)], ENRICHED)
    row = plan.features_from_enriched(one, "2018-08-31").first()
    assert (row.frequency, row.recency_days, row.rfm_score) == (1, 30, "111")
    assert row.avg_days_between_orders is None and row.preferred_payment_type is None


def test_empty_input_is_an_error(spark):
    with pytest.raises(ValueError):
        plan.features_from_enriched(spark.createDataFrame([], ENRICHED), "2018-08-31")


def test_recency_floors(spark):
    rows = spark.createDataFrame([
        (at("2018-08-31 10:00:00"),), (at("2018-08-01 10:00:00"),), (at("2018-08-31 00:00:00"),),
    ], "ts timestamp").select(S.elapsed_days_floor("2018-08-31", F.col("ts")).alias("d"))
    assert [r.d for r in rows.collect()] == [-1, 29, 0]


def test_state_is_that_of_the_smallest_order_with_one(spark):
    rows = [
        ("u", "o1", 1, at("2018-08-01"), 1.0, 0.0, 1.0, 1.0, "a", None),
        ("u", "o2", 1, at("2018-08-02"), 1.0, 0.0, 1.0, 1.0, "a", "RJ"),
        ("u", "o3", 1, at("2018-08-03"), 1.0, 0.0, 1.0, 1.0, "a", "SP"),
    ]
    level = rollup.order_rollup(spark.createDataFrame(rows, ENRICHED))
    assert rollup.customer_rfm(level, "2018-08-31").first().customer_state == "RJ"


def expected_quintiles(values, ascending):
    order = sorted(values, key=lambda p: (p[1] if ascending else -p[1], p[0]))
    n = len(values)
    if len({v for _, v in values}) < 2:
        return {i: 1 for i, _ in values}
    return {i: 1 if r == 1 else math.ceil(5 * (r - 1) / (n - 1)) for r, (i, _) in enumerate(order, 1)}


@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 7, 11, 12, 29, 500])
@pytest.mark.parametrize("distinct", [1, 2, 10_000])
def test_quintiles_match_the_rank_formula(spark, n, distinct):
    rng = random.Random(n * distinct)
    values = [(f"k{i:05d}", float(rng.randrange(distinct))) for i in range(n)]
    df = spark.createDataFrame(values, "id string, v double").repartition(5)
    got = ranking.add_quintile_scores(df, "id", {"up": ("v", True), "down": ("v", False)}).collect()
    assert {r.id: r.up for r in got} == expected_quintiles(values, True)
    assert {r.id: r.down for r in got} == expected_quintiles(values, False)


def test_quintiles_known_cases(spark):
    values = [1, 10, 20, 40, 80, 100, 120, 200, 300, 400]
    df = spark.createDataFrame([(f"{i:02d}", float(v)) for i, v in enumerate(values)], "id string, v double")
    got = ranking.add_quintile_scores(df, "id", {"s": ("v", False)}).orderBy("id").collect()
    assert [r.s for r in got] == [5, 5, 4, 4, 3, 3, 2, 2, 1, 1]
    twelve = spark.createDataFrame([(f"{i:02d}", float(i)) for i in range(12)], "id string, v double")
    counts = ranking.add_quintile_scores(twelve, "id", {"s": ("v", True)}).groupBy("s").count().orderBy("s")
    assert [r["count"] for r in counts.collect()] == [3, 2, 2, 2, 3]


def test_quintiles_with_one_value_on_almost_every_row(spark):
    """The common value is split by id, whatever the partitioning."""
    values = [(f"k{i:05d}", 1.0 if i % 40 else float(i)) for i in range(4000)]
    want = expected_quintiles(values, True)
    for parts in (1, 7):
        df = spark.createDataFrame(values, "id string, v double").repartition(parts)
        got = ranking.add_quintile_scores(df, "id", {"s": ("v", True)}).collect()
        assert {r.id: r.s for r in got} == want


def test_percent_rank_quintiles(spark):
    rng = random.Random(4)
    values = [(i, float(rng.randrange(9))) for i in range(200)]
    df = spark.createDataFrame(values, "id int, v double").repartition(3)
    got = ranking.add_percent_rank_quintiles(df, {"s": ("v", True)}).collect()
    for r in got:
        below = sum(v < r.v for _, v in values)
        ties = sum(v == r.v for _, v in values)
        assert r.s == next(k for k in range(1, 6) if (below + (ties + 1) / 2) / 200 <= k / 5 + 1e-12)


def test_exact_sample(spark):
    df = spark.range(1000).repartition(7)
    kept = ranking.sample_fraction(df, "id", 0.8, 3)
    ids = {r.id for r in kept.collect()}
    assert len(ids) == 800
    assert ids == {r.id for r in ranking.sample_fraction(df.repartition(2), "id", 0.8, 3).collect()}
    assert ids != {r.id for r in ranking.sample_fraction(df, "id", 0.8, 4).collect()}


def test_first_by_hash_equals_a_full_sort(spark):
    df = spark.range(20_000).repartition(6)
    got = [r.id for r in ranking.first_by_hash(df, "id", 50, 7).collect()]
    want = df.orderBy(S.hash_position(F.col("id"), 7), F.col("id").cast("string")).limit(50).collect()
    assert got == [r.id for r in want]
    assert ranking.first_by_hash(df, "id", 30_000, 7).count() == 20_000


def test_clean_orders(spark):
    schema = "order_id string, customer_id string, order_status string, order_purchase_timestamp string"
    rows = [
        ("o1", "c1", "delivered", "2018-01-01 10:00:00"), ("o1", "c1", "delivered", "2018-01-01 10:00:00"),
        ("o2", "c2", "delivered", "2018-01-02"), (None, "c3", "delivered", "2018-01-03"),
        ("o4", "c4", "delivered", "not a date"),
    ]
    got = cleaning.clean_orders(spark.createDataFrame(rows, schema)).collect()
    assert sorted(r.order_id for r in got) == ["o1", "o2"]


def test_dedup_comes_before_the_null_filter(spark):
    rows = [("o1", None, "a", "2018-01-01"), ("o1", "c1", "a", "2018-01-01")]
    schema = "order_id string, customer_id string, order_status string, order_purchase_timestamp string"
    # the first row of the order has no customer, so the order goes
    assert cleaning.clean_orders(spark.createDataFrame(rows, schema)).count() == 0


def test_clean_items_and_payments(spark):
    items = spark.createDataFrame(
        [("o1", 1, 10.0, 1.0), ("o1", 2, -1.0, 1.0), ("o2", 1, 5.0, None), ("o2", 2, None, 1.0), ("o3", 1, 1.0, -1.0),
         ("o4", 1, 1.0, float("nan")), ("o5", 1, float("nan"), 1.0)],
        "order_id string, order_item_id int, price double, freight_value double",
    )
    assert [r.price for r in cleaning.clean_order_items(items).collect()] == [10.0]
    assert cleaning.clean_order_items(items.drop("freight_value")).count() == 4
    payments = spark.createDataFrame(
        [("o1", 1, "a", 1, 5.0), ("o1", 1, "a", 1, 5.0), ("o1", 2, "a", 1, -5.0), ("o1", 3, "a", 1, None)],
        "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double",
    )
    assert cleaning.clean_order_payments(payments).count() == 1


def test_window_bounds_are_inclusive(spark):
    rows = [("a", "2018-08-31 23:59:59"), ("b", "2017-08-31 23:59:59"), ("c", "2017-08-31 23:59:58"),
            ("d", "2018-09-01 00:00:00")]
    orders = spark.createDataFrame(rows, "order_id string, t string").select(
        "order_id", F.col("t").cast("timestamp").alias("order_purchase_timestamp"), F.lit("delivered").alias("order_status")
    )
    assert sorted(r.order_id for r in cleaning.observation_window(orders, "2018-08-31").collect()) == ["a", "b"]


def test_payment_aggregate(spark):
    rows = [("o1", 1, "voucher", 1, 1.0), ("o1", 2, "boleto", 3, 2.0), ("o2", 1, None, None, None),
            ("o3", 1, "card", 2, 1.5), ("o3", 2, "card", 4, 1.5), ("o3", 3, "a", 6, 1.0)]
    schema = "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double"
    got = by_id(joins.payment_per_order(spark.createDataFrame(rows, schema)), "order_id")
    assert tuple(got["o1"])[1:] == (3.0, 2.0, 2, "boleto")
    assert tuple(got["o2"])[1:] == (0.0, None, 0, None)
    assert tuple(got["o3"])[1:] == (4.0, 4.0, 2, "card")


def make_sources(spark, hot: int) -> Sources:
    """Thirty orders; one of them holds ``hot`` items and payments, one customer a third of the orders."""
    orders = [(f"o{i}", f"c{0 if i % 3 == 0 else i}", "delivered", at(f"2018-0{1 + i % 8}-1{i % 9} 12:00:00"))
              for i in range(30)]
    sizes = {f"o{i}": hot if i == 5 else 1 + i % 4 for i in range(30)}
    items = [(o, j, f"p{j}", "s", None, 1.25 + j % 7, 0.5) for o, n in sizes.items() for j in range(1, n + 1)]
    payments = [(o, j, ["boleto", "voucher"][j % 2], 1 + j % 3, 2.5) for o, n in sizes.items() for j in range(1, n + 1)]
    customers = [(f"c{i}", f"u{i // 2}", "00001", "city", "SP") for i in range(30)]
    doubled = items + items[::3]
    return Sources(
        spark.createDataFrame(orders, "order_id string, customer_id string, order_status string, order_purchase_timestamp timestamp"),
        spark.createDataFrame(customers, "customer_id string, customer_unique_id string, customer_zip_code_prefix string, customer_city string, customer_state string"),
        spark.createDataFrame(doubled, "order_id string, order_item_id int, product_id string, seller_id string, shipping_limit_date timestamp, price double, freight_value double").repartition(6),
        spark.createDataFrame(payments, "order_id string, payment_sequential int, payment_type string, payment_installments int, payment_value double").repartition(6),
    )


@pytest.mark.parametrize("broadcast", ["10485760", "-1"])
def test_both_paths_agree_under_skew(spark, broadcast):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    try:
        sources = make_sources(spark, 900)
        direct = plan.feature_table(sources, "2018-08-31", built_at="2018-09-01")
        joined = plan.features_from_enriched(plan.enriched_items(sources, "2018-08-31"), "2018-08-31", built_at="2018-09-01")
        left, right = sorted(map(tuple, direct.collect())), sorted(map(tuple, joined.collect()))
        assert left == right
        assert sum(r[4] for r in left) == sum(1.25 + j % 7 for i in range(30) for j in range(1, (900 if i == 5 else 1 + i % 4) + 1))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_order_is_split_at_run_time(spark):
    """With low thresholds the join splits the partition of the order that holds most items."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        sources = make_sources(spark, 20_000)
        kept = plan.windowed_sources(sources, "2018-08-31")
        level = rollup.order_rollup_from_sources(kept.orders, kept.customers, kept.items, kept.payments)
        hot = level.where("order_id = 'o5'").first()
        assert hot.items_count == 20_000
        rows = level.collect()
        assert len(rows) == 30
        assert "skew=true" in level._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)


def test_children_of_an_order_that_leaves_by_dedup_stay_out(spark):
    """One copy of the order is in the window, but the kept copy is not."""
    sources = make_sources(spark, 3)
    extra = spark.createDataFrame(
        [("o1", "c0", "delivered", at("2010-01-01 00:00:00"))], sources.orders.schema
    )
    moved = Sources(sources.orders.unionByName(extra), sources.customers, sources.items, sources.payments)
    ids = {r.order_id for r in plan.enriched_items(moved, "2018-08-31").select("order_id").collect()}
    assert "o1" not in ids and "o2" in ids


def test_scalars(spark):
    row = spark.range(1).select(
        S.log1p_nonneg(F.lit(-1.0)).alias("a"), S.log1p_nonneg(F.lit(0.0)).alias("b"),
        S.log1p_nonneg(F.lit(math.e - 1)).alias("c"),
        S.month_key(F.lit("2018-08-15 10:00:00")).alias("m"), S.month_key(F.lit("")).alias("n"),
        S.finite_or(F.lit(float("nan")), 7.0).alias("f"), S.finite_or(F.lit(float("-inf")), 7.0).alias("g"),
        S.default_as_of(F.lit("2018-09-03").cast("date")).cast("string").alias("d"),
        S.iso_date(F.lit("2018-08-31T10:00:00Z")).alias("i"),
        S.run_name(F.lit("kmeans"), F.lit(4), F.create_map(F.lit("n_init"), F.lit("10"))).alias("r"),
    ).first()
    assert (row.a, row.b, round(row.c, 12)) == (0.0, 0.0, 1.0)
    assert (row.m, row.n, row.f, row.g, row.d, row.i) == ("2018-08", None, 7.0, 7.0, "2018-09-02", "2018-08-31")
    assert row.r == "kmeans_k4_n_init=10"
