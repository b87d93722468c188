"""Versioned tables: commits, publication, validation while writing, lookups, and the strict plan."""

from __future__ import annotations

import re
import threading

import pytest
from pyspark.sql import functions as F
from test_features import make_sources

from buyerlens.contracts import ORDERS
from buyerlens.operators import scoring
from buyerlens.plans import checked, feature_table, pipelines
from buyerlens.session import file_names
from buyerlens.sources.adapters import Sources
from buyerlens.sources.versions import BUCKET, RejectedWrite, VersionedTable


@pytest.fixture
def table(spark, tmp_path):
    rows = rows_of(spark, 1, "a")
    return VersionedTable(spark, str(tmp_path), rows.schema, "people", key="id", bucket_rows=100)


def rows_of(spark, n: int, tag: str):
    return spark.range(n).select(F.format_string("c%05d", "id").alias("id"), F.lit(tag).alias("tag"))


def tags(df) -> dict:
    return {r["tag"]: r["count"] for r in df.groupBy("tag").count().collect()}


def test_a_table_without_commits_is_empty(table):
    assert table.current().count() == 0 and table.all().count() == 0 and table.snapshot().newest is None
    assert table.matching(table.current(), None).columns == ["id", "tag"]
    with pytest.raises(FileNotFoundError):
        table.publish("2018-01-01")


def test_readers_between_two_publishes(spark, table):
    table.write(rows_of(spark, 10, "old"), "2018-01-31")
    table.publish("2018-01-31", model="m1")
    before = table.snapshot()
    # written, but not published: the current rows stay, a later date and a new version alike
    table.write(rows_of(spark, 20, "new"), "2018-01-31")
    table.write(rows_of(spark, 30, "later"), "2018-02-28")
    assert tags(table.current()) == {"old": 10} and table.snapshot().newest["partition"] == "2018-02-28"
    assert tags(table.all()) == {"new": 20, "later": 30}
    table.publish("2018-02-28", model="m2")
    assert tags(table.current()) == {"later": 30} and table.snapshot().current["facts"] == {"model": "m2"}
    # a reader stays on the versions that it saw
    assert tags(table.read(before.current)) == {"old": 10} and tags(table.read(*before.live.values())) == {"old": 10}
    assert [c.kind for c in table.commits().orderBy("version").collect()] == ["write", "publish", "write", "write", "publish"]


def test_readers_during_publishes(spark, table):
    """Whatever a reader meets is one whole published version."""
    sizes = {"v0": 50, "v1": 60, "v2": 70, "v3": 80}
    table.write(rows_of(spark, sizes["v0"], "v0"), "2018-01-31")
    table.publish("2018-01-31")
    seen, done, failed = [], threading.Event(), []

    def read() -> None:
        try:
            while not done.is_set():
                seen.append(tags(table.current()))
        except Exception as error:  # noqa: BLE001 - shown by the assertion below
            failed.append(error)

    reader = threading.Thread(target=read)
    reader.start()
    for tag in ("v1", "v2", "v3"):
        table.write(rows_of(spark, sizes[tag], tag), "2018-01-31")
        table.publish("2018-01-31")
    done.set()
    reader.join()
    assert not failed and seen
    assert all(len(found) == 1 and found.items() <= sizes.items() for found in seen)
    assert tags(table.current()) == {"v3": 80}


def test_a_write_that_dies_leaves_no_version(spark, table):
    table.write(rows_of(spark, 10, "old"), "2018-01-31")
    broken = rows_of(spark, 10, "x").withColumn("tag", F.raise_error(F.lit("lost")).cast("string"))
    with pytest.raises(Exception, match="lost"):
        table.write(broken, "2018-01-31", expected_rows=10)
    assert tags(table.current()) == {"old": 10}


def test_rejected_rows_leave_their_report(spark, table):
    table.write(rows_of(spark, 10, "old"), "2018-01-31")
    twice = rows_of(spark, 10, "new").unionByName(rows_of(spark, 3, "again"))
    with pytest.raises(RejectedWrite, match="tag_is_new: 3; primary_key_unique: 3"):
        table.write(twice, "2018-01-31", {"tag_is_new": F.count_if(F.col("tag") != "new")})
    assert tags(table.current()) == {"old": 10} and len(file_names(spark, f"{table.root}/data")) == 1
    kept = table.commits().where("kind = 'reject'").first()
    assert not kept.passed and kept.data is None and kept.row_count == 13
    assert [(r.check, r.violations) for r in kept.report] == [("tag_is_new", 3), ("primary_key_unique", 3)]
    # on request they are kept with their verdict
    assert not table.write(twice, "2018-02-28", strict=False)["passed"] and table.read(table.snapshot().newest).count() == 13


def test_null_keys_and_extra_columns(spark, table):
    rows = spark.createDataFrame([(None, "n", 1), ("c1", "n", 2)], f"id string, tag string, {BUCKET} int")
    commit = table.write(rows, "2018-01-31")
    assert commit["passed"] and sorted(map(str, table.read(commit).collect())) == sorted(map(str, rows.drop(BUCKET).collect()))
    assert table.matching(spark.createDataFrame([(None,), ("c1",), ("c1",)], "id string"), commit).collect() == [("c1", "n")]


def _files_read(df) -> int:
    """Files that the scans of an executed plan opened."""
    plan = df._jdf.queryExecution().executedPlan()
    plan = plan.executedPlan() if "AdaptiveSparkPlan" in plan.nodeName() else plan
    leaves = plan.collectLeaves()
    scans = [leaves.apply(i) for i in range(leaves.size()) if "Scan parquet" in leaves.apply(i).nodeName()]
    return sum(scan.metrics().apply("numFiles").value() for scan in scans)


def test_few_ids_read_few_files_of_one_date(spark, table):
    for day in ("2018-01-31", "2018-02-28", "2018-03-31"):
        commit = table.write(rows_of(spark, 2_000, day), day, expected_rows=2_000)
    assert commit["buckets"] == 20
    every = table.read(commit)
    every.collect()
    files = _files_read(every)
    assert files == 20
    few = table.matching(spark.createDataFrame([("c00007",), ("nobody",)], "id string"), commit)
    assert [tuple(r) for r in few.collect()] == [("c00007", "2018-03-31")]
    assert 1 <= _files_read(few) <= 2
    # more ids than are pushed into a scan meet the rows in a join
    many = rows_of(spark, 1_500, "x").select("id")
    assert table.matching(many, commit).count() == 1_500


def test_stored_rows_are_sorted_within_their_bucket(spark, table):
    commit = table.write(rows_of(spark, 1_000, "a").orderBy(F.rand(1)), "2018-01-31", expected_rows=300)
    rows = spark.read.parquet(f"{table.root}/data/_commit={commit['data']}").select(F.input_file_name().alias("f"), BUCKET, "id").collect()
    by_file: dict[str, list] = {}
    for r in rows:
        by_file.setdefault(r.f, []).append(r.id)
    assert len({r[BUCKET] for r in rows}) == 3 and all(ids == sorted(ids) for ids in by_file.values())


def test_lookup_in_the_stored_segments(spark, toy_features, tmp_path):
    root = str(tmp_path)
    model = scoring.fit_model(toy_features, "kmeans", 3, n_init=2)
    pipelines.persist_features(toy_features, f"{root}/features")
    pipelines.run_batch_scoring(spark, root, "2018-08-31", model, scored_at="2018-09-02 00:00:00")
    ids = spark.createDataFrame([("c001",), ("c001",), ("nobody",)], "customer_unique_id string")
    rows = {r.customer_unique_id: r for r in pipelines.lookup_segments(spark, root, ids).collect()}
    assert rows["c001"].updated_at == "2018-09-02 00:00:00" and rows["nobody"].segment_id is None and len(rows) == 2


# --- validation on the way ------------------------------------------------------------------

@pytest.fixture(scope="module")
def sources(spark):
    made = make_sources(spark, 40)
    missing = [f"cast(null as timestamp) {c}" for c in ORDERS.columns if c not in made.orders.columns]
    tables = [made.orders.selectExpr("*", *missing), made.customers, made.items.dropDuplicates(), made.payments]
    # plain rows, so that the plans hold no exchange of the fixture
    return Sources(*[spark.createDataFrame(t.collect(), t.schema) for t in tables])


def _exchanges_of(df, column: str) -> int:
    """Exchanges of a plan whose rows hold a column."""
    text = df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    return sum(f"{column}#" in block.split("Input [")[1].split("\n")[0] for block in re.split(r"\n\n", text)
               if re.match(r"\(\d+\) Exchange", block) and "Input [" in block)


def test_checked_items_are_the_unchecked_ones(spark, sources):
    items, watched = checked.checked_items(sources, "2018-08-31")
    plain = feature_table.enriched_items(sources, "2018-08-31")
    assert items.columns == plain.columns
    assert sorted(map(str, items.collect())) == sorted(map(str, plain.collect()))
    report = watched.report()
    assert all(r[1] for r in report)
    names = {r[0] for r in report}
    assert {"fk_orders_customers", "fk_items_orders", "fk_payments_orders", "orders.allowed_values:order_status",
            "order_items.primary_key_unique", "customers.not_null:customer_id", "order_payments.row_count_min"} <= names


def test_items_are_exchanged_once_with_all_checks(spark, sources):
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        items, _ = checked.checked_items(sources, "2018-08-31")
        assert _exchanges_of(items, "freight_value") == 1
        assert _exchanges_of(items, "freight_value") <= _exchanges_of(feature_table.enriched_items(sources, "2018-08-31"), "freight_value")
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_violations_are_counted_as_the_reports_count_them(spark, sources):
    bad = Sources(
        sources.orders.withColumn("order_status", F.when(F.col("order_id") == "o1", "lost").otherwise(F.col("order_status"))),
        sources.customers, sources.items.unionByName(sources.items.limit(2)),
        sources.payments.withColumn("payment_type", F.when(F.col("order_id") == "o2", " nan ").otherwise(F.col("payment_type")))
        .unionByName(sources.payments.limit(1).withColumn("order_id", F.lit("none"))))
    items, watched = checked.checked_items(bad, "2018-08-31")
    items.collect()
    found = {r[0]: (r[3], r[4]) for r in watched.report() if not r[1]}
    paid = sources.payments.where("order_id = 'o2'").count()
    assert found["order_items.primary_key_unique"] == (2, "2 duplicatas em PK ['order_id', 'order_item_id']")
    assert found["order_payments.not_null:payment_type"] == (paid, f"{paid} nulos em payment_type")
    assert found["fk_payments_orders"] == (1, "1 órfãos em ['order_id']")
    lost = sources.orders.where("order_id = 'o1'").count()
    assert found["orders.allowed_values:order_status"][0] == lost
    with pytest.raises(ValueError, match="Validação falhou"):
        pipelines.check_sources(bad)


def test_an_empty_table_is_reported(spark, sources, tmp_path):
    none = Sources(sources.orders, sources.customers, sources.items.limit(0), sources.payments)
    with pytest.raises(ValueError, match="row_count_min"):
        pipelines.build_enriched(none, str(tmp_path), "2018-08-31")
    assert not file_names(spark, f"{tmp_path}/data")
