from __future__ import annotations

import gzip
import os
import time

import pytest
from pyspark.errors import AnalysisException, StreamingQueryException

from buyerlens.contracts import CONTRACTS
from buyerlens.operators import cleaning
from buyerlens.sources import ledger
from buyerlens.sources import partitions as P
from buyerlens.streaming.deliveries import ingest_deliveries


def test_months():
    months = P.month_list("2018-08-31", 60)
    assert months == [(2018, 7), (2018, 8)]
    assert len(P.month_list("2018-08-31", 365)) == 13


def test_months_frame_equals_list(spark):
    day = spark.sql("SELECT DATE'2018-02-28' AS as_of_date")
    got = [(r.year, r.month) for r in P.months_frame(day, 100).orderBy("year", "month").collect()]
    assert got == P.month_list("2018-02-28", 100)


def csv(path: str, header: str, *rows: str) -> None:
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join([header, *rows]) + "\n")


PAY = "order_id,payment_sequential,payment_type,payment_installments,payment_value"


def payments(root: str, month: int, name: str, *rows: str) -> None:
    csv(f"{root}/order_payments/year=2018/month={month:02d}/{name}.csv", PAY, *rows)


def customers(root: str) -> None:
    csv(f"{root}/customers/snapshot=full/customers.csv",
        "customer_id,customer_unique_id,customer_zip_code_prefix,customer_city,customer_state", "c1,u1,01234,x,SP")


def test_ingest_window(spark, tmp_path):
    landing, processed = f"{tmp_path}/landing", f"{tmp_path}/processed"
    payments(landing, 7, "order_payments", "o1,1,boleto,1,10.5")
    payments(landing, 8, "order_payments", "o2,1,boleto,1,1.5", "o3,1,voucher,2,2.5")
    with pytest.raises(FileNotFoundError):
        P.ingest_window(spark, landing, processed, "2018-08-31", 60)
    customers(landing)
    for _ in range(2):
        result = P.ingest_window(spark, landing, processed, "2018-08-31", 60)
        assert result["rows"] == {"orders": 0, "order_items": 0, "order_payments": 3, "customers": 1}
        assert result["missing_partitions"] == [
            "order_items/2018-07", "order_items/2018-08", "orders/2018-07", "orders/2018-08"]
        assert P.load_partitions(spark, processed, "order_payments", [(2018, 7), (2018, 8), (2019, 1)]).count() == 3
    only = P.load_partitions(spark, processed, "order_payments", [(2018, 7)])
    assert [r.payment_value for r in only.collect()] == [10.5]
    assert P.load_partitions(spark, processed, "orders", [(2018, 7)]).count() == 0
    assert P.load_snapshot(spark, processed).first().customer_zip_code_prefix == "01234"
    assert all("_part=2018-07" in file for file in only.inputFiles())
    commits = [c.kind for c in ledger.dataset_store(spark, processed, "order_payments").commits().collect()]
    assert commits == ["write", "write"]  # both months at once, and nothing by the second run


def test_unknown_dataset(spark, tmp_path):
    with pytest.raises(ValueError):
        P.ingest_months(spark, str(tmp_path), str(tmp_path), "customers", [(2018, 7)])
    with pytest.raises(ValueError):
        ingest_deliveries(spark, str(tmp_path), str(tmp_path), "products", str(tmp_path))


def test_missing_landing_file(spark, tmp_path):
    with pytest.raises(AnalysisException):
        P.read_landing_csv(spark, f"{tmp_path}/none", CONTRACTS["orders"])


def test_write_replaces_only_its_partitions(spark, tmp_path):
    path = f"{tmp_path}/t"
    rows = spark.createDataFrame([(1, "a", 2018, 1), (2, "b", 2018, 2)], "k int, v string, year int, month int")
    assert P.write_partitions(rows, path, ["year", "month"]) == 2
    again = spark.createDataFrame([(9, "z", 2018, 2)], "k int, v string, year int, month int")
    for _ in range(2):
        assert P.write_partitions(again, path, ["year", "month"]) == 1
        assert sorted(r.k for r in spark.read.parquet(path).collect()) == [1, 9]
    assert P.is_partition_complete(spark, path, year=2018, month=2)
    assert not P.is_partition_complete(spark, path, year=2018, month=3)
    assert not P.is_partition_complete(spark, f"{path}/none", year=2018)


def test_current_partition(spark):
    table = spark.createDataFrame([("a", "2018-01-01"), ("b", "2018-02-01")], "id string, as_of_date string")
    assert [r.id for r in P.current_partition(table).collect()] == ["b"]
    pointer = spark.createDataFrame([("2018-01-01",)], "as_of_date string")
    assert [r.id for r in P.current_partition(table, pointer).collect()] == ["a"]
    with pytest.raises(ValueError):
        P.current_partition(table, table)


def test_pointer_prunes_the_stored_table(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"2018-0{m}-01") for i in range(5) for m in (1, 2, 3)], "id int, as_of_date string")
    P.write_partitions(rows, f"{tmp_path}/t", ["as_of_date"])
    table = spark.read.schema("id int, as_of_date string").parquet(f"{tmp_path}/t")
    current = P.current_partition(table, spark.createDataFrame([("2018-02-01",)], "as_of_date string"))
    plan = current._jdf.queryExecution().executedPlan().toString()
    assert current.count() == 5 and "2018-02-01" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]


def test_compressed_landing_files_count(spark, tmp_path):
    landing, processed = f"{tmp_path}/landing", f"{tmp_path}/processed"
    payments(landing, 7, "a", "o1,1,boleto,1,10.5")
    customers(landing)
    os.makedirs(f"{landing}/order_payments/year=2018/month=08")
    with gzip.open(f"{landing}/order_payments/year=2018/month=08/b.csv.gz", "wt") as f:
        f.write(f"{PAY}\no2,1,boleto,1,1.5\n")
    assert P.ingest_window(spark, landing, processed, "2018-08-31", 60)["rows"]["order_payments"] == 2


def test_columns_are_found_by_name(spark, tmp_path):
    folder = f"{tmp_path}/l/order_payments/year=2018"
    csv(f"{folder}/month=07/a.csv", "payment_type,order_id,note,payment_sequential,payment_installments,payment_value", "boleto,o1,x,1,1,1.0")
    csv(f"{folder}/month=08/a.csv", PAY, "o2,1,voucher,1,2.0")
    ingest_deliveries(spark, f"{tmp_path}/l", f"{tmp_path}/p", "order_payments", f"{tmp_path}/c")
    assert stored(spark, f"{tmp_path}/p") == [("o1", 1.0, 7), ("o2", 2.0, 8)]
    csv(f"{folder}/month=09/a.csv", "order_id,payment_value", "o3,1.0")
    with pytest.raises(StreamingQueryException, match="lacks payment_sequential, payment_type, payment_installments"):
        ingest_deliveries(spark, f"{tmp_path}/l", f"{tmp_path}/p", "order_payments", f"{tmp_path}/c")


def test_a_part_with_another_header_is_an_error(spark, tmp_path):
    folder = f"{tmp_path}/l/order_payments/year=2018/month=07"
    csv(f"{folder}/x-d1-p1of2.csv", PAY, "o1,1,boleto,1,1.0")
    csv(f"{folder}/x-d1-p2of2.csv", "payment_type,order_id,payment_sequential,payment_installments,payment_value", "boleto,o1,2,1,1.0")
    with pytest.raises(Exception, match="header"):
        P.ingest_months(spark, f"{tmp_path}/l", f"{tmp_path}/p", "order_payments", [(2018, 7)])
    assert ledger.dataset_store(spark, f"{tmp_path}/p", "order_payments").snapshot().newest is None


def test_deliveries_by_name():
    files = [("x-d10.csv", 5), ("x-d9.csv", 9), ("y.csv", 99), ("x-d11-p1of2.csv", 7), ("z.csv.bak", 100), ("_SUCCESS", 100)]
    assert ledger.chosen(files).name == "x-d10"
    assert ledger.chosen([*files, ("x-d11-p2of2.csv.gz", 1)]).name == "x-d11"
    assert ledger.chosen([("b.csv", 1), ("a.csv", 2)]).name == "a" and ledger.chosen([("a.csv", 1), ("b.csv", 1)]).name == "b"
    assert ledger.chosen([("x-d1-p1of2.csv", 1), ("x-d1-p1of2.csv.gz", 1)]) is None and ledger.chosen([]) is None
    (one,) = ledger.deliveries([("part-00000-5e0b-c000.csv", 1), ("part-00001-5e0b-c000.csv", 2), ("part-00001-5e0b-c001.csv", 2)])
    assert (one.name, one.number, len(one.files)) == ("5e0b", None, 3)


def test_numbered_deliveries(spark, tmp_path):
    """Parts over several runs, an older delivery that is late, a copied file, and batch and stream on one ledger."""
    landing, processed = f"{tmp_path}/l", f"{tmp_path}/p"

    def stream():
        ingest_deliveries(spark, landing, processed, "order_payments", f"{tmp_path}/c")
        return [r[0] for r in stored(spark, processed)]

    def batch():
        P.ingest_months(spark, landing, processed, "order_payments", [(2018, 7)])
        return [r[0] for r in stored(spark, processed)]

    payments(landing, 7, "pay", "o1,1,boleto,1,1.0")
    assert batch() == ["o1"]
    payments(landing, 7, "pay-d2-p1of2", "o2,1,boleto,1,1.0")
    assert stream() == ["o1"] and batch() == ["o1"]
    payments(landing, 7, "pay-d2-p2of2", "o3,1,boleto,1,1.0")
    assert stream() == ["o2", "o3"]
    payments(landing, 7, "pay-d1", "o4,1,boleto,1,1.0")
    payments(landing, 7, "copy of pay", "o1,1,boleto,1,1.0")
    assert stream() == ["o2", "o3"] and batch() == ["o2", "o3"]
    # files that have been put away leave the stored month as it is
    os.remove(f"{landing}/order_payments/year=2018/month=07/pay-d2-p1of2.csv")
    assert batch() == ["o2", "o3"]
    payments(landing, 7, "pay-d3")
    assert batch() == []
    commits = ledger.dataset_store(spark, processed, "order_payments").snapshot().live
    assert commits["2018-07"]["facts"]["number"] == "3" and commits["2018-07"]["row_count"] == 0


def test_a_file_rewritten_in_place(spark, tmp_path):
    landing, processed = f"{tmp_path}/l", f"{tmp_path}/p"
    payments(landing, 7, "order_payments", "o1,1,boleto,1,1.0")
    customers(landing)
    P.ingest_window(spark, landing, processed, "2018-07-31", 10)
    time.sleep(0.05)
    payments(landing, 7, "order_payments", "o2,1,boleto,1,1.0", "o3,1,boleto,1,1.0")
    csv(f"{landing}/customers/snapshot=full/customers.csv",
        "customer_state,customer_id,customer_unique_id,customer_zip_code_prefix,customer_city", "SP,c1,u1,01234,x", "RJ,c2,u2,00001,y")
    assert P.ingest_window(spark, landing, processed, "2018-07-31", 10)["rows"] == {
        "orders": 0, "order_items": 0, "order_payments": 2, "customers": 2}
    assert {r.customer_state for r in P.load_snapshot(spark, processed).collect()} == {"SP", "RJ"}


def test_the_copy_of_the_earliest_month_is_the_first(spark):
    rows = spark.createDataFrame(
        [("o1", "c1", "delivered", "2018-08-01", 2018, 8), ("o1", "c1", "shipped", "2018-07-01", 2018, 7), ("o2", "c1", "canceled", "2018-08-01", 2018, 8)],
        "order_id string, customer_id string, order_status string, order_purchase_timestamp string, year int, month int")
    kept = {r.order_id: r.order_status for r in cleaning.clean_orders(rows).collect()}
    assert kept == {"o1": "shipped", "o2": "canceled"} and "year" not in cleaning.clean_orders(rows).columns


def test_children_inherit_their_month(spark):
    orders = spark.createDataFrame(
        [("o1", "2018-08-15 10:00:00"), ("o2", "2018"), ("o3", None)], "order_id string, order_purchase_timestamp string")
    items = spark.createDataFrame([("o1",), ("o1",), ("o2",), ("o9",)], "order_id string")
    months = P.order_months(orders)
    assert [(r.year, r.month) for r in P.inherit_month(items, months).collect()] == [(2018, 8)] * 2
    assert P.orphan_count(items, months).first().orphans == 2


def stored(spark, processed):
    rows = ledger.dataset_store(spark, processed, "order_payments").all()
    return sorted((r.order_id, r.payment_value, r.month) for r in rows.collect())


def test_deliveries(spark, tmp_path):
    landing, processed, check = f"{tmp_path}/l", f"{tmp_path}/p", f"{tmp_path}/c"

    def run():
        ingest_deliveries(spark, landing, processed, "order_payments", check)

    payments(landing, 7, "d1", "o1,1,boleto,1,1.0", "o2,1,boleto,1,2.0")
    payments(landing, 8, "d1", "o3,1,boleto,1,3.0")
    run()
    first = [("o1", 1.0, 7), ("o2", 2.0, 7), ("o3", 3.0, 8)]
    assert stored(spark, processed) == first
    run()
    assert stored(spark, processed) == first
    # the newer delivery changes one row and lacks the other; August stays
    time.sleep(1.1)
    payments(landing, 7, "d2", "o1,1,boleto,1,9.0")
    run()
    assert stored(spark, processed) == [("o1", 9.0, 7), ("o3", 3.0, 8)]
    # two deliveries of a month in one batch: the newest counts
    time.sleep(1.1)
    payments(landing, 8, "d3", "o4,1,boleto,1,4.0")
    time.sleep(1.1)
    payments(landing, 8, "d4", "o5,1,boleto,1,5.0")
    run()
    assert stored(spark, processed) == [("o1", 9.0, 7), ("o5", 5.0, 8)]
    # from scratch, all deliveries at once give the same table as the newest files alone
    ingest_deliveries(spark, landing, f"{tmp_path}/q", "order_payments", f"{tmp_path}/c2")
    assert stored(spark, f"{tmp_path}/q") == stored(spark, processed)


def test_delivery_of_several_files(spark, tmp_path):
    """All parts of one Spark write belong to the same delivery."""
    rows = spark.createDataFrame(
        [(f"o{i}", 1, "boleto", 1, float(i)) for i in range(20)], CONTRACTS["order_payments"].landing_schema)
    rows.repartition(4).write.option("header", True).csv(f"{tmp_path}/l/order_payments/year=2018/month=07")
    ingest_deliveries(spark, f"{tmp_path}/l", f"{tmp_path}/p", "order_payments", f"{tmp_path}/c")
    assert len(stored(spark, f"{tmp_path}/p")) == 20


def test_a_delivery_in_two_runs_and_an_older_one(spark, tmp_path):
    landing, processed = f"{tmp_path}/l", f"{tmp_path}/p"
    name = "part-0000{}-5e0b-[a] b-c00{}"

    def run():
        ingest_deliveries(spark, landing, processed, "order_payments", f"{tmp_path}/c")
        return [r[0] for r in stored(spark, processed)]

    payments(landing, 7, name.format(0, 0), "o1,1,boleto,1,1.0")
    payments(landing, 7, name.format(0, 1), "o2,1,boleto,1,2.0")
    assert run() == ["o1", "o2"]
    payments(landing, 7, name.format(1, 0), "o3,1,boleto,1,3.0")
    assert run() == ["o1", "o2", "o3"]
    payments(landing, 7, "old", "o4,1,boleto,1,4.0")
    os.utime(f"{landing}/order_payments/year=2018/month=07/old.csv", (1e9, 1e9))
    assert run() == ["o1", "o2", "o3"]
    payments(landing, 8, "other", "o5,1,boleto,1,5.0")
    # a newer delivery stands between the parts of one that is newest in the end
    payments(landing, 7, "between", "o6,1,boleto,1,6.0")
    assert run() == ["o5", "o6"]
    time.sleep(1.1)
    payments(landing, 7, name.format(2, 0), "o7,1,boleto,1,7.0")
    assert run() == ["o1", "o2", "o3", "o5", "o7"]
