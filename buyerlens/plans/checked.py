"""The enriched items with all checks of the raw and cleaned tables riding on the one job that writes them.

Counters are observed where the rows pass anyway: missing and invalid values at the scan, repeated keys in
the aggregation that keeps the first row, orphans in the joins. Items are exchanged once, by order: the
join with all cleaned orders brings them together, the rows of a key meet in the same tasks, and the window
is applied afterwards."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from buyerlens.contracts import CONTRACTS
from buyerlens.operators import cleaning, quality
from buyerlens.operators.joins import payment_per_order
from buyerlens.plans import feature_table
from buyerlens.sources.adapters import Sources

# names that no source column has
_ORDER, _PAID, _COPIES, _ROWS = "_order", "_paid", "_copies", "_payment_rows"


class Watched:
    """Counts of violations that a job observes on its way, by check."""

    def __init__(self) -> None:
        self._seen: list[tuple[Observation, list[str], Callable[[str, int], str]]] = []

    def count(self, df: DataFrame, counts: dict[str, Column], explain: Callable[[str, int], str]) -> DataFrame:
        """``df``, with ``counts`` taken while it is read. A branch must stand in the plan once."""
        seen = Observation()
        self._seen.append((seen, list(counts), explain))
        return df.observe(seen, *[v.cast("bigint").alias(f"c{i}") for i, v in enumerate(counts.values())])

    def report(self) -> list[tuple] | None:
        """``(check, passed, severity, violations, detail)`` once the job has ended.

        None if the planner left a branch out, as it may when another one is empty."""
        rows: list[tuple] = []
        for seen, checks, explain in self._seen:
            try:
                found = seen.get
            except Py4JJavaError:  # a branch that was planned away has no row of counts
                return None
            for i, check in enumerate(checks):
                n = found[f"c{i}"] or 0
                rows.append((check, n == 0, "error", n, explain(check, n)))
        return rows


def _first_counted(rows: DataFrame, keys: list[str]) -> DataFrame:
    """As ``keep_first`` keeps them, with the number of copies; partial sums keep a hot key small."""
    months = cleaning.delivered_months(rows)
    rest = [*months, *[c for c in rows.columns if c not in (*keys, *months)]]
    found = rows.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("r"), F.count(F.lit(1)).alias(_COPIES))
    return found.select(*[F.col(c) if c in keys else F.col(f"r.{c}") for c in rows.columns if c not in months], _COPIES)


def checked_items(sources: Sources, as_of: str | date, window_days: int = 365,
                  statuses: tuple[str, ...] = ("delivered",)) -> tuple[DataFrame, Watched]:
    """The rows of ``feature_table.enriched_items`` and the checks that their evaluation fills in."""
    watched = Watched()

    def raw(dataset: str, rows: DataFrame) -> DataFrame:
        contract = CONTRACTS[dataset]
        counts = quality.row_counters(rows, contract)
        counts = {f"{dataset}.{check}": count for check, count in counts.items()}
        return watched.count(rows, counts, _explained(dataset)).dropna(subset=list(contract.primary_key))

    def deduplicated(dataset: str, rows: DataFrame) -> DataFrame:
        # rows of one key have equal columns of their order, which a minimum leaves alone
        first = _first_counted(rows, list(CONTRACTS[dataset].primary_key))
        copies = {f"{dataset}.primary_key_unique": F.sum(F.col(_COPIES) - 1)}
        return watched.count(first, copies, _explained(dataset)).drop(_COPIES)

    def orphans(name: str, rows: DataFrame, count: Column, key: str) -> DataFrame:
        return watched.count(rows, {name: count}, lambda _, n: "ok" if not n else f"{n} órfãos em {[key]}")

    customers = deduplicated("customers", raw("customers", sources.customers)).dropna(subset=["customer_unique_id"])
    dimension = customers.select("customer_id", "customer_unique_id", "customer_state")
    orders = deduplicated("orders", cleaning.parse_timestamps(raw("orders", sources.orders)))
    orders = orders.dropna(subset=["customer_id", "order_purchase_timestamp"])
    named = orders.join(dimension.withColumn("_known", F.lit(True)), "customer_id", "left")
    named = orphans("fk_orders_customers", named, F.count_if(F.col("_known").isNull()), "customer_id")

    # one exchange by order for keys, payments and orders
    payments = deduplicated("order_payments", raw("order_payments", sources.payments).repartition("order_id"))
    payments = payments.dropna(subset=["payment_value"]).where("payment_value >= 0")
    paid = payment_per_order(payments, _ROWS)
    paid_columns = [c for c in paid.columns if c not in ("order_id", _ROWS)]
    every = named.withColumn(_ORDER, F.lit(True)).join(paid, "order_id", "full_outer")
    every = orphans("fk_payments_orders", every, F.sum(F.when(F.col(_ORDER).isNull(), F.col(_ROWS))), "order_id")
    of_order = [c for c in named.columns if c != "order_id"]
    side = every.where(F.col(_ORDER)).select("order_id", F.struct(*of_order, *paid_columns).alias(_ORDER))

    items = raw("order_items", sources.items).join(side, "order_id", "left")
    items = cleaning.with_price(deduplicated("order_items", items))
    items = orphans("fk_items_orders", items, F.count_if(F.col(_ORDER).isNull()), "order_id")
    wide = items.select("*", f"{_ORDER}.*").drop(_ORDER).where("_known")
    kept = cleaning.observation_window(wide, as_of, window_days, statuses)
    columns = feature_table.enriched_items(sources, as_of, window_days, statuses).columns
    return kept.select(*columns), watched


def _explained(dataset: str) -> Callable[[str, int], str]:
    return lambda check, n: quality.detail_text(CONTRACTS[dataset], check.removeprefix(f"{dataset}."), n)
