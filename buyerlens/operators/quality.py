"""Data-quality operators. Every report is a DataFrame
``check, passed, severity, violations, detail``."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from buyerlens.contracts import CUSTOMER_FEATURES, Check, Contract
from buyerlens.functions.scalars import nullish

REPORT_SCHEMA = "check string, passed boolean, severity string, violations bigint, detail string"
SAMPLE_VALUES = 5

# Ranges of a feature table by check: column, least value, text of a violation.
FEATURE_RANGES = {
    "frequency_positive": ("frequency", 1, " clientes com frequency < 1"),
    "recency_non_negative": ("recency_days", 0, " recency negativas"),
    "monetary_non_negative": ("monetary", 0, " monetary negativas"),
}


def _union(reports: Iterable[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, reports)


def _rows(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, REPORT_SCHEMA)


def column_differences(df: DataFrame, expected: list[str]) -> tuple[list[str], list[str]]:
    """(missing, extra) column names against an expected list."""
    return [c for c in expected if c not in df.columns], [c for c in df.columns if c not in expected]


def schema_columns(df: DataFrame, contract: Contract) -> DataFrame:
    missing, _ = column_differences(df, contract.columns)
    detail = f"colunas ausentes: {missing}" if missing else "ok"
    return _rows(df.sparkSession, [("schema_columns", not missing, "error", len(missing), detail)])


def _not_null_columns(df: DataFrame, contract: Contract) -> list[str]:
    return [f.name for f in contract.fields if not f.nullable and f.name in df.columns]


def _violation_counts(df: DataFrame, contract: Contract) -> dict[str, Column]:
    """One count per declared null and allowed-value rule."""
    types = dict(df.dtypes)
    counts = {
        f"not_null:{c}": F.count_if(nullish(c, types[c])) for c in _not_null_columns(df, contract)
    }
    for f in contract.fields:
        if f.allowed and f.name in df.columns:
            counts[f"allowed_values:{f.name}"] = F.count_if(_disallowed(f.name, f.allowed))
    return counts


def row_counters(df: DataFrame, contract: Contract) -> dict[str, Column]:
    """Violations of all rules that a single pass counts: nulls, values and, if declared, some row at all.

    A contract column that the table lacks is a violation of its schema."""
    missing, _ = column_differences(df, contract.columns)
    counts = {"schema_columns": F.max(F.lit(len(missing)))} | _violation_counts(df, contract)
    if any(c.name == "row_count_min" for c in contract.checks):
        counts["row_count_min"] = F.when(F.count(F.lit(1)) >= 1, 0).otherwise(1)
    return counts


def _disallowed(column: str, allowed: tuple[str, ...]) -> Column:
    return F.col(column).isNotNull() & ~F.col(column).isin(list(allowed))


def _counted(df: DataFrame, counts: dict[str, Column], key: tuple[str, ...] = ()) -> DataFrame:
    """(check, violations) rows: all ``counts`` in one aggregate, and repeated keys.

    The counters need no shuffle. The key check shuffles nothing but the key
    columns, one row per key and task, so it stays apart."""
    parts = []
    if counts:
        names = {f"c{i}": label for i, label in enumerate(counts)}
        one_row = df.agg(*[v.alias(n) for n, v in zip(names, counts.values())])
        pairs = F.array(*[
            F.struct(F.lit(label).alias("check"), F.col(column).cast("bigint").alias("violations"))
            for column, label in names.items()
        ])
        parts.append(one_row.select(F.explode(pairs).alias("p")).select("p.check", "p.violations"))
    if key:
        # grouping puts null keys together: they equal each other
        repeated = df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).agg(
            F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint").alias("violations")
        )
        parts.append(repeated.select(F.lit("primary_key_unique").alias("check"), "violations"))
    return _union(parts)


def invalid_samples(df: DataFrame, contract: Contract) -> DataFrame:
    """Up to five distinct invalid values per categorical column, smallest first."""
    def sampled(name: str, allowed: tuple[str, ...]) -> DataFrame:
        return (
            df.where(_disallowed(name, allowed))
            .select(F.col(name).cast("string").alias("value")).distinct()
            .orderBy("value").limit(SAMPLE_VALUES)
            .agg(F.array_sort(F.collect_list("value")).alias("sample"))
            .select(F.lit(f"allowed_values:{name}").alias("check"), "sample")
        )
    return _union([sampled(f.name, f.allowed) for f in contract.fields
                   if f.allowed and f.name in df.columns])


def count_violations(df: DataFrame, contract: Contract, rules: str = "all") -> DataFrame:
    """(check, violations) for nulls, allowed values, row count and primary key.

    ``rules`` picks ``nulls``, ``values``, ``key`` or ``all``."""
    counts = _violation_counts(df, contract)
    if rules == "nulls":
        counts = {k: v for k, v in counts.items() if k.startswith("not_null")}
    elif rules == "values":
        counts = {k: v for k, v in counts.items() if k.startswith("allowed")}
    elif rules == "key":
        counts = {}
    key: tuple[str, ...] = ()
    if rules in ("all", "key") and all(c in df.columns for c in contract.primary_key):
        key = contract.primary_key
    if rules == "all":
        counts["row_count"] = F.count(F.lit(1))
    return _counted(df, counts, key)


def detail_text(contract: Contract, check: str, n: int) -> str:
    """The detail of a counted check, as the reports spell it."""
    if not n:
        return "ok"
    kind, _, column = check.partition(":")
    if kind == "not_null":
        return f"{n} nulos em {column}"
    if kind == "primary_key_unique":
        return f"{n} duplicatas em PK {list(contract.primary_key)}"
    return f"{n}{FEATURE_RANGES[check][2]}" if check in FEATURE_RANGES else str(n)


def _detail(contract: Contract) -> Column:
    check, n = F.col("check"), F.col("violations").cast("string")
    column = F.element_at(F.split(check, ":"), -1)
    return (
        F.when(F.col("violations") == 0, "ok")
        .when(check.startswith("not_null"), F.concat(n, F.lit(" nulos em "), column))
        .when(check == "primary_key_unique",
              F.concat(n, F.lit(f" duplicatas em PK {list(contract.primary_key)}")))
        .otherwise(n)
    )


def validate(df: DataFrame, contract: Contract) -> DataFrame:
    """Report of all checks of a contract: schema, nulls, key, values and row count."""
    spark = df.sparkSession
    report = [schema_columns(df, contract)]
    if not all(c in df.columns for c in contract.primary_key):
        detail = f"PK incompleta no dataframe: {list(contract.primary_key)}"
        report.append(_rows(spark, [("primary_key", False, "error", 1, detail)]))
    empty = F.lit(None).cast("array<string>").alias("sample")
    facts = count_violations(df, contract).select("check", "violations", empty)
    if any(f.allowed and f.name in df.columns for f in contract.fields):
        samples = invalid_samples(df, contract)
        facts = facts.unionByName(
            samples.select("check", F.lit(None).cast("bigint").alias("violations"), "sample")
        ).groupBy("check").agg(F.max("violations").alias("violations"), F.max("sample").alias("sample"))
    declared = next((c for c in contract.checks if c.name == "row_count_min"), None)
    if not declared:
        facts = facts.where("check <> 'row_count'")
    rows = F.col("check") == "row_count"
    n = F.col("violations").cast("string")
    sample = F.concat(F.lit("["), F.array_join("sample", ", "), F.lit("]"))
    detail = (
        F.when(rows, F.concat(F.lit("rows="), n))
        .when(F.col("check").startswith("allowed_values") & (F.col("violations") > 0),
              F.concat(n, F.lit(" inválidos; amostra="), sample))
        .otherwise(_detail(contract))
    )
    found = F.when(rows, F.when(F.col("violations") >= 1, 0).otherwise(1)).otherwise(F.col("violations"))
    report.append(facts.select(
        F.when(rows, "row_count_min").otherwise(F.col("check")).alias("check"), (found == 0).alias("passed"),
        F.when(rows, declared.severity if declared else "error").otherwise("error").alias("severity"),
        found.cast("bigint").alias("violations"), detail.alias("detail"),
    ))
    return _union(report)


def feature_counters(features: DataFrame) -> dict[str, Column]:
    """One count per null and range rule of a feature table."""
    types = dict(features.dtypes)
    counts = {f"not_null:{c}": F.count_if(nullish(c, types[c])) for c in _not_null_columns(features, CUSTOMER_FEATURES)}
    return counts | {
        name: F.count_if(F.col(column) < least) for name, (column, least, _) in FEATURE_RANGES.items() if column in features.columns}


def validate_features(features: DataFrame) -> DataFrame:
    """Report on a feature table: schema, nulls, key and the three value ranges."""
    contract = CUSTOMER_FEATURES
    present = {k: v for k, v in FEATURE_RANGES.items() if v[0] in features.columns}
    counts = feature_counters(features)
    complete = all(c in features.columns for c in contract.primary_key)
    counted = _counted(features, counts, contract.primary_key if complete else ())
    detail = _detail(contract)
    for name, (_, _, text) in present.items():
        detail = F.when(
            (F.col("check") == name) & (F.col("violations") > 0),
            F.concat(F.col("violations").cast("string"), F.lit(text)),
        ).otherwise(detail)
    return schema_columns(features, contract).unionByName(
        counted.select("check", (F.col("violations") == 0).alias("passed"),
                       F.lit("error").alias("severity"), "violations", detail.alias("detail"))
    )


def referential_integrity(child: DataFrame, parent: DataFrame, columns: list[str],
                          parent_columns: list[str], name: str) -> DataFrame:
    """One check row with the number of child rows without a parent.

    A null key matches a null key. The child is counted per key first, so a key
    shared by very many rows is one row in the join."""
    spark = child.sparkSession
    missing_child, _ = column_differences(child, columns)
    missing_parent, _ = column_differences(parent, parent_columns)
    if missing_child:
        return _rows(spark, [(name, False, "error", 1, f"FK ausente no filho: {columns}")])
    if missing_parent:
        return _rows(spark, [(name, False, "error", 1, f"PK ausente no pai: {parent_columns}")])
    keys = child.groupBy(*[F.col(c).alias(f"k{i}") for i, c in enumerate(columns)]).count()
    known = parent.select(*[F.col(c).alias(f"p{i}") for i, c in enumerate(parent_columns)])
    same = reduce(Column.__and__, [F.col(f"k{i}").eqNullSafe(F.col(f"p{i}")) for i in range(len(columns))])
    orphans = keys.join(known, same, "left_anti").agg(
        F.coalesce(F.sum("count"), F.lit(0)).cast("bigint").alias("violations")
    )
    return orphans.select(
        F.lit(name).alias("check"), (F.col("violations") == 0).alias("passed"),
        F.lit("error").alias("severity"), "violations",
        F.when(F.col("violations") == 0, "ok").otherwise(
            F.concat(F.col("violations").cast("string"), F.lit(f" órfãos em {columns}"))
        ).alias("detail"),
    )


def foreign_key_chain(orders: DataFrame, customers: DataFrame, items: DataFrame,
                      payments: DataFrame) -> DataFrame:
    """The three foreign keys of the retail tables, checked on unfiltered tables."""
    return _union([
        referential_integrity(orders, customers, ["customer_id"], ["customer_id"], "fk_orders_customers"),
        referential_integrity(items, orders, ["order_id"], ["order_id"], "fk_items_orders"),
        referential_integrity(payments, orders, ["order_id"], ["order_id"], "fk_payments_orders"),
    ])


def contract_expressions(df: DataFrame, contract: Contract, now: str = "current_timestamp()") -> DataFrame:
    """Evaluate the declared checks of a contract: ``check, severity, measure, passed``.

    ``now`` is a SQL expression. Plain checks share one aggregate."""
    plain = [c for c in contract.checks if c.per is None]
    reports = [_evaluated(df.agg(*[
        F.expr(f"CAST({c.measure.format(now=now)} AS DOUBLE)").alias(f"m{i}") for i, c in enumerate(plain)
    ]), plain)] if plain else []
    for check in contract.checks:
        if check.per is not None:
            smallest = (
                df.groupBy(check.per).agg(F.expr(f"CAST({check.measure} AS DOUBLE)").alias("m"))
                .agg(F.min("m").alias("m0"))
            )
            reports.append(_evaluated(smallest, [check]))
    return _union(reports)


def _evaluated(one_row: DataFrame, checks: list[Check]) -> DataFrame:
    entries = F.array(*[
        F.struct(
            F.lit(c.name).alias("check"), F.lit(c.severity).alias("severity"),
            F.col(f"m{i}").alias("measure"),
            F.coalesce(F.expr(f"m{i} {c.condition}"), F.lit(False)).alias("passed"),
        )
        for i, c in enumerate(checks)
    ])
    return one_row.select(F.explode(entries).alias("e")).select("e.*")


def report_passed(report: DataFrame) -> DataFrame:
    """One row: whether no failing check has severity ``error``."""
    failing = ~F.col("passed") & (F.col("severity") == "error")
    return report.agg((F.count_if(failing) == 0).alias("passed"))


def assert_valid(report: DataFrame, dataset: str) -> None:
    """Raise when a report has failing error checks. Reports have a row per check."""
    failed = report.where("NOT passed AND severity = 'error'").collect()
    if failed:
        details = "; ".join(f"{r['check']}: {r['detail']}" for r in failed)
        raise ValueError(f"Validação falhou para {dataset}: {details}")


def reconcile_counts(frames: dict[str, DataFrame]) -> DataFrame:
    """Row count per frame and whether all agree: ``stage, n, reconciled``."""
    counts = _union([
        f.agg(F.count(F.lit(1)).alias("n")).select(F.lit(stage).alias("stage"), "n")
        for stage, f in frames.items()
    ])
    # one row per stage: the window spans a handful of rows
    over_all = Window.partitionBy(F.lit(1))
    return counts.withColumn("reconciled", F.min("n").over(over_all) == F.max("n").over(over_all))
