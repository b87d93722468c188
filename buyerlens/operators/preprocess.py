"""Model frame and its preparation: median impute, log1p, population z-score."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from buyerlens.functions.scalars import log1p_nonneg
from buyerlens.operators.quality import column_differences
from buyerlens.operators.ranking import value_ranks

# Modelling columns in order, and the skewed ones among them.
FEATURE_COLUMNS = [
    "recency_days", "frequency", "monetary", "avg_ticket", "avg_items_per_order", "customer_age_days",
]
LOG_COLUMNS = ["recency_days", "frequency", "monetary", "avg_ticket"]


def select_model_frame(features: DataFrame, columns: list[str] | None = None,
                       id_column: str | None = None) -> DataFrame:
    """Modelling columns in order as doubles, after the id when one is named."""
    names = columns or FEATURE_COLUMNS
    absent, _ = column_differences(features, names)
    if absent:
        raise KeyError(f"the model frame lacks {', '.join(absent)}")
    doubles = [F.col(name).cast("double") for name in names]
    return features.select(id_column, *doubles) if id_column else features.select(*doubles)


@dataclass(frozen=True)
class Preprocessor:
    """Fitted parameters; one value per column, so it stays small."""

    log_columns: list[str]
    linear_columns: list[str]
    medians: dict[str, float]
    means: dict[str, float]
    stds: dict[str, float]

    @property
    def inputs(self) -> list[str]:
        """Log columns first, then the linear ones: also the order of the output."""
        return [*self.log_columns, *self.linear_columns]

    @property
    def outputs(self) -> list[str]:
        return [f"z_{c}" for c in self.inputs]

    def expressions(self) -> list[Column]:
        return [
            ((_filled(c, self.medians[c], c in self.log_columns) - F.lit(self.means[c]))
             / F.lit(self.stds[c])).alias(f"z_{c}")
            for c in self.inputs
        ]

    def transform(self, df: DataFrame) -> DataFrame:
        """Add the ``z_`` columns; a missing input column is an analysis error."""
        return df.select("*", *self.expressions())


def _known(column: str) -> Column:
    """The column's number; NaN is missing, as null is."""
    return F.nanvl(F.col(column).cast("double"), F.lit(None).cast("double"))


def _filled(column: str, median: float | None, log: bool) -> Column:
    value = F.coalesce(_known(column), F.lit(median).cast("double"))
    return log1p_nonneg(value) if log else value


def _middle_ranks(n: int) -> list[int]:
    return [(n + 1) // 2, n // 2 + 1]


def column_medians(df: DataFrame, columns: list[str]) -> dict[str, float | None]:
    """Exact interpolated medians of the values that are neither null nor NaN, by distributed rank."""
    found = value_ranks(df, {c: _known(c) for c in columns}, _middle_ranks)
    return {c: sum(found[c].values()) / len(found[c]) if found[c] else None for c in columns}


def fit_preprocessor(df: DataFrame, columns: list[str] | None = None,
                     log_columns: list[str] | None = None) -> Preprocessor:
    """Medians, then mean and population deviation of the imputed, logged columns."""
    wanted = columns or FEATURE_COLUMNS
    logged = [c for c in (LOG_COLUMNS if log_columns is None else log_columns) if c in wanted]
    linear = [c for c in wanted if c not in logged]
    medians = column_medians(df, wanted)
    moments = df.agg(*[
        agg(_filled(c, medians[c], c in logged)).alias(f"{kind}_{c}")
        for c in wanted
        for kind, agg in (("mean", F.avg), ("std", F.stddev_pop), ("low", F.min), ("high", F.max))
    ]).first()
    # a constant column keeps its values: its deviation counts as one
    stds = {
        c: 1.0 if moments[f"low_{c}"] == moments[f"high_{c}"] else moments[f"std_{c}"] for c in wanted
    }
    return Preprocessor(logged, linear, medians, {c: moments[f"mean_{c}"] for c in wanted}, stds)


def statistics_frame(df: DataFrame, fitted: Preprocessor) -> DataFrame:
    """Fitted parameters as rows ``column, median, mean, std``."""
    rows = [(c, fitted.medians[c], fitted.means[c], fitted.stds[c]) for c in fitted.inputs]
    return df.sparkSession.createDataFrame(rows, "column string, median double, mean double, std double")
