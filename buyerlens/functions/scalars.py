"""Column expressions shared by the operators. Everything stays in codegen."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000

# Amounts are summed as whole ten-thousandths: exact, independent of row order
# and cheaper than a wide decimal.
MONEY_SCALE = 10_000

# Texts that count as missing in a string column.
NULLISH_TEXTS = ["", "nan", "None", "NaT"]

# Weights and defaults of the composite trial score.
SCORE_WEIGHTS = {"silhouette": 0.45, "davies_bouldin_inv": 0.20, "stability_ari": 0.35}

# Segment names with their descriptions.
SEGMENT_DESCRIPTIONS = {
    "champions": "Recentes, compram com frequência e alto valor",
    "loyal_customers": "Frequência alta e valor acima da média",
    "big_spenders": "Ticket/valor alto com pouca recorrência",
    "new_customers": "Compra recente, ainda pouca história",
    "at_risk": "Já foram ativos, recência ruim",
    "hibernating": "Inativos, baixa frequência e baixo valor",
    "need_attention": "Perfil intermediário — campanha de reativação leve",
}


def as_date(value: str | date | datetime) -> date:
    """Normalise an as-of argument; text may carry a time part."""
    if isinstance(value, datetime):
        return value.date()
    if isinstance(value, date):
        return value
    return date.fromisoformat(value[:10])


def default_as_of(interval_end: Column) -> Column:
    """Last full day of a scheduling interval."""
    return F.date_sub(F.to_date(interval_end), 1)


def iso_date(column: Column) -> Column:
    """Ten-character ISO text of a date, timestamp or text column."""
    return F.substring(column.cast("string"), 1, 10)


def midnight(as_of: str | date | datetime) -> Column:
    return F.lit(as_date(as_of).isoformat()).cast("timestamp")


def _floor_days(later: Column, earlier: Column) -> Column:
    micros = F.unix_micros(later.cast("timestamp")) - F.unix_micros(earlier.cast("timestamp"))
    return F.floor(micros / F.lit(DAY_MICROS)).cast("int")


def elapsed_days_floor(as_of: str | date | datetime, ts: Column) -> Column:
    """Whole days from ``ts`` to as-of midnight, rounded toward minus infinity."""
    return _floor_days(midnight(as_of), ts)


def age_days(first: Column, last: Column) -> Column:
    return F.coalesce(_floor_days(last, first), F.lit(0))


def avg_days_between(age: Column, frequency: Column) -> Column:
    return F.when(frequency > 1, age / (frequency - 1))


def rfm_score(r: Column, f: Column, m: Column) -> Column:
    return F.concat(r.cast("string"), f.cast("string"), m.cast("string"))


def month_key(ts_text: Column) -> Column:
    """``yyyy-MM`` of a timestamp text, null when the text is too short."""
    return F.when(F.length(ts_text) >= 7, F.substring(ts_text, 1, 7))


def nullish(name: str, data_type: str) -> Column:
    """Missing value test; texts such as ``nan`` count only in string columns."""
    column = F.col(name)
    if data_type == "string":
        return column.isNull() | F.trim(column).isin(NULLISH_TEXTS)
    if data_type in ("double", "float"):
        return column.isNull() | F.isnan(column)
    return column.isNull()


def log1p_nonneg(column: Column) -> Column:
    return F.log1p(F.when(column < 0, F.lit(0.0)).otherwise(column))


def is_finite(column: Column) -> Column:
    value = column.cast("double")
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) != F.lit(float("inf")))


def finite_or(column: Column, default: float) -> Column:
    return F.when(is_finite(column), column.cast("double")).otherwise(F.lit(float(default)))


def composite_score(silhouette: Column, davies_bouldin: Column, ari: Column,
                    weights: dict[str, float] | None = None) -> Column:
    w = weights or SCORE_WEIGHTS
    spread = F.greatest(finite_or(davies_bouldin, 1.0), F.lit(0.0))
    return (
        F.lit(w["silhouette"]) * finite_or(silhouette, 0.0)
        + F.lit(w["davies_bouldin_inv"]) / (F.lit(1.0) + spread)
        + F.lit(w["stability_ari"]) * finite_or(ari, 0.0)
    )


def segment_label(r: Column, f: Column, m: Column) -> Column:
    """Business name of a cluster from its z-scores; ``r`` grows with recency of purchase.

    The thresholds are fixed values and the first matching rule wins."""
    return (
        F.when((r > 0.25) & (f > 0.25) & (m > 0.25), "champions")
        .when((f > 0.35) & (m > 0), "loyal_customers")
        .when((m > 0.45) & (f <= 0.1), "big_spenders")
        .when((r > 0.35) & (f < 0) & (m < 0.35), "new_customers")
        .when((r < -0.25) & (f > 0), "at_risk")
        .when((r < -0.25) & (f <= 0) & (m <= 0), "hibernating")
        .otherwise("need_attention")
    )


def label_description(base_label: Column) -> Column:
    described = F.lit(None).cast("string")
    for name, text in SEGMENT_DESCRIPTIONS.items():
        described = F.when(base_label == name, text).otherwise(described)
    return described


def run_name(algorithm: Column, n_clusters: Column, params: Column) -> Column:
    """``algorithm_k4_key=value``; ``params`` is a map without the cluster count."""
    extra = F.transform(F.map_entries(params), lambda e: F.concat(e["key"], F.lit("="), e["value"]))
    return F.concat_ws("_", algorithm, F.concat(F.lit("k"), n_clusters.cast("string")), extra)


def money_sum(column: Column) -> Column:
    """Exact sum in ten-thousandths, zero when every value is null or NaN."""
    known = F.nanvl(column.cast("double"), F.lit(None).cast("double"))
    return F.coalesce(F.sum(F.round(known * MONEY_SCALE).cast("bigint")), F.lit(0).cast("bigint"))


def money(units: Column) -> Column:
    return units / F.lit(float(MONEY_SCALE))


# number of positions an identifier can hash to
HASH_POSITIONS = 2**52


def hash_position(identifier: Column, seed: int) -> Column:
    """A reproducible pseudo-random position below 2**52 for an identifier."""
    digest = F.md5(F.concat(F.lit(f"{seed}|"), identifier.cast("string")))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint")
