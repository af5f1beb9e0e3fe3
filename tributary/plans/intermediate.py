"""Intermediate models: monthly activity and daily station readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tributary.functions.numeric import percent, round_half_away
from tributary.operators.aggregates import count_where, row_count
from tributary.operators.ordering import ordered

# Daily statistics as (clean column, output stem, digits, endings of the
# mean, minimum and maximum).
DAILY_MEASURES = (
    ("nivel_m", "nivel", 3, ("promedio", "minimo", "maximo")),
    ("conductividad_us_cm", "conductividad", 3, ("promedio", "minima", "maxima")),
    ("ph", "ph", 2, ("promedio", "minimo", "maximo")),
    ("turbidez_ntu", "turbidez", 2, ("promedio", "minima", "maxima")),
    ("od_mg_l", "od", 3, ("promedio", "minimo", "maximo")),
    ("temp_agua_c", "temperatura", 2, ("promedio", "minima", "maxima")),
)


def _monthly(rows: DataFrame, activity: str, resolved: str, days: str) -> DataFrame:
    """Counts of one activity per month, in the column order of the report."""
    per_month = rows.groupBy(F.col("created_month").alias("activity_month")).agg(
        row_count().alias("total_count"),
        count_where(F.col(resolved)).alias("closed_count"),
        F.avg(days).alias("mean_days"),
        F.count_distinct("author_login").alias("unique_contributors"),
    )
    return per_month.select(
        "activity_month",
        F.lit(activity).alias("activity_type"),
        "total_count",
        "closed_count",
        percent(F.col("closed_count"), F.col("total_count")).alias("close_rate_pct"),
        round_half_away(F.col("mean_days"), 1).alias("avg_days_to_resolve"),
        "unique_contributors",
    )


def int_github_activity(
    stg_github_issues: DataFrame, stg_github_pull_requests: DataFrame, in_order: bool = True
) -> DataFrame:
    issues = _monthly(stg_github_issues, "issue", "is_closed", "days_to_close")
    pulls = _monthly(stg_github_pull_requests, "pull_request", "is_merged", "days_to_merge")
    activity = issues.unionByName(pulls)
    return ordered(activity, "activity_month", "activity_type") if in_order else activity


def int_hidro_diario(stg_hidro_mediciones: DataFrame) -> DataFrame:
    figures = [row_count().alias("total_mediciones")]
    for clean, stem, digits, (mean, low, high) in DAILY_MEASURES:
        figures += [
            round_half_away(F.avg(clean), digits).alias(f"{stem}_{mean}"),
            round_half_away(F.min(clean), digits).alias(f"{stem}_{low}"),
            round_half_away(F.max(clean), digits).alias(f"{stem}_{high}"),
        ]
        if stem == "nivel":
            spread = F.max(clean) - F.min(clean)
            figures.append(round_half_away(spread, digits).alias("nivel_variacion"))
    return stg_hidro_mediciones.groupBy("estacion", "estacion_codigo", "fecha_dia").agg(*figures)
