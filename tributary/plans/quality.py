"""The checks of every model, their run and their summary."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, functions as F

from tributary.operators.checks import Check, outcomes

WARN = "warn"

# Kinds a creature may have, accepted states, devices and stations.
CREATURE_KINDS = (
    "normal", "fire", "water", "grass", "electric", "ice", "fighting", "poison", "ground",
    "flying", "psychic", "bug", "rock", "ghost", "dragon", "dark", "steel", "fairy",
    "stellar", "unknown",
)
STATES = ("open", "closed")
DEVICES = ("mobile", "desktop")
STATIONS = ("Itabó Guazú", "Pozuelo Puente")

# Rules, limits and severities.
CHECKS = (
    Check("stg_pokemon", "unique", "pokemon_id", WARN),
    Check("stg_pokemon", "not_null", "pokemon_id"),
    Check("stg_pokemon", "not_null", "pokemon_name"),
    Check("stg_pokemon", "between", "height_meters", low=0, high=100),
    Check("stg_pokemon", "between", "weight_kg", low=0, high=10_000),
    Check("stg_pokemon", "not_null", "primary_type", WARN),
    Check("stg_pokemon", "accepted_values", "primary_type", WARN, values=CREATURE_KINDS),
    Check("stg_github_issues", "unique", "issue_id"),
    Check("stg_github_issues", "not_null", "issue_id"),
    Check("stg_github_issues", "not_null", "state"),
    Check("stg_github_issues", "accepted_values", "state", values=STATES),
    Check("stg_github_issues", "not_null", "created_at"),
    Check("stg_github_pull_requests", "unique", "pr_id"),
    Check("stg_github_pull_requests", "not_null", "pr_id"),
    Check("stg_github_pull_requests", "accepted_values", "state", values=STATES),
    Check("stg_sessions", "unique", "website_session_id"),
    Check("stg_sessions", "not_null", "website_session_id"),
    Check("stg_sessions", "not_null", "utm_source"),
    Check("stg_sessions", "accepted_values", "device_type", values=DEVICES),
    Check("stg_orders", "unique", "order_id"),
    Check("stg_orders", "not_null", "order_id"),
    Check("stg_orders", "not_null", "price_usd"),
    Check("stg_orders", "between", "price_usd", low=0, high=10_000),
    Check("stg_order_items", "unique", "order_item_id"),
    Check("stg_order_items", "not_null", "order_item_id"),
    Check("stg_pageviews", "unique", "website_pageview_id"),
    Check("stg_pageviews", "not_null", "website_pageview_id"),
    Check("stg_refunds", "unique", "order_item_refund_id"),
    Check("stg_refunds", "not_null", "order_item_refund_id"),
    Check("stg_hidro_mediciones", "row_count", low=1_000, high=1_000_000),
    Check("stg_hidro_mediciones", "not_null", "estacion"),
    Check("stg_hidro_mediciones", "accepted_values", "estacion", values=STATIONS),
    Check("stg_hidro_mediciones", "not_null", "estacion_codigo"),
    Check("stg_hidro_mediciones", "not_null", "fecha_medicion"),
    Check("stg_hidro_mediciones", "between", "nivel_m", low=0, high=50,
          row_condition="nivel_m is not null"),
    Check("stg_hidro_mediciones", "between", "conductividad_us_cm", WARN, low=0, high=5_000,
          row_condition="conductividad_us_cm is not null"),
    Check("stg_hidro_mediciones", "between", "ph", WARN, low=0, high=14,
          row_condition="ph is not null"),
    Check("stg_hidro_mediciones", "between", "turbidez_ntu", WARN, low=0, high=5_000,
          row_condition="turbidez_ntu is not null"),
    Check("stg_hidro_mediciones", "between", "od_mg_l", WARN, low=0, high=20,
          row_condition="od_mg_l is not null"),
    Check("stg_hidro_mediciones", "between", "temp_agua_c", low=0, high=50,
          row_condition="temp_agua_c is not null"),
    Check("mart_pokemon_analytics", "unique", "pokemon_id", WARN),
    Check("mart_pokemon_analytics", "not_null", "pokemon_id"),
    Check("mart_pokemon_analytics", "not_null", "total_base_stats", WARN),
    Check("mart_pokemon_analytics", "between", "total_base_stats", low=0, high=1_200),
    Check("mart_pokemon_analytics", "accepted_values", "power_tier", WARN,
          values=("legendary_tier", "strong", "average", "weak")),
    Check("mart_pokemon_analytics", "not_null", "primary_type", WARN),
    Check("mart_github_summary", "not_null", "activity_month"),
    Check("mart_github_summary", "between", "total_activities", low=0, high=100_000),
    Check("fct_daily_sales", "unique", "date"),
    Check("fct_daily_sales", "not_null", "date"),
    Check("fct_daily_sales", "between", "conversion_rate_pct", low=0, high=100),
    Check("fct_channel_performance", "not_null", "session_month"),
    Check("fct_channel_performance", "not_null", "utm_source"),
    Check("fct_product_performance", "not_null", "product_id"),
    Check("fct_product_performance", "between", "margin_pct", low=-100, high=100),
    Check("mart_hidro_calidad", "not_null", "estacion"),
    Check("mart_hidro_calidad", "not_null", "fecha_dia"),
    Check("mart_hidro_calidad", "between", "tasa_outliers_pct", low=0, high=100,
          row_condition="tasa_outliers_pct is not null"),
    Check("mart_hidro_calidad", "accepted_values", "nivel_calidad",
          values=("optima", "buena", "regular", "mala")),
    Check("mart_hidro_resumen", "not_null", "estacion"),
    Check("mart_hidro_resumen", "accepted_values", "estacion", values=STATIONS),
    Check("mart_hidro_resumen", "not_null", "fecha_dia"),
    Check("mart_hidro_resumen", "accepted_values", "condicion_nivel",
          values=("crecida", "alto", "normal", "bajo", "bajante", "sin_datos", "sin_referencia")),
    Check("mart_hidro_resumen", "accepted_values", "condicion_ph",
          values=("acido", "normal", "alcalino", "sin_datos")),
    Check("mart_hidro_resumen", "accepted_values", "condicion_turbidez",
          values=("clara", "turbia", "muy_turbia", "sin_datos")),
    Check("mart_hidro_resumen", "accepted_values", "condicion_od",
          values=("saludable", "bajo", "critico", "sin_datos")),
    Check("obt_orders_enriched", "unique", "order_id", WARN),
    Check("obt_orders_enriched", "not_null", "order_id"),
    Check("obt_orders_enriched", "between", "price_usd", low=0, high=10_000),
    Check("stg_hidro_mediciones", "not_in_future", "fecha_medicion"),
    Check("stg_orders", "at_least", "margin_usd", low=-5),
    Check("mart_pokemon_analytics", "no_duplicates", "pokemon_name", WARN),
)


class ChecksFailed(Exception):
    """A check of severity ``error`` found failures.

    ``outcomes`` holds all the rows of the run, those of stations and of other checks too.
    """

    def __init__(self, names: list[str], outcomes: list):
        super().__init__(", ".join(names))
        self.outcomes = outcomes


def run_checks(
    table: Callable[[str], DataFrame], names: Iterable[str] | None = None
) -> DataFrame:
    """Outcome of every check of the chosen models, one scan per model."""
    chosen = None if names is None else set(names)
    checks = [check for check in CHECKS if chosen is None or check.table in chosen]
    if not checks:
        raise ValueError("none of the chosen models has a check")
    tables = {name: table(name) for name in dict.fromkeys(check.table for check in checks)}
    return outcomes(tables, checks)


def summarize(results: DataFrame) -> DataFrame:
    """Number of checks per outcome."""
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("checks"))


def enforce(results: DataFrame, before: list | None = None) -> list:
    """Outcomes as rows, at most one per check; raise if an ``error`` check failed.

    ``before`` are outcomes of earlier steps, which the error carries as well.
    """
    rows = results.collect()
    failed = sorted(row["check"] for row in rows if row["status"] == "error")
    if failed:
        raise ChecksFailed(failed, [*(before or []), *rows])
    return rows


def totals(outcomes: list) -> str:
    """The number of checks per outcome in one line, as in ``PASS 60, WARN 3, ERROR 1``."""
    statuses = [row["status"] for row in outcomes if "check" in row]
    return ", ".join(f"{s.upper()} {statuses.count(s)}" for s in ("pass", "warn", "error"))
