"""Mart models. ``in_order=False`` leaves out the final global sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tributary.functions.classify import bands, lookup
from tributary.functions.numeric import or_zero, percent, ratio, round_half_away
from tributary.functions.temporal import month_of, weekday_from_sunday
from tributary.operators import windows
from tributary.operators.aggregates import collapse, count_where, row_count, sum_where
from tributary.operators.joins import left_join
from tributary.operators.ordering import ordered
from tributary.plans.staging import BASE_STATS, SENSOR_MEASURES

# Weekday names, Sunday first.
WEEKDAYS = ("Domingo", "Lunes", "Martes", "Miércoles", "Jueves", "Viernes", "Sábado")

# Rows, not calendar days, in the moving average of the water level.
TRAILING_ROWS = 7


# --- e-commerce -------------------------------------------------------------------


def fct_daily_sales(
    stg_sessions: DataFrame, stg_orders: DataFrame, stg_refunds: DataFrame, in_order: bool = True
) -> DataFrame:
    """One row per day with sessions.

    Each input is reduced to days first and is then already partitioned by day, so the
    two joins move nothing. A refund counts on the day it was paid.
    """
    visits = stg_sessions.groupBy(F.col("session_date").alias("date")).agg(
        row_count().alias("total_sessions"),
        F.count_distinct("user_id").alias("unique_users"),
        count_where(F.col("is_repeat_session")).alias("repeat_sessions"),
    )
    sales = stg_orders.groupBy(F.col("order_date").alias("date")).agg(
        row_count().alias("total_orders"),
        F.count_distinct("user_id").alias("unique_buyers"),
        F.sum("items_purchased").alias("items_sold"),
        F.sum("price_usd").alias("revenue"),
        F.sum("cogs_usd").alias("cogs"),
        F.sum("margin_usd").alias("margin"),
    )
    refunds = stg_refunds.groupBy(F.col("refund_date").alias("date")).agg(
        row_count().alias("total_refunds"),
        F.sum("refund_amount_usd").alias("refund_amount"),
    )
    filled = (
        "total_orders",
        "unique_buyers",
        "items_sold",
        "revenue",
        "cogs",
        "margin",
        "total_refunds",
        "refund_amount",
    )
    days = visits.join(sales, "date", "left").join(refunds, "date", "left")
    days = days.withColumns({name: or_zero(F.col(name)) for name in filled})
    report = days.select(
        "date",
        "total_sessions",
        "unique_users",
        "repeat_sessions",
        "total_orders",
        "unique_buyers",
        "items_sold",
        percent(F.col("total_orders"), F.col("total_sessions")).alias("conversion_rate_pct"),
        "revenue",
        "cogs",
        "margin",
        "total_refunds",
        "refund_amount",
        (F.col("revenue") - F.col("refund_amount")).alias("net_revenue"),
    )
    return ordered(report, "date") if in_order else report


def fct_channel_performance(
    stg_sessions: DataFrame, stg_orders: DataFrame, in_order: bool = True
) -> DataFrame:
    """Sessions and their orders per month, source, campaign and device.

    Orders are combined per session before the join. That makes them unique per
    session, so sessions can be counted after the join and are read only once. Groups
    with an unknown month or device keep their sessions and show no orders: the
    report's keys are compared with plain equality, which NULL never meets.
    """
    per_session = collapse(
        stg_orders,
        "website_session_id",
        session_orders=F.count("order_id"),
        session_revenue=F.sum("price_usd"),
        session_margin=F.sum("margin_usd"),
    )
    channel = ["session_month", "utm_source", "utm_campaign", "device_type"]
    visits = stg_sessions.select("website_session_id", "user_id", *channel)
    known = F.col("session_month").isNotNull() & F.col("device_type").isNotNull()

    def total(name: str) -> Column:
        return F.sum(F.when(known, F.col(name)))

    channels = (
        visits.join(per_session, "website_session_id", "left")
        .groupBy(*channel)
        .agg(
            row_count().alias("total_sessions"),
            F.count_distinct("user_id").alias("unique_users"),
            or_zero(total("session_orders")).alias("total_orders"),
            total("session_revenue").alias("sold"),
            or_zero(total("session_margin")).alias("margin"),
        )
    )
    base = F.coalesce(F.col("sold"), F.lit(1))
    report = channels.select(
        *channel,
        "total_sessions",
        "unique_users",
        "total_orders",
        percent(F.col("total_orders"), F.col("total_sessions")).alias("conversion_rate_pct"),
        or_zero(F.col("sold")).alias("revenue"),
        "margin",
        percent(F.col("margin"), base).alias("margin_pct"),
    )
    if not in_order:
        return report
    return ordered(report, "session_month", "-revenue", "utm_source", "utm_campaign", "device_type")


def fct_product_performance(
    stg_order_items: DataFrame, stg_refunds: DataFrame, in_order: bool = True
) -> DataFrame:
    """Sales and refunds per product and month.

    Refunds are combined per item and month, and items per id and product, before they
    meet. An id that repeats in both tables then gives one pair per month and product
    instead of one per row; the pair counts for as many rows as went into it. Few items
    are refunded, so the others are left out before items are grouped: they pass one
    exchange by id, which serves the semi-join, the grouping and the join. A refund
    belongs to the month it was paid in; months without sales are not reported.
    """
    sales = stg_order_items.groupBy(
        "product_id", month_of(F.col("created_at")).alias("order_month")
    ).agg(
        row_count().alias("units_sold"),
        F.sum("price_usd").alias("revenue"),
        F.sum("cogs_usd").alias("cogs"),
        F.sum("margin_usd").alias("margin"),
    )
    paid = stg_refunds.withColumn("order_month", month_of(F.col("created_at")))
    per_item = collapse(
        paid,
        "order_item_id",
        "order_month",
        item_refunds=row_count(),
        item_amount=F.sum("refund_amount_usd"),
    )
    refunded = stg_order_items.join(per_item, "order_item_id", "left_semi")
    sold = refunded.groupBy("order_item_id", "product_id").agg(row_count().alias("copies"))
    refunds = (
        sold.join(per_item, "order_item_id")
        .groupBy("product_id", "order_month")
        .agg(
            F.sum(F.col("item_refunds") * F.col("copies")).alias("refund_count"),
            F.sum(F.col("item_amount") * F.col("copies")).alias("refund_amount"),
        )
    )
    both = sales.join(refunds, ["product_id", "order_month"], "left").withColumns(
        {name: or_zero(F.col(name)) for name in ("refund_count", "refund_amount")}
    )
    report = both.select(
        "product_id",
        "order_month",
        "units_sold",
        "revenue",
        "cogs",
        "margin",
        percent(F.col("margin"), F.col("revenue")).alias("margin_pct"),
        "refund_count",
        "refund_amount",
        (F.col("revenue") - F.col("refund_amount")).alias("net_revenue"),
    )
    return ordered(report, "order_month", "-revenue", "product_id") if in_order else report


def obt_orders_enriched(
    stg_orders: DataFrame, stg_sessions: DataFrame, stg_refunds: DataFrame
) -> DataFrame:
    """Every order with its session and its refunds; an order repeats per match."""
    orders = stg_orders.select(
        "order_id",
        F.col("created_at").alias("order_date"),
        "order_month",
        "website_session_id",
        "user_id",
        "primary_product_id",
        "items_purchased",
        "price_usd",
        "cogs_usd",
        "margin_usd",
        "margin_pct",
    )
    visits = stg_sessions.select(
        "website_session_id",
        "utm_source",
        "utm_campaign",
        "device_type",
        "is_repeat_session",
        "http_referer",
    )
    refunds = stg_refunds.select("order_id", "order_item_refund_id", "refund_amount_usd")
    joined = left_join(orders, visits, "website_session_id")
    joined = left_join(joined, refunds, "order_id")
    amount = or_zero(F.col("refund_amount_usd"))
    return joined.select(
        *orders.columns,
        *visits.columns[1:],
        amount.alias("refund_amount"),
        F.col("order_item_refund_id").isNotNull().alias("has_refund"),
        (F.col("price_usd") - amount).alias("net_revenue"),
    )


# --- repository activity ----------------------------------------------------------


def mart_github_summary(int_github_activity: DataFrame, in_order: bool = True) -> DataFrame:
    """Both activities of a month side by side.

    Contributors are the larger of the two monthly numbers, and the days to resolve are
    the mean of the two monthly means, each already rounded.
    """
    is_issue = F.col("activity_type") == "issue"
    is_pull = F.col("activity_type") == "pull_request"
    months = int_github_activity.groupBy("activity_month").agg(
        F.sum("total_count").alias("total_activities"),
        sum_where(F.col("total_count"), is_issue).alias("total_issues"),
        sum_where(F.col("total_count"), is_pull).alias("total_prs"),
        sum_where(F.col("closed_count"), is_issue).alias("closed_issues"),
        sum_where(F.col("closed_count"), is_pull).alias("merged_prs"),
        F.max("unique_contributors").alias("unique_contributors"),
        round_half_away(F.avg("avg_days_to_resolve"), 1).alias("avg_days_to_resolve"),
    )
    report = months.select(
        "activity_month",
        "total_activities",
        "total_issues",
        "total_prs",
        "closed_issues",
        "merged_prs",
        percent(F.col("closed_issues"), F.col("total_issues")).alias("issue_close_rate_pct"),
        percent(F.col("merged_prs"), F.col("total_prs")).alias("pr_merge_rate_pct"),
        "unique_contributors",
        "avg_days_to_resolve",
    )
    return ordered(report, "activity_month") if in_order else report


# --- water sensors ----------------------------------------------------------------
# Limits and names of the classes.


def level_condition(level: Column, usual: Column) -> Column:
    """Water level against the mean of its station."""
    return bands(
        [
            (level.isNull(), "sin_datos"),
            (usual.isNull(), "sin_referencia"),
            (level >= usual * 1.20, "crecida"),
            (level >= usual * 1.05, "alto"),
            (level <= usual * 0.80, "bajante"),
            (level <= usual * 0.95, "bajo"),
        ],
        "normal",
    )


def ph_condition(ph: Column) -> Column:
    return bands([(ph.isNull(), "sin_datos"), (ph < 6.5, "acido"), (ph > 8.5, "alcalino")], "normal")


def turbidity_condition(ntu: Column) -> Column:
    return bands([(ntu.isNull(), "sin_datos"), (ntu >= 50, "muy_turbia"), (ntu >= 5, "turbia")], "clara")


def oxygen_condition(mg_l: Column) -> Column:
    return bands([(mg_l.isNull(), "sin_datos"), (mg_l < 3, "critico"), (mg_l < 5, "bajo")], "saludable")


def quality_class(outlier_pct: Column) -> Column:
    """Class of a day from its rounded outlier percentage."""
    return bands(
        [(outlier_pct == 0, "optima"), (outlier_pct < 5, "buena"), (outlier_pct < 20, "regular")], "mala"
    )


def with_station_history(int_hidro_diario: DataFrame) -> DataFrame:
    """Daily rows with the row before, the trailing mean and the station means."""
    over = windows.series("estacion", "fecha_dia", "estacion_codigo")

    def usual(name: str, digits: int) -> Column:
        return round_half_away(windows.group_mean(name, "estacion"), digits)

    trailing = windows.trailing_mean("nivel_promedio", TRAILING_ROWS, over)
    return int_hidro_diario.withColumns(
        {
            "nivel_promedio_anterior": windows.previous("nivel_promedio", over),
            "nivel_promedio_movil_7d": round_half_away(trailing, 3),
            "nivel_historico_estacion": usual("nivel_promedio", 3),
            "ph_historico_estacion": usual("ph_promedio", 2),
            "temp_historica_estacion": usual("temperatura_promedio", 2),
        }
    )


def mart_hidro_resumen(int_hidro_diario: DataFrame, in_order: bool = True) -> DataFrame:
    day, level = F.col("fecha_dia"), F.col("nivel_promedio")
    usual = F.col("nivel_historico_estacion")
    report = with_station_history(int_hidro_diario).select(
        "estacion",
        "estacion_codigo",
        "fecha_dia",
        F.year(day).alias("anio"),
        F.month(day).alias("mes"),
        F.weekofyear(day).alias("semana"),
        lookup(weekday_from_sunday(day), dict(enumerate(WEEKDAYS))).alias("dia_semana"),
        "total_mediciones",
        "nivel_promedio",
        "nivel_minimo",
        "nivel_maximo",
        "nivel_variacion",
        "nivel_promedio_movil_7d",
        "nivel_historico_estacion",
        "conductividad_promedio",
        "ph_promedio",
        "ph_historico_estacion",
        "turbidez_promedio",
        "od_promedio",
        "temperatura_promedio",
        "temp_historica_estacion",
        round_half_away(level - F.col("nivel_promedio_anterior"), 3).alias("nivel_delta_dia_anterior"),
        round_half_away(level - usual, 3).alias("nivel_desviacion_historica"),
        level_condition(level, usual).alias("condicion_nivel"),
        ph_condition(F.col("ph_promedio")).alias("condicion_ph"),
        turbidity_condition(F.col("turbidez_promedio")).alias("condicion_turbidez"),
        oxygen_condition(F.col("od_promedio")).alias("condicion_od"),
    )
    return ordered(report, "estacion", "fecha_dia", "estacion_codigo") if in_order else report


def mart_hidro_calidad(stg_hidro_mediciones: DataFrame, in_order: bool = True) -> DataFrame:
    """Discarded and valid readings per station and day.

    The rate is over all readings that could have arrived with the day's rows, absent
    ones included.
    """
    # Column stems of the outlier and valid counts follow the payload field.
    stem = {field: field for field, *_ in SENSOR_MEASURES} | {"tempagua": "temperatura"}
    discarded = {f"outliers_{stem[field]}": flag for field, _, _, flag, _, _ in SENSOR_MEASURES}
    valid = {
        f"mediciones_validas_{stem[field]}": clean for field, _, clean, *_ in SENSOR_MEASURES
    }
    days = stg_hidro_mediciones.groupBy("estacion", "estacion_codigo", "fecha_dia").agg(
        row_count().alias("total_mediciones"),
        *[F.sum(flag).alias(name) for name, flag in discarded.items()],
        *[F.count(clean).alias(name) for name, clean in valid.items()],
    )
    # A flag is never NULL, so the total over all measures is the sum of their totals.
    every_outlier = sum((F.col(name) for name in discarded), F.lit(0).cast("long"))
    possible = F.col("total_mediciones") * len(SENSOR_MEASURES)
    rated = days.withColumn("outliers_totales", every_outlier).withColumn(
        "tasa_outliers_pct", percent(F.col("outliers_totales"), possible)
    )
    report = rated.select(
        "estacion",
        "estacion_codigo",
        "fecha_dia",
        "total_mediciones",
        *discarded,
        "outliers_totales",
        "tasa_outliers_pct",
        *valid,
        quality_class(F.col("tasa_outliers_pct")).alias("nivel_calidad"),
    )
    return ordered(report, "estacion", "fecha_dia", "estacion_codigo") if in_order else report


# --- creature catalogue -----------------------------------------------------------
# Limits and names of the classes.


def power_tier(total: Column) -> Column:
    """An unknown total falls through to the last class."""
    return bands(
        [(total >= 600, "legendary_tier"), (total >= 500, "strong"), (total >= 400, "average")], "weak"
    )


def attack_style(attack: Column, special: Column) -> Column:
    return bands(
        [(attack > special, "physical_attacker"), (special > attack, "special_attacker")], "balanced"
    )


def mart_pokemon_analytics(stg_pokemon: DataFrame, in_order: bool = True) -> DataFrame:
    stat = {name: F.col(name) for name in BASE_STATS}
    total = sum((stat[name] for name in BASE_STATS[1:]), stat[BASE_STATS[0]])
    height = F.col("height_meters")
    report = stg_pokemon.select(
        "pokemon_id",
        "pokemon_name",
        "primary_type",
        F.coalesce("secondary_type", F.lit("none")).alias("secondary_type"),
        "height_meters",
        "weight_kg",
        "base_experience",
        *BASE_STATS,
        "pokedex_order",
        "is_default",
        total.alias("total_base_stats"),
        round_half_away(ratio(F.col("weight_kg"), height * height), 2).alias("bmi_index"),
        (stat["attack"] + stat["special_attack"]).alias("total_attack_power"),
        (stat["defense"] + stat["special_defense"]).alias("total_defense_power"),
        power_tier(total).alias("power_tier"),
        attack_style(stat["attack"], stat["special_attack"]).alias("attack_style"),
    )
    if not in_order:
        return report
    # Totals repeat often and re-synced rows are equal throughout; the row number in the
    # scan keeps a frequent total, or one row's many copies, from filling one sort task.
    numbered = report.withColumn("_row", F.monotonically_increasing_id())
    return ordered(numbered, "-total_base_stats", "pokemon_id", "_row").drop("_row")
