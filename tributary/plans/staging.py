"""Staging models: rename, type, clean. Row by row, no exchange in any of them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tributary.functions.classify import keep_within, lookup, outside_flag
from tributary.functions.numeric import ratio, round_half_away
from tributary.functions.parsing import (
    json_fields,
    length_or_zero,
    nth,
    safe_double,
    safe_int,
    safe_timestamp,
)
from tributary.functions.temporal import (
    day_of,
    days_between,
    hour_of,
    month_of,
    week_of,
    year_number,
)

# Sensor measures as (payload field, raw column, clean column, flag
# column, lowest valid value, highest valid value).
SENSOR_MEASURES = (
    ("nivel", "nivel_raw", "nivel_m", "is_outlier_nivel", 0, 30),
    ("conductividad", "conductividad_raw", "conductividad_us_cm", "is_outlier_conductividad", 0, 2000),
    ("ph", "ph_raw", "ph", "is_outlier_ph", 4, 10),
    ("turbidez", "turbidez_raw", "turbidez_ntu", "is_outlier_turbidez", 0, 3000),
    ("od", "od_raw", "od_mg_l", "is_outlier_od", 0, 15),
    ("tempagua", "temp_raw", "temp_agua_c", "is_outlier_temp", 5, 40),
)

# Station code to display name.
STATION_NAMES = {"itabo_guazu": "Itabó Guazú", "pozuelo_puente": "Pozuelo Puente"}

# Base stats of a creature in list order.
BASE_STATS = ("hp", "attack", "defense", "special_attack", "special_defense", "speed")

# A wall-clock text may carry a zone name after its first 19 characters.
TIMESTAMP_TEXT_LENGTH = 19


def _margin() -> Column:
    return F.col("price_usd") - F.col("cogs_usd")


def _is(condition: Column) -> Column:
    """Condition as a plain boolean: unknown counts as false."""
    return F.coalesce(condition, F.lit(False))


def stg_sessions(website_sessions: DataFrame) -> DataFrame:
    start = F.col("created_at")
    return website_sessions.select(
        "website_session_id",
        "created_at",
        "user_id",
        (F.col("is_repeat_session") == 1).alias("is_repeat_session"),
        F.coalesce("utm_source", F.lit("direct")).alias("utm_source"),
        F.coalesce("utm_campaign", F.lit("none")).alias("utm_campaign"),
        "utm_content",
        "device_type",
        "http_referer",
        day_of(start).alias("session_date"),
        week_of(start).alias("session_week"),
        month_of(start).alias("session_month"),
        year_number(start).alias("session_year"),
    )


def stg_orders(orders: DataFrame) -> DataFrame:
    placed = F.col("created_at")
    share = ratio(_margin(), F.col("price_usd"))
    return orders.select(
        "order_id",
        "created_at",
        "website_session_id",
        "user_id",
        "primary_product_id",
        "items_purchased",
        "price_usd",
        "cogs_usd",
        _margin().alias("margin_usd"),
        round_half_away(share * F.lit(100.0), 2).alias("margin_pct"),
        day_of(placed).alias("order_date"),
        week_of(placed).alias("order_week"),
        month_of(placed).alias("order_month"),
        year_number(placed).alias("order_year"),
    )


def stg_pageviews(website_pageviews: DataFrame) -> DataFrame:
    return website_pageviews.select(
        "website_pageview_id",
        "created_at",
        "website_session_id",
        "pageview_url",
        day_of(F.col("created_at")).alias("pageview_date"),
    )


def stg_order_items(order_items: DataFrame) -> DataFrame:
    return order_items.select(
        "order_item_id",
        "created_at",
        "order_id",
        "product_id",
        "is_primary_item",
        "price_usd",
        "cogs_usd",
        _margin().alias("margin_usd"),
    )


def stg_refunds(order_item_refunds: DataFrame) -> DataFrame:
    return order_item_refunds.select(
        "order_item_refund_id",
        "created_at",
        "order_item_id",
        "order_id",
        "refund_amount_usd",
        day_of(F.col("created_at")).alias("refund_date"),
    )


def stg_github_issues(issues: DataFrame) -> DataFrame:
    opened, closed = F.col("created_at"), F.col("closed_at")
    is_closed = F.col("state") == "closed"
    return issues.select(
        F.col("id").alias("issue_id"),
        F.col("number").alias("issue_number"),
        "title",
        "state",
        "body",
        "created_at",
        "updated_at",
        "closed_at",
        F.col("user.login").alias("author_login"),
        F.col("user.type").alias("author_type"),
        length_or_zero(F.col("labels")).alias("label_count"),
        F.col("comments").alias("comment_count"),
        F.col("milestone.title").alias("milestone_title"),
        F.when(is_closed, days_between(opened, closed)).alias("days_to_close"),
        _is(is_closed).alias("is_closed"),
        month_of(opened).alias("created_month"),
        week_of(opened).alias("created_week"),
    )


def stg_github_pull_requests(pull_requests: DataFrame) -> DataFrame:
    opened, merged = F.col("created_at"), F.col("merged_at")
    return pull_requests.select(
        F.col("id").alias("pr_id"),
        F.col("number").alias("pr_number"),
        "title",
        "state",
        "created_at",
        "updated_at",
        "closed_at",
        "merged_at",
        F.col("user.login").alias("author_login"),
        F.col("head.ref").alias("source_branch"),
        F.col("base.ref").alias("target_branch"),
        merged.isNotNull().alias("is_merged"),
        _is((F.col("state") == "closed") & merged.isNull()).alias("is_rejected"),
        days_between(opened, merged).alias("days_to_merge"),
        month_of(opened).alias("created_month"),
        week_of(opened).alias("created_week"),
    )


def stg_pokemon(pokemon: DataFrame) -> DataFrame:
    stats = [
        safe_int(nth(F.col("stats"), place)["base_stat"]).alias(name)
        for place, name in enumerate(BASE_STATS, start=1)
    ]
    kinds = [
        nth(F.col("types"), place)["type"]["name"].cast("string").alias(name)
        for place, name in enumerate(("primary_type", "secondary_type"), start=1)
    ]
    return pokemon.select(
        F.col("id").alias("pokemon_id"),
        F.col("name").alias("pokemon_name"),
        "height",
        "weight",
        "base_experience",
        "types",
        (F.col("height").cast("double") / 10.0).alias("height_meters"),
        (F.col("weight").cast("double") / 10.0).alias("weight_kg"),
        "is_default",
        F.col("`order`").alias("pokedex_order"),
        *stats,
        *kinds,
        F.current_timestamp().alias("loaded_at"),
    )


def stg_hidro_mediciones(*stations: DataFrame) -> DataFrame:
    """Readings of all stations, one landing table per argument.

    The payload is parsed once per row, by a projection of its own before anything is
    derived from it. The timestamp is parsed twice: below, to leave rows without one out
    before their payload is parsed, and again for the rows that stay.
    """
    landing = ("station_name", "measurement_ts", "raw_payload", "extracted_at")
    readings = stations[0].select(*landing)
    for station in stations[1:]:
        readings = readings.unionByName(station.select(*landing))

    fields = [field for field, *_ in SENSOR_MEASURES]
    taken = F.col("fecha_medicion")
    parsed = readings.where(F.col("measurement_ts").isNotNull()).select(
        "station_name",
        safe_timestamp(
            F.substring("measurement_ts", 1, TIMESTAMP_TEXT_LENGTH)
        ).alias("fecha_medicion"),
        "extracted_at",
        json_fields(F.col("raw_payload"), fields),
    )
    typed = parsed.where(taken.isNotNull()).select(
        "station_name",
        "fecha_medicion",
        "extracted_at",
        *[safe_double(F.col(field)).alias(raw) for field, raw, *_ in SENSOR_MEASURES],
    )
    return typed.select(
        lookup(F.col("station_name"), STATION_NAMES, F.col("station_name")).alias("estacion"),
        F.col("station_name").alias("estacion_codigo"),
        "fecha_medicion",
        day_of(taken).alias("fecha_dia"),
        hour_of(taken).alias("fecha_hora"),
        month_of(taken).alias("fecha_mes"),
        *[raw for _, raw, *_ in SENSOR_MEASURES],
        *[
            keep_within(F.col(raw), low, high).alias(clean)
            for _, raw, clean, _, low, high in SENSOR_MEASURES
        ],
        *[
            outside_flag(F.col(raw), low, high).alias(flag)
            for _, raw, _, flag, low, high in SENSOR_MEASURES
        ],
        F.col("extracted_at").alias("cargado_en"),
    )
