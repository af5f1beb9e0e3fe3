"""Staging rules on hand-written rows."""

import math
from decimal import Decimal

from conftest import ts, values

from tributary.plans.staging import (
    stg_github_issues,
    stg_github_pull_requests,
    stg_hidro_mediciones,
    stg_orders,
    stg_pokemon,
    stg_sessions,
)

LANDING = "station_name string, measurement_ts string, raw_payload string, extracted_at timestamp_ntz"
LOADED = ts("2024-06-01 00:00:00")


def landing(spark, *rows, station="itabo_guazu"):
    return spark.createDataFrame([(station, *row, LOADED) for row in rows], LANDING)


def test_sessions_defaults_and_unknown_repeat(spark):
    raw = spark.createDataFrame(
        [
            (1, ts("2024-02-29 13:45:00"), 7, 1, None, None, None, None, None),
            (2, ts("2024-01-01 00:00:00"), 8, None, "ads", "spring", "c", "mobile", "http://x"),
        ],
        "website_session_id long, created_at timestamp_ntz, user_id long, is_repeat_session int, "
        "utm_source string, utm_campaign string, utm_content string, device_type string, "
        "http_referer string",
    )
    first, second = stg_sessions(raw).orderBy("website_session_id").collect()
    assert (first.utm_source, first.utm_campaign, first.device_type) == ("direct", "none", None)
    assert (first.is_repeat_session, second.is_repeat_session) == (True, None)
    assert first.session_week == ts("2024-02-26") and first.session_month == ts("2024-02-01")
    assert first.session_year == 2024 and second.utm_content == "c"


def test_order_margin_of_price_zero(spark):
    raw = spark.createDataFrame(
        [
            (1, ts("2024-01-01"), 1, 1, 1, 1, Decimal("30.00"), Decimal("20.00")),
            (2, ts("2024-01-01"), 1, 1, 1, 1, Decimal("0.00"), Decimal("7.00")),
        ],
        "order_id long, created_at timestamp_ntz, website_session_id long, user_id long, "
        "primary_product_id long, items_purchased int, price_usd decimal(18,2), "
        "cogs_usd decimal(18,2)",
    )
    got = values(stg_orders(raw), "margin_usd", "margin_pct")
    assert got == [(Decimal("-7.00"), None), (Decimal("10.00"), 33.33)]


def test_readings_are_cleaned_and_flagged(spark):
    payload = '{"nivel": 30, "conductividad": 2000.1, "ph": 3.9, "turbidez": "x", "od": null}'
    row = stg_hidro_mediciones(landing(spark, ("2024-01-02 03:04:05 PYST", payload))).first()
    assert row.estacion == "Itabó Guazú" and row.estacion_codigo == "itabo_guazu"
    assert row.fecha_medicion == ts("2024-01-02 03:04:05")
    assert row.fecha_hora == ts("2024-01-02 03:00:00")
    assert (row.nivel_m, row.conductividad_us_cm, row.ph) == (30.0, None, None)
    assert (row.conductividad_raw, row.ph_raw) == (2000.1, 3.9)
    assert (row.turbidez_raw, row.od_raw, row.temp_raw) == (None, None, None)
    flags = [row[name] for name in row.asDict() if name.startswith("is_outlier_")]
    assert flags == [0, 1, 1, 0, 0, 0]


def test_not_a_number_is_an_outlier(spark):
    row = stg_hidro_mediciones(landing(spark, ("2024-01-02", '{"od": "NaN"}'))).first()
    assert math.isnan(row.od_raw) and row.od_mg_l is None and row.is_outlier_od == 1


def test_readings_without_a_time_are_dropped(spark):
    rows = [(text, "{}") for text in (None, "2024", "soon", "2024-01-02 00:00:00")]
    assert stg_hidro_mediciones(landing(spark, *rows)).count() == 1


def test_stations_are_put_together_and_unknown_codes_kept(spark):
    first = landing(spark, ("2024-01-02", "{}"))
    second = landing(spark, ("2024-01-02", "{}"), ("2024-01-02", "{}"), station="other")
    assert values(stg_hidro_mediciones(first, second), "estacion") == [
        ("Itabó Guazú",), ("other",), ("other",),
    ]


def test_issue_rules(spark):
    raw = spark.createDataFrame(
        [
            (1, 1, "a", "closed", None, ts("2024-01-01 23:59:00"), None, ts("2024-01-02 00:01:00"),
             ("u", "User"), [("x",), ("y",)], 0, ("m",)),
            (2, 2, "b", "closed", None, ts("2024-01-01"), None, None, ("u", "User"), None, 0, None),
            (3, 3, "c", "open", None, ts("2024-01-01"), None, ts("2024-01-05"), None, [], 0, None),
            (4, 4, "d", None, None, ts("2024-01-01"), None, None, None, [], 0, None),
        ],
        "id long, number long, title string, state string, body string, created_at timestamp_ntz, "
        "updated_at timestamp_ntz, closed_at timestamp_ntz, user struct<login:string,type:string>, "
        "labels array<struct<name:string>>, comments long, milestone struct<title:string>",
    )
    got = values(
        stg_github_issues(raw),
        "issue_id", "label_count", "days_to_close", "is_closed", "author_login", "milestone_title",
    )
    assert got == [
        (1, 2, 1, True, "u", "m"),
        (2, 0, None, True, "u", None),
        (3, 0, None, False, None, None),
        (4, 0, None, False, None, None),
    ]


def test_pull_request_rules(spark):
    opened, later = ts("2024-01-01"), ts("2024-01-04")
    raw = spark.createDataFrame(
        [
            (1, 1, "a", "closed", opened, None, later, later, ("u",), ("f",), ("main",)),
            (2, 2, "b", "closed", opened, None, later, None, ("u",), ("f",), ("main",)),
            (3, 3, "c", "open", opened, None, None, None, None, ("f",), ("main",)),
        ],
        "id long, number long, title string, state string, created_at timestamp_ntz, "
        "updated_at timestamp_ntz, closed_at timestamp_ntz, merged_at timestamp_ntz, "
        "user struct<login:string>, head struct<ref:string>, base struct<ref:string>",
    )
    got = values(stg_github_pull_requests(raw), "pr_id", "is_merged", "is_rejected", "days_to_merge")
    assert got == [(1, True, False, 3), (2, False, True, None), (3, False, False, None)]


def test_creature_stats_by_position(spark):
    raw = spark.createDataFrame(
        [
            (1, "a", 7, 69, 64, True, 1, [(n,) for n in (1, 2, 3, 4, 5, 6)], [(("fire",),), (("ice",),)]),
            (2, "b", 0, 0, 0, True, 2, [(n,) for n in (1, 2, 3, 4, 5)], [(("fire",),)]),
        ],
        "id long, name string, height int, weight int, base_experience int, is_default boolean, "
        "`order` long, stats array<struct<base_stat:int>>, "
        "types array<struct<type:struct<name:string>>>",
    )
    columns = ("hp", "speed", "primary_type", "secondary_type", "height_meters", "pokedex_order")
    got = stg_pokemon(raw).orderBy("pokemon_id").select(*columns).collect()
    assert tuple(got[0]) == (1, 6, "fire", "ice", 0.7, 1)
    assert tuple(got[1]) == (1, None, "fire", None, 0.0, 2)
