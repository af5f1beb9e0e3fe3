"""Mart rules on hand-written rows."""

from decimal import Decimal

import pytest
from conftest import ts, values
from pyspark.sql import functions as F

from tributary.plans import marts
from tributary.plans.intermediate import int_github_activity, int_hidro_diario

SESSIONS = (
    "website_session_id long, user_id long, is_repeat_session boolean, utm_source string, "
    "utm_campaign string, device_type string, http_referer string, session_date timestamp_ntz, "
    "session_month timestamp_ntz"
)
ORDERS = (
    "order_id long, created_at timestamp_ntz, website_session_id long, user_id long, "
    "primary_product_id long, items_purchased int, price_usd decimal(18,2), "
    "cogs_usd decimal(18,2), margin_usd decimal(18,2), margin_pct double, "
    "order_date timestamp_ntz, order_month timestamp_ntz"
)
REFUNDS = (
    "order_item_refund_id long, created_at timestamp_ntz, order_item_id long, order_id long, "
    "refund_amount_usd decimal(18,2), refund_date timestamp_ntz"
)
ITEMS = (
    "order_item_id long, created_at timestamp_ntz, product_id long, price_usd decimal(18,2), "
    "cogs_usd decimal(18,2), margin_usd decimal(18,2)"
)
JAN, FEB, DAY = ts("2024-01-01"), ts("2024-02-01"), ts("2024-01-10")


def session(number, user=1, device="mobile", day=DAY, month=JAN, repeat=False):
    return (number, user, repeat, "ads", "none", device, None, day, month)


def order(number, visit, price="10.00", cost="4.00", day=DAY, user=1):
    price, cost = Decimal(price), Decimal(cost)
    return (number, day, visit, user, 1, 2, price, cost, price - cost, None, day, JAN)


def refund(number, order_id, amount="3.00", day=DAY, item=1):
    return (number, day, item, order_id, Decimal(amount), day)


def item(number, product=1, price="10.00", day=DAY):
    return (number, day, product, Decimal(price), Decimal("4.00"), Decimal(price) - 4)


def test_daily_sales(spark):
    other = ts("2024-01-11")
    lost = ts("2024-01-12")
    sessions = spark.createDataFrame(
        [session(1), session(2, user=1, repeat=True), session(3, user=2, day=other), session(4, day=other, repeat=None)],
        SESSIONS,
    )
    orders = spark.createDataFrame([order(1, 1), order(2, 9, day=lost)], ORDERS)
    refunds = spark.createDataFrame([refund(1, 1), refund(2, 2, day=other)], REFUNDS)
    rows = marts.fct_daily_sales(sessions, orders, refunds).collect()
    assert [row.date for row in rows] == [DAY, other]  # the day without sessions is gone
    first, second = rows
    assert (first.total_sessions, first.unique_users, first.repeat_sessions) == (2, 1, 1)
    assert (first.total_orders, first.items_sold, first.conversion_rate_pct) == (1, 2, 50.0)
    assert first.net_revenue == Decimal("7.00")
    assert (second.total_orders, second.revenue, second.refund_amount) == (0, 0, Decimal("3.00"))
    assert second.net_revenue == Decimal("-3.00") and second.repeat_sessions == 0


def test_channels_without_a_device_show_no_orders(spark):
    sessions = spark.createDataFrame([session(1), session(2, device=None), session(3, month=None)], SESSIONS)
    orders = spark.createDataFrame([order(1, 1), order(2, 2), order(3, 3)], ORDERS)
    got = values(
        marts.fct_channel_performance(sessions, orders),
        "session_month", "device_type", "total_sessions", "total_orders", "revenue", "margin_pct",
    )
    assert (JAN, "mobile", 1, 1, Decimal("10.00"), 60.0) in got
    assert (JAN, None, 1, 0, Decimal("0.00"), 0.0) in got
    assert (None, "mobile", 1, 0, Decimal("0.00"), 0.0) in got


def test_channel_revenue_of_zero_has_no_margin(spark):
    sessions = spark.createDataFrame([session(1)], SESSIONS)
    orders = spark.createDataFrame([order(1, 1, price="0.00", cost="0.00")], ORDERS)
    assert marts.fct_channel_performance(sessions, orders).first().margin_pct is None


def test_channels_equal_a_row_by_row_join(spark):
    """Copies on both sides, NULL keys and a key holding a third of all rows."""
    rows = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None)
        .otherwise(F.col("id") % 400).alias("website_session_id"),
        (F.col("id") % 17).alias("user_id"),
        (F.col("id") % 2 == 0).alias("is_repeat_session"),
        F.element_at(F.array(F.lit("a"), F.lit("b")), (F.col("id") % 2 + 1).cast("int")).alias("utm_source"),
        F.lit("none").alias("utm_campaign"),
        F.when(F.col("id") % 5 != 0, "mobile").alias("device_type"),
        F.when(F.col("id") % 11 != 0, F.lit(JAN)).alias("session_month"),
    )
    orders = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 500).alias("website_session_id"),
        F.when(F.col("id") % 20 != 0, F.col("id")).alias("order_id"),
        F.col("id").cast("decimal(18,2)").alias("price_usd"),
        (F.col("id") * 0.5).cast("decimal(18,2)").alias("margin_usd"),
    )
    keys = ["session_month", "utm_source", "utm_campaign", "device_type"]
    pairs = rows.join(orders, "website_session_id").groupBy(*keys).agg(
        F.count("order_id").alias("n"), F.sum("price_usd").alias("revenue")
    )
    visits = rows.groupBy(*keys).agg(
        F.count("*").alias("total_sessions"), F.count_distinct("user_id").alias("unique_users")
    )
    expected = visits.join(pairs, keys, "left").select(
        *keys, "total_sessions", "unique_users", F.coalesce("n", F.lit(0)), F.coalesce("revenue", F.lit(0)),
    )
    got = marts.fct_channel_performance(rows, orders).select(
        *keys, "total_sessions", "unique_users", "total_orders", "revenue"
    )
    assert values(got) == values(expected)


def test_refunds_of_products(spark):
    items = spark.createDataFrame([item(1), item(1), item(2, product=2)], ITEMS)
    refunds = spark.createDataFrame(
        [refund(1, 1, item=1), refund(2, 1, item=1), refund(3, 1, item=2, day=FEB), refund(4, 1, item=None)],
        REFUNDS,
    )
    got = values(
        marts.fct_product_performance(items, refunds),
        "product_id", "order_month", "units_sold", "refund_count", "refund_amount", "net_revenue",
    )
    # Two copies of the item and two refunds of it make four pairs; the refund in a
    # month without sales is not reported.
    assert got == [
        (1, JAN, 2, 4, Decimal("12.00"), Decimal("8.00")),
        (2, JAN, 1, 0, Decimal("0.00"), Decimal("10.00")),
    ]


def test_product_refunds_equal_a_row_by_row_join(spark):
    """An item id with a third of all rows in both tables."""
    day = F.lit(JAN) + F.make_dt_interval(days=(F.col("id") % 50).cast("int"))
    id_of = F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 50 == 1, None)
    items = spark.range(1200).select(
        id_of.otherwise(F.col("id") % 300).alias("order_item_id"),
        day.alias("created_at"),
        (F.col("id") % 4).alias("product_id"),
        *[F.col("id").cast("decimal(18,2)").alias(c) for c in ("price_usd", "cogs_usd", "margin_usd")],
    )
    refunds = spark.range(600).select(
        id_of.otherwise(F.col("id") % 400).alias("order_item_id"),
        day.alias("created_at"),
        F.when(F.col("id") % 9 != 0, F.col("id") * 0.25).cast("decimal(18,2)").alias("refund_amount_usd"),
    )
    month = F.date_trunc("month", F.col("created_at")).cast("timestamp_ntz")
    pairs = refunds.join(items.select("order_item_id", "product_id"), "order_item_id")
    expected = pairs.groupBy("product_id", month.alias("order_month")).agg(
        F.count("*").alias("refund_count"), F.sum("refund_amount_usd").alias("refund_amount")
    )
    got = marts.fct_product_performance(items, refunds).select(*expected.columns)
    assert values(got.where("refund_count > 0")) == values(expected)


def test_orders_repeat_per_refund(spark):
    orders = spark.createDataFrame(
        [order(1, 1), order(2, 1), order(3, None), order(4, 99)], ORDERS
    )
    sessions = spark.createDataFrame([session(1), session(1), session(5)], SESSIONS)
    refunds = spark.createDataFrame(
        [refund(1, 1, "3.00"), refund(2, 1, "5.00"), refund(3, 4, "1.00"), refund(9, None)], REFUNDS
    )
    df = marts.obt_orders_enriched(orders, sessions, refunds)
    got = values(df, "order_id", "utm_source", "refund_amount", "has_refund", "net_revenue")
    assert len(got) == 4 + 2 + 1 + 1
    assert got.count((1, "ads", Decimal("3.00"), True, Decimal("7.00"))) == 2
    assert got.count((2, "ads", Decimal("0.00"), False, Decimal("10.00"))) == 2
    assert (3, None, Decimal("0.00"), False, Decimal("10.00")) in got
    assert (4, None, Decimal("1.00"), True, Decimal("9.00")) in got


def test_activity_and_summary(spark):
    issues = spark.createDataFrame(
        [(JAN, True, 2, "a"), (JAN, False, None, "b"), (JAN, True, 5, "a")],
        "created_month timestamp_ntz, is_closed boolean, days_to_close long, author_login string",
    )
    pulls = spark.createDataFrame(
        [(JAN, True, 1, "a"), (FEB, False, None, None)],
        "created_month timestamp_ntz, is_merged boolean, days_to_merge long, author_login string",
    )
    activity = int_github_activity(issues, pulls)
    assert [tuple(row) for row in activity.collect()] == [
        (JAN, "issue", 3, 2, 66.67, 3.5, 2),
        (JAN, "pull_request", 1, 1, 100.0, 1.0, 1),
        (FEB, "pull_request", 1, 0, 0.0, None, 0),
    ]
    january, february = marts.mart_github_summary(activity).collect()
    assert tuple(january) == (JAN, 4, 3, 1, 2, 1, 66.67, 100.0, 2, 2.3)
    assert tuple(february) == (FEB, 1, 0, 1, 0, 0, None, 0.0, 0, None)


def daily(spark, rows):
    """Daily rows of one station from (day, level, pH, turbidity, oxygen)."""
    df = spark.createDataFrame(
        [("E", "e", ts(day), *rest) for day, *rest in rows],
        "estacion string, estacion_codigo string, fecha_dia timestamp_ntz, nivel_promedio double, "
        "ph_promedio double, turbidez_promedio double, od_promedio double",
    )
    missing = [
        "nivel_minimo", "nivel_maximo", "nivel_variacion", "conductividad_promedio",
        "temperatura_promedio",
    ]
    return df.withColumns({name: F.lit(None).cast("double") for name in missing}).withColumn(
        "total_mediciones", F.lit(1)
    )


def test_station_days_follow_rows_not_dates(spark):
    levels = [1.0, 2.0, 4.0, None, 8.0, 16.0, 32.0, 64.0]
    days = [f"2024-01-{n:02}" for n in (1, 2, 5, 6, 7, 8, 9, 20)]
    rows = [(day, level, 7.0, 1.0, 6.0) for day, level in zip(days, levels)]
    got = marts.mart_hidro_resumen(daily(spark, rows)).collect()
    assert got[0].nivel_delta_dia_anterior is None
    assert got[2].nivel_delta_dia_anterior == 2.0  # three days later, next row
    assert got[4].nivel_delta_dia_anterior is None  # the row before has no level
    assert got[7].nivel_promedio_movil_7d == 21.0  # rows 2 to 8, one without a level
    assert got[0].nivel_historico_estacion == round(127 / 7, 3)
    assert (got[0].anio, got[0].mes, got[0].semana, got[0].dia_semana) == (2024, 1, 1, "Lunes")
    assert got[3].condicion_nivel == "sin_datos"


def test_level_classes(spark):
    pairs = [
        (None, 1.0, "sin_datos"), (1.0, None, "sin_referencia"), (12.0, 10.0, "crecida"),
        (10.5, 10.0, "alto"), (8.0, 10.0, "bajante"), (9.5, 10.0, "bajo"), (10.0, 10.0, "normal"),
    ]
    df = spark.createDataFrame(pairs, "level double, usual double, label string")
    label = marts.level_condition(F.col("level"), F.col("usual"))
    assert df.where(~label.eqNullSafe(F.col("label"))).count() == 0


@pytest.mark.parametrize(
    "classify, cases",
    [
        (marts.ph_condition, {6.4: "acido", 6.5: "normal", 8.5: "normal", 8.6: "alcalino", None: "sin_datos"}),
        (marts.turbidity_condition, {4.9: "clara", 5.0: "turbia", 50.0: "muy_turbia", None: "sin_datos"}),
        (marts.oxygen_condition, {2.9: "critico", 3.0: "bajo", 5.0: "saludable", None: "sin_datos"}),
        (marts.quality_class, {0.0: "optima", 4.99: "buena", 5.0: "regular", 19.99: "regular", 20.0: "mala"}),
        (marts.power_tier, {600.0: "legendary_tier", 599.0: "strong", 500.0: "strong", 499.0: "average",
                            400.0: "average", 399.0: "weak", None: "weak"}),
    ],
)
def test_thresholds(spark, classify, cases):
    df = spark.createDataFrame(list(cases.items()), "x double, label string")
    assert values(df.select("x", classify(F.col("x")))) == values(df)


def readings(spark, outliers):
    """One row per entry with that many outlier flags set."""
    flags = ["nivel", "conductividad", "ph", "turbidez", "od", "temp"]
    clean = ["nivel_m", "conductividad_us_cm", "ph", "turbidez_ntu", "od_mg_l", "temp_agua_c"]
    df = spark.createDataFrame([(n,) for n in outliers], "n int")
    return df.select(
        F.lit("E").alias("estacion"), F.lit("e").alias("estacion_codigo"), F.lit(DAY).alias("fecha_dia"),
        *[(F.col("n") > place).cast("int").alias(f"is_outlier_{flag}") for place, flag in enumerate(flags)],
        *[F.when(F.col("n") <= place, 1.0).alias(name) for place, name in enumerate(clean)],
    )


def test_quality_of_a_day(spark):
    row = marts.mart_hidro_calidad(readings(spark, [0, 0, 1, 2])).first()
    assert (row.outliers_nivel, row.outliers_conductividad, row.outliers_temperatura) == (2, 1, 0)
    assert (row.outliers_totales, row.tasa_outliers_pct, row.nivel_calidad) == (3, 12.5, "regular")
    assert (row.mediciones_validas_nivel, row.mediciones_validas_temperatura) == (2, 4)


def test_rate_that_rounds_to_zero_is_optimal(spark):
    row = marts.mart_hidro_calidad(readings(spark, [1] + [0] * 4000)).first()
    assert (row.outliers_totales, row.tasa_outliers_pct, row.nivel_calidad) == (1, 0.0, "optima")


def test_daily_figures_ignore_missing_readings(spark):
    df = spark.createDataFrame(
        [("E", "e", DAY, 1.0), ("E", "e", DAY, None), ("E", "e", DAY, 2.0)],
        "estacion string, estacion_codigo string, fecha_dia timestamp_ntz, nivel_m double",
    )
    others = ["conductividad_us_cm", "ph", "turbidez_ntu", "od_mg_l", "temp_agua_c"]
    row = int_hidro_diario(df.withColumns({c: F.lit(None).cast("double") for c in others})).first()
    assert (row.total_mediciones, row.nivel_promedio, row.nivel_variacion) == (3, 1.5, 1.0)
    assert (row.ph_promedio, row.ph_minimo, row.temperatura_maxima) == (None, None, None)


def test_creatures(spark):
    df = spark.createDataFrame(
        [
            (1, "a", "fire", None, 1.0, 10.0, 1, 100, 100, 100, 100, 100, 100, 1, True),
            (2, "b", None, "ice", 0.0, 10.0, 1, 1, 5, 1, 3, 1, None, 2, True),
            (3, "c", "ice", "ice", 2.0, None, 1, 1, 2, 1, 3, 1, 1, 3, True),
        ],
        "pokemon_id long, pokemon_name string, primary_type string, secondary_type string, "
        "height_meters double, weight_kg double, base_experience int, hp int, attack int, "
        "defense int, special_attack int, special_defense int, speed int, pokedex_order long, "
        "is_default boolean",
    )
    first, last, unknown = marts.mart_pokemon_analytics(df).collect()
    assert (first.total_base_stats, first.power_tier, first.attack_style) == (600, "legendary_tier", "balanced")
    assert (first.secondary_type, first.bmi_index, first.total_attack_power) == ("none", 10.0, 200)
    assert (last.attack_style, last.bmi_index) == ("special_attacker", None)
    assert (unknown.total_base_stats, unknown.power_tier) == (None, "weak")
    assert (unknown.attack_style, unknown.bmi_index) == ("physical_attacker", None)
