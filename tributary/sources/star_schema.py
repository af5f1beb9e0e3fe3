"""Source tables derived from a star schema of orders, line items and events.

Lets every model run on general test tables. Each source is one projection of one
table; nothing is collected, sampled or invented, so the sources grow with the tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tributary.functions.temporal import WALL_CLOCK
from tributary.sources.tables import Loader

MONEY = "decimal(18,2)"
COST_SHARE = "0.60"
PRODUCTS = 25
NAMES = 450

# Kinds by embedding label; the last one is not an accepted kind.
KINDS = (
    "normal", "fire", "water", "grass", "electric", "ice", "ghost", "rock", "dragon", "shadow",
)

# Layout of the tables; declared, so that no file is opened to find it out.
TABLES = {
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
    "embeddings": "vec_id bigint, embedding array<float>, label int",
}

READING_START = "2024-01-01"
SENSOR_START = "2021-01-01"
SENSOR_STRETCH = 24
EXTRACTED_AT = "2024-06-01 06:00:00"


def _money(amount: Column) -> Column:
    return amount.cast(MONEY)


def _cost(price: Column) -> Column:
    return (price * F.lit(COST_SHARE).cast("decimal(3,2)")).cast(MONEY)


def _days_after(ts: Column, days: Column) -> Column:
    return ts + F.make_dt_interval(days=days.cast("int"))


def _line_id() -> Column:
    return F.col("l_orderkey") * 10 + F.col("l_linenumber")


def website_sessions(orders: DataFrame) -> DataFrame:
    customer = F.col("o_custkey")
    device = F.when(customer % 50 != 49, F.when(customer % 2 == 0, "mobile").otherwise("desktop"))
    return orders.select(
        F.col("o_orderkey").alias("website_session_id"),
        F.col("o_orderdate").alias("created_at"),
        customer.alias("user_id"),
        (F.col("o_orderstatus") == "F").cast("int").alias("is_repeat_session"),
        F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED")).alias("utm_source"),
        F.nullif(F.col("o_orderstatus"), F.lit("P")).alias("utm_campaign"),
        F.lit(None).cast("string").alias("utm_content"),
        device.alias("device_type"),
        F.lit(None).cast("string").alias("http_referer"),
    )


def orders(orders: DataFrame) -> DataFrame:
    """Every third session places three orders, up to four days later."""
    key, price = F.col("o_orderkey"), _money(F.col("o_totalprice"))
    cost = _cost(price) + F.col("o_custkey") % 7 * 100
    return orders.select(
        key.alias("order_id"),
        _days_after(F.col("o_orderdate"), F.col("o_custkey") % 5).alias("created_at"),
        (key - key % 3).alias("website_session_id"),
        F.col("o_custkey").alias("user_id"),
        (F.col("o_orderkey") % PRODUCTS).alias("primary_product_id"),
        (F.col("o_custkey") % 4 + 1).cast("int").alias("items_purchased"),
        price.alias("price_usd"),
        _money(cost).alias("cogs_usd"),
    )


def order_items(lineitem: DataFrame) -> DataFrame:
    price = _money(F.col("l_extendedprice"))
    return lineitem.select(
        _line_id().alias("order_item_id"),
        F.col("l_shipdate").alias("created_at"),
        F.col("l_orderkey").alias("order_id"),
        (F.col("l_partkey") % PRODUCTS).alias("product_id"),
        (F.col("l_linenumber") == 1).cast("int").alias("is_primary_item"),
        price.alias("price_usd"),
        _cost(price).alias("cogs_usd"),
    )


def order_item_refunds(lineitem: DataFrame) -> DataFrame:
    return lineitem.where(F.col("l_returnflag") == "R").select(
        _line_id().alias("order_item_refund_id"),
        F.col("l_shipdate").alias("created_at"),
        _line_id().alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        _money(F.col("l_extendedprice")).alias("refund_amount_usd"),
    )


def website_pageviews(events: DataFrame) -> DataFrame:
    return events.where(F.col("event_type") == "view").select(
        F.col("event_id").alias("website_pageview_id"),
        F.col("ts").alias("created_at"),
        F.col("user_id").alias("website_session_id"),
        F.concat(F.lit("/"), "event_type").alias("pageview_url"),
    )


def sensor_records(events: DataFrame, parity: int) -> DataFrame:
    """Sensor records of one station as the API would send them."""
    knob = F.get_json_object("props", "$.k").cast("double")
    value = F.col("value")
    elapsed = F.col("ts") - F.lit(READING_START).cast(WALL_CLOCK)
    taken = F.lit(SENSOR_START).cast(WALL_CLOCK) + elapsed * SENSOR_STRETCH
    seconds = F.substring(taken.cast("string"), 1, 19)
    return events.where(F.col("user_id") % 2 == parity).select(
        F.concat(seconds, F.lit(" PYST")).alias("fecha"),
        F.when(F.col("event_type") != "error", value / 10).alias("nivel"),
        (value * 10).alias("conductividad"),
        (knob * 0.065 + 4).alias("ph"),
        (value * 1.2).alias("turbidez"),
        (value / 6).alias("od"),
        (knob * 0.4 + 4).alias("tempagua"),
    )


def station_landing(events: DataFrame, station: str, parity: int) -> DataFrame:
    records = sensor_records(events, parity)
    payload = F.to_json(F.struct(*records.columns), {"ignoreNullFields": "false"})
    return records.select(
        F.lit(station).alias("station_name"),
        F.col("fecha").alias("measurement_ts"),
        payload.alias("raw_payload"),
        F.lit(EXTRACTED_AT).cast(WALL_CLOCK).alias("extracted_at"),
    )


def issues(orders: DataFrame) -> DataFrame:
    customer, created = F.col("o_custkey"), F.col("o_orderdate")
    tags = F.array(*[F.struct(F.lit(tag).alias("name")) for tag in ("bug", "docs", "help")])
    labels = F.slice(tags, F.lit(1), (customer % 4).cast("int"))
    author = F.struct(
        F.concat(F.lit("u"), customer.cast("string")).alias("login"),
        F.when(customer % 11 == 0, "Bot").otherwise("User").alias("type"),
    )
    milestone = F.struct(F.concat(F.lit("m"), (customer % 3).cast("string")).alias("title"))
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderkey").alias("number"),
        F.concat(F.lit("issue "), F.col("o_orderkey").cast("string")).alias("title"),
        F.when(F.col("o_orderstatus") == "O", "open").otherwise("closed").alias("state"),
        F.lit(None).cast("string").alias("body"),
        created.alias("created_at"),
        _days_after(created, F.lit(1)).alias("updated_at"),
        F.when(F.col("o_orderstatus") == "F", _days_after(created, customer % 60)).alias("closed_at"),
        author.alias("user"),
        F.when(customer % 5 != 0, labels).alias("labels"),
        (F.col("o_orderkey") % 10).alias("comments"),
        F.when(customer % 7 == 0, milestone).alias("milestone"),
    )


def pull_requests(lineitem: DataFrame) -> DataFrame:
    created = F.col("l_shipdate")
    is_open = F.col("l_linestatus") == "O"
    merged = F.when(
        ~is_open & (F.col("l_returnflag") == "A"), _days_after(created, F.col("l_quantity"))
    )
    branch = F.concat(F.lit("work-"), F.col("l_linenumber").cast("string"))
    return lineitem.select(
        _line_id().alias("id"),
        _line_id().alias("number"),
        F.concat(F.lit("change "), F.col("l_orderkey").cast("string")).alias("title"),
        F.when(is_open, "open").otherwise("closed").alias("state"),
        created.alias("created_at"),
        _days_after(created, F.lit(1)).alias("updated_at"),
        F.when(~is_open, F.coalesce(merged, _days_after(created, F.lit(2)))).alias("closed_at"),
        merged.alias("merged_at"),
        F.struct(F.concat(F.lit("u"), F.col("l_suppkey").cast("string")).alias("login")).alias("user"),
        F.struct(branch.alias("ref")).alias("head"),
        F.struct(F.lit("main").alias("ref")).alias("base"),
    )


def pokemon(embeddings: DataFrame) -> DataFrame:
    number, label = F.col("vec_id"), F.col("label")

    size = F.size("embedding")

    def stat(place: Column) -> Column:
        """Components place, place + 6, ... in thousandths, as one of six stats."""
        places = F.sequence(place, F.greatest(place, size - 1), F.lit(6))
        part = lambda at: F.floor(F.abs(F.get("embedding", at).cast("double")) * 1000)
        total = F.aggregate(places, F.lit(0).cast("long"), lambda sum_, at: sum_ + F.coalesce(part(at), F.lit(0)))
        return F.struct((total / 10).cast("int").alias("base_stat"))

    def kind(at: Column) -> Column:
        name = F.get(F.array(*[F.lit(k) for k in KINDS]), at.cast("int"))
        return F.struct(F.struct(name.alias("name")).alias("type"))

    stats = F.transform(F.sequence(F.lit(0), F.when(number % 20 == 0, 4).otherwise(5)), stat)
    one = F.array(kind(label % 10))
    two = F.array(kind(label % 10), kind((label + 3) % 10))
    return embeddings.select(
        number.alias("id"),
        F.concat(F.lit("creature-"), (number % NAMES).cast("string")).alias("name"),
        (number % 30).cast("int").alias("height"),
        (number * 3 % 500).cast("int").alias("weight"),
        (number % 300).cast("int").alias("base_experience"),
        (number % 2 == 0).alias("is_default"),
        (number + 1).alias("order"),
        stats.alias("stats"),
        F.when(number % 3 == 0, two).otherwise(one).alias("types"),
    )


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.schema(TABLES[name]).parquet(f"{root.rstrip('/')}/{name}.parquet")


# Source table to the table it comes from and how.
SOURCES = {
    "website_sessions": ("orders", website_sessions),
    "orders": ("orders", orders),
    "order_items": ("lineitem", order_items),
    "order_item_refunds": ("lineitem", order_item_refunds),
    "website_pageviews": ("events", website_pageviews),
    "hidro_estacion_itabo_guazu": (
        "events", lambda events: station_landing(events, "itabo_guazu", 0)
    ),
    "hidro_estacion_pozuelo_puente": (
        "events", lambda events: station_landing(events, "pozuelo_puente", 1)
    ),
    "issues": ("orders", issues),
    "pull_requests": ("lineitem", pull_requests),
    "pokemon": ("embeddings", pokemon),
}


def loader(spark: SparkSession, root: str) -> Loader:
    """Sources over the Parquet tables under ``root``."""

    def load(name: str) -> DataFrame:
        given, derive = SOURCES[name]
        return derive(table(spark, root, given))

    return load
