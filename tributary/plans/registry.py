"""Every query by name, over the Parquet tables of one folder.

A query takes (spark, folder) and returns a DataFrame with one value type per column and
no nested columns, so that results can be compared from engine to engine.
"""

from __future__ import annotations

import atexit
from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tributary.functions.classify import keep_within, outside_flag
from tributary.functions.numeric import or_zero, percent, ratio, round_half_away
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
    weekday_from_sunday,
    year_number,
)
from tributary.operators import windows
from tributary.operators.aggregates import row_count
from tributary.operators.checks import (
    Check,
    foreign_values,
    offending_rows,
    outcomes,
    repeated_values,
)
from tributary.plans import marts
from tributary.plans.models import MODELS, SUBSETS, build, model, models_over
from tributary.plans.quality import CHECKS, run_checks, summarize
from tributary.sources import ingest, star_schema
from tributary.sources.scratch import scratch_dir
from tributary.sources.sinks import append, full_refresh

Query = Callable[[SparkSession, str], DataFrame]

STATION_PARITY = {"itabo_guazu": 0, "pozuelo_puente": 1}
RECORDS_PER_ARRAY = 2_000
RECORDS_PER_LINE = 500


def _events(spark: SparkSession, folder: str) -> DataFrame:
    return star_schema.table(spark, folder, "events")


def _model(name: str, spark: SparkSession, folder: str) -> DataFrame:
    df = model(name, star_schema.loader(spark, folder))
    if name == "stg_pokemon":
        # The list of kinds is nested and the load time differs from run to run.
        kinds = F.array_join(F.transform("types", lambda kind: kind["type"]["name"]), ",")
        recent = F.col("loaded_at") > F.lit("2020-01-01 00:00:00").cast("timestamp")
        return df.withColumn("types", kinds).withColumn("loaded_at_known", recent).drop("loaded_at")
    return df


def _check(name: str) -> Check:
    return next(check for check in CHECKS if check.name == name)


# --- functions --------------------------------------------------------------------


def fn_date_parts(spark: SparkSession, folder: str) -> DataFrame:
    ts = F.col("ts")
    return _events(spark, folder).select(
        "event_id",
        hour_of(ts).alias("hour_start"),
        day_of(ts).alias("day_start"),
        week_of(ts).alias("week_start"),
        month_of(ts).alias("month_start"),
        year_number(ts).alias("year_number"),
        F.month(ts).alias("month_number"),
        F.weekofyear(ts).alias("iso_week"),
        weekday_from_sunday(ts).alias("weekday"),
        days_between(F.lit("2024-01-01 23:59:59").cast("timestamp_ntz"), ts).alias("days_since"),
    )


def fn_safe_cast(spark: SparkSession, folder: str) -> DataFrame:
    """Casts of whole, cut and spoilt texts, and of numbers with fractions."""
    number = F.col("value").cast("string")
    spoilt = F.concat(number, F.element_at(
        F.array(*[F.lit(tail) for tail in ("", "e1", "d", "f", "x", " ", "-")]),
        (F.col("event_id") % 7 + 1).cast("int"),
    ))
    whole = F.concat(F.substring(F.col("ts").cast("string"), 1, 19), F.lit(" PYST"))
    cut = whole.substr(F.lit(1), (F.col("event_id") % 20).cast("int"))
    halves = (F.col("event_id") - 40) / 2 + F.when(F.col("event_id") % 3 == 0, 0.25).otherwise(0.0)
    return _events(spark, folder).select(
        "event_id",
        safe_double(number).alias("plain_number"),
        safe_double(spoilt).alias("spoilt_number"),
        safe_double(F.col("event_type")).alias("word_number"),
        safe_timestamp(F.substring(whole, 1, 19)).alias("whole_ts"),
        safe_timestamp(cut).alias("cut_ts"),
        safe_int(F.col("event_id") * 1_000_000).alias("narrowed"),
        safe_int(halves).alias("from_double"),
        safe_int(halves.cast("decimal(18,2)")).alias("from_decimal"),
        safe_int(halves.cast("string")).alias("from_text"),
        safe_int(spoilt).alias("from_spoilt"),
    )


def fn_json(spark: SparkSession, folder: str) -> DataFrame:
    fields = json_fields(F.col("props"), ("k", "missing"))
    rows = _events(spark, folder).select("event_id", "event_type", fields)
    text = F.to_json(F.struct("event_id", "event_type", "missing"), {"ignoreNullFields": "false"})
    return rows.select(
        "event_id",
        F.col("k").alias("k_text"),
        F.col("missing").alias("missing_text"),
        text.alias("as_json"),
    )


def fn_nested(spark: SparkSession, folder: str) -> DataFrame:
    labels = F.col("labels")
    return star_schema.loader(spark, folder)("issues").select(
        "id",
        F.col("user.login").alias("login"),
        F.col("milestone.title").alias("milestone_title"),
        length_or_zero(labels).alias("label_count"),
        nth(labels, 1)["name"].alias("first_label"),
        nth(labels, 3)["name"].alias("third_label"),
        nth(labels, 9)["name"].alias("past_the_end"),
    )


def fn_null_guard(spark: SparkSession, folder: str) -> DataFrame:
    group = F.col("o_custkey") % 4
    known = F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED"))
    return star_schema.table(spark, folder, "orders").select(
        "o_orderkey",
        F.coalesce(known, F.lit("direct")).alias("priority"),
        F.nullif(group, F.lit(0)).alias("group_or_null"),
        or_zero(F.nullif(group, F.lit(3))).alias("group_or_zero"),
        ratio(F.col("o_orderkey"), group).alias("share"),
        percent(group, F.col("o_orderkey")).alias("share_pct"),
    )


def fn_round(spark: SparkSession, folder: str) -> DataFrame:
    """Rounded figures of every line item; ids repeat, so they are part of the row."""
    net = F.col("l_extendedprice") * (F.lit(1.0) - F.col("l_discount"))
    signed = (F.col("l_tax") - F.col("l_discount")) * F.col("l_quantity")
    return star_schema.table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        round_half_away(net, 1).alias("net_1"),
        round_half_away(net, 2).alias("net_2"),
        round_half_away(net / 7.0, 3).alias("net_3"),
        round_half_away(signed, 1).alias("signed_1"),
    )


def clean_range(spark: SparkSession, folder: str) -> DataFrame:
    value = F.when(F.col("event_type") != "error", F.col("value"))
    return _events(spark, folder).select(
        "event_id",
        keep_within(value, 10, 50).alias("kept"),
        outside_flag(value, 10, 50).alias("is_outlier"),
    )


# --- classifications and windows ---------------------------------------------------


def _classes(df: DataFrame, label: Column, *by: str) -> DataFrame:
    return df.groupBy(*by, label.alias("class")).agg(row_count().alias("rows"))


def _station_days(spark: SparkSession, folder: str) -> DataFrame:
    return model("int_hidro_diario", star_schema.loader(spark, folder))


def classify_level(spark: SparkSession, folder: str) -> DataFrame:
    days = marts.with_station_history(_station_days(spark, folder))
    label = marts.level_condition(F.col("nivel_promedio"), F.col("nivel_historico_estacion"))
    return _classes(days, label, "estacion")


def classify_ph(spark: SparkSession, folder: str) -> DataFrame:
    label = marts.ph_condition(F.col("ph_promedio"))
    return _classes(_station_days(spark, folder), label, "estacion")


def classify_turbidity(spark: SparkSession, folder: str) -> DataFrame:
    label = marts.turbidity_condition(F.col("turbidez_promedio"))
    return _classes(_station_days(spark, folder), label, "estacion")


def classify_oxygen(spark: SparkSession, folder: str) -> DataFrame:
    label = marts.oxygen_condition(F.col("od_promedio"))
    return _classes(_station_days(spark, folder), label, "estacion")


def classify_quality(spark: SparkSession, folder: str) -> DataFrame:
    days = model("mart_hidro_calidad", star_schema.loader(spark, folder), in_order=False)
    return _classes(days, F.col("nivel_calidad"), "estacion")


def classify_power(spark: SparkSession, folder: str) -> DataFrame:
    creatures = model("mart_pokemon_analytics", star_schema.loader(spark, folder), in_order=False)
    return _classes(creatures, F.col("power_tier"))


def classify_attack(spark: SparkSession, folder: str) -> DataFrame:
    creatures = model("mart_pokemon_analytics", star_schema.loader(spark, folder), in_order=False)
    return _classes(creatures, F.col("attack_style"))


def _windowed(spark: SparkSession, folder: str, name: str, value: Column) -> DataFrame:
    days = _station_days(spark, folder)
    return days.select("estacion", "fecha_dia", "nivel_promedio", value.alias(name))


def win_lag(spark: SparkSession, folder: str) -> DataFrame:
    over = windows.series("estacion", "fecha_dia")
    return _windowed(spark, folder, "previous_level", windows.previous("nivel_promedio", over))


def win_moving_avg(spark: SparkSession, folder: str) -> DataFrame:
    over = windows.series("estacion", "fecha_dia")
    mean = windows.trailing_mean("nivel_promedio", marts.TRAILING_ROWS, over)
    return _windowed(spark, folder, "trailing_level", round_half_away(mean, 3))


def win_partition_avg(spark: SparkSession, folder: str) -> DataFrame:
    mean = windows.group_mean("nivel_promedio", "estacion")
    return _windowed(spark, folder, "station_level", round_half_away(mean, 3))


# --- ingest and sinks ---------------------------------------------------------------


def _readings(landing: DataFrame) -> DataFrame:
    """Landing rows with the payload's measures as numbers, for comparison."""
    fields = ("nivel", "conductividad", "ph", "turbidez", "od", "tempagua")
    kept = ("station_name", "measurement_ts", "extracted_at")
    texts = landing.select(*kept, json_fields(F.col("raw_payload"), fields))
    return texts.select(*kept, *[safe_double(F.col(name)).alias(name) for name in fields])


def _records(spark: SparkSession, folder: str, station: str) -> DataFrame:
    return star_schema.sensor_records(_events(spark, folder), STATION_PARITY[station])


def _landed(load: Callable[[str], DataFrame]) -> DataFrame:
    """The landing rows of both stations, from the records that ``load`` reads."""
    landings = [ingest.to_landing(load(name), name, _load_time()) for name in STATION_PARITY]
    return _readings(landings[0].unionByName(landings[1]))


def _load_time() -> Column:
    return F.lit(star_schema.EXTRACTED_AT).cast("timestamp_ntz")


def _in_lists(records: DataFrame, size: int) -> DataFrame:
    """Records in lists of at most ``size``: (part, items).

    The part follows from the position in the scan and not from a column, so no value
    of the data can make a list longer.
    """
    part = F.floor(F.monotonically_increasing_id() / size)
    numbered = records.select(part.alias("part"), F.struct(*records.columns).alias("item"))
    return numbered.groupBy("part").agg(F.collect_list("item").alias("items"))


def _as_json(value: Column) -> Column:
    return F.to_json(value, {"ignoreNullFields": "false"}).alias("value")


def _write_arrays(records: DataFrame, path: str) -> None:
    """One compressed JSON array per file."""
    arrays = _in_lists(records, RECORDS_PER_ARRAY).select(_as_json(F.col("items")))
    arrays.write.option("maxRecordsPerFile", 1).option("compression", "gzip").text(path)


def ingest_ndjson(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_dir(spark, "ndjson")
    for station in STATION_PARITY:
        records = _records(spark, folder, station)
        landing = records.select(
            F.lit(station).alias("station_name"),
            F.col("fecha").alias("measurement_ts"),
            F.struct(*records.columns).alias("raw_payload"),
            _load_time().alias("extracted_at"),
        )
        landing.write.mode("append").option("ignoreNullFields", False).json(path)
    return _readings(ingest.read_landing_lines(spark, path))


def ingest_json_array(spark: SparkSession, folder: str) -> DataFrame:
    """One compressed array per file, both stations."""

    def load(station: str) -> DataFrame:
        path = scratch_dir(spark, "arrays")
        _write_arrays(_records(spark, folder, station), path)
        return ingest.read_records(spark, path, whole_files=True)

    return _landed(load)


def ingest_envelope(spark: SparkSession, folder: str) -> DataFrame:
    """Lines that are a list, an envelope around a list, or a single record."""
    return _landed(lambda station: _enveloped(spark, folder, station))


def _enveloped(spark: SparkSession, folder: str, station: str) -> DataFrame:
    path = scratch_dir(spark, "envelopes")
    lists = _in_lists(_records(spark, folder, station), RECORDS_PER_LINE)
    kind = F.col("part") % 3
    enveloped = F.struct(F.col("items").alias(ingest.ENVELOPE))
    lines = (
        lists.where(kind == 0).select(_as_json(F.col("items")))
        .unionByName(lists.where(kind == 1).select(_as_json(enveloped)))
        .unionByName(
            lists.where(kind == 2).select(F.explode("items").alias("item"))
            .select(_as_json(F.col("item")))
        )
    )
    lines.write.text(path)
    return ingest.read_records(spark, path)


def ingest_landing(spark: SparkSession, folder: str) -> DataFrame:
    """Whole-record payloads: every field survives, absent values as JSON nulls."""

    def load(station: str) -> DataFrame:
        path = scratch_dir(spark, "records")
        _records(spark, folder, station).write.option("ignoreNullFields", False).json(path)
        return ingest.read_records(spark, path)

    return _landed(load).withColumn("level_known", F.col("nivel").isNotNull())


def _scratch_database(spark: SparkSession) -> str:
    """A database for one query; it is dropped and its files removed at the process's end.

    The result is lazy and reads its tables, so it cannot go sooner.
    """
    location = scratch_dir(spark, "tables")
    database = "scratch_" + location.rsplit("-", 1)[1]
    spark.sql(f"CREATE DATABASE {database} LOCATION '{location}'")
    atexit.register(_drop, spark, database)
    return database


def _drop(spark: SparkSession, database: str) -> None:
    if spark.getActiveSession() is not None:
        spark.sql(f"DROP DATABASE IF EXISTS {database} CASCADE")


def ingest_summary(spark: SparkSession, folder: str) -> DataFrame:
    """Two stations with files and one without."""
    paths = {}
    for station in STATION_PARITY:
        paths[station] = scratch_dir(spark, station)
        _write_arrays(_records(spark, folder, station), paths[station])
    paths["missing"] = scratch_dir(spark, "missing")
    database = _scratch_database(spark)
    outcome = ingest.load_stations(spark, paths, database, _load_time(), whole_files=True)
    return outcome.select("station", "status", "rows", F.col("error").isNotNull().alias("has_error"))


def sink_full_refresh(spark: SparkSession, folder: str) -> DataFrame:
    """Load sessions, replace them by orders' keys, then offer an empty load."""
    load = star_schema.loader(spark, folder)
    table = f"{_scratch_database(spark)}.orders_landing"
    full_refresh(load("website_sessions"), table)
    orders = load("orders")
    full_refresh(orders, table, keep_if_empty=True)
    full_refresh(orders.where(F.lit(False)), table, keep_if_empty=True)
    return spark.table(table)


def sink_append(spark: SparkSession, folder: str) -> DataFrame:
    """Two syncs of the same sessions: every id is there twice."""
    sessions = star_schema.loader(spark, folder)("website_sessions")
    table = f"{_scratch_database(spark)}.sessions_landing"
    append(sessions, table)
    append(sessions, table)
    synced = spark.table(table).groupBy("website_session_id")
    return synced.agg(row_count().alias("copies"))


def build_subset(spark: SparkSession, folder: str) -> DataFrame:
    """Build the sensor models as tables and views; number of rows of each."""
    load = star_schema.loader(spark, folder)
    built = build(spark, load, _scratch_database(spark), SUBSETS["sensors"])
    sizes = [
        df.agg(row_count().alias("rows")).select(F.lit(name).alias("model"), "rows")
        for name, df in built.items()
    ]
    result = sizes[0]
    for size in sizes[1:]:
        result = result.unionByName(size)
    return result


# --- data checks --------------------------------------------------------------------


def check_unique(spark: SparkSession, folder: str) -> DataFrame:
    items = model("stg_order_items", star_schema.loader(spark, folder))
    return repeated_values(items, "order_item_id")


def check_not_null(spark: SparkSession, folder: str) -> DataFrame:
    creatures = model("mart_pokemon_analytics", star_schema.loader(spark, folder), in_order=False)
    failing = offending_rows(creatures, _check("mart_pokemon_analytics.total_base_stats.not_null"))
    return failing.select("pokemon_id", "pokemon_name", "hp", "speed")


def check_accepted_values(spark: SparkSession, folder: str) -> DataFrame:
    creatures = model("stg_pokemon", star_schema.loader(spark, folder))
    return foreign_values(creatures, _check("stg_pokemon.primary_type.accepted_values"))


def check_between(spark: SparkSession, folder: str) -> DataFrame:
    orders = model("stg_orders", star_schema.loader(spark, folder))
    failing = offending_rows(orders, _check("stg_orders.price_usd.between"))
    return failing.select("order_id", "price_usd")


def check_row_count(spark: SparkSession, folder: str) -> DataFrame:
    readings = model("stg_hidro_mediciones", star_schema.loader(spark, folder))
    check = _check("stg_hidro_mediciones.row_count")
    result = outcomes({check.table: readings}, [check])
    return result.select("check", "failures", "status")


def check_no_future(spark: SparkSession, folder: str) -> DataFrame:
    """Readings later than a given moment; the check itself uses the present one."""
    readings = model("stg_hidro_mediciones", star_schema.loader(spark, folder))
    check = Check(
        "stg_hidro_mediciones", "not_in_future", "fecha_medicion", moment="2022-06-01 00:00:00"
    )
    failing = offending_rows(readings, check)
    return failing.select("estacion", "fecha_medicion", "nivel_raw", "cargado_en")


def check_margin_floor(spark: SparkSession, folder: str) -> DataFrame:
    orders = model("stg_orders", star_schema.loader(spark, folder))
    failing = offending_rows(orders, _check("stg_orders.margin_usd.at_least"))
    return failing.select("order_id", "price_usd", "cogs_usd", "margin_usd")


def check_duplicate_names(spark: SparkSession, folder: str) -> DataFrame:
    creatures = model("mart_pokemon_analytics", star_schema.loader(spark, folder), in_order=False)
    repeated = repeated_values(creatures, "pokemon_name", ignore_null=False)
    return repeated.withColumnRenamed("n_records", "occurrences")


def check_outcomes(spark: SparkSession, folder: str) -> DataFrame:
    return run_checks(models_over(star_schema.loader(spark, folder)))


def check_summary(spark: SparkSession, folder: str) -> DataFrame:
    return summarize(check_outcomes(spark, folder))


QUERIES: dict[str, Query] = {name: partial(_model, name) for name in MODELS} | {
    query.__name__: query
    for query in (
        fn_date_parts,
        fn_safe_cast,
        fn_json,
        fn_nested,
        fn_null_guard,
        fn_round,
        clean_range,
        classify_level,
        classify_ph,
        classify_turbidity,
        classify_oxygen,
        classify_quality,
        classify_power,
        classify_attack,
        win_lag,
        win_moving_avg,
        win_partition_avg,
        ingest_ndjson,
        ingest_json_array,
        ingest_envelope,
        ingest_landing,
        ingest_summary,
        sink_full_refresh,
        sink_append,
        build_subset,
        check_unique,
        check_not_null,
        check_accepted_values,
        check_between,
        check_row_count,
        check_no_future,
        check_margin_floor,
        check_duplicate_names,
        check_outcomes,
        check_summary,
    )
}
