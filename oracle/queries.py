"""The expected result of each registered query as one DuckDB statement."""

from __future__ import annotations

from oracle.relations import RELATIONS, statement
from tributary.plans.quality import CHECKS

NUMBERS = """
    station_name, measurement_ts, extracted_at,
    cast(json_extract_string(raw_payload, '$.nivel') as double) as nivel,
    cast(json_extract_string(raw_payload, '$.conductividad') as double) as conductividad,
    cast(json_extract_string(raw_payload, '$.ph') as double) as ph,
    cast(json_extract_string(raw_payload, '$.turbidez') as double) as turbidez,
    cast(json_extract_string(raw_payload, '$.od') as double) as od,
    cast(json_extract_string(raw_payload, '$.tempagua') as double) as tempagua
"""


def _classes(label: str, relation: str, *by: str) -> str:
    columns = ", ".join([*by, f'{label} as "class"'])
    return statement(f"select {columns}, count(*) as rows from {relation} group by all", relation)


def _both_stations(columns: str) -> str:
    rows = "(from landing_itabo union all from landing_pozuelo)"
    return statement(f"select {columns} from {rows}", "landing_itabo", "landing_pozuelo")


def _failures(check) -> str:
    """Number of failures of one check as a scalar query."""
    table, column = check.table, check.column
    quoted = f'"{column}"'
    if check.rule == "not_null":
        return f"select count(*) from {table} where {quoted} is null"
    if check.rule == "between":
        return (
            f"select count(*) from {table} "
            f"where {quoted} < {check.low} or {quoted} > {check.high}"
        )
    if check.rule == "at_least":
        return f"select count(*) from {table} where {quoted} < {check.low}"
    if check.rule == "not_in_future":
        return f"select count(*) from {table} where {quoted} > (now() at time zone 'UTC')"
    if check.rule == "accepted_values":
        values = ", ".join(f"'{value}'" for value in check.values)
        return f"select count(distinct {quoted}) from {table} where {quoted} not in ({values})"
    if check.rule == "row_count":
        return (
            f"select cast(count(*) < {check.low} or count(*) > {check.high} as bigint) from {table}"
        )
    null = f"where {quoted} is not null" if check.rule == "unique" else ""
    return (
        f"select count(*) from (select {quoted} from {table} {null} "
        f"group by 1 having count(*) > 1)"
    )


def _outcomes(checks) -> str:
    rows = []
    for check in checks:
        column = "null" if check.column is None else f"'{check.column}'"
        rows.append(
            f"select '{check.name}' as \"check\", '{check.table}' as model, "
            f"cast({column} as varchar) as column_name, '{check.severity}' as severity, "
            f"({_failures(check)}) as failures"
        )
    return (
        "select *, if(failures = 0, 'pass', severity) as status from ("
        + " union all ".join(rows)
        + ")"
    )


_all_models = tuple(dict.fromkeys(check.table for check in CHECKS))
_row_count = [check for check in CHECKS if check.rule == "row_count"]
_sensor_models = (
    "stg_hidro_mediciones",
    "int_hidro_diario",
    "mart_hidro_resumen",
    "mart_hidro_calidad",
)

ORACLE: dict[str, str] = {
    name: statement(f"select * from {name}", name)
    for name in RELATIONS
    if name.startswith(("stg_", "int_", "fct_", "mart_", "obt_"))
}

ORACLE |= {
    "fn_date_parts": """
        select event_id, date_trunc('hour', ts) as hour_start, date_trunc('day', ts) as day_start,
               date_trunc('week', ts) as week_start, date_trunc('month', ts) as month_start,
               extract(year from ts) as year_number,
               cast(extract(month from ts) as integer) as month_number,
               cast(extract(week from ts) as integer) as iso_week,
               cast(extract(dow from ts) as integer) as weekday,
               date_diff('day', timestamp '2024-01-01 23:59:59', ts) as days_since
        from events""",
    "fn_safe_cast": """
        select event_id, value as plain_number,
               try_cast(cast(value as varchar)
                        || (['', 'e1', 'd', 'f', 'x', ' ', '-'])[event_id % 7 + 1] as double)
                   as spoilt_number,
               try_cast(event_type as double) as word_number,
               date_trunc('second', ts) as whole_ts,
               try_cast(left(strftime(ts, '%Y-%m-%d %H:%M:%S'), cast(event_id % 20 as integer))
                        as timestamp) as cut_ts,
               try_cast(event_id * 1000000 as integer) as narrowed,
               try_cast(halves as integer) as from_double,
               try_cast(cast(halves as decimal(18,2)) as integer) as from_decimal,
               try_cast(cast(halves as varchar) as integer) as from_text,
               try_cast(cast(value as varchar)
                        || (['', 'e1', 'd', 'f', 'x', ' ', '-'])[event_id % 7 + 1] as integer)
                   as from_spoilt
        from (select *, (event_id - 40) / 2 + if(event_id % 3 = 0, 0.25, 0.0)::double as halves
              from events)""",
    "fn_json": """
        select event_id, json_extract_string(props, '$.k') as k_text,
               json_extract_string(props, '$.missing') as missing_text,
               cast(json_object('event_id', event_id, 'event_type', event_type, 'missing', null)
                    as varchar) as as_json
        from events""",
    "fn_nested": statement("""
        select id, login, milestone as milestone_title, ifnull(length(labels), 0) as label_count,
               labels[1] as first_label, labels[3] as third_label, labels[9] as past_the_end
        from src_issues""", "src_issues"),
    "fn_null_guard": """
        select o_orderkey, ifnull(nullif(o_orderpriority, '4-NOT SPECIFIED'), 'direct') as priority,
               nullif(o_custkey % 4, 0) as group_or_null,
               ifnull(nullif(o_custkey % 4, 3), 0) as group_or_zero,
               o_orderkey / nullif(o_custkey % 4, 0) as share,
               round(o_custkey % 4 * 100.0 / nullif(o_orderkey, 0), 2) + 0.0 as share_pct
        from orders""",
    "fn_round": """
        select l_orderkey, l_linenumber, l_partkey,
               round(l_extendedprice * (1 - l_discount), 1) + 0.0 as net_1,
               round(l_extendedprice * (1 - l_discount), 2) + 0.0 as net_2,
               round(l_extendedprice * (1 - l_discount) / 7, 3) + 0.0 as net_3,
               round((l_tax - l_discount) * l_quantity, 1) + 0.0 as signed_1
        from lineitem""",
    "clean_range": """
        select event_id,
               case when event_type <> 'error' and value >= 10 and value <= 50 then value end as kept,
               cast(event_type <> 'error' and (value < 10 or value > 50) as integer) as is_outlier
        from events""",
    "classify_level": _classes("condicion_nivel", "mart_hidro_resumen", "estacion"),
    "classify_ph": _classes("condicion_ph", "mart_hidro_resumen", "estacion"),
    "classify_turbidity": _classes("condicion_turbidez", "mart_hidro_resumen", "estacion"),
    "classify_oxygen": _classes("condicion_od", "mart_hidro_resumen", "estacion"),
    "classify_quality": _classes("nivel_calidad", "mart_hidro_calidad", "estacion"),
    "classify_power": _classes("power_tier", "mart_pokemon_analytics"),
    "classify_attack": _classes("attack_style", "mart_pokemon_analytics"),
    "win_lag": statement("""
        select estacion, fecha_dia, nivel_promedio,
               lag(nivel_promedio) over (partition by estacion order by fecha_dia) as previous_level
        from int_hidro_diario""", "int_hidro_diario"),
    "win_moving_avg": statement("""
        select estacion, fecha_dia, nivel_promedio,
               round(avg(nivel_promedio) over (partition by estacion order by fecha_dia
                                               rows 6 preceding), 3) + 0.0 as trailing_level
        from int_hidro_diario""", "int_hidro_diario"),
    "win_partition_avg": statement("""
        select estacion, fecha_dia, nivel_promedio, station_level
        from int_hidro_diario join (
            select estacion, round(avg(nivel_promedio), 3) + 0.0 as station_level
            from int_hidro_diario group by estacion
        ) using (estacion)""", "int_hidro_diario"),
    "ingest_ndjson": _both_stations(NUMBERS),
    "ingest_json_array": _both_stations(NUMBERS),
    "ingest_envelope": _both_stations(NUMBERS),
    "ingest_landing": _both_stations(f"{NUMBERS}, nivel is not null as level_known"),
    "ingest_summary": statement("""
        select 'itabo_guazu' as station, 'ok' as status, count(*) as rows, false as has_error
        from landing_itabo
        union all select 'pozuelo_puente', 'ok', count(*), false from landing_pozuelo
        union all select 'missing', 'failed', null, true""", "landing_itabo", "landing_pozuelo"),
    "sink_full_refresh": statement("select * from src_orders", "src_orders"),
    "sink_append": statement(
        "select website_session_id, 2 * count(*) as copies from src_sessions group by 1",
        "src_sessions"),
    "build_subset": statement(
        " union all ".join(f"select '{m}' as model, count(*) as rows from {m}"
                           for m in _sensor_models),
        *_sensor_models),
    "check_unique": statement("""
        select order_item_id, count(*) as n_records from stg_order_items
        where order_item_id is not null group by 1 having n_records > 1""", "stg_order_items"),
    "check_not_null": statement("""
        select pokemon_id, pokemon_name, hp, speed from mart_pokemon_analytics
        where total_base_stats is null""", "mart_pokemon_analytics"),
    "check_accepted_values": statement("""
        select primary_type, count(*) as n_records from stg_pokemon
        where primary_type not in ('normal', 'fire', 'water', 'grass', 'electric', 'ice',
            'fighting', 'poison', 'ground', 'flying', 'psychic', 'bug', 'rock', 'ghost', 'dragon',
            'dark', 'steel', 'fairy', 'stellar', 'unknown')
        group by 1""", "stg_pokemon"),
    "check_between": statement("""
        select order_id, price_usd from stg_orders where price_usd < 0 or price_usd > 10000""",
        "stg_orders"),
    "check_row_count": statement(
        f'select "check", failures, status from ({_outcomes(_row_count)})', "stg_hidro_mediciones"),
    "check_no_future": statement("""
        select estacion, fecha_medicion, nivel_raw, cargado_en from stg_hidro_mediciones
        where fecha_medicion > timestamp '2022-06-01 00:00:00'""", "stg_hidro_mediciones"),
    "check_margin_floor": statement("""
        select order_id, price_usd, cogs_usd, margin_usd from stg_orders where margin_usd < -5""",
        "stg_orders"),
    "check_duplicate_names": statement("""
        select pokemon_name, count(*) as occurrences from mart_pokemon_analytics
        group by 1 having occurrences > 1""", "mart_pokemon_analytics"),
    "check_outcomes": statement(_outcomes(CHECKS), *_all_models),
    "check_summary": statement(
        f"select status, count(*) as checks from ({_outcomes(CHECKS)}) group by 1", *_all_models),
}
