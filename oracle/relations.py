"""Named relations in DuckDB SQL: sources over the given tables, and the models.

Each entry is (relations it reads, text). ``statement`` puts the ones a query needs in
front of it as common table expressions. Every rounded figure has ``+ 0.0`` after it,
which turns -0.0 into 0.0.
"""

from __future__ import annotations

RECORD = """
    select
        strftime(timestamp '2021-01-01' + (ts - timestamp '2024-01-01') * 24,
                 '%Y-%m-%d %H:%M:%S') || ' PYST' as fecha,
        case when event_type = 'error' then null else value / 10 end as nivel,
        value * 10 as conductividad,
        cast(json_extract_string(props, '$.k') as double) * 0.065::double + 4 as ph,
        value * 1.2::double as turbidez,
        value / 6 as od,
        cast(json_extract_string(props, '$.k') as double) * 0.4::double + 4 as tempagua
    from events where user_id % 2 = {parity}
"""

LANDING = """
    select '{station}' as station_name,
           fecha as measurement_ts,
           json_object('fecha', fecha, 'nivel', nivel, 'conductividad', conductividad,
                       'ph', ph, 'turbidez', turbidez, 'od', od, 'tempagua', tempagua) as raw_payload,
           timestamp '2024-06-01 06:00:00' as extracted_at
    from {records}
"""

MONTH_OF_ACTIVITY = """
    select created_month as activity_month, '{activity}' as activity_type,
           count(*) as total_count,
           count(*) filter (where {resolved}) as closed_count,
           round(100.0 * count(*) filter (where {resolved}) / count(*), 2) + 0.0 as close_rate_pct,
           round(avg({days}), 1) + 0.0 as avg_days_to_resolve,
           count(distinct author_login) as unique_contributors
    from {rows} group by all
"""

# Measures with their limits.
MEASURES = (
    ("nivel", "nivel_raw", "nivel_m", "nivel", 0, 30),
    ("conductividad", "conductividad_raw", "conductividad_us_cm", "conductividad", 0, 2000),
    ("ph", "ph_raw", "ph", "ph", 4, 10),
    ("turbidez", "turbidez_raw", "turbidez_ntu", "turbidez", 0, 3000),
    ("od", "od_raw", "od_mg_l", "od", 0, 15),
    ("tempagua", "temp_raw", "temp_agua_c", "temp", 5, 40),
)

_raw = ",\n".join(
    f"try_cast(json_extract_string(raw_payload, '$.{field}') as double) as {raw}"
    for field, raw, *_ in MEASURES
)
_clean = ",\n".join(
    f"if({raw} >= {low} and {raw} <= {high}, {raw}, null) as {clean}"
    for _, raw, clean, _, low, high in MEASURES
)
_flags = ",\n".join(
    f"cast(coalesce({raw} < {low} or {raw} > {high}, false) as integer) as is_outlier_{flag}"
    for _, raw, _, flag, low, high in MEASURES
)


def _daily(clean: str, digits: int, mean: str, low: str, high: str) -> str:
    figures = ((mean, f"avg({clean})"), (low, f"min({clean})"), (high, f"max({clean})"))
    return ", ".join(f"round({value}, {digits}) + 0.0 as {name}" for name, value in figures)


RELATIONS: dict[str, tuple[tuple[str, ...], str]] = {
    # --- sources ------------------------------------------------------------------
    "src_sessions": ((), """
        select o_orderkey as website_session_id, o_orderdate as created_at, o_custkey as user_id,
               cast(o_orderstatus = 'F' as integer) as is_repeat_session,
               nullif(o_orderpriority, '4-NOT SPECIFIED') as utm_source,
               nullif(o_orderstatus, 'P') as utm_campaign,
               cast(null as varchar) as utm_content,
               case when o_custkey % 50 = 49 then null
                    when o_custkey % 2 = 0 then 'mobile' else 'desktop' end as device_type,
               cast(null as varchar) as http_referer
        from orders"""),
    "src_orders": ((), """
        select o_orderkey as order_id,
               o_orderdate + to_days(cast(o_custkey % 5 as integer)) as created_at,
               o_orderkey - o_orderkey % 3 as website_session_id,
               o_custkey as user_id, o_orderkey % 25 as primary_product_id,
               cast(o_custkey % 4 + 1 as integer) as items_purchased,
               cast(o_totalprice as decimal(18,2)) as price_usd,
               cast(cast(cast(o_totalprice as decimal(18,2)) * 0.60 as decimal(18,2))
                    + o_custkey % 7 * 100 as decimal(18,2)) as cogs_usd
        from orders"""),
    "src_items": ((), """
        select l_orderkey * 10 + l_linenumber as order_item_id, l_shipdate as created_at,
               l_orderkey as order_id, l_partkey % 25 as product_id,
               cast(l_linenumber = 1 as integer) as is_primary_item,
               cast(l_extendedprice as decimal(18,2)) as price_usd,
               cast(cast(l_extendedprice as decimal(18,2)) * 0.60 as decimal(18,2)) as cogs_usd
        from lineitem"""),
    "src_refunds": ((), """
        select l_orderkey * 10 + l_linenumber as order_item_refund_id, l_shipdate as created_at,
               l_orderkey * 10 + l_linenumber as order_item_id, l_orderkey as order_id,
               cast(l_extendedprice as decimal(18,2)) as refund_amount_usd
        from lineitem where l_returnflag = 'R'"""),
    "src_itabo": ((), RECORD.format(parity=0)),
    "src_pozuelo": ((), RECORD.format(parity=1)),
    "landing_itabo": (("src_itabo",), LANDING.format(station="itabo_guazu", records="src_itabo")),
    "landing_pozuelo": (
        ("src_pozuelo",), LANDING.format(station="pozuelo_puente", records="src_pozuelo")),
    "src_issues": ((), """
        select o_orderkey as id, o_orderkey as number, 'issue ' || o_orderkey as title,
               if(o_orderstatus = 'O', 'open', 'closed') as state,
               cast(null as varchar) as body, o_orderdate as created_at,
               o_orderdate + interval 1 day as updated_at,
               case when o_orderstatus = 'F'
                    then o_orderdate + to_days(cast(o_custkey % 60 as integer)) end as closed_at,
               'u' || o_custkey as login, if(o_custkey % 11 = 0, 'Bot', 'User') as kind,
               if(o_custkey % 5 = 0, null,
                  list_slice(['bug', 'docs', 'help'], 1, o_custkey % 4)) as labels,
               o_orderkey % 10 as comments,
               if(o_custkey % 7 = 0, 'm' || (o_custkey % 3), null) as milestone
        from orders"""),
    "src_pulls": ((), """
        select l_orderkey * 10 + l_linenumber as id, 'change ' || l_orderkey as title,
               if(l_linestatus = 'O', 'open', 'closed') as state, l_shipdate as created_at,
               l_shipdate + interval 1 day as updated_at,
               case when l_linestatus <> 'O' and l_returnflag = 'A'
                    then l_shipdate + to_days(cast(l_quantity as integer)) end as merged_at,
               if(l_linestatus = 'O', null,
                  coalesce(merged_at, l_shipdate + interval 2 day)) as closed_at,
               'u' || l_suppkey as login, 'work-' || l_linenumber as head
        from lineitem"""),
    "src_creatures": ((), """
        select vec_id, 'creature-' || (vec_id % 450) as name,
               list_transform(range(0, if(vec_id % 20 = 0, 5, 6)), lambda place: cast(floor(list_sum(
                   list_transform(list_filter(embedding, lambda x, i: (i - 1) % 6 = place),
                                  lambda x: floor(abs(cast(x as double)) * 1000))) / 10) as integer)) as stats,
               ['normal', 'fire', 'water', 'grass', 'electric', 'ice', 'ghost', 'rock', 'dragon',
                'shadow'] as kinds,
               label
        from embeddings"""),
    # --- staging ------------------------------------------------------------------
    "stg_sessions": (("src_sessions",), """
        select website_session_id, created_at, user_id, is_repeat_session = 1 as is_repeat_session,
               ifnull(utm_source, 'direct') as utm_source,
               ifnull(utm_campaign, 'none') as utm_campaign,
               utm_content, device_type, http_referer,
               date_trunc('day', created_at) as session_date,
               date_trunc('week', created_at) as session_week,
               date_trunc('month', created_at) as session_month,
               year(created_at) as session_year
        from src_sessions"""),
    "stg_orders": (("src_orders",), """
        select *, price_usd - cogs_usd as margin_usd,
               round((price_usd - cogs_usd) / nullif(price_usd, 0) * 100, 2) + 0.0 as margin_pct,
               date_trunc('day', created_at) as order_date,
               date_trunc('week', created_at) as order_week,
               date_trunc('month', created_at) as order_month,
               year(created_at) as order_year
        from src_orders"""),
    "stg_pageviews": ((), """
        select event_id as website_pageview_id, ts as created_at, user_id as website_session_id,
               '/' || event_type as pageview_url, date_trunc('day', ts) as pageview_date
        from events where event_type = 'view'"""),
    "stg_order_items": (("src_items",), """
        select *, price_usd - cogs_usd as margin_usd from src_items"""),
    "stg_refunds": (("src_refunds",), """
        select *, date_trunc('day', created_at) as refund_date from src_refunds"""),
    "stg_github_issues": (("src_issues",), """
        select id as issue_id, number as issue_number, title, state, body, created_at, updated_at,
               closed_at, login as author_login, kind as author_type,
               ifnull(length(labels), 0) as label_count, comments as comment_count,
               milestone as milestone_title,
               if(state = 'closed', date_diff('day', created_at, closed_at), null) as days_to_close,
               ifnull(state = 'closed', false) as is_closed,
               date_trunc('month', created_at) as created_month,
               date_trunc('week', created_at) as created_week
        from src_issues"""),
    "stg_github_pull_requests": (("src_pulls",), """
        select id as pr_id, id as pr_number, title, state, created_at, updated_at, closed_at,
               merged_at, login as author_login, head as source_branch, 'main' as target_branch,
               merged_at is not null as is_merged,
               state = 'closed' and merged_at is null as is_rejected,
               date_diff('day', created_at, merged_at) as days_to_merge,
               date_trunc('month', created_at) as created_month,
               date_trunc('week', created_at) as created_week
        from src_pulls"""),
    "stg_pokemon": (("src_creatures",), """
        select vec_id as pokemon_id, name as pokemon_name,
               cast(vec_id % 30 as integer) as height,
               cast(vec_id * 3 % 500 as integer) as weight,
               cast(vec_id % 300 as integer) as base_experience,
               height / 10.0::double as height_meters, weight / 10.0::double as weight_kg,
               vec_id % 2 = 0 as is_default, vec_id + 1 as pokedex_order,
               stats[1] as hp, stats[2] as attack, stats[3] as defense, stats[4] as special_attack,
               stats[5] as special_defense, stats[6] as speed,
               kinds[label % 10 + 1] as primary_type,
               if(vec_id % 3 = 0, kinds[(label + 3) % 10 + 1], null) as secondary_type,
               primary_type || if(vec_id % 3 = 0, ',' || secondary_type, '') as types,
               true as loaded_at_known
        from src_creatures"""),
    "stg_hidro_mediciones": (("landing_itabo", "landing_pozuelo"), f"""
        select *, {_clean}, {_flags}
        from (
            select if(station_name = 'itabo_guazu', 'Itabó Guazú', 'Pozuelo Puente') as estacion,
                   station_name as estacion_codigo,
                   try_cast(left(measurement_ts, 19) as timestamp) as fecha_medicion,
                   date_trunc('day', fecha_medicion) as fecha_dia,
                   date_trunc('hour', fecha_medicion) as fecha_hora,
                   date_trunc('month', fecha_medicion) as fecha_mes,
                   {_raw},
                   extracted_at as cargado_en
            from (from landing_itabo union all from landing_pozuelo)
        )
        where fecha_medicion is not null"""),
    # --- intermediate -------------------------------------------------------------
    "int_github_activity": (
        ("stg_github_issues", "stg_github_pull_requests"),
        MONTH_OF_ACTIVITY.format(activity="issue", resolved="is_closed", days="days_to_close",
                                 rows="stg_github_issues")
        + " union all "
        + MONTH_OF_ACTIVITY.format(activity="pull_request", resolved="is_merged",
                                   days="days_to_merge", rows="stg_github_pull_requests")),
    "int_hidro_diario": (("stg_hidro_mediciones",), f"""
        select estacion, estacion_codigo, fecha_dia, count(*) as total_mediciones,
               round(max(nivel_m) - min(nivel_m), 3) + 0.0 as nivel_variacion,
               {_daily('nivel_m', 3, 'nivel_promedio', 'nivel_minimo', 'nivel_maximo')},
               {_daily('conductividad_us_cm', 3, 'conductividad_promedio', 'conductividad_minima',
                       'conductividad_maxima')},
               {_daily('ph', 2, 'ph_promedio', 'ph_minimo', 'ph_maximo')},
               {_daily('turbidez_ntu', 2, 'turbidez_promedio', 'turbidez_minima', 'turbidez_maxima')},
               {_daily('od_mg_l', 3, 'od_promedio', 'od_minimo', 'od_maximo')},
               {_daily('temp_agua_c', 2, 'temperatura_promedio', 'temperatura_minima',
                       'temperatura_maxima')}
        from stg_hidro_mediciones group by 1, 2, 3"""),
    # --- marts --------------------------------------------------------------------
    "fct_daily_sales": (("stg_sessions", "stg_orders", "stg_refunds"), """
        with visits as (
            select session_date as d, count(*) as n, count(distinct user_id) as users,
                   count(*) filter (where is_repeat_session) as repeats
            from stg_sessions group by d
        ), sales as (
            select order_date as d, count(*) as n, count(distinct user_id) as buyers,
                   sum(items_purchased) as items, sum(price_usd) as revenue, sum(cogs_usd) as cogs,
                   sum(margin_usd) as margin
            from stg_orders group by d
        ), returned as (
            select refund_date as d, count(*) as n, sum(refund_amount_usd) as amount
            from stg_refunds group by d
        )
        select d as "date", visits.n as total_sessions, users as unique_users,
               repeats as repeat_sessions,
               ifnull(sales.n, 0) as total_orders, ifnull(buyers, 0) as unique_buyers,
               cast(ifnull(items, 0) as bigint) as items_sold,
               round(ifnull(sales.n, 0) * 100.0 / visits.n, 2) + 0.0 as conversion_rate_pct,
               cast(ifnull(revenue, 0) as decimal(28,2)) as revenue,
               cast(ifnull(cogs, 0) as decimal(28,2)) as cogs,
               cast(ifnull(margin, 0) as decimal(29,2)) as margin,
               ifnull(returned.n, 0) as total_refunds,
               cast(ifnull(amount, 0) as decimal(28,2)) as refund_amount,
               cast(ifnull(revenue, 0) - ifnull(amount, 0) as decimal(29,2)) as net_revenue
        from visits left join sales using (d) left join returned using (d)"""),
    "fct_channel_performance": (("stg_sessions", "stg_orders"), """
        with visits as (
            select session_month as m, utm_source as s, utm_campaign as c, device_type as v,
                   count(*) as n, count(distinct user_id) as users
            from stg_sessions group by m, s, c, v
        ), sales as (
            select session_month as m, utm_source as s, utm_campaign as c, device_type as v,
                   count(order_id) as n, sum(price_usd) as revenue, sum(margin_usd) as margin
            from stg_orders join stg_sessions using (website_session_id) group by m, s, c, v
        )
        select m as session_month, s as utm_source, c as utm_campaign, v as device_type,
               visits.n as total_sessions, users as unique_users,
               ifnull(sales.n, 0) as total_orders,
               round(ifnull(sales.n, 0) * 100.0 / visits.n, 2) + 0.0 as conversion_rate_pct,
               cast(ifnull(revenue, 0) as decimal(38,2)) as revenue,
               cast(ifnull(margin, 0) as decimal(38,2)) as margin,
               round(ifnull(margin, 0) * 100.0 / nullif(ifnull(revenue, 1), 0), 2) + 0.0 as margin_pct
        from visits left join sales using (m, s, c, v)"""),
    "fct_product_performance": (("stg_order_items", "stg_refunds"), """
        with sales as (
            select product_id as p, date_trunc('month', created_at) as m, count(*) as units,
                   sum(price_usd) as revenue, sum(cogs_usd) as cogs, sum(margin_usd) as margin
            from stg_order_items group by p, m
        ), returned as (
            select i.product_id as p, date_trunc('month', r.created_at) as m, count(*) as n,
                   sum(r.refund_amount_usd) as amount
            from stg_refunds r, stg_order_items i where i.order_item_id = r.order_item_id
            group by p, m
        )
        select p as product_id, m as order_month, units as units_sold,
               cast(revenue as decimal(28,2)) as revenue, cast(cogs as decimal(28,2)) as cogs,
               cast(margin as decimal(29,2)) as margin,
               round(margin * 100.0 / nullif(revenue, 0), 2) + 0.0 as margin_pct,
               ifnull(n, 0) as refund_count,
               cast(ifnull(amount, 0) as decimal(38,2)) as refund_amount,
               cast(revenue - ifnull(amount, 0) as decimal(38,2)) as net_revenue
        from sales left join returned using (p, m)"""),
    "obt_orders_enriched": (("stg_orders", "stg_sessions", "stg_refunds"), """
        select o.order_id, o.created_at as order_date, order_month, website_session_id,
               o.user_id, primary_product_id, items_purchased, price_usd, cogs_usd, margin_usd,
               margin_pct, utm_source, utm_campaign, device_type, is_repeat_session, http_referer,
               ifnull(refund_amount_usd, 0) as refund_amount,
               order_item_refund_id is not null as has_refund,
               cast(price_usd - ifnull(refund_amount_usd, 0) as decimal(19,2)) as net_revenue
        from stg_orders o
        left join stg_sessions s using (website_session_id)
        left join stg_refunds r using (order_id)"""),
    "mart_github_summary": (("int_github_activity",), """
        select activity_month, cast(sum(total_count) as bigint) as total_activities,
               cast(ifnull(sum(total_count) filter (where activity_type = 'issue'), 0) as bigint)
                   as total_issues,
               cast(ifnull(sum(total_count) filter (where activity_type <> 'issue'), 0) as bigint)
                   as total_prs,
               cast(ifnull(sum(closed_count) filter (where activity_type = 'issue'), 0) as bigint)
                   as closed_issues,
               cast(ifnull(sum(closed_count) filter (where activity_type <> 'issue'), 0) as bigint)
                   as merged_prs,
               round(100.0 * closed_issues / nullif(total_issues, 0), 2) + 0.0
                   as issue_close_rate_pct,
               round(100.0 * merged_prs / nullif(total_prs, 0), 2) + 0.0 as pr_merge_rate_pct,
               max(unique_contributors) as unique_contributors,
               round(avg(avg_days_to_resolve), 1) + 0.0 as avg_days_to_resolve
        from int_github_activity group by activity_month"""),
    "station_history": (("int_hidro_diario",), """
        select *,
               lag(nivel_promedio) over days as nivel_promedio_anterior,
               round(avg(nivel_promedio) over (days rows 6 preceding), 3) + 0.0
                   as nivel_promedio_movil_7d,
               round(avg(nivel_promedio) over station, 3) + 0.0 as nivel_historico_estacion,
               round(avg(ph_promedio) over station, 2) + 0.0 as ph_historico_estacion,
               round(avg(temperatura_promedio) over station, 2) + 0.0 as temp_historica_estacion
        from int_hidro_diario
        window station as (partition by estacion),
               days as (partition by estacion order by fecha_dia, estacion_codigo)"""),
    "mart_hidro_resumen": (("station_history",), """
        select * exclude (conductividad_minima, conductividad_maxima, ph_minimo, ph_maximo,
                          turbidez_minima, turbidez_maxima, od_minimo, od_maximo,
                          temperatura_minima, temperatura_maxima, nivel_promedio_anterior),
               cast(year(fecha_dia) as integer) as anio,
               cast(month(fecha_dia) as integer) as mes,
               cast(weekofyear(fecha_dia) as integer) as semana,
               (['Domingo', 'Lunes', 'Martes', 'Miércoles', 'Jueves', 'Viernes', 'Sábado'])
                   [dayofweek(fecha_dia) + 1] as dia_semana,
               round(nivel_promedio - nivel_promedio_anterior, 3) + 0.0 as nivel_delta_dia_anterior,
               round(nivel_promedio - nivel_historico_estacion, 3) + 0.0
                   as nivel_desviacion_historica,
               case when nivel_promedio is null then 'sin_datos'
                    when nivel_historico_estacion is null then 'sin_referencia'
                    when nivel_promedio >= nivel_historico_estacion * 1.20 then 'crecida'
                    when nivel_promedio >= nivel_historico_estacion * 1.05 then 'alto'
                    when nivel_promedio <= nivel_historico_estacion * 0.80 then 'bajante'
                    when nivel_promedio <= nivel_historico_estacion * 0.95 then 'bajo'
                    else 'normal' end as condicion_nivel,
               case when ph_promedio < 6.5 then 'acido' when ph_promedio <= 8.5 then 'normal'
                    when ph_promedio > 8.5 then 'alcalino' else 'sin_datos' end as condicion_ph,
               case when turbidez_promedio < 5 then 'clara' when turbidez_promedio < 50 then 'turbia'
                    when turbidez_promedio >= 50 then 'muy_turbia' else 'sin_datos' end
                   as condicion_turbidez,
               case when od_promedio >= 5 then 'saludable' when od_promedio >= 3 then 'bajo'
                    when od_promedio < 3 then 'critico' else 'sin_datos' end as condicion_od
        from station_history"""),
    "mart_hidro_calidad": (("stg_hidro_mediciones",), """
        select *, round(100.0 * outliers_totales / (total_mediciones * 6), 2) + 0.0
                      as tasa_outliers_pct,
               case when tasa_outliers_pct >= 20 then 'mala' when tasa_outliers_pct >= 5 then 'regular'
                    when tasa_outliers_pct > 0 then 'buena' else 'optima' end as nivel_calidad
        from (
            select estacion, estacion_codigo, fecha_dia, count(*) as total_mediciones,
                   count(*) filter (where is_outlier_nivel = 1) as outliers_nivel,
                   count(*) filter (where is_outlier_conductividad = 1) as outliers_conductividad,
                   count(*) filter (where is_outlier_ph = 1) as outliers_ph,
                   count(*) filter (where is_outlier_turbidez = 1) as outliers_turbidez,
                   count(*) filter (where is_outlier_od = 1) as outliers_od,
                   count(*) filter (where is_outlier_temp = 1) as outliers_temperatura,
                   cast(sum(is_outlier_nivel + is_outlier_conductividad + is_outlier_ph
                            + is_outlier_turbidez + is_outlier_od + is_outlier_temp) as bigint)
                       as outliers_totales,
                   count(nivel_m) as mediciones_validas_nivel,
                   count(conductividad_us_cm) as mediciones_validas_conductividad,
                   count(ph) as mediciones_validas_ph,
                   count(turbidez_ntu) as mediciones_validas_turbidez,
                   count(od_mg_l) as mediciones_validas_od,
                   count(temp_agua_c) as mediciones_validas_temperatura
            from stg_hidro_mediciones group by all
        )"""),
    "mart_pokemon_analytics": (("stg_pokemon",), """
        select * exclude (height, weight, types, loaded_at_known) replace (ifnull(secondary_type, 'none') as secondary_type),
               hp + attack + defense + special_attack + special_defense + speed as total_base_stats,
               round(weight_kg / nullif(height_meters ** 2, 0), 2) + 0.0 as bmi_index,
               attack + special_attack as total_attack_power,
               defense + special_defense as total_defense_power,
               case when total_base_stats >= 600 then 'legendary_tier'
                    when total_base_stats >= 500 then 'strong'
                    when total_base_stats >= 400 then 'average' else 'weak' end as power_tier,
               case sign(attack - special_attack) when 1 then 'physical_attacker'
                    when -1 then 'special_attacker' else 'balanced' end as attack_style
        from stg_pokemon"""),
}


def needed(names: tuple[str, ...]) -> list[str]:
    """The relations and all they read, each after what it reads."""
    order: list[str] = []
    for name in names:
        for earlier in [*needed(RELATIONS[name][0]), name]:
            if earlier not in order:
                order.append(earlier)
    return order


def statement(body: str, *reads: str) -> str:
    """``body`` with the relations it reads in front of it."""
    named = [f"{name} as ({RELATIONS[name][1].strip()})" for name in needed(reads)]
    return f"with {', '.join(named)} {body.strip()}" if named else body.strip()
