"""The models by name, what they read, and how they are built and stored."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import Future, ThreadPoolExecutor
from dataclasses import dataclass
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tributary.plans import intermediate, marts, staging
from tributary.sources.sinks import full_refresh
from tributary.sources.tables import Loader


@dataclass(frozen=True)
class Model:
    """``reads`` names the source tables and models passed to ``make``, in order."""

    make: Callable[..., DataFrame]
    reads: tuple[str, ...]
    stored: bool = False
    sorted: bool = False


MODELS = {
    "stg_sessions": Model(staging.stg_sessions, ("website_sessions",)),
    "stg_orders": Model(staging.stg_orders, ("orders",)),
    "stg_pageviews": Model(staging.stg_pageviews, ("website_pageviews",)),
    "stg_order_items": Model(staging.stg_order_items, ("order_items",)),
    "stg_refunds": Model(staging.stg_refunds, ("order_item_refunds",)),
    "stg_github_issues": Model(staging.stg_github_issues, ("issues",)),
    "stg_github_pull_requests": Model(staging.stg_github_pull_requests, ("pull_requests",)),
    "stg_pokemon": Model(staging.stg_pokemon, ("pokemon",)),
    "stg_hidro_mediciones": Model(
        staging.stg_hidro_mediciones,
        ("hidro_estacion_itabo_guazu", "hidro_estacion_pozuelo_puente"),
    ),
    "int_github_activity": Model(
        intermediate.int_github_activity,
        ("stg_github_issues", "stg_github_pull_requests"),
        sorted=True,
    ),
    "int_hidro_diario": Model(intermediate.int_hidro_diario, ("stg_hidro_mediciones",)),
    "fct_daily_sales": Model(
        marts.fct_daily_sales, ("stg_sessions", "stg_orders", "stg_refunds"), True, True
    ),
    "fct_channel_performance": Model(
        marts.fct_channel_performance, ("stg_sessions", "stg_orders"), True, True
    ),
    "fct_product_performance": Model(
        marts.fct_product_performance, ("stg_order_items", "stg_refunds"), True, True
    ),
    "obt_orders_enriched": Model(
        marts.obt_orders_enriched, ("stg_orders", "stg_sessions", "stg_refunds"), True
    ),
    "mart_github_summary": Model(marts.mart_github_summary, ("int_github_activity",), True, True),
    "mart_hidro_resumen": Model(marts.mart_hidro_resumen, ("int_hidro_diario",), True, True),
    "mart_hidro_calidad": Model(marts.mart_hidro_calidad, ("stg_hidro_mediciones",), True, True),
    "mart_pokemon_analytics": Model(marts.mart_pokemon_analytics, ("stg_pokemon",), True, True),
}

# Models that several others read and that are expensive to make; stored unless told otherwise.
SHARED = ("stg_hidro_mediciones",)

# Models whose jobs run side by side.
MODELS_AT_ONCE = 4

# Subsets that are usually built together.
SUBSETS = {
    "catalogue_and_activity": (
        "stg_pokemon",
        "stg_github_issues",
        "stg_github_pull_requests",
        "int_github_activity",
        "mart_pokemon_analytics",
        "mart_github_summary",
    ),
    "ecommerce": (
        "stg_sessions",
        "stg_orders",
        "stg_pageviews",
        "stg_order_items",
        "stg_refunds",
        "fct_daily_sales",
        "fct_channel_performance",
        "fct_product_performance",
        "obt_orders_enriched",
    ),
    "sensors": (
        "stg_hidro_mediciones",
        "int_hidro_diario",
        "mart_hidro_resumen",
        "mart_hidro_calidad",
    ),
}


def models_over(load: Loader) -> Callable[[str], DataFrame]:
    """Models by name as lazy DataFrames over ``load``; each is defined once.

    Models that others read are not sorted: sorted input would cost a range exchange and
    mean nothing to what reads it.
    """
    known: dict[str, DataFrame] = {}

    def get(name: str) -> DataFrame:
        if name not in MODELS:
            return load(name)
        if name not in known:
            known[name] = _make(name, get, in_order=False)
        return known[name]

    return get


def _make(name: str, get: Callable[[str], DataFrame], in_order: bool) -> DataFrame:
    chosen = MODELS[name]
    make = partial(chosen.make, in_order=in_order) if chosen.sorted else chosen.make
    return make(*[get(read) for read in chosen.reads])


def model(name: str, load: Loader, in_order: bool = True) -> DataFrame:
    """One model as a lazy DataFrame over its sources."""
    return _make(name, models_over(load), in_order)


def layer(name: str) -> str:
    """The layer a model belongs to: staging, intermediate or marts."""
    prefix = name.split("_")[0]
    return {"stg": "staging", "int": "intermediate"}.get(prefix, "marts")


def table_of(name: str, database: str, layered: bool = False) -> str:
    """Where a model is stored; ``layered`` gives each layer a database ``<database>_<layer>``."""
    return f"{database}_{layer(name)}.{name}" if layered else f"{database}.{name}"


def build(
    spark: SparkSession,
    load: Loader,
    database: str,
    names: Iterable[str] | None = None,
    keep: Iterable[str] = SHARED,
    in_order: bool = False,
    layered: bool = False,
) -> dict[str, DataFrame]:
    """Build models: marts as tables of ``database``, the others as temporary views.

    ``names`` restricts the build; models they depend on are computed as needed. A model
    in ``keep`` is stored although it is no mart, which pays when several marts read an
    expensive one; it also outlives the session, which a temporary view does not. What was
    stored here is read back by the models that follow. With ``layered``, staging,
    intermediate and mart tables go to databases of their own, made where they are missing.

    Models that do not read each other are built side by side, so that a small one does not
    leave a cluster idle. If one fails, the others are still built, except those that read
    it, and the failure is raised at the end.
    """
    wanted = set(MODELS) if names is None else set(names)
    keep = set(keep)
    unknown = sorted((wanted | keep) - set(MODELS))
    if unknown:
        raise KeyError(f"unknown models: {', '.join(unknown)}")
    # MODELS lists every model after those it reads, so a model that waits for another one
    # never keeps it from being started.
    chosen = [name for name in MODELS if name in wanted]
    kept = {name for name in chosen if MODELS[name].stored or name in keep}
    if layered:
        for used in sorted({layer(name) for name in kept}):
            spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}_{used}")
    building: dict[str, Future[DataFrame]] = {}

    def get(name: str) -> DataFrame:
        if name in building:
            return building[name].result()
        return _make(name, get, in_order=False) if name in MODELS else load(name)

    def make(name: str) -> DataFrame:
        df = _make(name, get, in_order and name in kept)
        if name not in kept:
            df.createOrReplaceTempView(name)
            return df
        table = table_of(name, database, layered)
        full_refresh(df, table)
        return spark.table(table)

    with ThreadPoolExecutor(max_workers=MODELS_AT_ONCE) as pool:
        for name in chosen:
            building[name] = pool.submit(make, name)
    return {name: made.result() for name, made in building.items()}
