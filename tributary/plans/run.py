"""Whole runs: ingest, then build, then check, each of them optional."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from tributary.plans.models import MODELS, SUBSETS, build, models_over, table_of
from tributary.plans.quality import CHECKS, enforce, run_checks
from tributary.sources.ingest import load_stations
from tributary.sources.tables import Loader


def select(names: Iterable[str]) -> list[str]:
    """Model names from a mix of model names and subset names."""
    chosen: list[str] = []
    for name in names:
        chosen += SUBSETS.get(name, (name,))
    unknown = [name for name in chosen if name not in MODELS]
    if unknown:
        raise KeyError(f"unknown models: {', '.join(unknown)}")
    return chosen


def check(
    load: Loader,
    names: Iterable[str] | None = None,
    built: Mapping[str, DataFrame] | None = None,
    before: list | None = None,
) -> list:
    """Check models, reading those in ``built`` and defining the others over ``load``.

    Returns one row per check and raises if a check of severity ``error`` failed.
    """
    built = built or {}
    defined = models_over(load)
    checked = {rule.table for rule in CHECKS}
    chosen = checked if names is None else checked.intersection(names)
    if not chosen:
        return []
    results = run_checks(lambda name: built[name] if name in built else defined(name), chosen)
    return enforce(results, before)


def stored(spark: SparkSession, database: str, layered: bool = False) -> dict[str, DataFrame]:
    """The models that exist as tables of ``database``, or of its layers' databases."""
    tables = {name: table_of(name, database, layered) for name in MODELS}
    return {
        name: spark.table(table)
        for name, table in tables.items()
        if spark.catalog.tableExists(table)
    }


def run(
    spark: SparkSession,
    load: Loader,
    database: str,
    stations: Mapping[str, str] | None = None,
    names: Iterable[str] | None = None,
    keep: Iterable[str] = (),
    whole_files: bool = False,
    transform: bool = True,
    test: bool = True,
    layered: bool = False,
) -> list:
    """Ingest ``stations`` into ``database``, build models there and check them.

    A station that fails is reported and its previous landing table stays in use, so the
    models are built from what there is. Returns the outcomes of stations and checks; if a
    check fails the run, the error carries them.
    """
    outcomes: list = []
    if stations:
        outcomes += load_stations(spark, stations, database, whole_files=whole_files).collect()
    chosen = None if names is None else select(names)
    built = build(spark, load, database, chosen, keep, layered=layered) if transform else {}
    if test:
        outcomes += check(load, chosen, built, outcomes)
    return outcomes
