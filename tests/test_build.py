"""Building models into a database, whole and in part, and checking what was built."""

import pytest
from conftest import values

from tributary.plans.models import MODELS, SUBSETS, build, model
from tributary.plans.quality import run_checks
from tributary.plans.run import stored
from tributary.sources import star_schema
from tributary.sources.tables import (
    SOURCE_TABLES,
    from_database,
    from_frames,
    from_parquet,
)

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def load(spark):
    return star_schema.loader(spark, FOLDER)


def test_every_model_follows_what_it_reads():
    seen = set()
    for name, chosen in MODELS.items():
        assert all(read in seen or read in SOURCE_TABLES for read in chosen.reads)
        seen.add(name)
    assert sorted(name for subset in SUBSETS.values() for name in subset) == sorted(MODELS)


def test_marts_are_tables_and_the_rest_views(spark, load, database):
    built = build(spark, load, database, SUBSETS["sensors"])
    assert set(built) == set(SUBSETS["sensors"])
    tables = {table.name for table in spark.catalog.listTables(database) if not table.isTemporary}
    assert tables == {"mart_hidro_resumen", "mart_hidro_calidad", "stg_hidro_mediciones"}
    assert spark.table("int_hidro_diario").count() == built["mart_hidro_resumen"].count()


def test_kept_model_is_stored_and_read_back(spark, load, database):
    build(spark, load, database, SUBSETS["sensors"], keep=["int_hidro_diario"])
    stored = spark.table(f"{database}.mart_hidro_calidad")
    assert values(stored) == values(model("mart_hidro_calidad", load))
    assert spark.catalog.tableExists(f"{database}.int_hidro_diario")


def test_one_mart_alone_and_again(spark, load, database):
    for _ in range(2):
        built = build(spark, load, database, ["fct_daily_sales"], in_order=True)
    assert list(built) == ["fct_daily_sales"]
    assert values(built["fct_daily_sales"]) == values(model("fct_daily_sales", load))


def test_layers_have_databases_of_their_own(spark, load, database):
    try:
        built = build(spark, load, database, SUBSETS["sensors"], layered=True)
        tables = {
            f"{part}.{table.name}"
            for part in ("staging", "intermediate", "marts")
            if spark.catalog.databaseExists(f"{database}_{part}")
            for table in spark.catalog.listTables(f"{database}_{part}")
            if not table.isTemporary
        }
        assert tables == {
            "staging.stg_hidro_mediciones", "marts.mart_hidro_resumen", "marts.mart_hidro_calidad",
        }
        assert [t for t in spark.catalog.listTables(database) if not t.isTemporary] == []
        found = stored(spark, database, layered=True)
        assert values(found["mart_hidro_calidad"]) == values(built["mart_hidro_calidad"])
    finally:
        for part in ("staging", "marts"):
            spark.sql(f"DROP DATABASE IF EXISTS {database}_{part} CASCADE")


def test_a_failing_model_stops_only_what_reads_it(spark, load, database):
    def without_orders(name):
        if name == "orders":
            raise OSError("no orders today")
        return load(name)

    names = ["stg_orders", "fct_daily_sales", "fct_product_performance", "mart_hidro_calidad"]
    with pytest.raises(OSError, match="no orders today"):
        build(spark, without_orders, database, names)
    tables = {table.name for table in spark.catalog.listTables(database) if not table.isTemporary}
    assert tables == {"fct_product_performance", "mart_hidro_calidad"}


def test_unknown_names(spark, load, database):
    with pytest.raises(KeyError, match="no_such"):
        build(spark, load, database, ["no_such"])
    with pytest.raises(KeyError):
        build(spark, load, database, [], keep=["no_such"])


def test_checks_run_on_what_was_built(spark, load, database):
    built = build(spark, load, database, SUBSETS["sensors"])
    checked = [name for name in built if name.startswith(("stg", "mart"))]
    results = run_checks(built.__getitem__, checked)
    assert results.where("status <> 'pass'").count() == 0


def test_sources_from_files_tables_and_frames(spark, database, tmp_path):
    df = spark.range(3).withColumnRenamed("id", "website_pageview_id")
    df.write.parquet(str(tmp_path / "website_pageviews"))
    df.write.saveAsTable(f"{database}.website_pageviews")
    loaders = (
        from_parquet(spark, str(tmp_path)),
        from_database(spark, database),
        from_frames({"website_pageviews": df}),
    )
    for load in loaders:
        assert load("website_pageviews").count() == 3
        with pytest.raises(KeyError):
            load("no_such_source")
