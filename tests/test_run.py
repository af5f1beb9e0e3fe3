"""Whole runs and the command line, from JSON files to checked tables."""

import json

import pytest
from conftest import values

from tributary.__main__ import main
from tributary.plans.quality import ChecksFailed
from tributary.plans.run import run, select
from tributary.sources.tables import from_database


def record(minute, level):
    return {
        "fecha": f"2024-01-{1 + minute // 72:02} {minute // 3 % 24:02}:{minute % 3 * 20:02}:00 PYST",
        "nivel": level, "conductividad": 50, "ph": 7.1, "turbidez": 3, "od": 6.5, "tempagua": 22,
    }


@pytest.fixture
def stations(tmp_path):
    paths = {}
    for station, count in (("itabo_guazu", 700), ("pozuelo_puente", 500)):
        paths[station] = str(tmp_path / f"{station}.json")
        records = [record(n, 2.0 if n % 100 else 99) for n in range(count)]
        (tmp_path / f"{station}.json").write_text(json.dumps({"results": records}))
    return paths


def test_from_files_to_checked_tables(spark, database, stations):
    load = from_database(spark, database)
    outcomes = run(spark, load, database, stations, ["sensors"])
    assert {row.status for row in outcomes} == {"ok", "pass"}
    assert sum(row["rows"] for row in outcomes[:2]) == 1200
    days = spark.table(f"{database}.mart_hidro_calidad")
    assert values(days.where("outliers_nivel > 0"), "nivel_calidad")[0] == ("buena",)
    assert days.agg({"outliers_nivel": "sum"}).first()[0] == 12


def test_too_few_readings_fail_the_run(spark, database, tmp_path):
    paths = {}
    for station in ("itabo_guazu", "pozuelo_puente"):
        paths[station] = str(tmp_path / f"{station}.json")
        (tmp_path / f"{station}.json").write_text(json.dumps([record(1, 2.0)]))
    with pytest.raises(ChecksFailed, match="stg_hidro_mediciones.row_count") as failure:
        run(spark, from_database(spark, database), database, paths, ["sensors"])
    outcomes = failure.value.outcomes
    assert [row["rows"] for row in outcomes[:2]] == [1, 1]
    assert {row["failures"] for row in outcomes[2:] if row["check"].endswith("row_count")} == {1}


def test_a_failing_command_line_reports_everything(spark, database, tmp_path, capsys):
    path = tmp_path / "s.json"
    path.write_text(json.dumps([record(1, 2.0)]))
    pairs = [f for s in ("itabo_guazu", "pozuelo_puente") for f in ("--station", f"{s}={path}")]
    assert main(["build", "--database", database, "--select", "sensors", *pairs]) == 1
    shown = capsys.readouterr()
    assert shown.out.count("status='ok'") == 2 and "ERROR 1" in shown.out and "PASS" in shown.out
    assert "stg_hidro_mediciones.row_count" in shown.err


def test_command_line(spark, database, stations, capsys):
    pairs = [word for name, path in stations.items() for word in ("--station", f"{name}={path}")]
    assert main(["ingest", "--database", database, *pairs]) == 0
    assert "status='ok'" in capsys.readouterr().out
    assert main(["run", "--database", database, "--select", "sensors"]) == 0
    other = spark.newSession()
    assert other.table(f"{database}.mart_hidro_resumen").count() > 0
    assert other.table(f"{database}.int_hidro_diario").count() > 0
    assert main(["test", "--database", database, "--select", "mart_hidro_calidad"]) == 0
    assert capsys.readouterr().out.count("status='pass'") == 4


def test_selection():
    assert select(["sensors", "stg_orders"])[-1] == "stg_orders"
    assert len(select(["sensors", "stg_orders"])) == 5
    with pytest.raises(KeyError):
        select(["nothing"])
