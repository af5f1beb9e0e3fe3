"""Checks on tables that do and do not violate them."""

import pytest
from conftest import ts, values

from tributary.operators.checks import (
    Check,
    foreign_values,
    offending_rows,
    outcomes,
    repeated_values,
)
from tributary.plans.quality import CHECKS, ChecksFailed, enforce, run_checks, summarize

SCHEMA = "id long, kind string, size double, seen timestamp_ntz"


def table(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


CLEAN = [(1, "a", 1.0, ts("2020-01-01")), (2, None, None, None)]
CASES = [
    # rule and settings, violating rows, failures
    (Check("t", "unique", "id"), [(1, "a", 1.0, None), (1, "b", 1.0, None), (1, "b", 1.0, None),
                                  (None, "a", 1.0, None), (None, "a", 1.0, None)], 1),
    (Check("t", "not_null", "id"), [(None, "a", 1.0, None), (None, "b", 1.0, None)], 2),
    (Check("t", "accepted_values", "kind", values=("a", "b")),
     [(1, "x", 1.0, None), (2, "x", 1.0, None), (3, "y", 1.0, None), (4, None, 1.0, None)], 2),
    (Check("t", "between", "size", low=0, high=1),
     [(1, "a", -0.1, None), (2, "a", 1.1, None), (3, "a", 1.0, None), (4, "a", None, None)], 2),
    (Check("t", "between", "size", low=0, high=1, row_condition="kind = 'a'"),
     [(1, "a", 2.0, None), (2, "b", 2.0, None), (3, None, 2.0, None)], 1),
    (Check("t", "row_count", low=1, high=2), [(n, "a", 1.0, None) for n in range(3)], 1),
    (Check("t", "at_least", "size", low=-5), [(1, "a", -5.0, None), (2, "a", -5.1, None)], 1),
    (Check("t", "not_in_future", "seen"), [(1, "a", 1.0, ts("2999-01-01"))], 1),
    (Check("t", "no_duplicates", "kind"), [(1, None, 1.0, None), (2, None, 1.0, None)], 1),
]


@pytest.mark.parametrize("check, rows, failures", CASES, ids=lambda case: getattr(case, "rule", None))
def test_rule(spark, check, rows, failures):
    [row] = outcomes({"t": table(spark, *rows)}, [check]).collect()
    assert (row.failures, row.status) == (failures, "error")
    [row] = outcomes({"t": table(spark, *CLEAN)}, [check]).collect()
    assert (row.failures, row.status) == (0, "pass")


def test_many_tables_in_one_run(spark):
    checks = [
        Check("t", "unique", "id", "warn"),
        Check("u", "not_null", "kind"),
        Check("u", "row_count", low=5, high=9),
    ]
    tables = {"t": table(spark, *CLEAN, *CLEAN), "u": table(spark, *CLEAN)}
    results = outcomes(tables, checks)
    assert values(results, "model", "failures", "status") == [
        ("t", 2, "warn"), ("u", 1, "error"), ("u", 1, "error"),
    ]
    assert values(summarize(results)) == [("error", 2), ("warn", 1)]
    with pytest.raises(ChecksFailed, match="u.kind.not_null, u.row_count"):
        enforce(results)


def test_empty_table(spark):
    checks = [Check("t", "unique", "id"), Check("t", "row_count", low=1, high=2)]
    got = values(outcomes({"t": table(spark)}, checks), "check", "failures")
    assert got == [("t.id.unique", 0), ("t.row_count", 1)]


def test_warnings_do_not_fail_the_run(spark):
    results = outcomes({"t": table(spark, *CLEAN)}, [Check("t", "not_null", "kind", "warn")])
    assert [row.status for row in enforce(results)] == ["warn"]


def test_failing_rows_and_values(spark):
    df = table(spark, (1, "a", 9.0, None), (1, None, 1.0, None), (2, None, 1.0, None))
    assert values(repeated_values(df, "id")) == [(1, 2)]
    assert values(repeated_values(df, "kind")) == []
    assert values(repeated_values(df, "kind", ignore_null=False)) == [(None, 2)]
    assert values(foreign_values(df, Check("t", "accepted_values", "kind", values=("b",)))) == [("a", 1)]
    assert values(offending_rows(df, Check("t", "between", "size", low=0, high=5)), "id") == [(1,)]


def test_settings():
    assert len(CHECKS) == len({check.name for check in CHECKS}) == 72
    assert sum(check.severity == "warn" for check in CHECKS) == 13


def test_subset_of_models(spark):
    df = spark.createDataFrame([(1,), (1,)], "website_pageview_id long")
    results = run_checks(lambda name: df, ["stg_pageviews"])
    assert values(results, "check", "failures") == [
        ("stg_pageviews.website_pageview_id.not_null", 0),
        ("stg_pageviews.website_pageview_id.unique", 1),
    ]
    with pytest.raises(ValueError):
        run_checks(lambda name: df, ["int_hidro_diario"])
