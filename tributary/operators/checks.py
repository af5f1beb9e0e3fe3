"""Data checks: the offending rows of one rule, or the outcome of many in one pass."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, functions as F

from tributary.functions.temporal import WALL_CLOCK, utc_wall_clock

# What a rule counts as one failure.
ROWS = "rows"  # every row it marks
VALUES = "values"  # every distinct value it marks
REPEATS = "repeats"  # every value it marks more than once
TABLE = "table"  # the table, if its row count is out of range
# Tables whose jobs run side by side.
TABLES_AT_ONCE = 8
OUTCOMES = "check string, model string, column_name string, severity string, failures long, status string"


@dataclass(frozen=True)
class Check:
    """One rule on one column of a table.

    ``severity`` is ``error`` (fails the run) or ``warn`` (is reported). ``moment``
    stands in for the present time.
    """

    table: str
    rule: str
    column: str | None = None
    severity: str = "error"
    values: tuple[str, ...] = ()
    low: float | None = None
    high: float | None = None
    row_condition: str | None = None
    moment: str | None = None

    @property
    def name(self) -> str:
        return ".".join(part for part in (self.table, self.column, self.rule) if part)

    @property
    def counts(self) -> str:
        """How marked rows turn into failures."""
        kinds = {
            "unique": REPEATS,
            "no_duplicates": REPEATS,
            "accepted_values": VALUES,
            "row_count": TABLE,
        }
        return kinds.get(self.rule, ROWS)

    def marks(self) -> Column:
        """Rows the rule has to count. NULL, like false, marks nothing."""
        column = F.col(self.column) if self.column else None
        if self.rule == "unique":
            return column.isNotNull()
        if self.rule in ("no_duplicates", "row_count"):
            return F.lit(True)
        if self.rule == "not_null":
            return column.isNull()
        if self.rule == "accepted_values":
            return ~column.isin(*self.values)
        if self.rule == "between":
            outside = ~column.between(self.low, self.high)
            return outside if self.row_condition is None else F.expr(self.row_condition) & outside
        if self.rule == "at_least":
            return column < self.low
        if self.rule == "not_in_future":
            now = F.lit(self.moment).cast(WALL_CLOCK) if self.moment else utc_wall_clock()
            return column > now
        raise ValueError(f"unknown rule: {self.rule}")


def offending_rows(df: DataFrame, check: Check) -> DataFrame:
    """Rows that break a row-wise rule."""
    return df.where(check.marks())


def repeated_values(df: DataFrame, column: str, ignore_null: bool = True) -> DataFrame:
    """Values that occur more than once, with their number of rows."""
    rows = df.where(F.col(column).isNotNull()) if ignore_null else df
    counted = rows.groupBy(column).agg(F.count(F.lit(1)).alias("n_records"))
    return counted.where(F.col("n_records") > 1)


def foreign_values(df: DataFrame, check: Check) -> DataFrame:
    """Values outside the accepted list, with their number of rows."""
    marked = df.where(check.marks())
    return marked.groupBy(check.column).agg(F.count(F.lit(1)).alias("n_records"))


def _counted(check: Check) -> Column:
    """Failures of one rule over the whole table, unless it counts repeated values."""
    if check.counts == TABLE:
        # The count is of all rows, so that it has a value for an empty table as well.
        return F.when(F.count(F.lit(1)).between(check.low, check.high), 0).otherwise(1).cast("long")
    if check.counts == VALUES:
        return F.count_distinct(F.when(check.marks(), F.col(check.column)))
    return F.count(F.when(check.marks(), 1))


def _row_rules(df: DataFrame, checks: Sequence[tuple[int, Check]]) -> DataFrame:
    """(number, failures) of rules that one conditional aggregate counts, in one scan.

    Each task sends one row of counts, and the foreign values it met beside it.
    """
    counts = df.agg(*[_counted(check).alias(f"failures_{number}") for number, check in checks])
    pairs = [F.struct(F.lit(number).alias("number"), F.col(f"failures_{number}").alias("failures")) for number, _ in checks]
    return counts.select(F.inline(F.array(*pairs)))


def _repeats(df: DataFrame, number: int, check: Check) -> DataFrame:
    """(number, failures) of a rule on repeated values: a scan of one column, in its own type."""
    counted = df.where(check.marks()).groupBy(check.column).agg(F.count(F.lit(1)).alias("n"))
    return counted.agg(F.lit(number).alias("number"), F.count(F.when(F.col("n") > 1, 1)).alias("failures"))


def outcomes(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """Failures of all ``checks``: one aggregate per table, and one more per rule on repeats.

    Rules on rows, on the number of rows and on foreign values of a table are counted
    together while it is scanned once. What a column repeats is grouped by that column
    alone; counts are combined map-side, so a frequent value is no burden.

    Each table is a job of its own and several run side by side: one plan over all tables
    would be optimized anew whenever any part of it ends. What comes to the driver is a
    row per check.
    """

    def count(name: str) -> list[Row]:
        own = [(number, check) for number, check in enumerate(checks) if check.table == name]
        plain = [(number, check) for number, check in own if check.counts != REPEATS]
        found = [_row_rules(tables[name], plain)] if plain else []
        found += [_repeats(tables[name], number, check) for number, check in own if check.counts == REPEATS]
        return reduce(DataFrame.unionByName, found).collect() if found else []

    with ThreadPoolExecutor(max_workers=TABLES_AT_ONCE) as pool:
        rows = [row for found in pool.map(count, tables) for row in found]
    results = []
    for row in sorted(rows):
        check = checks[row["number"]]
        status = check.severity if row["failures"] else "pass"
        results.append((check.name, check.table, check.column, check.severity, row["failures"], status))
    return next(iter(tables.values())).sparkSession.createDataFrame(results, OUTCOMES)
