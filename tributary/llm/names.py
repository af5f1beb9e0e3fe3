"""Column names that cannot clash."""

from __future__ import annotations

from pyspark.sql import DataFrame


def unused(df: DataFrame, *wanted: str) -> list[str]:
    """For each wanted name one like it that ``df`` does not have, in any case."""
    taken = {name.lower() for name in df.columns}
    found = []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def quoted(name: str) -> str:
    """A column's name as it is written in ``F.col``, whatever signs it has."""
    return "`" + name.replace("`", "``") + "`"
