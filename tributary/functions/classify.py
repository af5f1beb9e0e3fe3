"""Lookups, value ranges and ordered threshold classes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F


def lookup(key: Column, names: Mapping, otherwise: Column | None = None) -> Column:
    """Map fixed keys to names; other keys give ``otherwise`` (NULL if absent)."""
    pairs = iter(names.items())
    first, label = next(pairs)
    mapped = F.when(key == first, label)
    for value, label in pairs:
        mapped = mapped.when(key == value, label)
    return mapped if otherwise is None else mapped.otherwise(otherwise)


def bands(rules: Sequence[tuple[Column, str]], otherwise: str) -> Column:
    """Label of the first rule that holds; a NULL comparison does not hold."""
    labelled = F.when(*rules[0])
    for condition, label in rules[1:]:
        labelled = labelled.when(condition, label)
    return labelled.otherwise(otherwise)


def keep_within(value: Column, low: float, high: float) -> Column:
    """The value inside the closed range, else NULL."""
    return F.when(value.between(low, high), value)


def outside_flag(value: Column, low: float, high: float) -> Column:
    """1 for a value outside the closed range, 0 inside it or where absent."""
    return F.when(~value.between(low, high), 1).otherwise(0)
