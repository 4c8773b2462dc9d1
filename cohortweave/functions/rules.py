"""Ordered rules, code predicates and NULL policies as Column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DROP, KEEP = "drop", "keep"
PROPAGATE, SKIP = "propagate", "skip"


def first_match(rules: Sequence[tuple[Column, object]], default: object = None) -> Column:
    """Value of the first true condition; a NULL condition does not match."""
    result = None
    for condition, value in rules:
        value = value if isinstance(value, Column) else F.lit(value)
        result = F.when(condition, value) if result is None else result.when(condition, value)
    default = default if isinstance(default, Column) else F.lit(default)
    return result.otherwise(default)


def label_rules(df: DataFrame, out: str, rules: Sequence[tuple[Column, object]], default: object = None) -> DataFrame:
    return df.withColumn(out, first_match(rules, default))


def flag(condition: Column) -> Column:
    """0/1 integer; NULL counts as 0."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def head(column: str | Column, length: int | None) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return column if length is None else F.substring(column, 1, length)


def any_code(columns: Iterable[str], codes: Iterable[str], match_len: int | None = None) -> Column:
    """True where the first ``match_len`` characters (or all) of any column are in the list."""
    codes = list(codes)
    return reduce(lambda a, b: a | b, [head(c, match_len).isin(codes) for c in columns])


def no_code(columns: Iterable[str], codes: Iterable[str], null_policy: str = DROP) -> Column:
    """True where no column holds a listed code.

    ``drop`` leaves a NULL code undecided, as ``NOT (NULL IN ..)`` does, so a filter
    drops the row; ``keep`` treats a NULL code as not listed.
    """
    if null_policy not in (DROP, KEEP):
        raise ValueError(f"null_policy must be {DROP!r} or {KEEP!r}")
    codes = list(codes)

    def listed(c: str) -> Column:
        hit = F.col(c).isin(codes)
        return hit if null_policy == DROP else F.coalesce(hit, F.lit(False))

    return reduce(lambda a, b: a & b, [~listed(c) for c in columns])


def sum_where(value: str, condition: Column, null_policy: str = PROPAGATE) -> Column:
    """Conditional sum. ``propagate``: one NULL among the matching rows makes the sum NULL."""
    total = F.sum(F.when(condition, F.col(value)))
    if null_policy == SKIP:
        return total
    if null_policy != PROPAGATE:
        raise ValueError(f"null_policy must be {PROPAGATE!r} or {SKIP!r}")
    rows = F.count(F.when(condition, F.lit(1)))
    known = F.count(F.when(condition, F.col(value)))
    return F.when(rows == known, total)
