"""Data assertions: one row per check with the number of failures.

All column checks of a table fold into one aggregate scan; uniqueness and
relationships need a shuffle of the key column only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

RESULT_SCHEMA = "check string, column string, failures bigint, severity string"


class CheckFailure(AssertionError):
    """An assertion of severity `error` has failing rows."""


@dataclass(frozen=True)
class Rule:
    """A row-level rule: `bad` is true for a failing row and never null."""

    check: str
    column: str
    bad: Column
    severity: str = "error"


def not_null(column: str, severity: str = "error") -> Rule:
    """Q2."""
    return Rule("not_null", column, F.col(column).isNull(), severity)


def accepted_values(column: str, values: Sequence, severity: str = "error") -> Rule:
    """Q3; null passes."""
    bad = F.coalesce(~F.col(column).isin(*values), F.lit(False))
    return Rule("accepted_values", column, bad, severity)


def accepted_range(column: str, low, high, severity: str = "error") -> Rule:
    """Q4, both ends allowed; null passes."""
    bad = F.coalesce(~F.col(column).between(low, high), F.lit(False))
    return Rule("accepted_range", column, bad, severity)


def parsed(source: str, column: str, severity: str = "warn") -> Rule:
    """Text that is there but came out as null, such as a malformed time."""
    given = F.coalesce(F.trim(source) != "", F.lit(False))
    return Rule("parsed", source, given & F.col(column).isNull(), severity)


def check_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """All row-level rules of a table in one aggregate."""
    counts = df.agg(*[F.count_if(rule.bad).alias(f"_{i}") for i, rule in enumerate(rules)])
    results = F.array(
        *[
            F.struct(
                F.lit(rule.check).alias("check"),
                F.lit(rule.column).alias("column"),
                F.col(f"_{i}").alias("failures"),
                F.lit(rule.severity).alias("severity"),
            )
            for i, rule in enumerate(rules)
        ]
    )
    return counts.select(F.inline(results))


def check_unique(df: DataFrame, column: str, severity: str = "error") -> DataFrame:
    """Q1: number of repeated non-null values."""
    repeated = (
        df.select(column)
        .where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count("*").alias("n"))
        .where("n > 1")
    )
    return repeated.agg(F.count("*").alias("failures")).select(
        F.lit("unique").alias("check"),
        F.lit(column).alias("column"),
        "failures",
        F.lit(severity).alias("severity"),
    )


def check_relationships(
    child: DataFrame, parent: DataFrame, column: str, field_name: str, severity: str = "error"
) -> DataFrame:
    """Q5: child rows whose non-null key has no parent.

    Rows are counted per key before the join, so a hot key is one row in it.
    """
    keys = (
        child.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    )
    orphans = keys.join(parent.select(F.col(field_name).alias(column)), column, "left_anti")
    return orphans.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("failures")).select(
        F.lit("relationships").alias("check"),
        F.lit(column).alias("column"),
        "failures",
        F.lit(severity).alias("severity"),
    )


def source_freshness(
    df: DataFrame, source: str, column: str, as_of: Column, warn_hours: float = 2, error_hours: float = 12
) -> DataFrame:
    """Q7: newest row of a source against `as_of`."""
    newest = df.agg(F.max(column).alias("latest_at"))
    hours = (F.unix_micros(as_of) - F.unix_micros("latest_at")) / F.lit(3_600_000_000.0)
    status = (
        F.when(hours.isNull() | (hours > error_hours), "error")
        .when(hours > warn_hours, "warn")
        .otherwise("pass")
    )
    return newest.select(
        F.lit(source).alias("source"),
        "latest_at",
        F.round(hours, 6).alias("age_hours"),
        status.alias("status"),
    )


@dataclass(frozen=True)
class TableChecks:
    """The assertions of one table."""

    rows: Sequence[Rule] = ()
    unique: Sequence[str] = ()
    parents: Sequence[tuple[str, DataFrame, str]] = field(default=())


def run_checks(df: DataFrame, checks: TableChecks) -> DataFrame:
    """Every assertion of a table as one result set."""
    parts = [check_unique(df, column) for column in checks.unique]
    if checks.rows:
        parts.append(check_rows(df, checks.rows))
    parts += [check_relationships(df, parent, c, f) for c, parent, f in checks.parents]
    return reduce(DataFrame.unionByName, parts)


def enforce(results: DataFrame) -> list:
    """Raise if an `error` check fails; return the failing `warn` rows (Q6).

    The result set has one row per declared check.
    """
    failing = results.where("failures > 0").collect()
    errors = [row for row in failing if row.severity == "error"]
    if errors:
        raise CheckFailure("; ".join(f"{r.check}({r.column}): {r.failures}" for r in errors))
    return failing
