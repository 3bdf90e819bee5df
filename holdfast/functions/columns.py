"""Column expressions shared by the operators. All run inside codegen."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def instant(value: datetime | date | str) -> Column:
    """A zone-less timestamp literal, so comparisons push down to the scan."""
    if isinstance(value, datetime):
        value = value.isoformat(sep=" ")
    return F.lit(str(value)).cast("timestamp_ntz")


def days_before(as_of: datetime | str, days: int) -> Column:
    return instant(as_of) - F.expr(f"INTERVAL '{int(days)}' DAY")


def within(ts: Column, as_of: datetime | str, days: int) -> Column:
    """``ts`` lies in ``[as_of - days, as_of)``."""
    return (ts >= days_before(as_of, days)) & (ts < instant(as_of))


def elapsed_days(start: Column, end: Column) -> Column:
    """Whole days of elapsed time between two zone-less timestamps."""
    return F.extract(F.lit("DAY"), end - start).cast("int")


def timestamp_text(value: datetime | date | str) -> str:
    """The same literal as SQL text. Wide column lists are SQL text: one call each from Python."""
    if isinstance(value, datetime):
        value = value.isoformat(sep=" ")
    return f"TIMESTAMP_NTZ '{value}'"


def within_text(ts: str, as_of: datetime | str, days: int) -> str:
    now = timestamp_text(as_of)
    return f"({ts} >= {now} - INTERVAL '{int(days)}' DAY AND {ts} < {now})"


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division on doubles; NULL when the denominator is 0."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def ratio_text(numerator: str, denominator: str) -> str:
    return f"try_divide(CAST({numerator} AS DOUBLE), CAST({denominator} AS DOUBLE))"


def flag_text(condition: str) -> str:
    """1 if true; 0 if false or unknown."""
    return f"coalesce(CAST({condition} AS INT), 0)"


def elapsed_days_text(start: str, end: str) -> str:
    return f"CAST(extract(DAY FROM ({end} - {start})) AS INT)"


def expressions(columns: dict[str, str]) -> dict[str, Column]:
    return {name: F.expr(text) for name, text in columns.items()}


def cents(amount: Column) -> Column:
    """A two-decimal amount as a whole number, so sums do not depend on row order."""
    return F.rint(amount.cast("double") * 100).cast("bigint")


def from_cents(total: Column) -> Column:
    return total.cast("double") / 100


def right_closed_bins(value: str, edges: list[float | None], labels: list[str]) -> str:
    """SQL text: label of the bin ``(edges[i], edges[i+1]]``, NULL outside. A last edge of None is open."""
    cases = [
        f"WHEN {value} > {low}" + ("" if high is None else f" AND {value} <= {high}") + f" THEN '{label}'"
        for low, high, label in zip(edges, edges[1:], labels)
    ]
    return f"CASE {' '.join(cases)} END"


def unit_hash(*parts: Column | str) -> Column:
    """Number in [0, 1) from the first 8 hex digits of an MD5; the same on every run and engine."""
    texts = [F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts]
    digits = F.substring(F.md5(F.concat(*texts)), 1, 8)
    return F.conv(digits, 16, 10).cast("bigint") / F.lit(float(2**32))
