"""Exact quantiles (linear interpolation) that stay exact beyond one task's memory."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

# values (rows x columns) one task may hold; both ways give the same result
ONE_PASS_VALUES = 200_000
_ACCURACY = 10_000


def exact_quantiles(
    df: DataFrame,
    columns: list[str],
    probabilities: list[float],
    rows: int | None = None,
    one_pass_values: int = ONE_PASS_VALUES,
) -> dict[str, list[float | None]]:
    """Quantiles of every column; NULLs are ignored, an all-NULL column gives None.

    Up to ``one_pass_values`` values (rows x columns) one aggregate does it.
    Above, an approximate sketch brackets every quantile; further passes count
    what lies below each bracket and the values inside, which are few.
    """
    if not columns:
        return {}
    rows = df.count() if rows is None else rows
    if rows * len(columns) <= one_pass_values:
        wanted = ", ".join(f"{p!r}D" for p in probabilities)
        found = df.selectExpr(*[f"percentile(CAST(`{c}` AS DOUBLE), array({wanted})) AS `{c}`" for c in columns]).first()
        return {c: list(found[c]) if found[c] is not None else [None] * len(probabilities) for c in columns}
    return _bracketed(df, columns, probabilities)


def _bracketed(df: DataFrame, columns: list[str], probabilities: list[float]) -> dict[str, list[float | None]]:
    out: dict[str, list[float | None]] = {c: [None] * len(probabilities) for c in columns}
    known = df.selectExpr(*[f"count(`{c}`) AS `{c}`" for c in columns]).first()
    columns = [c for c in columns if known[c]]
    if not columns:
        return out

    def around(c: str, p: float) -> tuple[float, float]:
        # the sketch's rank error on both sides, and one rank for the rounding of places
        margin = 2.0 / _ACCURACY + 2.0 / known[c]
        return max(0.0, p - margin), min(1.0, p + margin)

    numeric = {c: F.col(c).cast("double") for c in columns}
    sketch = df.agg(
        *[F.min(x).alias(f"min_{c}") for c, x in numeric.items()],
        *[F.max(x).alias(f"max_{c}") for c, x in numeric.items()],
        *[
            F.percentile_approx(x, [q for p in probabilities for q in around(c, p)], _ACCURACY).alias(f"q_{c}")
            for c, x in numeric.items()
        ],
    ).first()

    brackets: list[tuple[str, int, float, float]] = []
    for c in columns:
        for i, p in enumerate(probabilities):
            below, above = around(c, p)
            low = sketch[f"min_{c}"] if below == 0 else sketch[f"q_{c}"][2 * i]
            high = sketch[f"max_{c}"] if above == 1 else sketch[f"q_{c}"][2 * i + 1]
            brackets.append((c, i, low, high))

    below = df.agg(
        *[F.count_if(numeric[c] < low).alias(f"{i}|{c}") for c, i, low, _ in brackets],
    ).first()
    hits = [
        F.when(
            numeric[c].between(low, high),
            F.struct(F.lit(c).alias("column"), F.lit(i).alias("slot"), numeric[c].alias("value")),
        )
        for c, i, low, high in brackets
    ]
    counted = (
        df.select(F.explode(F.array_compact(F.array(*hits))).alias("hit"))
        .groupBy("hit.column", "hit.slot", "hit.value")
        .agg(F.count("*").alias("n"))
    )
    upto = W.partitionBy("column", "slot").orderBy("value")
    steps = counted.withColumn("last", F.sum("n").over(upto) - 1)

    def places(c: str, i: int) -> tuple[int, int]:
        place = probabilities[i] * (known[c] - 1)
        return math.floor(place) - below[f"{i}|{c}"], math.ceil(place) - below[f"{i}|{c}"]

    wanted = F.coalesce(
        *[
            F.when((F.col("column") == c) & (F.col("slot") == i), F.array(*map(F.lit, places(c, i))))
            for c, i, _, _ in brackets
        ]
    )
    first = F.col("last") - F.col("n") + 1
    picked = (
        steps.withColumn("rank", F.explode(wanted))
        .where((F.col("rank") >= first) & (F.col("rank") <= F.col("last")))
        .select("column", "slot", "rank", "value")
        .collect()
    )
    at = {(r["column"], r["slot"], r["rank"]): r["value"] for r in picked}
    for c, i, _, _ in brackets:
        place = probabilities[i] * (known[c] - 1)
        low, high = (at[c, i, rank] for rank in places(c, i))
        out[c][i] = low if low == high else (math.ceil(place) - place) * low + (place - math.floor(place)) * high
    return out
