"""Support ticket rollup and rates."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.functions.columns import elapsed_days_text, expressions, ratio_text, timestamp_text


def support_rollup(tickets: DataFrame) -> DataFrame:
    """Rolled up by (customer, category) first, so distinct categories need no row expansion."""
    by_category = tickets.groupBy("customer_id", "issue_category").agg(
        F.expr("count(*) AS _n"),
        F.expr("count_if(status = 'resolved') AS _resolved"),
        F.expr("count_if(status = 'open') AS _open"),
        F.expr("sum(CAST(rint(CAST(resolution_time_hours AS DOUBLE) * 100) AS BIGINT)) AS _time"),
        F.expr("count(resolution_time_hours) AS _timed"),
        F.expr("max(created_date) AS _last"),
    )
    return by_category.groupBy("customer_id").agg(
        F.expr("sum(_n) AS support_ticket_count"),
        F.expr("sum(_resolved) AS resolved_tickets"),
        F.expr("sum(_open) AS open_tickets"),
        F.expr(f"{ratio_text('sum(_time) / 100D', 'sum(_timed)')} AS avg_resolution_time"),
        F.expr("max(_last) AS last_ticket_date"),
        F.expr("count(issue_category) AS unique_issue_categories"),
    )


def rates(as_of: datetime | str) -> dict[str, str]:
    return {
        "support_resolution_rate": ratio_text("resolved_tickets", "support_ticket_count + 1"),
        "support_open_rate": ratio_text("open_tickets", "support_ticket_count + 1"),
        "days_since_last_ticket": elapsed_days_text("last_ticket_date", timestamp_text(as_of)),
    }


def support_features(rollup: DataFrame, as_of: datetime | str) -> DataFrame:
    return rollup.withColumns(expressions(rates(as_of)))
