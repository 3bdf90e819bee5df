"""Queries over states that are kept between runs, streams into them, layouts and sketches, each with its SQL."""

from __future__ import annotations

import uuid
from datetime import datetime

from pyspark.sql import functions as F

from checks import views as v
from checks.feature_queries import _RFM_OUT, _TABLE_OUT, ACTIVITY, AS_OF, ORDER_DEPENDENT, features, profiles, tidy
from checks.registry import ORACLE, query
from checks.scoring_queries import LABEL_AS_OF, MOMENTS
from checks.views import ALL_VIEWS, sql
from holdfast.functions import gram
from holdfast.operators import file_increments, incremental, monitoring, panes, scoring, sketches
from holdfast.plans import features as plan
from holdfast.plans import timeline
from holdfast.session import pinned, scratch_path
from holdfast.sources import bucketed, scans, snapshots
from holdfast.sources import fixtures as fx
from holdfast.streaming import engagement as stream
from holdfast.streaming import rollup, sessions

_TX = ["customer_id", "transaction_id", "transaction_date", "transaction_amount"]


def _year(df):
    return df.select(*_TX, F.year("transaction_date").alias("year"))


@query(ORACLE["incremental_rollup"])
def incremental_files(spark, folder):
    """Files of years: loaded without every third transaction before the label time first, then the years that changed are read."""
    path = scratch_path(spark, "by-file")
    tx = _year(fx.transactions(spark, folder))
    old = tx.where((F.col("transaction_date") < F.lit(LABEL_AS_OF).cast("timestamp_ntz")) & ((F.col("transaction_id") % 3 > 0) | (F.col("year") % 2 == 0)))
    kept = old.where("year % 2 = 0")
    old.write.partitionBy("year").parquet(f"{path}/in")
    file_increments.refresh(spark, f"{path}/in", old.schema, f"{path}/state")
    later = tx.join(F.broadcast(kept.select("year").distinct()), "year", "left_anti").select(tx.columns)
    later.write.option("partitionOverwriteMode", "dynamic").mode("overwrite").partitionBy("year").parquet(f"{path}/in")
    rest = tx.join(F.broadcast(kept.select("year").distinct()), "year", "left_semi").where(F.col("transaction_date") >= F.lit(LABEL_AS_OF).cast("timestamp_ntz"))
    rest.select(tx.columns).write.mode("append").partitionBy("year").parquet(f"{path}/in")
    file_increments.refresh(spark, f"{path}/in", old.schema, f"{path}/state")
    return tidy(incremental.rollup_of(file_increments.current(spark, f"{path}/state")), {"std_transaction"})


@query(ORACLE["incremental_rollup"])
def stream_rollup(spark, folder):
    """Transactions arrive in eight files, two a batch, and are merged into the state; it is compacted on the way."""
    path = scratch_path(spark, "stream-rollup")
    tx = fx.transactions(spark, folder).select(*_TX)
    tx.repartition(8, "transaction_id").write.parquet(f"{path}/in")
    arriving = stream.read_stream(spark, f"{path}/in", tx.schema, files_per_batch=2)
    rollup.start(arriving, f"{path}/state", f"{path}/checkpoint", compact=3).awaitTermination()
    return tidy(incremental.rollup_of(rollup.state(spark, f"{path}/state")), {"std_transaction"})


@query(ORACLE["sessionize_events"])
def stream_sessions(spark, folder):
    """Sessions that the stream has sealed, and the open ones from its state."""
    path = scratch_path(spark, "stream-sessions")
    raw = fx.table(spark, folder, "events")
    found = sessions.sessions(fx.as_user_events(stream.read_stream(spark, folder, raw.schema, "events.parquet")))
    stream.start(found, f"{path}/out", f"{path}/checkpoint").awaitTermination()
    sealed = spark.read.schema(found.schema).parquet(f"{path}/out")
    return sealed.unionByName(sessions.open_sessions(spark, f"{path}/checkpoint"))


# an as-of time within a day, so that every window has two edge days
PANES_AS_OF = "2001-05-02 13:30:00"


@query(sql(f"SELECT {_RFM_OUT} FROM rfm", ("transactions",), v.rfm(f"TIMESTAMP '{PANES_AS_OF}'")))
def rfm_from_panes(spark, folder):
    tx = fx.transactions(spark, folder)
    daily = pinned(incremental.partial_state(tx), "panes")
    return tidy(panes.rfm_from_panes(daily, tx, PANES_AS_OF))


@query(sql(f"SELECT {_TABLE_OUT} FROM features", ALL_VIEWS, v.feature_ctes()))
def bucketed_features(spark, folder):
    """The feature table from sources written in buckets by customer."""
    path, prefix = scratch_path(spark, "bucketed"), f"snapshot_{uuid.uuid4().hex}"
    tables = fx.all_tables(spark, folder)
    names = [n for n in tables if n != "customers"]
    laid = bucketed.bucketed_sources({n: tables[n] for n in names}, path, prefix, 16)
    wide = tidy(plan.build_features(profiles(spark, folder), tables | laid, AS_OF, ACTIVITY))
    bucketed.drop_tables(spark, laid, prefix)
    return wide


@query(sql(
    """SELECT customer_id, count(DISTINCT product_category) AS exact, true AS within_bound FROM transaction_lines GROUP BY 1""",
    ("transaction_lines",),
))
def distinct_sketches(spark, folder):
    """Product categories per customer from daily sketches, held against the exact number: within four standard errors and one."""
    lines = fx.transaction_lines(spark, folder)
    daily = sketches.daily_distinct(lines, "product_category", "transaction_date")
    estimated = sketches.merged_distinct(daily, "estimate", "customer_id")
    exact = lines.groupBy("customer_id").agg(F.count_distinct("product_category").alias("exact"))
    near = F.abs(F.col("estimate") - F.col("exact")) <= 4 * 1.04 / 64 * F.col("exact") + 1
    return exact.join(estimated, "customer_id").select("customer_id", "exact", near.alias("within_bound"))


DRIFT_COLUMNS = ["total_spent_365d", "transaction_count_365d", "avg_transaction_365d"]


@query()
def snapshot_sketch_drift(spark, folder):
    """Drift of the newest windows against three older snapshots, of which sketches only are read; tests compare with the exact index."""
    path = scratch_path(spark, "sketches")
    rows = timeline.rfm_at_times(fx.transactions(spark, folder), list(MOMENTS), (365,))
    rows = pinned(rows, "times")
    for moment in MOMENTS:
        at = rows.where(F.col("as_of") == F.lit(moment).cast("timestamp_ntz"))
        kept = sketches.snapshot_sketches(at, DRIFT_COLUMNS)
        snapshots.write_snapshot(kept, path, datetime.fromisoformat(moment))
    stored = snapshots.read_snapshots(spark, path)
    newest = stored.where(F.col("snapshot_ts") == snapshots.snapshot_key(datetime.fromisoformat(MOMENTS[-1])))
    found = None
    for moment in MOMENTS[:-1]:
        key = snapshots.snapshot_key(datetime.fromisoformat(moment))
        one = sketches.sketch_drift_psi(stored.where(F.col("snapshot_ts") == key), newest).withColumn("against", F.lit(key))
        found = one if found is None else found.unionByName(one)
    return found


_TIMES = " UNION ALL ".join(
    f"SELECT TIMESTAMP '{m}' AS as_of, * FROM ({v.rfm_window(365, f'''TIMESTAMP '{m}' ''')})" for m in MOMENTS
)


@query(sql(
    "SELECT as_of, customer_id, transaction_count_365d, total_spent_365d, avg_transaction_365d, "
    f"round(std_transaction_365d, 4) AS std_transaction_365d, min_transaction_365d, max_transaction_365d, recency_days_365d FROM ({_TIMES})",
    ("transactions",),
))
def rfm_at_times(spark, folder):
    return tidy(timeline.rfm_at_times(fx.transactions(spark, folder), list(MOMENTS), (365,)))


_DRIFT_TIMES = ", ".join(f"(TIMESTAMP '{m}')" for m in MOMENTS)


@query(sql(
    f"""
SELECT snapshot_ts, metric, round(value, 9) AS value, round(lag(value) OVER w, 9) AS previous, round(value - lag(value) OVER w, 9) AS change
FROM (SELECT as_of AS snapshot_ts, unnest(['accuracy', 'precision', 'recall', 'f1_score', 'rows']) AS metric,
        unnest([(n - fp - fn)/n, coalesce(tp/nullif(tp + fp, 0), 0), coalesce(tp/nullif(tp + fn, 0), 0),
                coalesce(2*tp/nullif(2*tp + fp + fn, 0), 0), n::DOUBLE]) AS value
      FROM (SELECT as_of, count(*) AS n, count(*) FILTER (flag AND churned) AS tp, count(*) FILTER (flag AND NOT churned) AS fp,
              count(*) FILTER (NOT flag AND churned) AS fn
            FROM (SELECT t.as_of, coalesce(max(date_sub('day', x.transaction_date, t.as_of)) IS NULL
                      OR min(date_sub('day', x.transaction_date, t.as_of)) FILTER (x.transaction_date < t.as_of
                         AND x.transaction_date >= t.as_of - INTERVAL 365 DAY) IS NULL
                      OR min(date_sub('day', x.transaction_date, t.as_of)) FILTER (x.transaction_date < t.as_of
                         AND x.transaction_date >= t.as_of - INTERVAL 365 DAY) / 365 >= 0.5, true) AS flag,
                    count(*) FILTER (x.transaction_date >= t.as_of AND x.transaction_date < t.as_of + INTERVAL 365 DAY) = 0 AS churned
                  FROM (VALUES {_DRIFT_TIMES}) t(as_of) JOIN customers c ON c.registration_date < CAST(t.as_of AS DATE)
                  LEFT JOIN transactions x ON x.customer_id = c.customer_id GROUP BY t.as_of, c.customer_id) GROUP BY as_of))
WINDOW w AS (PARTITION BY metric ORDER BY snapshot_ts)""",
    ("customers", "transactions"),
))
def performance_drift(spark, folder):
    """Metrics of the stand-in probability at four as-of times and their change, features and labels in one pass a source."""
    tx, people = fx.transactions(spark, folder), fx.customers(spark, folder)
    windows = timeline.rfm_at_times(tx, list(MOMENTS), (365,)).select("customer_id", "as_of", "recency_days_365d")
    judged = timeline.labels_at_times(people, tx, list(MOMENTS)).join(windows, ["customer_id", "as_of"], "left")
    judged = judged.withColumn("churn_probability", scoring.recency_score(F.col("recency_days_365d")))
    drift = monitoring.metric_drift(timeline.metrics_at_times(judged))
    return tidy(drift, {"value", "previous", "change"}, 9)


# every number of the feature table but the rounded ones whose last bits differ
CORRELATED_ALL = sorted(
    [f"{c}_{d}d" for d in v.WINDOWS for c in ("transaction_count", "total_spent", "avg_transaction", "min_transaction", "max_transaction", "recency_days")]
    + ["account_balance", "total_quantity", "avg_quantity", "refund_rate", "total_refunds", "avg_discount_rate", "product_category_count",
       "total_events", "page_views", "clicks", "searches", "add_to_cart", "session_count", "total_time_spent", "support_ticket_count",
       "monthly_fee", "customer_age_days", "days_since_last_login", "age", "estimated_clv", *sorted(ORDER_DEPENDENT)]
)


@query(sql(
    "SELECT feature_a, feature_b, round(c, 6) AS correlation FROM (SELECT "
    + "unnest(["
    + ", ".join(f"'{a}'" for i, a in enumerate(CORRELATED_ALL) for _ in CORRELATED_ALL[i + 1:])
    + "]) AS feature_a, unnest(["
    + ", ".join(f"'{b}'" for i, _ in enumerate(CORRELATED_ALL) for b in CORRELATED_ALL[i + 1:])
    + "]) AS feature_b, unnest(["
    + ", ".join(f"corr({a}, {b})" for i, a in enumerate(CORRELATED_ALL) for b in CORRELATED_ALL[i + 1:])
    + "]) AS c FROM features)",
    ALL_VIEWS, v.feature_ctes(),
))
def full_correlation(spark, folder):
    """All pairs of the feature table's numbers by one matrix product per batch."""
    return tidy(gram.correlations(features(spark, folder), CORRELATED_ALL), {"correlation"}, 6)
