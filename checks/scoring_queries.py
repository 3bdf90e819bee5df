"""Queries over labels, scores, reports, campaigns, history, metrics and monitoring, each with its SQL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import views as v
from checks.feature_queries import AS_OF, customer_rows, features, profiles, tidy
from checks.registry import query
from checks.views import ALL_VIEWS, sql
from holdfast.operators import campaigns, history, incremental, labels, metrics, monitoring, rfm, scoring
from holdfast.session import pinned, scratch_path
from holdfast.sources import fixtures as fx
from holdfast.sources import snapshots
from holdfast.streaming import engagement as stream

LABEL_AS_OF = fx.LABEL_AS_OF
# moments of the prediction history
MOMENTS = ("2000-08-02 00:00:00", "2001-02-02 00:00:00", "2001-05-02 00:00:00", "2001-08-02 00:00:00")


def windows_at(spark: SparkSession, folder: str, as_of: str, lookbacks=(365,)) -> DataFrame:
    windows = rfm.rfm_windows(fx.transactions(spark, folder), as_of, lookbacks)
    return fx.customers(spark, folder).select("customer_id").join(windows, "customer_id", "left")


def scored(spark: SparkSession, folder: str, as_of: str = AS_OF) -> DataFrame:
    """Predictions with the stand-in probability."""
    p = scoring.recency_score(F.col("recency_days_365d")).alias("churn_probability")
    return scoring.predictions(windows_at(spark, folder, as_of).select("customer_id", p), as_of)


def prediction_history(spark: SparkSession, folder: str) -> DataFrame:
    """The predictions of all moments, each written once: else the aggregates, joins and sorts of all moments share each task."""
    return scoring.union_predictions(*[pinned(scored(spark, folder, m), "predictions") for m in MOMENTS])


BAND = (
    "CASE WHEN churn_probability >= 0.7 THEN 'high' WHEN churn_probability >= 0.4 THEN 'medium' ELSE 'low' END"
)


def scored_ctes(moment: str, name: str = "scored") -> dict[str, str]:
    stamp = f"TIMESTAMP '{moment}'"
    return {
        f"{name}_raw": f"""
SELECT c.customer_id,
  least(coalesce(date_sub('day', max(t.transaction_date), {stamp}), 365)/365::DOUBLE, 1) AS churn_probability
FROM customers c LEFT JOIN transactions t ON t.customer_id = c.customer_id
  AND t.transaction_date >= {stamp} - INTERVAL 365 DAY AND t.transaction_date < {stamp}
GROUP BY 1""",
        name: f"""
SELECT customer_id, churn_probability, {BAND} AS risk_category,
  CAST({stamp} AS DATE) AS prediction_date, {stamp} AS prediction_timestamp FROM {name}_raw""",
    }


def history_ctes() -> dict[str, str]:
    ctes: dict[str, str] = {}
    for i, m in enumerate(MOMENTS):
        ctes |= scored_ctes(m, f"s{i}")
    ctes["history"] = " UNION ALL ".join(f"SELECT * FROM s{i}" for i in range(len(MOMENTS)))
    return ctes


BASE = ("customers", "transactions")


def scored_sql(body: str, moment: str = AS_OF) -> str:
    return sql(body, BASE, scored_ctes(moment))


# ---------------------------------------------------------------- labels

LABELS = f"""
SELECT c.customer_id, CAST(CASE WHEN count(t.transaction_id) = 0 THEN 1 ELSE 0 END AS INT) AS churned
FROM customers c LEFT JOIN transactions t ON t.customer_id = c.customer_id
  AND t.transaction_date >= {v.LABEL} AND t.transaction_date < {v.LABEL} + INTERVAL 365 DAY
GROUP BY 1"""


def labelled(spark: SparkSession, folder: str) -> DataFrame:
    return labels.churn_labels(
        fx.customers(spark, folder), fx.transactions(spark, folder), LABEL_AS_OF, fx.LABEL_HORIZON_DAYS
    )


@query(sql(LABELS, BASE))
def churn_labels(spark, folder):
    return labelled(spark, folder)


@query(sql(f"SELECT churned, count(*) AS rows FROM ({LABELS}) GROUP BY 1", BASE))
def class_distribution(spark, folder):
    return labels.class_distribution(labelled(spark, folder))


# ---------------------------------------------------------------- scores and reports

@query(scored_sql("SELECT * FROM scored"))
def score_customers(spark, folder):
    return scored(spark, folder).orderBy(F.col("churn_probability").desc(), "customer_id")


@query(scored_sql("SELECT customer_id, churn_probability, risk_category FROM scored"))
def risk_band(spark, folder):
    return scored(spark, folder).select("customer_id", "churn_probability", "risk_category")


@query(scored_sql("SELECT * FROM scored WHERE risk_category IN ('high', 'medium')"))
def risk_filter(spark, folder):
    return scoring.risk_filter(scored(spark, folder), ("high", "medium"))


@query(scored_sql("""
SELECT count(*) AS total_customers, count(*) FILTER (risk_category='high') AS high_risk_count,
  count(*) FILTER (risk_category='medium') AS medium_risk_count, count(*) FILTER (risk_category='low') AS low_risk_count
FROM scored"""))
def risk_distribution(spark, folder):
    return scoring.risk_distribution(scored(spark, folder))


@query(scored_sql("SELECT * FROM scored WHERE risk_category = 'high' ORDER BY churn_probability DESC, customer_id LIMIT 50"))
def high_risk_customers(spark, folder):
    return scoring.high_risk_customers(scored(spark, folder), 50)


@query(scored_sql("SELECT * FROM scored WHERE risk_category = 'high'"))
def high_risk_customers_all(spark, folder):
    return scoring.high_risk_customers(scored(spark, folder))


@query(scored_sql(
    "SELECT customer_id, churn_probability, risk_category FROM scored ORDER BY churn_probability DESC, customer_id LIMIT 10"
))
def top10_high_risk(spark, folder):
    return scoring.top_customers(scored(spark, folder), 10)


@query(sql(
    """
SELECT s.customer_id, round(s.churn_probability, 4) AS churn_probability, s.risk_category, x.factor, x.description,
  round(x.value, 4) AS value
FROM scored s JOIN (
  SELECT customer_id, 'high_recency' AS factor, 'No recent transactions' AS description,
    CAST(recency_days_30d AS DOUBLE) AS value FROM f WHERE recency_days_30d > 30
  UNION ALL SELECT customer_id, 'declining_activity', 'Significant activity decline', activity_decline_30_90
    FROM f WHERE activity_decline_30_90 > 0.5
  UNION ALL SELECT customer_id, 'open_support_tickets', 'Unresolved support issues', CAST(open_tickets AS DOUBLE)
    FROM f WHERE open_tickets > 0
  UNION ALL SELECT customer_id, 'low_engagement', 'Below average engagement', engagement_score
    FROM f WHERE engagement_score < 50) x USING (customer_id)""",
    ALL_VIEWS, v.feature_ctes() | scored_ctes(AS_OF) | {"f": "SELECT * FROM features"},
))
def risk_factors(spark, folder):
    found = scoring.risk_factors(scored(spark, folder), features(spark, folder))
    exploded = found.select("customer_id", "churn_probability", "risk_category", F.inline("key_risk_factors"))
    return tidy(exploded, {"value"})


@query(scored_sql("""
SELECT TIMESTAMP '2001-08-02 00:00:00' AS report_date, count(*) AS total_customers_scored,
  count(*) FILTER (risk_category='high') AS high, count(*) FILTER (risk_category='medium') AS medium,
  count(*) FILTER (risk_category='low') AS low, round(avg(churn_probability), 6) AS avg_churn_probability,
  round(median(churn_probability), 6) AS median_churn_probability, max(churn_probability) AS max_churn_probability,
  round(stddev_samp(churn_probability), 6) AS std_churn_probability,
  (SELECT string_agg(CAST(customer_id AS VARCHAR), ',' ORDER BY churn_probability DESC, customer_id)
   FROM (SELECT * FROM scored ORDER BY churn_probability DESC, customer_id LIMIT 10)) AS top_10_high_risk
FROM scored"""))
def daily_report(spark, folder):
    report = scoring.daily_report(scored(spark, folder), AS_OF, customer_rows(spark, folder))
    ids = F.array_join(F.col("top_10_high_risk.customer_id").cast("array<string>"), ",").alias("top_10_high_risk")
    report = report.select("report_date", "total_customers_scored", "risk_distribution.*", "statistics.*", ids)
    return tidy(report, {"avg_churn_probability", "median_churn_probability", "std_churn_probability"}, 6)


@query(scored_sql("""
SELECT max(prediction_date) AS prediction_date, count(*) AS total_customers,
  count(*) FILTER (risk_category='high') AS high_risk_count,
  count(*) FILTER (risk_category='medium') AS medium_risk_count, count(*) FILTER (risk_category='low') AS low_risk_count,
  round(avg(churn_probability), 6) AS avg_churn_probability,
  (SELECT string_agg(CAST(customer_id AS VARCHAR), ',' ORDER BY churn_probability DESC, customer_id)
   FROM (SELECT * FROM scored WHERE risk_category='high' ORDER BY churn_probability DESC, customer_id LIMIT 100)
  ) AS high_risk_customers
FROM scored"""))
def prediction_summary(spark, folder):
    path = scratch_path(spark, "report")
    snapshots.write_report(scoring.prediction_summary(scored(spark, folder)), path)
    back = spark.read.json(path).withColumns(
        {
            "prediction_date": F.col("prediction_date").cast("date"),
            "high_risk_customers": F.array_join(F.col("high_risk_customers").cast("array<string>"), ","),
        }
    )
    return tidy(back, {"avg_churn_probability"}, 6)


@query(sql("SELECT * FROM history", BASE, history_ctes()))
def union_predictions(spark, folder):
    return prediction_history(spark, folder)


@query(sql("SELECT * FROM s0 UNION ALL SELECT * FROM s3", BASE, history_ctes()))
def append_predictions(spark, folder):
    path = scratch_path(spark, "predictions")
    for moment in (MOMENTS[0], MOMENTS[0], MOMENTS[-1]):  # a run that is repeated adds nothing
        snapshots.append_predictions(scored(spark, folder, moment), path, datetime.fromisoformat(str(moment)))
    return spark.read.parquet(path).drop("snapshot_ts")


# ---------------------------------------------------------------- history

@query(sql(
    "SELECT *, CAST(row_number() OVER (PARTITION BY customer_id ORDER BY prediction_timestamp DESC, churn_probability) AS INT) AS recency_rank "
    "FROM history QUALIFY recency_rank <= 2",
    BASE, history_ctes(),
))
def keep_last_n_predictions(spark, folder):
    return history.keep_last_n(prediction_history(spark, folder), "customer_id", "prediction_timestamp", "churn_probability", 2)


@query(sql(
    "SELECT * FROM history QUALIFY row_number() OVER "
    "(PARTITION BY customer_id ORDER BY churn_probability DESC, prediction_timestamp) = 1",
    BASE, history_ctes(),
))
def best_row_per_group(spark, folder):
    return history.best_row_per_group(
        prediction_history(spark, folder), "customer_id", "churn_probability", "prediction_timestamp"
    )


def snapshot_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Long (snapshot_ts, metric, value) over the prediction history."""
    p = F.col("churn_probability")
    per = prediction_history(spark, folder).groupBy(
        F.date_format("prediction_date", "yyyyMMdd").alias("snapshot_ts")
    ).agg(
        F.round(F.avg(p), 6).alias("mean_probability"),
        (F.count_if(F.col("risk_category") == "high") / F.count("*")).alias("high_share"),
        F.max(p).alias("max_probability"),
    )
    return per.unpivot(
        "snapshot_ts", ["mean_probability", "high_share", "max_probability"], "metric", "value"
    )


def _metric_ctes() -> dict[str, str]:
    return history_ctes() | {
        "metrics": """
SELECT strftime(prediction_date, '%Y%m%d') AS snapshot_ts, unnest(['mean_probability', 'high_share', 'max_probability']) AS metric,
  unnest([round(avg(churn_probability), 6), count(*) FILTER (risk_category='high')/count(*), max(churn_probability)]) AS value
FROM history GROUP BY prediction_date"""
    }


@query(sql(
    """SELECT metric, max(value) FILTER (snapshot_ts='20000802') AS "20000802",
    max(value) FILTER (snapshot_ts='20010802') AS "20010802" FROM metrics GROUP BY 1""",
    BASE, _metric_ctes(),
))
def compare_snapshots(spark, folder):
    return history.compare_snapshots(snapshot_metrics(spark, folder), ["20000802", "20010802"])


@query(sql(
    """SELECT snapshot_ts, metric, value, lag(value) OVER w AS previous, value - lag(value) OVER w AS change
    FROM metrics WINDOW w AS (PARTITION BY metric ORDER BY snapshot_ts)""",
    BASE, _metric_ctes(),
))
def metric_drift(spark, folder):
    return monitoring.metric_drift(snapshot_metrics(spark, folder))


# ---------------------------------------------------------------- campaigns

_TEMPLATES = """
SELECT * FROM (VALUES
 ('high', 'CHURN_HIGH_RISK_001', 'email,sms,push', 'urgent', 'premium_discount', 30, 'urgent', 'exclusive_benefits', 'critical'),
 ('medium', 'CHURN_MEDIUM_RISK_002', 'email,push', 'high', 'standard_discount', 15, 'friendly', 'loyalty_rewards', 'moderate'),
 ('low', 'CHURN_LOW_RISK_003', 'email', 'normal', 'engagement', 0, 'informative', 'feature_awareness', 'routine'))
 t(risk_category, campaign_id, channels, priority, offer_type, discount_percentage, message_tone, incentive, urgency_level)"""


@query(scored_sql(f"""
SELECT customer_id, campaign_id, channels, priority, churn_probability, risk_category,
  TIMESTAMP '{AS_OF}' AS created_at, offer_type, discount_percentage, message_tone, incentive, urgency_level
FROM scored JOIN ({_TEMPLATES}) USING (risk_category)"""))
def campaign_payloads(spark, folder):
    payloads = campaigns.campaign_payloads(scored(spark, folder), AS_OF)
    personal = [c for c in payloads.schema["personalization"].dataType.names if c != "customer_id"]
    return payloads.withColumn("channels", F.array_join("channels", ",")).select(
        "*", *[F.col(f"personalization.{c}").alias(c) for c in personal]
    ).drop("personalization")


@query(scored_sql(f"""
SELECT customer_id, risk_category, churn_probability, 'queued' AS campaign_status, 'CHURN_HIGH_RISK_001' AS campaign_id,
  TIMESTAMP '{AS_OF}' AS triggered_at FROM scored WHERE risk_category = 'high'"""))
def trigger_high_risk(spark, folder):
    return campaigns.trigger_high_risk(scored(spark, folder), AS_OF)


@query(scored_sql("""
SELECT customer_id, churn_probability, risk_category, strftime(prediction_date, '%Y-%m-%d') AS prediction_date,
  'ensemble_v1' AS model_version FROM scored"""))
def crm_sync_records(spark, folder):
    return campaigns.crm_sync_records(scored(spark, folder))


# an outcome per customer from its balance stands in for the replies of the receiving side
_STATUS = "CASE WHEN account_balance > 2000 THEN 'success' WHEN account_balance > 0 THEN 'failed' ELSE 'error' END"


def campaign_results(spark: SparkSession, folder: str, moment: str = AS_OF) -> DataFrame:
    sent = campaigns.trigger_campaigns(scored(spark, folder, moment), moment)
    outcome = fx.customers(spark, folder).select("customer_id", F.expr(_STATUS).alias("campaign_status"))
    return sent.drop("campaign_status").join(outcome, "customer_id")


@query(scored_sql(f"""
SELECT count(*) AS total_campaigns, count(*) FILTER (risk_category='high') AS high,
  count(*) FILTER (risk_category='medium') AS medium, count(*) FILTER (risk_category='low') AS low,
  count(*) FILTER (status='success') AS success, CAST(0 AS BIGINT) AS queued,
  CAST(0 AS BIGINT) AS skipped, count(*) FILTER (status='failed') AS failed,
  count(*) FILTER (status='error') AS error,
  round(count(*) FILTER (status='success')/count(*)*100, 6) AS success_rate,
  round(avg(churn_probability), 6) AS avg_churn_probability
FROM (SELECT *, {_STATUS} AS status FROM scored JOIN customers USING (customer_id))"""))
def campaign_report(spark, folder):
    report = campaigns.campaign_report(campaign_results(spark, folder)).select(
        "total_campaigns", "campaigns_by_risk.*", "campaigns_by_status.*", "success_rate", "avg_churn_probability"
    )
    return tidy(report, {"success_rate", "avg_churn_probability"}, 6)


@query(scored_sql(f"""
SELECT count(*) AS total_customers, count(*) FILTER (status='success') AS successful_syncs,
  count(*) FILTER (status<>'success') AS failed_syncs
FROM (SELECT {_STATUS} AS status FROM scored JOIN customers USING (customer_id))"""))
def crm_sync_summary(spark, folder):
    return campaigns.sync_summary(campaign_results(spark, folder), "campaign_status")


@query(scored_sql(f"""
SELECT customer_id, CASE risk_category WHEN 'high' THEN 'at_risk' WHEN 'medium' THEN 'watch' ELSE 'loyal' END AS segment,
  TIMESTAMP '{AS_OF}' AS updated_at FROM scored"""))
def segment_updates(spark, folder):
    return campaigns.segment_updates(scored(spark, folder), AS_OF).drop("metadata")


@query(scored_sql("""
SELECT risk_category, CAST((rn-1)//100 AS BIGINT) AS batch, string_agg(CAST(customer_id AS VARCHAR), ',' ORDER BY customer_id) AS customer_ids,
  'win_back' AS campaign_name, 'email,push' AS channels, 'We miss you' AS message, '{"discount": "15"}' AS offer,
  'custom_retention' AS campaign_type, any_value(TIMESTAMP '2001-08-02 00:00:00') AS created_at
FROM (SELECT *, row_number() OVER (PARTITION BY risk_category ORDER BY customer_id) AS rn FROM scored)
GROUP BY risk_category, batch"""))
def custom_campaign_batches(spark, folder):
    batches = campaigns.custom_campaign_batches(
        scored(spark, folder), "risk_category", "win_back", 100, ("email", "push"), "We miss you", {"discount": "15"}, moment=AS_OF
    )
    joined = {c: F.array_join(F.col(c).cast("array<string>"), ",") for c in ("customer_ids", "channels")}
    return batches.withColumns(joined)


@query(scored_sql("""
SELECT customer_id, churn_probability, row_number() OVER (ORDER BY churn_probability DESC, customer_id) AS send_rank,
  CAST((row_number() OVER (ORDER BY churn_probability DESC, customer_id) - 1)//60 AS BIGINT) AS slot FROM scored"""))
def send_slots(spark, folder):
    return campaigns.send_slots(scored(spark, folder))


@query(sql(
    """SELECT customer_id, 'win_back' AS experiment,
    CASE WHEN CAST('0x'||substr(md5('win_back'||'|'||CAST(customer_id AS VARCHAR)),1,8) AS BIGINT)/4294967296 < 0.5
      THEN 'treatment' ELSE 'control' END AS arm FROM customers""",
    ("customers",),
))
def ab_assignment(spark, folder):
    return campaigns.ab_assignment(fx.customers(spark, folder), "win_back")


@query(scored_sql(
    f"""
SELECT risk_category, count(*) AS targeted, count(purchases) AS converted,
  CAST(coalesce(sum(purchases), 0) AS BIGINT) AS purchases, count(purchases)/count(*) AS conversion_rate
FROM scored LEFT JOIN (SELECT customer_id, count(*) AS purchases FROM transactions
  WHERE transaction_date >= {v.LABEL} AND transaction_date < {v.LABEL} + INTERVAL 30 DAY GROUP BY 1) USING (customer_id)
GROUP BY 1""",
    LABEL_AS_OF,
))
def campaign_conversion(spark, folder):
    results = campaigns.trigger_campaigns(scored(spark, folder, LABEL_AS_OF), LABEL_AS_OF)
    return campaigns.campaign_conversion(results, fx.transactions(spark, folder))


# ---------------------------------------------------------------- metrics

def judged(spark: SparkSession, folder: str) -> DataFrame:
    """Stand-in scores before the label window with what happened in it."""
    return scored(spark, folder, LABEL_AS_OF).join(labelled(spark, folder), "customer_id")


def judged_sql(body: str) -> str:
    ctes = scored_ctes(LABEL_AS_OF) | {
        "judged": f"SELECT customer_id, churn_probability AS p, churned AS y FROM scored JOIN ({LABELS}) USING (customer_id)"
    }
    return sql(body, BASE, ctes)


_CELLS = """SELECT count(*) FILTER (y=1 AND p>=0.5) AS tp, count(*) FILTER (y=0 AND p>=0.5) AS fp,
  count(*) FILTER (y=1 AND p<0.5) AS fn, count(*) FILTER (y=0 AND p<0.5) AS tn FROM judged"""


@query(judged_sql(_CELLS))
def confusion_matrix(spark, folder):
    return metrics.confusion_matrix(judged(spark, folder))


@query(judged_sql(f"""
SELECT (tp+tn)/(tp+fp+fn+tn) AS accuracy, coalesce(tp/nullif(tp+fp, 0), 0) AS precision,
  coalesce(tp/nullif(tp+fn, 0), 0) AS recall, coalesce(2*tp/nullif(2*tp+fp+fn, 0), 0) AS f1_score FROM ({_CELLS})"""))
def classification_metrics(spark, folder):
    return metrics.classification_metrics(judged(spark, folder))


@query(judged_sql("""
SELECT round(sum(CASE WHEN a.p > b.p THEN 1.0 WHEN a.p = b.p THEN 0.5 ELSE 0 END)/count(*), 9) AS roc_auc
FROM judged a JOIN judged b ON a.y = 1 AND b.y = 0"""))
def roc_auc(spark, folder):
    return tidy(metrics.roc_auc(judged(spark, folder)), {"roc_auc"}, 9)


@query(judged_sql("""
SELECT t.p AS threshold, count(*) FILTER (j.y=1) AS true_positives, count(*) FILTER (j.y=0) AS false_positives,
  count(*) FILTER (j.y=1)/count(*) AS precision,
  count(*) FILTER (j.y=1)/(SELECT count(*) FROM judged WHERE y=1) AS recall,
  count(*) FILTER (j.y=0)/(SELECT count(*) FROM judged WHERE y=0) AS false_positive_rate
FROM (SELECT DISTINCT p FROM judged) t JOIN judged j ON j.p >= t.p GROUP BY 1"""))
def pr_curve(spark, folder):
    return metrics.pr_curve(judged(spark, folder))


# ---------------------------------------------------------------- monitoring

DRIFT = ["total_spent_365d", "transaction_count_365d", "recency_days_365d", "avg_transaction_365d", "total_spent_90d"]


def _drift_ctes() -> dict[str, str]:
    ctes = {}
    for name, moment in (("base", v.LABEL), ("now", v.ORDERS)):
        ctes[f"{name}_365"] = v.rfm_window(365, moment)
        ctes[f"{name}_90"] = v.rfm_window(90, moment)
        ctes[name] = f"SELECT * FROM {name}_365 LEFT JOIN {name}_90 USING (customer_id)"
    return ctes


def _psi_sql(feature: str) -> str:
    def share(table: str) -> str:
        return f"""SELECT CASE WHEN {feature} IS NULL THEN -1 ELSE coalesce(len(list_filter(cuts, lambda c: c < {feature})), 0) END AS bin,
          count(*) AS n
        FROM {table}, (SELECT quantile_cont(CAST({feature} AS DOUBLE), [0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9]) AS cuts FROM base)
        GROUP BY 1"""

    return f"""
SELECT '{feature}' AS feature, round(sum((n-b)*ln(n/b)), 6) AS psi, sum((n-b)*ln(n/b)) > 0.1 AS drifted FROM (
  SELECT greatest(coalesce(x.n, 0)/sum(x.n) OVER (), 0.0001) AS b, greatest(coalesce(y.n, 0)/sum(y.n) OVER (), 0.0001) AS n
  FROM ({share('base')}) x FULL JOIN ({share('now')}) y USING (bin))"""


@query(sql(" UNION ALL ".join(_psi_sql(c) for c in DRIFT), ("transactions",), _drift_ctes()))
def feature_drift_psi(spark, folder):
    tx = fx.transactions(spark, folder)
    base, now = (rfm.rfm_windows(tx, m, (90, 365)) for m in (LABEL_AS_OF, AS_OF))
    return tidy(monitoring.feature_drift_psi(base, now, DRIFT, customer_rows(spark, folder)), {"psi"}, 6)


def _bins(table: str) -> str:
    return f"SELECT CAST(least(floor(churn_probability*10), 9) AS INT) AS bin, count(*) AS n FROM {table} GROUP BY 1"


@query(sql(
    f"""
SELECT 'churn_probability' AS feature, round(sum((n-b)*ln(n/b)), 6) AS psi, sum((n-b)*ln(n/b)) > 0.15 AS drifted FROM (
  SELECT greatest(coalesce(x.n, 0)/sum(x.n) OVER (), 0.0001) AS b, greatest(coalesce(y.n, 0)/sum(y.n) OVER (), 0.0001) AS n
  FROM ({_bins('s0')}) x FULL JOIN ({_bins('s3')}) y USING (bin))""",
    BASE, history_ctes(),
))
def prediction_drift_psi(spark, folder):
    base, now = scored(spark, folder, LABEL_AS_OF), scored(spark, folder, AS_OF)
    return tidy(monitoring.prediction_drift_psi(base, now), {"psi"}, 6)


OUTLIERS = ["total_spent_365d", "avg_transaction_365d", "max_transaction_365d", "transaction_count_365d"]


def _outlier_sql(c: str) -> str:
    return f"""
SELECT '{c}' AS column_name, round(lo, 4) AS lower_fence, round(hi, 4) AS upper_fence,
  (SELECT count(*) FROM w365 WHERE {c} < lo) AS below, (SELECT count(*) FROM w365 WHERE {c} > hi) AS above
FROM (SELECT q1 - 1.5::DOUBLE*(q3-q1) AS lo, q3 + 1.5::DOUBLE*(q3-q1) AS hi FROM (
  SELECT quantile_cont(CAST({c} AS DOUBLE), 0.25) AS q1, quantile_cont(CAST({c} AS DOUBLE), 0.75) AS q3 FROM w365))"""


@query(sql(" UNION ALL ".join(_outlier_sql(c) for c in OUTLIERS), ("transactions",), {"w365": v.rfm_window(365, v.ORDERS)}))
def outliers_iqr(spark, folder):
    windows = rfm.rfm_windows(fx.transactions(spark, folder), AS_OF, (365,))
    out = monitoring.outliers_iqr(windows, OUTLIERS, customer_rows(spark, folder))
    return tidy(out, {"lower_fence", "upper_fence"}, 4)


CORRELATED = ["total_spent_365d", "transaction_count_365d", "recency_days_365d", "avg_transaction_365d", "account_balance"]


@query(sql(
    " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round(corr({a}, {b}), 6) AS correlation FROM joined"
        for i, a in enumerate(CORRELATED) for b in CORRELATED[i + 1:]
    ),
    BASE,
    {"w365": v.rfm_window(365, v.ORDERS), "joined": "SELECT * FROM customers LEFT JOIN w365 USING (customer_id)"},
))
def feature_correlation(spark, folder):
    windows = rfm.rfm_windows(fx.transactions(spark, folder), AS_OF, (365,))
    wide = profiles(spark, folder).join(windows, "customer_id", "left")
    return tidy(monitoring.feature_correlation(wide, CORRELATED), {"correlation"}, 6)


def _violations(table: str, rule: str, condition: str) -> str:
    return f"SELECT '{table}' AS table_name, '{rule}' AS rule, count(*) AS violations FROM {table} WHERE {condition}"


def _duplicates(table: str, key: str) -> str:
    return (
        f"SELECT '{table}', 'duplicate_key', count(*) - count(DISTINCT {key}) FROM {table}"
    )


@query(sql(
    " UNION ALL ".join(
        [
            _violations("customers", "null_key", "customer_id IS NULL"),
            _violations("customers", "age_out_of_range", "age < 18 OR age > 100"),
            _violations("customers", "login_before_registration", "last_login_date < registration_date"),
            _violations("customers", "negative_balance", "account_balance < 0"),
            _duplicates("customers", "customer_id"),
            _violations("transactions", "null_key", "transaction_id IS NULL OR customer_id IS NULL"),
            _violations("transactions", "amount_not_positive", "transaction_amount <= 0"),
            _duplicates("transactions", "transaction_id"),
            _violations("user_events", "null_key", "customer_id IS NULL"),
            _violations("user_events", "negative_time", "time_spent_seconds < 0"),
            _violations("user_events", "unknown_type", "event_type NOT IN ('page_view','click','search','add_to_cart')"),
            _violations("support_tickets", "unknown_status", "status NOT IN ('resolved','open')"),
            _duplicates("support_tickets", "ticket_id"),
            _violations("subscription_history", "fee_missing", "monthly_fee IS NULL"),
        ]
        + [
            _violations(t, "orphan_key", "customer_id NOT IN (SELECT customer_id FROM customers)")
            for t in ("transactions", "user_events", "support_tickets", "subscription_history")
        ]
    ),
    ALL_VIEWS,
))
def data_validation(spark, folder):
    return monitoring.data_validation(fx.all_tables(spark, folder))


@query(sql(
    """
SELECT customer_id, count(*) AS transaction_count, CAST(sum(CAST(transaction_amount AS DECIMAL(18,2))) AS DOUBLE) AS total_spent,
  CAST(sum(CAST(transaction_amount AS DECIMAL(18,2))) AS DOUBLE)/count(*) AS avg_transaction,
  round(stddev_samp(transaction_amount), 4) AS std_transaction, min(transaction_amount) AS min_transaction,
  max(transaction_amount) AS max_transaction, max(transaction_date) AS last_transaction FROM transactions GROUP BY 1""",
    ("transactions",),
))
def incremental_rollup(spark, folder):
    """Loaded without every third transaction before the label time first, then what is new or late."""
    tx = fx.transactions(spark, folder)
    first = tx.where((F.col("transaction_date") < F.lit(LABEL_AS_OF).cast("timestamp_ntz")) & (F.col("transaction_id") % 3 > 0))
    state = pinned(incremental.partial_state(first), "state")
    _, figures = incremental.incremental_rollup(tx, state)
    return tidy(figures, {"std_transaction"})


@query(sql(
    """
SELECT time_bucket(INTERVAL 1 DAY, event_timestamp) AS window_start,
  time_bucket(INTERVAL 1 DAY, event_timestamp) + INTERVAL 1 DAY AS window_end, event_type, count(*) AS events,
  CAST(sum(CAST(time_spent_seconds AS DECIMAL(28,9))) AS DOUBLE) AS time_spent_seconds
FROM user_events GROUP BY ALL""",
    ("user_events",),
))
def stream_engagement(spark, folder):
    raw = fx.table(spark, folder, "events")
    arriving = stream.read_stream(spark, folder, raw.schema, "events.parquet")
    path = scratch_path(spark, "stream")
    stream.start(stream.windowed_counts(fx.as_user_events(arriving)), f"{path}/out", f"{path}/state").awaitTermination()
    return stream.with_open_windows(spark.read.parquet(f"{path}/out"), fx.user_events(spark, folder))
