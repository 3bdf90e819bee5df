"""Retention campaigns as tables: payloads, send plan, results, reports.

Nothing is sent: a payload table is the outbox another program reads.
"""

from __future__ import annotations

import json
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.functions.columns import instant, ratio, unit_hash
from holdfast.functions.intervals import counts_within
from holdfast.functions.ordering import with_rank
from holdfast.operators.scoring import BANDS, risk_filter
from holdfast.session import bounded_broadcast

# one row per risk band (fixed values)
TEMPLATES = [
    ("high", "CHURN_HIGH_RISK_001", ["email", "sms", "push"], "urgent",
     "premium_discount", 30, "urgent", "exclusive_benefits", "critical"),
    ("medium", "CHURN_MEDIUM_RISK_002", ["email", "push"], "high",
     "standard_discount", 15, "friendly", "loyalty_rewards", "moderate"),
    ("low", "CHURN_LOW_RISK_003", ["email"], "normal",
     "engagement", 0, "informative", "feature_awareness", "routine"),
]
_TEMPLATE_SCHEMA = (
    "risk_category string, campaign_id string, channels array<string>, priority string, offer_type string, "
    "discount_percentage int, message_tone string, incentive string, urgency_level string"
)
# band -> customer segment
SEGMENTS = {"high": "at_risk", "medium": "watch", "low": "loyal"}
MODEL_VERSION = "ensemble_v1"
SENDS_PER_MINUTE = 60
STATUSES = ("success", "queued", "skipped", "failed", "error")


def templates(spark: SparkSession) -> DataFrame:
    """Three rows, so always broadcast."""
    return F.broadcast(spark.createDataFrame(TEMPLATES, _TEMPLATE_SCHEMA))


def campaign_payloads(scored: DataFrame, moment: datetime | str, additional: tuple[str, ...] = ()) -> DataFrame:
    """One outbox row per customer, nested as the receiving side expects; bands without a template drop out.

    ``additional`` names further columns of ``scored`` for the personalization.
    """
    lookup = templates(scored.sparkSession)
    return scored.join(lookup, "risk_category").select(
        "customer_id",
        "campaign_id",
        "channels",
        "priority",
        "churn_probability",
        "risk_category",
        instant(moment).alias("created_at"),
        F.struct(
            "customer_id",
            "urgency_level",
            "offer_type",
            "discount_percentage",
            "message_tone",
            "incentive",
            *additional,
        ).alias("personalization"),
    )


def as_json(payloads: DataFrame, name: str = "payload") -> DataFrame:
    return payloads.select("customer_id", F.to_json(F.struct("*")).alias(name))


def trigger_campaigns(
    scored: DataFrame, moment: datetime | str, bands: tuple[str, ...] | None = None
) -> DataFrame:
    """One result row per selected customer: queued, or skipped for want of a template."""
    lookup = templates(scored.sparkSession).select("risk_category", "campaign_id")
    return risk_filter(scored, bands).join(lookup, "risk_category", "left").select(
        "customer_id",
        "risk_category",
        "churn_probability",
        F.when(F.col("campaign_id").isNull(), "skipped").otherwise("queued").alias("campaign_status"),
        "campaign_id",
        instant(moment).alias("triggered_at"),
    )


def trigger_high_risk(scored: DataFrame, moment: datetime | str) -> DataFrame:
    return trigger_campaigns(scored, moment, ("high",))


def crm_sync_records(scored: DataFrame) -> DataFrame:
    return scored.select(
        "customer_id",
        "churn_probability",
        "risk_category",
        F.date_format("prediction_date", "yyyy-MM-dd").alias("prediction_date"),
        F.lit(MODEL_VERSION).alias("model_version"),
    )


def sync_summary(results: DataFrame, status: str = "sync_status") -> DataFrame:
    """Counts over a table of sync outcomes; anything but success is a failure."""
    ok = F.coalesce(F.col(status) == "success", F.lit(False))
    return results.agg(
        F.count("*").alias("total_customers"),
        F.count_if(ok).alias("successful_syncs"),
        F.count_if(~ok).alias("failed_syncs"),
    )


def campaign_report(results: DataFrame) -> DataFrame:
    """Total, counts by band and by status, success share in percent, mean probability; zeros when empty."""
    status = F.col("campaign_status")
    cells = results.groupBy("risk_category", "campaign_status").agg(
        F.count("*").alias("n"), F.sum("churn_probability").alias("p"), F.count("churn_probability").alias("np")
    )

    def total(*where: Column) -> Column:
        value = F.when(where[0], F.col("n")) if where else F.col("n")
        return F.coalesce(F.sum(value), F.lit(0))

    return cells.agg(
        total().alias("total_campaigns"),
        F.struct(*[total(F.col("risk_category") == b).alias(b) for b in BANDS]).alias("campaigns_by_risk"),
        F.struct(*[total(status == s).alias(s) for s in STATUSES]).alias("campaigns_by_status"),
        F.coalesce(ratio(total(status == "success"), F.sum("n")) * 100, F.lit(0.0)).alias("success_rate"),
        ratio(F.sum("p"), F.sum("np")).alias("avg_churn_probability"),
    )


def segment_updates(scored: DataFrame, moment: datetime | str) -> DataFrame:
    segment = F.coalesce(*[F.when(F.col("risk_category") == b, s) for b, s in SEGMENTS.items()])
    return scored.select(
        "customer_id",
        segment.alias("segment"),
        instant(moment).alias("updated_at"),
        F.to_json(F.struct("churn_probability", "risk_category")).alias("metadata"),
    )


def custom_campaign_batches(
    audience: DataFrame,
    group: str,
    campaign_name: str,
    batch_size: int = 1000,
    channels: tuple[str, ...] = ("email",),
    message: str = "",
    offer: dict[str, str] | None = None,
    partitions: int | None = None,
    moment: datetime | str | None = None,
) -> DataFrame:
    """Id lists of at most ``batch_size`` per group, in id order; no list holds a whole group.

    The place within a group is the place in the table less the place of the
    group's first row, so a group that holds most rows stays spread out.
    """
    ranked = with_rank(
        audience.select(group, "customer_id"), [F.col(group), F.col("customer_id")], "_rank", partitions
    )
    firsts = ranked.groupBy(F.col(group).alias("_group")).agg(F.min("_rank").alias("_first"))
    firsts = bounded_broadcast(firsts)
    batch = F.floor((F.col("_rank") - F.col("_first")) / batch_size).cast("bigint")
    return (
        ranked.join(firsts, F.col(group).eqNullSafe(F.col("_group")))  # a missing group is one as well
        .groupBy(group, batch.alias("batch"))
        .agg(F.sort_array(F.collect_list("customer_id")).alias("customer_ids"))
        .select(
            "*",
            F.lit(campaign_name).alias("campaign_name"),
            F.lit(list(channels)).alias("channels"),
            F.lit(message).alias("message"),
            F.lit(json.dumps(offer or {})).alias("offer"),
            F.lit("custom_retention").alias("campaign_type"),
            (F.lit(None).cast("timestamp_ntz") if moment is None else instant(moment)).alias("created_at"),
        )
    )


def send_slots(
    scored: DataFrame, per_minute: int = SENDS_PER_MINUTE, partitions: int | None = None
) -> DataFrame:
    """The minute each customer is due under the rate limit, riskiest first."""
    order = [F.col("churn_probability").desc(), F.col("customer_id").asc()]
    ranked = with_rank(scored.select("customer_id", "churn_probability"), order, "send_rank", partitions)
    return ranked.withColumn("slot", F.floor((F.col("send_rank") - 1) / per_minute).cast("bigint"))


def ab_assignment(customers: DataFrame, experiment: str, treatment_share: float = 0.5) -> DataFrame:
    """A repeatable arm per customer and experiment, without a shuffle."""
    u = unit_hash(experiment, "|", F.col("customer_id"))
    return customers.select(
        "customer_id",
        F.lit(experiment).alias("experiment"),
        F.when(u < treatment_share, "treatment").otherwise("control").alias("arm"),
    )


def campaign_conversion(
    results: DataFrame, transactions: DataFrame, horizon_days: int = 30
) -> DataFrame:
    """Share of triggers, by band, whose customer buys within the horizon after them.

    Only purchases between the first trigger and the end of the last horizon
    are read. A trigger's purchases are the difference of two running counts, so
    triggers and purchases of a customer are sorted together and never paired.
    """
    horizon = F.expr(f"INTERVAL '{int(horizon_days)}' DAY")
    ts = F.col("transaction_date")
    first = results.agg(F.min("triggered_at")).scalar()
    last = results.agg(F.max("triggered_at") + horizon).scalar()
    near = transactions.where((ts >= first) & (ts < last))
    bought = counts_within(near, "transaction_date", results, "triggered_at", "customer_id", horizon_days)
    bought = bought.select("customer_id", "triggered_at", F.nullif("n", F.lit(0)).alias("purchases"))
    return (
        results.join(bought, ["customer_id", "triggered_at"], "left")
        .groupBy("risk_category")
        .agg(
            F.count("*").alias("targeted"),
            F.count("purchases").alias("converted"),
            F.coalesce(F.sum("purchases"), F.lit(0)).alias("purchases"),
        )
        .withColumn("conversion_rate", ratio(F.col("converted"), F.col("targeted")))
    )
