"""The daily runs after training: score everyone, report, and queue campaigns."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

from holdfast.operators import campaigns, scoring
from holdfast.operators.models import Settings
from holdfast.plans.training import Scorer
from holdfast.sources import snapshots


def scoring_run(
    features: DataFrame, scorer: Scorer, path: str, moment: datetime, settings: Settings = Settings()
) -> DataFrame:
    """Score every customer of the feature table; write the predictions, their summary and the daily report."""
    spark = features.sparkSession
    scored = scoring.predictions(scorer.score(features, settings), moment)
    snapshots.write_snapshot(scored, f"{path}/predictions", moment)
    written = snapshots.latest_snapshot(spark, f"{path}/predictions")
    key = snapshots.snapshot_key(moment)
    snapshots.write_report(scoring.prediction_summary(written), f"{path}/summary/{key}")
    snapshots.write_report(scoring.daily_report(written, moment), f"{path}/daily_report/{key}")
    return written


def campaign_run(spark: SparkSession, path: str, moment: datetime) -> DataFrame:
    """Queue the high band of the newest predictions; write payloads, results, report and sync records."""
    newest = snapshots.latest_snapshot(spark, f"{path}/predictions").drop("snapshot_ts")
    high = scoring.risk_filter(newest, ("high",))
    snapshots.write_snapshot(campaigns.as_json(campaigns.campaign_payloads(high, moment)), f"{path}/outbox", moment)
    snapshots.write_snapshot(campaigns.trigger_high_risk(newest, moment), f"{path}/campaign_results", moment)
    snapshots.write_snapshot(campaigns.crm_sync_records(newest), f"{path}/crm_sync", moment)
    results = snapshots.latest_snapshot(spark, f"{path}/campaign_results")
    snapshots.write_report(
        campaigns.campaign_report(results), f"{path}/campaign_report/{snapshots.snapshot_key(moment)}"
    )
    return results
