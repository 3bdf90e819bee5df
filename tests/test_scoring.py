from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from holdfast.operators import campaigns, history, metrics, monitoring, prepare, scoring
from holdfast.session import scratch_path
from holdfast.sources import snapshots

NOW = datetime(2001, 8, 2)


@pytest.fixture(scope="module")
def scored(spark):
    raw = spark.range(1000).select(
        F.col("id").alias("customer_id"),
        F.when(F.col("id") % 3 == 0, 0.8).otherwise(F.col("id") / 1000).alias("churn_probability"),
    )
    return scoring.predictions(raw, NOW)


def test_band_edges(spark):
    df = spark.createDataFrame([(0.7,), (0.69999,), (0.4,), (0.39999,)], "p double")
    assert [r[0] for r in df.select(scoring.risk_band(F.col("p"))).collect()] == ["high", "medium", "medium", "low"]


def test_top_n_zero_means_all(scored):
    high = scored.where("risk_category = 'high'").count()
    assert scoring.high_risk_customers(scored, 0).count() == high
    top = scoring.high_risk_customers(scored, 5).collect()
    assert [r["customer_id"] for r in top][:2] == [998, 997]


def test_reports_beyond_the_one_pass_limit(scored):
    a = scoring.daily_report(scored, NOW, 1000).first()
    b = scoring.daily_report(scored, NOW, 1000, one_pass_values=10).first()
    assert a["statistics"]["median_churn_probability"] == b["statistics"]["median_churn_probability"]
    top = a["top_10_high_risk"]
    assert len(top) == 10 and top[0]["customer_id"] == 998 and top[0]["risk_category"] == "high"
    assert a["risk_distribution"]["high"] == scored.where("risk_category = 'high'").count()


def test_summary_lists_the_riskiest_first(scored):
    r = scoring.prediction_summary(scored, 3).first()
    assert r["high_risk_customers"] == [998, 997, 995] and r["total_customers"] == 1000


def test_batches_hold_every_customer_once(scored):
    batches = campaigns.custom_campaign_batches(scored, "risk_category", "x", 50, partitions=8).collect()
    ids = [i for b in batches for i in b["customer_ids"]]
    assert sorted(ids) == list(range(1000))
    assert max(len(b["customer_ids"]) for b in batches) == 50
    for band in ("high", "medium", "low"):
        mine = sorted((b["batch"], b["customer_ids"]) for b in batches if b["risk_category"] == band)
        flat = [i for _, l in mine for i in l]
        assert flat == sorted(flat)
        assert all(len(l) == 50 for _, l in mine[:-1])


def test_send_slots_hold_sixty(scored):
    slots = campaigns.send_slots(scored, partitions=8).groupBy("slot").count().collect()
    assert {r["count"] for r in slots if r["slot"] < 16} == {60}
    assert sum(r["count"] for r in slots) == 1000


def test_payloads_and_skips(spark):
    df = spark.createDataFrame([(1, 0.9, "high"), (2, 0.1, "odd")], "customer_id long, churn_probability double, risk_category string")
    payload = campaigns.campaign_payloads(df, NOW).collect()
    assert [(p["customer_id"], p["campaign_id"], p["channels"]) for p in payload] == [
        (1, "CHURN_HIGH_RISK_001", ["email", "sms", "push"])
    ]
    assert payload[0]["personalization"]["discount_percentage"] == 30
    assert '"urgency_level":"critical"' in campaigns.as_json(campaigns.campaign_payloads(df, NOW)).first()["payload"]
    more = campaigns.campaign_payloads(df.withColumn("tier", F.lit("gold")), NOW, ("tier",)).first()
    assert more["personalization"]["tier"] == "gold"
    status = {r["customer_id"]: r["campaign_status"] for r in campaigns.trigger_campaigns(df, NOW).collect()}
    assert status == {1: "queued", 2: "skipped"}


def test_empty_campaign_report_is_zero(scored):
    empty = campaigns.trigger_campaigns(scored.where("customer_id < 0"), NOW)
    r = campaigns.campaign_report(empty).first()
    assert r["total_campaigns"] == 0 and r["success_rate"] == 0.0 and r["avg_churn_probability"] is None
    assert set(r["campaigns_by_status"].asDict().values()) == set(r["campaigns_by_risk"].asDict().values()) == {0}


def brute_auc(rows):
    pos, neg = [p for y, p in rows if y], [p for y, p in rows if not y]
    return sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("partitions", [1, 8])
def test_auc_with_ties(spark, partitions):
    rows = [(int(i * 7919 % 5 == 0), (i * 31 % 17) / 17) for i in range(300)]
    df = spark.createDataFrame(rows, "churned int, churn_probability double")
    got = metrics.roc_auc(df, partitions=partitions).first()["roc_auc"]
    assert got == pytest.approx(brute_auc(rows))


def test_auc_extremes(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.1)], "churned int, churn_probability double")
    assert metrics.roc_auc(df).first()["roc_auc"] == 1.0
    assert metrics.roc_auc(df.withColumn("churn_probability", F.lit(0.5))).first()["roc_auc"] == 0.5
    assert metrics.roc_auc(df.where("churned = 1")).first()["roc_auc"] is None


def test_metrics_without_positives(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.2)], "churned int, churn_probability double")
    r = metrics.classification_metrics(df).first()
    assert (r["accuracy"], r["precision"], r["recall"], r["f1_score"]) == (1.0, 0.0, 0.0, 0.0)


def test_auc_agrees_with_spark_ml(spark, scored):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator

    df = scored.withColumn("churned", (F.xxhash64("customer_id") % 3 == 0).cast("int"))
    ours = metrics.roc_auc(df).first()["roc_auc"]
    theirs = BinaryClassificationEvaluator(
        rawPredictionCol="churn_probability", labelCol="churned", numBins=0
    ).evaluate(df)
    assert ours == pytest.approx(theirs)


def test_history_queries(spark):
    rows = [(c, float((c * s) % 7), datetime(2001, 1, s)) for c in range(5) for s in range(1, 7)]
    df = spark.createDataFrame(rows, "customer_id long, churn_probability double, ts timestamp_ntz")
    kept = history.keep_last_n(df, "customer_id", "ts", "ts", 2).collect()
    assert {r["ts"].day for r in kept} == {5, 6} and len(kept) == 10
    best = {r["customer_id"]: r for r in history.best_row_per_group(df, "customer_id", "churn_probability", "ts").collect()}
    assert best[0]["ts"].day == 1 and best[3]["churn_probability"] == 6.0
    plan = history.keep_last_n(df, "customer_id", "ts", "ts", 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_snapshots(spark, scored):
    path = scratch_path(spark, "snap")
    for moment in (NOW - timedelta(days=1), NOW, NOW):  # a repeated run replaces its own snapshot only
        snapshots.write_snapshot(scored, path, moment)
    assert snapshots.read_snapshots(spark, path).count() == 2000
    newest = snapshots.latest_snapshot(spark, path)
    assert newest.count() == 1000 and newest.first()["snapshot_ts"] == "20010802_000000"
    assert all("snapshot_ts=20010802_000000/" in f for f in newest.inputFiles())
    # a day without rows is a snapshot too, not yesterday's
    snapshots.write_snapshot(scored.where("customer_id < 0"), path, NOW + timedelta(days=1))
    assert snapshots.latest_snapshot(spark, path).count() == 0


def test_drift_is_zero_without_change_and_the_same_beyond_the_limit(spark):
    base = spark.range(2000).select(F.rand(3).alias("x"), F.lit(None).cast("double").alias("none"))
    base = base.cache()
    moved = base.withColumn("x", F.col("x") + 0.3)
    same = monitoring.feature_drift_psi(base, base, ["x", "none"], 2000).collect()
    assert sorted((r["feature"], r["drifted"]) for r in same) == [("none", False), ("x", False)]
    assert all(r["psi"] == pytest.approx(0) for r in same)
    a = monitoring.feature_drift_psi(base, moved, ["x"], 2000).first()
    b = monitoring.feature_drift_psi(base, moved, ["x"], 2000, one_pass_values=10).first()
    assert a["drifted"] and a["psi"] == pytest.approx(b["psi"])


def test_validation_finds_planted_violations(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (None, 3), (9, 3)], "customer_id long, ticket_id long")
    parents = spark.createDataFrame([(1,)], "customer_id long")
    assert monitoring.orphan_rows(df, "t", "customer_id", parents).first()["violations"] == 1
    assert monitoring.key_rule_violations(df, "t", "ticket_id", {}).first()["violations"] == 1


def test_split_and_folds_are_stratified_and_repeatable(spark):
    df = spark.range(5003).select(F.col("id").alias("customer_id"), (F.col("id") % 7 == 0).cast("int").alias("churned"))
    a = prepare.train_test_split(df).groupBy("churned", "split").count().collect()
    b = prepare.train_test_split(df.repartition(7)).groupBy("churned", "split").count().collect()
    assert sorted(a) == sorted(b)
    sizes = {r["churned"]: r["count"] for r in df.groupBy("churned").count().collect()}
    for r in a:
        share = {"test": 0.2, "validation": 0.1, "train": 0.7}[r["split"]]
        assert abs(r["count"] - share * sizes[r["churned"]]) < 1
    folds = prepare.with_folds(df).groupBy("churned", "fold").count().collect()
    assert len(folds) == 10 and all(abs(r["count"] - sizes[r["churned"]] / 5) < 1 for r in folds)


def test_empty_columns_keep_their_row(spark):
    full = spark.range(100).select(F.col("id").cast("double").alias("x"), F.lit(None).cast("double").alias("y"))
    swapped = full.select(F.col("y").alias("x"), F.col("x").alias("y"))
    drift = {r["feature"]: r for r in monitoring.feature_drift_psi(full, swapped, ["x", "y"]).collect()}
    assert set(drift) == {"x", "y"} and all(r["drifted"] and r["psi"] > 1 for r in drift.values())
    assert not any(r["drifted"] for r in monitoring.feature_drift_psi(full, full, ["x", "y"]).collect())
    assert monitoring.feature_drift_psi(swapped, full, ["x"]).count() == 1
    found = {r["column_name"]: r for r in monitoring.outliers_iqr(full, ["x", "y"]).collect()}
    assert found["y"]["lower_fence"] is None and (found["y"]["below"], found["y"]["above"]) == (0, 0)
    assert found["x"]["lower_fence"] is not None


def test_history_of_predictions_is_read_as_written(spark, sf):
    """The aggregates and joins of its moments share no task with each other or with what ranks them."""
    from checks import scoring_queries as Q

    plan = Q.prediction_history(spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation") == len(Q.MOMENTS) and "Join" not in plan and "Aggregate" not in plan
