"""Panes, buckets, sketches, several as-of times, interval counts and the pair matrix, against the plain ways."""

import random
import time
import uuid
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from checks.feature_queries import ACTIVITY, AS_OF, profiles, tidy
from checks.scoring_queries import MOMENTS
from holdfast.functions import gram
from holdfast.functions.intervals import counts_within
from holdfast.functions.ordering import hot_limit
from holdfast.operators import campaigns, engagement, incremental, labels, monitoring, panes, rfm, sketches
from holdfast.operators import transactions as behaviour
from holdfast.plans import features as plan
from holdfast.plans import timeline
from holdfast.session import pinned, scratch_path
from holdfast.sources import bucketed
from holdfast.sources import fixtures as fx

T0 = datetime(2024, 1, 1)


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("as_of", ["2001-05-02 00:00:00", "2001-05-02 13:30:00", "2000-02-29 23:59:59", "1990-01-01 01:00:00"])
def test_panes_equal_the_windows(spark, sf, as_of):
    tx = fx.transactions(spark, sf)
    daily = pinned(incremental.partial_state(tx), "panes")
    assert rows(tidy(panes.rfm_from_panes(daily, tx, as_of))) == rows(tidy(rfm.rfm_windows(tx, as_of)))


def test_panes_read_rows_of_edge_days_only(spark, sf):
    tx = fx.transactions(spark, sf)
    moment = datetime(2001, 5, 2, 13, 30)
    days = {r[0] for r in panes.edge_rows(tx, moment, rfm.LOOKBACKS).select(F.col("transaction_date").cast("date")).distinct().collect()}
    assert days <= set(panes.edge_days(moment, rfm.LOOKBACKS)) and len(panes.edge_days(moment, rfm.LOOKBACKS)) == 8
    assert panes.edge_days(datetime(2001, 5, 2), rfm.LOOKBACKS) == []
    assert panes.edge_rows(tx, datetime(2001, 5, 2), rfm.LOOKBACKS).count() == 0


def test_bucketed_sources_need_no_exchange(spark, sf):
    tables = fx.all_tables(spark, sf)
    path, prefix = scratch_path(spark, "bucketed"), f"t_{uuid.uuid4().hex}"
    laid = bucketed.bucketed_sources(tables, path, prefix, 8)
    own = profiles(spark, sf)
    people = bucketed.write_bucketed(own, f"{prefix}_profiles", f"{path}/profiles", 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wide = plan.joined_groups(people, laid, AS_OF, ACTIVITY, transactions_hot=None, events_hot=None)
        text = wide._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in text and "SelectedBucketsCount" in text
        plain = plan.joined_groups(own, tables, AS_OF, ACTIVITY)
        assert rows(tidy(wide)) == rows(tidy(plain.select(wide.columns)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        bucketed.drop_tables(spark, laid | {"profiles": people}, prefix)


def test_a_heavy_customer_keeps_a_table_in_plain_files(spark):
    df = spark.range(1000).select((F.col("id") % 2).alias("customer_id"), "id")
    name = f"t_{uuid.uuid4().hex}"
    out = bucketed.write_bucketed(df, name, scratch_path(spark, "heavy"), 4, hot_rows=100)
    plan_text = out.groupBy("customer_id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" in plan_text and out.count() == 1000
    spark.sql(f"DROP TABLE {name}")
    assert hot_limit(df, "customer_id", 100) == 100 and hot_limit(df, "customer_id", 500) is None
    assert hot_limit(df.limit(0), "customer_id") is None


def test_unsplit_keys_give_the_same_rows(spark, sf):
    tx, events = fx.transactions(spark, sf), fx.user_events(spark, sf)
    for one, two in (
        (behaviour.days_between_transactions(tx, None), behaviour.days_between_transactions(tx, 3)),
        (tidy(behaviour.transaction_regularity(tx, None)), tidy(behaviour.transaction_regularity(tx, 3))),
        (engagement.sessionize_events(events, hot_rows=None), engagement.sessionize_events(events, hot_rows=3)),
        (engagement.engagement_rollup(events, hot_rows=None), engagement.engagement_rollup(events, hot_rows=3)),
    ):
        assert rows(one) == rows(two)


def test_counts_within_equal_pairs(spark):
    rng = random.Random(1)
    at = lambda: T0 + timedelta(hours=rng.randrange(24 * 200))
    bought = [(rng.choice([1, 2, 3, None]), at()) for _ in range(300)] + [(1, T0)] * 3 + [(2, None)]
    starts = [(rng.choice([1, 2, 4, None]), at()) for _ in range(80)] + [(1, T0), (1, T0), (1, T0 - timedelta(days=30)), (2, None)]
    starts += [(2, b[1]) for b in bought[:9]]
    found = counts_within(spark.createDataFrame(bought, "c long, at timestamp_ntz"), "at", spark.createDataFrame(starts, "c long, t timestamp_ntz"), "t", "c", 30)
    got = {(r["c"], r["t"]): r["n"] for r in found.collect()}
    inside = lambda c, t: sum(b[0] == c and b[1] is not None and t <= b[1] < t + timedelta(days=30) for b in bought)
    assert got == {(c, t): inside(c, t) for c, t in starts if c is not None and t is not None}


def test_conversion_of_a_heavy_customer_does_not_multiply(spark):
    n = 100_000
    second = F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("id").cast("decimal(18,6)"))
    moment = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + second
    results = spark.range(n).select(F.lit(7).alias("customer_id"), moment.alias("triggered_at"), F.lit("high").alias("risk_category"))
    tx = spark.range(n).select(F.lit(7).alias("customer_id"), moment.alias("transaction_date"))
    began = time.time()
    got = campaigns.campaign_conversion(results, tx).first()
    # trigger k has the purchases of its second and later ones
    assert (got["targeted"], got["converted"], got["purchases"]) == (n, n, n * (n + 1) // 2)
    assert time.time() - began < 60


def test_batches_of_customers_without_a_group(spark):
    audience = spark.createDataFrame([(1, "a"), (2, None), (3, "a"), (4, None), (5, None)], "customer_id long, g string")
    got = {(r["g"], r["batch"]): r["customer_ids"] for r in campaigns.custom_campaign_batches(audience, "g", "x", 2).collect()}
    assert got == {("a", 0): [1, 3], (None, 0): [2, 4], (None, 1): [5]}


def test_correlations_equal_pairs_of_known_rows(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(500, 6)) @ rng.normal(size=(6, 6)) + 1e6
    x[:, 4] = 3.5
    x[rng.random(x.shape) < 0.2] = np.nan
    x[10:, 5] = np.nan
    data = [tuple(None if np.isnan(v) and k % 2 else float(v) for k, v in enumerate(r)) for r in x]
    names = [f"c{k}" for k in range(6)]
    df = spark.createDataFrame(data, ", ".join(f"{n} double" for n in names)).repartition(5)
    got = {(r["feature_a"], r["feature_b"]): r["correlation"] for r in gram.correlations(df, names).collect()}
    assert len(got) == 15
    for (a, b), r in got.items():
        i, j = int(a[1]), int(b[1])
        both = ~np.isnan(x[:, i]) & ~np.isnan(x[:, j])
        if 4 in (i, j):
            assert r is None
        else:
            assert r == pytest.approx(np.corrcoef(x[both, i], x[both, j])[0, 1], abs=1e-9)
    assert {r["correlation"] for r in gram.correlations(df.limit(0), names).collect()} == {None}
    assert gram.correlations(df, names[:1]).count() == 0
    old = {(r["feature_a"], r["feature_b"]): r["correlation"] for r in monitoring.feature_correlation(df.na.drop(), names[:4]).collect()}
    new = {(r["feature_a"], r["feature_b"]): r["correlation"] for r in gram.correlations(df.na.drop(), names[:4]).collect()}
    assert new == pytest.approx(old, abs=1e-9)


def test_distinct_sketches_merge(spark):
    n = 60_000
    moment = F.lit("2024-01-01 00:00:00").cast("timestamp_ntz") + F.make_dt_interval((F.col("id") % 30).cast("int"))
    df = spark.range(n).select((F.col("id") % 2).alias("customer_id"), moment.alias("ts"), F.concat(F.lit("v"), F.hash("id") % 20_000).alias("value"))
    df = df.withColumn("value", F.when(F.col("value") != "v0", F.col("value")))
    daily = pinned(sketches.daily_distinct(df, "value", "ts"), "daily")
    merged = {r["customer_id"]: r["n"] for r in sketches.merged_distinct(daily, "n", "customer_id").collect()}
    whole = df.where("value IS NOT NULL").groupBy("customer_id").agg(F.hll_sketch_estimate(F.hll_sketch_agg("value", sketches.LG_K)).alias("n"))
    exact = {r["customer_id"]: r["n"] for r in df.groupBy("customer_id").agg(F.count_distinct("value").alias("n")).collect()}
    for r in whole.collect():
        assert merged[r["customer_id"]] == pytest.approx(r["n"], rel=1e-3)
        assert merged[r["customer_id"]] == pytest.approx(exact[r["customer_id"]], rel=4 * 1.04 / 64)


def test_sketch_drift_is_near_the_exact_index(spark):
    def table(seed, n, shift, missing):
        return spark.range(n).select(
            (F.randn(seed) + shift).alias("x"), F.when(F.rand(seed + 1) > missing, F.rand(seed + 2)).alias("w"),
            F.lit(None).cast("double").alias("empty"), F.lit(2.0).alias("same"),
        )

    columns = ["x", "w", "empty", "same"]
    current = pinned(table(9, 20_000, 0.4, 0.3), "now")
    now = sketches.snapshot_sketches(current, columns)
    for k, (shift, missing) in enumerate(((0.0, 0.1), (0.4, 0.3), (1.0, 0.9))):
        old = pinned(table(k, 30_000, shift, missing), "old")
        exact = {r["feature"]: r for r in monitoring.feature_drift_psi(old, current, columns).collect()}
        got = {r["feature"]: r for r in sketches.sketch_drift_psi(sketches.snapshot_sketches(old, columns), now).collect()}
        assert set(got) == set(exact)
        for c in columns:
            assert got[c]["psi"] == pytest.approx(exact[c]["psi"], abs=0.01, rel=0.1)
            assert got[c]["drifted"] == exact[c]["drifted"] or abs(exact[c]["psi"] - 0.1) < 0.02
    kept = now.collect()
    assert {r["feature"]: (r["known"], r["missing"]) for r in kept}["empty"] == (0, 20_000)


def test_several_times_equal_single_ones(spark, sf):
    tx, people = fx.transactions(spark, sf), fx.customers(spark, sf)
    many = pinned(tidy(timeline.rfm_at_times(tx, list(MOMENTS))), "many")
    marked = pinned(timeline.labels_at_times(people, tx, list(MOMENTS)), "labels")
    for m in MOMENTS:
        at = F.col("as_of") == F.lit(m).cast("timestamp_ntz")
        assert rows(many.where(at).drop("as_of")) == rows(tidy(rfm.rfm_windows(tx, m)))
        known = people.where(F.col("registration_date") < F.lit(m).cast("date"))
        assert rows(marked.where(at).drop("as_of")) == rows(labels.churn_labels(known, tx, m))
    plan_text = timeline.rfm_at_times(tx, list(MOMENTS))._jdf.queryExecution().executedPlan().toString()
    assert plan_text.count("FileScan") == 1
