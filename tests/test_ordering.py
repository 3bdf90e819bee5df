"""Order-dependent operators: the split paths must equal the plain ones and brute force."""

from datetime import datetime, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F

from holdfast.functions import ordering
from holdfast.operators import engagement, transactions

T0 = datetime(2001, 1, 1)


@pytest.fixture(scope="module")
def heavy(spark):
    """Customer 1 has a third of the rows: ties, many instants in a minute, gaps of days."""
    rows, i = [], 0
    for n in range(120):
        step = timedelta(seconds=n // 3 * 7) if n < 60 else timedelta(days=(n - 59) // 2, hours=n % 5)
        rows.append((1, i, T0 + step))
        i += 1
    for c in range(2, 42):
        for n in range(6):
            rows.append((c, i, T0 + timedelta(hours=31 * n * (c % 4), minutes=29 + n)))
            i += 1
    return spark.createDataFrame(rows, "customer_id long, transaction_id long, transaction_date timestamp_ntz")


def brute(df):
    pdf = df.toPandas().sort_values(["customer_id", "transaction_date", "transaction_id"])
    gap = pdf.groupby("customer_id")["transaction_date"].diff().dt.days
    return pdf.assign(gap=gap)


def test_days_between_equal_with_and_without_split(heavy):
    want = {r.transaction_id: None if pd.isna(r.gap) else int(r.gap) for r in brute(heavy).itertuples()}
    for hot_rows in (10**6, 50, 1):
        got = transactions.days_between_transactions(heavy, hot_rows).collect()
        assert {r["transaction_id"]: r["days_between_transactions"] for r in got} == want


def test_regularity_equal_with_and_without_split(heavy):
    groups = brute(heavy).groupby("customer_id")["gap"]
    mean, std = groups.mean(), groups.std()
    for hot_rows in (10**6, 50, 1):
        for r in transactions.transaction_regularity(heavy, hot_rows).collect():
            c = r["customer_id"]
            assert r["avg_days_between_transactions"] == pytest.approx(mean[c])
            assert r["std_days_between_transactions"] == pytest.approx(std[c])


def test_one_transaction_has_no_interval(spark):
    df = spark.createDataFrame([(1, 1, T0)], "customer_id long, transaction_id long, transaction_date timestamp_ntz")
    for hot_rows in (10, 0):
        (row,) = transactions.transaction_regularity(df, hot_rows).collect()
        assert row["avg_days_between_transactions"] is None
        assert row["std_days_between_transactions"] is None


def test_two_at_one_instant_are_zero_days_apart(spark):
    df = spark.createDataFrame(
        [(1, 1, T0), (1, 2, T0)], "customer_id long, transaction_id long, transaction_date timestamp_ntz"
    )
    for hot_rows in (10, 0):
        (row,) = transactions.transaction_regularity(df, hot_rows).collect()
        assert row["avg_days_between_transactions"] == 0.0
        assert row["std_days_between_transactions"] is None


def test_sessions_equal_with_and_without_split(heavy):
    events = heavy.withColumnRenamed("transaction_date", "event_timestamp").drop("transaction_id")
    plain = sorted(map(tuple, engagement.sessionize_events(events, 30).collect()))
    assert plain == sorted(map(tuple, engagement.sessionize_events(events, 30, hot_rows=1).collect()))
    assert sum(r[3] for r in plain) == events.count()
    counts = {r["customer_id"]: r["session_count"] for r in engagement.session_counts(events, 30, 1).collect()}
    for c, n in counts.items():
        assert n == sum(1 for r in plain if r[0] == c)


def test_session_gap_of_exactly_the_limit_stays_open(spark):
    stamps = [T0, T0 + timedelta(minutes=30), T0 + timedelta(minutes=60, microseconds=1)]
    df = spark.createDataFrame([(1, t) for t in stamps], "customer_id long, event_timestamp timestamp_ntz")
    sessions = sorted(map(tuple, engagement.sessionize_events(df, 30).collect()))
    assert [r[3] for r in sessions] == [2, 1]


def test_given_session_ids_are_counted(spark):
    df = spark.createDataFrame(
        [(1, T0, "a"), (1, T0, "a"), (1, T0, "b")], "customer_id long, event_timestamp timestamp_ntz, session_id string"
    )
    assert engagement.session_counts(df).first()["session_count"] == 2


def test_rank_over_the_table_with_heavy_ties(spark):
    df = spark.range(3000).select("id", F.when(F.col("id") % 3 == 0, 0.5).otherwise(F.rand(7)).alias("p"))
    df = df.cache()
    ranked = ordering.with_rank(df, [F.col("p").desc(), F.col("id").asc()], "r", 16).toPandas()
    want = df.toPandas().sort_values(["p", "id"], ascending=[False, True])["id"].tolist()
    assert ranked.sort_values("r")["id"].tolist() == want
    assert ranked["r"].tolist().sort() is None and set(ranked["r"]) == set(range(1, 3001))


def test_running_sums_over_the_table(spark):
    df = spark.range(1000).select("id", (F.col("id") * 7 % 13).alias("x"))
    pdf = df.toPandas().sort_values("id", ascending=False)
    want = pdf["x"].cumsum()[::-1].tolist()
    for rows in (None, 1000):
        got = ordering.with_running_sums(df, [F.col("id").desc()], {"s": "x"}, 16, rows).toPandas().sort_values("id")
        assert got["s"].tolist() == want


def test_segments_stay_balanced_with_one_heavy_group(spark):
    df = spark.range(4000).select("id", F.when(F.col("id") < 2000, "a").otherwise("b").alias("g"))
    sizes = ordering.range_segments(df, [F.col("g"), F.col("id")], 8).groupBy("_segment").count().toPandas()
    assert sizes["count"].max() < 1500


def test_missing_and_repeated_ids_equal_with_and_without_split(spark):
    rows = [
        (1, None, T0 + timedelta(days=11)), (1, 5, T0), (1, 7, T0 + timedelta(days=15)), (1, 7, T0 + timedelta(days=15)),
        (1, None, T0 + timedelta(days=15)), (None, 1, T0), (None, 2, T0 + timedelta(days=2)), (2, 3, None),
    ]
    df = spark.createDataFrame(rows, "customer_id long, transaction_id long, transaction_date timestamp_ntz")
    found = [sorted(map(str, transactions.days_between_transactions(df, n).collect())) for n in (10**6, 2, 0)]
    assert found[0] == found[1] == found[2]
    gaps = [(r["transaction_id"], r["days_between_transactions"]) for r in transactions.days_between_transactions(df, 0).where("customer_id = 1").collect()]
    assert sorted(gaps, key=str) == sorted([(5, None), (None, 11), (None, 4), (7, 0), (7, 0)], key=str)


def test_building_a_plan_runs_no_job(spark, heavy):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plans-only", "")
    transactions.days_between_transactions(heavy, 50)
    transactions.transaction_regularity(heavy, 50)
    engagement.sessionize_events(heavy.withColumnRenamed("transaction_date", "event_timestamp"), 30, 50)
    jobs = tracker.getJobIdsForGroup("plans-only")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not jobs
