from datetime import datetime, timedelta

from holdfast.operators import engagement, incremental
from holdfast.session import pinned, scratch_path
from holdfast.sources import fixtures as fx
from holdfast.streaming import engagement as stream

T0 = datetime(2024, 1, 1)
SCHEMA = "customer_id long, event_timestamp timestamp_ntz, event_type string, time_spent_seconds double"


def write(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def run(spark, folder, path):
    schema = spark.createDataFrame([], SCHEMA).schema
    arriving = stream.read_stream(spark, folder, schema)
    stream.start(stream.windowed_counts(arriving), f"{path}/out", f"{path}/state").awaitTermination()
    return spark.read.parquet(f"{path}/out")


def test_restarts_late_rows_and_open_windows(spark):
    path = scratch_path(spark, "stream-test")
    folder = f"{path}/in"
    write(spark, folder, [(1, T0 + timedelta(hours=h), "click", 1.0) for h in range(0, 60, 5)])
    first = run(spark, folder, path)
    days = {r["window_start"].day for r in first.collect()}
    assert days == {1, 2}  # the third day is still open
    both = stream.with_open_windows(first, spark.read.parquet(folder))
    batch = stream.windowed_counts(spark.read.parquet(folder))
    assert sorted(map(tuple, both.collect())) == sorted(map(tuple, batch.collect()))

    # a late row of a sealed day is dropped, a row of the open day counts, sealed windows land once
    write(spark, folder, [(1, T0 + timedelta(hours=1), "click", 1.0), (1, T0 + timedelta(hours=70), "click", 1.0)])
    write(spark, folder, [(1, T0 + timedelta(days=5), "click", 1.0)])
    second = {r["window_start"].day: r["events"] for r in run(spark, folder, path).collect()}
    assert second[1] == 5 and second[3] == 3 and 6 not in second


def test_incremental_equals_full_in_several_steps(spark, sf):
    tx = fx.transactions(spark, sf)
    state = incremental.partial_state(tx.where("transaction_date < TIMESTAMP_NTZ '1996-01-01 00:00:00'"))
    for year in (1998, 2000, 2003):
        upto = tx.where(f"transaction_date < TIMESTAMP_NTZ '{year}-01-01 00:00:00'")
        merged, figures = incremental.incremental_rollup(upto, pinned(state, "state"))
        state = merged
    full = incremental.rollup_of(incremental.partial_state(tx))
    assert sorted(map(str, figures.collect())) == sorted(map(str, full.collect()))


def test_incremental_from_nothing(spark, sf):
    tx = fx.transactions(spark, sf)
    empty = incremental.partial_state(tx.where("1 = 0"))
    _, figures = incremental.incremental_rollup(tx, empty)
    assert figures.count() == incremental.merged_days(incremental.partial_state(tx)).count()


def test_late_and_tied_rows_count(spark):
    schema = "customer_id long, transaction_amount double, transaction_date timestamp_ntz"
    first = [(1, 1.0, T0), (1, 2.0, T0 + timedelta(days=1)), (2, 3.0, T0 + timedelta(days=3)), (2, 4.0, T0), (3, 5.0, None)]
    later = [(2, 9.0, T0 + timedelta(days=3)), (1, 8.0, T0 + timedelta(hours=3)), (4, 7.0, T0 + timedelta(days=9))]
    state = pinned(incremental.partial_state(spark.createDataFrame(first, schema)), "state")
    tx = spark.createDataFrame(first + later, schema)
    assert {r["day"].day for r in incremental.touched_days(tx, "transaction_date", state).collect()} == {1, 4, 10}
    merged, figures = incremental.incremental_rollup(tx, state)
    full = incremental.partial_state(tx)
    assert sorted(map(str, merged.collect())) == sorted(map(str, full.collect()))
    assert sorted(map(str, figures.collect())) == sorted(map(str, incremental.rollup_of(full).collect()))
    # rows taken back
    _, fewer = incremental.incremental_rollup(spark.createDataFrame(first[:2], schema), pinned(full, "state"))
    assert [r["transaction_count"] for r in fewer.collect()] == [2]


def test_times_below_a_hundredth_are_kept(spark):
    rows = [(1, T0, "click", 0.004)] * 9
    df = spark.createDataFrame(rows, SCHEMA)
    assert stream.windowed_counts(df).first()["time_spent_seconds"] == 0.036
    assert engagement.engagement_rollup(df).first()["total_time_spent"] == 0.036


def test_incremental_notices_exchanged_and_corrected_rows(spark):
    from datetime import datetime
    from decimal import Decimal

    schema = "customer_id long, transaction_date timestamp_ntz, transaction_amount decimal(15,2)"
    at = lambda day, hour: datetime(2024, 1, day, hour)
    first = [(1, at(1, 1), Decimal(5)), (2, at(1, 2), Decimal(7)), (1, at(2, 1), Decimal(9)), (2, at(3, 1), Decimal(4)), (None, at(4, 1), None)]
    state = pinned(incremental.partial_state(spark.createDataFrame(first, schema)), "state")
    # one row lost and a late one gained on day 1, a value corrected on day 2
    then = [(1, at(1, 1), Decimal(5)), (3, at(1, 9), Decimal(7)), (1, at(2, 1), Decimal(8)), *first[3:]]
    tx = spark.createDataFrame(then, schema)
    assert {r["day"].day for r in incremental.touched_days(tx, "transaction_date", state).collect()} == {1, 2}
    merged, figures = incremental.incremental_rollup(tx, state)
    assert sorted(map(str, figures.collect())) == sorted(map(str, incremental.rollup_of(incremental.partial_state(tx)).collect()))
    assert incremental.touched_days(tx, "transaction_date", merged).count() == 0
