"""State kept per file, per batch and per open session, against the whole computation."""

import random
from collections import Counter
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from holdfast.operators import engagement
from holdfast.operators import file_increments as files
from holdfast.operators import incremental
from holdfast.session import scratch_path
from holdfast.streaming import engagement as stream
from holdfast.streaming import rollup, sessions

TX = "customer_id long, transaction_date timestamp_ntz, transaction_amount decimal(15,2)"
T0 = datetime(2024, 1, 1)


def rows(df):
    return sorted(map(str, df.collect()))


def purchases(seed, n=200, days=60):
    rng = random.Random(seed)
    return [(rng.choice([1, 2, 3, 4, None]), T0 + timedelta(days=rng.randrange(days), hours=rng.randrange(24)), Decimal(rng.randrange(1, 9999)) / 100) for _ in range(n)]


@pytest.fixture
def folder(spark):
    return scratch_path(spark, "increments")


def put(spark, path, data, mode="overwrite", schema=TX):
    spark.createDataFrame(data, schema).coalesce(1).write.mode(mode).parquet(path)


def check_files(spark, folder, read):
    n = files.refresh(spark, f"{folder}/in", TX + ", part int", f"{folder}/state")
    tx = spark.read.schema(TX + ", part int").parquet(f"{folder}/in")
    got = incremental.rollup_of(files.current(spark, f"{folder}/state"))
    assert rows(got) == rows(incremental.rollup_of(incremental.partial_state(tx)))
    assert n == read


def test_only_changed_files_are_read(spark, folder, monkeypatch):
    for k in range(4):
        put(spark, f"{folder}/in/part={k}", purchases(k))
    check_files(spark, folder, 4)
    check_files(spark, folder, 0)
    put(spark, f"{folder}/in/part=9", purchases(9, days=400))  # late and new rows in a new file
    check_files(spark, folder, 1)
    corrected = purchases(1)
    corrected[0] = (*corrected[0][:2], Decimal("9.99"))
    put(spark, f"{folder}/in/part=1", corrected[:-1] + [(7, T0, Decimal(1))])  # a value corrected, a row exchanged
    now = files.listing(spark, f"{folder}/in")
    changed = files.changed_files(now, files.known_files(spark, f"{folder}/state"))
    delta = files.read_changed(spark, f"{folder}/in", TX + ", part int", changed)
    assert [f.rpartition("/")[2] for f in delta.inputFiles()] == [r["file"].rpartition("/")[2] for r in changed.collect()]
    assert len(delta.inputFiles()) == 1 and "/part=1/" in delta.inputFiles()[0]
    assert delta.count() == 200
    check_files(spark, folder, 1)
    put(spark, f"{folder}/in/part=2", [])  # rows removed, their file left
    check_files(spark, folder, 1)
    whole = spark.read.schema(TX + ", part int").parquet(f"{folder}/in").drop("part").collect()
    for k in (0, 1, 2, 3, 9):
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/in/part={k}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    put(spark, f"{folder}/in/part=100", whole)  # a compaction
    check_files(spark, folder, 1)
    monkeypatch.setattr(files, "MAX_PATHS", 1)  # more changed files than are read by name
    put(spark, f"{folder}/in/part=101", purchases(5))
    put(spark, f"{folder}/in/part=102", purchases(6))
    check_files(spark, folder, 2)


def test_killed_before_its_list_was_written(spark, folder, monkeypatch):
    put(spark, f"{folder}/in/part=0", purchases(0))
    check_files(spark, folder, 1)
    put(spark, f"{folder}/in/part=1", purchases(1))
    incremental.partial_state(spark.createDataFrame(purchases(1), TX).withColumn("_file", F.lit("half")), "_file").write.parquet(f"{folder}/state/parts/run=1")
    check_files(spark, folder, 1)


def arriving(spark, folder, per_batch=1):
    return stream.read_stream(spark, folder, spark.createDataFrame([], TX).schema, files_per_batch=per_batch)


def full(data, spark):
    return rows(incremental.rollup_of(incremental.partial_state(spark.createDataFrame(data, TX))))


def test_stream_killed_between_batches(spark, folder, monkeypatch):
    data = []
    for k in range(7):
        data += purchases(k, 40)
        put(spark, f"{folder}/in", purchases(k, 40), "append")
    put_batch = rollup.merge_batch(f"{folder}/state", 3)

    def dies(batch, number):
        put_batch(batch, number)
        if number == 4:
            raise RuntimeError("killed after its batch was merged, before that was noted")

    monkeypatch.setattr(rollup, "merge_batch", lambda path, compact: dies)
    with pytest.raises(Exception):
        rollup.start(arriving(spark, f"{folder}/in"), f"{folder}/state", f"{folder}/checkpoint").awaitTermination()
    monkeypatch.undo()
    rollup.start(arriving(spark, f"{folder}/in"), f"{folder}/state", f"{folder}/checkpoint", 3).awaitTermination()
    assert rollup._numbers(spark, f"{folder}/state/base") == [2, 5]
    assert rows(incremental.rollup_of(rollup.state(spark, f"{folder}/state"))) == full(data, spark)
    # a batch that comes again changes nothing
    again = spark.createDataFrame(purchases(6, 40), TX)
    before = rows(rollup.state(spark, f"{folder}/state"))
    order = {tuple(r): n for n in range(7) for r in spark.read.parquet(f"{folder}/state/parts/batch={n}").collect()}
    number = order[tuple(incremental.partial_state(again).first())]
    rollup.merge_batch(f"{folder}/state", 3)(again, number)
    assert rows(rollup.state(spark, f"{folder}/state")) == before
    rollup.vacuum(spark, f"{folder}/state")
    assert rows(rollup.state(spark, f"{folder}/state")) == before
    assert rollup._numbers(spark, f"{folder}/state/base") == [5] and rollup._numbers(spark, f"{folder}/state/parts") == [6]
    more = purchases(50, 10)
    put(spark, f"{folder}/in", more, "append")
    rollup.start(arriving(spark, f"{folder}/in"), f"{folder}/state", f"{folder}/checkpoint", 3).awaitTermination()
    assert rows(incremental.rollup_of(rollup.state(spark, f"{folder}/state"))) == full(data + more, spark)


def test_state_before_the_first_batch(spark, folder):
    assert rollup.state(spark, folder) is None


EVENTS = "customer_id long, event_timestamp timestamp_ntz"


def run_sessions(spark, folder):
    schema = spark.createDataFrame([], EVENTS).schema
    found = sessions.sessions(stream.read_stream(spark, f"{folder}/in", schema, files_per_batch=1))
    stream.start(found, f"{folder}/out", f"{folder}/checkpoint").awaitTermination()
    sealed = spark.read.schema(found.schema).parquet(f"{folder}/out")
    return sealed, sealed.unionByName(sessions.open_sessions(spark, f"{folder}/checkpoint"))


def test_sealed_and_open_sessions_equal_the_batch(spark, folder):
    minute, tick = timedelta(minutes=1), timedelta(microseconds=1)
    first = [(1, T0), (1, T0 + 30 * minute), (1, T0 + 60 * minute + tick), (2, T0), (None, T0 + 5 * minute), (2, None)]
    first += [(3, T0 + 300 * minute), (3, T0 + 300 * minute)]
    put(spark, f"{folder}/in", first, schema=EVENTS)
    sealed, both = run_sessions(spark, folder)
    assert sealed.count() == 4 and rows(both) == rows(engagement.sessionize_events(spark.createDataFrame(first, EVENTS)))
    # late but inside the watermark (240 minutes): joins the open session of 3, and opens and joins those of 4
    inside = [(3, T0 + 271 * minute), (4, T0 + 215 * minute), (4, T0 + 245 * minute), (5, T0 + 420 * minute)]
    put(spark, f"{folder}/in", inside, "append", EVENTS)
    sealed, both = run_sessions(spark, folder)
    kept = first + inside
    assert rows(both) == rows(engagement.sessionize_events(spark.createDataFrame(kept, EVENTS)))
    # outside: dropped, and sealed sessions land once
    put(spark, f"{folder}/in", [(1, T0 + 10 * minute), (6, T0 + 20 * minute)], "append", EVENTS)
    put(spark, f"{folder}/in", [(5, T0 + 450 * minute), (7, T0 + 900 * minute)], "append", EVENTS)
    sealed, both = run_sessions(spark, folder)
    kept += [(5, T0 + 450 * minute), (7, T0 + 900 * minute)]
    assert rows(both) == rows(engagement.sessionize_events(spark.createDataFrame(kept, EVENTS)))
    assert max(Counter(map(str, sealed.collect())).values()) == 1 and sealed.count() == both.count() - 1


def test_sessions_of_a_table_equal_the_operator(spark, sf):
    from holdfast.sources import fixtures as fx

    events = fx.user_events(spark, sf)
    assert rows(sessions.sessions(events)) == rows(engagement.sessionize_events(events))
