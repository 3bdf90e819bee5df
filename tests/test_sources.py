import datetime as dt

import pytest

from holdfast.session import scratch_path, shared_folder
from holdfast.sources import scans
from holdfast.sources.schemas import SOURCES

ROW = ("t1", "c1", dt.datetime(2001, 7, 1, 5), 12.5, "buy", "card", "toys", 2, 0.1, False)


@pytest.mark.parametrize("fmt", ["parquet", "orc", "json", "csv"])
def test_every_file_format_gives_the_declared_schema(spark, fmt):
    names = SOURCES["transactions"].names
    path = scratch_path(spark, fmt)
    df = spark.createDataFrame([ROW], names).withColumn("transaction_date", spark_ntz("transaction_date"))
    df.write.format(fmt).options(header="true").save(path)
    options = {"header": "true"} if fmt == "csv" else {}
    back = scans.read_table(spark, "transactions", path, fmt, **options)
    assert back.schema["transaction_date"].dataType.simpleString() == "timestamp_ntz"
    row = scans.scan_transactions(back, dt.datetime(2001, 8, 2)).first()
    assert (row["customer_id"], float(row["transaction_amount"]), row["quantity"]) == ("c1", 12.5, 2)
    assert row["transaction_date"] == dt.datetime(2001, 7, 1, 5)


def spark_ntz(name):
    from pyspark.sql import functions as F

    return F.col(name).cast("timestamp_ntz")


def test_zoned_timestamps_are_conformed(spark):
    df = spark.createDataFrame([ROW], SOURCES["transactions"].names)
    assert df.schema["transaction_date"].dataType.simpleString() == "timestamp"
    assert scans.conform(df, SOURCES["transactions"]).schema["transaction_date"].dataType.simpleString() == "timestamp_ntz"


def test_shared_folder_is_the_one_the_cluster_names(spark, monkeypatch):
    assert scratch_path(spark, "x").startswith(shared_folder(spark))
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: "hdfs://shared/folder/")
    assert shared_folder(spark) == "hdfs://shared/folder"
