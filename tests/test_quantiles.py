import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.functions.quantiles import exact_quantiles

P = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


@pytest.mark.parametrize("limit", [0, 10**6])
def test_equal_to_numpy(spark, limit):
    df = spark.range(30_000).select(
        F.rand(1).alias("u"),
        F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise(F.randn(2)).alias("heavy"),
        F.when(F.col("id") % 7 > 0, F.col("id").cast("int")).alias("gaps"),
        F.lit(None).cast("double").alias("none"),
        F.lit(1.5).alias("one"),
    ).cache()
    got = exact_quantiles(df, df.columns, P, one_pass_values=limit)
    pdf = df.toPandas()
    for c in ("u", "heavy", "gaps", "one"):
        want = np.quantile(pdf[c].dropna().astype(float), P)
        assert got[c] == pytest.approx(list(want), rel=1e-12, abs=1e-12)
    assert got["none"] == [None] * len(P)


@pytest.mark.parametrize("limit", [0, 10**6])
def test_few_rows_and_none(spark, limit):
    df = spark.createDataFrame([(3.0,), (1.0,)], "x double")
    assert exact_quantiles(df, ["x"], [0.5, 0.75], one_pass_values=limit)["x"] == [2.0, 2.5]
    empty = df.where("x > 9")
    assert exact_quantiles(empty, ["x"], [0.5], one_pass_values=limit)["x"] == [None]
