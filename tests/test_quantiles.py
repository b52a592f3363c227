import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from sievekit.plans.quantiles import exact_quantiles, exact_quantiles_many


@pytest.mark.parametrize("n", [1, 2, 3, 5, 40, 3000])
def test_equal_to_pandas(spark, n):
    rng = random.Random(n)
    rows = [(rng.choice([rng.random(), 0.5, float(rng.randint(0, 3))]), float(rng.randint(0, 5)), None if rng.random() < 0.3 else rng.gauss(0, 1)) for _ in range(n)]
    df, pdf = spark.createDataFrame(rows, "a double, b double, c double").repartition(3), pd.DataFrame(rows, columns=list("abc"), dtype=float)
    probs = [0.0, 0.01, 0.25, 0.5, 0.75, 1.0]
    for options in ({}, {"accuracy": 20}, {"most_values": 2, "rows_per_bucket": 7}):
        got = exact_quantiles_many(df, {k: F.col(k) for k in "abc"}, probs, **options)
        for k in "abc":
            want = pdf[k].dropna().quantile(probs).tolist()
            assert got[k] == (pytest.approx(want, abs=1e-12) if pdf[k].notna().any() else [None] * len(probs)), (k, options)


def test_no_rows(spark):
    df = spark.createDataFrame([(None,)], "a double")
    assert exact_quantiles(df, F.col("a"), [0.5]) == [None] == exact_quantiles(df.where("false"), F.col("a"), [0.5])
