from pyspark.sql import functions as F

from sievekit.operators import profile as pr
from sievekit.operators import quality as qu


def test_duplicate_count_nulls_equal(spark):
    df = spark.createDataFrame([(None,), (None,), ("a",), ("a",), ("a",), ("b",)], "k string")
    r = qu.duplicate_count(df, ["k"]).first()
    assert (r["n_rows"], r["n_distinct"], r["n_duplicates"]) == (6, 3, 3)


def test_missing_summary_counts_nan(spark):
    df = spark.createDataFrame([(1.0, "x"), (float("nan"), None), (None, "y"), (2.0, "z")], "a double, b string")
    out = {r["column_name"]: r for r in qu.missing_summary(df).collect()}
    assert out["a"]["missing_count"] == 2 and out["a"]["missing_pct"] == 50.0
    assert out["b"]["missing_count"] == 1


def test_range_checks_nan_null_limit(spark):
    df = spark.createDataFrame([(0.0,), (10.0,), (float("nan"),), (None,)], "x double")
    out = {r["check_name"]: r for r in qu.range_checks(df, [("in", "x", 0, 10), ("pos", "x", 0, None)]).collect()}
    assert out["in"]["n_fail"] == 2 and out["in"]["status"] == "FAIL"
    ok = qu.range_checks(df.filter(F.col("x").isNotNull() & ~F.isnan("x")), [("in", "x", 0, 10)]).first()
    assert ok["status"] == "PASS"


def test_histogram_equal_values_and_max(spark):
    df = spark.createDataFrame([(5.0,)] * 4, "v double")
    h = pr.histogram(df, "v", 10).orderBy("bin").collect()
    assert len(h) == 10 and sum(r["count"] for r in h) == 4
    assert h[0]["bin_lo"] == 4.5 and h[-1]["bin_hi"] == 5.5
    df2 = spark.createDataFrame([(0.0,), (1.0,), (10.0,)], "v double")
    h2 = pr.histogram(df2, "v", 5).orderBy("bin").collect()
    assert h2[-1]["count"] == 1 and h2[0]["count"] == 2   # max lands in the last, closed bin


def test_value_counts_share(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,)], "c string")
    out = {r["c"]: r for r in pr.value_counts(df, "c").collect()}
    assert out["a"]["count"] == 2 and abs(out["a"]["share"] - 2 / 3) < 1e-12
    assert None not in out


def test_describe_full_matches_pandas(spark):
    import pandas as pd
    vals = [1.0, 2.0, 4.0, 8.0, 16.0]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r = pr.describe_full(df, ["x"]).first()
    d = pd.Series(vals).describe()
    assert r["count"] == 5 and abs(r["std"] - round(d["std"], 6)) < 1e-9
    assert (r["p25"], r["p50"], r["p75"]) == (d["25%"], d["50%"], d["75%"])


def test_correlation_pairs(spark):
    df = spark.createDataFrame([(float(i), 2.0 * i, -float(i)) for i in range(5)], "a double, b double, c double")
    out = {(r["col_a"], r["col_b"]): r["r"] for r in pr.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert out == {("a", "b"): 1.0, ("a", "c"): -1.0, ("b", "c"): -1.0}


def test_exact_quantiles_bucketed_path_matches_numpy(spark):
    import numpy as np
    from sievekit.plans.quantiles import exact_quantiles, exact_quantiles_many
    rng = np.random.default_rng(5)
    vals = np.concatenate([rng.normal(size=400), np.full(300, 1.5)])   # one value holds 3/7 of rows
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    want = list(np.quantile(vals, [0.1, 0.25, 0.5, 0.9]))
    got = exact_quantiles(df, df["x"], [0.1, 0.25, 0.5, 0.9], rows_per_bucket=50)
    assert np.allclose(got, want, rtol=0, atol=1e-12)
    many = exact_quantiles_many(df, {"a": df["x"], "b": df["x"] * 2}, [0.5], rows_per_bucket=50)
    assert abs(many["a"][0] - np.median(vals)) < 1e-12 and abs(many["b"][0] - 2 * np.median(vals)) < 1e-12


def test_duplicates_of_an_empty_table(spark):
    df = spark.createDataFrame([], "a int, t string")
    assert tuple(qu.duplicate_count(df, ["a"]).first()) == (0, 0, 0)
    report = {r["check_name"]: r for r in qu.quality_report(df, ["a"], "t").collect()}
    assert report["duplicate_keys"]["value"] == 0 and report["duplicate_keys"]["status"] == "PASS"
