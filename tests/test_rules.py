import math

from pyspark.sql import functions as F

from sievekit.operators import rules as ru


def test_rule_flags_null_nan_and_limit(spark):
    df = spark.createDataFrame(
        [(1, 500.0, 5.0, 5, 10), (2, 500.01, 5.1, 6, 11), (3, None, float("nan"), None, 3),
         (4, 600.0, 1.0, 6, 0)],
        "id int, molecular_weight double, logp double, num_h_donors int, num_h_acceptors int")
    out = {r["id"]: r for r in ru.rule_flags(df).collect()}
    assert out[1]["n_violations"] == 0 and out[1]["passes"]          # exactly on the limit
    assert out[2]["n_violations"] == 4 and not out[2]["passes"]
    assert out[3]["n_violations"] == 0 and out[3]["passes"]          # null / NaN count as 0
    assert out[4]["n_violations"] == 2 and not out[4]["passes"]
    nulls = {r["id"]: r for r in ru.rule_flags(df, null_policy="null").collect()}
    assert nulls[3]["n_violations"] is None and nulls[3]["passes"] is None


def test_rule_flags_sum_matches_flags(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet")
    rules = [("a", ru.above("l_quantity", 45)), ("b", ru.above("l_discount", 0.09))]
    out = ru.rule_flags(df, rules)
    bad = out.filter(F.col("a") + F.col("b") != F.col("n_violations")).count()
    assert bad == 0
    summary = ru.rule_summary(out).collect()
    assert sum(r["n_rows"] for r in summary) == df.count()
    assert math.isclose(sum(r["pct_rows"] for r in summary), 100.0)


def test_weighted_score_threshold_before_rounding(spark):
    # 0.50004 rounds to 0.5 but the label uses the unrounded value
    df = spark.createDataFrame([(1, 0.50004), (2, 0.5), (3, 1.7), (4, -0.2)], "id int, noise double")
    out = {r["id"]: r for r in ru.weighted_rule_score(df, terms=[], noise=F.col("noise")).collect()}
    assert out[1]["score"] == 0.5 and out[1]["label"] is True
    assert out[2]["score"] == 0.5 and out[2]["label"] is False
    assert out[3]["score"] == 1.0 and out[4]["score"] == 0.0


def test_text_descriptors(spark):
    df = spark.createDataFrame([("One two\none TWO 12!",), ("",), (None,), ("a\na\nb",)], "s string")
    r = ru.text_descriptors(df, "s").collect()
    assert r[0]["n_chars"] == 19 and r[0]["n_tokens"] == 5 and r[0]["distinct_token_share"] == 3 / 5
    assert (r[0]["digit_share"], r[0]["upper_share"], r[0]["punct_share"]) == (2 / 19, 4 / 19, 1 / 19)
    assert r[0]["repeated_line_share"] == 0.0 and r[3]["repeated_line_share"] == 1.0 - 2 / 3
    assert all(r[1][c] == 0 for c in ru.DESCRIPTORS)
    assert all(r[2][c] is None for c in ru.DESCRIPTORS)


def test_banded_class_closed_ranges(spark):
    df = spark.createDataFrame([(300.0, 2.0), (500.0, 4.0), (299.99, 4.01), (400.0, 1.0)], "a double, b double")
    out = ru.banded_class(df, 0.5, [("a", 300, 500, 0.2), ("b", 2, 4, 0.2)], [(0.7, "active"), (0.4, "moderate")], "inactive")
    assert [r["band"] for r in out.collect()] == ["active", "active", "moderate", "moderate"]


def test_desirability_in_unit_interval(spark):
    df = spark.createDataFrame([(x,) for x in (0.0, 10.0, 25.0, 40.0)], "q double")
    out = ru.desirability_score(df, [("q", 0.0, 1.0, 25.0, 20.0, 3.0, 3.0, 1.0, 1.0)]).collect()
    vals = [r["desirability"] for r in out]
    assert all(0.0 < v <= 1.0 for v in vals)
    assert max(vals) == vals[2]


def test_candidate_screen_top_k(spark):
    df = spark.createDataFrame([(i, 0.9, -1.0, i / 10) for i in range(10)],
                               "id int, conf double, sol double, score double")
    out = ru.candidate_screen(df, "id", "conf", "sol", "score", k=3).collect()
    assert [r["id"] for r in out] == [9, 8, 7]
