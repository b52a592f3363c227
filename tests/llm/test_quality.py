import numpy as np
import pytest
from pyspark.sql import functions as F

from sievekit.llm.common import fold_of
from sievekit.llm.quality import Features, fit_ordinal, learn_quality, score_quality
from sievekit.llm.queries import QUERIES


def test_fit_recovers_order():
    rng = np.random.default_rng(2)
    x = rng.normal(size=600)
    grades = np.digitize(1.5 * x + rng.logistic(size=600) * 0.3, [-1, 0.5, 1.5])
    model = fit_ordinal([(np.array([3]), np.array([v])) for v in x], grades, 4, 4, rounds=800)
    assert (np.diff(model.thresholds) > 0).all() and model.weights[3] > 2
    tails = model.tails(model.weights[3] * x)
    assert (np.diff(tails, axis=1) < 0).all()
    assert np.corrcoef(tails.sum(axis=1), grades)[0, 1] > 0.85


def test_likelihood_gradient_is_right():
    """One step from the start must lower the loss for any data."""
    rng = np.random.default_rng(0)
    rows = [(np.unique(rng.integers(0, 16, 4)), None) for _ in range(80)]
    rows = [(a, rng.normal(size=len(a))) for a, _ in rows]
    grades = rng.integers(0, 3, 80)

    def loss(m):
        z = np.array([m.weights[a] @ x for a, x in rows])
        edges = np.column_stack([np.ones(80), m.tails(z), np.zeros(80)])
        return -np.log(edges[np.arange(80), grades] - edges[np.arange(80), grades + 1]).mean()

    losses = [loss(fit_ordinal(rows, grades, 3, 4, rounds=n, rate=0.01, ridge=0)) for n in (1, 20, 100, 400)]
    assert losses == sorted(losses, reverse=True)


def test_features_of_odd_texts():
    f = Features(10, limit=5)
    assert len(f.row(None)[0]) == len(f.row(" \n")[0]) == 1
    again = [f.row("one two three four five six seven! 8 (x) ++") for _ in range(2)]
    assert (again[0][0] == again[1][0]).all() and (np.diff(again[0][0]) > 0).all()


def test_odd_rows(docs_of, odd_rows, spark):
    docs = docs_of(odd_rows)
    ratings = spark.createDataFrame([(1, 0), (5, 2), (7, 1), (8, None), (None, 1)], "doc_id bigint, grade int")
    model = learn_quality(docs, ratings, 3)
    out = score_quality(docs, model, 2)
    assert out.columns == ["doc_id", "expected_grade", "grade", "tail", "selected"] and out.count() == len(odd_rows)
    assert out.where("expected_grade BETWEEN 0 AND 2 AND tail BETWEEN 0 AND 1 AND selected = (tail >= 0.5)").count() == len(odd_rows)
    none = learn_quality(docs, ratings.where("false"), 3)
    assert score_quality(docs, none, 1).where("abs(expected_grade - 1) < 1e-9").count() == len(odd_rows)
    assert score_quality(docs.where("false"), model, 2).count() == 0
    with pytest.raises(ValueError):
        learn_quality(docs, ratings.withColumn("grade", F.lit(3)), 3)


def test_held_out_selection(spark):
    got = QUERIES["op3_quality_classifier"](spark, "/root/testdata/sf0.1").where("held_out").join(
        spark.read.parquet("/root/testdata/sf0.1/labels.parquet"), "doc_id").groupBy("quality", "selected").count().collect()
    n = {(r["quality"], r["selected"]): r["count"] for r in got}
    assert n[1, True] >= 0.98 * (n[1, True] + n.get((1, False), 0)) and n[0, False] >= 0.9 * (n[0, False] + n.get((0, True), 0))
    assert fold_of(F.lit(1), 4) is not None
