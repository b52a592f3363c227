import random

import __spark_entry__ as E
import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from sievekit.operators import forest as fo
from sievekit.operators import train as tr


def _rows(spark, n=400, seed=3, partitions=3):
    """Two many-valued features, six of 0 and 1, one constant; noisy labels of three classes."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        bits = [float(rng.random() < 0.4) for _ in range(6)]
        a, b = rng.gauss(0, 1), float(rng.randint(0, 20))
        y = (a + bits[0] + bits[2] * (b > 9) > 0.7) + (bits[4] * bits[5] > 0 and b < 6)
        rows.append((k, [a, *bits[:3], b, 0.0, *bits[3:]], float(y if rng.random() < 0.8 else rng.randint(0, 2)), 1.0 + k % 3))
    df = spark.createDataFrame(rows, "id int, x array<double>, label double, weight double").repartition(partitions)
    return df.select("id", array_to_vector("x").alias("features"), "label", "weight")


def _trees(spark, model, path, least=0):
    model.write().save(path)
    nodes = {}
    for r in spark.read.parquet(f"{path}/data").collect():
        nodes.setdefault(r["treeID"], {})[r["nodeData"]["id"]] = r["nodeData"]

    def shape(of, at=0):
        n = of[at]
        own = (n["split"]["featureIndex"], [round(v, 9) for v in n["split"]["leftCategoriesOrThreshold"]], n["prediction"], n["rawCount"],
               [round(v, 6) for v in n["impurityStats"]], round(n["gain"], 9))
        if n["rawCount"] < least:  # its best splits may be equally good
            return own[2:5]
        return own if n["leftChild"] < 0 else (own, shape(of, n["leftChild"]), shape(of, n["rightChild"]))
    return [shape(nodes[t]) for t in sorted(nodes)]


@pytest.mark.parametrize("weight, least", [("weight", 1), (None, 4)])
def test_without_draws_the_trees_are_sparks(spark, tmp_path, weight, least):
    x = _rows(spark)
    o = dict(numTrees=1, maxDepth=9, featureSubsetStrategy="all", bootstrap=False, seed=1, minInstancesPerNode=least, **({"weightCol": weight} if weight else {}))
    mine, theirs = fo.WholeTreeForest(**o).fit(x), RandomForestClassifier(**o).fit(x)
    assert _trees(spark, mine, f"{tmp_path}/a", 16) == _trees(spark, theirs, f"{tmp_path}/b", 16)
    assert np.allclose(mine.featureImportances.toArray(), theirs.featureImportances.toArray(), atol=0.02)
    assert mine.transform(x).select("probability").collect() and mine.numClasses == 3 and mine.getMaxDepth() == 9


def test_scores_and_importances_without_the_jvm_model(spark, tmp_path):
    """Scored from the grown trees, rows get exactly what Spark's model of these trees gives."""
    x = _rows(spark)
    model = tr.train_forest(x, num_trees=70, max_depth=7, weight_col="weight")
    before, importances = tr.score_rows(model, x).sort("id").collect(), model.featureImportances.toArray()
    probs = model.transform(x).sort("id").select("rawPrediction", "probability", "prediction").collect()
    assert model._made is None and model.getNumTrees == 70 and model.numFeatures == 9
    model.write().save(f"{tmp_path}/m")
    theirs = RandomForestClassificationModel.load(f"{tmp_path}/m")
    assert before == tr.score_rows(theirs, x).sort("id").collect() and theirs.totalNumNodes == model.totalNumNodes
    assert probs == theirs.transform(x).sort("id").select("rawPrediction", "probability", "prediction").collect()
    assert np.allclose(importances, theirs.featureImportances.toArray(), atol=1e-12) and theirs.getMaxDepth() == 7
    assert theirs.getNumTrees == 70 and len(model.trees) == 70


def test_draws_do_not_follow_partitions(spark, tmp_path):
    o = dict(num_trees=7, max_depth=8, weight_col="weight", seed=5)
    one = _trees(spark, tr.train_forest(_rows(spark, partitions=1), **o), f"{tmp_path}/a")
    assert len(one) == 7 and len({str(t) for t in one}) == 7
    assert one == _trees(spark, tr.train_forest(_rows(spark, partitions=9), **o), f"{tmp_path}/b")
    assert one != _trees(spark, tr.train_forest(_rows(spark, partitions=1), **(o | {"seed": 6})), f"{tmp_path}/c")


def test_search_query_grows_whole_trees(spark, tmp_path, monkeypatch):
    """No statistics of nodes are exchanged: Spark's learner, which does that, is not asked."""
    sf = str(tmp_path)
    texts = [(k, f"BAD {k % 7} WORDS " * 4 if k % 3 == 0 else f"some quiet words number {k} of a calm text") for k in range(160)]
    spark.createDataFrame(texts, "doc_id bigint, text string").write.parquet(f"{sf}/documents.parquet")
    spark.createDataFrame([(k, int(k % 3 == 0)) for k in range(160)], "doc_id bigint, toxic int").write.parquet(f"{sf}/labels.parquet")

    def refuse(self, df):
        raise AssertionError("level by level")
    monkeypatch.setattr(RandomForestClassifier, "_fit", refuse, raising=False)
    monkeypatch.setattr(E, "SEARCH_SPACE", {"numTrees": [2, 5], "maxDepth": [10], "featureSubsetStrategy": ["sqrt", "all"]})
    rows = E.queries()["param_search"](spark, sf).collect()
    assert len(rows) == 4 and all(0 <= r["val_roc_auc"] <= 1 for r in rows) and sum(r["best"] for r in rows) == 1


def test_general_weights_blocks_and_subsets(spark, tmp_path, monkeypatch):
    x, o = _rows(spark), dict(num_trees=3, max_depth=8, weight_col="weight", feature_subset="5", seed=2)
    whole = _trees(spark, tr.train_forest(x, **o), f"{tmp_path}/a")
    from sievekit.operators.forest import _subsets
    got = _subsets(np.random.default_rng(0), 500, 3, 20)
    assert all(len(set(r)) == 3 and list(r) == sorted(r) for r in got.tolist()) and set(np.bincount(got.ravel(), minlength=20) > 40) == {True}
    assert len(_subsets(np.random.default_rng(0), 3, 5, 6)) == 3 and len(whole) == 3


def test_what_is_left_to_sparks_learner(spark, monkeypatch):
    x, asked = _rows(spark, 60), []
    fit = RandomForestClassifier._fit
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda self, df: (asked.append(self.getMaxDepth()), fit(self, df))[1], raising=False)
    tr.train_forest(x, num_trees=2, max_depth=4)
    fo.WholeTreeForest(numTrees=2, maxDepth=7, impurity="entropy").fit(x)
    assert asked == [4, 7]
    tr.train_forest(x, num_trees=2, max_depth=6)
    assert asked == [4, 7]
    with monkeypatch.context() as m:
        m.setattr(tr, "_heap_mb", lambda spark: 0)  # packed rows do not fit
        fo.WholeTreeForest(numTrees=2, maxDepth=8).fit(x)
    assert asked == [4, 7, 8]
    with pytest.raises(Exception, match="(?i)null"):
        fo.WholeTreeForest(numTrees=2, maxDepth=9).fit(x.withColumn("label", F.when(F.col("id") > 3, F.col("label"))))
    assert asked[-1] == 9


def test_splits_follow_shares_of_the_rows():
    assert fo.split_points(np.array([1.0, 2.0, 4.0]), np.array([1, 1, 1]), 32).tolist() == [1.5, 3.0]
    assert fo.split_points(np.arange(100.0), np.ones(100), 4).tolist() == [24.5, 49.5, 74.5]
    assert [fo.subset_size(s, 2055, 50) for s in ("sqrt", "log2", "all", "auto", "7", "0.5", "onethird")] == [46, 12, 2055, 46, 7, 1028, 685]


def test_features_go_to_workers_in_bounded_batches(spark):
    """Ten thousand whole texts and their tokens at once take most of an executor."""
    from sievekit.operators import fingerprints as fpo
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.unset(name)
        fpo.feature_batch(spark.createDataFrame([(1, "a b c")], "id int, text string"), "text")
        assert int(spark.conf.get(name).removesuffix("b")) == 8 << 20
    finally:
        spark.conf.set(name, before)
