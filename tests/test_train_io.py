import json
import os

import __spark_entry__ as E
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sievekit.operators import evaluate as ev
from sievekit.operators import runs as rn
from sievekit.operators import train as tr
from sievekit.session import scratch_path
from sievekit.sources import tables as io


def _separable(spark, n=200):
    rows = [(i, float(i % 2), [i % 2 * 8 + (i % 5)], float(i % 7)) for i in range(n)]
    df = spark.createDataFrame(rows, "id int, y double, bits array<int>, d double")
    return tr.assemble_features(df, ["d"], "bits", 16, "y")


def test_assemble_and_forest_on_separable_data(spark):
    x = _separable(spark)
    assert x.first()["features"].size == 17
    model = tr.train_forest(x, num_trees=10, max_depth=5)
    scored = tr.score_rows(model, x)
    probs = [r["score"] for r in scored.collect()]
    assert all(0.0 <= p <= 1.0 for p in probs)
    auc = ev.roc_auc(scored, "label", "score").first()["auc"]
    assert auc > 0.99


def test_boosted_with_weights(spark):
    x = _separable(spark).withColumn("w", F.when(F.col("label") == 1.0, 2.0).otherwise(1.0))
    model = tr.train_boosted(x, weight_col="w", max_iter=5, max_depth=3)
    assert tr.score_rows(model, x).filter("prediction = label").count() > 190


def test_class_weights_balanced_and_empty_class(spark):
    df = spark.createDataFrame([(0,), (0,), (0,), (1,)], "y int")
    w = {r["label"]: r["weight"] for r in tr.class_weights(df, "y").collect()}
    assert abs(w[0] - 4 / 6) < 1e-12 and w[1] == 2.0
    with pytest.raises(ValueError):
        tr.class_weights(df.filter("y = 0"), "y")
    with pytest.raises(ValueError):
        tr.positive_weight(df.filter("y = 0"), "y")


def test_param_search_and_importances(spark):
    from pyspark.ml.classification import RandomForestClassifier
    x = _separable(spark, 120)
    model, trials = tr.param_search(x, x, lambda p: RandomForestClassifier(seed=1, **p),
                                    {"numTrees": [3, 5], "maxDepth": [2, 4]}, n_trials=3, parallelism=2)
    t = trials.collect()
    assert len(t) == 3 and all(r["val_roc_auc"] is not None for r in t)
    imp = tr.top_importances(model, tr.feature_names(["d"], 16), 5).collect()
    assert len(imp) <= 5 and imp == sorted(imp, key=lambda r: -r["importance"])


def test_fits_share_the_cores(spark, monkeypatch):
    """Partitions of a fit's rows follow the cores it has, not the files of its input."""
    from pyspark.ml.classification import RandomForestClassifier
    x, cores, seen = _separable(spark, 120).repartition(40), spark.sparkContext.defaultParallelism, []
    fit = RandomForestClassifier._fit
    monkeypatch.setattr(RandomForestClassifier, "_fit", lambda self, df: (seen.append(df.rdd.getNumPartitions()), fit(self, df))[1])
    assert tr.train_forest(x, num_trees=2, max_depth=2, written=True).getNumTrees == 2
    tr.param_search(x, x, lambda p: RandomForestClassifier(seed=1, **p), {"numTrees": [1, 2]}, n_trials=2, parallelism=2, refit=x)
    assert seen[0] <= cores and max(seen[1:3]) <= max(1, cores // 2) and seen[3] <= cores and len(seen) == 4
    monkeypatch.setattr(tr, "_heap_mb", lambda spark: 1)  # 120 rows of 17 features: more than a sixteenth of 1 / 1024 MB
    assert tr.fit_partitions(x, "features", 10_000) == 1 and tr.fit_partitions(x.crossJoin(spark.range(100)), "features", 10_000) == 13


def test_save_and_load_model(spark):
    x = _separable(spark, 60)
    model = tr.train_forest(x, num_trees=3, max_depth=3)
    path = scratch_path(spark, "m")
    tr.save_model(model, path, x.schema)
    again = tr.score_rows(tr.load_model(path), x).select("id", "score").orderBy("id").collect()
    first = tr.score_rows(model, x).select("id", "score").orderBy("id").collect()
    assert again == first


def test_run_log_and_compare(spark):
    log = rn.RunLog(spark, scratch_path(spark, "runs"))
    parent = log.start_run("search")
    child = log.start_run("trial_1", parent)
    log.log_params(child, {"numTrees": 10, "strategy": "sqrt"})
    log.log_metrics(child, {"val_auc": 0.8})
    rows = log.read().filter(F.col("run_id") == child).collect()
    assert {r["key"] for r in rows} >= {"numTrees", "strategy", "val_auc"}
    assert all(r["parent_id"] == parent for r in rows)
    m = spark.createDataFrame([(0.9, 0.5)], "accuracy double, f1 double")
    long = rn.metrics_long(m, "a", "val").unionByName(rn.metrics_long(m, "b", "test"))
    cmp = rn.compare_models(long, ["accuracy", "f1"], split="val").collect()
    assert len(cmp) == 1 and cmp[0]["run_name"] == "a"


def test_csv_conform_write_verify(spark):
    path = scratch_path(spark, "csv")
    os.makedirs(path)
    with open(os.path.join(path, "x.csv"), "w") as f:
        f.write("a,b\n1,x\nnot_a_number,y\n3,z,extra\n")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.StringType())])
    df = io.read_csv(spark, path, schema)
    rows = df.collect()
    assert len(rows) == 3 and sum(1 for r in rows if r["_corrupt_record"] is not None) >= 1
    conformed = io.conform(df, T.StructType([T.StructField("b", T.StringType()),
                                             T.StructField("c", T.DoubleType())]))
    assert conformed.columns == ["b", "c"]
    out = scratch_path(spark, "out")
    io.write_table(conformed, out)
    v = io.verify_persisted(spark, out, conformed).first()
    assert v["matches"] and v["rows_read"] == 3


def test_namespace_and_schema_report(spark):
    assert io.use_namespace(spark, "sievekit_test") == "sievekit_test"
    spark.catalog.setCurrentDatabase("default")
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    rep = {r["column_name"]: r for r in io.schema_report(df).collect()}
    assert rep["a"]["dtype"] == "int" and rep["b"]["non_null"] == 1


def test_weights_with_other_and_null_labels(spark):
    df = spark.createDataFrame([(None,), (2,), (3,), (4,), (0,), (0,), (1,)], "y int")
    w = {r["label"]: r["weight"] for r in tr.class_weights(df, "y").collect()}
    assert w == {0: 3 / 4, 1: 3 / 2}
    got = tr.with_class_weights(df, "y").collect()
    assert [r["weight"] for r in got] == [None, None, None, None, 0.75, 0.75, 1.5]


def test_depth_beyond_the_limit_raises(spark):
    with pytest.raises(ValueError):
        tr.train_forest(_separable(spark, 20), num_trees=1, max_depth=31)


def test_rows_without_label_are_left_out_of_fits(spark):
    x = _separable(spark, 60)
    x = x.unionByName(x.limit(5).withColumn("label", F.lit(None).cast("double")))
    assert tr.train_forest(x, num_trees=2, max_depth=3).numFeatures == 17


def test_refit_and_kept_model(spark):
    from pyspark.ml.classification import RandomForestClassifier
    x = _separable(spark, 80)
    model, trials = tr.param_search(x, x, lambda p: RandomForestClassifier(seed=1, **p), {"numTrees": [2, 7]}, n_trials=2,
                                    parallelism=2, refit=x)
    best = max(trials.collect(), key=lambda r: (r["val_roc_auc"], -r["trial"]))
    assert f'"numTrees": {model.getNumTrees}' in best["params"]


def test_loading_checks_the_saved_signature(spark):
    x = _separable(spark, 40)
    path = scratch_path(spark, "m")
    tr.save_model(tr.train_forest(x, num_trees=2, max_depth=2), path, x.schema)
    tr.load_model(path, x)
    with pytest.raises(ValueError):
        tr.load_model(path, x.drop("features"))


def test_a_run_goes_on_from_another_handle(spark):
    path = scratch_path(spark, "runs")
    rid = rn.RunLog(spark, path).start_run("a")
    rn.RunLog(spark, path).log_metrics(rid, {"m": 1.0})
    assert rn.RunLog(spark, path).read().where("kind = 'metric' AND run_name = 'a'").count() == 1
    with pytest.raises(ValueError):
        rn.RunLog(spark, path).log_metrics("missing", {"m": 1.0})


def test_scratch_needs_a_shared_folder_on_a_cluster():
    from sievekit import session

    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master, applicationId = "spark://host:7077", "app"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(Session())
    Session.sparkContext.master = "local[2]"
    assert session.ensure_checkpoint_dir(Session()) == session.ensure_checkpoint_dir(Session())


def test_scratch_is_deleted_when_asked(spark):
    from sievekit.session import clear_scratch, cut_lineage
    df = cut_lineage(spark.range(10).toDF("x"))
    path = df.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:").replace("//", "/")
    assert df.count() == 10 and os.path.isdir(path)
    assert clear_scratch(spark) >= 1
    assert not os.path.exists(path)


@pytest.fixture(scope="module")
def separable_tables(spark, tmp_path_factory):
    """Toxic documents shout; a third of the rows is toxic; every tenth has no label."""
    sf = str(tmp_path_factory.mktemp("separable"))
    texts = [(k, f"BAD WORDS!!! {k} " * 6 if k % 3 == 0 else f"some quiet words number {k} of a long and calm text") for k in range(240)]
    spark.createDataFrame(texts, "doc_id bigint, text string").write.parquet(f"{sf}/documents.parquet")
    labels = [(k, int(k % 3 == 0)) for k in range(240) if k % 10]
    spark.createDataFrame(labels, "doc_id bigint, toxic int").write.parquet(f"{sf}/labels.parquet")
    return sf


def _held_out_auc(rows):
    """Share of (toxic, other) pairs of held-out rows in the right order, ties as half."""
    held = [r for r in rows if r["split"] != "train"]
    pos, neg = ([r["score"] for r in held if r["doc_id"] % 3 == 0], [r["score"] for r in held if r["doc_id"] % 3])
    assert pos and neg
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


@pytest.mark.parametrize("name", ["train_forest", "train_boosted", "score_rows"])
def test_queries_return_scores(spark, separable_tables, monkeypatch, name):
    boosted = tr.train_boosted
    monkeypatch.setattr(E.tr, "train_boosted", lambda x, **o: boosted(x, **{**o, "max_iter": 5}))
    out = E.queries()[name](spark, separable_tables)
    assert out.columns == ["doc_id", "split", "label", "prediction", "score"] and name not in E.oracle_sql()
    rows = out.collect()
    assert len(rows) == len({r["doc_id"] for r in rows}) == (240 if name == "score_rows" else 216)
    assert _held_out_auc(rows) > 0.95
    assert all(0 <= r["score"] <= 1 and r["prediction"] == (r["score"] > 0.5) for r in rows)


def test_saved_model_query_returns_scores(spark, separable_tables):
    rows = E.queries()["save_model"](spark, separable_tables).collect()
    assert len(rows) == 216 and all(r["same_score"] for r in rows)
    assert all(r["prediction"] == r["label"] == (r["doc_id"] % 3 == 0) for r in rows)
    assert len({r["score"] for r in rows}) > 1


def test_search_query_returns_settings_and_best(spark, separable_tables, monkeypatch):
    monkeypatch.setattr(E, "SEARCH_SPACE", {"numTrees": [1, 4], "maxDepth": [1, 3]})
    out = E.queries()["param_search"](spark, separable_tables)
    assert out.columns == ["trial", "params", "val_roc_auc", "best", "test_roc_auc"] and "param_search" not in E.oracle_sql()
    rows = sorted(out.collect(), key=lambda r: r["trial"])
    assert [r["trial"] for r in rows] == [0, 1, 2, 3] and all(0 <= r["val_roc_auc"] <= 1 for r in rows)
    assert {tuple(json.loads(r["params"]).items()) for r in rows} == {(("maxDepth", d), ("numTrees", n)) for d in (1, 3) for n in (1, 4)}
    best = max(rows, key=lambda r: (r["val_roc_auc"], -r["trial"]))
    assert [r["trial"] for r in rows if r["best"]] == [best["trial"]] and best["test_roc_auc"] > 0.95
    assert all(r["test_roc_auc"] is None for r in rows if not r["best"])


def test_importances_query_returns_features(spark, separable_tables):
    out = E.queries()["top_importances"](spark, separable_tables)
    assert out.columns == ["rank", "feature", "importance"] and "top_importances" not in E.oracle_sql()
    rows = sorted(out.collect(), key=lambda r: r["rank"])
    assert [r["rank"] for r in rows] == list(range(1, 21)) and len({r["feature"] for r in rows}) == 20
    values = [r["importance"] for r in rows]
    assert values == sorted(values, reverse=True) and 0 < sum(values) <= 1 + 1e-9
    assert {r["feature"] for r in rows} & {"calc_upper_share", "calc_punct_share", "calc_distinct_token_share"}


def test_one_tree_of_depth_one_splits_best(spark):
    """Without bootstrap and with all features, the tree's split is the one of least Gini impurity."""
    import random

    from pyspark.ml.classification import RandomForestClassifier
    from pyspark.ml.functions import array_to_vector

    rng = random.Random(5)
    rows = [([float(rng.randint(0, 9)), float(rng.randint(0, 9)), float(rng.randint(0, 9))],) for _ in range(150)]
    rows = [(x, float(x[1] + rng.randint(0, 3) > 6)) for (x,) in rows]
    df = spark.createDataFrame(rows, "x array<double>, label double").select(array_to_vector("x").alias("features"), "label")
    model = RandomForestClassifier(numTrees=1, maxDepth=1, featureSubsetStrategy="all", bootstrap=False, seed=1).fit(df)
    gini = lambda ys: len(ys) * (1 - (sum(ys) / len(ys)) ** 2 - (1 - sum(ys) / len(ys)) ** 2) if ys else 0.0
    cost = {(f, t): gini([y for x, y in rows if x[f] <= t]) + gini([y for x, y in rows if x[f] > t]) for f in range(3) for t in range(9)}
    feature, cut = min(cost, key=cost.get)
    scored = tr.score_rows(model, df.withColumn("x", F.col("features"))).collect()
    for side in (True, False):
        part = [r for r in scored if (r["x"][feature] <= cut) == side]
        share = sum(r["label"] for r in part) / len(part)
        assert all(abs(r["score"] - share) < 1e-12 for r in part)


def test_digest_finds_a_changed_cell(spark):
    df = spark.createDataFrame([(1, "a", None), (2, None, [1]), (2, None, [1]), (3, "", [])], "k int, s string, v array<int>")
    base = io.content_digest(df).first()
    assert io.content_digest(df.repartition(4).select("v", "k", "s")).first() == base
    for other in (df.withColumn("s", F.when(F.col("k") == 3, F.lit("x")).otherwise(F.col("s"))), df.distinct(), df.unionByName(df.where("k = 2")).unionByName(df.where("k = 2")),
                  df.withColumn("s", F.coalesce("s", F.lit(""))), df.withColumnRenamed("s", "z"), df.where("false")):
        assert io.content_digest(other).first() != base
    path = scratch_path(spark, "verified")
    io.write_table(df.withColumn("s", F.when(F.col("k") == 3, F.lit("x")).otherwise(F.col("s"))), path)
    v = io.verify_persisted(spark, path, df).first()
    assert v["rows_written"] == v["rows_read"] == 4 and not v["matches"]


def test_verified_writes_run_the_source_once(spark):
    runs = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b

    df = spark.range(100).mapInArrow(count, "id bigint").repartition(2)
    assert io.write_verified(df, scratch_path(spark, "once")).first()["matches"] and runs.value == 100
    assert io.write_verified(spark.range(0), scratch_path(spark, "none")).first() == (0, 0, True)


def test_batches_can_be_loaded_again(spark):
    path = scratch_path(spark, "batches")
    load = lambda day, n: io.write_batches(spark.range(n).withColumn("batch_id", F.lit(day)), path)
    counts = lambda: {r["batch_id"]: r["count"] for r in spark.read.parquet(path).groupBy("batch_id").count().collect()}
    load("d1", 10)
    load("d2", 20)
    load("d1", 10)
    assert counts() == {"d1": 10, "d2": 20}
    load("d1", 4)
    assert counts() == {"d1": 4, "d2": 20}
    assert io.drop_batch(spark, path, "d2") and not io.drop_batch(spark, path, "d3")
    assert counts() == {"d1": 4}


def test_rejects_hold_every_lost_value(spark):
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("a", T.IntegerType()), T.StructField("b", T.DateType()), T.StructField("c", T.StringType())])
    df = spark.createDataFrame([(1, "5", "2024-01-02", "x"), (2, "five", "never", None), (3, None, "2024-02-30", "y"), (3, "5.5.5", None, "z")], "k int, a string, b string, d string")
    got = sorted(map(tuple, io.rejects(df, schema, ["k"]).collect()))
    assert got == [(2, "a", "int", "five"), (2, "b", "date", "never"), (3, "a", "int", "5.5.5"), (3, "b", "date", "2024-02-30")]
    drift = {r["column_name"]: (r["change"], r["n_lost"]) for r in io.schema_drift(df, schema).collect()}
    assert drift == {"k": ("retyped", 0), "a": ("retyped", 2), "b": ("retyped", 2), "c": ("missing", 0), "d": ("extra", 0)}
    lost = sum(r[c] is not None for r in df.collect() for c in "ab") - sum(r[c] is not None for r in io.conform(df, schema).collect() for c in "ab")
    assert lost == len(got)
    assert io.rejects(df, df.schema, ["k"]).count() == 0 and {r["change"] for r in io.schema_drift(df, df.schema).collect()} == {"same"}
    assert io.rejects(df.where("false"), schema, ["k"]).count() == 0


def test_a_stopped_search_goes_on(spark):
    from pyspark.ml.classification import RandomForestClassifier
    x = _separable(spark, 60)
    path = scratch_path(spark, "ledger")
    space, fits = {"numTrees": [1, 2, 3, 4, 5], "maxDepth": [1, 2]}, []

    def search(stop):
        log = rn.RunLog(spark, path)
        run = log.find("search") or log.start_run("search")

        def build(p):
            if len(fits) == stop:
                raise KeyboardInterrupt
            fits.append(p)
            return RandomForestClassifier(seed=1, **p)
        return tr.param_search(x, x, build, space, n_trials=10, parallelism=1, ledger=log, run_id=run)

    with pytest.raises(KeyboardInterrupt):
        search(7)
    assert len(fits) == 7
    model, trials = search(None)
    again = [json.loads(r["params"]) for r in sorted(trials.collect(), key=lambda r: r["trial"])]
    assert fits[:7] == again[:7] and fits[7:10] == again[7:] and len(fits) <= 11  # and the best, if its model was lost
    whole, _ = tr.param_search(x, x, lambda p: RandomForestClassifier(seed=1, **p), space, n_trials=10)
    assert model.getNumTrees == whole.getNumTrees
    rn.RunLog(spark, path).start_run("another")
    log = rn.RunLog(spark, path)
    run = log.find("search")
    assert {p.split("run_id=")[1].split("/")[0] for p in log.of_run(run).inputFiles()} == {run}
    assert len(log.trials(run)) == 10 and log.trials("unknown") == {} and log.find("unknown") is None
