import os
import shutil

from pyspark.sql import functions as F

from sievekit.plans import flows
from sievekit.session import scratch_path
from sievekit.streaming.incremental import incremental_features

SF = "/root/testdata/sf0.001"


def test_three_flows_end_to_end(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    source = docs.join(labels, "doc_id")
    bronze, silver = scratch_path(spark, "bronze"), scratch_path(spark, "silver")
    out = flows.ingest(source, "doc_id", bronze, "text", [("n_chars_positive", "n_chars", 1, None)])
    assert sum(r["n_rows"] for r in out["split_counts"].collect()) == source.count()
    feats = flows.featurize(spark, bronze, "text", silver, radius=1, n_bits=256)
    assert feats["silver"].count() == source.count()
    assert feats["density"].first()["n_rows"] == source.count()
    res = flows.train(spark, silver, "toxic", 256, scratch_path(spark, "runs"))
    keys = {r["key"] for r in res["runs"].filter(F.col("kind") == "metric").collect()}
    assert {"train_roc_auc", "val_f1", "test_accuracy"} <= keys


def test_incremental_features_exactly_once(spark):
    src = scratch_path(spark, "src")
    os.makedirs(src)
    shutil.copy(f"{SF}/documents.parquet", os.path.join(src, "part-0.parquet"))
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    out, ckpt = scratch_path(spark, "silver"), scratch_path(spark, "ckpt")
    first = incremental_features(spark, src, schema, "text", out, ckpt, radius=1, n_bits=128)
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert first.count() == n
    again = incremental_features(spark, src, schema, "text", out, ckpt, radius=1, n_bits=128)
    assert again.count() == n                 # nothing reprocessed
    shutil.copy(f"{SF}/documents.parquet", os.path.join(src, "part-1.parquet"))
    third = incremental_features(spark, src, schema, "text", out, ckpt, radius=1, n_bits=128)
    assert third.count() == 2 * n             # only the new file appended
