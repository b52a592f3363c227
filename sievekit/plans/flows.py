"""End-to-end flows: the three stages of a screening run (ingest, featurise,
train) composed from the operators.  Each stage reads tables, writes its
layer once (partitioned by split) and returns bounded reports; later
stages read the written layer rather than recomputing it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import evaluate as ev
from ..operators import fingerprints as fpo
from ..operators import frames as fr
from ..operators import profile as pr
from ..operators import quality as qu
from ..operators import rules as ru
from ..operators import runs as rn
from ..operators import train as tr
from ..sources import tables as io


def ingest(source: DataFrame, key_col: str, target: str, text_col: str | None = None,
           range_checks: Sequence[tuple[str, str, object, object]] = (),
           rules: Sequence[tuple[str, Column]] | None = None,
           fractions: Sequence[float] = (0.7, 0.15, 0.15), seed: int = 42) -> dict[str, DataFrame]:
    """Quality checks, profile, rule flags and a hash split, then one write
    of the bronze layer partitioned by ``split``."""
    flagged = ru.rule_flags(source, rules) if rules is not None else source
    bronze = fr.hash_split(flagged, key_col, fractions, seed=seed)
    io.write_table(bronze, target, partition_by=["split"])
    written = io.read_table(source.sparkSession, target)
    read_back = written.select(*source.columns)  # the source itself is read once
    report = qu.quality_report(read_back, [text_col or key_col], text_col, 3, range_checks)
    profile = pr.describe_full(read_back)
    counts = written.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"))
    out = {"quality": report, "profile": profile, "split_counts": counts}
    if rules is not None:
        out["rule_summary"] = ru.rule_summary(written)
    return out


def featurize(spark: SparkSession, bronze: str, text_col: str, target: str,
              radius: int = 2, n_bits: int = 2048) -> dict[str, DataFrame]:
    """Descriptors, fingerprint and rule flags for all splits in one pass,
    one write of the silver layer, and the feature checks on it."""
    silver = fpo.feature_batch(io.read_table(spark, bronze), text_col, radius, n_bits)
    io.write_table(silver, target, partition_by=["split"])
    written = io.read_table(spark, target)
    calc = [c for c in written.columns if c.startswith("calc_")]
    return {
        "silver": written,
        "null_counts": qu.null_counts(written, calc),
        "stats": pr.describe_basic(written, calc),
        "rule_summary": ru.rule_summary(written, "n_violations", "passes"),
        "density": fpo.fingerprint_density(written, "bits", n_bits),
        "bit_usage": fpo.bit_usage(written, "bits", n_bits),
    }


def train(spark: SparkSession, silver: str, label_col: str, n_bits: int, run_log_path: str,
          search_space: Mapping[str, Sequence] | None = None, n_trials: int = 20,
          seed: int = 42, bits_col: str = "bits", parallelism: int = 2) -> dict[str, object]:
    """Assemble, weight, train a forest (optionally after a random search, whose
    trials are logged as they end and whose best setting is fitted again on
    train and validation rows), score every split and log metrics per split into
    the run table."""
    from pyspark.ml.classification import RandomForestClassifier

    data = io.read_table(spark, silver)
    calc = [c for c in data.columns if c.startswith("calc_")]
    x = tr.assemble_features(data, calc, bits_col, n_bits, label_col)
    x = tr.with_class_weights(x, "label", classes=(0.0, 1.0))
    train_df, val_df = x.filter(F.col("split") == "train"), x.filter(F.col("split") == "val")
    log = rn.RunLog(spark, run_log_path)
    run = log.start_run("random_forest")
    if search_space:
        model, trials = tr.param_search(
            train_df, val_df,
            lambda p: RandomForestClassifier(seed=seed, weightCol="weight", **p),
            search_space, n_trials=n_trials, seed=seed, parallelism=parallelism,
            refit=train_df.unionByName(val_df), ledger=log, run_id=run)
        log.log_table(run, "trials", trials, "params", "val_roc_auc")
    else:
        model = tr.train_forest(train_df, weight_col="weight", seed=seed)
    scored = tr.score_rows(model, x)
    for split in ("train", "val", "test"):
        part = scored.filter(F.col("split") == split)
        log.log_metrics_frame(run, ev.binary_metrics(part, "label", "prediction", "score", prefix=f"{split}_"))
    names = tr.feature_names(calc, n_bits)
    log.log_table(run, "importances", tr.top_importances(model, names, 20), "feature", "importance")
    return {"model": model, "scored": scored, "runs": log.read()}
