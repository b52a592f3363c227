"""Plan-shape guards: no registered query may plan a cartesian product or a
broadcast nested-loop join (pair explosions), and scans must be pruned."""

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"
MODEL_QUERIES = {"assemble_features", "train_forest", "train_boosted", "score_rows", "param_search",
                 "top_importances", "run_log", "save_model"}


ROW_WISE = ["string_descriptors", "hashed_fingerprint", "pattern_keys", "feature_batch", "columns_with_prefix", "rule_flags",
            "weighted_rule_score", "linear_score", "banded_class", "desirability_score", "dense_fingerprint", "batch_featurize"]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_pair_explosions_in_plans(spark):
    bad = {}
    for name, q in E.queries().items():
        if name in MODEL_QUERIES:
            continue
        plan = _plan(q(spark, SF))
        hits = [op for op in ("CartesianProduct", "BroadcastNestedLoopJoin") if op in plan]
        if hits:
            bad[name] = hits
    assert not bad, bad


def test_scan_pruning_and_pushdown(spark):
    plan = _plan(E.queries()["describe_full"](spark, SF))
    assert "ReadSchema: struct<l_quantity:double,l_extendedprice:double,l_discount:double,l_tax:double>" in plan
    plan = _plan(E.queries()["range_filter"](spark, SF))
    assert "PushedFilters: [IsNotNull(l_extendedprice), GreaterThanOrEqual(l_extendedprice,10000.0)" in plan


def test_building_row_wise_queries_starts_no_job(spark):
    """Beyond reading the footer of the Parquet file."""
    tracker, context = spark.sparkContext.statusTracker(), spark.sparkContext
    for name in ROW_WISE:
        context.setJobGroup(f"build-{name}", name)
        E.queries()[name](spark, SF)
        context.setLocalProperty("spark.jobGroup.id", None)
        assert len(tracker.getJobIdsForGroup(f"build-{name}")) <= 1, name


def test_reports_scan_once(spark):
    from sievekit.operators import profile as pr
    from sievekit.operators import rules as ru
    li = spark.read.parquet(f"{SF}/lineitem.parquet")
    assert _plan(ru.rule_summary(ru.rule_flags(li, [("q", ru.above("l_quantity", 45))]))).count("FileScan") == 1
    counts = pr.value_counts(li, "l_returnflag")
    assert "lineitem" not in _plan(counts)  # what is left reads the few counts


def test_text_queries_read_only_key_and_text(spark):
    for name in ("string_descriptors", "hashed_fingerprint", "feature_batch"):
        assert "ReadSchema: struct<doc_id:bigint,text:string>" in _plan(E.queries()[name](spark, SF)), name


def _lines(df, start):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return [x.strip(" :+-") for x in plan.splitlines() if x.strip(" :+-").startswith(start)]


def test_evaluation_filters_nothing_over_text(spark, monkeypatch):
    """A filter on label, prediction or score would reach the scan and compute the descriptors there once more."""
    from sievekit.operators import evaluate as ev
    seen, cut = [], ev.cut_lineage
    monkeypatch.setattr(ev, "cut_lineage", lambda df, *a: (seen.append(df), cut(df, *a))[1])
    for name in ("classification_report", "confusion_matrix", "roc_auc", "roc_curve", "score_histogram", "binary_metrics"):
        seen.append(E.queries()[name](spark, SF))
    filters = [x for df in seen for x in _lines(df, "Filter") if "text#" in x]
    assert len(seen) > 6 and not filters, filters


def test_duplicate_counts_move_no_text(spark):
    for name in ("duplicate_count", "quality_report"):
        plan = _plan(E.queries()[name](spark, SF))
        moved = [x for x in plan.splitlines() if "Exchange" in x and "text" in x]
        keys = [x for x in plan.splitlines() if "partial_count" in x and "keys=[text" in x]
        assert "Exchange" in plan and not moved and not keys, name


def test_rarity_has_one_exchange_of_bits(spark, monkeypatch):
    from sievekit.operators import fingerprints as fpo
    monkeypatch.setattr(fpo, "cut_lineage", lambda df, *a: df)
    df = spark.createDataFrame([(1, [0, 2]), (2, [2]), (3, None)], "id int, bits array<int>")
    plan = _plan(fpo.rarity_score(df, "id", "bits", 4))
    assert "hashpartitioning(bit" in plan and "hashpartitioning(id" not in plan and "Join" not in plan


def test_similarity_join_never_explodes_whole_sets(spark, monkeypatch):
    from sievekit.operators import similarity as si
    written = []
    cut = si.cut_lineage
    monkeypatch.setattr(si, "cut_lineage", lambda df, *a: (written.append((a, df)), cut(df, *a))[1])
    df = spark.createDataFrame([(k, list(range(k, k + 40))) for k in range(60)], "id bigint, bits array<bigint>")
    si.similarity_join(df, "id", "bits", 0.9).collect()
    named = {a[0]: df for a, df in written if a}
    assert "Generate" not in _plan(named["prefixes"]) and "bits" not in "".join(x for x in _plan(named["prefixes"]).splitlines() if "Exchange" in x)
    assert named["prefix-rows"].count() <= 60 * 5  # places 1 to 5 of 40 at 0.9


def test_pattern_plans_do_not_grow(spark):
    from sievekit.operators import fingerprints as fpo
    df = spark.createDataFrame([(1, "a b c"), (2, "b c d")], "id int, t string")
    few, many = (len(_plan(fpo.pattern_search(df, "id", "t", [["a", f"x{k}"] for k in range(n)]))) for n in (3, 10_000))
    assert abs(few - many) < 200


def test_feature_batch_splits_texts_once_and_counts_runs(spark):
    """Tokens feed descriptors and fingerprint alike; characters that do not count are taken out a run at a time."""
    from sievekit.operators import fingerprints as fpo
    df = spark.createDataFrame([(1, "Ab1!? é€😀~`x\n\n2"), (2, ""), (3, None), (4, "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")], "id int, text string")
    out = fpo.feature_batch(df, "text")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("split(lower(") == 1 and "[^0-9]+" in plan and "[^0-9]," not in plan
    got = {r["id"]: (r["calc_n_chars"], r["calc_digit_share"], r["calc_upper_share"], r["calc_punct_share"]) for r in out.collect()}
    assert got == {1: (15, 2 / 15, 1 / 15, 4 / 15), 2: (0, 0.0, 0.0, 0.0), 3: (None, None, None, None), 4: (32, 0.0, 0.0, 1.0)}
