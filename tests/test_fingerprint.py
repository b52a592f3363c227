from pyspark.sql import functions as F

from sievekit.functions import (dense_fingerprint, hashed_fingerprint, pattern_keys, sign_bits,
                                similarity, tokens, with_fingerprint)
from sievekit.operators import fingerprints as fpo
from sievekit.operators import frames as fr


def test_fingerprint_edge_cases(spark):
    df = spark.createDataFrame([(1, None), (2, ""), (3, "one"), (4, "a b c"), (5, "a b c")], "id int, t string")
    out = {r["id"]: r["bits"] for r in with_fingerprint(df, "t", "bits", 2, 64).collect()}
    assert out[1] is None and out[2] == []
    assert len(out[3]) == 1                      # one token: radius 0 only
    assert out[4] == out[5] and len(out[4]) <= 3 + 1   # 3 tokens + one radius-1 window
    assert out[4] == sorted(set(out[4])) and all(0 <= b < 64 for b in out[4])


def test_fingerprint_on_column_reference_equals_inline(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(20)
    a = {r["doc_id"]: r["bits"] for r in with_fingerprint(df, "text", "bits", 1, 256).collect()}
    b = {r["doc_id"]: r["bits"] for r in df.select("doc_id", hashed_fingerprint(tokens("text"), 1, 256).alias("bits")).collect()}
    assert a == b


def test_similarity_properties(spark):
    df = spark.createDataFrame([([1, 2, 3], [2, 3, 4]), ([], []), ([5], [5]), (None, [1])], "a array<int>, b array<int>")
    r = df.select(similarity("a", "b").alias("t"), similarity("b", "a").alias("t2"),
                  similarity("a", "b", "dice").alias("d"), similarity("a", "a").alias("self")).collect()
    assert r[0]["t"] == 0.5 and r[0]["t2"] == 0.5 and abs(r[0]["d"] - 2 / 3) < 1e-12
    assert r[1]["t"] == 0.0 and r[2]["t"] == 1.0 and r[2]["self"] == 1.0
    assert r[3]["t"] is None


def test_sign_and_dense_bits(spark):
    df = spark.createDataFrame([([0.5, -1.0, 0.0, 2.0],), ([],)], "e array<float>")
    r = df.select(sign_bits("e").alias("b")).collect()
    assert r[0]["b"] == [0, 3] and r[1]["b"] == []
    d = df.select(dense_fingerprint(sign_bits("e"), 5).alias("d")).first()["d"]
    assert d == [1, 0, 0, 1, 0]


def test_pattern_keys_and_search(spark):
    df = spark.createDataFrame([(1, "Of the people, of the"), (2, None), (3, "nothing")], "id int, t string")
    keys = {r["id"]: r["k"] for r in df.select("id", pattern_keys("t", ["[0-9]", "people"]).alias("k")).collect()}
    assert keys[1] == [0, 1] and keys[2] is None
    hits = fpo.pattern_search(df, "id", "t", [["of", "the"], ["missing"]]).collect()
    assert len(hits) == 1 and hits[0]["n_matches"] == 2
    assert [list(m) for m in hits[0]["matches"]] == [[0, 1], [3, 4]]


def test_hash_split_stable_under_repartition(spark):
    df = spark.range(2000).withColumnRenamed("id", "k")
    base = {r["k"]: r["split"] for r in fr.hash_split(df, "k").collect()}
    for n in (1, 4, 32):
        again = {r["k"]: r["split"] for r in fr.hash_split(df.repartition(n), "k").collect()}
        assert again == base
    counts = {s: list(base.values()).count(s) for s in ("train", "val", "test")}
    assert sum(counts.values()) == 2000 and 1300 < counts["train"] < 1500


def test_bit_usage_and_density(spark):
    df = spark.createDataFrame([([0, 2],), ([2],), ([],), (None,)], "b array<int>")
    usage = {r["bit"]: r["n_rows"] for r in fpo.bit_usage(df, "b", 4).collect()}
    assert usage == {0: 1, 1: 0, 2: 2, 3: 0}
    d = fpo.fingerprint_density(df, "b", 4).first()
    assert d["n_rows"] == 3 and d["mean_on_bits"] == 1.0 and d["sparsity"] == 0.75


def test_batch_featurize_user_function_with_failures(spark):
    import pandas as pd
    from pyspark.sql import types as T

    def fn(s: pd.Series) -> pd.DataFrame:
        if s.isna().any() or (s == "bad").any():
            raise ValueError("bad input")
        return pd.DataFrame({"n": s.str.len().astype("float64")})

    schema = T.StructType([T.StructField("n", T.DoubleType())])
    df = spark.createDataFrame([("abc",), ("bad",), (None,), ("hello",)], "t string")
    out = {r["t"]: r for r in fpo.batch_featurize(df, "t", fn, schema).collect()}
    assert out["abc"]["calc_n"] == 3.0 and out["hello"]["calc_n"] == 5.0
    assert out["bad"]["calc_n"] is None and out["bad"]["featurize_error"] is True
    assert out[None]["featurize_error"] is True
    assert out["abc"]["featurize_error"] is False


def test_null_results_and_bad_rows_are_flagged(spark):
    import pandas as pd
    from pyspark.sql import types as T

    calls = []

    def fn(s: pd.Series) -> pd.DataFrame:
        calls.append(len(s))
        if (s == "bad").any():
            raise ValueError
        return pd.DataFrame({"n": s.str.len().where(s != "none").astype("float64")})

    schema = T.StructType([T.StructField("n", T.DoubleType())])
    s = pd.Series(["x"] * 63 + ["bad"])
    out = fpo._isolated(fn, s, ["n"])
    assert out["n"].isna().sum() == 1 and len(calls) <= 2 * 7  # halves, not rows
    df = spark.createDataFrame([("none",), ("ok",)], "t string")
    got = {r["t"]: r["featurize_error"] for r in fpo.batch_featurize(df, "t", fn, schema).collect()}
    assert got == {"none": True, "ok": False}


def test_case_is_kept_on_request(spark):
    """On strings where c and C are different things."""
    df = spark.createDataFrame([(1, "CC(=O)Oc1ccccc1C(=O)O"), (2, "CN1C=NC2=C1C(=O)N(C(=O)N2C)C"), (3, "cc(=o)oC1CCCCC1c(=o)o")], "id int, s string")
    atom = "[A-Za-z][0-9]?|[=()]"
    low, kept = ({r["id"]: r["bits"] for r in with_fingerprint(df, "s", "bits", 1, 4096, pattern=atom, lowercase=x).collect()} for x in (True, False))
    assert low[1] == low[3] and kept[1] != kept[3] and low[1] != kept[1]
    hits = {r["id"] for r in fpo.pattern_search(df, "id", "s", [["c", "c"]], token_pattern="[A-Za-z]", lowercase=False).collect()}
    assert hits == {1, 3}


def test_unfolded_hashes(spark):
    df = spark.createDataFrame([(1, "a b c d"), (2, None), (3, "")], "id int, t string")
    out = {r["id"]: r["bits"] for r in with_fingerprint(df, "t", "bits", 1, None).collect()}
    assert len(out[1]) == 6 and all(0 <= b < 1 << 60 for b in out[1]) and out[2] is None and out[3] == []


def test_dense_of_edges(spark):
    df = spark.createDataFrame([([],), ([0],), ([4],), ([0, 1, 2, 3, 4],), (None,)], "b array<int>")
    got = [r["d"] for r in df.select(dense_fingerprint("b", 5).alias("d")).collect()]
    assert got == [[0] * 5, [1, 0, 0, 0, 0], [0, 0, 0, 0, 1], [1] * 5, None]


def _brute_search(rows, patterns):
    out = []
    for i, t in rows:
        toks = (t or "").lower().split()
        for pid, p in patterns:
            at = [list(range(k, k + len(p))) for k in range(len(toks) - len(p) + 1) if toks[k:k + len(p)] == p]
            if at:
                out.append((i, pid, len(at), at))
    return sorted(out, key=str)


def test_ten_thousand_patterns_equal_brute_force(spark, monkeypatch):
    import random
    rng = random.Random(3)
    words = [f"w{k}" for k in range(60)]
    rows = [(k, " ".join(rng.choices(words, k=rng.randint(0, 60)))) for k in range(60)] + [(7, None), (7, ""), (8, "w1 w1 w1 w1 W1")]
    patterns = [(k, rng.choices([*words, "absent"], k=rng.choice([1, 2, 2, 3, 4]))) for k in range(10_000)] + [(-1, ["w1", "w1"])]
    df = spark.createDataFrame(rows, "id int, t string").repartition(3)
    table = spark.createDataFrame(patterns, "pattern_id int, pattern array<string>")
    want = _brute_search(rows, patterns)
    for limit in (fpo.MAX_BROADCAST_PATTERNS, 10):  # the index broadcast, and shuffled
        monkeypatch.setattr(fpo, "MAX_BROADCAST_PATTERNS", limit)
        got = [(r["id"], r["pattern_id"], r["n_matches"], [list(m) for m in r["matches"]]) for r in fpo.pattern_search(df, "id", "t", table).collect()]
        assert sorted(got, key=str) == want
    assert fpo.pattern_search(df, "id", "t", []).count() == 0


def test_empty_patterns_are_an_error(spark):
    import pytest
    df = spark.createDataFrame([(1, "a")], "id int, t string")
    for bad in ([[]], [["a"], []]):
        with pytest.raises(ValueError):
            fpo.pattern_search(df, "id", "t", bad)


def test_rarity_against_brute_force(spark):
    import math
    rows = [(1, [0, 2, 5]), (2, [2]), (3, []), (4, None), (5, [2, 5]), (5, [7])]
    df = spark.createDataFrame(rows, "id int, b array<int>")
    n, df_ = 5, {b: sum(b in (r[1] or []) for r in rows) for b in range(8)}
    means = [sum(math.log(n / df_[b]) for b in r[1]) / len(r[1]) if r[1] else None for r in rows]
    lo, hi = min(m for m in means if m is not None), max(m for m in means if m is not None)
    want = sorted(((r[0], None if m is None else round(1 + 9 * (m - lo) / (hi - lo), 6)) for r, m in zip(rows, means)), key=str)
    assert sorted(map(tuple, fpo.rarity_score(df, "id", "b", 8).collect()), key=str) == want
    assert [r["rarity"] for r in fpo.rarity_score(df.where("id = 2"), "id", "b", 8).collect()] == [1.0]
    assert fpo.rarity_score(df.where("false"), "id", "b", 8).count() == 0


def test_set_up_runs_once_a_task(spark, tmp_path):
    import os
    import uuid

    import pandas as pd
    import pytest
    from pyspark.sql import types as T

    folder = str(tmp_path)

    def setup():
        open(os.path.join(folder, uuid.uuid4().hex), "w").close()
        return lambda s: pd.DataFrame({"n": s.str.len().astype("Int64")})

    schema = T.StructType([T.StructField("n", T.LongType())])
    df = spark.createDataFrame([(f"text {k}" * (k % 3) if k % 5 else None,) for k in range(300)], "t string").repartition(4)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10")  # some eight batches a task
    try:
        out = fpo.batch_featurize(df, "t", schema=schema, setup=setup, prefix="u_").collect()
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert len(out) == 300 and len(os.listdir(folder)) == 4
    assert all(r["u_n"] == (None if r["t"] is None else len(r["t"])) and r["featurize_error"] == (r["t"] is None) for r in out)
    with pytest.raises(ValueError):
        fpo.batch_featurize(df, "t", lambda s: s, schema, setup=setup)


def test_fingerprint_hashes_a_token_once_a_batch(spark, monkeypatch):
    """Windows of all rows at once, rows cut apart again; a distinct token costs one digest."""
    import hashlib

    import pyarrow as pa
    from sievekit.functions import fingerprint as fp
    rows = [["a", "b", "a"], None, [], ["b", None, "a"], ["a"] * 5, ["c", "b"]]
    seen, md5 = [], hashlib.md5
    monkeypatch.setattr(fp.hashlib, "md5", lambda x, **k: (seen.append(x), md5(x, **k))[1])
    monkeypatch.setattr(fp, "MOST_TOKENS", 4)
    h = {t: int(md5(t.encode()).hexdigest()[:8], 16) for t in "abc"}

    def brute(row, n_bits):
        out = set()
        for k in range(3):
            for i in range(len(row) - 2 * k):
                window, runs = row[i:i + 2 * k + 1], []
                for factor, prime in (fp.FOLDED,) if n_bits else fp.UNFOLDED:
                    v = k
                    for t in window:
                        v = None if t is None or v is None else (v * factor + h[t]) % prime
                    runs.append(v)
                out.add(None if None in runs else runs[0] % n_bits if n_bits else runs[0] * (1 << 30) + runs[1])
        return sorted(out - {None}) + [None] * (None in out)
    for n_bits in (None, 64):
        seen.clear()
        got = fp._fingerprints(pa.array(rows, pa.list_(pa.string())), 2, n_bits).to_pylist()
        assert got == [None if r is None else brute(r, n_bits) for r in rows]
        assert sorted(seen) == [b"a", b"b", b"c"]
