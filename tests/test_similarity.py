import itertools
import random

import pytest

from pyspark.sql import functions as F

from sievekit.functions import sign_bits, with_fingerprint
from sievekit.operators import similarity as si


def _brute_pairs(rows, t):
    groups = {}
    for i, b in rows:
        if b:
            key = tuple(b)
            groups[key] = min(groups.get(key, i), i)
    reps = sorted((i, set(b)) for b, i in groups.items())
    out = {}
    for (i, a), (j, b) in itertools.combinations(reps, 2):
        x = len(a & b)
        s = x / (len(a) + len(b) - x)
        if s >= t:
            out[(min(i, j), max(i, j))] = s
    return out


def test_similarity_join_equals_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    f = with_fingerprint(docs, "text", "bits", 1, None).select("doc_id", "bits")
    rows = [(r["doc_id"], r["bits"]) for r in f.collect()]
    for t, salt in ((0.5, 20_000), (0.3, 2)):
        got = {(r["id_a"], r["id_b"]): r["similarity"] for r in si.similarity_join(f, "doc_id", "bits", t, salt_rows=salt).collect()}
        assert got == _brute_pairs(rows, t)


def test_similarity_join_synthetic_skew(spark):
    rng = random.Random(1)
    base = list(range(100))
    rows = []
    for i in range(150):   # many near copies sharing rare bits, plus exact copies
        s = set(base)
        s.discard(rng.randint(0, 99))
        if i % 3 == 0:
            s.add(100 + rng.randint(0, 5))
        rows.append((i, sorted(s)))
    rows += [(1000 + i, [500, 501, 502]) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, bits array<int>")
    got = {(r["id_a"], r["id_b"]): r["similarity"] for r in si.similarity_join(df, "id", "bits", 0.9, salt_rows=10).collect()}
    assert got == _brute_pairs(rows, 0.9)
    groups = si.copy_groups(df, "id", "bits").filter(F.col("rep_id") == 1000).collect()
    assert len(groups) == 40 and all(r["n_copies"] == 40 for r in groups)


def test_dice_join(spark):
    rows = [(1, [1, 2, 3, 4]), (2, [1, 2, 3, 5]), (3, [7, 8]), (4, [7, 9])]
    df = spark.createDataFrame(rows, "id long, bits array<int>")
    got = {(r["id_a"], r["id_b"]) for r in si.similarity_join(df, "id", "bits", 0.7, method="dice").collect()}
    assert got == {(1, 2)}     # dice(1,2) = 0.75, dice(3,4) = 0.5


def test_top_k_equals_brute_force(spark):
    emb = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").select("vec_id", "label", sign_bits("embedding").alias("bits"))
    protos = si.majority_bits(emb, "label", "bits", "qbits")
    got = {(r["query_id"], r["rank"]): (r["id"], r["similarity"]) for r in
           si.similar_top_k(emb, protos, "vec_id", "bits", "label", "qbits", k=3).collect()}
    corpus = [(r["vec_id"], set(r["bits"])) for r in emb.collect()]
    for p in protos.collect():
        q = set(p["qbits"])
        scored = sorted(((-(len(q & b) / (len(q) + len(b) - len(q & b))), i) for i, b in corpus if q & b))
        for k, (neg, i) in enumerate(scored[:3], start=1):
            assert got[(p["label"], k)] == (i, -neg)


def test_join_of_wide_elements_and_copies(spark):
    """Elements beyond 2**32, and the sizes of copy groups on both sides."""
    big = 1 << 59
    rows = [(1, [big, big + 1, big + 2, big + 3]), (2, [big, big + 1, big + 2, big + 3]), (3, [big + 1, big + 2, big + 3]), (4, [])]
    df = spark.createDataFrame(rows, "id long, bits array<bigint>")
    got = [tuple(r) for r in si.similarity_join(df, "id", "bits", 0.7).collect()]
    assert got == [(1, 3, 0.75, 2, 1)]


def test_too_many_queries(spark):
    df = spark.createDataFrame([(1, [1]), (2, [2])], "id long, bits array<int>")
    q = df.select(F.col("id").alias("q"), F.col("bits").alias("qb"))
    assert si.similar_top_k(df, q, "id", "bits", "q", "qb", k=1).count() == 2
    with pytest.raises(ValueError):
        si.similar_top_k(df, q, "id", "bits", "q", "qb", max_queries=1)


def test_top_k_with_ties_skips_pairs(spark):
    """Many equal similarities and sizes that differ widely: the same rows as brute force, from fewer pairs than all."""
    rng = random.Random(9)
    rows = [(i, sorted(rng.sample(range(300), rng.choice([3, 8, 8, 20, 60, 150])))) for i in range(400)] + [(1000 + k, []) for k in range(3)] + [(2000, None)]
    rows += [(3000 + k, rows[0][1]) for k in range(20)]
    queries = [(f"q{k}", rows[k][1]) for k in range(12)] + [("none", []), ("far", [999])]
    corpus = spark.createDataFrame(rows, "id bigint, bits array<int>")
    qs = spark.createDataFrame(queries, "q string, qb array<int>")
    for method in ("tanimoto", "dice"):
        got = sorted((r["query_id"], r["rank"], r["id"], r["similarity"]) for r in si.similar_top_k(corpus, qs, "id", "bits", "q", "qb", 4, method).collect())
        want = []
        for q, qb in queries:
            scored = []
            for i, b in rows:
                x = len(set(b or []) & set(qb))
                if x:
                    scored.append((-(x / (len(b) + len(qb) - x) if method == "tanimoto" else 2 * x / (len(b) + len(qb))), i))
            want += [(q, k + 1, i, -s) for k, (s, i) in enumerate(sorted(scored)[:4])]
        assert got == sorted(want)
    rows_, qs_ = (df.select(i, F.size(b).alias(n), si.packed_words(F.col(b), 16).alias("words")) for df, i, b, n in ((corpus, "id", "bits", "n"), (qs.where("size(qb) > 0"), "q", "qb", "nq")))
    bounded = si.near_sizes(rows_, qs_.withColumnRenamed("q", "query_id"), 4, "tanimoto")
    near = bounded.where("query_id <> 'far'")  # nothing bounds a query that no row resembles
    assert si._pairs_within(rows_, near).count() < 0.9 * 420 * 12


def test_packed_words(spark):
    df = spark.createDataFrame([([0, 63, 64, 127],), ([],), (None,)], "b array<int>")
    got = [r["w"] for r in df.select(si.packed_words(F.col("b"), 3).alias("w")).collect()]
    assert got == [[1 - (1 << 63), 1 - (1 << 63), 0], [0, 0, 0], [None] * 3] or got[:2] == [[1 - (1 << 63), 1 - (1 << 63), 0], [0, 0, 0]]
    with pytest.raises(ValueError):
        si.similar_top_k(df.select(F.lit(1).alias("id"), "b"), spark.createDataFrame([(1, [1 << 20])], "q int, qb array<int>"), "id", "b", "q", "qb")


def test_join_with_a_full_sketch(spark):
    """Eight counters for thousands of elements: the order says nothing, the pairs are the same."""
    rng = random.Random(4)
    rows = [(i, sorted({x + 10_000 * (i // 5) for x in rng.sample(range(60), 50)})) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, bits array<bigint>")
    got = {(r["id_a"], r["id_b"]): r["similarity"] for r in si.similarity_join(df, "id", "bits", 0.7, sketch_bits=3).collect()}
    assert got == _brute_pairs(rows, 0.7) and got


def test_sketch_counts_every_set(spark):
    from sievekit.plans.sketch import slot_counts
    df = spark.createDataFrame([([1, 2, 5],), ([1],), ([],), (None,), ([1 << 40 | 1],)], "s array<bigint>").repartition(3)
    assert slot_counts(df, "s", 2).tolist() == [0, 4, 1, 0]
    assert slot_counts(df, "s", 16)[[1, 2, 5]].tolist() == [3, 1, 1]


def test_similarity_join_writes_no_whole_sets(spark, monkeypatch):
    written, cut = [], si.cut_lineage
    monkeypatch.setattr(si, "cut_lineage", lambda df, *a: (written.append((a, df.columns)), cut(df, *a))[1])
    df = spark.createDataFrame([(k, list(range(k // 2, k // 2 + 40))) for k in range(20)] + [(20, []), (21, None)], "id bigint, bits array<bigint>")
    got = si.similarity_join(df, "id", "bits", 0.9).collect()
    assert {(r["id_a"], r["id_b"]) for r in got} == {(k, j) for k in range(0, 20, 2) for j in (k + 2, k + 4) if j < 20}
    assert {(r["copies_a"], r["copies_b"]) for r in got} == {(2, 2)}
    assert written and not [a for a, columns in written if "bits" in columns]


def test_similarity_join_deals_prefix_rows_once(spark, monkeypatch):
    """Seldom elements meet through one exchange, frequent ones through salts, whichever are which."""
    written, cut = {}, si.cut_lineage
    monkeypatch.setattr(si, "cut_lineage", lambda df, *a: (written.update({a[0] if a else "": df}), cut(df, *a))[1])
    df = spark.createDataFrame([(k, list(range(k // 4, k // 4 + 30))) for k in range(60)], "id bigint, bits array<bigint>")
    some = [sorted(map(tuple, si.similarity_join(df, "id", "bits", 0.8, salt_rows=s).collect())) for s in (1, 3, 20_000)]
    assert len(some[0]) == 3 * 15 - 6 and some[0] == some[1] == some[2]
    plan = written["candidates"]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RepartitionByExpression") == 2 and "c#" not in plan  # the same one on both sides


def test_similarity_join_moves_sources_not_sets(spark, monkeypatch):
    """Compared sets are made again from what they come from; pairs are the same as of moved sets."""
    from sievekit.functions import hashed_fingerprint, tokens
    written, cut = {}, si.cut_lineage
    monkeypatch.setattr(si, "cut_lineage", lambda df, *a: (written.update({a[0] if a else "": df}), cut(df, *a))[1])
    rng = random.Random(8)
    texts = [" ".join(f"w{k // 4}_{j if rng.random() < 0.99 else rng.random()}" for j in range(60)) for k in range(60)] + ["", None, "w0_1"]
    docs = spark.createDataFrame([*enumerate(texts)], "doc_id bigint, text string")
    df = with_fingerprint(docs, "text", "bits", 2, None)
    moved = sorted(map(tuple, si.similarity_join(df, "doc_id", "bits", 0.7).collect()))
    got = si.similarity_join(df, "doc_id", "bits", 0.7, source_col="text", from_source=lambda t: hashed_fingerprint(tokens(t), 2, None))
    assert sorted(map(tuple, got.collect())) == moved and moved
    plan = written["similarities"]._jdf.queryExecution().optimizedPlan().toString().splitlines()
    assert max(k for k, x in enumerate(plan) if "ArrowEvalPython" in x or "PythonUDF" in x) < min(k for k, x in enumerate(plan) if "Join" in x)
    rows = [(r["doc_id"], r["bits"]) for r in df.collect() if r["bits"]]
    assert {(a, b): s for a, b, s, *_ in moved} == _brute_pairs(rows, 0.7)


def test_similarity_join_drops_candidates_far_apart(spark, monkeypatch):
    """Sets that share seldom elements but differ in most are no candidates, however frequent their pairs."""
    written, cut = {}, si.cut_lineage
    monkeypatch.setattr(si, "cut_lineage", lambda df, *a: (written.update({a[0] if a else "": b}), b)[1] if (b := cut(df, *a)) else None)
    rows = [(k, sorted({1, 2, 3, *range(1000 * k + 10, 1000 * k + 200)} if k < 20 else {*range(90_000, 90_190), k})) for k in range(24)]
    df = spark.createDataFrame(rows, "id bigint, bits array<bigint>")
    got = {(r["id_a"], r["id_b"]): r["similarity"] for r in si.similarity_join(df, "id", "bits", 0.8).collect()}
    assert got == _brute_pairs(rows, 0.8) and len(got) == 6 == written["candidates"].count()


def test_parities_bound_the_difference_and_lone_elements_go(spark):
    import numpy as np

    from sievekit.plans.sketch import PARITY_WORDS, _parities, shared_slots, without_lone
    rng = random.Random(2)
    sets = [sorted(rng.sample(range(5000), rng.randint(0, 900))) for _ in range(30)] + [[]]
    got = _parities(np.array([x for s in sets for x in s], np.int64), np.array([len(s) for s in sets])).reshape(-1, PARITY_WORDS)
    apart = lambda a, b: sum((int(x) & 0xFFFFFFFFFFFFFFFF).bit_count() for x in got[a] ^ got[b])
    assert all(apart(a, b) <= len(set(sets[a]) ^ set(sets[b])) for a in range(31) for b in range(31)) and apart(0, 0) == 0
    df = spark.createDataFrame([(1, [1, 2, 3], [7, 8, 9]), (2, [1, 2], [9, 5]), (3, [], []), (4, [4], [7])], "id int, pos array<int>, tok array<int>").repartition(3)
    left = {r["id"]: (r["pos"], r["tok"]) for r in without_lone(df, shared_slots(df, "tok", 6)).collect()}
    assert left == {1: ([1, 3], [7, 9]), 2: ([1], [9]), 3: ([], []), 4: ([4], [7])}
