import hashlib
import random

from pyspark.sql import functions as F

from sievekit.llm.fingerprints import FLOOR, LIMIT, add_sketch, as_text, containment, edited_fingerprints, fingerprint_digest, fingerprints, likeness, merged, with_next


def shingles(t):
    w = (t or "").lower().split()
    return {tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))} if w else set()


def brute_edits(rows):
    rows = sorted(((i is not None, i or 0, t or "") for i, t in rows))
    out = []
    for k, (some, i, t) in enumerate(rows):
        q = len(t) // 4
        e = t[:len(t) - q] + rows[(k + 1) % len(rows)][2][:q]
        out.append((i if some else None, len(t), hashlib.sha256(e.encode()).hexdigest()))
    return sorted(out, key=str)


def check(docs_of, rows):
    got = [r.asDict() for r in fingerprint_digest(docs_of(rows)).collect()]
    assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=str) == brute_edits(rows)
    assert all(0 <= r[c] <= 1 for r in got for c in ("near_edited", "near_next"))


def test_odd_rows_and_neighbours(docs_of, odd_rows):
    check(docs_of, odd_rows)
    check(docs_of, [(5, "only one é")])
    check(docs_of, [(k * 1000 - 7, f"text {k} " * (k % 13)) for k in range(900)])  # several ranges
    assert fingerprint_digest(docs_of([])).count() == 0


def test_ranges_see_few_rows(spark):
    rows = spark.range(2000).select((F.col("id") * F.col("id")).alias("k"), F.col("id").cast("string").alias("text"))
    got = {r["k"]: r["next_text"] for r in with_next(rows, "k", ["text"], rows_each=10).collect()}
    assert got == {k * k: str((k + 1) % 2000) for k in range(2000)}


def exact(spark, texts):
    """Sketches and true shingle hashes (a sketch at an unreachable floor)."""
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    return {r["i"]: r["s"] for r in add_sketch(df, "t", "s").collect()}


def test_threshold_floor_and_equality(spark):
    rng = random.Random(1)
    word = lambda: f"w{rng.randint(0, 5000)}"
    long, short = " ".join(word() for _ in range(6000)), "a b c d e f g h"
    got = exact(spark, [long, long, short, "a b", "", None])
    assert got[0] == got[1] == sorted(got[0]) and max(got[0]) <= LIMIT
    assert abs(len(got[0]) - 6000 / 16) < 80
    assert len(got[2]) == 4 and len(got[3]) == 1 and got[4] == got[5] == []


def test_estimates(spark):
    rng = random.Random(2)
    words = [f"w{rng.randint(0, 10 ** 6)}" for _ in range(8000)]
    texts = [" ".join(words), " ".join(words[:2000]), " ".join(words[1000:6000]), "", " ".join(words[:12])]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    df = add_sketch(df, "t", "s")
    a, b = df.select(F.col("t").alias("ta"), F.col("s").alias("a")), df.select(F.col("t").alias("tb"), F.col("s").alias("b"))
    pairs = a.join(b, F.length("ta") >= F.length("tb")).select("*", likeness(F.col("a"), F.col("b")).alias("like"),
                                                               containment(F.col("b"), F.col("a")).alias("inside"), merged(F.col("a"), F.col("b")).alias("m"))
    for r in pairs.collect():
        x, y = shingles(r["ta"]), shingles(r["tb"])
        if r["ta"] and r["tb"]:
            assert abs(r["like"] - len(x & y) / len(x | y)) < 0.12
            assert abs(r["inside"] - len(x & y) / len(y)) < 0.12
        else:
            assert r["like"] == float(r["ta"] == r["tb"]) and r["inside"] == 1.0
        if y <= x and len(y) >= FLOOR:
            assert r["m"] == r["a"]


def test_edited_copies_are_near_and_neighbours_are_not(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [r["text"] for r in docs.orderBy("doc_id").select("text").collect()]
    got = edited_fingerprints(docs).orderBy("doc_id").collect()
    for c, other in (("near_edited", lambda k: texts[k][:len(texts[k]) - len(texts[k]) // 4] + texts[(k + 1) % len(texts)][:len(texts[k]) // 4]),
                     ("near_next", lambda k: texts[(k + 1) % len(texts)])):
        errors = []
        for k, r in enumerate(got):
            x, y = shingles(texts[k]), shingles(other(k))
            errors.append(abs(r[c] - (len(x & y) / len(x | y) if x | y else 1)))
        assert sum(errors) / len(errors) < 0.1


def test_text_form_and_no_python(spark, capsys):
    df = spark.createDataFrame([(1, "x y z")], "doc_id bigint, text string")
    row = fingerprints(df).select("sketch", as_text(F.col("sketch")).alias("hex")).first()
    assert row["hex"] == f"{row['sketch'][0] % (1 << 64):016X}"
    fingerprint_digest(spark.read.parquet("/root/testdata/sf0.001/documents.parquet")).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan.replace("ExistingRDD", "") and "Arrow" not in plan and "SinglePartition" not in plan
