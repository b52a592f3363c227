import numpy as np
from pyspark.sql import functions as F

from sievekit.llm.common import fold_of
from sievekit.llm.language import Space, learn_languages, predict_languages, trigram_counts


def test_bundle_is_the_sum_of_bound_letters():
    sp = Space(64, 3)
    letters = {c: sp.letters[k].astype(int) for c, k in ((" ", 0), ("a", 1), ("b", 2))}
    bind = lambda x, y, z: np.roll(letters[x], 2) * np.roll(letters[y], 1) * letters[z]
    want = bind(" ", "a", "b") + bind("a", "b", " ") + bind("b", " ", "a") + bind(" ", "a", " ")
    assert (sp.bundle("AB, -- 7a") == want).all()


def test_no_letters():
    assert all(len(trigram_counts(t)[0]) == 0 for t in (None, "", " 12 ?", "🙂"))
    assert len(trigram_counts("𐐀")[0])  # a letter beyond the basic plane


def test_odd_rows(docs_of, odd_rows):
    docs = docs_of(odd_rows).withColumn("lang", F.when(F.col("doc_id") == 5, "en").when(F.col("doc_id") == 7, "xx"))
    learned = learn_languages(docs)
    assert sorted(learned) == ["en", "xx"]
    got = predict_languages(docs, learned)
    assert got.count() == len(odd_rows) and got.columns[-2:] == ["lang_pred", "score"]
    by = {r["doc_id"]: r for r in got.collect()}
    assert [by[i]["lang_pred"] for i in (1, 2, 3, 4, 5, 7)] == ["und"] * 4 + ["en", "xx"]
    assert all(0 <= r["score"] <= 1 for r in by.values())
    assert learn_languages(docs.where("false")) == {}
    assert {r[0] for r in predict_languages(docs, {}).select("lang_pred").distinct().collect()} == {"und"}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    learned = learn_languages(docs, where=fold_of(F.col("doc_id"), 3) != 1)
    held = predict_languages(docs.where(fold_of(F.col("doc_id"), 3) == 1), learned).where("n_chars > 40")
    assert held.where("lang = lang_pred").count() >= 0.98 * held.count()


def test_same_in_any_partitioning(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    a, b = learn_languages(docs.repartition(1)), learn_languages(docs.repartition(7))
    assert all((a[k] == b[k]).all() for k in a) and sorted(a) == sorted(b)


def test_no_two_letters_share_a_vector(spark):
    letters = "äñöéüßабгдαβγعربسםש日本語𐐨" + "".join(map(chr, range(0x4E00, 0x4E64)))
    a, b = Space(512, 11), Space(512, 11)
    first, again = {c: a.bundle(c) for c in letters}, {c: b.bundle(c) for c in reversed(letters)}
    assert len({v.tobytes() for v in first.values()}) == len(letters)
    assert all((first[c] == again[c]).all() for c in letters)  # in any order of meeting
    docs = spark.createDataFrame([("x", "ä ä ä"), ("y", "ñ ñ ñ"), ("z", "日本"), ("u", "本日")], "lang string, text string")
    got = predict_languages(docs, learn_languages(docs)).collect()
    assert all(r["lang_pred"] == r["lang"] and r["score"] > 0.99 for r in got)
