from pyspark.sql import functions as F

from sievekit.llm.common import fold_of
from sievekit.llm.toxicity import Lexicon, Matcher, fold, learn_lexicon, score_toxicity


def test_folding():
    assert fold("ІDІОТ 1d1ot $tup1d i!diot ｔｒａｓｈ st​upid").split() == ["idiot", "idiot", "stupid", "iidiot", "trash", "stupid"]
    assert fold("wow!! the&&& a$$$ (idiot)").split() == ["wow", "the", "a", "idiot"]
    assert fold(None) == fold("") == " "
    assert "ó" in fold("CHÓN")


def test_matches_equal_brute_force():
    terms = ((" idio", 2.0), (" idiot", 3.0), (" scum ", 1.5), (" trash", 1.0))
    m = Matcher(Lexicon(terms, (" trash can ",)))
    for text in ("An idiot, idiotic scum; scummy", "trash trash can trashcan, Trash", "", None, "xidiot"):
        folded = fold(text)
        spared = {k for k in range(len(folded)) if any(folded.startswith(" trash can ", s) and s <= k < s + 10 for s in range(max(0, k - 11), k + 1))}
        want = []
        for k in range(len(folded)):
            w = [x for t, x in terms if folded.startswith(t, k)]
            if w and k not in spared:
                want.append((k, max(w)))
        assert m.matches(folded) == want


def test_score_falls_with_length_and_rises_with_matches():
    m = Matcher(Lexicon(((" idiot", 3.0),), ()))
    assert m.score("idiot idiot and more") > m.score("idiot and more") > m.score("idiot " + "word " * 500) > m.score("word " * 500) == m.score(None)


def test_odd_rows(docs_of, odd_rows, spark):
    docs = docs_of(odd_rows)
    labels = spark.createDataFrame([(1, 1), (2, 0), (5, None), (None, 1)], "doc_id bigint, toxic int")
    lexicon = learn_lexicon(docs, labels)
    out = score_toxicity(docs, lexicon)
    assert out.columns == ["doc_id", "score", "predicted"] and out.count() == len(odd_rows)
    assert out.where("score BETWEEN 0 AND 1").count() == len(odd_rows)
    empty = learn_lexicon(docs.where("false"), labels.where("false"))
    assert empty.terms == () and score_toxicity(docs, empty).where("predicted = 1").count() == 0
    assert score_toxicity(docs.where("false"), lexicon).count() == 0


def test_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    fold_ = fold_of(F.col("doc_id"), 4)
    lexicon = learn_lexicon(docs, labels, where=fold_ != 2)
    held = score_toxicity(docs, lexicon).where(fold_ == 2).join(labels, "doc_id").groupBy("toxic", "predicted").count().collect()
    n = {(r["toxic"], r["predicted"]): r["count"] for r in held}
    assert n[1, 1] >= 0.8 * (n[1, 1] + n.get((1, 0), 0)) and n.get((0, 1), 0) <= 0.01 * n[0, 0]
