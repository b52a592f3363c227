import corpus_pipeline
import public_tokenizers
from pyspark.sql import functions as F

from sievekit.llm.common import stored

from . import test_decontaminate, test_ngram_join, test_secrets

SF = "/root/testdata/sf0.001"


def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    extra = spark.createDataFrame([(10_001, None, "en", "s", 0), (10_002, "12 34", "en", "s", 5), (10_003, 'a clean text with password="hunter2hunter2" inside', "en", "s", 49)], docs.schema)
    docs = docs.unionAll(extra)
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "near_duplicates", "decontamination", "secrets", "packing"]
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        out = stored(stage(spark, docs, SF), name)
        if name != "packing":
            assert out.columns == docs.columns
            after = {r["doc_id"]: r["text"] for r in out.collect()}
            assert out.count() == len(after)
        if name == "language_id":
            assert before.keys() - after.keys() == {i for i, t in before.items() if not any(c.isalpha() for c in t or "")} >= {10_001, 10_002}
        elif name == "near_duplicates":
            assert after.keys() == {i for i, _, c in test_ngram_join.brute(list(before.items()), words=5, percent=80) if i == c}
        elif name == "decontamination":
            assert after.keys() == {r[0] for r in test_decontaminate.brute(before.items(), items) if not r[-1]}
        elif name == "secrets":
            assert after.keys() == before.keys() and "[SECRET]" in after[10_003]
            assert all(not test_secrets.brute(t) for t in after.values())
            assert out.where(F.col("n_chars") != F.char_length("text")).isEmpty()
        else:
            assert {r[0] for r in out.select("doc_id").collect()} == before.keys()
            assert out.groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("m")).where("n > 2048 OR n <> m").isEmpty()
        docs = out


def test_run_and_empty_table(spark, tmp_path):
    assert corpus_pipeline.run(spark, SF).count() > 0
    for t in ("documents", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").where("false").write.parquet(f"{tmp_path}/{t}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_near_copies_at_five_words(spark, docs_of):
    """5-word similarity of 0.80 to 0.85, as a replaced tail and as scattered edits."""
    words = [f"w{k}" for k in range(200)]
    tail = words[:179] + [f"t{k}" for k in range(21)]
    far = words[:170] + [f"f{k}" for k in range(30)]
    other = [f"o{k}" for k in range(190)]
    edited = [f"x{k}" if k in (20, 70, 120, 170) else w for k, w in enumerate(other)]
    rows = [(k, " ".join(t)) for k, t in enumerate((words, tail, far, other, edited))]
    kept = {r["doc_id"] for r in corpus_pipeline.near_duplicates(spark, docs_of(rows), SF).collect()}
    assert kept == {i for i, _, c in test_ngram_join.brute(rows, percent=80, words=5) if i == c} == {0, 2, 3}
    assert {i for i, _, c in test_ngram_join.brute(rows) if i == c} == {0, 1, 2, 3, 4}


def test_near_duplicates_with_null_and_repeated_keys(spark, docs_of):
    """Of each group by 5 words and 0.8 one row stays, that with the smallest key (null last)."""
    base = " ".join(f"w{k}" for k in range(60))
    rows = [(None, base), (None, base + " end"), (4, base), (4, base), (4, "another text with more than five words"), (3, base.replace("w30", "x")), (9, None), (9, None), (None, ""),
            (8, "seldom seen words stand here alone"), (7, "seldom seen words stand here alone"), (None, "keyless text of six plain words"), (None, "keyless text of six plain words")]
    kept = sorted(((r["doc_id"], r["text"]) for r in corpus_pipeline.near_duplicates(spark, docs_of(rows), SF).collect()), key=str)
    assert kept == sorted([(3, rows[5][1]), (4, rows[4][1]), (9, None), (9, None), (None, ""), (7, rows[10][1]), (None, rows[11][1])], key=str)


def test_a_column_that_differs_by_case_alone(spark):
    """TEXT beside text, DOC_ID beside doc_id: only the exact names are read, all come back."""
    from sievekit.llm.bpe import encode_documents
    from sievekit.llm.decontaminate import drop_contaminated
    from sievekit.llm.language import learn_languages, predict_languages
    from sievekit.llm.ngram_join import keep_one_each
    from sievekit.llm.secrets import redact_secrets

    docs = spark.createDataFrame([(1, "some words in one text of seven", "en", "x", 9), (2, "some words in one text of seven", "en", "x", 9)],
                                 "doc_id bigint, text string, lang string, TEXT string, DOC_ID int")
    items = spark.createDataFrame([(1, "x", "no shared words here")], "item_id bigint, TEXT string, text string")
    outs = [keep_one_each(docs), drop_contaminated(docs, items), redact_secrets(docs), predict_languages(docs, learn_languages(docs)).drop("lang_pred", "score")]
    assert [o.columns for o in outs] == [docs.columns] * 4
    assert [len(o.collect()) for o in outs] == [1, 2, 2, 2] and outs[0].first()[0] == 1
    assert sorted(r["doc_id"] for r in encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json")).collect()) == [1, 2]
