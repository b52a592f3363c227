"""A training-data pipeline: language ID, near-duplicate removal, benchmark
decontamination, secret redaction, packing.

Each stage takes the documents that its predecessor kept.  All but the last
return the columns of ``documents``."""

from __future__ import annotations

import os

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievekit.llm.common import stored
from sievekit.llm.decontaminate import drop_contaminated
from sievekit.llm.language import learn_languages, predict_languages
from sievekit.llm.ngram_join import keep_one_each
from sievekit.llm.packing import pack_documents
from sievekit.llm.secrets import redact_secrets
from sievekit.session import clear_scratch, scratch_made


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go: null and empty texts and
    those without a letter.  ``lang`` becomes the recognised one.  Repeated rows
    and null keys stay as they are; ties go to the first language by name; an
    empty table stays empty."""
    columns = docs.columns
    named = predict_languages(docs, learn_languages(docs), lang_as="named lang", score_as="named score").where("`named lang` <> 'und'")
    return named.withColumn("lang", F.col("named lang")).select(*columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, similarity
    of 0.8 or more) stays, that with the smallest id (null ids last, equal ones by
    a hash of the text).  Null, empty and wordless texts are near nothing and
    stay; an empty table stays empty."""
    return keep_one_each(docs, words=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that share a benchmark window go.  Null and empty texts share
    none; repeated rows go or stay together; an empty table or benchmark changes
    nothing."""
    return drop_contaminated(docs, spark.read.parquet(os.path.join(sf_dir, "benchmark.parquet")))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are masked; ``n_chars`` follows.  No document goes; null
    texts stay null, with a null ``n_chars``; an empty table stays empty."""
    return redact_secrets(docs).withColumn("n_chars", F.char_length("text").cast("bigint")).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the remaining documents and their places in sequences.  A null or
    empty text is one piece of the end token; repeated rows and null keys are
    packed like any other; an empty table gives no rows."""
    return pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("language_id", language_id), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("secrets", secrets), ("packing", packing)]

#: No stage but the last few could be SQL; tests compare the whole with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again by the next.
    What a stage wrote on its way goes once its result is written."""
    docs = spark.read.parquet(os.path.join(sf_dir, "documents.parquet"))
    earlier = scratch_made()
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, name)
            clear_scratch(spark, [p for p in scratch_made() if p not in earlier and p != docs.scratch])
    return docs
