"""

Every query reads the driver's tables under ``sf_dir`` (whole tables,
whole texts) and runs one operator of the ``sievekit`` package.  The
matching DuckDB SQL restates the same semantics on the same files.
Queries without an oracle (model training) get the rows-only check and
their own tests."""

from __future__ import annotations

import os
import re
import warnings
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.ml.functions import vector_to_array
from pyspark.sql import types as T

from sievekit.functions import (dense_fingerprint, hashed_fingerprint, pattern_keys, sign_bits, similarity,
                                tokens, with_fingerprint)
from sievekit.operators import evaluate as ev
from sievekit.operators import fingerprints as fpo
from sievekit.operators import frames as fr
from sievekit.operators import profile as pr
from sievekit.operators import quality as qu
from sievekit.operators import rules as ru
from sievekit.operators import runs as rn
from sievekit.operators import similarity as si
from sievekit.operators import train as tr
from sievekit.plans.sqlgen import (d, descriptors_sql, fingerprint_sql, linear_score_sql, split_sql,
                                   token_hashes_sql, tokens_sql, unit_hash_sql, weighted_score_sql)
from sievekit.session import cut_lineage, ensure_checkpoint_dir, scratch_path
from sievekit.sources import tables as io

SMOKE_DIR = "/root/testdata/sf0.001"

_Q: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
_SQL: dict[str, str] = {}


def _register(name: str, sql: str | None = None):
    def deco(fn):
        _Q[name] = fn
        if sql is not None:
            _SQL[name] = sql
        return fn
    return deco


def _t(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf, f"{name}.parquet"))


# ---------------------------------------------------------------- parameters
# Fixed query parameters (chosen once; queries and oracles share them).
FP_RADIUS, FP_BITS = 2, 2048
JOIN_THRESHOLD = 0.8  # the join compares unfolded window hashes
LINE_RULES = [("qty_violation", "l_quantity", 45), ("price_violation", "l_extendedprice", 95000),
              ("discount_violation", "l_discount", 0.09), ("tax_violation", "l_tax", 0.07)]
LINE_WEIGHTS = [("l_quantity", ">", 45, 0.15), ("l_extendedprice", ">", 95000, 0.2),
                ("l_discount", ">", 0.09, 0.1), ("l_tax", ">", 0.07, 0.1),
                ("l_quantity", "<", 5, 0.15), ("l_linenumber", ">", 5, 0.1)]
LINE_LINEAR = [(-0.05, "l_quantity", 25), (5.0, "l_discount", 0.05), (-3.0, "l_tax", 0.04)]
LINE_BONUSES = [("l_quantity", 10, 30, 0.2), ("l_discount", 0.02, 0.06, 0.2)]
LINE_BANDS = [(0.7, "active"), (0.4, "moderate")]
LINE_CURVES = [("l_quantity", 0.0, 1.0, 25.0, 20.0, 3.0, 3.0, 1.0, 1.0),
               ("l_discount", 0.0, 1.0, 0.05, 0.06, 0.01, 0.01, 1.0, 0.5)]
DESC_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
DOC_PATTERNS = ["[0-9]", "@", "https?://", "[A-Z]{3,}", "[|]", "[!?]"]
TOKEN_PATTERNS = [["of", "the"], ["de", "la"], ["the"]]
RANGE_CHECKS = [("quantity_positive", "l_quantity", 0, None), ("discount_range", "l_discount", 0, 0.1),
                ("tax_range", "l_tax", 0, 0.08), ("price_nonneg", "l_extendedprice", 0, None)]
DESCRIPTORS = ["n_chars", "n_tokens", "distinct_token_share", "digit_share", "upper_share", "punct_share", "repeated_line_share"]
DOC_WEIGHTS = [("distinct_token_share", "<", 0.6, 0.3), ("punct_share", ">", 0.05, 0.25), ("repeated_line_share", ">", 0.1, 0.3),
               ("n_tokens", ">", 300, 0.25)]
DOC_LINEAR = [(1.0, "distinct_token_share", 0.7), (4.0, "punct_share", 0.02), (-0.0002, "n_tokens", 200)]


def _op(c, op, v):
    return ru.compare(c, op, v)


def _sql_cond(c, op, v):
    return f"{c} {op} {v!r}"


# ------------------------------------------------------------ shared frames
def _lineitem_nulls(spark, sf):
    li = _t(spark, sf, "lineitem")
    return li.withColumns({
        "l_discount": F.when(F.col("l_quantity") > 48, F.lit(None)).otherwise(F.col("l_discount")),
        "l_tax": F.when(F.col("l_tax") > 0.07, F.lit(float("nan"))).otherwise(F.col("l_tax")),
        "l_returnflag": F.when((F.col("l_linestatus") == "F") & (F.col("l_quantity") < 3), F.lit(None))
                         .otherwise(F.col("l_returnflag")),
    })


LINEITEM_NULLS_SQL = """(SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice,
  CASE WHEN l_quantity > 48 THEN NULL ELSE l_discount END AS l_discount,
  CASE WHEN l_tax > 0.07 THEN 'NaN'::DOUBLE ELSE l_tax END AS l_tax,
  CASE WHEN l_linestatus = 'F' AND l_quantity < 3 THEN NULL ELSE l_returnflag END AS l_returnflag,
  l_linestatus, l_shipdate FROM lineitem)"""


def _part_nulls(spark, sf):
    p = _t(spark, sf, "part")
    return p.withColumns({
        "p_size": F.when(F.col("p_size") > 45, F.lit(None)).otherwise(F.col("p_size")),
        "p_retailprice": F.when(F.col("p_size") < 3, F.lit(float("nan"))).otherwise(F.col("p_retailprice")),
        "p_brand": F.when(F.col("p_type") == "SMALL", F.lit(None)).otherwise(F.col("p_brand")),
    })


PART_NULLS_SQL = """(SELECT p_partkey, p_name,
  CASE WHEN p_type = 'SMALL' THEN NULL ELSE p_brand END AS p_brand, p_type,
  CASE WHEN p_size > 45 THEN NULL ELSE p_size END AS p_size,
  CASE WHEN p_size < 3 THEN 'NaN'::DOUBLE ELSE p_retailprice END AS p_retailprice FROM part)"""


def _parts(spark) -> int | None:
    """Partitions for row-wise work on tables of few splits (the bench and the
    small test files are one split each); unset on a cluster."""
    n = spark.conf.get("spark.sievekit.partitions", None)
    return int(n) if n else None


def _doc_fp(spark, sf, n_bits=FP_BITS, radius=FP_RADIUS):
    docs = _t(spark, sf, "documents").select("doc_id", "text")
    return with_fingerprint(docs, "text", "bits", radius, n_bits, partitions=_parts(spark)).select("doc_id", "bits")


def _doc_fp_sql(n_bits=FP_BITS, radius=FP_RADIUS):
    return (f"(SELECT doc_id, {fingerprint_sql('h', radius, n_bits)} AS bits FROM "
            f"(SELECT doc_id, {token_hashes_sql(tokens_sql('text'))} AS h FROM documents))")


def _line_flags(spark, sf):
    li = _t(spark, sf, "lineitem")
    rules = [(n, ru.above(c, v)) for n, c, v in LINE_RULES]
    return ru.rule_flags(li, rules)


_LINE_FLAGS_SQL = ", ".join(f"CASE WHEN {c} > {v!r} THEN 1 ELSE 0 END AS {n}" for n, c, v in LINE_RULES)
_LINE_SUM_SQL = " + ".join(f"CASE WHEN {c} > {v!r} THEN 1 ELSE 0 END" for n, c, v in LINE_RULES)
LINE_FLAGS_SQL = (f"(SELECT *, {_LINE_FLAGS_SQL}, CAST({_LINE_SUM_SQL} AS INTEGER) AS n_violations, "
                  f"({_LINE_SUM_SQL}) <= 1 AS passes FROM lineitem)")


def _doc_scores(spark, sf):
    """Two deterministic "models" over documents: a weighted rule score (with
    the share of capitals as its continuous part) and a linear score."""
    docs = _t(spark, sf, "documents").select("doc_id", "text")
    docs = ru.text_descriptors(docs, "text", partitions=_parts(spark)).drop("text")
    scored = ru.weighted_rule_score(docs, [(_op(c, op, v), w) for c, op, v, w in DOC_WEIGHTS], noise=F.col("upper_share"),
                                    score_col="score", label_col="pred", threshold=0.25)
    scored = ru.linear_score(scored, DOC_LINEAR, 0.5, (0.0, 1.0), out="score_b", digits=4)
    return scored.select("doc_id", "score", F.col("pred").cast("int").alias("pred"), "score_b")


def _eval_frame(spark, sf):
    lab = _t(spark, sf, "labels").select("doc_id", F.col("toxic").alias("label"))
    s = _doc_scores(spark, sf)
    return s.join(lab, "doc_id").select("doc_id", "label", F.col("pred").alias("prediction"), "score",
                                        "score_b", (F.col("score_b") > 0.5).cast("int").alias("prediction_b"))


_DOC_TERMS_SQL = [(f"{c} {op} {d(v) if isinstance(v, float) else v}", w) for c, op, v, w in DOC_WEIGHTS]
DOC_SCORES_SQL = f"""(SELECT doc_id, score, CAST(pred AS INTEGER) AS pred, score_b FROM (
  SELECT doc_id, {weighted_score_sql(_DOC_TERMS_SQL, 0.25, score='score', label='pred', noise='upper_share')},
    {linear_score_sql(DOC_LINEAR, 0.5, (0.0, 1.0), 'score_b', 4)}
  FROM (SELECT doc_id, {descriptors_sql('text')} FROM documents)))"""
EVAL_SQL = f"""(SELECT s.doc_id, l.toxic AS label, s.pred AS prediction, s.score, s.score_b,
  CAST(s.score_b > 0.5 AS INTEGER) AS prediction_b
  FROM {DOC_SCORES_SQL} s JOIN labels l ON s.doc_id = l.doc_id)"""


# ================================================================ 2.1 I/O
@_register("read_table", "SELECT * FROM orders")
def q_read_table(spark, sf):
    return io.read_table(spark, os.path.join(sf, "orders.parquet"))


PART_SCHEMA = T.StructType([T.StructField("p_partkey", T.LongType()), T.StructField("p_name", T.StringType()),
                            T.StructField("p_brand", T.StringType()), T.StructField("p_type", T.StringType()),
                            T.StructField("p_size", T.IntegerType()),
                            T.StructField("p_retailprice", T.DoubleType())])


@_register("read_csv", "SELECT *, CAST(NULL AS VARCHAR) AS _corrupt_record FROM part")
def q_read_csv(spark, sf):
    path = scratch_path(spark, "part-csv")
    _t(spark, sf, "part").write.mode("overwrite").option("header", True).csv(path)
    return io.read_csv(spark, path, PART_SCHEMA)


CONFORM_SCHEMA = T.StructType([T.StructField("p_partkey", T.StringType()),
                               T.StructField("p_size", T.DoubleType()),
                               T.StructField("p_type", T.IntegerType()),
                               T.StructField("p_retailprice", T.DoubleType()),
                               T.StructField("p_comment", T.StringType())])


@_register("conform", """SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, CAST(p_size AS DOUBLE) AS p_size,
  TRY_CAST(p_type AS INTEGER) AS p_type, p_retailprice, CAST(NULL AS VARCHAR) AS p_comment FROM part""")
def q_conform(spark, sf):
    return io.conform(_t(spark, sf, "part"), CONFORM_SCHEMA)


CONFORM_DRIFT_SQL = [("p_partkey", "retyped", "string", "bigint"), ("p_size", "retyped", "double", "int"), ("p_type", "retyped", "int", "string"),
                     ("p_retailprice", "same", "double", "double"), ("p_comment", "missing", "string", None),
                     ("p_name", "extra", None, "string"), ("p_brand", "extra", None, "string")]


@_register("conform_drift", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{k}' AS change, {'NULL' if t is None else repr(t)} AS declared, {'NULL' if f is None else repr(f)} AS found, "
    + ("CAST(count_if(p_type IS NOT NULL AND TRY_CAST(p_type AS INTEGER) IS NULL) AS BIGINT)" if c == "p_type" else "CAST(count_if(false) AS BIGINT)") + " AS n_lost FROM part"
    for c, k, t, f in CONFORM_DRIFT_SQL))
def q_conform_drift(spark, sf):
    return io.schema_drift(_t(spark, sf, "part"), CONFORM_SCHEMA)


@_register("conform_rejects", """SELECT p_partkey, 'p_type' AS column_name, 'int' AS declared, p_type AS value FROM part
  WHERE p_type IS NOT NULL AND TRY_CAST(p_type AS INTEGER) IS NULL""")
def q_conform_rejects(spark, sf):
    return io.rejects(_t(spark, sf, "part"), CONFORM_SCHEMA, ["p_partkey"])


@_register("write_table", "SELECT * FROM orders")
def q_write_table(spark, sf):
    path = scratch_path(spark, "orders-copy")
    io.write_table(_t(spark, sf, "orders"), path)
    return io.read_table(spark, path)


@_register("write_batches", "SELECT * FROM orders")
def q_write_batches(spark, sf):
    """Orders by status, one status loaded twice."""
    path, orders = scratch_path(spark, "orders-batches"), _t(spark, sf, "orders")
    for part in (orders.where("o_orderstatus = 'F'"), orders.where("o_orderstatus <> 'F'"), orders.where("o_orderstatus = 'F'")):
        io.write_batches(part, path, "o_orderstatus")
    return spark.read.schema(orders.schema).parquet(path)


@_register("verify_persisted", "SELECT count(*) AS rows_written, count(*) AS rows_read, true AS matches FROM orders")
def q_verify_persisted(spark, sf):
    return io.write_verified(_t(spark, sf, "orders"), scratch_path(spark, "orders-verify"))


_LI_TYPES = [("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
             ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
             ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
             ("l_linestatus", "string"), ("l_shipdate", "timestamp_ntz")]


@_register("use_namespace", """SELECT 'sievekit_query' AS database, lang, source, count(*) AS n_docs, CAST(sum(n_chars) AS BIGINT) AS n_chars
  FROM documents GROUP BY lang, source""")
def q_use_namespace(spark, sf):
    """Documents written into a namespace of its own and counted there."""
    before = spark.catalog.currentDatabase()
    name = io.use_namespace(spark, "sievekit_query", scratch_path(spark, "namespace"))
    try:
        io.write_table(_t(spark, sf, "documents"), "documents_copy")
        copy = io.read_table(spark, f"{name}.documents_copy")
    finally:
        io.use_namespace(spark, before)
    return copy.groupBy("lang", "source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum("n_chars").alias("n_chars")).withColumn("database", F.lit(name))


@_register("schema_report", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS dtype, count({c}) AS non_null FROM lineitem" for c, t in _LI_TYPES))
def q_schema_report(spark, sf):
    return io.schema_report(_t(spark, sf, "lineitem"))


@_register("write_splits", f"SELECT {split_sql('doc_id')} AS split, count(*) AS n_rows FROM documents GROUP BY 1")
def q_write_splits(spark, sf):
    docs = fr.hash_split(_t(spark, sf, "documents"), "doc_id")
    return io.write_splits(docs, scratch_path(spark, "doc-splits"))


# ================================================================ 2.2 frames
@_register("project", "SELECT p_partkey, p_name, p_size FROM part")
def q_project(spark, sf):
    return fr.project(_t(spark, sf, "part"), drop=["p_brand", "p_type", "p_retailprice"])


@_register("columns_with_prefix", f"SELECT doc_id, {descriptors_sql('text', 'calc_')} FROM documents")
def q_columns_with_prefix(spark, sf):
    feats = fpo.feature_batch(_t(spark, sf, "documents").select("doc_id", "text"), "text", partitions=_parts(spark))
    return fr.columns_with_prefix(feats, "calc_", keep=["doc_id"])


@_register("expand_struct", """SELECT p_partkey, p_name, p_brand, p_type, p_size AS calc_p_size,
  p_retailprice AS calc_p_retailprice, upper(p_brand) AS calc_brand_upper FROM part""")
def q_expand_struct(spark, sf):
    p = _t(spark, sf, "part")
    s = p.select("p_partkey", "p_name", "p_brand", "p_type",
                 F.struct("p_size", "p_retailprice", F.upper("p_brand").alias("brand_upper")).alias("d"))
    return fr.expand_struct(s, "d", prefix="calc_")


@_register("conditional_column", """SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice,
  CASE WHEN l_quantity > 45 THEN 1 ELSE 0 END AS is_bulk,
  CASE WHEN l_extendedprice > 50000 THEN 'high' ELSE 'low' END AS price_band FROM lineitem""")
def q_conditional_column(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    return fr.conditional_column(li, {"is_bulk": (F.col("l_quantity") > 45, 1, 0),
                                      "price_band": (F.col("l_extendedprice") > 50000, "high", "low")})


@_register("range_filter", "SELECT * FROM lineitem WHERE l_extendedprice >= 10000 AND l_extendedprice < 20000")
def q_range_filter(spark, sf):
    return fr.range_filter(_t(spark, sf, "lineitem"), "l_extendedprice", 10000, 20000)


@_register("short_string_filter", "SELECT doc_id, text, lang FROM documents WHERE length(text) < 50")
def q_short_string_filter(spark, sf):
    return fr.short_string_filter(_t(spark, sf, "documents").select("doc_id", "text", "lang"), "text", 50)


@_register("class_subset", "SELECT * FROM labels WHERE toxic = 1")
def q_class_subset(spark, sf):
    return fr.class_subset(_t(spark, sf, "labels"), "toxic", 1)


@_register("head_n", "SELECT * FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def q_head_n(spark, sf):
    return fr.head_n(_t(spark, sf, "orders"), 10, [F.desc("o_totalprice"), F.asc("o_orderkey")])


@_register("sample_rows", f"SELECT doc_id, lang FROM documents WHERE {unit_hash_sql('doc_id', 42)} < {d(0.2)}")
def q_sample_rows(spark, sf):
    return fr.hash_sample(_t(spark, sf, "documents").select("doc_id", "lang"), "doc_id", 0.2, seed=42)


@_register("fill_nulls", f"""SELECT p_partkey, p_name, p_brand, p_type, coalesce(p_size, 0) AS p_size,
  CASE WHEN p_retailprice IS NULL OR isnan(p_retailprice) THEN {d(0.0)} ELSE p_retailprice END AS p_retailprice
  FROM {PART_NULLS_SQL}""")
def q_fill_nulls(spark, sf):
    return fr.fill_nulls(_part_nulls(spark, sf), 0, ["p_size", "p_retailprice"])


@_register("bool_to_int", "SELECT doc_id, CAST(regexp_matches(text, '[0-9]') AS INTEGER) AS has_digit FROM documents")
def q_bool_to_int(spark, sf):
    docs = _t(spark, sf, "documents").select("doc_id", F.col("text").rlike("[0-9]").alias("has_digit"))
    return fr.bool_to_int(docs, "has_digit")


@_register("hash_split", f"SELECT doc_id, {split_sql('doc_id')} AS split FROM documents")
def q_hash_split(spark, sf):
    return fr.hash_split(_t(spark, sf, "documents").select("doc_id"), "doc_id")


# ================================================================ 2.3 quality
_LI_COLS = [c for c, _ in _LI_TYPES]
_FLOATS = {"l_quantity", "l_extendedprice", "l_discount", "l_tax"}


def _miss_sql(c):
    return f"({c} IS NULL OR isnan({c}))" if c in _FLOATS else f"{c} IS NULL"


@_register("missing_summary", "SELECT * FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST(count_if({_miss_sql(c)}) AS BIGINT) AS missing_count, "
    f"round(count_if({_miss_sql(c)}) * {d(100.0)} / count(*), 2) AS missing_pct FROM {LINEITEM_NULLS_SQL}"
    for c in _LI_COLS) + ") WHERE missing_count > 0")
def q_missing_summary(spark, sf):
    return qu.missing_summary(_lineitem_nulls(spark, sf))


_PART_COLS = ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"]


@_register("null_counts", "SELECT " + ", ".join(
    f"CAST(count_if({c} IS NULL) AS BIGINT) AS {c}" for c in _PART_COLS) + f" FROM {PART_NULLS_SQL}")
def q_null_counts(spark, sf):
    return qu.null_counts(_part_nulls(spark, sf))


@_register("valid_share", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, avg(CASE WHEN {c} IS NOT NULL THEN {d(1.0)} ELSE {d(0.0)} END) * {d(100.0)} "
    f"AS valid_pct FROM {PART_NULLS_SQL}" for c in _PART_COLS))
def q_valid_share(spark, sf):
    return qu.valid_share(_part_nulls(spark, sf))


@_register("duplicate_count", """SELECT CAST(sum(c) AS BIGINT) AS n_rows, count(*) AS n_distinct,
  CAST(sum(c - 1) AS BIGINT) AS n_duplicates FROM (SELECT text, count(*) AS c FROM documents GROUP BY text)""")
def q_duplicate_count(spark, sf):
    return qu.duplicate_count(_t(spark, sf, "documents"), ["text"])


def _range_sql(c, lo, hi):
    cond = f"{c} IS NOT NULL AND NOT isnan({c})"
    if lo is not None:
        cond += f" AND {c} >= {d(lo)}"
    if hi is not None:
        cond += f" AND {c} <= {d(hi)}"
    return cond


@_register("range_checks", " UNION ALL ".join(
    f"SELECT '{n}' AS check_name, CAST(count_if(NOT ({_range_sql(c, lo, hi)})) AS BIGINT) AS n_fail, "
    f"CASE WHEN count_if(NOT ({_range_sql(c, lo, hi)})) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM lineitem"
    for n, c, lo, hi in RANGE_CHECKS))
def q_range_checks(spark, sf):
    return qu.range_checks(_t(spark, sf, "lineitem"), RANGE_CHECKS)


_DOC_COLS = ["doc_id", "text", "lang", "source", "n_chars"]
_QR_MISSING = " + ".join(f"count_if({c} IS NULL)" for c in _DOC_COLS)


@_register("quality_report", f"""
WITH a AS (SELECT count(*) AS r, {_QR_MISSING} AS m, count_if(length(text) < 3) AS s,
  count_if(NOT (n_chars IS NOT NULL AND n_chars >= 1)) AS p FROM documents),
dup AS (SELECT CAST(sum(c - 1) AS BIGINT) AS v FROM (SELECT text, count(*) AS c FROM documents GROUP BY text))
SELECT 'rows' AS check_name, CAST(r AS BIGINT) AS value, CASE WHEN r > 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM a
UNION ALL SELECT 'missing_cells', CAST(m AS BIGINT), CASE WHEN m = 0 THEN 'PASS' ELSE 'FAIL' END FROM a
UNION ALL SELECT 'short_strings', CAST(s AS BIGINT), CASE WHEN s = 0 THEN 'PASS' ELSE 'FAIL' END FROM a
UNION ALL SELECT 'n_chars_positive', CAST(p AS BIGINT), CASE WHEN p = 0 THEN 'PASS' ELSE 'FAIL' END FROM a
UNION ALL SELECT 'duplicate_keys', v, CASE WHEN v = 0 THEN 'PASS' ELSE 'FAIL' END FROM dup""")
def q_quality_report(spark, sf):
    return qu.quality_report(_t(spark, sf, "documents"), ["text"], "text", 3,
                             [("n_chars_positive", "n_chars", 1, None)])


# ================================================================ 2.4 profile
@_register("describe_full", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
    f"min({c}) AS min, round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50, "
    f"round(quantile_cont({c}, 0.75), 6) AS p75, max({c}) AS max FROM lineitem" for c in DESC_COLS))
def q_describe_full(spark, sf):
    return pr.describe_full(_t(spark, sf, "lineitem"), DESC_COLS)


@_register("describe_basic", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS count, round(avg({c}), 6) AS mean, "
    f"round(stddev_samp({c}), 6) AS stddev, min({c}) AS min, max({c}) AS max FROM lineitem" for c in DESC_COLS))
def q_describe_basic(spark, sf):
    return pr.describe_basic(_t(spark, sf, "lineitem"), DESC_COLS)


@_register("value_counts", """SELECT o_orderpriority, count(*) AS count,
  count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM orders WHERE o_orderpriority IS NOT NULL) AS share
  FROM orders WHERE o_orderpriority IS NOT NULL GROUP BY o_orderpriority""")
def q_value_counts(spark, sf):
    return pr.value_counts(_t(spark, sf, "orders"), "o_orderpriority")


@_register("group_count", "SELECT l_returnflag, count(*) AS count FROM lineitem GROUP BY l_returnflag")
def q_group_count(spark, sf):
    return pr.group_count(_t(spark, sf, "lineitem"), "l_returnflag")


@_register("share_where", f"SELECT avg(CASE WHEN l_discount > 0.05 THEN {d(1.0)} ELSE {d(0.0)} END) * {d(100.0)} AS pct FROM lineitem")
def q_share_where(spark, sf):
    return pr.share_where(_t(spark, sf, "lineitem"), F.col("l_discount") > 0.05)


@_register("count_where", "SELECT CAST(count_if(toxic = 1) AS BIGINT) AS n_toxic, CAST(count_if(quality = 1) AS BIGINT) AS n_quality FROM labels")
def q_count_where(spark, sf):
    return pr.count_where(_t(spark, sf, "labels"), {"n_toxic": F.col("toxic") == 1,
                                                   "n_quality": F.col("quality") == 1})


@_register("mean_median", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(avg({c}), 6) AS mean, round(median({c}), 6) AS median FROM lineitem"
    for c in DESC_COLS))
def q_mean_median(spark, sf):
    return pr.mean_median(_t(spark, sf, "lineitem"), DESC_COLS)


def _hist_sql(table, col, bins):
    return f"""WITH s AS (SELECT min({col}) AS lo0, max({col}) AS hi0 FROM {table}),
e AS (SELECT CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo, CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM s),
b AS (SELECT least(CAST(floor(({col} - lo) * {bins} / (hi - lo)) AS INTEGER), {bins - 1}) AS bin FROM {table}, e WHERE {col} IS NOT NULL),
c AS (SELECT bin, count(*) AS n FROM b GROUP BY bin)
SELECT CAST(g.bin AS INTEGER) AS bin, lo + g.bin * (hi - lo) / {bins} AS bin_lo, lo + (g.bin + 1) * (hi - lo) / {bins} AS bin_hi,
  coalesce(c.n, 0) AS count FROM range({bins}) g(bin) CROSS JOIN e LEFT JOIN c ON c.bin = g.bin"""


@_register("histogram", _hist_sql("events", "value", 40))
def q_histogram(spark, sf):
    return pr.histogram(_t(spark, sf, "events"), "value", 40)


@_register("histogram_by_group", """WITH s AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem)
SELECT l_returnflag, least(CAST(floor((l_extendedprice - lo) * 30 / (hi - lo)) AS INTEGER), 29) AS bin, count(*) AS count
FROM lineitem, s WHERE l_extendedprice IS NOT NULL GROUP BY 1, 2""")
def q_histogram_by_group(spark, sf):
    return pr.histogram_by_group(_t(spark, sf, "lineitem"), "l_extendedprice", "l_returnflag", 30)


CORR_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_linenumber"]


@_register("correlation_matrix", " UNION ALL ".join(
    f"SELECT '{a}' AS col_a, '{b}' AS col_b, round(corr({a}, {b}), 6) AS r FROM lineitem"
    for i, a in enumerate(CORR_COLS) for b in CORR_COLS[i + 1:]))
def q_correlation_matrix(spark, sf):
    return pr.correlation_matrix(_t(spark, sf, "lineitem"), CORR_COLS)


@_register("class_balance", """SELECT toxic, count(*) AS count,
  count(*) / (SELECT CAST(count(*) AS DOUBLE) FROM labels WHERE toxic IS NOT NULL) AS share
  FROM labels WHERE toxic IS NOT NULL GROUP BY toxic""")
def q_class_balance(spark, sf):
    return pr.class_balance(_t(spark, sf, "labels"), "toxic")


# ================================================================ 2.5 rules
@_register("rule_flags", "SELECT l_orderkey, l_linenumber, " + ", ".join(n for n, _, _ in LINE_RULES)
           + f", n_violations, passes FROM {LINE_FLAGS_SQL}")
def q_rule_flags(spark, sf):
    return _line_flags(spark, sf).select("l_orderkey", "l_linenumber", *[n for n, _, _ in LINE_RULES],
                                         "n_violations", "passes")


@_register("rule_summary", f"""SELECT n_violations, count(*) AS n_rows, bool_and(passes) AS passes,
  count(*) * {d(100.0)} / (SELECT count(*) FROM lineitem) AS pct_rows FROM {LINE_FLAGS_SQL} GROUP BY n_violations""")
def q_rule_summary(spark, sf):
    return ru.rule_summary(_line_flags(spark, sf))


_LW_SQL = [(f"{c} {op} {d(v) if isinstance(v, float) else v}", w) for c, op, v, w in LINE_WEIGHTS]


@_register("weighted_rule_score", f"SELECT l_orderkey, l_linenumber, {weighted_score_sql(_LW_SQL)} FROM lineitem")
def q_weighted_rule_score(spark, sf):
    li = _t(spark, sf, "lineitem")
    out = ru.weighted_rule_score(li, [(_op(c, op, v), w) for c, op, v, w in LINE_WEIGHTS])
    return out.select("l_orderkey", "l_linenumber", "label", "score")


@_register("linear_score", f"SELECT l_orderkey, l_linenumber, {linear_score_sql(LINE_LINEAR, 0.5, (-8, 1), 'linear_score')} FROM lineitem")
def q_linear_score(spark, sf):
    out = ru.linear_score(_t(spark, sf, "lineitem"), LINE_LINEAR, 0.5, (-8, 1))
    return out.select("l_orderkey", "l_linenumber", "linear_score")


_BAND_SCORE_SQL = "least(greatest(" + f"{d(0.5)}" + "".join(
    f" + CASE WHEN {c} BETWEEN {d(lo)} AND {d(hi)} THEN {d(w)} ELSE {d(0.0)} END" for c, lo, hi, w in LINE_BONUSES) \
    + f", {d(0.0)}), {d(1.0)})"


@_register("banded_class", f"""SELECT l_orderkey, l_linenumber, band_score,
  CASE WHEN band_score > 0.7 THEN 'active' WHEN band_score > 0.4 THEN 'moderate' ELSE 'inactive' END AS band
  FROM (SELECT l_orderkey, l_linenumber, {_BAND_SCORE_SQL} AS band_score FROM lineitem)""")
def q_banded_class(spark, sf):
    out = ru.banded_class(_t(spark, sf, "lineitem"), 0.5, LINE_BONUSES, LINE_BANDS, "inactive")
    return out.select("l_orderkey", "l_linenumber", "band_score", "band")


@_register("string_descriptors", f"SELECT doc_id, {descriptors_sql('text')} FROM documents")
def q_string_descriptors(spark, sf):
    out = ru.text_descriptors(_t(spark, sf, "documents").select("doc_id", "text"), "text", partitions=_parts(spark))
    return out.select("doc_id", *DESCRIPTORS)


def _ads_sql(c, a, b, cc, dd, e, f, dmax, w):
    x = f"CAST({c} AS DOUBLE)"
    return (f"{d(w)} * ln(({d(a)} + {d(b)} / ({d(1.0)} + exp(-({x} - {d(cc)} + {d(dd / 2.0)}) / {d(e)})) * "
            f"({d(1.0)} - {d(1.0)} / ({d(1.0)} + exp(-({x} - {d(cc)} - {d(dd / 2.0)}) / {d(f)})))) / {d(dmax)})")


_DESIRE_SQL = (f"round(exp(({d(0.0)} + " + " + ".join(_ads_sql(*cv) for cv in LINE_CURVES)
               + f") / {d(sum(cv[-1] for cv in LINE_CURVES))}), 6)")


@_register("desirability_score", f"SELECT l_orderkey, l_linenumber, {_DESIRE_SQL} AS desirability FROM lineitem")
def q_desirability_score(spark, sf):
    out = ru.desirability_score(_t(spark, sf, "lineitem"), LINE_CURVES)
    return out.select("l_orderkey", "l_linenumber", F.round("desirability", 6).alias("desirability"))


@_register("candidate_screen", f"""SELECT l_orderkey, l_linenumber, band_score, linear_score FROM (
  SELECT l_orderkey, l_linenumber, {d(1.0)} - l_discount AS confidence,
    {linear_score_sql(LINE_LINEAR, 0.5, (-8, 1), 'linear_score')}, {_BAND_SCORE_SQL} AS band_score FROM lineitem)
  WHERE confidence >= 0.7 AND linear_score >= -3.0 AND band_score >= 0.6""")
def q_candidate_screen(spark, sf):
    li = _t(spark, sf, "lineitem").withColumn("confidence", F.lit(1.0) - F.col("l_discount"))
    li = ru.banded_class(ru.linear_score(li, LINE_LINEAR, 0.5, (-8, 1)), 0.5, LINE_BONUSES, LINE_BANDS, "inactive")
    out = ru.candidate_screen(li.withColumn("_k", F.struct("l_orderkey", "l_linenumber", "linear_score")),
                              "_k", "confidence", "linear_score", "band_score")
    return out.select("l_orderkey", "l_linenumber", "band_score", "linear_score")


# ================================================================ 2.6 strings, fingerprints
@_register("batch_featurize", f"SELECT doc_id, {descriptors_sql('text', 'calc_')}, text IS NULL AS featurize_error FROM documents")
def q_batch_featurize(spark, sf):
    out = fpo.batch_featurize(_t(spark, sf, "documents").select("doc_id", "text"), "text", partitions=_parts(spark))
    return out.drop("text")


@_register("batch_featurize_user", """SELECT doc_id, CAST(length(text) AS BIGINT) AS u_length, CAST(len(string_split(text, chr(10))) AS BIGINT) AS u_lines,
  CAST(len(regexp_extract_all(text, '[0-9]+')) AS BIGINT) AS u_numbers, text IS NULL AS featurize_error FROM documents""")
def q_batch_featurize_user(spark, sf):
    """A user's vectorised function, made once a task."""
    def setup():
        number = re.compile("[0-9]+")

        def features(s: pd.Series) -> pd.DataFrame:
            return pd.DataFrame({"length": s.str.len().astype("Int64"), "lines": (s.str.count("\n") + 1).astype("Int64"),
                                 "numbers": s.map(lambda t: len(number.findall(t)), na_action="ignore").astype("Int64")})
        return features

    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("length", "lines", "numbers")])
    docs = _t(spark, sf, "documents").select("doc_id", "text")
    return fpo.batch_featurize(docs, "text", schema=schema, setup=setup, prefix="u_", partitions=_parts(spark)).drop("text")


@_register("hashed_fingerprint", f"SELECT doc_id, bits FROM {_doc_fp_sql()}")
def q_hashed_fingerprint(spark, sf):
    return _doc_fp(spark, sf)


_PK_SQL = ", ".join(f"CAST(regexp_matches(text, '{p}') AS INTEGER)" for p in DOC_PATTERNS)


@_register("pattern_keys", f"SELECT doc_id, CASE WHEN text IS NULL THEN NULL ELSE [{_PK_SQL}] END AS keys FROM documents")
def q_pattern_keys(spark, sf):
    return _t(spark, sf, "documents").select("doc_id", pattern_keys("text", DOC_PATTERNS).alias("keys"))


@_register("similarity_column", f"""WITH f AS {_doc_fp_sql()}
SELECT a.doc_id AS doc_a, b.doc_id AS doc_b,
  CASE WHEN len(a.bits) + len(b.bits) - len(list_intersect(a.bits, b.bits)) = 0 THEN {d(0.0)}
       ELSE len(list_intersect(a.bits, b.bits)) / (len(a.bits) + len(b.bits) - len(list_intersect(a.bits, b.bits))) END AS tanimoto,
  CASE WHEN len(a.bits) + len(b.bits) = 0 THEN {d(0.0)}
       ELSE 2 * len(list_intersect(a.bits, b.bits)) / (len(a.bits) + len(b.bits)) END AS dice
FROM f a JOIN f b ON b.doc_id = a.doc_id + 1""")
def q_similarity_column(spark, sf):
    f = cut_lineage(_doc_fp(spark, sf), "fingerprints")  # both sides read it
    a = f.select(F.col("doc_id").alias("doc_a"), F.col("bits").alias("bits_a"))
    b = f.select(F.col("doc_id").alias("doc_b"), F.col("bits").alias("bits_b"))
    pairs = a.join(b, F.col("doc_b") == F.col("doc_a") + 1)
    return pairs.select("doc_a", "doc_b", similarity("bits_a", "bits_b", "tanimoto").alias("tanimoto"),
                        similarity("bits_a", "bits_b", "dice").alias("dice"))


@_register("similarity_join", f"""WITH f AS {_doc_fp_sql(None)},
g AS (SELECT min(doc_id) AS rep, count(*) AS copies, bits FROM f WHERE len(bits) > 0 GROUP BY bits),
p AS (SELECT a.rep AS id_a, b.rep AS id_b, len(list_intersect(a.bits, b.bits)) AS x, len(a.bits) AS na, len(b.bits) AS nb,
      a.copies AS copies_a, b.copies AS copies_b
      FROM g a JOIN g b ON a.rep < b.rep AND len(b.bits) >= {JOIN_THRESHOLD} * len(a.bits) - 1e-9
      AND len(a.bits) >= {JOIN_THRESHOLD} * len(b.bits) - 1e-9)
SELECT id_a, id_b, x / (na + nb - x) AS similarity, copies_a, copies_b FROM p WHERE x / (na + nb - x) >= {d(JOIN_THRESHOLD)}""")
def q_similarity_join(spark, sf):
    f = with_fingerprint(_t(spark, sf, "documents").select("doc_id", "text"), "text", "bits", FP_RADIUS, None, partitions=_parts(spark))
    return si.similarity_join(f, "doc_id", "bits", JOIN_THRESHOLD, source_col="text",
                              from_source=lambda text: hashed_fingerprint(tokens(text), FP_RADIUS, None))


@_register("copy_groups", f"""WITH f AS {_doc_fp_sql(None)},
g AS (SELECT bits, min(doc_id) AS rep_id, count(*) AS n_copies FROM f WHERE len(bits) > 0 GROUP BY bits)
SELECT f.doc_id, g.rep_id, g.n_copies FROM f JOIN g ON f.bits = g.bits""")
def q_copy_groups(spark, sf):
    return si.copy_groups(_doc_fp(spark, sf, None), "doc_id", "bits")


_SIGN_SQL = "(SELECT vec_id, label, list_filter(range(0, len(embedding)), lambda i: embedding[i + 1] > 0) AS bits FROM embeddings)"


@_register("similar_top_k", f"""WITH sb AS {_SIGN_SQL},
cnt AS (SELECT label, count(*) AS n FROM embeddings GROUP BY label),
pb AS (SELECT label, bit, count(*) AS c FROM (SELECT label, unnest(bits) AS bit FROM sb) GROUP BY label, bit),
cen AS (SELECT pb.label AS query_id, list_sort(list(bit)) AS qbits FROM pb JOIN cnt ON pb.label = cnt.label
        WHERE pb.c * 2 > cnt.n GROUP BY pb.label),
s AS (SELECT query_id, vec_id AS id, len(list_intersect(qbits, bits)) AS x, len(qbits) AS nq, len(bits) AS nc
      FROM cen JOIN sb ON true WHERE len(bits) > 0),
r AS (SELECT query_id, id, x / (nc + nq - x) AS similarity,
        row_number() OVER (PARTITION BY query_id ORDER BY x / (nc + nq - x) DESC, id) AS rank FROM s WHERE x > 0)
SELECT * FROM r WHERE rank <= 5""")
def q_similar_top_k(spark, sf):
    emb = _t(spark, sf, "embeddings").select("vec_id", "label", sign_bits("embedding").alias("bits"))
    protos = si.majority_bits(emb, "label", "bits", out="qbits")
    return si.similar_top_k(emb, protos, "vec_id", "bits", "label", "qbits", k=5)


_PATTERNS_SQL = (f"SELECT CAST(item_id AS VARCHAR) AS pattern_id, ({tokens_sql('text')})[1:3] AS pattern FROM benchmark WHERE len({tokens_sql('text')}) > 0"
                 + "".join(f" UNION ALL SELECT 'f{i}', {p!r}" for i, p in enumerate(TOKEN_PATTERNS)))


@_register("pattern_search", f"""WITH p AS ({_PATTERNS_SQL}),
d AS (SELECT doc_id, {tokens_sql('text')} AS toks FROM documents),
x AS (SELECT doc_id, toks, unnest(range(1, len(toks) + 1)) AS i FROM d)
SELECT doc_id, pattern_id, count(*) AS n_matches, list(CAST(range(i - 1, i - 1 + len(pattern)) AS INTEGER[]) ORDER BY i) AS matches
FROM x JOIN p ON toks[i] = pattern[1] AND toks[i:i + len(pattern) - 1] = pattern GROUP BY doc_id, pattern_id""")
def q_pattern_search(spark, sf):
    """Patterns from a table: the first three tokens of every benchmark item, and a few more."""
    items = _t(spark, sf, "benchmark").select(F.col("item_id").cast("string").alias("pattern_id"), F.slice(tokens("text"), 1, 3).alias("pattern")).where(F.size("pattern") > 0)
    more = fpo.pattern_frame(spark, TOKEN_PATTERNS).select(F.concat(F.lit("f"), F.col("pattern_id")).alias("pattern_id"), "pattern")
    return fpo.pattern_search(_t(spark, sf, "documents"), "doc_id", "text", items.unionByName(more), partitions=_parts(spark))


@_register("rarity_score", f"""WITH f AS (SELECT * FROM {_doc_fp_sql()} WHERE bits IS NOT NULL),
n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM f),
ex AS (SELECT doc_id, unnest(bits) AS bit FROM f),
df AS (SELECT bit, count(*) AS c FROM ex GROUP BY bit),
m AS (SELECT doc_id, avg(ln(n.n / df.c)) AS m FROM ex JOIN df ON ex.bit = df.bit CROSS JOIN n GROUP BY doc_id),
mm AS (SELECT min(m) AS lo, max(m) AS hi FROM m)
SELECT d.doc_id, round(CASE WHEN hi = lo THEN 1.0 ELSE 1.0 + 9.0 * (m.m - lo) / (hi - lo) END, 6) AS rarity
FROM documents d LEFT JOIN m ON d.doc_id = m.doc_id CROSS JOIN mm""")
def q_rarity_score(spark, sf):
    return fpo.rarity_score(_doc_fp(spark, sf), "doc_id", "bits", FP_BITS)


@_register("fingerprint_density", f"""SELECT count(*) AS n_rows, avg(len(bits)) AS mean_on_bits,
  {d(1.0)} - avg(len(bits)) / {d(FP_BITS)} AS sparsity FROM {_doc_fp_sql()} WHERE bits IS NOT NULL""")
def q_fingerprint_density(spark, sf):
    return fpo.fingerprint_density(_doc_fp(spark, sf), "bits", FP_BITS)


@_register("bit_usage", f"""WITH c AS (SELECT bit, count(*) AS n FROM (SELECT unnest(bits) AS bit FROM {_doc_fp_sql()}) GROUP BY bit)
SELECT CAST(g.bit AS INTEGER) AS bit, coalesce(c.n, 0) AS n_rows FROM range({FP_BITS}) g(bit) LEFT JOIN c ON c.bit = g.bit""")
def q_bit_usage(spark, sf):
    return fpo.bit_usage(_doc_fp(spark, sf), "bits", FP_BITS)


@_register("dense_fingerprint", f"""SELECT doc_id, CASE WHEN bits IS NULL THEN NULL ELSE
  list_transform(range(0, 64), lambda i: CAST(list_contains(bits, CAST(i AS INTEGER)) AS INTEGER)) END AS dense
  FROM {_doc_fp_sql(64)}""")
def q_dense_fingerprint(spark, sf):
    f = _doc_fp(spark, sf, 64)
    return f.select("doc_id", dense_fingerprint("bits", 64).alias("dense"))


_FB_FLAGS = [("short_text", "calc_n_chars < 50"), ("few_distinct", "calc_distinct_token_share < 0.3"),
             ("many_capitals", "calc_upper_share > 0.3"), ("much_punctuation", "calc_punct_share > 0.15")]
_FB_SUM = " + ".join(f"CASE WHEN {c} THEN 1 ELSE 0 END" for _, c in _FB_FLAGS)
_FEATURES_SQL = f"""(SELECT doc_id, {descriptors_sql('text', 'calc_')}, {fingerprint_sql('h', FP_RADIUS, FP_BITS)} AS bits
      FROM (SELECT doc_id, text, {token_hashes_sql(tokens_sql('text'))} AS h FROM documents))"""


@_register("feature_batch", f"""SELECT doc_id, {", ".join('calc_' + p for p in DESCRIPTORS)}, bits,
  {", ".join(f"CASE WHEN {c} THEN 1 ELSE 0 END AS {n}" for n, c in _FB_FLAGS)},
  CAST({_FB_SUM} AS INTEGER) AS n_violations, ({_FB_SUM}) <= 1 AS passes FROM {_FEATURES_SQL}""")
def q_feature_batch(spark, sf):
    out = fpo.feature_batch(_t(spark, sf, "documents").select("doc_id", "text"), "text", FP_RADIUS, FP_BITS, partitions=_parts(spark))
    return out.drop("text")


# ================================================================ 2.7 training
def _train_frame(spark, sf, all_documents=False):
    """documents + labels -> features, with a hash split (train/val/test)."""
    lab = _t(spark, sf, "labels").select("doc_id", "toxic")
    # two numbers a label: up to a size that is checked, they go to the texts, not the texts to them
    lab = si.bounded(lab)
    docs = _t(spark, sf, "documents").select("doc_id", "text").join(lab, "doc_id", "left" if all_documents else "inner")
    feats = fpo.feature_batch(docs, "text", FP_RADIUS, FP_BITS, partitions=_parts(spark))
    feats = fr.hash_split(feats, "doc_id")
    x = tr.assemble_features(feats, [f"calc_{p}" for p in DESCRIPTORS], "bits", FP_BITS, "toxic")
    # the feature table is read by fitting, scoring and evaluation: write it once
    return cut_lineage(x.select("doc_id", "split", "features", "label"), "features")


@_register("assemble_features", f"""SELECT f.doc_id, {split_sql('f.doc_id')} AS split, CAST(l.toxic AS DOUBLE) AS label,
  list_concat([{", ".join(f"coalesce(CAST(calc_{p} AS DOUBLE), {d(0)})" for p in DESCRIPTORS)}],
    list_transform(range(0, {FP_BITS}), lambda i: CAST(list_contains(coalesce(bits, CAST([] AS INTEGER[])), CAST(i AS INTEGER)) AS DOUBLE))) AS features
  FROM {_FEATURES_SQL} f JOIN labels l ON l.doc_id = f.doc_id""")
def q_assemble_features(spark, sf):
    x = _train_frame(spark, sf)
    return x.select("doc_id", "split", "label", vector_to_array("features").alias("features"))


@_register("class_weights", """SELECT toxic AS label, count(*) AS n_rows,
  (SELECT CAST(count(*) AS DOUBLE) FROM labels WHERE toxic IS NOT NULL) / (2.0 * count(*)) AS weight
  FROM labels WHERE toxic IS NOT NULL GROUP BY toxic""")
def q_class_weights(spark, sf):
    return tr.class_weights(_t(spark, sf, "labels"), "toxic")


def _fit_forest(spark, sf, num_trees=100, all_documents=False):
    x = _train_frame(spark, sf, all_documents)
    train = tr.with_class_weights(x.filter(F.col("split") == "train"), "label", classes=(0.0, 1.0))
    return x, tr.train_forest(train, weight_col="weight", num_trees=num_trees, max_depth=20,
                              min_instances_per_node=2, seed=42, written=True)


def _scores(scored):
    """The operators' whole result: no SQL can say what a model predicts."""
    return scored.select("doc_id", "split", "label", "prediction", "score")


@_register("train_forest")
def q_train_forest(spark, sf):
    x, model = _fit_forest(spark, sf)
    return _scores(tr.score_rows(model, x))


def _fit_boosted(spark, sf):
    x = _train_frame(spark, sf)
    pos_w = tr.positive_weight(x.filter(F.col("split") == "train"), "label")
    x = x.withColumn("weight", F.when(F.col("label") == 1.0, F.lit(pos_w)).otherwise(F.lit(1.0)))
    model = tr.train_boosted(x.filter(F.col("split") == "train"), weight_col="weight", max_iter=150,
                             max_depth=6, step_size=0.1, subsampling_rate=0.8, feature_subset="0.8", written=True)
    return x, model


@_register("train_boosted")
def q_train_boosted(spark, sf):
    x, model = _fit_boosted(spark, sf)
    return _scores(tr.score_rows(model, x))


@_register("score_rows")
def q_score_rows(spark, sf):
    x, model = _fit_forest(spark, sf, num_trees=50, all_documents=True)
    return _scores(tr.score_rows(model, x))


SEARCH_SPACE = {"numTrees": [50, 100, 150, 200], "maxDepth": [10, 15, 20, 25, 30],
                "minInstancesPerNode": [1, 2, 4], "featureSubsetStrategy": ["sqrt", "log2", "all"]}


def _searched(spark, sf):
    """All rows, the best setting's model fitted again, and the trials."""
    x = tr.with_class_weights(_train_frame(spark, sf), "label", classes=(0.0, 1.0))
    parallel = int(spark.conf.get("spark.sievekit.parallelFits", "4"))
    budget = tr.tree_memory_mb(spark, concurrent_fits=parallel)

    def build(p):
        # deep trees are grown whole; for the others node batches sized from the heap
        # shared by the concurrent fits, cached node ids: fewer passes over the data
        forest = tr.WholeTreeForest(seed=42, weightCol="weight", maxMemoryInMB=budget, cacheNodeIds=True, **p)
        forest.concurrent_fits = parallel
        return forest
    train, val = x.filter(F.col("split") == "train"), x.filter(F.col("split") == "val")
    parts, ledger = _parts(spark), rn.RunLog(spark, scratch_path(spark, "trials"))
    model, trials = tr.param_search(train, val, build, SEARCH_SPACE, n_trials=20, seed=42, parallelism=parallel,
                                    partitions=parts and max(1, parts // parallel),
                                    refit=cut_lineage(train.unionByName(val), "refit"), ledger=ledger, run_id=ledger.start_run("forest_search"))
    return x, model, trials


@_register("param_search")
def q_param_search(spark, sf):
    """Each trial, which is best, and the AUC on the test rows of the best
    setting's model (null for the others, which are not kept)."""
    x, model, trials = _searched(spark, sf)
    test_auc = ev.roc_auc(tr.score_rows(model, x.filter(F.col("split") == "test")), "label", "score").first()["auc"]
    best = F.row_number().over(Window.partitionBy().orderBy(F.desc_nulls_last("val_roc_auc"), "trial")) == 1  # 20 rows
    return trials.withColumn("best", best).withColumn("test_roc_auc", F.when(F.col("best"), F.lit(test_auc).cast("double")))


@_register("top_importances")
def q_top_importances(spark, sf):
    _, model = _fit_forest(spark, sf, num_trees=50)
    top = tr.top_importances(model, tr.feature_names([f"calc_{p}" for p in DESCRIPTORS], FP_BITS), 20)
    w = Window.partitionBy().orderBy(F.desc("importance"), "feature")  # 20 rows
    return top.select(F.row_number().over(w).alias("rank"), "feature", "importance")


_RUNS = [("weighted_rules", "prediction", "score"), ("linear_rules", "prediction_b", "score_b")]


def _metrics_sql(pred, score):
    return f"""(SELECT CASE WHEN n = 0 THEN 0.0 ELSE (tp + tn) / n END AS accuracy,
  CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS precision,
  CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS recall,
  CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1,
  (SELECT auc FROM {_auc_sql(score)}) AS roc_auc
FROM (SELECT CAST(count_if(label = 1 AND {pred} = 1) AS BIGINT) AS tp, CAST(count_if(label <> 1 AND {pred} = 1) AS BIGINT) AS fp,
  CAST(count_if(label = 1 AND {pred} <> 1) AS BIGINT) AS fn, CAST(count_if(label <> 1 AND {pred} <> 1) AS BIGINT) AS tn,
  count(*) AS n FROM {EVAL_SQL}))"""


def _auc_sql(score):
    return f"""(WITH s AS (SELECT CAST({score} AS DOUBLE) AS score, CAST(count_if(label = 1) AS BIGINT) AS pos,
    CAST(count_if(label <> 1) AS BIGINT) AS neg FROM {EVAL_SQL} WHERE {score} IS NOT NULL GROUP BY 1),
  c AS (SELECT *, sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS neg_cum FROM s)
  SELECT CASE WHEN sum(pos) = 0 OR sum(neg) = 0 THEN NULL
    ELSE CAST(sum(pos * ((neg_cum - neg) + neg / 2.0)) AS DOUBLE) / CAST(sum(pos) * sum(neg) AS DOUBLE) END AS auc FROM c)"""


def _run_rows_sql(name, pred, score):
    row = lambda kind, key, value, text: (f"SELECT '{name}' AS run_name, 'rule_models' AS parent_name, '{kind}' AS kind, "  # noqa: E731
                                          f"'{key}' AS key, {value} AS value, {text} AS text")
    return " UNION ALL ".join([
        row("run", "start", "CAST(NULL AS DOUBLE)", "CAST(NULL AS VARCHAR)"), row("param", "model", "CAST(NULL AS DOUBLE)", f"'{name}'"),
        row("param", "threshold", d(0.5), "CAST(NULL AS VARCHAR)"),
        *(row("metric", f"val_{k}", f"(SELECT round({k}, 9) FROM {_metrics_sql(pred, score)})", "CAST(NULL AS VARCHAR)") for k in _METRIC_KEYS)])


_METRIC_KEYS = ["accuracy", "precision", "recall", "f1", "roc_auc"]


@_register("run_log", " UNION ALL ".join(
    ["SELECT 'rule_models' AS run_name, CAST(NULL AS VARCHAR) AS parent_name, 'run' AS kind, 'start' AS key, CAST(NULL AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS text"]
    + [_run_rows_sql(*r) for r in _RUNS]))
def q_run_log(spark, sf):
    path = scratch_path(spark, "runs")
    log = rn.RunLog(spark, path)
    e = _eval_frame(spark, sf)
    parent = log.start_run("rule_models")
    for name, pred, score in _RUNS:
        rid = log.start_run(name, parent)
        again = rn.RunLog(spark, path)  # a run goes on from another handle by its id
        again.log_params(rid, {"model": name, "threshold": 0.5})
        again.log_metrics_frame(rid, ev.binary_metrics(e, "label", pred, score, prefix="val_"))
    rows = log.read()
    names = rows.where("kind = 'run'").select(F.col("run_id").alias("parent_id"), F.col("run_name").alias("parent_name"))
    return rows.join(names, "parent_id", "left").select("run_name", "parent_name", "kind", "key", F.round("value", 9).alias("value"), "text")


@_register("save_model")
def q_save_model(spark, sf):
    """Scores of the model as fitted and as loaded again."""
    x, model = _fit_forest(spark, sf, num_trees=20)
    path = scratch_path(spark, "model")
    tr.save_model(model, path, x.schema)
    before = tr.score_rows(model, x).select("doc_id", F.col("score").alias("before"))
    after = tr.score_rows(tr.load_model(path, x), x).select("doc_id", "label", "prediction", "score")
    return after.join(before, "doc_id").withColumn("same_score", F.col("score") == F.col("before")).drop("before")


@_register("compare_models", f"""SELECT 'weighted_rules' AS run_name, * FROM {_metrics_sql('prediction', 'score')}
UNION ALL SELECT 'linear_rules', * FROM {_metrics_sql('prediction_b', 'score_b')}""")
def q_compare_models(spark, sf):
    e = _eval_frame(spark, sf)
    long = rn.metrics_long(ev.binary_metrics(e, "label", "prediction", "score"), "weighted_rules", "val") \
        .unionByName(rn.metrics_long(ev.binary_metrics(e, "label", "prediction_b", "score_b"), "linear_rules", "val"))
    return rn.compare_models(long, _METRIC_KEYS, split="val")


# ================================================================ 2.8 evaluation
@_register("binary_metrics", f"SELECT * FROM {_metrics_sql('prediction', 'score')}")
def q_binary_metrics(spark, sf):
    return ev.binary_metrics(_eval_frame(spark, sf), "label", "prediction", "score")


@_register("roc_auc", f"SELECT auc FROM {_auc_sql('score_b')}")
def q_roc_auc(spark, sf):
    return ev.roc_auc(_eval_frame(spark, sf), "label", "score_b")


@_register("roc_curve", f"""WITH s AS (SELECT CAST(score_b AS DOUBLE) AS score, count_if(label = 1) AS pos, count_if(label <> 1) AS neg
  FROM {EVAL_SQL} WHERE score_b IS NOT NULL GROUP BY 1),
t AS (SELECT CAST(sum(pos) AS DOUBLE) AS p, CAST(sum(neg) AS DOUBLE) AS n FROM s),
c AS (SELECT score, sum(pos) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS pc,
  sum(neg) OVER (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS nc FROM s)
SELECT 'infinity'::DOUBLE AS threshold, {d(0.0)} AS fpr, {d(0.0)} AS tpr
UNION ALL SELECT score, CASE WHEN n = 0 THEN 0.0 ELSE nc / n END, CASE WHEN p = 0 THEN 0.0 ELSE pc / p END FROM c, t""")
def q_roc_curve(spark, sf):
    return ev.roc_curve(_eval_frame(spark, sf), "label", "score_b")


@_register("confusion_matrix", f"""SELECT CAST(g.l AS INTEGER) AS label, CAST(g.p AS INTEGER) AS prediction,
  count(e.ll) AS count FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) g(l, p)
  LEFT JOIN (SELECT CASE WHEN label = 1 THEN 1 ELSE 0 END AS ll, CASE WHEN prediction = 1 THEN 1 ELSE 0 END AS pp
             FROM {EVAL_SQL}) e ON e.ll = g.l AND e.pp = g.p GROUP BY 1, 2""")
def q_confusion_matrix(spark, sf):
    return ev.confusion_matrix(_eval_frame(spark, sf), "label", "prediction")


@_register("classification_report", f"""WITH c AS (SELECT CAST(count_if(label = 1 AND prediction = 1) AS BIGINT) AS tp,
  CAST(count_if(label <> 1 AND prediction = 1) AS BIGINT) AS fp, CAST(count_if(label = 1 AND prediction <> 1) AS BIGINT) AS fn,
  CAST(count_if(label <> 1 AND prediction <> 1) AS BIGINT) AS tn, count(*) AS n FROM {EVAL_SQL}),
m AS (SELECT CASE WHEN tn + fn = 0 THEN 0.0 ELSE tn / (tn + fn) END AS p0, CASE WHEN tn + fp = 0 THEN 0.0 ELSE tn / (tn + fp) END AS r0,
  CASE WHEN 2 * tn + fn + fp = 0 THEN 0.0 ELSE 2 * tn / (2 * tn + fn + fp) END AS f0, tn + fp AS s0,
  CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END AS p1, CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END AS r1,
  CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END AS f1, tp + fn AS s1,
  CASE WHEN n = 0 THEN 0.0 ELSE (tp + tn) / n END AS acc, n FROM c)
SELECT '0' AS row_name, p0 AS precision, r0 AS recall, f0 AS f1, s0 AS support FROM m
UNION ALL SELECT '1', p1, r1, f1, s1 FROM m
UNION ALL SELECT 'accuracy', NULL, NULL, acc, n FROM m
UNION ALL SELECT 'macro avg', (p0 + p1) / 2.0, (r0 + r1) / 2.0, (f0 + f1) / 2.0, n FROM m
UNION ALL SELECT 'weighted avg', CASE WHEN n = 0 THEN 0.0 ELSE (p0 * s0 + p1 * s1) / n END,
  CASE WHEN n = 0 THEN 0.0 ELSE (r0 * s0 + r1 * s1) / n END, CASE WHEN n = 0 THEN 0.0 ELSE (f0 * s0 + f1 * s1) / n END, n FROM m""")
def q_classification_report(spark, sf):
    return ev.classification_report(_eval_frame(spark, sf), "label", "prediction")


@_register("score_histogram", f"""WITH e AS {EVAL_SQL}, s AS (SELECT min(score_b) AS lo0, max(score_b) AS hi0 FROM e),
b AS (SELECT CASE WHEN lo0 = hi0 THEN lo0 - 0.5 ELSE lo0 END AS lo, CASE WHEN lo0 = hi0 THEN hi0 + 0.5 ELSE hi0 END AS hi FROM s)
SELECT label, least(CAST(floor((score_b - lo) * 50 / (hi - lo)) AS INTEGER), 49) AS bin, count(*) AS count
FROM e, b WHERE score_b IS NOT NULL GROUP BY 1, 2""")
def q_score_histogram(spark, sf):
    return ev.score_histogram(_eval_frame(spark, sf), "label", "score_b", 50)


# ================================================================ contract
def entry(spark: SparkSession) -> DataFrame:
    """Flagship: rule flags over lineitem summarised per violation count."""
    ensure_checkpoint_dir(spark)
    return q_rule_summary(spark, SMOKE_DIR)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {**_Q, **_LLM[0]}


def oracle_sql() -> dict[str, str]:
    return {**_SQL, **_LLM[1]}


def _optional() -> tuple[dict, dict]:
    """Queries and SQL of the ``llm`` subpackage, which may be absent, or lack a package it needs."""
    try:
        from sievekit.llm.queries import ORACLES, QUERIES
    except ImportError as e:
        warnings.warn(f"without the queries of sievekit.llm: {e}", stacklevel=2)
        return {}, {}
    return QUERIES, ORACLES


_LLM = _optional()
