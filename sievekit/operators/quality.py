"""Data-quality checks.  Each check is one aggregate pass; results are long
tables so that many checks can be unioned into one report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _is_float(df: DataFrame, c: str) -> bool:
    return isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType))


def _missing(df: DataFrame, c: str) -> Column:
    x = F.col(c)
    return x.isNull() | F.isnan(x) if _is_float(df, c) else x.isNull()


def _long(one_row: DataFrame, names: Sequence[str], value_col: str,
          key_col: str = "column_name", ids: Sequence[str] = ()) -> DataFrame:
    """One wide row -> (key_col, value_col) rows (``ids`` carried along)."""
    return one_row.unpivot(list(ids), list(names), key_col, value_col)


def missing_summary(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column: missing count (null, or NaN in float columns) and share
    in percent rounded to 2; only columns with something missing."""
    cols = list(cols or df.columns)
    wide = df.agg(F.count(F.lit(1)).alias("_n"),
                  *[F.count_if(_missing(df, c)).alias(c) for c in cols])
    long = _long(wide, cols, "missing_count", ids=["_n"])
    return (long.filter(F.col("missing_count") > 0)
            .select("column_name", "missing_count",
                    F.round(F.col("missing_count") * 100.0 / F.col("_n"), 2).alias("missing_pct")))


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One wide row: null count per column (same names as the inputs)."""
    cols = list(cols or df.columns)
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])


def valid_share(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Per column: percent of non-null values over the same table's rows."""
    cols = list(cols or df.columns)
    wide = df.agg(*[(F.avg(F.col(c).isNotNull().cast("double")) * 100.0).alias(c) for c in cols])
    return _long(wide, cols, "valid_pct")


def key_digest(keys: Sequence[str], salt: int) -> Column:
    """64 bits of a key; which columns are null is part of it, as a hash skips nulls."""
    nulls = sum((F.col(k).isNull().cast("int") * (1 << i % 31) for i, k in enumerate(keys)), F.lit(0))
    return F.xxhash64(F.lit(salt), nulls, *keys)


def duplicate_count(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows after the first of each key (nulls equal each other); 0 of an empty
    table.

    Keys are grouped by 128-bit digests, so that long texts never move.  A third
    digest must agree within each group; a collision of the first two is an
    error, not a wrong count.  The group-by runs with map-side partial counts,
    so a key holding a third of all rows is pre-aggregated before the shuffle."""
    third = key_digest(keys, 3)
    per_key = df.groupBy(key_digest(keys, 1).alias("_a"), key_digest(keys, 2).alias("_b")).agg(
        F.count(F.lit(1)).alias("_c"), F.min(third).alias("_lo"), F.max(third).alias("_hi"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("bigint")
    counts = per_key.agg(total(F.col("_c")).alias("n_rows"), F.count(F.lit(1)).cast("bigint").alias("n_distinct"),
                         total(F.col("_c") - 1).alias("n_duplicates"), F.count_if(F.col("_lo") != F.col("_hi")).alias("_met"))
    sound = F.when(F.col("_met") > 0, F.raise_error(F.lit("two keys share a 128-bit digest")).cast("bigint"))
    return counts.select("n_rows", "n_distinct", F.coalesce(sound, F.col("n_duplicates")).alias("n_duplicates"))


def _nan_safe(df: DataFrame, c: str) -> Column:
    return F.nanvl(F.col(c), F.lit(None)) if _is_float(df, c) else F.col(c)


def _in_range(df: DataFrame, c: str, lo, hi) -> Column:
    """``lo <= c <= hi`` (bound None = open); false for null and NaN."""
    x = _nan_safe(df, c)
    ok = x.isNotNull()
    if lo is not None:
        ok = ok & (x >= F.lit(lo))
    if hi is not None:
        ok = ok & (x <= F.lit(hi))
    return ok


def range_checks(df: DataFrame, checks: Sequence[tuple[str, str, object, object]]) -> DataFrame:
    """Named closed-range checks ``(name, column, lo, hi)`` (bound None =
    open).  A row fails if its value is null, NaN or outside the range.
    Result rows: ``check_name, n_fail, status`` (PASS when nothing fails)."""
    aggs = [F.count_if(~_in_range(df, c, lo, hi)).alias(name) for name, c, lo, hi in checks]
    names = [c[0] for c in checks]
    long = _long(df.agg(*aggs), names, "n_fail", "check_name")
    return long.withColumn("status", F.when(F.col("n_fail") == 0, "PASS").otherwise("FAIL"))


def quality_report(df: DataFrame, key_cols: Sequence[str], text_col: str | None = None,
                   min_len: int = 3,
                   checks: Sequence[tuple[str, str, object, object]] = ()) -> DataFrame:
    """One long table ``(check_name, value, status)`` from the real check
    results: rows, missing cells, duplicate keys, short strings, range
    checks.  Statuses are computed, never literal."""
    cols = list(df.columns)
    aggs = [F.count(F.lit(1)).alias("rows"),
            sum((F.count_if(_missing(df, c)) for c in cols), F.lit(0)).alias("missing_cells")]
    if text_col is not None:
        aggs.append(F.count_if(F.length(F.col(text_col)) < F.lit(min_len)).alias("short_strings"))
    aggs += [F.count_if(~_in_range(df, c, lo, hi)).alias(name) for name, c, lo, hi in checks]
    wide = df.agg(*aggs)
    names = ["rows", "missing_cells"] + (["short_strings"] if text_col else []) + [c[0] for c in checks]
    wide = wide.select(*[F.col(n).cast("bigint").alias(n) for n in names])
    dup = duplicate_count(df, key_cols).select(F.lit("duplicate_keys").alias("check_name"),
                                               F.col("n_duplicates").alias("value"))
    long = _long(wide, names, "value", "check_name").unionByName(dup)
    return long.withColumn(
        "status",
        F.when(F.col("check_name") == "rows", F.when(F.col("value") > 0, "PASS").otherwise("FAIL"))
         .otherwise(F.when(F.col("value") == 0, "PASS").otherwise("FAIL")))
