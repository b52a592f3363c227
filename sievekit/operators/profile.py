"""Aggregation and profiling.  One aggregate pass per report; results in
long form ``(column_name, stat...)`` so reports over hundreds of columns
stay narrow.  A scalar used once (a share denominator) is a scalar
subquery; scalars used in several expressions (histogram edges) are
fetched once as a one-row aggregate, never joined."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..plans.quantiles import exact_quantiles_many
from ..session import cut_lineage

QUANTILES = (0.25, 0.5, 0.75)


def _num(df: DataFrame, c: str) -> Column:
    """Numeric value as double with NaN as null (pandas skips NaN)."""
    x = F.col(c).cast("double")
    if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        x = F.nanvl(x, F.lit(None))
    return x


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def describe_full(df: DataFrame, cols: Sequence[str] | None = None, exact: bool = True,
                  accuracy: int = 10_000, digits: int = 6) -> DataFrame:
    """count, mean, sample std, min, 25/50/75 % (linear interpolation),
    max per numeric column.

    ``exact=True``: quantiles from ``plans.quantiles`` (three narrow scans for
    all columns together; only values near the wanted ranks are grouped).
    ``exact=False``:
    ``percentile_approx`` in the same single aggregate pass."""
    cols = list(cols or numeric_columns(df))
    aggs = []
    for c in cols:
        x = _num(df, c)
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
        if not exact:
            aggs.append(F.percentile_approx(x, list(QUANTILES), accuracy).alias(f"{c}__q"))
    wide = df.agg(*aggs)

    def q(c, i):
        if not exact:
            return F.col(f"{c}__q")[i].cast("double")
        return F.lit(quants[c][i]).cast("double")

    quants = exact_quantiles_many(df, {c: _num(df, c) for c in cols}, QUANTILES) if exact else {}
    rows = [F.struct(F.lit(c).alias("column_name"),
                     F.col(f"{c}__count").cast("bigint").alias("count"),
                     F.round(F.col(f"{c}__mean"), digits).alias("mean"),
                     F.round(F.col(f"{c}__std"), digits).alias("std"),
                     F.col(f"{c}__min").alias("min"),
                     F.round(q(c, 0), digits).alias("p25"),
                     F.round(q(c, 1), digits).alias("p50"),
                     F.round(q(c, 2), digits).alias("p75"),
                     F.col(f"{c}__max").alias("max")) for c in cols]
    return wide.select(F.inline(F.array(*rows)))


def describe_basic(df: DataFrame, cols: Sequence[str] | None = None, digits: int = 6) -> DataFrame:
    """count, mean, sample stddev, min, max per column, numeric (Spark's
    ``describe`` returns strings)."""
    cols = list(cols or numeric_columns(df))
    aggs = []
    for c in cols:
        x = _num(df, c)
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"),
                 F.max(x).alias(f"{c}__max")]
    wide = df.agg(*aggs)
    rows = [F.struct(F.lit(c).alias("column_name"),
                     F.col(f"{c}__count").cast("bigint").alias("count"),
                     F.round(F.col(f"{c}__mean"), digits).alias("mean"),
                     F.round(F.col(f"{c}__std"), digits).alias("stddev"),
                     F.col(f"{c}__min").alias("min"),
                     F.col(f"{c}__max").alias("max")) for c in cols]
    return wide.select(F.inline(F.array(*rows)))


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Rows per value (nulls dropped) and share of the non-null total."""
    counts = df.filter(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    counts = cut_lineage(counts, "value-counts")  # one scan of the table; the total is taken from the counts
    total = counts.select(F.sum("count").cast("double")).scalar()
    return (counts.withColumn("share", F.col("count") / total)
            .orderBy(F.desc("count"), F.col(col)))


def group_count(df: DataFrame, col: str) -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias("count")).orderBy(col)


def share_where(df: DataFrame, cond: Column, name: str = "pct") -> DataFrame:
    """Percent of rows for which ``cond`` is true (null counts as false),
    one scan."""
    return df.agg((F.avg(F.coalesce(cond, F.lit(False)).cast("double")) * 100.0).alias(name))


def count_where(df: DataFrame, conds: Mapping[str, Column]) -> DataFrame:
    """One row: number of rows satisfying each named condition."""
    return df.agg(*[F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in conds.items()])


def mean_median(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """Mean and exact median per column (median via ``exact_quantiles``)."""
    wide = df.agg(*[F.avg(_num(df, c)).alias(f"{c}__mean") for c in cols])
    med = {c: v[0] for c, v in exact_quantiles_many(df, {c: _num(df, c) for c in cols}, [0.5]).items()}
    rows = [F.struct(F.lit(c).alias("column_name"),
                     F.round(F.col(f"{c}__mean"), digits).alias("mean"),
                     F.round(F.lit(med[c]).cast("double"), digits).alias("median")) for c in cols]
    return wide.select(F.inline(F.array(*rows)))


def histogram_edges(df: DataFrame, col: str) -> tuple[Column, Column]:
    """``(lo, hi)`` literals: min and max (one aggregate job, two numbers to
    the driver), widened by 0.5 on each side when equal (numpy's rule).
    Literals rather than scalar subqueries: the edges appear in several
    expressions and each subquery occurrence may rescan the input."""
    x = _num(df, col)
    r = df.agg(F.min(x).alias("lo"), F.max(x).alias("hi")).first()
    lo, hi = r["lo"], r["hi"]
    if lo is None:
        lo, hi = 0.0, 1.0
    elif lo == hi:
        lo, hi = lo - 0.5, hi + 0.5
    return F.lit(float(lo)), F.lit(float(hi))


def bin_index(x: Column, lo: Column, hi: Column, bins: int) -> Column:
    """Equal-width bin in [0, bins); the last bin is closed on the right."""
    return F.least(F.floor((x - lo) * F.lit(bins) / (hi - lo)).cast("int"), F.lit(bins - 1))


def histogram(df: DataFrame, col: str, bins: int = 50) -> DataFrame:
    """Equal-width histogram from min to max, empty bins included:
    ``(bin, bin_lo, bin_hi, count)``."""
    lo, hi = histogram_edges(df, col)
    x = _num(df, col)
    counts = (df.select(x.alias("_x")).filter(F.col("_x").isNotNull())
              .groupBy(bin_index(F.col("_x"), lo, hi, bins).alias("bin"))
              .agg(F.count(F.lit(1)).alias("count")))
    grid = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    # both sides have at most ``bins`` rows
    return (grid.join(F.broadcast(counts), "bin", "left")
            .select("bin",
                    (lo + F.col("bin") * (hi - lo) / F.lit(bins)).alias("bin_lo"),
                    (lo + (F.col("bin") + 1) * (hi - lo) / F.lit(bins)).alias("bin_hi"),
                    F.coalesce(F.col("count"), F.lit(0)).cast("bigint").alias("count")))


def histogram_by_group(df: DataFrame, col: str, group_col: str, bins: int = 30) -> DataFrame:
    """Counts per (group, bin) on edges computed from all rows; cells with
    no rows are omitted."""
    lo, hi = histogram_edges(df, col)
    x = _num(df, col)
    return (df.select(F.col(group_col), x.alias("_x")).filter(F.col("_x").isNotNull())
            .groupBy(group_col, bin_index(F.col("_x"), lo, hi, bins).alias("bin"))
            .agg(F.count(F.lit(1)).alias("count")))


def correlation_matrix(df: DataFrame, cols: Sequence[str], digits: int = 6) -> DataFrame:
    """Pearson r for each pair ``a < b`` (in the given column order),
    pairwise complete; one aggregate pass."""
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    wide = df.agg(*[F.corr(_num(df, a), _num(df, b)).alias(f"{a}__{b}") for a, b in pairs])
    rows = [F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"),
                     F.round(F.col(f"{a}__{b}"), digits).alias("r")) for a, b in pairs]
    return wide.select(F.inline(F.array(*rows)))


def class_balance(df: DataFrame, label_col: str) -> DataFrame:
    """Rows per class and share of all labelled rows."""
    return value_counts(df, label_col)
