"""Projections, filters, sampling and splitting.

All of these are narrow transformations (no shuffle) except ``head_n``
with an ordering, which Spark plans as a per-partition top-k
(TakeOrderedAndProject) merged on one task: its state is bounded by ``n``."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _cols(df: DataFrame, cols: Iterable[str] | None) -> list[str]:
    return list(df.columns) if cols is None else list(cols)


def project(df: DataFrame, cols: Sequence[str] | None = None,
            drop: Sequence[str] = ()) -> DataFrame:
    """Keep ``cols`` (all if None), then drop ``drop``."""
    out = df.select(*cols) if cols is not None else df
    return out.drop(*drop) if drop else out


def columns_with_prefix(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns plus every column whose name starts with ``prefix``."""
    picked = [c for c in df.columns if c.startswith(prefix) and c not in keep]
    return df.select(*keep, *picked)


def expand_struct(df: DataFrame, struct_col: str, prefix: str = "calc_",
                  drop: bool = True) -> DataFrame:
    """Flatten a struct column into ``<prefix><field>`` columns in one
    projection (the struct expression is evaluated once)."""
    fields = df.schema[struct_col].dataType.fieldNames()
    base = [c for c in df.columns if not (drop and c == struct_col)]
    return df.select(*base, *[F.col(f"{struct_col}.{f}").alias(f"{prefix}{f}")
                              for f in fields])


def conditional_column(df: DataFrame,
                       specs: Mapping[str, tuple[Column, object, object]]) -> DataFrame:
    """Add ``name = when(cond, a).otherwise(b)`` for each spec, in one
    projection.  A null condition takes the ``otherwise`` branch."""
    return df.withColumns({
        name: F.when(cond, a if isinstance(a, Column) else F.lit(a))
               .otherwise(b if isinstance(b, Column) else F.lit(b))
        for name, (cond, a, b) in specs.items()
    })


def range_filter(df: DataFrame, col: str, lo=None, hi=None) -> DataFrame:
    """Rows with ``lo <= col < hi`` (either bound optional); pushed to the scan."""
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (F.col(col) >= F.lit(lo))
    if hi is not None:
        cond = cond & (F.col(col) < F.lit(hi))
    return df.filter(cond)


def short_string_filter(df: DataFrame, col: str, max_len: int) -> DataFrame:
    """Rows whose string is shorter than ``max_len`` characters; null excluded."""
    return df.filter(F.length(F.col(col)) < F.lit(max_len))


def class_subset(df: DataFrame, label_col: str, value) -> DataFrame:
    return df.filter(F.col(label_col) == F.lit(value))


def head_n(df: DataFrame, n: int, order_by: Sequence[str | Column] | None = None) -> DataFrame:
    """First ``n`` rows; with ``order_by`` the result is deterministic
    (per-partition top-n, then merge)."""
    if order_by:
        return df.orderBy(*order_by).limit(n)
    return df.limit(n)


def sample_rows(df: DataFrame, fraction: float, seed: int = 42) -> DataFrame:
    """Bernoulli sample for quick looks.  Depends on partitioning; use
    ``hash_sample`` where the same rows must come back every time."""
    return df.sample(withReplacement=False, fraction=fraction, seed=seed)


def unit_hash(key: Column, seed: int) -> Column:
    """Portable uniform draw in [0, 1) from a key: first 32 bits of
    ``md5('<seed>:<key>')``.  Same value in Spark and DuckDB and under any
    partitioning."""
    h = F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string"))), 1, 8), 16, 10)
    return h.cast("bigint") / F.lit(4294967296.0)


def hash_sample(df: DataFrame, key: str, fraction: float, seed: int = 42) -> DataFrame:
    """Stable sample: rows whose key hashes below ``fraction``."""
    return df.filter(unit_hash(F.col(key), seed) < F.lit(fraction))


def split_cuts(fractions: Sequence[float]) -> list[float]:
    """Cumulative cut points of the split fractions (last one open)."""
    total = float(sum(fractions))
    if total <= 0:
        raise ValueError("fractions must sum to a positive number")
    cuts, acc = [], 0.0
    for f in fractions[:-1]:
        acc += f / total
        cuts.append(acc)
    return cuts


def hash_split(df: DataFrame, key: str, fractions: Sequence[float] = (0.7, 0.15, 0.15),
               names: Sequence[str] = ("train", "val", "test"), seed: int = 42,
               split_col: str = "split") -> DataFrame:
    """Add a ``split`` column: train / val / test by a hash of ``key``.

    Unlike ``rand(seed)`` the assignment does not depend on the number or
    order of partitions, so a recomputed partition (lost executor) lands
    every row in the same split again."""
    if len(fractions) != len(names):
        raise ValueError("one name per fraction")
    u = unit_hash(F.col(key), seed)
    expr = None
    for cut, name in zip(split_cuts(fractions), names):
        expr = F.when(u < F.lit(cut), F.lit(name)) if expr is None \
            else expr.when(u < F.lit(cut), F.lit(name))
    last = F.lit(names[-1])
    return df.withColumn(split_col, last if expr is None else expr.otherwise(last))


def fill_nulls(df: DataFrame, value=0, subset: Sequence[str] | None = None) -> DataFrame:
    """Replace nulls (and NaN in float columns) by ``value`` in ``subset``."""
    cols = _cols(df, subset)
    types = dict(df.dtypes)
    repl = {}
    for c in cols:
        x = F.col(c)
        if types[c] in ("double", "float"):
            x = F.nanvl(x, F.lit(None))
        repl[c] = F.coalesce(x, F.lit(value).cast(types[c]))
    return df.withColumns(repl)


def nan_to_null(df: DataFrame, subset: Sequence[str] | None = None) -> DataFrame:
    """NaN becomes null, so comparisons follow SQL null logic (in Spark
    ``NaN > x`` is true for every x)."""
    floats = {f.name for f in df.schema.fields
              if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    cols = [c for c in _cols(df, subset) if c in floats]
    return df.withColumns({c: F.nanvl(F.col(c), F.lit(None)) for c in cols}) if cols else df


def bool_to_int(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    return df.withColumn(out or col, F.col(col).cast("int"))
