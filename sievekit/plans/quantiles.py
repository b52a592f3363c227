"""Exact quantiles in three narrow scans, without a one-task value map.

``percentile`` keeps a value -> count map and merges all of it in one final
task; for a global quantile over billions of distinct doubles that task does
not fit.  Here one aggregate pass brackets each wanted rank by
``percentile_approx``, a second counts the values below each bracket, and a
third groups only the values inside the brackets, a tiny share of the table.
Linear interpolation between the neighbouring order statistics, as pandas
and ``quantile_cont``."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage
from .cumulative import DEFAULT_ROWS_PER_BUCKET, running_totals

#: Grouped values that the driver looks through; more are ranked by running totals.
MOST_VALUES = 100_000


def exact_quantiles(df: DataFrame, value: Column, probs: Sequence[float], **options) -> list[float | None]:
    """Quantiles of the non-null values of ``value`` (a column expression)."""
    return exact_quantiles_many(df, {"v": value}, probs, **options)["v"]


def exact_quantiles_many(df: DataFrame, values: dict[str, Column], probs: Sequence[float], accuracy: int = 10_000,
                         most_values: int = MOST_VALUES, rows_per_bucket: int = DEFAULT_ROWS_PER_BUCKET) -> dict[str, list[float | None]]:
    """``exact_quantiles`` of several columns at once.  Nothing is unpivoted or
    shuffled but the values inside the brackets; a bracket that misses its rank
    is widened and counted again."""
    names = list(values)
    rows = df.select(*[values[k].cast("double").alias(f"c{i}") for i, k in enumerate(names)])
    width = 4.0 / accuracy
    marks = [min(1.0, max(0.0, p + s * width)) for p in probs for s in (-1, 1)]
    first = rows.agg(*[f for i in range(len(names)) for f in (
        F.count(f"c{i}").alias(f"n{i}"), F.percentile_approx(f"c{i}", marks, accuracy).alias(f"q{i}"))]).first()
    # (column, probability, position, bracket)
    wanted = [(i, j, (first[f"n{i}"] - 1) * p, first[f"q{i}"][2 * j:2 * j + 2])
              for i in range(len(names)) for j, p in enumerate(probs) if first[f"n{i}"]]
    known, todo = {}, [(i, j, h, *b) for i, j, h, b in wanted]
    while todo:
        todo = _resolve(rows, todo, known, most_values, rows_per_bucket)
    out: dict[str, list[float | None]] = {k: [None for _ in probs] for k in names}
    for i, j, h, _ in wanted:
        lo, hi = known[i, j, math.floor(h)], known[i, j, math.ceil(h)]
        out[names[i]][j] = lo if lo == hi else lo + (hi - lo) * (h - math.floor(h))
    return out


def _resolve(rows: DataFrame, todo: list, known: dict, most_values: int, rows_per_bucket: int) -> list:
    """Values at the wanted ranks whose brackets hold them; the other brackets, widened."""
    aggs = []
    for t, (i, _, _, lo, hi) in enumerate(todo):
        c = F.col(f"c{i}")
        aggs += [F.count_if(c < F.lit(lo)).alias(f"below{t}"), F.count_if(c <= F.lit(hi)).alias(f"upto{t}"),
                 F.max(F.when(c < F.lit(lo), c)).alias(f"before{t}"), F.min(F.when(c > F.lit(hi), c)).alias(f"after{t}")]
    counts = rows.agg(*aggs).first()
    inside, again = [], []
    for t, (i, j, h, lo, hi) in enumerate(todo):
        below, upto = counts[f"below{t}"], counts[f"upto{t}"]
        ranks = {math.floor(h), math.ceil(h)}
        # the neighbours of the bracket are known, too
        if below - 1 in ranks:
            known[i, j, below - 1] = counts[f"before{t}"]
        if upto in ranks:
            known[i, j, upto] = counts[f"after{t}"]
        left = [r for r in ranks if (i, j, r) not in known]
        if all(below <= r < upto for r in left):
            inside += [(t, i, j, lo, hi, [(r, r - below) for r in left])] if left else []
        else:
            again.append((i, j, h, -math.inf if min(left) < below else lo, math.inf if max(left) >= upto else hi))
    if inside:
        hit = F.array(*[F.when(F.col(f"c{i}").between(F.lit(lo), F.lit(hi)), F.struct(F.lit(t).alias("t"), F.col(f"c{i}").alias("v")))
                        for t, i, _, lo, hi, _ in inside])
        grouped = (rows.select(F.explode(F.filter(hit, lambda x: x.isNotNull())).alias("x")).groupBy(F.col("x.t").alias("t"), F.col("x.v").alias("v"))
                   .agg(F.count(F.lit(1)).alias("c")))
        grouped = cut_lineage(grouped, "brackets")
        got = sorted(tuple(r) for r in grouped.limit(most_values + 1).collect())
        for t, i, j, _, _, ranks in inside:
            if len(got) <= most_values:
                at = _values_at([(v, c) for s, v, c in got if s == t], [r for _, r in ranks])
            else:
                at = _values_at_scale(grouped.filter(F.col("t") == t), [r for _, r in ranks], rows_per_bucket)
            known.update({(i, j, whole): at[r] for whole, r in ranks})
    return again


def _values_at(counts: list[tuple[float, int]], ranks: list[int]) -> dict[int, float]:
    out, seen = {}, 0
    for v, c in counts:
        out.update({r: v for r in ranks if seen <= r < seen + c})
        seen += c
    return out


def _values_at_scale(counts: DataFrame, ranks: list[int], rows_per_bucket: int) -> dict[int, float]:
    """The same from a frame (v, c) of any size: at most one row for each rank reaches the driver."""
    cum = running_totals(counts.select("v", "c"), "v", ["c"], rows_per_bucket=rows_per_bucket)
    covers = F.lit(False)
    for r in ranks:
        covers = covers | ((F.col("c_cum") - F.col("c") <= F.lit(r)) & (F.lit(r) < F.col("c_cum")))
    hits = cum.filter(covers).select("v", "c", "c_cum").collect()
    return {r: float(next(x["v"] for x in hits if x["c_cum"] - x["c"] <= r < x["c_cum"])) for r in ranks}
