"""Rule and score columns.  All are single projections (no shuffle) built
from ``when``/``greatest``/``least`` so they stay in whole-stage codegen.

Conditions are Spark ``Column``s.  Use ``above``/``below`` to build limit
conditions that treat NaN like null: in Spark ``NaN > x`` is true, while
the rule semantics want an invalid value to count as "no violation"."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.tokens import tokens
from ..session import with_partitions

# Default rule-of-five upper limits (violation when the value
# is strictly above the limit) and the number of violations still passing.
RULE_OF_FIVE = (
    ("mw_violation", "molecular_weight", 500),
    ("logp_violation", "logp", 5),
    ("hbd_violation", "num_h_donors", 5),
    ("hba_violation", "num_h_acceptors", 10),
)
MAX_VIOLATIONS = 1

def _nn(c) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    return F.nanvl(x.cast("double"), F.lit(None))


def above(c, limit) -> Column:
    """``c > limit``; null and NaN give null."""
    return _nn(c) > F.lit(limit)


def below(c, limit) -> Column:
    return _nn(c) < F.lit(limit)


def compare(c, op: str, limit) -> Column:
    ops = {">": above, "<": below,
           ">=": lambda c, v: _nn(c) >= F.lit(v), "<=": lambda c, v: _nn(c) <= F.lit(v)}
    return ops[op](c, limit)


def clip(x: Column, lo, hi) -> Column:
    """Clamp to [lo, hi]; null stays null (``greatest``/``least`` alone
    would skip the null and return a bound)."""
    return F.when(x.isNull(), F.lit(None)).otherwise(F.least(F.greatest(x, F.lit(lo)), F.lit(hi)))


def rule_flags(df: DataFrame, rules: Sequence[tuple[str, Column]] | None = None,
               total_col: str = "n_violations", pass_col: str = "passes",
               max_violations: int = MAX_VIOLATIONS, null_policy: str = "zero") -> DataFrame:
    """One 0/1 flag per named rule, their integer sum and a pass flag
    (``sum <= max_violations``), in one projection.

    ``null_policy='zero'``: a rule whose condition is null counts as not
    violated (so an invalid row passes).  ``'null'``: the flag, the sum
    and the pass flag become null."""
    if rules is None:
        rules = [(name, above(c, lim)) for name, c, lim in RULE_OF_FIVE]
    if null_policy == "zero":
        flags = {n: F.when(c, 1).otherwise(0) for n, c in rules}
    elif null_policy == "null":
        flags = {n: c.cast("int") for n, c in rules}
    else:
        raise ValueError("null_policy must be 'zero' or 'null'")
    total = sum((F.col(n) for n in flags), F.lit(0))
    return (df.withColumns(flags)
              .withColumn(total_col, total.cast("int"))
              .withColumn(pass_col, F.col(total_col) <= F.lit(max_violations)))


def rule_summary(flagged: DataFrame, total_col: str = "n_violations",
                 pass_col: str = "passes") -> DataFrame:
    """Rows per violation count with their share, and whether that count
    passes.  One scan: the total is the sum of the few grouped counts."""
    counts = flagged.groupBy(total_col).agg(F.count(F.lit(1)).alias("n_rows"), F.first(pass_col).alias(pass_col))
    return (counts.withColumn("pct_rows", F.col("n_rows") * 100.0 / F.sum("n_rows").over(Window.partitionBy()).cast("double"))
            .orderBy(total_col))


def weighted_rule_score(df: DataFrame, terms: Sequence[tuple[Column, float]],
                        noise: Column | None = None, threshold: float = 0.5,
                        score_col: str = "score", label_col: str = "label",
                        digits: int = 4) -> DataFrame:
    """Sum of weights of the true conditions (+ optional noise column),
    clipped to [0, 1].  The label compares the *unrounded* score with the
    threshold; the stored score is rounded half-to-even to ``digits``."""
    raw = F.lit(0.0)
    for cond, w in terms:
        raw = raw + F.when(cond, F.lit(float(w))).otherwise(F.lit(0.0))
    if noise is not None:
        raw = raw + noise
    clipped = clip(raw, 0.0, 1.0)
    return df.withColumns({"_raw_score": clipped}) \
             .withColumns({label_col: F.col("_raw_score") > F.lit(threshold),
                           score_col: F.bround(F.col("_raw_score"), digits)}) \
             .drop("_raw_score")


def linear_score(df: DataFrame, terms: Sequence[tuple[float, str, float]], intercept: float, bounds: tuple[float, float],
                 noise: Column | None = None, out: str = "linear_score",
                 digits: int = 2) -> DataFrame:
    """``intercept + sum(coef * (col - centre))`` (+ noise), clipped and
    rounded half-to-even."""
    x = F.lit(float(intercept))
    for coef, c, centre in terms:
        x = x + F.lit(float(coef)) * (F.col(c) - F.lit(centre))
    if noise is not None:
        x = x + noise
    return df.withColumn(out, F.bround(clip(x, float(bounds[0]), float(bounds[1])), digits))


def banded_class(df: DataFrame, base: float, bonuses: Sequence[tuple[str, float, float, float]],
                 bands: Sequence[tuple[float, str]], default: str, noise: Column | None = None,
                 score_col: str = "band_score", out: str = "band") -> DataFrame:
    """Base score plus a bonus per closed range hit, clipped to [0, 1],
    then cut into named bands (first band whose threshold is exceeded)."""
    s = F.lit(float(base))
    for c, lo, hi, w in bonuses:
        s = s + F.when(_nn(c).between(F.lit(lo), F.lit(hi)), F.lit(float(w))).otherwise(F.lit(0.0))
    if noise is not None:
        s = s + noise
    s = clip(s, 0.0, 1.0)
    cls = None
    for t, name in bands:
        cls = F.when(F.col(score_col) > F.lit(t), name) if cls is None \
            else cls.when(F.col(score_col) > F.lit(t), name)
    cls = F.lit(default) if cls is None else cls.otherwise(default)
    return df.withColumn(score_col, s).withColumn(out, cls)


#: Columns of ``text_descriptors``.
DESCRIPTORS = ("n_chars", "n_tokens", "distinct_token_share", "digit_share", "upper_share", "punct_share", "repeated_line_share")


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole == 0, F.lit(0.0)).otherwise(part.cast("double") / whole)


def text_descriptors(df: DataFrame, text_col: str, prefix: str = "", partitions: int | None = None,
                     tokens_col: str | None = None) -> DataFrame:
    """Length, tokens, and the shares of distinct tokens, digits, capitals,
    punctuation (ASCII) and repeated lines of a text, in one projection.
    Shares of an empty text are 0; null text gives nulls.  The tokens stay as
    ``tokens_col`` if it is given."""
    tmp = tokens_col or "_t"
    s, t, n = F.col(text_col), F.col(tmp), F.length(F.col(text_col))
    lines = F.split(s, "\n")
    # what is no such character goes a run at a time, not each by itself
    only = lambda others: F.length(F.regexp_replace(s, f"{others}+", ""))
    props = {"n_chars": n, "n_tokens": F.size(t), "distinct_token_share": _share(F.size(F.array_distinct(t)), F.size(t)),
             "digit_share": _share(only("[^0-9]"), n), "upper_share": _share(only("[^A-Z]"), n),
             "punct_share": _share(only("\\P{Punct}"), n),
             "repeated_line_share": F.lit(1.0) - F.size(F.array_distinct(lines)).cast("double") / F.size(lines)}
    props = {f"{prefix}{k}": F.when(s.isNull(), F.lit(None)).otherwise(v) for k, v in props.items()}
    out = with_partitions(df, partitions).withColumn(tmp, tokens(text_col)).withColumns(props)
    return out if tokens_col else out.drop(tmp)


def desirability_score(df: DataFrame, curves: Sequence[tuple[str, float, float, float, float,
                                                             float, float, float, float]],
                       out: str = "desirability") -> DataFrame:
    """Weighted geometric mean of per-column desirabilities in (0, 1].

    Each curve is ``(column, a, b, c, d, e, f, dmax, weight)`` of the
    asymmetric double sigmoid
    ``a + b / (1 + exp(-(x - c + d/2) / e)) * (1 - 1 / (1 + exp(-(x - c - d/2) / f)))``
    divided by ``dmax`` (form published by Bickerton et al., 2012).  The
    score is ``exp(sum(w * ln(d)) / sum(w))``; null if any input is null."""
    num, den = F.lit(0.0), 0.0
    for c, a, b, cc, d, e, f, dmax, w in curves:
        x = _nn(c)
        ads = (F.lit(a) + F.lit(b) / (F.lit(1.0) + F.exp(-(x - F.lit(cc) + F.lit(d / 2.0)) / F.lit(e)))
               * (F.lit(1.0) - F.lit(1.0) / (F.lit(1.0) + F.exp(-(x - F.lit(cc) - F.lit(d / 2.0)) / F.lit(f)))))
        dval = ads / F.lit(dmax)
        num = num + F.lit(float(w)) * F.log(dval)
        den += float(w)
    return df.withColumn(out, F.exp(num / F.lit(den)))


def candidate_screen(df: DataFrame, key: str, confidence_col: str, solubility_col: str,
                     score_col: str, confidence_min: float = 0.7, solubility_min: float = -3.0,
                     score_min: float = 0.6, k: int | None = None) -> DataFrame:
    """Rows meeting all three thresholds, best score first (ties by key).
    With ``k`` only the top ``k`` (a per-partition top-k, then merge)."""
    out = df.filter((F.col(confidence_col) >= confidence_min)
                    & (F.col(solubility_col) >= solubility_min)
                    & (F.col(score_col) >= score_min))
    out = out.orderBy(F.desc(score_col), F.asc(key))
    return out.limit(k) if k is not None else out
