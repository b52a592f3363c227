"""Table jobs over fingerprints and tokens: bit statistics, rarity scores,
pattern search, and batch featurising (native or a user pandas function)."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.fingerprint import explode_bits, hashed_fingerprint
from ..functions.tokens import tokens
from ..session import bound_batches, cut_lineage, with_partitions
from .rules import below, above, rule_flags, text_descriptors

# Largest bit space whose per-bit table is broadcast (rows = n_bits).
MAX_BROADCAST_BITS = 1 << 22


def fingerprint_density(df: DataFrame, bits_col: str, n_bits: int) -> DataFrame:
    """Rows, mean set bits per row and sparsity ``1 - mean/n_bits`` over
    the whole table (null fingerprints skipped)."""
    b = F.col(bits_col)
    # conditional aggregates, not a filter: a filter on the bits would be
    # pushed below the projection that computes them
    s = df.agg(F.count(b).alias("n_rows"),
               F.avg(F.when(b.isNotNull(), F.size(b))).alias("mean_on_bits"))
    return s.withColumn("sparsity", F.lit(1.0) - F.col("mean_on_bits") / F.lit(float(n_bits)))


def _bit_counts(df: DataFrame, bits_col: str) -> DataFrame:
    """Rows per set bit.  Partial aggregation caps the shuffle at
    ``n_bits`` rows per map task."""
    return (df.select(explode_bits(bits_col).alias("bit")).filter(F.col("bit").isNotNull())
            .groupBy("bit").agg(F.count(F.lit(1)).alias("n_rows")))


def bit_usage(df: DataFrame, bits_col: str, n_bits: int) -> DataFrame:
    """Rows per bit position, zero for never-set bits: ``(bit, n_rows)``."""
    counts = _bit_counts(df, bits_col)
    grid = df.sparkSession.range(n_bits).select(F.col("id").cast("int").alias("bit"))
    joined = grid.join(F.broadcast(counts) if n_bits <= MAX_BROADCAST_BITS else counts, "bit", "left")
    return joined.select("bit", F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"))


def rarity_score(df: DataFrame, id_col: str, bits_col: str, n_bits: int,
                 out: str = "rarity", digits: int = 6, materialize: bool = True) -> DataFrame:
    """Fragment-rarity score on a 1..10 scale: the row mean of
    ``ln(N / df(bit))`` over its set bits (N rows with a fingerprint,
    df(bit) rows having the bit), min-max scaled over the table.  Rows
    without bits get null.  (Idea after Ertl and Schuffenhauer, 2009.)

    The bits' weights are one array of at most ``n_bits`` numbers, looked up
    inside each row's own projection: the only exchange is that of the bit
    counts, and rows are neither exploded again nor moved."""
    if n_bits > MAX_BROADCAST_BITS:
        raise ValueError(f"more than {MAX_BROADCAST_BITS} bits: fold the fingerprints first")
    base = df.select(F.col(id_col).alias("id"), F.col(bits_col).alias("bits"))
    if materialize:  # read twice below; fingerprinting is not cheap
        base = cut_lineage(base)
    n_rows = base.select(F.count("bits").cast("double")).scalar()
    counts = _bit_counts(base, "bits").select(F.struct("bit", F.log(n_rows / F.col("n_rows")).alias("w")).alias("x"))
    # bits without rows are filled with nulls, so that a bit is its own index
    listed = counts.agg(F.array_sort(F.collect_list("x")).alias("xs"))
    dense = listed.select(F.transform(
        F.arrays_zip(F.concat(F.array(F.lit(-1)), F.transform("xs", lambda x: x["bit"])).alias("before"), F.transform("xs", lambda x: x["w"]).alias("w"),
                     F.transform("xs", lambda x: x["bit"]).alias("bit")),
        lambda x: F.when(x["bit"].isNull(), F.array().cast("array<double>")).otherwise(
            F.concat(F.array_repeat(F.lit(None).cast("double"), (x["bit"] - x["before"] - 1).cast("int")), F.array(x["w"])))).alias("ws"))
    weights = dense.select(F.flatten("ws")).scalar()
    total = F.aggregate("bits", F.lit(0.0), lambda acc, b: acc + F.get("weights", b))
    means = base.select("id", "bits", weights.alias("weights")).select("id", F.when(F.size("bits") > 0, total / F.size("bits")).alias("m"))
    if materialize:
        means = cut_lineage(means, "rarity")
    mm = means.agg(F.min("m").alias("lo"), F.max("m").alias("hi")).first()  # two numbers
    lo, hi = F.lit(mm["lo"]).cast("double"), F.lit(mm["hi"]).cast("double")
    scaled = F.when(hi == lo, F.when(F.col("m").isNotNull(), F.lit(1.0))).otherwise(F.lit(1.0) + F.lit(9.0) * (F.col("m") - lo) / (hi - lo))
    return means.select(F.col("id").alias(id_col), F.round(scaled, digits).alias(out))


# Pattern tables up to so many rows are broadcast; above it the join shuffles.
MAX_BROADCAST_PATTERNS = 1_000_000


def pattern_frame(spark: SparkSession, patterns: Sequence[Sequence[str]]) -> DataFrame:
    """A list of token sequences as a table ``(pattern_id, pattern)``."""
    return spark.createDataFrame([(i, list(p)) for i, p in enumerate(patterns)], "pattern_id int, pattern array<string>")


def pattern_index(rows: DataFrame, patterns: DataFrame) -> DataFrame:
    """``(anchor, pattern_id, at, pattern)``: each pattern under the token of it
    that is rarest in ``rows`` (column ``toks``), at its first place there."""
    spots = patterns.select("pattern_id", "pattern", F.posexplode("pattern").alias("at", "tok"))
    wanted = spots.select("tok").distinct()
    few = F.broadcast(wanted) if wanted.count() <= MAX_BROADCAST_PATTERNS else wanted
    counts = (rows.select(F.explode_outer("toks").alias("tok")).join(few, "tok", "left_semi")
              .groupBy("tok").agg(F.count(F.lit(1)).alias("c")))
    best = F.min(F.struct(F.coalesce("c", F.lit(0)).alias("c"), "tok", "at", "pattern")).alias("best")
    return spots.join(counts, "tok", "left").groupBy("pattern_id").agg(best).select(
        F.col("best.tok").alias("anchor"), "pattern_id", F.col("best.at").alias("at"), F.col("best.pattern").alias("pattern"))


def pattern_search(df: DataFrame, id_col: str, text_col: str,
                   patterns: DataFrame | Sequence[Sequence[str]], token_pattern: str | None = None, lowercase: bool = True,
                   partitions: int | None = None) -> DataFrame:
    """Occurrences of token-sequence patterns: one row per (row, pattern)
    with at least one match: ``(id, pattern_id, n_matches, matches)`` where
    ``matches`` is an array of 0-based token-index arrays.

    Patterns are a table ``(pattern_id, pattern)`` with distinct ids (or a list,
    numbered from 0); the plan does not grow with them.  An empty or null
    pattern is an error.  Each is found through its rarest token in the texts
    (``pattern_index``) and then compared whole where that token stands.  Up to
    ``MAX_BROADCAST_PATTERNS`` patterns the index is broadcast and a row's tokens
    are looked up and compared where they are; beyond it the places found are
    joined back to the texts that have any."""
    if not isinstance(patterns, DataFrame):
        patterns = pattern_frame(df.sparkSession, patterns)
    patterns = cut_lineage(patterns.select("pattern_id", "pattern"), "patterns")
    size = patterns.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.coalesce(F.size("pattern"), F.lit(0)) < 1).alias("empty")).first()
    if size["empty"]:
        raise ValueError("pattern must have at least one token")
    rows = with_partitions(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), partitions)
    rows = cut_lineage(rows.select(F.monotonically_increasing_id().alias("row"), "id", tokens("text", token_pattern, lowercase).alias("toks")), "tokens")
    index = cut_lineage(pattern_index(rows, patterns), "pattern-index")
    same = F.slice("toks", F.col("start") + 1, F.size("pattern")) == F.col("pattern")
    if size["n"] <= MAX_BROADCAST_PATTERNS:
        spots = rows.select("row", "id", "toks", F.posexplode_outer("toks").alias("pos", "tok")).join(F.broadcast(index), F.col("tok") == F.col("anchor"))
        hits = spots.withColumn("start", F.col("pos") - F.col("at")).filter((F.col("start") >= 0) & same)
    else:
        spots = rows.select("row", F.posexplode_outer("toks").alias("pos", "tok")).join(index.drop("pattern"), F.col("tok") == F.col("anchor"))
        spots = spots.select("row", "pattern_id", (F.col("pos") - F.col("at")).alias("start")).filter(F.col("start") >= 0)
        hits = spots.join(rows, "row").join(patterns, "pattern_id").filter(same)
    found = hits.groupBy("row", "pattern_id").agg(F.first("id").alias("id"), F.first(F.size("pattern")).alias("m"), F.sort_array(F.collect_list("start")).alias("starts"))
    matches = F.transform("starts", lambda s: F.sequence(s, s + F.col("m") - 1))
    return found.select(F.col("id").alias(id_col), "pattern_id", F.size("starts").alias("n_matches"), matches.alias("matches"))


def _isolated(fn: Callable[[pd.Series], pd.DataFrame], s: pd.Series, fields: list[str]) -> pd.DataFrame:
    """``fn`` over a batch, halved until the rows that raise stand alone."""
    try:
        out = fn(s).reset_index(drop=True)[fields].astype(object)
        if len(out) != len(s):
            raise ValueError(f"the function returned {len(out)} rows for {len(s)}")
        return out
    except Exception:
        if len(s) == 1:
            return pd.DataFrame({f: pd.Series([None], dtype=object) for f in fields})
        half = len(s) // 2
        return pd.concat([_isolated(fn, s.iloc[:half], fields), _isolated(fn, s.iloc[half:], fields)], ignore_index=True)


def batch_featurize(df: DataFrame, text_col: str,
                    fn: Callable[[pd.Series], pd.DataFrame] | None = None,
                    schema: T.StructType | None = None, prefix: str = "calc_",
                    error_col: str = "featurize_error", partitions: int | None = None,
                    setup: Callable[[], Callable[[pd.Series], pd.DataFrame]] | None = None) -> DataFrame:
    """Descriptor columns ``<prefix><field>`` for each row.

    Default: the native ``text_descriptors`` (no Python).  With ``fn`` (a
    user batch function ``Series[str] -> DataFrame`` whose columns match
    ``schema``) it runs over an iterator of Arrow batches.  With ``setup``
    instead, that is called once in each task and returns the function: for a
    library, pattern or model that is dear to load.  ``error_col`` is true
    for a null input, for a row on which the function raises, and for a row whose
    fields all come back null; such rows have null fields.  A ``setup`` that
    raises ends the task."""
    if fn is None and setup is None:
        out = text_descriptors(df, text_col, prefix=prefix, partitions=partitions)
        return out.withColumn(error_col, F.col(text_col).isNull())
    if fn is not None and setup is not None:
        raise ValueError("give a function or a set-up that returns one")
    if schema is None:
        raise ValueError("a user function needs its output schema")
    fields = schema.fieldNames()
    ret = T.StructType(list(schema.fields) + [T.StructField(error_col, T.BooleanType())])

    @F.pandas_udf(ret)
    def _run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        made = setup() if setup is not None else fn
        for s in batches:
            res = _isolated(made, s.reset_index(drop=True), fields)
            res[error_col] = (s.isna().to_numpy() | res[fields].isna().all(axis=1).to_numpy())
            yield res

    with_struct = with_partitions(df, partitions).withColumn("_desc", _run(F.col(text_col)))
    return with_struct.select(*df.columns,
                              *[F.col(f"_desc.{f}").alias(f"{prefix}{f}") for f in fields],
                              F.col(f"_desc.{error_col}").alias(error_col))


def text_rules(prefix: str = "calc_") -> list[tuple]:
    """Rules of ``feature_batch`` unless the caller gives others."""
    return [("short_text", below(f"{prefix}n_chars", 50)), ("few_distinct", below(f"{prefix}distinct_token_share", 0.3)),
            ("many_capitals", above(f"{prefix}upper_share", 0.3)), ("much_punctuation", above(f"{prefix}punct_share", 0.15))]


def feature_batch(df: DataFrame, text_col: str, radius: int = 2, n_bits: int = 2048, prefix: str = "calc_",
                  bits_col: str = "bits", rules: list[tuple] | None = None, partitions: int | None = None) -> DataFrame:
    """Descriptors, fingerprint and rule flags in one pass over the rows, whose
    texts are split into tokens once.  Bounds the session's Arrow batches."""
    bound_batches(df.sparkSession)
    d = text_descriptors(df, text_col, prefix=prefix, partitions=partitions, tokens_col="_tokens")
    d = d.withColumn(bits_col, hashed_fingerprint("_tokens", radius, n_bits)).drop("_tokens")
    return rule_flags(d, text_rules(prefix) if rules is None else rules)
