"""Document fingerprints: threshold-scaled sketches, in Spark expressions only.

A text's shingles are its runs of five words (all its words if it has fewer),
hashed to 64 bits.  The sketch keeps every hash below a fixed fraction of the
hash range, so sketches grow with their texts, two of them can be compared
however unequal the texts are, and sketches of parts merge to the sketch of
the whole.  A text with few shingles below the threshold keeps its ``FLOOR``
smallest hashes instead, which is a sketch at a higher threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import id_text, one_of_each, picked

WORDS, FRACTION, FLOOR = 5, 16, 16
#: Kept hashes are at most this, of a signed 64-bit range.
LIMIT = -(1 << 63) + (1 << 64) // FRACTION - 1


def add_sketch(rows: DataFrame, text_col: str, as_: str, words: int = WORDS) -> DataFrame:
    """``rows`` with the sketch of a text column (sorted hashes).  Null and empty
    texts, and those of white space, have an empty sketch."""
    h, s, low = (f"__{as_}_{k}" for k in ("hashes", "shingles", "low"))
    hashed = F.transform(F.array_remove(F.split(F.lower(F.coalesce(F.col(text_col), F.lit(""))), r"\s+"), ""), lambda x: F.xxhash64(x))
    rows = rows.withColumn(h, hashed)
    run = lambda x, i: F.xxhash64(x, *(F.get(h, i + k) for k in range(1, words)))
    shingles = F.when(F.size(h) >= words, F.transform(F.slice(h, 1, F.size(h) - (words - 1)), run)).when(
        F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))
    rows = rows.withColumn(s, shingles)
    rows = rows.withColumn(low, F.array_distinct(F.filter(s, lambda x: x <= LIMIT)))
    sketch = F.when(F.size(low) >= FLOOR, F.sort_array(low)).otherwise(F.slice(F.sort_array(F.array_distinct(s)), 1, FLOOR))
    return rows.withColumn(as_, sketch).drop(h, s, low)


def known_up_to(sketch: Column) -> Column:
    """All the text's hashes up to this one are in its sketch."""
    return F.when(F.size(sketch) < FLOOR, F.lit((1 << 63) - 1)).otherwise(F.greatest(F.lit(LIMIT), F.element_at(sketch, -1)))


def _common(a: Column, b: Column) -> tuple[Column, Column, Column]:
    """Sizes of both sketches and of their intersection, where both are complete."""
    both = F.least(known_up_to(a), known_up_to(b))
    x, y = (F.filter(s, lambda v: v <= both) for s in (a, b))
    return F.size(x), F.size(y), F.size(F.array_intersect(x, y))


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of the shingle sets; 1 for two empty ones."""
    n, m, both = _common(a, b)
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(F.coalesce(F.try_divide(both.cast("double"), n + m - both), F.lit(0.0)))


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that b has; 1 for an empty a."""
    n, _, both = _common(a, b)
    return F.when(F.size(a) == 0, 1.0).otherwise(F.coalesce(F.try_divide(both.cast("double"), n), F.lit(0.0)))


def merged(a: Column, b: Column) -> Column:
    """The sketch of both texts' shingles together, as far as both are complete."""
    both = F.least(known_up_to(a), known_up_to(b))
    return F.sort_array(F.filter(F.array_union(a, b), lambda v: v <= both))


def as_text(sketch: Column) -> Column:
    """16 hex digits for each hash."""
    return F.array_join(F.transform(sketch, lambda v: F.lpad(F.hex(v), 16, "0")), "")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_chars (code points), sketch.
    Null texts count as empty; repeated rows give repeated results; only the key
    and the text are read; no shuffle."""
    rows = picked(docs, doc_id=id_col, text=text_col).withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    return add_sketch(rows, "text", "sketch").select("doc_id", F.char_length("text").cast("bigint").alias("n_chars"), "sketch")


def with_next(docs: DataFrame, key: str, carry: list[str], rows_each: int = 250, most: int = 4096) -> DataFrame:
    """``docs`` (with a bigint ``key`` without nulls) and columns next_<c> of the
    row that follows by key, then by the carried columns; after the last row
    comes the first.

    Rows are dealt to ranges of the key, about ``rows_each`` rows each and
    ``most`` ranges at most, so that above ``rows_each * most`` rows ranges grow
    with the table; rows of one key share a range.  A copy of each range's first
    row closes the range before."""
    n = docs.count()
    if not n:
        return docs.select("*", *(F.col(c).alias(f"next_{c}") for c in carry))
    parts = max(1, min(most, n // rows_each))
    cuts = docs.select(F.percentile_approx(key, [k / parts for k in range(1, parts)] or [0.5], 20 * most)).first()[0]
    cuts = sorted(set(cuts)) if parts > 1 else []
    bounds = F.array(*map(F.lit, cuts)).cast("array<bigint>")
    part = F.size(F.filter(bounds, lambda b: b < F.col(key)))
    firsts = {r["__part"]: r["least"] for r in docs.groupBy(part.alias("__part")).agg(F.min(key).alias("least")).collect()}  # most rows
    order = sorted(firsts)
    before = F.create_map(*(F.lit(x) for k, p in enumerate(order) for x in (firsts[p], order[k - 1])))
    closing = docs.where(F.col(key).isin(list(firsts.values()))).select("*", F.try_element_at(before, F.col(key)).alias("__part"), F.lit(1).alias("__extra"))
    closing = one_of_each(closing, ["__part"], [F.col(key), *map(F.col, carry)])
    rows = docs.select("*", part.alias("__part"), F.lit(0).alias("__extra")).unionByName(closing)
    w = Window.partitionBy("__part").orderBy("__extra", key, *carry)
    return rows.select("*", *(F.lead(c).over(w).alias(f"next_{c}") for c in carry)).where("__extra = 0").drop("__part", "__extra")


def edited_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each document beside its edited text, whose last quarter (code points,
    rounded down) is replaced by as many from the start of the next document by
    key (null keys first, equal keys by text; after the last the first):
    doc_id, n_chars, edited_sha256, sketch, edited_sketch, near_edited,
    near_next.  Null texts count as empty, as do missing ends of short texts."""
    rows = id_text(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    rows = rows.withColumn("key", F.coalesce("doc_id", F.lit(-(1 << 63))))
    rows = with_next(add_sketch(rows, "text", "sketch"), "key", ["text", "sketch"])
    rows = rows.withColumn("n_chars", F.char_length("text"))
    cut = F.floor(F.col("n_chars") / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.col("n_chars") - cut), F.substring(F.col("next_text"), F.lit(1), cut))
    rows = rows.select("doc_id", F.col("n_chars").cast("bigint").alias("n_chars"), edited.alias("edited"), "sketch", "next_sketch")
    rows = add_sketch(rows, "edited", "edited_sketch")
    return rows.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "sketch", "edited_sketch",
                       likeness(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
                       likeness(F.col("sketch"), F.col("next_sketch")).alias("near_next"))


def fingerprint_digest(docs: DataFrame) -> DataFrame:
    """The contract's columns, from ``edited_fingerprints``."""
    return edited_fingerprints(docs).select("doc_id", "n_chars", "edited_sha256", as_text(F.col("sketch")).alias("fingerprint"),
                                            as_text(F.col("edited_sketch")).alias("edited_fingerprint"), "near_edited", "near_next")
