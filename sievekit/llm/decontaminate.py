"""Benchmark decontamination by winnowing.

Both sides are cut into runs of ``k`` words.  Of every ``window`` consecutive
runs the one with the smallest hash is kept (the last of equals), on either
side, so any shared span of ``k + window - 1`` words shares a kept run at the
same place in it.  Kept runs of documents that pass a fixed-size bit filter of
the benchmark's kept runs are joined with them by hash, and every hit is
extended word by word on both sides (the neighbouring words travel with it),
which also makes the result exact.  An item shorter than the span is one
window itself: documents give all runs of such a length instead.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import gram_hashes, id_text, id_text_batches, numbered, stored, word_hashes

#: Letters, digits and every non-ASCII byte are word bytes; A-Z are lower-cased.
_TO_WORD = bytes(b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TO_WORD).split() if text else []


def winnow(grams: np.ndarray, window: int) -> np.ndarray:
    """Positions kept: of every ``window`` neighbours the smallest, the last of equals."""
    m = len(grams) - window + 1
    if m <= 0:
        return np.zeros(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(grams, window)
    at = window - 1 - np.argmin(views[:, ::-1], axis=1) + np.arange(m)
    return at[np.concatenate(([True], at[1:] != at[:-1]))]


def _marks(words: list[bytes], span: int, k: int, short: list[int]) -> list[tuple[int, int, int, np.ndarray, np.ndarray]]:
    """Kept runs as (whole, words in a run, reach, positions, hashes).  ``whole``
    is 0 for winnowed runs, else the length of the short items they stand for;
    ``reach`` is how many words on either side may belong to the same window."""
    h = word_hashes(words)
    out = []
    if len(h) >= span:
        g = gram_hashes(h, k)
        at = winnow(g, span - k + 1)
        out.append((0, k, span - k, at, g[at]))
    for n in short:
        g = gram_hashes(h, n)
        out.append((n, n, 0, np.arange(len(g)), g))
    return out


def _near(words: list[bytes], at: int, n: int, reach: int) -> tuple[int, str]:
    """How many neighbours come before the run, and the run with its neighbours."""
    left = min(reach, at)
    return left, b" ".join(words[at - left:at + n + reach]).decode("utf-8", "surrogatepass")


def benchmark_marks(benchmark: DataFrame, span: int, k: int, id_col: str, text_col: str) -> DataFrame:
    """Kept runs of the items, each with its neighbours and its item."""

    def run(batches):
        for keys, texts in id_text_batches(batches):
            rows, owner = [], []
            for i, t in enumerate(texts):
                w = words_of(t)
                for whole, n, reach, at, g in _marks(w, span, k, [len(w)] if 0 < len(w) < span else []):
                    for p, x in zip(at.tolist(), g.view(np.int64).tolist()):
                        rows.append((whole, x, *_near(w, p, n, reach)))
                        owner.append(i)
            cols = list(zip(*rows)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([keys.take(pa.array(owner, pa.int64())), *(pa.array(c, t) for c, t in zip(cols, _MARK))],
                                             names=["item_id", "whole", "hash", "i_left", "i_near"])

    return id_text(benchmark, id_col, text_col).mapInArrow(
        run, "item_id bigint, whole int, hash bigint, i_left int, i_near string").distinct()


_MARK = (pa.int32(), pa.int64(), pa.int32(), pa.string())


def _bit_filter(marks: DataFrame, bits: int) -> np.ndarray:
    """2**bits bits, one set for each kept run of the benchmark: 2**(bits - 6)
    numbers whatever the benchmark's size; when full, it only lets more through."""
    bit = F.col("hash").bitwiseXOR(F.col("whole").cast("bigint")).bitwiseAND(F.lit((1 << bits) - 1))
    words = marks.select(bit.alias("bit")).groupBy(F.shiftright("bit", 6).alias("at")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(bit & 63 AS INT)))").alias("word")).collect()
    out = np.zeros(1 << bits - 6, np.int64)
    for r in words:
        out[r["at"]] = r["word"]
    return out.view(np.uint64)


def _passes(filter_: np.ndarray, g: np.ndarray, whole: int, bits: int) -> np.ndarray:
    bit = (g ^ np.uint64(whole)) & np.uint64((1 << bits) - 1)
    return np.flatnonzero(filter_[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1))


def contamination(docs: DataFrame, benchmark: DataFrame, span: int = 10, k: int = 5, bits: int = 22, id_col: str = "doc_id",
                  text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_words, n_hit (words inside
    any occurrence of any benchmark window), items (ids as text, sorted),
    spans (word ranges that agree with an item) and text_key (xxhash64 of the
    text, to find the row again).

    Windows are all runs of ``span`` words of an item, or the whole item if it
    is shorter.  Null and empty texts have no words and no hits, on either
    side; a null item key hits but is not listed; a repeated row gives a
    repeated result; with an empty benchmark nothing is hit; other columns are
    not read.

    One pass over the texts.  Only kept runs that the filter lets through are
    shuffled, with ``2 * span`` words at most.  A run that very many documents
    share meets the benchmark's rows in a join whose large partitions Spark
    splits."""
    marks = stored(benchmark_marks(benchmark, span, k, item_id_col, item_text_col), "marks")
    short = sorted(r["whole"] for r in marks.where("whole > 0").select("whole").distinct().collect())  # fewer than span
    seen = docs.sparkSession.sparkContext.broadcast(_bit_filter(marks, bits))

    def run(batches):
        for b in batches:
            text_keys = b.column(2)
            at = 0
            for ids, texts in id_text_batches([b]):
                hits, n_words = [], []
                for t in texts:
                    w = words_of(t)
                    n_words.append(len(w))
                    found = []
                    for whole, n, reach, pos, g in _marks(w, span, k, short):
                        for j in _passes(seen.value, g, whole, bits).tolist():
                            left, near = _near(w, int(pos[j]), n, reach)
                            found.append({"whole": whole, "hash": int(g[j].view(np.int64)), "pos": int(pos[j]), "left": left, "near": near})
                    hits.append(found)
                yield pa.RecordBatch.from_arrays([ids, text_keys.slice(at, len(texts)), pa.array(n_words, pa.int64()), pa.array(hits, _HITS)],
                                                 names=["doc_id", "text_key", "n_words", "hits"])
                at += len(texts)

    scanned = id_text(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text")).mapInArrow(
        run, "doc_id bigint, text_key bigint, n_words bigint, hits array<struct<whole:int,hash:bigint,pos:int,left:int,near:string>>")
    scanned = stored(scanned.withColumn("row", F.monotonically_increasing_id()), "scanned")
    seen.destroy()

    # extend every hit: words that agree before the run, and from its start on
    d, i, left, i_left = F.split("near", " "), F.split("i_near", " "), F.col("left"), F.col("i_left")
    before = _agree(F.reverse(F.slice(d, 1, left)), F.reverse(F.slice(i, 1, i_left)))
    after = _agree(F.slice(d, left + 1, F.size(d)), F.slice(i, i_left + 1, F.size(i)))
    met = (scanned.select("row", F.inline("hits")).join(marks, ["whole", "hash"])
           .select("row", "item_id", "whole", "pos", before.alias("before"), after.alias("after"))
           .where(F.when(F.col("whole") > 0, F.col("after") == F.col("whole")).otherwise(F.col("before") + F.col("after") >= span))
           .select("row", "item_id", (F.col("pos") - F.col("before")).alias("start"), (F.col("pos") + F.col("after")).alias("end"))
           .groupBy("row", "start", "end").agg(F.collect_set(F.col("item_id").cast("string")).alias("of")))
    met = stored(met, "met")
    earlier = F.max("end").over(Window.partitionBy("row").orderBy("start", "end").rowsBetween(Window.unboundedPreceding, -1))
    covered = F.greatest(F.lit(0), F.col("end") - F.greatest(F.col("start"), F.coalesce(F.col("earlier"), F.lit(0))))
    cover = met.withColumn("earlier", earlier).groupBy("row").agg(
        F.sum(covered).cast("bigint").alias("n_hit"), F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("of")))).alias("items"))
    none = lambda c, kind: F.coalesce(F.col(c), F.array().cast(kind))
    return scanned.select("row", "doc_id", "n_words", "text_key").join(cover, "row", "left").select(
        "doc_id", "n_words", F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"), none("items", "array<string>").alias("items"),
        none("spans", "array<struct<start:int,end:int>>").alias("spans"), "text_key")


def _agree(a, b):
    """How many leading words two arrays share."""
    pairs = F.zip_with(a, b, lambda x, y: F.coalesce(x == y, F.lit(False)))
    stop = F.array_position(pairs, F.lit(False))
    return F.when(stop == 0, F.size(pairs)).otherwise(stop - 1).cast("int")


_HITS = pa.list_(pa.struct([("whole", pa.int32()), ("hash", pa.int64()), ("pos", pa.int32()), ("left", pa.int32()), ("near", pa.string())]))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Rows of ``docs`` without a hit word, all columns kept, whatever their names.
    Rows are matched by key and text, so repeated or null keys are judged by
    their own text; repeated rows stay or go together.  Null and empty texts are
    hit by nothing and stay; an empty table or benchmark changes nothing."""
    bad = contamination(docs, benchmark, id_col=id_col, text_col=text_col, **options).where("n_hit > 0").select(
        F.col("doc_id").alias("__bad_id"), F.col("text_key").alias("__bad_text")).distinct()
    bad = stored(bad, "contaminated")  # its size is then known, and a small one is broadcast
    plain, id_at, text_at = numbered(docs), docs.columns.index(id_col), docs.columns.index(text_col)
    key = F.xxhash64(F.col(f"c{text_at}").cast("string")) == F.col("__bad_text")
    return plain.join(bad, key & F.col(f"c{id_at}").cast("bigint").eqNullSafe(F.col("__bad_id")), "left_anti").toDF(*docs.columns)


def contamination_digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The contract's columns, from ``contamination``."""
    return contamination(docs, benchmark).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))
