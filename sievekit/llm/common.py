"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sievekit.session import bound_batches, clear_scratch, scratch_path


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the corpus folder, through Spark's own reader."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once under the shared checkpoint folder and read it back:
    lineage is cut, and a lost executor re-reads files."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    bound_batches(spark)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.scratch = path
    return back


def discard(df: DataFrame) -> None:
    """Delete the files of a ``stored`` table that nothing will read again."""
    clear_scratch(df.sparkSession, [df.scratch])


_HELD: dict = {}


def held(key, make=None):
    """What ``make`` gives, remembered by this Python worker until it asks for
    something else: a worker that serves many operators holds one's tables."""
    if key not in _HELD:
        _HELD.clear()
        pa.default_memory_pool().release_unused()
        if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
            libc.malloc_trim(0)  # what was freed goes back to the system
        _HELD[key] = make() if make else None
    return _HELD[key]


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the key and the text, under fixed names, so that other columns of
    the caller's table can neither clash nor be read."""
    return picked(docs, doc_id=id_col, text=text_col).select(F.col("doc_id").cast("bigint"), F.col("text").cast("string"))


def numbered(df: DataFrame) -> DataFrame:
    """``df`` with its columns named c0, c1 and so on, which no name added to them can clash with."""
    return df.toDF(*(f"c{k}" for k in range(len(df.columns))))


def picked(df: DataFrame, **names: str) -> DataFrame:
    """Columns of ``df`` under new names, found by their exact spelling: another
    column may differ from one of them by case alone."""
    return numbered(df).select(*(F.col(f"c{df.columns.index(c)}").alias(k) for k, c in names.items()))


def one_of_each(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in some order.  Every task sends on its own first
    rows only, so that a key with very many rows is no load."""
    return rows.withColumn("nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("nth = 1").drop("nth")


def fold_of(doc_id: Column, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds


def parts_of(batches: Iterable[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in parts of so many rows, to bound what one step holds."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def id_text_batches(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list]]:
    """Keys (Arrow) and texts (Python strings or None) of ``id_text`` rows, at most
    1,000 rows at a time."""
    for part in parts_of(batches):
        yield part.column(0), part.column(1).to_pylist()


class WordHashes(dict):
    """64-bit hash of each word, remembered up to ``limit`` words."""

    limit = 400_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


#: Odd multipliers; a gram's hash is a sum of its words' hashes times powers of the first, mixed by the second.
_MUL, _MIX = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(held("word hashes", WordHashes).__getitem__, words), np.uint64, len(words))


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all ``n``-word runs of a document given its words' hashes."""
    m = len(h) - n + 1
    if m <= 0:
        return np.zeros(0, np.uint64)
    out = h[:m].copy()
    for k in range(1, n):
        out *= _MUL
        out += h[k:k + m]
    out ^= out >> np.uint64(29)
    out *= _MIX
    out ^= out >> np.uint64(32)
    return out
