"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1.  A letter trigram is the
product of its letters' vectors, the first rotated by two places, the second
by one.  A text is the sum of its trigrams' vectors; a language's prototype
is the sum of the vectors of its training texts, each text weighing the same.
A text gets the language whose prototype has the largest cosine with it.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import held, numbered, parts_of, picked

#: Symbols: 0 is a word boundary, 1-26 a-z, any other letter its code point.
_BITS = 21
#: Trigrams of the first so many letters that a process meets are remembered.
_KNOWN = 64


def _symbol_table() -> np.ndarray:
    table = np.zeros(0x110000, np.int32)
    for c in range(0x110000):
        if chr(c).isalpha():
            table[c] = c
    table[97:123] = np.arange(1, 27)
    return table


_TABLE = _symbol_table()


def trigram_counts(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Codes and counts of a text's letter trigrams, runs of anything else
    being one boundary; nothing if the text has no letter."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not text:
        return none
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    s = _TABLE[points]
    if not s.any():
        return none
    s = np.concatenate(([0], s, [0])).astype(np.int64)
    keep = np.ones(len(s), bool)
    keep[1:] = (s[1:] != 0) | (s[:-1] != 0)
    s = s[keep]
    return np.unique(((s[:-2] << _BITS) + s[1:-1] << _BITS) + s[2:], return_counts=True)


class Space:
    """Vectors of letters, each from its code point alone, made when met, and
    of trigrams of the letters met first."""

    def __init__(self, dims: int, seed: int):
        self.dims, self.seed = dims, seed
        base = np.random.default_rng(seed).choice(np.array([-1, 1], np.int8), (27, dims))
        self.letters = np.concatenate([base, np.zeros((_KNOWN - 27, dims), np.int8)])
        self.place = np.full(0x110000, -1, np.int32)
        self.place[:27] = np.arange(27)
        self.met = 27
        self.known = np.full(_KNOWN ** 3, -1, np.int32)
        self.vectors = np.zeros((1024, dims), np.int8)
        self.n = 0

    def _places(self, symbols: np.ndarray) -> np.ndarray:
        """Rows of ``letters``."""
        for c in np.unique(symbols[self.place[symbols] < 0]).tolist():
            if self.met == len(self.letters):
                self.letters = np.concatenate([self.letters, np.zeros_like(self.letters)])
            self.letters[self.met] = np.random.default_rng([self.seed, c]).choice(np.array([-1, 1], np.int8), self.dims)
            self.place[c] = self.met
            self.met += 1
        return self.place[symbols]

    def _bound(self, a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
        return np.roll(self.letters[a], 2, axis=1) * np.roll(self.letters[b], 1, axis=1) * self.letters[c]

    def total(self, codes: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The sum of the trigrams' vectors."""
        low = (1 << _BITS) - 1
        abc = [self._places(x) for x in (codes >> 2 * _BITS, codes >> _BITS & low, codes & low)]
        kept = np.maximum(np.maximum(abc[0], abc[1]), abc[2]) < _KNOWN
        a, b, c = (x[kept].astype(np.int64) for x in abc)
        out = counts[kept].astype(np.float32) @ self.rows((a * _KNOWN + b) * _KNOWN + c).astype(np.float32)
        rest, n = [x[~kept] for x in abc], counts[~kept].astype(np.float32)
        for k in range(0, len(n), 4096):
            out += n[k:k + 4096] @ self._bound(*(x[k:k + 4096] for x in rest)).astype(np.float32)
        return out

    def rows(self, codes: np.ndarray) -> np.ndarray:
        new = codes[self.known[codes] < 0]
        if len(new):
            made = self._bound(new // _KNOWN ** 2, new // _KNOWN % _KNOWN, new % _KNOWN)
            while self.n + len(new) > len(self.vectors):
                self.vectors = np.concatenate([self.vectors, np.zeros_like(self.vectors)])
            self.vectors[self.n:self.n + len(new)] = made
            self.known[new] = np.arange(self.n, self.n + len(new))
            self.n += len(new)
        return self.vectors[self.known[codes]]

    def bundle(self, text: str | None) -> np.ndarray | None:
        """The text's vector, or None without letters."""
        codes, counts = trigram_counts(text)
        if not len(codes):
            return None
        return self.total(codes, counts)


def space(dims: int, seed: int) -> Space:
    return held(("space", dims, seed), lambda: Space(dims, seed))


#: A training text's unit vector is rounded to this many steps, so that sums are whole numbers and exact in any order.
_STEPS = 1 << 20


def learn_languages(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", where: Column | None = None,
                    dims: int = 512, seed: int = 11, most: int = 500) -> dict[str, np.ndarray]:
    """A unit prototype for each language of the rows that ``where`` keeps.
    Null languages and texts without letters teach nothing.  Each task sends one
    vector for each language it met; their sum has ``dims`` numbers a language,
    and more than ``most`` languages are an error."""
    rows = picked(docs if where is None else docs.where(where), text=text_col, lang=lang_col)
    rows = rows.select(F.col("text").cast("string"), F.col("lang").cast("string")).where("lang IS NOT NULL")

    def run(batches):
        sp, sums = space(dims, seed), {}
        for b in parts_of(batches):
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                v = sp.bundle(text)
                if v is not None and (norm := np.linalg.norm(v)):
                    unit = np.rint(v / norm * _STEPS).astype(np.int64)
                    sums[lang] = sums[lang] + unit if lang in sums else unit
        for lang, v in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * dims), pa.array(range(dims), pa.int32()), pa.array(v)],
                                             names=["lang", "at", "value"])

    total = rows.mapInArrow(run, "lang string, at int, value bigint").groupBy("lang", "at").agg(
        F.sum(F.col("value").cast("decimal(38,0)")).cast("double").alias("value"))
    got = total.limit((most + 1) * dims).collect()
    out: dict[str, np.ndarray] = {}
    for r in got:
        out.setdefault(r["lang"], np.zeros(dims))[r["at"]] = r["value"]
    if len(out) > most:
        raise ValueError(f"more than {most} languages")
    return {k: v / (np.linalg.norm(v) or 1.0) for k, v in sorted(out.items())}


def predict_languages(docs: DataFrame, prototypes: dict[str, np.ndarray], text_col: str = "text", lang_as: str = "lang_pred",
                      score_as: str = "score", dims: int = 512, seed: int = 11) -> DataFrame:
    """``docs`` with the predicted language and its cosine (0 to 1; negative
    ones count as 0).  ``und`` with score 0 for a null text or one without a
    letter, and for all texts if nothing was learned.  Ties go to the first
    language by name.  All rows and columns stay; columns of the result's names
    are replaced.  One map over the rows; whole texts."""
    kept = [k for k, c in enumerate(docs.columns) if c not in (lang_as, score_as)]
    docs = numbered(docs).select(*(f"c{k}" for k in kept)).toDF(*(docs.columns[k] for k in kept))
    names, at = list(prototypes), docs.columns.index(text_col)
    matrix = np.array([prototypes[k] for k in names], np.float32).reshape(-1, dims)

    def run(batches):
        sp = space(dims, seed)
        for b in parts_of(batches):
            langs, scores = [], []
            for text in b.column(at).to_pylist():
                v = sp.bundle(text) if names else None
                if v is None:
                    langs.append("und")
                    scores.append(0.0)
                    continue
                cos = matrix @ v / (np.linalg.norm(v) or 1.0)
                k = int(np.argmax(cos))
                langs.append(names[k])
                scores.append(min(1.0, max(0.0, float(cos[k]))))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                                             names=[str(k) for k in range(b.num_columns + 2)])

    plain = docs.toDF(*map(str, range(len(docs.columns))))
    n = len(docs.columns)
    schema = T.StructType([*plain.schema, T.StructField(str(n), T.StringType()), T.StructField(str(n + 1), T.DoubleType())])
    return plain.mapInArrow(run, schema).toDF(*docs.columns, lang_as, score_as)
