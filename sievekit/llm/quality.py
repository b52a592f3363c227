"""Quality classifier: ordinal regression with cumulative links on graded ratings.

A text becomes hashed features (words, word shapes, layout).  All grades
share one weight vector w; ordered thresholds t_1 < t_2 < ... separate them:
P(grade >= k) = logistic(w.x - t_k).  This gives an expected grade and, for
selection, the probability of the upper tail.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held, id_text, id_text_batches, one_of_each

_ENDS = str.maketrans("", "", ".,;:!?\"'()[]")


def _shape(word: str) -> str:
    core = word.translate(_ENDS)
    if core.isalpha():
        kind = "a" if core.islower() else "A" if core.isupper() and len(core) > 1 else "Aa" if core[0].isupper() else "aA"
    elif core.isdigit():
        kind = "0"
    else:
        kind = "mixed" if any(c.isalnum() for c in core) else "sign" if core else "stop"
    return kind + "!" * ("!" in word)


class Features:
    """Hashed features, with the slots of known words remembered up to a limit."""

    def __init__(self, bits: int, limit: int = 200_000):
        self.size, self.limit, self.known = 1 << bits, limit, {}

    def slot(self, name: str) -> int:
        return xxhash.xxh3_64_intdigest(name) % self.size

    def of_word(self, word: str) -> tuple[int, int]:
        if len(self.known) > self.limit:
            self.known.clear()
        got = self.known[word] = self.slot("w " + word.lower().translate(_ENDS)), self.slot("s " + _shape(word))
        return got

    def row(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        """Sorted slots and their values; the constant feature alone for an empty text."""
        words = (text or "").split()
        n = len(words)
        if not n:
            at = np.array([self.slot("empty")])
            return at, np.ones(1)
        pairs = [self.known.get(w) or self.of_word(w) for w in words]
        at = np.array(pairs, np.int64)
        # words: damped counts, unit length; shapes: shares
        w_at, w_n = np.unique(at[:, 0], return_counts=True)
        w_x = np.log1p(w_n)
        w_x /= np.linalg.norm(w_x)
        s_at, s_n = np.unique(at[:, 1], return_counts=True)
        lines = text.split("\n")
        again = sum(a == b for a, b in zip(words, words[1:])) / n
        extra = {"distinct words": len(w_at) / n, "repeated next": again, "repeated lines": 1 - len(set(lines)) / len(lines),
                 "log words": np.log1p(n) / 10, "word length": min(2.0, len(text) / n / 8)}
        slots = np.concatenate([w_at, s_at, [self.slot("x " + k) for k in extra]])
        values = np.concatenate([w_x, 2 * s_n / n, 2 * np.array(list(extra.values()))])
        u, back = np.unique(slots, return_inverse=True)
        return u, np.bincount(back, values)




def features(bits: int) -> Features:
    return held(("features", bits), lambda: Features(bits))


@dataclass
class Ordinal:
    """Shared weights over hashed features and ascending thresholds; grades are 0 .. len(thresholds)."""

    bits: int
    weights: np.ndarray
    thresholds: np.ndarray

    def tails(self, z: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1 .. of each linear score."""
        return 1 / (1 + np.exp(-np.clip(z[:, None] - self.thresholds, -30, 30)))


def fit_ordinal(rows: list[tuple[np.ndarray, np.ndarray]], grades: np.ndarray, n_grades: int, bits: int,
                rounds: int = 300, rate: float = 0.05, ridge: float = 1e-4) -> Ordinal:
    """Maximum likelihood by Adam over all given rows; thresholds stay ordered
    because their gaps are exponentials."""
    at = np.concatenate([r[0] for r in rows])
    x = np.concatenate([r[1] for r in rows])
    owner = np.repeat(np.arange(len(rows)), [len(r[0]) for r in rows])
    slots, at = np.unique(at, return_inverse=True)
    n, k = len(rows), n_grades - 1
    share = np.clip([np.mean(grades >= g) for g in range(1, n_grades)], 1e-3, 1 - 1e-3)
    start = np.maximum.accumulate(-np.log(share / (1 - share)) + 1e-3 * np.arange(k))
    p = np.concatenate([np.zeros(len(slots)), start[:1], np.log(np.maximum(np.diff(start), 1e-2))])
    m, v = np.zeros_like(p), np.zeros_like(p)
    edge = lambda z: 1 / (1 + np.exp(-np.clip(z, -30, 30)))
    for step in range(1, rounds + 1):
        w, gaps = p[:len(slots)], np.exp(p[len(slots) + 1:])
        t = p[len(slots)] + np.concatenate([[0], np.cumsum(gaps)])
        z = np.bincount(owner, w[at] * x, n)
        tails = np.column_stack([np.ones(n), edge(z[:, None] - t), np.zeros(n)])
        upper, lower = tails[np.arange(n), grades], tails[np.arange(n), grades + 1]
        mass = np.maximum(upper - lower, 1e-9)
        du, dl = upper * (1 - upper) / mass, lower * (1 - lower) / mass
        dz = (du - dl) / n
        dt = np.bincount(grades, -du, n_grades)[1:] / n + np.bincount(grades, dl, n_grades)[:-1] / n
        tail_sums = np.cumsum(dt[::-1])[::-1]
        g = -np.concatenate([np.bincount(at, dz[owner] * x, len(slots)), tail_sums[:1], tail_sums[1:] * gaps])
        g[:len(slots)] += ridge * w
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        p = p - rate * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    weights = np.zeros(1 << bits)
    weights[slots] = p[:len(slots)]
    return Ordinal(bits, weights, p[len(slots)] + np.concatenate([[0], np.cumsum(np.exp(p[len(slots) + 1:]))]))


def learn_quality(docs: DataFrame, ratings: DataFrame, n_grades: int, where: Column | None = None, grade_col: str = "grade",
                  id_col: str = "doc_id", text_col: str = "text", sample: int = 6_000, bits: int = 16) -> Ordinal:
    """Fit on at most ``sample`` rated rows: those with the smallest key hashes
    among rows that ``where`` keeps.  Rows of one key count once (the smallest
    text hash), so that the bound holds for what is joined.  Only their hashed features reach the
    driver.  Null ratings or keys are left out; a rating outside 0 ..
    ``n_grades`` - 1 is an error; without any rated row all grades are equally
    likely."""
    keys = ratings.select(F.col(id_col).cast("bigint").alias("key"), F.col(grade_col).cast("int").alias("grade"),
                          *([] if where is None else [where.alias("use")]))
    keys = (keys if where is None else keys.where("use").drop("use")).where("key IS NOT NULL AND grade IS NOT NULL")
    keys = keys.orderBy(F.xxhash64("key"), "key", "grade").limit(sample)
    rated = id_text(docs, id_col, text_col).join(F.broadcast(keys), F.col("doc_id") == F.col("key")).select("doc_id", "text", "grade")
    rated = one_of_each(rated, ["doc_id", "grade"], [F.xxhash64("text"), F.col("text")])

    def run(batches):
        f = features(bits)
        for b in batches:
            rows = [f.row(t) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array([r[0].astype(np.int32) for r in rows], pa.list_(pa.int32())),
                                              pa.array([r[1].astype(np.float32) for r in rows], pa.list_(pa.float32()))], names=["doc_id", "grade", "at", "x"])

    got = rated.mapInArrow(run, "doc_id bigint, grade int, at array<int>, x array<float>").toArrow().sort_by([("doc_id", "ascending"), ("grade", "ascending")])
    grades = got["grade"].to_numpy()
    if not len(grades):
        return Ordinal(bits, np.zeros(1 << bits), -np.log(np.arange(n_grades - 1, 0, -1) / np.arange(1, n_grades)))
    if grades.min() < 0 or grades.max() >= n_grades:
        raise ValueError(f"ratings must be 0 to {n_grades - 1}")
    lists = [[x.values.to_numpy() for x in got[c]] for c in ("at", "x")]
    return fit_ordinal([(a.astype(np.int64), x.astype(float)) for a, x in zip(*lists)], grades, n_grades, bits)


def score_quality(docs: DataFrame, model: Ordinal, at_least: int, select: float = 0.5, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, expected_grade, grade (most
    likely; the lower of equals), tail (P(grade >= ``at_least``)), selected (tail
    reaches ``select``).  Null texts count as empty; repeated rows give repeated
    results; whole texts; other columns are not read; a map, no shuffle."""
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast(model)

    def run(batches):
        m, f = held.value, features(held.value.bits)
        for ids, texts in id_text_batches(batches):
            rows = [f.row(t) for t in texts]
            z = np.array([m.weights[a] @ x for a, x in rows])
            tails = m.tails(z)
            edges = np.column_stack([np.ones(len(z)), tails, np.zeros(len(z))])
            tail = edges[:, at_least]
            yield pa.RecordBatch.from_arrays([ids, pa.array(tails.sum(axis=1)), pa.array(np.argmax(edges[:, :-1] - edges[:, 1:], axis=1), pa.int32()),
                                              pa.array(tail), pa.array(tail >= select)], names=["doc_id", "expected_grade", "grade", "tail", "selected"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, expected_grade double, grade int, tail double, selected boolean")
