"""Toxicity by a weighted lexicon matched with Aho-Corasick.

Texts are folded first: lower case, look-alike letters of other scripts to
Latin ones, invisible characters away, digits and signs that stand for
letters inside words to those letters, everything else between words to
blanks.  The lexicon holds word beginnings (stems) and whole words with
log-odds weights, learned from labelled rows.  Matches inside an exception
phrase do not count.  A text's evidence, in total and by length, becomes a
probability by logistic calibration on the same rows.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import held, id_text, id_text_batches, one_of_each, stored

# Letters of other scripts that look like Latin ones.
LOOKALIKES = {
    "а": "a", "в": "b", "с": "c", "ԁ": "d", "е": "e", "һ": "h", "і": "i", "ј": "j", "к": "k", "ӏ": "l", "м": "m", "о": "o",
    "р": "p", "ѕ": "s", "т": "t", "у": "y", "х": "x", "ԝ": "w", "α": "a", "β": "b", "ε": "e", "η": "n", "ι": "i", "κ": "k",
    "ν": "v", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "χ": "x", "γ": "y", "ω": "w", "ı": "i", "ɑ": "a", "ɡ": "g", "ℓ": "l",
}
INVISIBLE = "­​‌‍⁠﻿"
DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t"}
SIGNS = {"@": "a", "$": "s", "!": "i", "|": "l"}
#: Harmless phrases around words that a lexicon may hold.
EXCEPTIONS = ("trash can", "trash bag", "trash bin", "clown fish", "lost and found")


class _Fold(dict):
    def __missing__(self, c: int) -> int:
        ch = chr(c)
        if 0xFF01 <= c <= 0xFF5E:
            self[c] = ord(chr(c - 0xFEE0).lower().translate(self))
        else:
            self[c] = c if ch.isalnum() else 32
        return self[c]


_FOLD = _Fold({ord(k): ord(v) for k, v in {**LOOKALIKES, **DIGITS}.items()} | dict.fromkeys(map(ord, INVISIBLE)))
_SIGN = re.compile(r"(?<![@$!|])[@$!|](?=[^\W\d_])|(?<=[^\W\d_])[@$!|](?=[^\W_])")
_HAS_SIGN = re.compile(r"[@$!|]")


def fold(text: str | None) -> str:
    """The folded text, words between single or several blanks, one at either end."""
    if not text:
        return " "
    if _HAS_SIGN.search(text):
        text = _SIGN.sub(lambda m: SIGNS[m[0]], text)
    return f" {text.lower().translate(_FOLD)} "


@dataclass(frozen=True)
class Lexicon:
    """``terms``: folded term (" stem" or " word ") to weight; ``exceptions``:
    folded phrases; ``calibration``: bias and slopes for total and density."""

    terms: tuple[tuple[str, float], ...]
    exceptions: tuple[str, ...]
    calibration: tuple[float, float, float] = (-4.0, 1.0, 1.0)


class Matcher:
    def __init__(self, lexicon: Lexicon):
        self.machine = ahocorasick.Automaton()
        for term, weight in lexicon.terms:
            self.machine.add_word(term, (len(term), weight))
        for phrase in lexicon.exceptions:
            self.machine.add_word(phrase, (len(phrase), None))
        if len(self.machine):
            self.machine.make_automaton()
        self.bias, self.total, self.dense = lexicon.calibration

    def matches(self, folded: str) -> list[tuple[int, float]]:
        """(start, weight), the weightiest term at each word, without those inside exceptions."""
        if not len(self.machine):
            return []
        best, spared = {}, []
        for end, (n, weight) in self.machine.iter(folded):
            start = end - n + 1
            if weight is None:
                spared.append((start, end))
            else:
                best[start] = max(weight, best.get(start, 0.0))
        out, spared, k, reach = [], sorted(spared), 0, 0
        for s, w in sorted(best.items()):  # both in order: one sweep
            while k < len(spared) and spared[k][0] <= s:
                reach, k = max(reach, spared[k][1]), k + 1
            if s >= reach:
                out.append((s, w))
        return out

    def evidence(self, text: str | None) -> tuple[float, float]:
        """Log of the matched weight, and of the matched weight for each 100 words."""
        folded = fold(text)
        found = self.matches(folded)
        if not found:
            return 0.0, 0.0
        weight = sum(w for _, w in found)
        return math.log1p(weight), math.log1p(100 * weight / (len(folded.split()) + 10))

    def score(self, text: str | None) -> float:
        a, b = self.evidence(text)
        z = self.bias + self.total * a + self.dense * b
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def matcher(lexicon: Lexicon) -> Matcher:
    return held(("matcher", lexicon), lambda: Matcher(lexicon))


# ------------------------------------------------------------------ learning
def _terms_of(text: str | None, short: int, long: int) -> set[str]:
    words = set(fold(text).split())
    return {f" {w} " for w in words if len(w) > 2} | {f" {w[:n]}" for w in words for n in range(short, min(long, len(w)) + 1)}


def _sketch(text: str | None) -> str:
    """The two smallest hashes of a text's three-word runs: near copies mostly share them."""
    w = fold(text).split()
    return " ".join(f"{h:x}" for h in heapq.nsmallest(2, {xxhash.xxh3_64_intdigest(" ".join(w[k:k + 3])) for k in range(max(1, len(w) - 2))}))


def learn_lexicon(docs: DataFrame, labels: DataFrame, where: Column | None = None, label_col: str = "toxic", id_col: str = "doc_id",
                  text_col: str = "text", sample: int = 12_000, support: int = 10, odds: float = 2.0, most: int = 5_000,
                  short: int = 4, long: int = 10, exceptions: tuple[str, ...] = EXCEPTIONS) -> Lexicon:
    """Lexicon and calibration from at most ``sample`` labelled rows (those with
    the smallest key hashes among rows that ``where``, over the labels, keeps).
    Rows of one key count once, as do near copies: the row with the smallest
    text hash, then the smallest key.  A term needs ``support`` toxic rows and
    log-odds of ``odds``; a term whose beginning already is one is left out, and
    a beginning that nearly always goes on in one way is taken that far; at most
    ``most`` terms stay.  Null labels are left out; without any labelled row
    the lexicon is empty and every score is the same low one."""
    keys = labels.select(F.col(id_col).cast("bigint").alias("key"), F.col(label_col).cast("int").alias("label"),
                         *([] if where is None else [where.alias("use")]))
    keys = (keys if where is None else keys.where("use").drop("use")).where("label IS NOT NULL AND key IS NOT NULL")
    keys = keys.orderBy(F.xxhash64("key"), "key").limit(sample)
    rows = id_text(docs, id_col, text_col).join(F.broadcast(keys), F.col("doc_id") == F.col("key")).select("doc_id", "text", "label")
    rows = one_of_each(rows, ["doc_id", "label"], [F.xxhash64("text"), F.col("text")])

    def sketched(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([_sketch(t) for t in b.column(1).to_pylist()], pa.string())],
                                             names=["doc_id", "text", "label", "sketch"])

    rows = one_of_each(rows.mapInArrow(sketched, "doc_id bigint, text string, label int, sketch string"), ["label", "sketch"], [F.col("doc_id")])
    rows = stored(rows.select("text", "label"), "labelled")

    def count(batches):
        seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
        n = [0, 0]
        for b in batches:
            for text, label in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                seen[int(label == 1)].update(_terms_of(text, short, long))
                n[int(label == 1)] += 1
        seen[0][""], seen[1][""] = n
        terms = [t for t in seen[0].keys() | seen[1].keys()]
        yield pa.RecordBatch.from_arrays([pa.array(terms, pa.string()), pa.array([seen[0][t] for t in terms], pa.int64()),
                                          pa.array([seen[1][t] for t in terms], pa.int64())], names=["term", "clean", "toxic"])

    table = stored(rows.mapInArrow(count, "term string, clean bigint, toxic bigint").groupBy("term").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).where((F.col("toxic") >= support) | (F.col("term") == "")), "terms")
    total = table.where("term = ''").first()
    n0, n1 = (total["clean"], total["toxic"]) if total else (0, 0)
    weight = F.log((F.col("toxic") + 0.5) / (n1 + 1)) - F.log((F.col("clean") + 0.5) / (n0 + 1))
    picked = table.where("term <> ''").withColumn("weight", weight).where(F.col("weight") >= odds)
    got = {r["term"]: (r["toxic"], r["weight"]) for r in picked.orderBy(F.desc("toxic"), "term").limit(most).collect()}
    chosen: dict[str, float] = {}
    for term in sorted(got, key=lambda t: (len(t), t)):
        if not any(term[:n] in chosen for n in range(short + 1, len(term))):
            chosen[term] = got[term][1]
    longer: dict[str, list[str]] = {}
    for term in got:
        longer.setdefault(term[:-1], []).append(term)
    for term in list(chosen):  # the longest beginning that the same rows share
        stem = term
        while best := max((t for t in longer.get(stem, []) if t[-1] != " " and got[t][0] >= 0.98 * got[term][0]), key=lambda t: (got[t][0], t), default=None):
            stem = best
        del chosen[term]
        chosen[stem] = got[stem][1]
    kept = tuple(f" {' '.join(fold(p).split())} " for p in exceptions)
    return calibrated(Lexicon(tuple(sorted(chosen.items())), kept), rows)


def calibrated(lexicon: Lexicon, rows: DataFrame) -> Lexicon:
    """The lexicon with a logistic fit of the evidence of at most ``sample``
    labelled rows: two numbers and a label of each reach the driver."""

    def run(batches):
        m = matcher(lexicon)
        for b in batches:
            x = [m.evidence(t) for t in b.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([v[0] for v in x], pa.float64()), pa.array([v[1] for v in x], pa.float64()),
                                              pa.array([float(v == 1) for v in b.column(1).to_pylist()], pa.float64())], names=["a", "b", "y"])

    got = rows.mapInArrow(run, "a double, b double, y double").toPandas().to_numpy(float)
    if not len(got):
        return lexicon
    got = got[np.lexsort(got.T)]  # sums in one order, whatever order the rows came in
    x, y = np.column_stack([np.ones(len(got)), got[:, :2]]), got[:, 2]
    w, ridge = np.zeros(3), np.diag([1e-3, 0.1, 0.1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return Lexicon(lexicon.terms, lexicon.exceptions, tuple(round(float(v), 9) for v in w))


def score_toxicity(docs: DataFrame, lexicon: Lexicon, threshold: float = 0.3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, score (0 to 1), predicted (1 if
    the score reaches ``threshold``).  Null and empty texts get the
    score of no evidence; repeated rows repeated results; whole texts; other
    columns are not read; a map over the rows, no shuffle."""

    def run(batches):
        m = matcher(lexicon)
        for ids, texts in id_text_batches(batches):
            scores = [m.score(t) for t in texts]
            yield pa.RecordBatch.from_arrays([ids, pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32())],
                                             names=["doc_id", "score", "predicted"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, score double, predicted int")
