"""Hashed token fingerprints and related column expressions.

A fingerprint is the sorted array of set-bit positions (``array<int>``),
never a dense 0/1 vector: a 2,048- or 2^20-wide dense array per row costs
memory and shuffle bytes for zeros.  ``dense_fingerprint`` produces the
dense form only on request.

The circular fingerprint here is the table-job analogue of a Morgan
fingerprint over a token sequence: the environment of radius ``k`` around
token ``i`` is the window ``tokens[i-k .. i+k]``; every environment with
``0 <= k <= radius`` that fits inside the sequence is hashed and folded to
``n_bits``.  It is not chemically equal to any RDKit output."""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from .tokens import _c

# The portable token hash is the first 8 hex digits of md5, the
# only hash that both Spark and DuckDB (the oracle) compute identically.  A
# window's hash runs over its tokens' integers by v = (v * factor + h) mod prime;
# products stay below 2**62.
MD5_HEX_DIGITS = 8
FOLDED = (1103515245, 2147483647)
UNFOLDED = ((1103515245, 1073741789), (69069, 1073741783))
#: Tokens whose windows are held at once.
MOST_TOKENS = 1 << 18


def token_hashes(toks: pa.StringArray) -> np.ndarray:
    """One integer below 2**32 for each token; a distinct token is hashed once
    a call.  Null tokens give 0."""
    coded = toks.dictionary_encode()
    digests = (hashlib.md5(t.encode(), usedforsecurity=False).digest() for t in coded.dictionary.to_pylist())
    known = np.fromiter((int.from_bytes(x[:MD5_HEX_DIGITS // 2], "big") for x in digests), np.uint64, len(coded.dictionary))
    return np.append(known, np.uint64(0))[coded.indices.fill_null(len(known)).to_numpy()]


def _run(h: np.ndarray, width: int, start: int, factor: int, prime: int) -> np.ndarray:
    n = max(0, len(h) - width + 1)
    v = np.full(n, start, np.uint64)
    for j in range(width):
        v *= np.uint64(factor)
        v += h[j:j + n]
        v %= np.uint64(prime)
    return v


def _window_hashes(h: np.ndarray, k: int, n_bits: int | None) -> np.ndarray:
    """Hashes of every radius-``k`` window of an array of token hashes, also of
    windows that reach from one row into the next."""
    width = 2 * k + 1
    if n_bits is not None:
        return (_run(h, width, k, *FOLDED) % np.uint64(n_bits)).astype(np.int64)
    hi, lo = (_run(h, width, k, *fp).astype(np.int64) for fp in UNFOLDED)
    return hi * (1 << 30) + lo


def _row_bits(h: np.ndarray, known: np.ndarray | None, ends: list[int], nulls: list[bool], radius: int,
              n_bits: int | None) -> list[np.ndarray | list | None]:
    """Set bits of each row: token hashes of rows that follow each other, which
    tokens are not null (None: all), the rows' ends and which rows are null."""
    windows = [_window_hashes(h, k, n_bits) for k in range(radius + 1)]
    out, at = [], 0
    for end, null in zip(ends, nulls):
        spans = [slice(at, max(at, end - 2 * k)) for k in range(radius + 1)]
        bits = [w[s] for w, s in zip(windows, spans)]
        if known is not None and not known[at:end].all():  # a window with a null token has a null hash, listed last
            whole = [np.array([known[i:i + 2 * k + 1].all() for i in range(s.start, s.stop)], bool) for k, s in enumerate(spans)]
            out.append([*np.unique(np.concatenate([b[w] for b, w in zip(bits, whole)])).tolist(), None])
        else:
            out.append(None if null else np.unique(np.concatenate(bits)))
        at = end
    return out


def _fingerprints(toks: pa.ListArray, radius: int, n_bits: int | None) -> pa.Array:
    """Windows of rows of about ``MOST_TOKENS`` tokens at once, to bound what is held."""
    kind = pa.list_(pa.int32() if n_bits is not None else pa.int64())
    flat, nulls = toks.flatten(), toks.is_null().to_pylist()
    h, known = token_hashes(flat), None if flat.null_count == 0 else flat.is_valid().to_numpy(zero_copy_only=False)
    ends = np.cumsum(toks.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
    parts, at, start = [], 0, 0
    while at < len(toks):
        upto = max(at + 1, int(np.searchsorted(ends, start + MOST_TOKENS, "right")))
        some = slice(start, int(ends[upto - 1]))
        rows = _row_bits(h[some], known if known is None else known[some], (ends[at:upto] - start).tolist(), nulls[at:upto], radius, n_bits)
        parts.append(pa.array(rows, kind))
        at, start = upto, some.stop
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


def hashed_fingerprint(toks, radius: int = 2, n_bits: int | None = 2048) -> Column:
    """Sorted set-bit positions of the circular token fingerprint; with
    ``n_bits=None`` the windows' unfolded 60-bit hashes, whose number of
    distinct values grows with the data (``array<bigint>``).

    A map over Arrow batches of the token arrays: a batch's distinct tokens are
    hashed once each, and windows combine the integers for all rows at once.
    Null tokens give null; an empty token array gives an empty array.  Write
    fingerprints that are filtered or read more than once."""
    if radius < 0 or (n_bits is not None and n_bits <= 0):
        raise ValueError("radius must be >= 0 and n_bits > 0")

    @F.arrow_udf(f"array<{'int' if n_bits is not None else 'bigint'}>")
    def bits(toks: pa.Array) -> pa.Array:
        return _fingerprints(toks, radius, n_bits)

    return bits(_c(toks))


def explode_bits(bits) -> Column:
    """``explode_outer`` of a bit array; filter the output column for null.

    Plain ``explode`` makes Catalyst infer ``size(bits) > 0`` and push it
    below projections and repartitions, which re-evaluates an expensive
    fingerprint expression where the filter lands (possibly one task)."""
    return F.explode_outer(_c(bits))


def sign_bits(vec) -> Column:
    """Positions (0-based) of the strictly positive entries of a numeric
    array: a dense embedding turned into a set-bit fingerprint."""
    v = _c(vec)
    n = F.size(v)
    idx = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    pos = F.filter(idx, lambda i: F.element_at(v, i + 1) > 0)
    return F.when(v.isNull(), F.lit(None).cast("array<int>")).otherwise(pos)


def dense_fingerprint(bits, n_bits: int) -> Column:
    """0/1 array of length ``n_bits`` from set-bit positions."""
    b = _c(bits)
    # runs of zeros between the sorted bits: linear in n_bits
    ends = F.concat(b, F.array(F.lit(n_bits)))
    gaps = F.transform(ends, lambda e, i: F.concat(
        F.array_repeat(F.lit(0), F.when(i == 0, e).otherwise(e - F.get(ends, i - 1) - 1).cast("int")),
        F.when(e < n_bits, F.array(F.lit(1))).otherwise(F.array().cast("array<int>"))))
    return F.when(b.isNull(), F.lit(None).cast("array<int>")).otherwise(F.flatten(gaps))


def pattern_keys(text, patterns: list[str]) -> Column:
    """One 0/1 key per regex pattern (a structural-key fingerprint whose
    pattern list the user supplies).  Null text gives null."""
    s = _c(text)
    keys = F.array(*[s.rlike(p).cast("int") for p in patterns])
    return F.when(s.isNull(), F.lit(None).cast("array<int>")).otherwise(keys)


def token_matches(toks, pattern: list[str]) -> Column:
    """Every occurrence of a token sequence: an array of index arrays
    (0-based token positions), empty if none, null for null tokens."""
    if not pattern:
        raise ValueError("pattern must have at least one token")
    t = _c(toks)
    m = len(pattern)
    n = F.size(t)
    starts = F.when(n >= m, F.sequence(F.lit(1), n - m + 1)) \
              .otherwise(F.array().cast("array<int>"))
    first = F.lit(pattern[0])
    want = F.array(*[F.lit(p) for p in pattern])
    hits = F.filter(starts, lambda i: (F.element_at(t, i) == first)
                    & (F.slice(t, i, m) == want))
    idx = F.transform(hits, lambda i: F.sequence(i - 1, i + m - 2))
    return F.when(t.isNull(), F.lit(None).cast("array<array<int>>")).otherwise(idx)


def tanimoto(a, b) -> Column:
    """|a & b| / |a | b| over set-bit arrays; both empty gives 0.0."""
    a, b = _c(a), _c(b)
    x = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - x
    sim = F.when(union == 0, F.lit(0.0)).otherwise(x / union)
    return F.when(a.isNull() | b.isNull(), F.lit(None).cast("double")).otherwise(sim)


def dice(a, b) -> Column:
    """2 |a & b| / (|a| + |b|); both empty gives 0.0."""
    a, b = _c(a), _c(b)
    x = F.size(F.array_intersect(a, b))
    tot = F.size(a) + F.size(b)
    sim = F.when(tot == 0, F.lit(0.0)).otherwise(2 * x / tot)
    return F.when(a.isNull() | b.isNull(), F.lit(None).cast("double")).otherwise(sim)


SIMILARITY = {"tanimoto": tanimoto, "dice": dice}


def similarity(a, b, method: str = "tanimoto") -> Column:
    try:
        return SIMILARITY[method](a, b)
    except KeyError:
        raise ValueError(f"unknown similarity method {method!r}; "
                         f"use one of {sorted(SIMILARITY)}") from None


def with_fingerprint(df, text_col: str, out: str = "bits", radius: int = 2, n_bits: int | None = 2048,
                     pattern: str | None = None, keep_tokens: bool = False, lowercase: bool = True,
                     partitions: int | None = None):
    """Add ``out``: tokens are projected once into a column, then hashed.  With
    ``lowercase=False`` tokens differ by case.  ``partitions`` deals the rows of
    a table with few splits first."""
    from ..session import with_partitions
    from .tokens import tokens
    tmp = "_tokens" if not keep_tokens else "tokens"
    x = with_partitions(df, partitions).withColumn(tmp, tokens(text_col, pattern, lowercase))
    x = x.withColumn(out, hashed_fingerprint(F.col(tmp), radius, n_bits))
    return x if keep_tokens else x.drop(tmp)
