"""DuckDB SQL fragments that mirror the native column expressions, used by
the oracle queries in ``__spark_entry__``.  They restate the same rules in
a second engine so results can be compared value for value: float
literals are cast to DOUBLE (DuckDB reads ``0.5`` as DECIMAL), integer
truncation uses ``trunc`` (DuckDB's cast rounds), counts are cast to
BIGINT (DuckDB counts as HUGEINT)."""

from __future__ import annotations

from collections.abc import Sequence



def d(x) -> str:
    """A DOUBLE literal."""
    return f"CAST({float(x)!r} AS DOUBLE)"


def tokens_sql(col: str) -> str:
    return f"list_filter(regexp_split_to_array(lower({col}), '[ \\t\\n\\r]+'), lambda x: x <> '')"


def token_hashes_sql(tok: str) -> str:
    return f"list_transform({tok}, lambda t: CAST(('0x' || substr(md5(t), 1, 8)) AS BIGINT))"


def _run_sql(width: int, start: int, factor: int, prime: int) -> str:
    v = f"CAST({start} AS BIGINT)"
    for j in range(width):
        v = f"(({v} * {factor} + h[i + {j}]) % {prime})"
    return v


def fingerprint_sql(hashes: str, radius: int, n_bits: int | None) -> str:
    """Fingerprint of a column of token hashes named ``h`` (a list of bigint)."""
    assert hashes == "h"
    parts, kind = [], "INTEGER" if n_bits else "BIGINT"
    for k in range(radius + 1):
        width = 2 * k + 1
        if n_bits:
            one = f"CAST({_run_sql(width, k, 1103515245, 2147483647)} % {n_bits} AS INTEGER)"
        else:
            one = f"{_run_sql(width, k, 1103515245, 1073741789)} * 1073741824 + {_run_sql(width, k, 69069, 1073741783)}"
        parts.append(f"CASE WHEN len(h) >= {width} THEN list_transform(range(1, len(h) - {2 * k} + 1), lambda i: {one}) "
                     f"ELSE CAST([] AS {kind}[]) END")
    return f"CASE WHEN h IS NULL THEN NULL ELSE list_sort(list_distinct(flatten([{', '.join(parts)}]))) END"


def unit_hash_sql(key: str, seed: int) -> str:
    return (f"(CAST(('0x' || substr(md5('{seed}:' || CAST({key} AS VARCHAR)), 1, 8)) AS BIGINT) "
            f"/ {d(4294967296.0)})")


def split_sql(key: str, fractions: Sequence[float] = (0.7, 0.15, 0.15),
              names: Sequence[str] = ("train", "val", "test"), seed: int = 42) -> str:
    u = unit_hash_sql(key, seed)
    cuts = [sum(fractions[:k + 1]) for k in range(len(fractions) - 1)]
    whens = " ".join(f"WHEN {u} < {d(c)} THEN '{n}'" for c, n in zip(cuts, names))
    return f"CASE {whens} ELSE '{names[-1]}' END"


def _clip(x: str, lo, hi) -> str:
    return f"CASE WHEN ({x}) IS NULL THEN NULL ELSE least(greatest({x}, {d(lo)}), {d(hi)}) END"


def descriptors_sql(col: str, prefix: str = "") -> str:
    """SELECT-list of the text descriptors."""
    n, toks = f"length({col})", tokens_sql(col)
    lines = f"string_split({col}, chr(10))"

    def share(part, whole):
        return f"CASE WHEN {col} IS NULL THEN NULL WHEN {whole} = 0 THEN {d(0)} ELSE CAST({part} AS DOUBLE) / {whole} END"

    def only(klass):
        return f"length(regexp_replace({col}, '[^{klass}]', '', 'g'))"

    props = {"n_chars": f"CAST({n} AS INTEGER)", "n_tokens": f"CAST(len({toks}) AS INTEGER)",
             "distinct_token_share": share(f"len(list_distinct({toks}))", f"len({toks})"),
             "digit_share": share(only("0-9"), n), "upper_share": share(only("A-Z"), n),
             "punct_share": share(only("!-/:-@\\[-`{-~"), n),
             "repeated_line_share": f"{d(1)} - CAST(len(list_distinct({lines})) AS DOUBLE) / len({lines})"}
    return ", ".join(f"{v} AS {prefix}{k}" for k, v in props.items())


def weighted_score_sql(terms: Sequence[tuple[str, float]], threshold: float = 0.5,
                       score: str = "score", label: str = "label", digits: int = 4, noise: str | None = None) -> str:
    raw = d(0.0)
    for cond, w in terms:
        raw = f"({raw} + CASE WHEN {cond} THEN {d(w)} ELSE {d(0.0)} END)"
    raw = raw if noise is None else f"({raw} + {noise})"
    c = _clip(raw, 0.0, 1.0)
    return f"({c}) > {d(threshold)} AS {label}, round_even({c}, {digits}) AS {score}"


def linear_score_sql(terms, intercept, bounds, out: str, digits: int = 2) -> str:
    x = d(intercept)
    for coef, col, centre in terms:
        x = f"({x} + {d(coef)} * ({col} - {centre}))"
    return f"round_even({_clip(x, *bounds)}, {digits}) AS {out}"
