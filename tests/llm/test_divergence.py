import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa

from sievekit.llm import divergence
from sievekit.llm.divergence import divergence_audit, term_counts

TERM = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(rows, ranks=200):
    """Plain dictionaries over (lang, source, text) rows."""
    rows = [(a or "", b or "", terms_of(t)) for a, b, t in rows]
    out = []
    for lang in {r[0] for r in rows}:
        texts = Counter(t for a, _, w in rows if a == lang for t in set(w))
        kept = [t for t, n in texts.items() if n >= 3]
        groups = {b: Counter() for a, b, _ in rows if a == lang}
        for a, b, w in rows:
            if a == lang:
                groups[b].update(t for t in w if texts[t] >= 3)
        share = lambda counts: {t: 1 + 10 ** 9 * (counts[t] + 1) // (sum(counts.values()) + len(kept)) for t in kept}
        q = share(sum(groups.values(), Counter()))
        for b, counts in groups.items():
            p = share(counts)
            pairs = [(o, sum((p[t] - r[t]) ** 2 // r[t] for t in kept)) for o in groups if o != b for r in [share(groups[o])]]
            terms = [(t, (p[t] - q[t]) ** 2 // q[t]) for t in kept if counts[t] and p[t] > q[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, ranks)):
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, b, part, i, v, k + 1) for k, (i, v) in enumerate(items[:most])]
    return sorted(out)


def check(spark, rows, **options):
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "lang string, source string, text string, term string, n int").repartition(3)
    got = divergence_audit(docs, **options)
    assert got.columns == ["lang", "source", "part", "item", "value", "rank"]
    assert sorted(map(tuple, got.collect())) == brute(rows, options.get("most_ranks", 200))


def vocabulary(rng):
    letters = "abyzABYZéßñЖ語🙂"
    return ["".join(rng.choices(letters, k=rng.choice([1, 2, 3, 4, 5, 7, 8, 9, 12, 16, 17, 30, 90]))) for _ in range(60)]


def test_random_corpora(spark):
    rng = random.Random(3)
    words = vocabulary(rng)
    rows = [(rng.choice(["en", "de", None, ""]), rng.choice(["a", "b", "ü", None]), rng.choice([" ", "-", "\x00", "1"]).join(rng.choices(words[:rng.choice([3, 60])], k=rng.randint(0, 40))))
            for _ in range(80)]
    check(spark, rows)
    check(spark, rows, most_ranks=4)


def test_odd_rows(spark):
    check(spark, [])
    check(spark, [(None, None, None), ("en", "a", ""), ("en", "b", "12 ?!"), ("fr", "only", "mot mot mot")])
    check(spark, [("en", s, t) for s in "abc" for t in ("same row", "same row", "tie eit", None, "x" * 100_000 + " " + "ab " * 50_000)])


def test_long_texts_blocks_and_runs(monkeypatch):
    """Small blocks, early merging and sending on leave the sums alone."""
    rng = random.Random(4)
    words = vocabulary(rng)
    rows = [(rng.choice("xy"), rng.choice("abc"), " ".join(rng.choices(words, k=rng.randint(0, 60)))) for _ in range(200)]
    want = Counter()
    seen = Counter()
    for a, b, t in rows:
        want.update((a, b, w) for w in terms_of(t))
        seen.update({(a, b, w) for w in terms_of(t)})
    monkeypatch.setattr(divergence, "BLOCK", 300)
    monkeypatch.setattr(divergence, "MOST_HELD", 50)
    cols = list(zip(*rows))
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["lang", "source", "text"])
    got, texts = Counter(), Counter()
    for b in divergence._count_task(iter([batch.slice(0, 90), batch.slice(90)])):
        for lang, source, term, n, k in zip(*(c.to_pylist() for c in b.columns)):
            got[lang, source, term] += n
            texts[lang, source, term] += k
    assert got == want and texts == seen


def test_radix_order_is_stable():
    rng = np.random.default_rng(5)
    low, high = rng.integers(0, 1 << 64, 5000, np.uint64) & np.uint64(0xFF000000000000FF), rng.integers(0, 3, 5000).astype(np.uint32)
    assert (divergence.radix_order([low, high]) == np.lexsort((low, high))).all()


def test_counts_need_one_shuffle(spark):
    docs = spark.createDataFrame([("en", "a", "one two two")], "lang string, source string, text string")
    counts = term_counts(docs)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1, plan
    assert sorted(map(tuple, counts.collect())) == [("en", "a", "one", 1, 1), ("en", "a", "two", 2, 1)]
