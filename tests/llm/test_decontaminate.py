import hashlib
import random
import re

from sievekit.llm.decontaminate import contamination, contamination_digest, drop_contaminated, winnow
import numpy as np

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(t):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in t or ""))


def brute(docs, items, span=10):
    windows = {}
    for i, t in items:
        w = words(t)
        n = min(span, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k:k + n]), set()).add(i)
    out = []
    for i, t in docs:
        w, hit, of = words(t), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (found := windows.get(tuple(w[k:k + n]))) is not None:
                    hit.update(range(k, k + n))
                    of |= found
        of = sorted(str(x) for x in of if x is not None)
        out.append((i, len(w), len(hit), len(of), hashlib.sha256(",".join(of).encode()).hexdigest(), bool(hit)))
    return sorted(out, key=str)


def check(docs_of, docs, items):
    got = contamination_digest(docs_of(docs), docs_of(items).withColumnRenamed("doc_id", "item_id"))
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(docs, items)


def test_winnow_keeps_one_of_each_window():
    g = np.array([5, 3, 3, 9, 1, 7, 7, 7], np.uint64)
    kept = set(winnow(g, 3).tolist())
    assert all(kept & set(range(k, k + 3)) for k in range(6))
    assert winnow(g[:2], 3).size == 0


def test_random_corpora(docs_of):
    rng = random.Random(8)
    for vocabulary in (3, 12):
        pool = [f"w{k}" if k % 3 else f"Ŵ{k}é" for k in range(vocabulary)]
        text = lambda n: " ".join(rng.choices(pool, k=n))
        items = [(k, text(rng.choice([0, 1, 2, 5, 9, 10, 11, 25, 60]))) for k in range(14)]
        items += [(None, text(12)), (3, text(15)), (50, None), (51, items[8][1])]
        docs = [(k, text(rng.randint(0, 80))) for k in range(25)]
        docs += [(100 + k, f"{text(7)} {i[1] or ''} {text(5)}") for k, i in enumerate(items)]
        check(docs_of, docs, items)


def test_odd_rows(docs_of, odd_rows):
    check(docs_of, odd_rows, [(1, "without an end plain words go on and on without"), (2, "One!"), (3, ""), (4, None)])
    check(docs_of, odd_rows, [])
    check(docs_of, [], [(1, "a b c")])


def test_drop_keeps_clean_rows_and_columns(docs_of, odd_rows):
    docs = docs_of(odd_rows)
    out = drop_contaminated(docs, docs_of([(1, "SAME row"), (2, "a text without a key")]).withColumnRenamed("doc_id", "item_id"))
    assert out.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in out.collect()) == ["1", "2", "3", "4", "5", "7", "8"]


def test_spans_and_items(docs_of):
    item = " ".join(f"q{k}" for k in range(30))
    got = contamination(docs_of([(1, f"x y {item} z")]), docs_of([(7, item)]).withColumnRenamed("doc_id", "item_id")).first()
    assert got["n_hit"] == 30 and got["items"] == ["7"]
    assert {k for s in got["spans"] for k in range(s["start"], s["end"])} == set(range(2, 32))
