import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from sievekit.llm.components import connected_components
from sievekit.llm.ngram_join import MOST_MATCHES, SLOT_BITS, _leaders, _need, chosen_prefix, keep_one_each, need_of, ngram_join, parities, shingle_set


def shingles(t, words=4):
    w = (t or "").encode().lower().split()
    return frozenset(tuple(w[k:k + words]) for k in range(max(1, len(w) - words + 1))) if w else frozenset()


def brute(rows, percent=85, words=4):
    sets = [shingles(t, words) for _, t in rows]
    comp = list(range(len(rows)))

    def find(k):
        while comp[k] != k:
            k = comp[k]
        return k

    for a in range(len(rows)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                comp[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, len(sets[k]), least.get(find(k)) if sets[k] else i) for k, (i, _) in enumerate(rows)), key=str)


def check(docs_of, rows, **options):
    got = ngram_join(docs_of(rows), **options)
    assert sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got.collect()), key=str) == brute(rows, **options)


def near_copies(rng, n, length, vocabulary, edits):
    base = [f"w{rng.randint(0, vocabulary)}" for _ in range(length)]
    out = [" ".join(base)]
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randint(0, edits)):
            k = rng.randrange(len(w))
            w[k:k + 1] = rng.choice([[], [f"x{rng.randint(0, 30)}"], [w[k], f"w{rng.randint(0, vocabulary)}"]])
        out.append(" ".join(w))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_random_groups(docs_of, seed):
    rng = random.Random(seed)
    texts = []
    for length, edits in ((120, 7), (60, 4), (30, 2), (12, 1), (5, 1)):
        texts += near_copies(rng, 40, length, 3000, edits)
    texts += near_copies(rng, 60, 200, 40, 12)  # few words, long sets
    passage = " ".join(f"p{k}" for k in range(60))
    texts += [passage + " " + " ".join(f"z{rng.randint(0, 999)}" for _ in range(rng.randint(0, 30))) for _ in range(60)]
    texts += ["Same TEXT here again and again", "same\x0btext HERE\tagain and again"] * 30
    rng.shuffle(texts)
    check(docs_of, list(enumerate(texts, 100)))


def test_chain_of_links(docs_of):
    words = [f"w{k}" for k in range(260)]
    check(docs_of, [(k, " ".join(words[k * 3:k * 3 + 100])) for k in range(50)])


def test_boundary_is_inclusive(docs_of):
    a = [f"w{k}" for k in range(103)]  # 100 shingles; 85 of 100 shared
    check(docs_of, [(2, " ".join(a)), (1, " ".join(a[:88])), (0, " ".join(a[:87]))])


def test_odd_rows(docs_of, odd_rows):
    check(docs_of, [*odd_rows, (None, "same row"), (None, None), (12, LONG_COPY), (9, "ONE"), (10, "é"), (11, "É")])
    assert ngram_join(docs_of([])).count() == 0
    check(docs_of, [(1, None), (2, "")])


LONG_COPY = "plain words go on and on without an end " * 4001


def test_other_parameters(docs_of):
    rng = random.Random(5)
    check(docs_of, list(enumerate(near_copies(rng, 60, 50, 500, 5))), percent=60, words=2)


def test_prefix_theorem():
    """Sets that are similar enough share l shingles of their prefixes."""
    rng = np.random.default_rng(3)
    freq = rng.integers(0, 2000, 1 << SLOT_BITS)
    for _ in range(400):
        s = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 80)).astype(np.uint64))
        t = np.unique(np.concatenate([rng.permutation(s)[:max(1, int(len(s) * rng.uniform(0.8, 1)))], rng.integers(0, 1 << 63, rng.integers(0, 10)).astype(np.uint64)]))
        both = len(np.intersect1d(s, t))
        if 100 * both >= 85 * (len(s) + len(t) - both):
            (p, a), (q, b) = (chosen_prefix(x, freq, 10.0, 85) for x in (s, t))
            assert 1 <= min(a, b) <= MOST_MATCHES and len(np.intersect1d(p, q)) >= min(a, b)
            assert both >= need_of(len(s), len(t), 85)


def test_parities_never_exceed_the_difference():
    rng = np.random.default_rng(9)
    for _ in range(200):
        s = np.unique(rng.integers(0, 1 << 63, rng.integers(1, 900)).astype(np.uint64))
        t = np.unique(np.concatenate([s[rng.random(len(s)) < 0.9], rng.integers(0, 1 << 63, rng.integers(0, 60)).astype(np.uint64)]))
        apart = sum(int(x).bit_count() for x in (parities(s) ^ parities(t)).view(np.uint64))
        assert apart <= len(np.setxor1d(s, t))


def test_costly_prefixes_are_longer():
    s = np.unique(np.random.default_rng(1).integers(0, 1 << 63, 100).astype(np.uint64))
    rare, common = np.ones(1 << SLOT_BITS), np.full(1 << SLOT_BITS, 5000)
    assert chosen_prefix(s, rare, 10.0, 85)[1] == 1 < chosen_prefix(s, common, 10.0, 85)[1]


def test_keep_one_each(docs_of, odd_rows):
    docs = docs_of([*odd_rows, (20, "a b c d e f g h i j"), (20, "A b c d e f g h i j"), (19, "a b c d e f g h i j"), (None, "one")])
    out = keep_one_each(docs)
    assert out.columns == docs.columns
    assert sorted(str(r["doc_id"]) for r in out.collect()) == sorted(["None", "1", "2", "3", "5", "6", "7", "8", "19", "4"])


def test_components(spark):
    rng = random.Random(7)
    links = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(220)] + [(k, k + 1) for k in range(1000, 1040)] + [(5, 5)]
    comp = {}

    def find(x):
        while comp.setdefault(x, x) != x:
            x = comp[x]
        return x

    for a, b in links:
        x, y = find(a), find(b)
        comp[max(x, y)] = min(x, y)
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(links, "u bigint, v bigint")).collect()}
    assert got == {x: find(x) for x in got} and {x for a, b in links if a != b for x in (a, b)} == got.keys()
    assert connected_components(spark.createDataFrame([], "u bigint, v bigint")).count() == 0


def test_leaders_and_bounds_of_very_long_texts(spark):
    """Places from 2**19 on and sizes from 2**24 on."""
    rows = [(1, 5, 600_000, 20_000_000), (1, 4, 600_000, 20_000_000), (1, 3, 600_001, 4), (2, 7, 1, 1 << 24), (2, 8, 1, (1 << 24) - 1), (3, 9, 0, 1)]
    flat = spark.createDataFrame(rows, "token bigint, node bigint, pos int, n int")
    got = {r["token"]: tuple(r)[1:] for r in _leaders(flat).select("token", "c", "lead", "lead_n", "lead_pos").collect()}
    assert got == {1: (2 + 1, 4, 20_000_000, 600_000), 2: (2, 8, (1 << 24) - 1, 1)}
    big = flat.where("n = 20000000").select(_need(F.col("n"), F.col("n"), 85).alias("need")).first()["need"]
    assert big == need_of(20_000_000, 20_000_000, 85)


def test_words_made_to_collide_in_polynomial_hashes(docs_of):
    """A Thue-Morse word and its complement have one hash under any polynomial modulo 2**64."""
    u, v = "a", "b"
    while len(u) < 2048:
        u, v = u + v, v + u
    for n in (9, 16, 17, 1024, 2048):
        assert shingle_set(f"one two three {u[:n]}", 4) != shingle_set(f"one two three {v[:n]}", 4)
    check(docs_of, [(1, f"one two three four {u}"), (2, f"one two three four {v}"), (3, "a\x00 b c d"), (4, "a b c d")])
