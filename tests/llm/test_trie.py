import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from sievekit.llm.trie import DoubleArray, branched, packed_trie, prefix_trie, turn_sequences

NAMES = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def conversations(rows):
    """(conv_id, turn, role, text) rows as lists of (role, text)."""
    out = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is not None, r[1] or 0)):
        if conv is not None:
            out[conv].append((role or "", text or ""))
    return out


def rebuilt(own):
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        out[c] = own.get(c - c % 100, [])[:h] + turns[h:]
    return out


def brute(convs):
    members = defaultdict(list)
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids = defaultdict(int)
    for k in members:
        if k:
            kids[k[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for k, m in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not kids[k]
            saved[k[:d]] += (len(m) - 1) * len(k[-1][1]) if k else 0
    digest = lambda k: hashlib.sha256(",".join(map(str, sorted(c for c in members[k] if len(convs[c]) == len(k)))).encode()).hexdigest()
    return sorted(((min(m), len(k), min(members[k[:-1]]) if k else None, len(m), kids[k], leaves[k], saved[k], digest(k)) for k, m in members.items()), key=str)


@pytest.fixture(scope="module")
def turns_of(spark):
    """A conversations table with columns that clash with names used inside."""
    schema = "conv_id bigint, turn bigint, role string, text string, id string, chars int, key string, n int, shard string, t string, h int, head string"
    return lambda rows: spark.createDataFrame([(*r, "x", 1, "x", 1, "x", "x", 1, "x") for r in rows], schema).repartition(3)


def check(turns_of, rows, **options):
    got = prefix_trie(branched(turn_sequences(turns_of(rows))), **options)
    assert got.columns == NAMES
    assert sorted(map(tuple, got.collect()), key=str) == brute(rebuilt(conversations(rows)))


def random_rows(rng, convs=260, pool=6):
    rows = []
    for c in range(0, convs):
        if c % 100 or rng.random() < 0.7:
            rows += [(c, t if t or rng.random() < 0.8 else None, rng.choice(["user", "assistant", None]), rng.choice(["", "hi", "ä語🙂", None, "what else"][:pool]))
                     for t in range(rng.choice([1, 2, 3, 7, 9]))]
    return rows


def test_random_conversations(turns_of):
    rng = random.Random(6)
    rows = random_rows(rng)
    check(turns_of, rows)
    for most in (1, 30):  # every prefix, and some prefixes, are too hot for one shard
        check(turns_of, rows, most_turns=most)


def test_common_first_turns_and_copies(turns_of):
    rng = random.Random(7)
    rows = [(c, t, "system" if t == 0 else "user", "same" if t < 5 or c % 3 == 0 else f"text {rng.randint(0, 3)}") for c in range(300) for t in range(c % 9 + 1)]
    check(turns_of, rows, most_turns=20)


def test_odd_rows(turns_of):
    check(turns_of, [])
    check(turns_of, [(None, 1, "user", "nobody's")])
    check(turns_of, [(7, 1, None, None)])
    check(turns_of, [(100, None, "user", "first"), (100, 3, "user", "b"), (101, 1, "user", "x"), (101, 2, "us", "erx"), (250, 1, "a", "long " * 50_000), (None, 2, None, None)])


def test_tied_and_repeated_rows_are_turns(turns_of):
    """Equal turn numbers go by the turns' ids, whatever the order of rows."""
    rows = [(5, 1, "user", "a"), (5, 1, "user", "b"), (5, 1, "user", "a"), (6, 1, "user", "b"), (6, 1, "user", "a"), (6, 1, "user", "a")]
    got = prefix_trie(turn_sequences(turns_of(rows))).collect()
    assert sorted((r["depth"], r["n_convs"]) for r in got) == [(0, 2), (1, 2), (2, 2), (3, 2)]


def test_a_long_conversation(turns_of):
    rows = [(c, t, "user", f"turn {t}" if t < 2990 else f"turn {t} {c}") for c in (1, 2) for t in range(3000)]
    got = {(r["depth"], r["conv_id"]): r for r in prefix_trie(turn_sequences(turns_of(rows)), most_turns=1000).collect()}
    assert len(got) == 1 + 2990 + 2 * 10
    assert got[2990, 1]["n_children"] == 2 and got[0, 1]["n_leaves"] == 2 and got[3000, 2]["parent_conv_id"] == 2


def test_double_array_holds_what_was_put_in():
    rng = np.random.default_rng(8)
    seqs = sorted({tuple(rng.integers(0, 40, rng.integers(0, 6)).tolist()) for _ in range(4000)})
    size = np.array([len(s) for s in seqs])
    ids, start = np.array([x for s in seqs for x in s], np.int64), np.cumsum(size) - size
    trie = packed_trie(ids, start, size)
    prefixes = {s[:d] for s in seqs for d in range(len(s) + 1)}
    used = np.flatnonzero(trie.check != -1)
    assert len(used) == len(prefixes) and trie.tail < 2.5 * len(prefixes)
    places = {}
    for p in prefixes:
        at = np.zeros(1, np.int64)
        for x in p:
            at = trie.step(at, np.array([x]))
        assert at[0] >= 0
        places[int(at[0])] = p
    assert len(places) == len(prefixes)
    assert all(trie.step(np.array([k]), np.array([x]))[0] == -1 for k, p in list(places.items())[:200] for x in range(40) if (*p, x) not in prefixes)
    assert DoubleArray().step(np.zeros(1, np.int64), np.array([5])).tolist() == [-1]
