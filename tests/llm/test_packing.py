import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from sievekit.llm.packing import Encoder, best_fit, crossover, fill_of, fitness, mutate, pack_documents, slots

PATH = public_tokenizers.path("word_bpe_49k.json")


def pieces_of(packing):
    out = Counter()
    for kind, n in packing.items():
        for length, k in kind:
            out[length] += k * n
    return out


def test_encoder_equals_the_library(spark):
    tok = Tokenizer.from_file(PATH)
    texts = ["", "It's a <|endoftext|> test", "don't WE'LL 'S'T 'Re", "naïve İstanbul ΣΑΣ x² ½ 12 ÀÉÿß", "a\x1cb\x85c d", "é é", "日本語 🙂",
             "word!! the&&& a$$$ %%% it's'll", "\t\n"]
    texts += [r["text"] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text").collect()]
    want = [np.asarray(e.ids, "<u4").tobytes() for e in tok.encode_batch(texts, add_special_tokens=False)]
    small = Encoder(PATH, limit=300)  # forgets often
    assert Encoder(PATH).encode(texts) == want
    assert small.encode(texts) + small.encode(texts) == want * 2


def test_genes_keep_every_piece():
    rng = random.Random(4)
    for capacity in (10, 64):
        counts = {k: rng.randint(1, 40) for k in range(1, capacity + 1)}
        a = best_fit({}, counts, capacity)
        for _ in range(15):
            b = best_fit({}, counts, capacity, sorted(counts, key=lambda x: -x * rng.uniform(0.5, 1)))
            for child in (crossover(a, b, counts, capacity, rng), mutate(b, capacity, rng)):
                assert pieces_of(child) == Counter(counts)
                assert max(map(fill_of, child)) <= capacity and min(child.values()) > 0
            a = min(a, child, key=lambda p: fitness(p, capacity))


def test_best_fit_prefers_the_fullest_bin():
    assert best_fit({((6, 1),): 1, ((7, 1),): 1}, {3: 1}, 10) == {((6, 1),): 1, ((7, 1), (3, 1)): 1}


def test_slots_are_gapless():
    packing = {((5, 1), (2, 2)): 3, ((2, 4),): 2}
    t = slots(packing)
    places = {}
    for length, count in pieces_of(packing).items():
        for rank in range(count):
            k = np.searchsorted(t["key"], (length << 48) + rank, "right") - 1
            at = rank - (int(t["key"][k]) & ((1 << 48) - 1))
            places.setdefault(int(t["seq"][k]) + at // int(t["per"][k]), []).append((int(t["at"][k]) + at % int(t["per"][k]) * length, length))
    assert len(places) == 5
    for rows in places.values():
        rows.sort()
        assert [a for a, _ in rows] == [sum(n for _, n in rows[:k]) for k in range(len(rows))]


def check(rows, got, capacity):
    tok = Tokenizer.from_file(PATH)
    want = []
    for i, t in rows:
        ids = [*tok.encode(t or "", add_special_tokens=False).ids, 0]
        for k, at in enumerate(range(0, len(ids), capacity)):
            part = ids[at:at + capacity]
            want.append((i, k, at, len(part), zlib.crc32(np.asarray(part, "<u4").tobytes())))
    assert sorted(((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got), key=str) == sorted(want, key=str)
    by = {}
    for r in got:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for rows in by.values():
        rows.sort()
        assert [a for a, _ in rows] == [sum(n for _, n in rows[:k]) for k in range(len(rows))]
        assert sum(n for _, n in rows) <= capacity
    return len(by)


def test_odd_rows(docs_of, odd_rows):
    docs = docs_of(odd_rows)
    check(odd_rows, pack_documents(docs, PATH, capacity=64, islands=2, epochs=2).collect(), 64)
    ids = pack_documents(docs, PATH, capacity=64, with_ids=True, islands=2, epochs=1).where("doc_id = 2").first()["ids"]
    assert ids == [0]
    assert pack_documents(docs_of([]), PATH).count() == 0


def test_whole_table_is_packed_tightly(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = pack_documents(docs, PATH).collect()
    assert check(rows, got, 2048) <= 1.02 * -(-sum(r["length"] for r in got) // 2048) + 1


def test_a_worker_remembers_a_bounded_number_of_words():
    """Two workers of an executor hold these tables beside a JVM that has grown in earlier stages."""
    enc = Encoder(PATH)
    assert enc.limit <= 100_000
    words = [f"{a}{b}{c}" for a in "bcdfghjklmnpqrstvwxz" for b in "aeiou" for c in range(1100)]
    for at in range(0, len(words), 10_000):
        enc.encode([" ".join(words[at:at + 10_000])])
    assert len(enc.words) <= 100_000 and len(enc.parts) <= 200_000
    assert enc.encode([" ".join(words[-50:])]) == enc.ids([" ".join(words[-50:])])


def test_forms_of_a_word_share_an_entry():
    """Capitals and marks around a word make no further entries, and a new part is not normalized and split again."""
    enc = Encoder(PATH)
    texts = [f"{a}{w}{b}" for w in ("straße", "Straße", "STRAßE") for a in ("", "(", "##") for b in ("", ".", ",", "!!", "'s", "7")]
    assert enc.encode(texts) == enc.ids(texts)
    assert not enc.words and set(enc.parts) == {"straße", "(", "##", ".", ",", "!!", "'s", "7"}
    assert enc.by_parts and enc.plain.normalizer is None


def test_new_parts_have_the_ids_of_the_whole_tokenizer():
    enc = Encoder(PATH)
    chars = [chr(c) for c in (*range(33, 127), *range(0xC0, 0x100)) if chr(c) not in "×÷"]
    texts = chars + [a + b for a in chars for b in "'sté9!"] + ["'" * 5, "''s", "!'s'", "y'all'd've", "x" * 400, "ÀÉ" * 90, "<|end of text|>"]
    assert [enc.encode([t])[0] for t in texts] == enc.ids(texts)
    fresh = Encoder(PATH)
    assert fresh.encode(texts) == enc.ids(texts) and fresh.parts == enc.parts
    assert len(fresh.parts) > 300
