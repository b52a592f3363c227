import hashlib
import os
import random

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sievekit.llm.bpe import decode_documents, encode_documents, piece_table, token_digest

PATH = public_tokenizers.path("byte_bpe_50k.json")
#: Spaces of all kinds before words, signs, numbers and the special token; contractions; letters, digits and
#: characters that only newer Unicode versions know; combining marks; control characters.
TEXTS = ["a  b   c \n\n d\t\te  ", "  <|endoftext|>  x<|endoftext|><|endoftext|>", "it's we'LL don't I'm you've he'd they're 'Sure'", "!!<|endoftext|>?? <|endoftext", "  x　\u0085y᠎ z ",
         "abc123 ½²³ x٣٤ 日本語テキスト 🙂🙂 👩‍👩‍👧 é", "ࡰࡱ new letters \U00031350\U0001e030 <|endoftext|> andೳ", "\x00\x01\x7f \x1c\x1d", " ", "\n", "x" * 3000, " " * 3000 + "end"]


@pytest.fixture(scope="module")
def tok():
    return Tokenizer.from_file(PATH)


def brute(tok, rows):
    out = []
    for i, t in rows:
        ids = tok.encode(t or "", add_special_tokens=False).ids
        back = tok.decode(ids, skip_special_tokens=False)
        out.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    return sorted(out, key=str)


def check(tok, docs_of, rows, **options):
    got = token_digest(docs_of(rows, **options), PATH)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect()), key=str) == brute(tok, rows)


def test_texts_of_all_kinds(tok, docs_of):
    check(tok, docs_of, list(enumerate(TEXTS)))
    rng = random.Random(12)
    bits = ["a", "B", "é", " ", "  ", "\n", "1", "'", "'s", "!", "<|endoftext|>", "<|", "語", "ࡰ", " ", "🙂"]
    check(tok, docs_of, [(k, "".join(rng.choices(bits, k=rng.randint(0, 30)))) for k in range(400)])


def test_odd_rows(tok, docs_of, odd_rows):
    check(tok, docs_of, odd_rows)
    check(tok, docs_of, [])
    check(tok, docs_of, [(1, None), (2, "")])


def test_texts_longer_than_a_block(tok, docs_of):
    rng = random.Random(1)
    check(tok, docs_of, [(1, " ".join(str(rng.random()) for _ in range(300_000))), (2, "y" * 200_000), (3, "short"), (4, None)], parts=1)


def test_round_trip_and_any_ids(spark, tok, docs_of):
    rows = list(enumerate(TEXTS))
    encoded = encode_documents(docs_of(rows), PATH)
    assert encoded.columns == ["doc_id", "ids"]
    assert sorted(map(tuple, decode_documents(encoded, PATH).collect())) == rows
    rng = random.Random(2)
    some = [(k, [rng.randrange(50_257) for _ in range(rng.randint(0, 9))]) for k in range(200)] + [(None, None), (7, [50_256, None, 99_999, 50_256])]
    got = decode_documents(spark.createDataFrame(some, "doc_id bigint, ids array<int>"), PATH).collect()
    want = [(k, tok.decode([x for x in ids or [] if x is not None and x < 50_257], skip_special_tokens=False)) for k, ids in some]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_pieces_cover_the_vocabulary(spark):
    assert piece_table(spark, PATH).agg(F.count("id"), F.countDistinct("id")).first() == (50_257, 50_257)


def test_texts_do_not_move_and_changing_rows_are_an_error(spark, docs_of):
    docs = docs_of([(k, f"some words {k}") for k in range(50)])
    plan = encode_documents(docs, PATH)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2 and "Exchange hashpartitioning(bucket" in plan and "Exchange hashpartitioning(block" in plan

    def other_texts(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([os.urandom(4).hex() for _ in range(b.num_rows)])], names=["doc_id", "text"])

    unsteady = spark.range(50).mapInArrow(other_texts, "doc_id bigint, text string")
    with pytest.raises(Exception, match="changed between two readings"):
        encode_documents(unsteady, PATH).collect()
