import hashlib
import random

from pyspark.sql import functions as F

from sievekit.llm.chat import chat_digest, format_chats, read_back

SCHEMA = "conv_id bigint, turn bigint, role string, text string, n string, t string, blocks string, formatted string"
BITS = ["<|start|>", "<|next|>", "<|end|>\n", "<|", "\\", "\\b", "\\l", "|", "<", "\n", "user\n", "ok", "é🙂", "</turn>", "### Assistant:", ""]


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], SCHEMA).repartition(3)


def turns_of(rows):
    by = {}
    for c, k, role, text in rows:
        by.setdefault(c, []).append((k is not None, k or 0, role or "", text or ""))
    return {c: [x[2:] for x in sorted(v)] for c, v in by.items()}


def check(spark, rows):
    df = table(spark, rows)
    got = {r["conv_id"]: r for r in format_chats(df).withColumn("back", read_back(F.col("formatted"))).collect()}
    digest = {r["conv_id"]: r for r in chat_digest(df).collect()}
    want = turns_of(rows)
    assert got.keys() == want.keys() == digest.keys()
    for c, turns in want.items():
        assert [tuple(t) for t in got[c]["back"]] == turns
        assert got[c]["n_blocks"] == sum(k == 0 or turns[k][0] != turns[k - 1][0] for k in range(len(turns)))
        learned = "".join(t for r, t in turns if r == "assistant")
        d = digest[c]
        assert (d["n_turns"], d["loss_chars"], d["formatted_chars"]) == (len(turns), len(learned), len(got[c]["formatted"]))
        assert d["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert d["loss_sha256"] == hashlib.sha256(learned.encode()).hexdigest()
        spans = [(s["start"], s["length"]) for s in got[c]["loss"]]
        assert len(spans) == sum(r == "assistant" for r, _ in turns) and spans == sorted(spans)


def test_control_strings_in_texts_and_roles(spark):
    rng = random.Random(2)
    role = lambda: rng.choice(["user", "assistant", "assistant", "system", "as\\n<|end|>\nsistant"])
    check(spark, [(c, k, role(), "".join(rng.choices(BITS, k=rng.randint(0, 6)))) for c in range(60) for k in range(rng.randint(1, 9))])


def test_nulls_ties_repeats(spark):
    check(spark, [(None, 0, "user", "a"), (None, 1, "assistant", None), (1, None, None, None), (1, 0, "assistant", "b"), (1, 0, "assistant", "b"),
                  (1, 0, "assistant", "a"), (2, 5, "assistant", ""), (3, 1, "user", "x" * 200_000), (3, 2, "assistant", "y" * 200_000)])


def test_many_turns_of_one_conversation(spark):
    check(spark, [(1, k, ("user", "assistant")[k // 3 % 2], f"turn {k}") for k in range(600)])


def test_merged_block_has_one_head(spark):
    row = format_chats(table(spark, [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c")])).first()
    assert row["formatted"] == "<|start|>user\na<|next|>b<|end|>\n<|start|>assistant\nc<|end|>\n"


def test_empty_and_no_python(spark, capsys):
    df = table(spark, [])
    assert format_chats(df).count() == 0 and chat_digest(df).count() == 0
    chat_digest(spark.read.parquet("/root/testdata/sf0.001/conversations.parquet")).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange") == 1
