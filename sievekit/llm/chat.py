"""Chat formatting as a relational job, in Spark expressions only.

The turns of a conversation are collected as structs and sorted; adjacent
turns of one role become one block whose texts are aggregated between
separators; blocks are concatenated.  A block is

    <|start|>role<newline>text[<|next|>text ...]<|end|><newline>

Control strings all begin with ``<|``.  In texts and roles a backslash becomes
``\\b`` and ``<|`` becomes ``\\l`` (and, in roles, a line end ``\\n``), so no
text can imitate the template, and the original is read back exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import picked

START, NEXT, END = "<|start|>", "<|next|>", "<|end|>\n"


def escape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\"), F.lit("\\b")), F.lit("<|"), F.lit("\\l"))


def unescape(text: Column) -> Column:
    return F.replace(F.replace(text, F.lit("\\l"), F.lit("<|")), F.lit("\\b"), F.lit("\\"))


def escape_role(role: Column) -> Column:
    return F.replace(escape(role), F.lit("\n"), F.lit("\\n"))


def unescape_role(role: Column) -> Column:
    return F.replace(F.replace(F.replace(role, F.lit("\\n"), F.lit("\n")), F.lit("\\l"), F.lit("<|")), F.lit("\\b"), F.lit("\\"))


def format_chats(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                 learn_role: str = "assistant") -> DataFrame:
    """One row for each conversation: conv_id, formatted, n_blocks, and
    ``loss``, the spans (start from 0, length; code points) of the texts of
    ``learn_role`` in ``formatted``, without separators.

    Null roles and texts count as empty.  Turns are ordered by turn (null
    first), equal ones by role, then text; repeated rows are turns of their own.
    Rows with a null conversation make one conversation with a null key.  An
    empty table gives no rows; other columns are not read.

    The only shuffle brings a conversation's turns together, which its one
    output row needs; the work grows in proportion to them."""
    rows = picked(turns, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col)
    rows = rows.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text")})
    # where each text will lie: running sums of the lengths of what comes before it
    w = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    other = lambda near: near.over(w).isNull() | (near.over(w) != F.col("role"))
    rows = rows.withColumns({
        "before": F.when(other(F.lag("role")), len(START) + F.char_length(escape_role(F.col("role"))) + 1).otherwise(len(NEXT)),
        "size": F.char_length(escape(F.col("text"))), "after": F.when(other(F.lead("role")), len(END)).otherwise(0)})
    end = F.sum(F.col("before") + F.col("size") + F.col("after")).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = rows.withColumn("start", (end - F.col("after") - F.col("size")).cast("int"))
    rows = rows.select("conv_id", F.struct("turn", "role", "text", "start", F.col("size").alias("length")).alias("t"))
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t"))
    learned = F.transform(F.filter("t", lambda t: t["role"] == learn_role), lambda t: F.struct(t["start"].alias("start"), t["length"].alias("length")))
    chats = chats.withColumn("loss", learned)
    chats = chats.withColumn("role", F.transform("t", lambda t: t["role"])).withColumn("n", F.size("t"))
    # a block begins where the role differs from the one before
    first = F.filter(F.sequence(F.lit(0), F.col("n") - 1), lambda i: (i == 0) | (F.get("role", i) != F.get("role", i - 1)))
    chats = chats.withColumn("first", first)
    past = F.concat(F.slice("first", 2, F.col("n")), F.array("n"))
    blocks = F.transform(F.arrays_zip(F.col("first").alias("a"), past.alias("b")), lambda x: F.struct(
        F.get("role", x["a"]).alias("role"),
        F.transform(F.slice("t", x["a"] + 1, x["b"] - x["a"]), lambda t: escape(t["text"])).alias("texts")))
    chats = chats.select("conv_id", blocks.alias("blocks"), "loss")
    body = F.transform("blocks", lambda b: F.concat(F.lit(START), escape_role(b["role"]), F.lit("\n"), F.array_join(b["texts"], NEXT), F.lit(END)))
    return chats.select("conv_id", F.array_join(body, "").alias("formatted"), F.size("blocks").alias("n_blocks"), "loss")


def read_back(formatted: Column) -> Column:
    """The turns (role, text) of a formatted conversation, in order."""
    blocks = F.slice(F.split(formatted, r"<\|start\|>"), 2, F.char_length(formatted) + 1)

    def turns(block: Column) -> Column:
        block = F.substring(block, F.lit(1), F.char_length(block) - len(END))
        cut = F.position(F.lit("\n"), block)
        role = unescape_role(F.substring(block, F.lit(1), cut - 1))
        texts = F.split(F.substring(block, cut + 1, F.char_length(block)), r"<\|next\|>")
        return F.transform(texts, lambda t: F.struct(role.alias("role"), unescape(t).alias("text")))

    return F.flatten(F.transform(blocks, turns))


def chat_digest(turns: DataFrame) -> DataFrame:
    """The contract's columns, read back from the output of ``format_chats``."""
    chats = format_chats(turns).withColumn("turns", read_back(F.col("formatted")))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join(F.transform("loss", lambda s: unescape(F.substring(F.col("formatted"), s["start"] + 1, s["length"]))), "")
    hexed = lambda c: F.sha2(c.cast("binary"), 256)
    chats = chats.withColumn("learned", learned)
    return chats.select("conv_id", F.size("turns").cast("bigint").alias("n_turns"), hexed(said).alias("turns_sha256"),
                        F.char_length("learned").cast("bigint").alias("loss_chars"), hexed(F.col("learned")).alias("loss_sha256"),
                        F.char_length("formatted").cast("bigint").alias("formatted_chars"), "n_blocks")
