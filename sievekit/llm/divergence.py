"""Source divergence audit: how far the sources of a language differ in their terms.

Terms are counted by packing.  The bytes of a block of texts are folded and
cut into terms in one numpy pass.  A term of up to eight bytes becomes one
big-endian uint64, one of up to sixteen becomes two; terms are dealt to
buckets by length, so that a bucket's radix sort makes only as many 16-bit
passes as its terms have byte pairs.  Longer terms lie in one bucket for each
length and are sorted as bytes.  Runs of equal keys are the counts.  Spark
adds up the tasks' counts, compares the groups and ranks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import picked, stored

#: Bytes of text that are cut and sorted at a time (a longer text goes alone).
BLOCK = 1 << 22
#: Counted terms that a task holds before it sends them on.
MOST_HELD = 500_000
#: Shares are counted in this many parts.
UNIT = 1_000_000_000

#: What a byte of a term becomes, 0 for bytes outside terms.
_FOLD = np.zeros(256, np.uint8)
_FOLD[0x80:] = np.arange(0x80, 0x100)
_FOLD[0x61:0x7B] = _FOLD[0x41:0x5B] = np.arange(0x61, 0x7B)


# ------------------------------------------------------------------ packing
def radix_order(columns: list[np.ndarray]) -> np.ndarray:
    """The stable order of rows by columns of unsigned numbers, the most
    significant column last: one pass for each 16 bits that are not all equal."""
    order = np.arange(len(columns[0]))
    for column in columns:
        for shift in range(0, column.dtype.itemsize * 8, 16):
            digit = (column >> column.dtype.type(shift)).astype(np.uint16)
            if len(digit) and digit.min() != digit.max():
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def _changes(columns: list[np.ndarray]) -> np.ndarray:
    """Where sorted rows differ from the row before."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return new


def cut_terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Folded bytes, and start, length and text number of every term of texts
    that lie back to back."""
    folded = _FOLD[data]
    inside = folded != 0
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    before, after = np.zeros(len(data), bool), np.zeros(len(data), bool)
    before[1:], after[:-1] = inside[:-1], inside[1:]
    start = np.flatnonzero(inside & ~(before & ~edge[:-1]))
    end = np.flatnonzero(inside & ~(after & ~edge[1:])) + 1
    return folded, start, end - start, np.searchsorted(offsets, start, "right") - 1


def packed(folded: np.ndarray, start: np.ndarray, length: np.ndarray) -> Iterator[tuple[int, np.ndarray, list[np.ndarray]]]:
    """For each bucket its number (byte pairs up to 8, else the length), which
    terms lie in it and their keys: the least significant word first, or one
    array of bytes."""
    data = np.concatenate([folded, np.zeros(16, np.uint8)])
    word = np.ndarray((len(data) - 7,), ">u8", data, strides=(1,))
    bucket = np.where(length <= 16, (length + 1) // 2, length)
    for b in np.unique(bucket).tolist():
        at = np.flatnonzero(bucket == b)
        first, size = start[at], length[at]
        if b > 16:
            yield b, at, [np.ndarray((len(data) - b + 1,), f"S{b}", data, strides=(1,))[first]]
            continue
        unused = ((8 if b <= 4 else 16) - size).astype(np.uint64) * np.uint64(8)
        last = word[first if b <= 4 else first + 8].astype(np.uint64) >> unused << unused
        yield b, at, [last] if b <= 4 else [last, word[first].astype(np.uint64)]


def _ordered(keys: list[np.ndarray], group: np.ndarray) -> np.ndarray:
    if keys[0].dtype.kind == "S":
        order = np.argsort(keys[0], kind="stable")
        return order[radix_order([group[order]])]
    return radix_order([*keys, group])


def counted(keys: list[np.ndarray], group: np.ndarray, text: np.ndarray) -> tuple:
    """Runs of equal keys in a group: keys, group, how many, in how many texts
    (texts come in ascending order)."""
    order = _ordered(keys, group)
    keys, group, text = [k[order] for k in keys], group[order], text[order]
    new = _changes([*keys, group])
    at = np.flatnonzero(new)
    return ([k[at] for k in keys], group[at], np.diff(np.append(at, len(group))),
            np.add.reduceat((new | _changes([text])).astype(np.int64), at) if len(at) else at)


def merged(tables: list[tuple]) -> tuple:
    """Several tables of one bucket as one."""
    keys = [np.concatenate(k) for k in zip(*(t[0] for t in tables))]
    group, n, texts = (np.concatenate([t[k] for t in tables]) for k in (1, 2, 3))
    order = _ordered(keys, group)
    keys, group = [k[order] for k in keys], group[order]
    at = np.flatnonzero(_changes([*keys, group]))
    return [k[at] for k in keys], group[at], np.add.reduceat(n[order], at), np.add.reduceat(texts[order], at)


def unpacked(keys: list[np.ndarray]) -> pa.Array:
    """The terms of a bucket as strings."""
    if keys[0].dtype.kind != "S":
        words = np.ascontiguousarray(np.stack(keys[::-1], axis=1).astype(">u8"))
        keys = [words.view(f"S{8 * len(keys)}").ravel()]
    return pa.array(keys[0].tolist(), pa.binary()).cast(pa.string())


class _Held:
    """Counted terms by bucket, merged now and then."""

    def __init__(self):
        self.tables: dict[int, list[tuple]] = {}
        self.rows = 0

    def add(self, bucket: int, table: tuple) -> None:
        self.tables.setdefault(bucket, []).append(table)
        self.rows += len(table[1])

    def merge(self) -> None:
        self.tables = {b: [merged(t) if len(t) > 1 else t[0]] for b, t in self.tables.items()}
        self.rows = sum(len(t[0][1]) for t in self.tables.values())

    def batches(self, langs: list[str], sources: list[str]) -> Iterator[pa.RecordBatch]:
        self.merge()
        names = [pa.array(x, pa.string()) for x in (langs, sources)]
        for keys, group, n, texts in (t[0] for t in self.tables.values()):
            for at in range(0, len(group), 50_000):
                part = slice(at, at + 50_000)
                g = pa.array(group[part])
                yield pa.RecordBatch.from_arrays([names[0].take(g), names[1].take(g), unpacked([k[part] for k in keys]),
                                                  pa.array(n[part], pa.int64()), pa.array(texts[part], pa.int64())], names=_COUNTS)
        self.tables, self.rows = {}, 0


_COUNTS = ["lang", "source", "term", "n", "texts"]


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ids: dict[tuple[str, str], int] = {}
    held = _Held()
    most = 2 * MOST_HELD
    for b in batches:
        group = np.array([ids.setdefault(k, len(ids)) for k in zip(b.column(0).to_pylist(), b.column(1).to_pylist())], np.uint32)
        text = b.column(2).cast(pa.large_binary())
        ends = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + len(text) + 1]
        data = np.frombuffer(text.buffers()[2] or b"", np.uint8)
        at = 0
        while at < len(text):
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + BLOCK, "right")) - 1)
            folded, start, length, doc = cut_terms(data[ends[at]:ends[to]], ends[at:to + 1] - ends[at])
            for bucket, terms, keys in packed(folded, start, length):
                held.add(bucket, counted(keys, group[at:to][doc[terms]], doc[terms]))
            at = to
            if held.rows > most:
                held.merge()
                if held.rows > MOST_HELD:
                    yield from held.batches(*map(list, zip(*ids)))
        if len(ids) > MOST_HELD:
            yield from held.batches(*map(list, zip(*ids)))
            ids = {}
    if ids:
        yield from held.batches(*map(list, zip(*ids)))


def _filled(rows: DataFrame) -> DataFrame:
    return rows.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in rows.columns))


def term_counts(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """lang, source, term, n (occurrences) and texts (rows that have it), one
    row for each group and term; null cells count as ''.

    Every row is a text of its own, repeated ones too.  Texts without a term
    and empty tables give no row.  Each task counts its rows first; the counts
    are dealt by language and term."""
    rows = _filled(picked(docs, lang=lang_col, source=source_col, text=text_col))
    parts = rows.mapInArrow(_count_task, "lang string, source string, term string, n bigint, texts bigint")
    return parts.repartition("lang", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("texts").alias("texts"))


# --------------------------------------------------------------- comparison
def share(n: str, total: str, kinds: str) -> Column:
    """1 + floor(UNIT * (n + 1) / (total + kinds)), exactly."""
    return F.expr(f"1L + (CAST({UNIT} AS DECIMAL(10,0)) * CAST({n} + 1 AS DECIMAL(19,0))) div CAST(nullif({total} + {kinds}, 0) AS DECIMAL(20,0))")


def apart(p: str, q: str) -> Column:
    """floor((p - q)^2 / q) of whole numbers."""
    return F.expr(f"(({p} - {q}) * ({p} - {q})) div {q}")


def _apart(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // q


def _pair_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For rows sorted by language and term, the sums over terms that two
    sources both have, as a correction to what they are if one has none."""
    ids: dict[tuple[str, str], int] = {}
    keys, sums, carry = np.zeros(0, np.int64), np.zeros(0, np.int64), None

    def emit():
        names = [pa.array(x, pa.string()) for x in zip(*ids)] if ids else [pa.array([], pa.string())] * 2
        a, b = keys >> 32, keys & 0xFFFFFFFF
        return pa.RecordBatch.from_arrays([names[0].take(pa.array(a)), names[1].take(pa.array(a)), names[1].take(pa.array(b)), pa.array(sums)],
                                          names=["lang", "source", "other", "value"])

    def add(table: pa.Table):
        nonlocal keys, sums
        lang, term, source = (table.column(k).combine_chunks().dictionary_encode() for k in range(3))
        g_of = np.array([ids.setdefault(k, len(ids)) for k in zip(lang.to_pylist(), source.to_pylist())], np.int64)
        p, p0 = (table.column(k).to_numpy().astype(np.int64) for k in (3, 4))
        first = np.flatnonzero(_changes([lang.indices.to_numpy(), term.indices.to_numpy()]))
        size = np.diff(np.append(first, len(p)))
        width, begin = np.repeat(size, size), np.repeat(first, size)
        done = np.concatenate([[0], np.cumsum(width)])
        at = 0
        while at < len(p):
            to = max(at + 1, int(np.searchsorted(done, done[at] + 1_000_000, "right")) - 1)
            a = np.repeat(np.arange(at, to), width[at:to])
            b = np.arange(len(a)) - np.repeat(done[at:to] - done[at], width[at:to]) + begin[a]
            a, b = a[a != b], b[a != b]
            value = _apart(p[a], p[b]) - _apart(p[a], p0[b]) - _apart(p0[a], p[b]) + _apart(p0[a], p0[b])
            all_keys, place = np.unique(np.concatenate([keys, g_of[a] << 32 | g_of[b]]), return_inverse=True)
            total = np.zeros(len(all_keys), np.int64)
            np.add.at(total, place, np.concatenate([sums, value]))
            keys, sums, at = all_keys, total, to
            if len(keys) > MOST_HELD:
                yield emit()
                keys, sums = keys[:0], sums[:0]

    for b in batches:
        table = pa.Table.from_batches([b])
        if carry is not None:
            table = pa.concat_tables([carry, table])
        if table.num_rows:
            lang, term = (table.column(k).combine_chunks().dictionary_encode().indices.to_numpy() for k in (0, 1))
            last = int(np.flatnonzero(_changes([lang, term]))[-1])  # the last term may go on in the next batch
            carry = table.slice(last)
            yield from add(table.slice(0, last))
    if carry is not None:
        yield from add(carry)
    if len(keys):
        yield emit()


def divergence_audit(docs: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
                     least_texts: int = 3, most_ranks: int = 200) -> DataFrame:
    """lang, source, part, item, value, rank.  Part ``pair`` has each other
    source of the language with the summed divergence of the two sources' term
    shares, part ``term`` the ``most_ranks`` terms that a source has most beyond
    its language's share.

    Null language, source or text counts as ''.  A group without terms is
    compared like any other; a language without kept terms has pairs of value 0
    and no terms.  Ties go by the item's bytes.  Repeated rows count each; an
    empty table gives no rows.  Columns of other names are not read.

    Terms that neither of two sources has need only be counted, those that one
    has follow from its counts, and those that both have are summed in the task
    that holds the term, so no row is made for a pair and a term."""
    counts, of_term = term_counts(docs, lang_col, source_col, text_col), Window.partitionBy("lang", "term")
    kept = stored(counts.withColumns({
        "lang_texts": F.sum("texts").over(of_term), "lang_n": F.sum("n").over(of_term),
        "first": F.row_number().over(of_term.orderBy("source")) == 1}).where(F.col("lang_texts") >= least_texts).select(
            "lang", "source", "term", "n", "lang_n", "first"), "kept-terms")
    every = _filled(picked(docs, lang=lang_col, source=source_col)).distinct()
    of_group = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"), F.count(F.lit(1)).alias("has"))
    of_lang = kept.groupBy("lang").agg(F.sum("n").alias("lang_total"), F.count_if("first").alias("kinds"))
    groups = every.join(of_group, ["lang", "source"], "left").join(of_lang, "lang", "left").fillna(0)
    groups = stored(groups.withColumn("p0", share("0", "total", "kinds")), "groups")

    rows = kept.join(groups, ["lang", "source"]).withColumns({"p": share("n", "total", "kinds"), "q": share("lang_n", "lang_total", "kinds")})
    by = Window.partitionBy("lang", "source")
    terms = rows.where("p > q").select("lang", "source", F.col("term").alias("item"), apart("p", "q").alias("value"))
    terms = terms.withColumn("rank", F.row_number().over(by.orderBy(F.desc("value"), "item"))).where(F.col("rank") <= most_ranks)

    others = groups.select("lang", F.col("source").alias("other"), F.col("has").alias("other_has"), F.col("p0").alias("other_p0"))
    pairs = groups.join(others, "lang").where("source <> other")
    neither = pairs.select("lang", "source", "other", F.when(F.col("kinds") > 0, (F.col("kinds") - F.col("has") - F.col("other_has")) * apart("p0", "other_p0"))
                           .otherwise(0).alias("value"))
    levels = rows.groupBy("lang", "source", "p").agg(F.count(F.lit(1)).alias("of"))
    one = levels.join(others.select("lang", "other", "other_p0"), "lang").where("source <> other").groupBy("lang", "source", "other").agg(
        F.sum(F.col("of") * apart("p", "other_p0")).alias("there"), F.sum(F.col("of") * apart("other_p0", "p")).alias("back"))
    one = one.select("lang", F.inline(F.array(F.struct("source", "other", F.col("there").alias("value")),
                                              F.struct(F.col("other").alias("source"), F.col("source").alias("other"), F.col("back").alias("value")))))
    both = rows.select("lang", "term", "source", "p", "p0").repartition("lang", "term").sortWithinPartitions("lang", "term").mapInArrow(
        _pair_task, "lang string, source string, other string, value bigint")
    summed = neither.unionByName(one).unionByName(both).groupBy("lang", "source", F.col("other").alias("item")).agg(
        F.sum(F.col("value").cast("decimal(38,0)")).cast("bigint").alias("value"))
    ranked = summed.withColumn("rank", F.row_number().over(by.orderBy(F.desc("value"), "item")))
    out = lambda df, part: df.select("lang", "source", F.lit(part).alias("part"), "item", "value", F.col("rank").cast("int").alias("rank"))
    return out(ranked, "pair").unionByName(out(terms, "term"))
