"""Byte-pair encoding and decoding through a table of distinct words.

Spark's regex functions split the texts into the tokenizer's words.  The texts
of a block of some megabytes become positions in the block's list of distinct
words.  The words of all blocks make one table, sorted by word, in which each
distinct word is encoded once; its ids go back to every block that has it, by
position.  Decoding joins the ids with the vocabulary's pieces: once for each
distinct word of a block if texts are encoded and decoded together, else, in
blocks again, once for each distinct id.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import bound_batches, held, id_text, stored

#: Bytes of words (or of ids) in a block; a longer text is a block of its own.
BLOCK = 1 << 24
#: Entries of lists that are put together at a time.
STEP = 500_000
#: Distinct words move in so many groups; more than tasks are ever wanted for the word table.
BUCKETS = 1024

#: Fixed: the words of a byte-level tokenizer, in Java's notation.
_SPACE = r"\p{IsWhite_Space}"
WORDS = (r"'(?:[stmd]|re|ve|ll)| ?\p{L}+| ?\p{N}+| ?[^" + _SPACE + r"\p{L}\p{N}]+"
         r"|[" + _SPACE + r"]+(?![^" + _SPACE + r"])|[" + _SPACE + r"]+")
#: Characters that the regex library may know less of than the tokenizer does.
UNKNOWN = r"\p{Cn}"


def _load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()
    return tok


def _tokenizer(path: str):
    return held(("tokenizer", path), lambda: _load(path))


def _specials(path: str) -> list[str]:
    """Texts of the added tokens, longest first; only such as stand for themselves."""
    spec = json.loads(_tokenizer(path).to_str())
    pre = spec["pre_tokenizer"] or {}
    if spec["normalizer"] or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
        raise ValueError("not a plain byte-level tokenizer")
    if any(t["lstrip"] or t["rstrip"] or t["single_word"] or t["normalized"] for t in spec["added_tokens"]):
        raise ValueError("added tokens that take in what is beside them are not supported")
    return sorted((t["content"] for t in spec["added_tokens"]), key=lambda t: (-len(t), t))


def words_of(text: Column, specials: list[str]) -> Column:
    """The words of a text, null where it has characters that only the tokenizer
    itself can class.  Added tokens are words of their own, and what lies
    between them is split by itself."""
    plain = lambda t: F.regexp_extract_all(t, F.lit(WORDS), F.lit(0))
    words = plain(text)
    if specials:
        marks = F.lit("|".join("".join(f"\\{c}" if not c.isalnum() else c for c in t) for t in specials))
        mixed = F.flatten(F.zip_with(F.split(text, marks), F.regexp_extract_all(text, marks, F.lit(0)),
                                     lambda part, mark: F.concat(plain(part), F.filter(F.array(mark), lambda m: m.isNotNull()))))
        words = F.when(F.regexp_like(text, marks), mixed).otherwise(words)
    return F.when(~F.regexp_like(text, F.lit(UNKNOWN)), words)


def _split_here(path: str, specials: list[str], text: str) -> list[str]:
    """``words_of`` by the tokenizer's own splitter."""
    split = _tokenizer(path).pre_tokenizer.pre_tokenize_str
    out = []
    for k, part in enumerate(re.split("(" + "|".join(map(re.escape, specials)) + ")", text) if specials else [text]):
        out += [part] if k % 2 else [part[a:b] for _, (a, b) in split(part)] if part else []
    return out


# ------------------------------------------------------------------- blocks
def _flat(values: pa.Array) -> tuple[np.ndarray, bytes]:
    """How many bytes each entry has, and all of them: strings, binaries, numbers, or lists of numbers."""
    if pa.types.is_list(values.type):
        sizes, values = np.diff(values.offsets.to_numpy()), values.flatten()
        return sizes.astype(np.uint32) * 4, values.to_numpy().astype("<u4").tobytes()
    if pa.types.is_integer(values.type):
        return np.full(len(values), 4, np.uint32), values.to_numpy().astype("<u4").tobytes()
    sizes = pc.binary_length(values).to_numpy(zero_copy_only=False).astype(np.uint32)
    return sizes, pc.binary_join(pa.array([values.cast(pa.binary())], pa.list_(pa.binary())), b"")[0].as_py() if len(values) else b""


def _buckets(items: pa.Array) -> np.ndarray:
    if pa.types.is_integer(items.type):
        return items.to_numpy() % BUCKETS
    return np.fromiter(map(zlib.crc32, items.cast(pa.binary()).to_pylist()), np.int64, len(items)) % BUCKETS


class _Block:
    """Rows (key, list): ``keys``, the lengths of their lists, ``items``, the
    distinct entries, bucket by bucket, where each bucket begins, and ``codes``,
    the lists' entries as places among them.  ``number`` is a digest of the
    items and of the place in the table, so that two readings that do not see
    the same rows do not meet."""

    def __init__(self, place: str, keys: pa.Array, lists: pa.ListArray):
        coded = lists.flatten().dictionary_encode()
        bucket = _buckets(coded.dictionary)
        order = np.argsort(bucket, kind="stable")
        place_of = np.empty(len(order), np.int64)
        place_of[order] = np.arange(len(order))
        self.keys, self.sizes = keys, np.diff(lists.offsets.to_numpy()).astype(np.int32)
        self.items, self.codes = coded.dictionary.take(pa.array(order)), place_of[coded.indices.to_numpy()]
        self.bucket = bucket[order]
        lengths, data = _flat(self.items)
        digest = xxhash.xxh3_64(f"{place} {len(order)}")
        digest.update(lengths.tobytes())
        digest.update(data)
        self.number = digest.intdigest() - (1 << 63)


def _ends(lists: pa.ListArray) -> np.ndarray:
    """Bytes of the entries before each list and after the last."""
    offsets, values = lists.offsets.to_numpy().astype(np.int64), lists.values
    if not pa.types.is_string(values.type):
        return offsets * (values.type.bit_width // 8)
    return np.concatenate([[0], np.cumsum(pc.binary_length(values).to_numpy(), dtype=np.int64)])[offsets]


def _in_blocks(batches: Iterator[pa.RecordBatch], resplit=None) -> Iterator[_Block]:
    """Rows (key, list[, text]) by blocks, which may take in several batches; a
    null list is made from the text."""
    at_row, part, held_rows, held_bytes = 0, TaskContext.get().partitionId(), [], 0

    def whole():
        nonlocal at_row, held_rows, held_bytes
        keys, lists = (pa.concat_arrays(x) for x in zip(*held_rows))
        place, at_row = f"{part} {at_row}", at_row + len(keys)
        held_rows, held_bytes = [], 0
        return _Block(place, keys, lists)

    for b in batches:
        lists = b.column(1)
        if lists.null_count:
            parts, at = [], 0
            for k in np.flatnonzero(lists.is_null()).tolist():
                parts += [lists.slice(at, k - at), pa.array([resplit(b.column(2)[k].as_py())], lists.type)]
                at = k + 1
            lists = pa.concat_arrays([*parts, lists.slice(at)])
        ends, at = _ends(lists), 0
        while at < b.num_rows:
            to = int(np.searchsorted(ends, ends[at] + BLOCK - held_bytes, "right")) - 1
            if to <= at:
                if held_rows:
                    yield whole()
                    continue
                to = at + 1
            held_rows.append((b.column(0).slice(at, to - at), lists.slice(at, to - at)))
            held_bytes, at = held_bytes + int(ends[to] - ends[at]), to
    if held_rows:
        yield whole()


def _wide(n: int) -> np.dtype:
    return np.dtype(np.uint16 if n <= 1 << 16 else np.uint32)


def _list_of(values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _packed(data: bytes) -> pa.Array:
    return pa.array([pa.compress(data, "zstd", asbytes=True)], pa.binary())


_HEAD = "block bigint, k int, n int, doc_ids array<bigint>, sizes array<int>, codes binary"
_SPOT = "bucket int, block bigint, k int, items array<{}>"
_FOUND = "block bigint, k int, lengths binary, data binary, n_bytes array<int>"


def _heads(resplit=None):
    """One row a block: how many distinct entries, the keys, the lengths, the places."""
    def run(batches):
        for block in _in_blocks(batches, resplit):
            n = len(block.items)
            yield pa.RecordBatch.from_arrays([pa.array([block.number], pa.int64()), pa.array([-1], pa.int32()), pa.array([n], pa.int32()), _list_of(block.keys),
                                              _list_of(pa.array(block.sizes)), _packed(block.codes.astype(_wide(n)).tobytes())],
                                             names=["block", "k", "n", "doc_ids", "sizes", "codes"])
    return run


def _spots(resplit=None):
    """A row for each bucket of distinct entries of each block, with the place of the first."""
    def run(batches):
        for block in _in_blocks(batches, resplit):
            first = np.flatnonzero(np.concatenate([[True], block.bucket[1:] != block.bucket[:-1]])) if len(block.bucket) else block.bucket
            ends = pa.array(np.append(first, len(block.bucket)), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(block.bucket[first], pa.int32()), pa.array(np.full(len(first), block.number), pa.int64()), pa.array(first, pa.int32()),
                                              pa.ListArray.from_arrays(ends, block.items)], names=["bucket", "block", "k", "items"])
    return run


def _each(spots: DataFrame) -> DataFrame:
    """A row for each entry: block, k, item."""
    return spots.select("block", F.col("k").alias("first"), F.posexplode("items").alias("k", "item")).select("block", (F.col("first") + F.col("k")).alias("k"), "item")


def _found_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(block, k, value) rows sorted by block and k, with the values of neighbouring places in one row."""
    for b in batches:
        block, k = b.column(0).to_numpy(), b.column(1).to_numpy()
        cut = np.flatnonzero((block[1:] != block[:-1]) | (k[1:] != k[:-1] + 1)) + 1 if b.num_rows else []
        for x, y in zip([0, *cut] if b.num_rows else [], [*cut, b.num_rows]):
            lengths, data = _flat(b.column(2).slice(x, y - x))
            yield pa.RecordBatch.from_arrays([pa.array(block[x:x + 1]), pa.array(k[x:x + 1]), _packed(lengths.tobytes()), _packed(data),
                                              _list_of(pa.array([lengths.nbytes, len(data)], pa.int32()))], names=["block", "k", "lengths", "data", "n_bytes"])


def _rejoined(heads: DataFrame, found: DataFrame) -> DataFrame:
    """Each block's row (k is -1), followed by the values ``found`` (block, k, value)
    for its distinct entries, in order of their places.  Either reading of the
    table is a stage that begins with it, so both number its parts alike."""
    packed = found.sortWithinPartitions("block", "k").mapInArrow(_found_rows, _FOUND)
    return heads.unionByName(packed, allowMissingColumns=True).repartition("block").sortWithinPartitions("block", "k").select(
        "n", "doc_ids", "sizes", "codes", "lengths", "data", "n_bytes")


def _by_block(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, bytes]]:
    """Of each block that streams by: the keys, list lengths and places, where each entry's bytes end, and those bytes."""
    head, lengths, data = None, [], []

    def whole():
        n, keys, sizes, codes = head
        ends = np.cumsum(np.frombuffer(b"".join(lengths), np.uint32), dtype=np.int64)
        if len(ends) != n:
            raise RuntimeError("the rows changed between two readings of the table: write them first")
        size = int(sizes.sum()) * _wide(n).itemsize
        return keys, sizes, np.frombuffer(pa.decompress(codes, size, "zstd") if size else b"", _wide(n)), ends, b"".join(data)

    unpack = lambda x, n: pa.decompress(x, n, "zstd", asbytes=True) if n else b""
    for b in batches:
        for n, keys, sizes, codes, some, more, bytes_ in zip(*b.columns):
            if n.is_valid:
                if head is not None:
                    yield whole()
                head, lengths, data = (n.as_py(), keys.values, sizes.values.to_numpy(), codes.as_py()), [], []
            elif head is not None:
                x, y = bytes_.as_py()
                lengths.append(unpack(some.as_py(), x))
                data.append(unpack(more.as_py(), y))
    if head is not None:
        yield whole()


def _slices(sizes: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """Ranges of lists, and of their entries, of some size."""
    ends, at = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)]), 0
    while at < len(sizes):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + STEP, "right")) - 1)
        yield at, to, int(ends[at]), int(ends[to])
        at = to


def _texts(parts: list[bytes], codes: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """The joined entries of every list."""
    ends = np.concatenate([[0], np.cumsum(sizes)]).tolist()
    codes = codes.tolist()
    return pa.array([b"".join(map(parts.__getitem__, codes[a:b])).decode("utf-8", "replace") for a, b in zip(ends, ends[1:])], pa.string())


def _encoded_rows(pieces=None):
    """Keys and ids, and the text that the ids' ``pieces`` make."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = None if pieces is None else pa.array(pieces.value, pa.binary())
        for keys, sizes, codes, ends, data in _by_block(batches):
            ids, starts = np.frombuffer(data, "<u4").astype(np.int32), np.concatenate([[0], ends // 4])
            each = np.diff(starts)
            parts = None if pieces is None else pc.binary_join(pa.ListArray.from_arrays(pa.array(starts, pa.int32()), vocabulary.take(pa.array(ids))), b"").to_pylist()
            for a, b, x, y in _slices(sizes):
                some = codes[x:y]
                n = each[some]
                to = np.concatenate([[0], np.cumsum(n)])
                spots = np.arange(to[-1]) + np.repeat(starts[:-1][some] - to[:-1], n)
                out = [keys.slice(a, b - a), pa.ListArray.from_arrays(pa.array(to[np.concatenate([[0], np.cumsum(sizes[a:b])])], pa.int32()), pa.array(ids[spots]))]
                if parts is not None:
                    out.append(_texts(parts, some, sizes[a:b]))
                yield pa.RecordBatch.from_arrays(out, names=["doc_id", "ids", "text"][:len(out)])
    return run


def _decoded_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for keys, sizes, codes, ends, data in _by_block(batches):
        ends = ends.tolist()
        parts = [data[x:y] for x, y in zip([0, *ends], ends)]
        for a, b, x, y in _slices(sizes):
            yield pa.RecordBatch.from_arrays([keys.slice(a, b - a), _texts(parts, codes[x:y], sizes[a:b])], names=["doc_id", "text"])


# ------------------------------------------------------------------- tables
def _encode_words(path: str):
    """Ids in place of the words of sorted rows; a word's rows are neighbours, and it is encoded once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tok, last, last_ids = _tokenizer(path), None, None
        for b in batches:
            coded = b.column(2).dictionary_encode()
            words = coded.dictionary.to_pylist()
            known = [last_ids] if words and words[0] == last else []
            ids = known + [e.ids for e in tok.encode_batch_fast(words[len(known):], add_special_tokens=False)]
            if words:
                last, last_ids = words[-1], ids[-1]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(ids, pa.list_(pa.int32())).take(coded.indices)], names=["block", "k", "ids"])
    return run


def word_ids(spots: DataFrame, tokenizer_path: str) -> DataFrame:
    """block, k and ids: the word table.  Blocks' words are dealt by bucket; within
    a task a word's rows are neighbours, and the word is encoded once."""
    return _each(spots.repartition("bucket")).sortWithinPartitions("item").mapInArrow(_encode_words(tokenizer_path), "block bigint, k int, ids array<int>")


@lru_cache(maxsize=1)
def _byte_of() -> dict[str, int]:
    """The byte for which a character of a byte-level vocabulary stands: printable
    Latin-1 characters for themselves, the other bytes, in order, from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(other)}


def pieces_of(tokenizer_path: str) -> list[bytes]:
    """The bytes of every id of the vocabulary, whose size the tokenizer file
    bounds; added tokens are their own text, unused ids nothing."""
    tok, byte = _tokenizer(tokenizer_path), _byte_of()
    added = {k: t.content.encode() for k, t in tok.get_added_tokens_decoder().items()}
    vocabulary = {k: added.get(k) or bytes(byte[c] for c in t) for t, k in tok.get_vocab(with_added_tokens=True).items()}
    return [vocabulary.get(k, b"") for k in range(max(vocabulary) + 1)]


def piece_table(spark: SparkSession, tokenizer_path: str) -> DataFrame:
    """id and piece of the whole vocabulary."""
    return spark.createDataFrame(list(enumerate(pieces_of(tokenizer_path))), "id int, piece binary")


def encode_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", decode: bool = False) -> DataFrame:
    """doc_id and ids (array<int>) of every row, as the tokenizer itself gives
    them; with ``decode`` also text, decoded from the ids.

    Null and empty texts have no ids and decode to an empty text.  Rows with
    null, repeated or equal keys are rows like any other; an empty table gives
    no rows; other columns are not read.  Texts are encoded whole.  A text with
    characters unknown to Spark's regex library is split by the tokenizer.

    The texts are read and split twice, once for the distinct words of blocks and
    once for the places, and a block whose two readings differ is an error: write
    a table first whose rows may change when it is computed again.  Distinct
    words of blocks move to the word table and back, the places once; a task
    holds one block, and the session's Arrow batches are bounded.  With ``decode``, the ids of a block's distinct words are
    joined with the vocabulary's pieces, which are broadcast."""
    spark, specials = docs.sparkSession, _specials(tokenizer_path)
    bound_batches(spark)
    rows = id_text(docs, id_col, text_col).withColumn("text", F.coalesce("text", F.lit("")))
    rows = rows.select("doc_id", words_of(F.col("text"), specials).alias("words"), F.when(F.regexp_like("text", F.lit(UNKNOWN)), F.col("text")).alias("text"))
    resplit = lambda text: _split_here(tokenizer_path, specials, text)
    ids = word_ids(rows.mapInArrow(_spots(resplit), _SPOT.format("string")), tokenizer_path)
    pieces = spark.sparkContext.broadcast(pieces_of(tokenizer_path)) if decode else None
    return _rejoined(rows.mapInArrow(_heads(resplit), _HEAD), ids).mapInArrow(_encoded_rows(pieces), "doc_id bigint, ids array<int>" + ", text string" * decode)


def decode_documents(encoded: DataFrame, tokenizer_path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id and text of every row of ids, special tokens included; ids outside
    the vocabulary and null ids give nothing, null or empty lists an empty text,
    and bytes that are no UTF-8 the replacement character.  The rows are written
    once, as they may come from a shuffle, and then read twice."""
    bound_batches(encoded.sparkSession)
    rows = encoded.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(ids_col).cast("array<int>"), F.array().cast("array<int>")).alias("ids"))
    rows = stored(rows.withColumn("ids", F.filter("ids", lambda k: k.isNotNull())), "ids")
    pieces = F.broadcast(piece_table(encoded.sparkSession, tokenizer_path).withColumnRenamed("id", "item"))
    spots = _each(rows.mapInArrow(_spots(), _SPOT.format("int")).repartition("bucket")).join(pieces, "item", "left")
    found = spots.select("block", "k", F.coalesce("piece", F.lit(b"")).alias("piece"))
    return _rejoined(rows.mapInArrow(_heads(), _HEAD), found).mapInArrow(_decoded_rows, "doc_id bigint, text string")


def token_digest(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the text decoded from them."""
    both = encode_documents(docs, tokenizer_path, id_col, text_col, decode=True)
    return both.select("doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(F.array_join(F.col("ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
                       F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"))
