"""A frequency sketch of fixed width over set elements, and prefixes cut by it.

The sketch counts elements by their low bits.  Each task counts its rows in
one array; the arrays' chunks are added up by two shuffles (by chunk and lane,
then by chunk), so the driver gets one array whatever the table's size.  As an
order of elements it need only be the same for all rows: collisions make a
prefix less selective, never wrong."""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Slots of a chunk that travels, and lanes in which chunks are added up first.
CHUNK, LANES = 1 << 14, 64
_EPS = 1e-9


def _chunks(counts: np.ndarray, lane: int) -> pa.RecordBatch:
    parts = [(k, counts[at:at + CHUNK]) for k, at in enumerate(range(0, len(counts), CHUNK))]
    parts = [(k, zlib.compress(c.tobytes(), 1)) for k, c in parts if c.any()]
    return pa.RecordBatch.from_arrays([pa.array([k for k, _ in parts], pa.int32()), pa.array([lane] * len(parts), pa.int32()),
                                       pa.array([c for _, c in parts], pa.binary())], names=["chunk", "lane", "counts"])


def _count(bits: int):
    def run(batches):
        counts = np.zeros(1 << bits, np.int64)
        for b in batches:
            counts += np.bincount(b.column(0).flatten().to_numpy() & (1 << bits) - 1, minlength=len(counts))
        yield _chunks(counts, TaskContext.get().partitionId() % LANES)
    return run


def _add(batches):
    """Chunks sorted by key: equal ones follow each other."""
    key, total = None, None
    for b in batches:
        for chunk, lane, data in zip(*b.columns):
            now, counts = (chunk.as_py(), lane.as_py()), np.frombuffer(zlib.decompress(data.as_py()), np.int64)
            if now == key:
                total += counts
                continue
            if key is not None:
                yield _one(key, total)
            key, total = now, counts.copy()
    if key is not None:
        yield _one(key, total)


def _one(key: tuple[int, int], counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()),
                                       pa.array([zlib.compress(counts.tobytes(), 1)], pa.binary())], names=["chunk", "lane", "counts"])


def slot_counts(df: DataFrame, set_col: str, bits: int = 22) -> np.ndarray:
    """How many sets (``array<bigint>``) have an element in each of 2**bits slots
    (the elements' low bits), as 32-bit numbers."""
    kind = "chunk int, lane int, counts binary"
    parts = df.select(F.col(set_col).cast("array<bigint>")).mapInArrow(_count(bits), kind)
    parts = parts.repartition("chunk", "lane").sortWithinPartitions("chunk", "lane").mapInArrow(_add, kind)
    parts = parts.withColumn("lane", F.lit(0)).repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_add, kind)
    out = np.zeros(1 << bits, np.int64)
    for r in parts.collect():  # one row for each chunk of the fixed width
        out[r["chunk"] * CHUNK:(r["chunk"] + 1) * CHUNK] = np.frombuffer(zlib.decompress(r["counts"]), np.int64)[:len(out) - r["chunk"] * CHUNK]
    return np.minimum(out, (1 << 31) - 1).astype(np.int32)


#: Numbers of 64 bits in a row's parities, and rows whose parities are made at once.
PARITY_WORDS, PARITY_ROWS = 32, 512


def _parities(tok: np.ndarray, size: np.ndarray) -> np.ndarray:
    """For each row, whether an odd number of its elements falls on each of the bits."""
    bits, out, ends = PARITY_WORDS * 64, [], np.concatenate([[0], np.cumsum(size)])
    spot = (tok.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(32)).astype(np.int64) % bits
    for first in range(0, len(size), PARITY_ROWS):
        some = size[first:first + PARITY_ROWS]
        at = np.repeat(np.arange(len(some)) * bits, some) + spot[ends[first]:ends[first + len(some)]]
        out.append(np.packbits((np.bincount(at, minlength=len(some) * bits) & 1).astype(bool)).view(np.int64))
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def with_prefixes(df: DataFrame, set_col: str, counts: np.ndarray, jaccard: float, narrow: bool = False) -> DataFrame:
    """``df`` with ``pos`` and ``tok`` in place of the set: the first
    ``n - ceil(t*n) + 1`` elements of its n, seldom slots first, then by element,
    and their 1-based places in that order.  Elements alone in their slot are
    left out: no other set has them.  With ``narrow`` their low 32 bits stand for the
    elements.  ``parity`` is of the whole set: as many bits as differ between two
    rows' parities, so many elements at least are in one of the sets only.  A map
    over the rows."""
    held = df.sparkSession.sparkContext.broadcast(counts)
    keep = [c for c in df.columns if c != set_col]
    kind = np.int32 if narrow else np.int64

    def run(batches):
        freq = held.value
        for b in batches:
            lists = b.column(len(keep))
            tok, size = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
            parity = pa.ListArray.from_arrays(pa.array(np.arange(len(size) + 1) * PARITY_WORDS, pa.int32()), pa.array(_parities(tok, size)))
            row = np.repeat(np.arange(len(size)), size)
            c = freq[tok & len(freq) - 1]
            order = np.lexsort((tok, c, row))
            tok, c = tok[order], c[order]
            pos = np.arange(len(tok)) - np.repeat(np.cumsum(size) - size, size) + 1
            most = size - np.ceil(size * jaccard - _EPS).astype(np.int64) + 1
            kept = (pos <= most[row]) & (c > 1)
            ends = pa.array(np.concatenate([[0], np.cumsum(np.bincount(row[kept], minlength=len(size)))]), pa.int32())
            yield pa.RecordBatch.from_arrays([*b.columns[:len(keep)], pa.ListArray.from_arrays(ends, pa.array(pos[kept], pa.int32())),
                                              pa.ListArray.from_arrays(ends, pa.array(tok[kept].astype(kind))), parity], names=[*keep, "pos", "tok", "parity"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.select(keep).schema)
    return df.select(*keep, F.col(set_col).cast("array<bigint>")).mapInArrow(run, f"{schema}, pos array<int>, tok array<{'int' if narrow else 'bigint'}>, parity array<bigint>")


#: Bits of a map of elements at most (2^28: 32 MB), slots an element where there are fewer, bits of a chunk that
#: travels, and elements put in at once.
MAP_BITS, MAP_SLOTS, MAP_CHUNK, MAP_ROWS = 28, 8, 1 << 20, 1 << 22


def _slot(tok: np.ndarray, bits: int) -> np.ndarray:
    return (tok.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(64 - bits)).astype(np.int64)


def _bytes_of(slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes that have these bits (sorted), and their values."""
    if not len(slots):
        return slots, np.zeros(0, np.uint8)
    at = slots >> 3
    starts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
    return at[starts], np.bitwise_or.reduceat(np.uint8(1) << (slots & 7).astype(np.uint8), starts)


def _mapped(bits: int):
    """Which slots a task's elements fall on, and on which more than one row's do."""
    def put(once: np.ndarray, twice: np.ndarray, parts: list) -> None:
        slots = np.sort(np.concatenate(parts))
        again = np.concatenate([[False], slots[1:] == slots[:-1]])
        at, values = _bytes_of(slots[~again])
        twice[at] |= once[at] & values
        once[at] |= values
        at, values = _bytes_of(np.unique(slots[again]))
        twice[at] |= values

    def run(batches):
        once, twice, parts, held = np.zeros((1 << bits) // 8, np.uint8), np.zeros((1 << bits) // 8, np.uint8), [], 0
        for b in batches:
            parts.append(_slot(b.column(0).flatten().to_numpy(), bits))
            held += len(parts[-1])
            if held > MAP_ROWS:
                put(once, twice, parts)
                parts, held = [], 0
        if held:
            put(once, twice, parts)
        step = MAP_CHUNK // 8
        for k in range(0, len(once), step):
            if once[k:k + step].any():
                yield _chunk_maps(k // step, once[k:k + step], twice[k:k + step])
    return run


def _chunk_maps(chunk: int, once: np.ndarray, twice: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([chunk], pa.int32()), *(pa.array([zlib.compress(x.tobytes(), 1)], pa.binary()) for x in (once, twice))],
                                      names=["chunk", "once", "twice"])


def _joined_maps(batches):
    """Chunks sorted by number: equal ones follow each other."""
    key, once, twice = None, None, None
    for b in batches:
        for chunk, *data in zip(*b.columns):
            now, (a, c) = chunk.as_py(), (np.frombuffer(zlib.decompress(x.as_py()), np.uint8) for x in data)
            if now == key:
                twice |= c | once & a
                once |= a
                continue
            if key is not None:
                yield _chunk_maps(key, np.zeros(0, np.uint8), twice)
            key, once, twice = now, a.copy(), c.copy()
    if key is not None:
        yield _chunk_maps(key, np.zeros(0, np.uint8), twice)


def shared_slots(df: DataFrame, set_col: str, n_elements: int) -> np.ndarray:
    """Packed bits of the slots on which elements of more than one set fall: as many slots as
    are ``MAP_SLOTS`` times the elements, 2**``MAP_BITS`` at most.  An element of another slot is in one set only."""
    bits = max(20, min(MAP_BITS, int(n_elements * MAP_SLOTS).bit_length()))
    kind = "chunk int, once binary, twice binary"
    parts = df.select(set_col).mapInArrow(_mapped(bits), kind).repartition("chunk").sortWithinPartitions("chunk").mapInArrow(_joined_maps, kind)
    out = np.zeros((1 << bits) // 8, np.uint8)
    for r in parts.select("chunk", "twice").toLocalIterator():  # one row for each chunk of the bounded width
        at = r["chunk"] * (MAP_CHUNK // 8)
        out[at:at + MAP_CHUNK // 8] = np.frombuffer(zlib.decompress(r["twice"]), np.uint8)
    return out


def without_lone(df: DataFrame, shared: np.ndarray) -> DataFrame:
    """``df`` (with ``pos`` and ``tok``) without elements alone in their slot (``shared_slots``)."""
    held, bits = df.sparkSession.sparkContext.broadcast(shared), len(shared).bit_length() + 2
    at, cols = df.columns.index("tok"), df.columns

    def run(batches):
        twice = held.value
        for b in batches:
            lists = b.column(at)
            tok, size = lists.flatten().to_numpy(), np.diff(lists.offsets.to_numpy())
            slot = _slot(tok, bits)
            kept = (twice[slot >> 3] >> (slot & 7).astype(np.uint8) & 1).astype(bool)
            ends = pa.array(np.concatenate([[0], np.cumsum(kept)])[np.concatenate([[0], np.cumsum(size)])], pa.int32())
            out = list(b.columns)
            for k in (cols.index("pos"), at):
                out[k] = pa.ListArray.from_arrays(ends, pa.array(b.column(k).flatten().to_numpy()[kept]))
            yield pa.RecordBatch.from_arrays(out, names=cols)

    return df.mapInArrow(run, df.schema)
