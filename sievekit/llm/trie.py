"""Conversation prefix trie: how conversations share their first turns.

Equal conversations become one weighted sequence of turn ids.  Sequences are
dealt to shards by their first turn; where too many turns meet, by the first
two, four, eight and so on.  A shard's sequences are packed into a double-array
trie: turn ids are numbered densely, the child of state s by id c is the state
BASE[s] + c, and CHECK of it is s.  A walk over the arrays gives the shard's
nodes.  Nodes above a shard's cut are shared with other shards; their parts
are added up globally.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import picked, stored

#: Bytes of a turn's id and of a prefix's key (of their SHA-256).
WIDTH = 16
#: Turns of different conversations that one shard may hold.
MOST_TURNS = 300_000
#: Conversation ids joined into one row on the way to a digest.
MOST_IDS = 10_000


# ------------------------------------------------------------ double array
class DoubleArray:
    """A trie over dense ids; state 0 is the root, a free state's CHECK is -1."""

    def __init__(self):
        self.base, self.check = np.zeros(1024, np.int64), np.full(1024, -1, np.int64)
        self.check[0] = -2
        self.tail, self.holes, self.seen = 1, [], 0

    def _grow(self, size: int) -> None:
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.full(more, -1, np.int64)])

    def _take(self, state: int, ids: np.ndarray) -> None:
        """One BASE for all children of a state: at the first of some holes where
        all fit, else behind the last state."""
        while self.seen < len(self.holes) and self.check[self.holes[self.seen]] != -1:
            self.seen += 1
        for slot in [*(h for h in self.holes[self.seen:self.seen + 64] if self.check[h] == -1), self.tail]:
            to = slot - ids[0] + ids
            self._grow(int(to[-1]) + 1)
            if (self.check[to] == -1).all():
                break
        self.base[state], self.check[to] = slot - ids[0], state
        if to[-1] >= self.tail:
            gap = np.arange(self.tail, to[-1])
            self.holes += gap[self.check[gap] == -1].tolist()
            self.tail = int(to[-1]) + 1

    def _free(self, n: int) -> np.ndarray:
        got: list[int] = []
        while len(got) < n and self.seen < len(self.holes):
            some = self.holes[self.seen:self.seen + n - len(got)]
            self.seen += len(some)
            got += [h for h in some if self.check[h] == -1]
        self.holes, self.seen = (self.holes[self.seen:], 0) if self.seen > 100_000 else (self.holes, self.seen)
        more = n - len(got)
        self._grow(self.tail + more)
        out = np.array([*got, *range(self.tail, self.tail + more)], np.int64)
        self.tail += more
        return out

    def add(self, states: np.ndarray, ids: np.ndarray) -> None:
        """All children of some states, which have none yet: rows sorted by state and id."""
        first = np.flatnonzero(np.concatenate([[True], states[1:] != states[:-1]]))
        size = np.diff(np.append(first, len(states)))
        for at, n in zip(first[size > 1].tolist(), size[size > 1].tolist()):
            self._take(int(states[at]), ids[at:at + n])
        only = first[size == 1]
        slots = self._free(len(only))
        self.base[states[only]], self.check[slots] = slots - ids[only], states[only]

    def step(self, states: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The children's states, -1 where there is no such child."""
        to = self.base[states] + ids
        inside = (to > 0) & (to < len(self.check))
        to[~inside] = 0
        return np.where(inside & (self.check[to] == states), to, -1)


def packed_trie(ids: np.ndarray, start: np.ndarray, size: np.ndarray) -> DoubleArray:
    """The trie of sequences, given one after the other so that equal prefixes
    are neighbours: level by level, the distinct ids below each state."""
    trie, state, rows, depth = DoubleArray(), np.zeros(len(size), np.int64), np.flatnonzero(size > 0), 0
    while len(rows):
        at, c = state[rows], ids[start[rows] + depth]
        new = np.concatenate([[True], (at[1:] != at[:-1]) | (c[1:] != c[:-1])])
        s, k = at[new], c[new]
        order = np.lexsort((k, s))
        trie.add(s[order], k[order])
        state[rows] = trie.step(at, c)
        depth += 1
        rows = rows[size[rows] > depth]
    return trie


def _dense(data: bytes, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Dense numbers of the turn ids in sequences, counted up level by level, so
    that siblings have close ones; where each sequence starts; its ids' bytes."""
    n = len(data) // WIDTH
    raw = pa.FixedSizeBinaryArray.from_buffers(pa.binary(WIDTH), n, [None, pa.py_buffer(data)])
    start = np.cumsum(size) - size
    by_level = np.argsort(np.arange(n) - np.repeat(start, size), kind="stable")
    coded = raw.take(pa.array(by_level)).dictionary_encode()
    ids = np.zeros(n, np.int64)
    ids[by_level] = coded.indices.to_numpy()
    return ids, start, coded.dictionary


# ------------------------------------------------------------------- shards
_NODE = ["upper", "key", "path", "depth", "conv_id", "parent_conv_id", "n_convs", "chars", "n_children", "n_leaves", "saved", "ends"]
_NODE_SCHEMA = ("upper boolean, key binary, path array<binary>, depth bigint, conv_id bigint, parent_conv_id bigint, n_convs bigint, chars bigint, "
                "n_children bigint, n_leaves bigint, saved bigint, ends string")
_NODE_TYPES = [pa.bool_(), pa.binary(), pa.list_(pa.binary()), *[pa.int64()] * 8, pa.string()]


def child_key(parent: bytes, turn: bytes) -> bytes:
    return hashlib.sha256(parent + turn).digest()[:WIDTH]


ROOT = hashlib.sha256(b"").digest()[:WIDTH]


def shard_nodes(seqs: list[bytes], cuts: np.ndarray, chars: list[np.ndarray], weight: np.ndarray, least: np.ndarray, ends: list[str]) -> pa.RecordBatch:
    """The nodes of one shard.  Nodes below the cut are whole.  Of an upper node
    (fewer turns than its sequences' cut) only this shard's part is known: its
    key and its ancestors' keys, and what whole nodes add to it (children,
    leaves, saved); a whole node right at the cut carries its parent's key."""
    order = np.array(sorted(range(len(seqs)), key=seqs.__getitem__), np.int64)
    seqs, ends, cuts, weight, least = [seqs[k] for k in order], [ends[k] for k in order], cuts[order], weight[order], least[order]
    texts = np.concatenate([chars[k] for k in order] or [np.zeros(0)]).astype(np.int64)
    size = np.array([len(s) // WIDTH for s in seqs], np.int64)
    ids, start, turns = _dense(b"".join(seqs), size)
    trie = packed_trie(ids, start, size)

    n = len(trie.check)
    of, low, length, depth, kids, leaves, saved = (np.zeros(n, np.int64) for _ in range(7))
    whole, end_of = np.zeros(n, bool), np.full(n, -1, np.int64)
    keys, paths = {0: ROOT}, {0: []}
    of[0], low[0] = weight.sum(), least.min()
    state, rows, levels = np.zeros(len(size), np.int64), np.arange(len(size)), [np.zeros(1, np.int64)]
    level = 0
    while True:
        done = rows[size[rows] == level]
        end_of[state[done]] = done
        rows = rows[size[rows] > level]
        if not len(rows):
            break
        at = start[rows] + level
        state[rows] = to = trie.step(state[rows], ids[at])
        first = np.flatnonzero(np.concatenate([[True], to[1:] != to[:-1]]))
        node, level = to[first], level + 1
        of[node], low[node] = np.add.reduceat(weight[rows], first), np.minimum.reduceat(least[rows], first)
        length[node], depth[node], whole[node] = texts[at[first]], level, cuts[rows[first]] <= level
        for k in np.flatnonzero(~whole[node]).tolist():
            up = int(trie.check[node[k]])
            keys[int(node[k])], paths[int(node[k])] = child_key(keys[up], turns[int(ids[at[first[k]]])].as_py()), [*paths[up], keys[up]]
        levels.append(node)
    for node in levels[:0:-1]:
        up, known = trie.check[node], whole[node]
        leaves[node] += known & (kids[node] == 0)
        saved[node] += np.where(known, (of[node] - 1) * length[node], 0)
        for total, part in ((kids, known.astype(np.int64)), (leaves, leaves[node]), (saved, saved[node])):
            np.add.at(total, up, part)

    node = np.concatenate(levels)
    up = trie.check[node]
    has_upper = whole[node] & np.concatenate([[False], ~whole[up[1:]]])
    key = [keys[s] if s in keys else keys[int(trie.check[s])] if cut else None for s, cut in zip(node.tolist(), has_upper.tolist())]
    parent = pa.array(np.where(up >= 0, low[np.maximum(up, 0)], 0), mask=~whole[node] | has_upper)
    cols = [~whole[node], key, [paths.get(s) for s in node.tolist()], depth[node], low[node], parent, of[node], length[node], kids[node], leaves[node], saved[node],
            [ends[k] if k >= 0 else None for k in end_of[node].tolist()]]
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(cols, _NODE_TYPES)], names=_NODE)


def _shard_task(most_turns: int):
    """Tries of the sequences that stream by, sorted by shard; small shards share one."""
    def emit(held):
        seqs, cuts, chars, weight, least, ends = held
        out = shard_nodes(seqs, np.array(cuts, np.int64), chars, np.array(weight, np.int64), np.array(least, np.int64), ends)
        for at in range(0, out.num_rows, 10_000):
            yield out.slice(at, 10_000)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[] for _ in range(6)]
        turns, last = 0, None
        for b in batches:
            offsets = b.column(3).offsets.to_numpy()
            chars = b.column(3).values.to_numpy(zero_copy_only=False)
            plain = [b.column(k).to_pylist() for k in (0, 1, 2, 4, 5, 6)]
            for k, (shard, cut, seq, weight, least, ends) in enumerate(zip(*plain)):
                if turns >= most_turns and shard != last:
                    yield from emit(held)
                    held, turns = [[] for _ in range(6)], 0
                for store, value in zip(held, (seq, cut, chars[offsets[k]:offsets[k + 1]], weight, least, ends)):
                    store.append(value)
                turns, last = turns + 1 + len(seq) // WIDTH, shard
        if held[0]:
            yield from emit(held)

    return run


# ------------------------------------------------------------------ digests
def _id_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of sorted (key, conv_id) rows as comma-joined text."""
    for b in batches:
        for at in range(0, b.num_rows, MOST_IDS):
            key, conv = (c.slice(at, MOST_IDS).to_numpy(zero_copy_only=False) for c in b.columns)
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            text = [",".join(map(str, conv[x:y].tolist())) for x, y in zip(first.tolist(), [*first[1:].tolist(), len(key)])]
            yield pa.RecordBatch.from_arrays([pa.array(key[first], pa.binary()), pa.array(conv[first]), pa.array(text)], names=["key", "first", "ids"])


def _digest_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the joined chunks of each key, which stream by in order."""
    last, sha, out = None, None, []
    for b in batches:
        for key, _, ids in zip(*(c.to_pylist() for c in b.columns)):
            if key != last:
                if sha is not None:
                    out.append((last, sha.hexdigest()))
                last, sha = key, hashlib.sha256(ids.encode())
            else:
                sha.update(b"," + ids.encode())
        if out:
            yield _digests(out)
            out = []
    if sha is not None:
        yield _digests([(last, sha.hexdigest())])


def _digests(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows])], names=["key", "ends"])


def id_digests(members: DataFrame) -> DataFrame:
    """key and ends: the SHA-256 of each key's conv_ids, ascending and comma-joined.

    Rows are sorted by ranges of (key, conv_id), so that the members of a very
    large group lie in many tasks; what reaches the one task that must digest
    them in order is a stream of joined chunks, of which it holds one."""
    chunks = members.select("key", "conv_id").repartitionByRange("key", "conv_id").sortWithinPartitions("key", "conv_id").mapInArrow(
        _id_chunks, "key binary, first bigint, ids string")
    return chunks.repartition("key").sortWithinPartitions("key", "first").mapInArrow(_digest_chunks, "key binary, ends string")


# -------------------------------------------------------------------- tries
def _digest(c: Column) -> Column:
    return F.unhex(F.substring(F.sha2(c, 256), 1, 2 * WIDTH))


def turn_sequences(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """conv_id and turns (an array of id and chars), in order.  A turn's id is a
    digest of role and text, chars the text's code points; null role or text is
    empty; null turn numbers come first, equal ones go by id.  Rows with a null
    key belong to no conversation.  The texts themselves never move."""
    turns = picked(turns, conv_id=conv_col, turn=turn_col, role=role_col, text=text_col)
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turn_id = F.substring(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"), 256), 1, 2 * WIDTH)
    rows = turns.select(F.col("conv_id").cast("bigint").alias("conv_id"), F.struct(
        "turn", turn_id.alias("id"), F.char_length(text).alias("chars")).alias("t")).where("conv_id IS NOT NULL")
    return rows.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("t")).select(
        "conv_id", F.transform("t", lambda t: F.struct(t["id"].alias("id"), t["chars"].alias("chars"))).alias("turns"))


def branched(sequences: DataFrame, of: int = 100, most: int = 6) -> DataFrame:
    """Sequences whose first h turns are those of the conversation at the next
    lower multiple of ``of`` (fewer if it has fewer, none if it is absent); h is
    the crc32 of the decimal key modulo ``most``."""
    heads = sequences.where(F.col("conv_id") % of == 0).select(F.col("conv_id").alias("of"), F.slice("turns", 1, most - 1).alias("head"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    joined = sequences.withColumns({"of": F.col("conv_id") - F.col("conv_id") % of, "h": h}).join(heads, "of", "left")
    own = F.slice("turns", F.col("h") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return joined.select("conv_id", F.concat(F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.slice("turns", 1, 0)), own).alias("turns"))


def _cut_deep_enough(rows: DataFrame, most_turns: int) -> DataFrame:
    """``rows`` with cut (a number of turns) and shard (a key of the first ``cut``
    turns): deeper, by twofold steps, for prefixes in which too many turns meet."""
    prefix = lambda d: _digest(F.expr(f"substring(seq, 1, {WIDTH * d})"))
    rows, depth = rows.withColumns({"cut": F.lit(1), "shard": prefix(1)}), 1
    while True:
        hot = stored(rows.where(F.col("cut") == depth).groupBy("shard").agg(F.count(F.lit(1)).alias("of"), F.sum(F.length("seq") / WIDTH + 1).alias("turns"))
                     .where((F.col("of") > 1) & (F.col("turns") > most_turns)).select(F.col("shard").alias("hot")), "hot-prefixes")
        if hot.isEmpty():
            return rows
        depth *= 2
        rows = rows.join(hot, F.col("shard") == F.col("hot"), "left").withColumns({
            "cut": F.when(F.col("hot").isNull(), F.col("cut")).otherwise(depth),
            "shard": F.when(F.col("hot").isNull(), F.col("shard")).otherwise(prefix(depth))}).drop("hot")


def prefix_trie(sequences: DataFrame, most_turns: int = MOST_TURNS) -> DataFrame:
    """One row for each distinct run of first turns (also of none) in
    ``sequences`` (conv_id, turns, as from ``turn_sequences``): conv_id, the
    smallest member; depth; parent_conv_id, the parent's; n_convs, members;
    n_children; n_leaves, childless nodes in the subtree; saved_tokens, the
    subtree's sum of (members - 1) times the code points of the last text;
    ends_sha256, over the ids of members without further turns.

    Conversations without turns are members of the root.  Keys are taken to be
    distinct.  An empty table gives no rows.  Equal sequences are one row with a
    weight before anything meets; a task holds the turn ids of one conversation,
    or of several up to about twice ``most_turns`` turns."""
    rows = stored(sequences.select(
        "conv_id", F.unhex(F.array_join(F.transform("turns", lambda t: t["id"]), "")).alias("seq"),
        F.transform("turns", lambda t: t["chars"]).alias("chars")).withColumn("key", _digest(F.col("seq"))), "sequences")
    distinct = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("conv_id").alias("least"), F.first("seq").alias("seq"), F.first("chars").alias("chars"))
    distinct = stored(distinct.join(id_digests(rows), "key"), "distinct-sequences")
    shards = _cut_deep_enough(distinct, most_turns).select("shard", "cut", "seq", "chars", "n", "least", "ends")
    nodes = stored(shards.repartition("shard").sortWithinPartitions("shard").mapInArrow(_shard_task(most_turns), _NODE_SCHEMA), "nodes")

    empty = hashlib.sha256(b"").hexdigest()
    out = lambda df: df.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"),
                               F.coalesce("ends", F.lit(empty)).alias("ends_sha256"))
    upper = stored(nodes.where("upper").groupBy("key").agg(
        F.first("path").alias("path"), F.first("depth").alias("depth"), F.min("conv_id").alias("conv_id"), F.sum("n_convs").alias("n_convs"), F.first("chars").alias("chars"),
        F.sum("n_children").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"), F.max("ends").alias("ends")), "upper-nodes")
    root = upper.where("depth = 0").select("conv_id").first()
    if root is None:
        return out(nodes)
    above = upper.where("depth > 0").groupBy(F.element_at("path", -1).alias("key")).agg(F.count(F.lit(1)).alias("more"))
    upper = upper.join(above, "key", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0))).drop("more")
    own = upper.select(F.explode(F.concat("path", F.array("key"))).alias("key"), (F.col("n_children") == 0).cast("bigint").alias("leaf"),
                       ((F.col("n_convs") - 1) * F.col("chars")).alias("own")).groupBy("key").agg(F.sum("leaf").alias("leaf"), F.sum("own").alias("own"))
    upper = upper.join(own, "key").withColumns({"n_leaves": F.col("n_leaves") + F.col("leaf"), "saved": F.col("saved") + F.col("own")})
    # first turns, of which there may be very many, need no look-up of their parent
    parents = upper.where("depth > 0").select("key", F.col("conv_id").alias("parent_conv_id"))
    of_root = lambda df: df.withColumn("parent_conv_id", F.lit(root["conv_id"]))
    lower = nodes.where("NOT upper")
    at_cut = lower.where("key IS NOT NULL AND depth > 1").drop("parent_conv_id").join(parents, "key")
    deep_upper = upper.where("depth > 1").withColumn("key", F.element_at("path", -1)).join(parents, "key")
    parts = [lower.where("key IS NULL"), of_root(lower.where("key IS NOT NULL AND depth = 1")), at_cut,
             upper.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("bigint")), of_root(upper.where("depth = 1")), deep_upper]
    result = out(parts[0])
    for p in parts[1:]:
        result = result.unionByName(out(p))
    return result
