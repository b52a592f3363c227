"""Near duplicates by an exact n-gram Jaccard join with adaptive prefixes.

Each text is its set of distinct word shingles (64-bit hashes), ordered by
how common they are in the whole corpus, rarest first.  Two sets with enough
in common must share at least l of their first ``n - need + l`` shingles, for
any l.  Every document picks its own l: a longer prefix costs more look-ups
but demands more shared shingles before a pair is verified, and the estimated
frequencies of its shingles say which is cheaper.  A pair is held to the
smaller l of the two.

Large groups of near copies would make pairs by the square of their size, so
links are found in two steps that lose none.  First every document is
verified against one leader, the document among those sharing a prefix
shingle in which that shingle comes first.  Then only documents that are not
yet in one component are paired, under the same prefix bound and finer bounds
by size and place.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, gram_hashes, held, id_text, id_text_batches, numbered, stored
from .components import connected_components

#: The frequency table has 2**SLOT_BITS slots and travels in chunks.
SLOT_BITS, CHUNK_BITS = 20, 14
MOST_MATCHES = 4
#: Nodes that meet at a shingle without regard to their sizes.
FEW = 64
#: Rows (two numbers and a flag) that may be broadcast.
MOST_BROADCAST = 1_000_000


_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
#: Bytes hashed at a time.
_BLOCK = 1 << 20
#: The low k bytes of a 64-bit number.
_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
_BY_LENGTH = np.uint64(0x9E3779B97F4A7C15)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ h >> np.uint64(30)) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ h >> np.uint64(27)) * np.uint64(0x94D049BB133111EB)
    return h ^ h >> np.uint64(31)


def _word_hashes(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the words of up to ``_BLOCK`` bytes.  A word of up to
    eight bytes is one number, of up to sixteen two; they are mixed with its
    length, one after the other.  Longer words are hashed by the library."""
    b = np.frombuffer(data, np.uint8)
    edge = np.flatnonzero(np.diff(np.concatenate(([True], _BLANK[b], [True]))))
    start, end = edge[::2], edge[1::2]
    n = end - start
    eight = np.ndarray((len(b) + 9,), "<u8", np.concatenate([b, np.zeros(16, np.uint8)]), strides=(1,))
    h = _mixed(eight[start] & _LOW[np.minimum(n, 8)] ^ n.astype(np.uint64) * _BY_LENGTH)
    more = np.flatnonzero(n > 8)
    h[more] = _mixed(h[more] ^ eight[start[more] + 8] & _LOW[np.minimum(n[more] - 8, 8)])
    for k in np.flatnonzero(n > 16).tolist():
        h[k] = xxhash.xxh3_64_intdigest(data[start[k]:end[k]])
    return start, h


def _long_word_hashes(data: bytes) -> np.ndarray:
    """Words' hashes of more than a block: cut at blanks; a longer word is hashed by itself."""
    out, at = [], 0
    while at < len(data):
        end = at + _BLOCK
        if end < len(data):
            cut = max(data.rfind(c, at, end) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c"))
            if cut < 0:
                end = min((k for k in (data.find(c, end) for c in (b" ", b"\n", b"\t", b"\r", b"\x0b", b"\x0c")) if k >= 0), default=len(data))
                out.append(np.array([xxhash.xxh3_64_intdigest(data[at:end])], np.uint64))
                at = end
                continue
            end = cut + 1
        out.append(_word_hashes(data[at:end])[1])
        at = end
    return np.concatenate(out) if out else np.zeros(0, np.uint64)


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text; a text of fewer words is one
    shingle.  Short texts are hashed together, a block at a time."""
    held(None)  # no other operator's tables are needed any more
    data = [t.encode("utf-8", "surrogatepass").lower() if t else b"" for t in texts]
    hashes: list = [None] * len(data)
    at = 0
    while at < len(data):
        end, size = at, 0
        while end < len(data) and size + len(data[end]) + 1 <= _BLOCK:
            size += len(data[end]) + 1
            end += 1
        if end == at:
            hashes[at] = _long_word_hashes(data[at])
            at += 1
            continue
        start, h = _word_hashes(b"\n".join(data[at:end]))
        first = np.searchsorted(start, np.cumsum([0] + [len(d) + 1 for d in data[at:end]]))
        for k in range(at, end):
            hashes[k] = h[first[k - at]:first[k - at + 1]]
        at = end
    return [np.unique(gram_hashes(h, min(words, len(h)))) if len(h) else np.zeros(0, np.uint64) for h in hashes]


def shingle_set(text: str | None, words: int) -> np.ndarray:
    return shingle_sets([text], words)[0]


def node_of(s: np.ndarray) -> int:
    """Equal sets are one node: a signed 64-bit hash of the set."""
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


# ----------------------------------------------------------------- frequency
def _first_pass(words: int):
    def run(batches):
        counts = np.zeros(1 << SLOT_BITS, np.int32)
        for whole in batches:
            at = 0
            for ids, texts in id_text_batches([whole]):
                sets = shingle_sets(texts, words)
                if any(map(len, sets)):
                    counts += np.bincount((np.concatenate(sets) >> np.uint64(64 - SLOT_BITS)).astype(np.int64), minlength=len(counts)).astype(np.int32)
                n, nodes = len(sets), [node_of(s) if len(s) else None for s in sets]
                yield pa.RecordBatch.from_arrays([ids, whole.column(2).slice(at, n), pa.array([len(s) for s in sets], pa.int64()), pa.array(nodes, pa.int64()),
                                                  pa.nulls(n, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary())], names=_FIRST)
                at += n
        lane, size = TaskContext.get().partitionId() % 64, 1 << CHUNK_BITS
        chunks = [(k, zlib.compress(counts[k * size:(k + 1) * size].astype(np.int64).tobytes(), 1)) for k in range(len(counts) // size)]
        n = len(chunks)
        yield pa.RecordBatch.from_arrays([*[pa.nulls(n, pa.int64())] * 4, pa.array([c[0] for c in chunks], pa.int32()),
                                          pa.array([lane] * n, pa.int32()), pa.array([c[1] for c in chunks], pa.binary())], names=_FIRST)
    return run


_FIRST = ["doc_id", "text_key", "n", "node", "chunk", "lane", "counts"]


def _summed(chunks: DataFrame, keys: list[str]) -> DataFrame:
    """Adds up the chunks of equal keys, which stream by one after the other."""
    def one(key, counts):
        return pa.RecordBatch.from_arrays([pa.array([key[0]], pa.int32()), pa.array([key[1]], pa.int32()), pa.array([zlib.compress(counts.tobytes(), 1)], pa.binary())],
                                          names=["chunk", "lane", "counts"])

    def run(batches):
        last, total = None, None
        for b in batches:
            for chunk, lane, data in zip(*b.columns):
                key = (chunk.as_py(), lane.as_py() if "lane" in keys else 0)
                counts = np.frombuffer(zlib.decompress(data.as_py()), np.int64)
                if key != last:
                    if last is not None:
                        yield one(last, total)
                    last, total = key, counts.copy()
                else:
                    total += counts
        if last is not None:
            yield one(last, total)

    return chunks.select("chunk", "lane", "counts").repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "chunk int, lane int, counts binary")


def shingle_frequencies(first: DataFrame) -> np.ndarray:
    """How many sets have a shingle in each slot, over all documents: a table of
    fixed size.  At any corpus size, a shingle that is much more common than the
    mean of a slot stands out."""
    parts = _summed(_summed(first.where("chunk IS NOT NULL"), ["chunk", "lane"]), ["chunk"]).collect()  # 2**(SLOT_BITS - CHUNK_BITS) rows
    out = np.zeros((1 << SLOT_BITS - CHUNK_BITS, 1 << CHUNK_BITS), np.int64)
    for r in parts:
        out[r["chunk"]] += np.frombuffer(zlib.decompress(r["counts"]), np.int64)
    return out.ravel()


def bit_filter(values: DataFrame, column: str, most_bits: int = 27) -> np.ndarray:
    """A bit set of the values' lowest bits, 16 bits for each value but at most
    2**most_bits in all (16 MB); when it fills up, it only lets more through."""
    n = values.count()
    bits = max(16, min(most_bits, (16 * n - 1).bit_length())) if n else 16
    rows = values.select(F.col(column).bitwiseAND(F.lit((1 << bits) - 1)).alias("bit")).groupBy(F.shiftright("bit", 6).alias("at")).agg(
        F.expr("bit_or(shiftleft(1L, CAST(bit & 63 AS INT)))").alias("word")).toArrow()
    out = np.zeros(1 << bits - 6, np.int64)
    out[rows["at"].to_numpy()] = rows["word"].to_numpy()
    return out


def _in_filter(filter_: np.ndarray, node: int) -> bool:
    bit = node & (len(filter_) * 64 - 1)
    return bool(int(filter_[bit >> 6]) >> (bit & 63) & 1)


def _all_in_filter(filter_: np.ndarray, values: np.ndarray) -> np.ndarray:
    bit = values & (len(filter_) * 64 - 1)
    return (filter_[bit >> 6] >> (bit & 63) & 1).astype(bool)


# ------------------------------------------------------------------ prefixes
def need_of(n: int, m: int, percent: int) -> int:
    """The least intersection of sets of n and m with enough similarity."""
    return -(-percent * (n + m) // (100 + percent))


def chosen_prefix(s: np.ndarray, freq: np.ndarray, mean: float, percent: int) -> tuple[np.ndarray, int]:
    """The document's prefix, rarest shingles first, and its l."""
    count = freq[(s >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]
    order = np.argsort(count, kind="stable")  # s is sorted: equal counts go by hash
    n = len(s)
    least = -(-percent * n // 100)  # what any partner must share
    common = np.cumsum(np.maximum(0.0, count[order[:n - least + MOST_MATCHES]] - mean))
    best, best_cost = 1, None
    for k in range(1, min(MOST_MATCHES, least) + 1):
        scan = common[min(n - least + k, len(common)) - 1]
        cost = scan + (1 + n / 64) * scan / k
        if best_cost is None or cost < best_cost:
            best, best_cost = k, cost
    return s[order[:n - least + best]], best


def _prefixes(words: int, percent: int, freq, mean: float, copies):
    def run(batches):
        for _, texts in id_text_batches(batches):
            rows = []
            for s in shingle_sets(texts, words):
                if len(s):
                    node = node_of(s)
                    tokens, matches = chosen_prefix(s, freq.value, mean, percent)
                    rows.append((node, len(s), matches, _in_filter(copies.value, node), tokens.view(np.int64), parities(s)))
            cols = list(zip(*rows)) if rows else [[]] * 6
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, _PREFIX)], names=["node", "n", "l", "copies", "tokens", "parity"])
    return run


_PREFIX = [pa.int64(), pa.int32(), pa.int32(), pa.bool_(), pa.list_(pa.int64()), pa.list_(pa.int64())]


def parities(s: np.ndarray) -> np.ndarray:
    """1,024 bits: whether a slot of the hash has an odd number of the set's
    shingles.  Every bit in which two sets differ is a shingle that only one
    of them has."""
    return np.packbits((np.bincount((s & np.uint64(1023)).astype(np.int64), minlength=1024) & 1).astype(np.uint8)).view(np.int64)


def _may_be_near(pairs: DataFrame, short: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) whose parities do not rule out enough similarity."""
    side = lambda k: short.select(F.col("node").alias(k), F.col("n").alias(f"{k}_n"), F.col("parity").alias(f"{k}_parity"))
    both = pairs.join(side("u"), "u").join(side("v"), "v")
    apart = F.aggregate(F.zip_with("u_parity", "v_parity", lambda a, b: F.bit_count(a.bitwiseXOR(b))), F.lit(0), lambda t, x: t + x)
    most = F.col("u_n") + F.col("v_n") - 2 * _need(F.col("u_n"), F.col("v_n"), percent)
    return both.where(apart <= most).select("u", "v")


def _repeated(prefixes: DataFrame, repeated) -> DataFrame:
    """The prefixes without shingles that only one prefix has."""
    def run(batches):
        for b in batches:
            tokens, ends = b.column(4).values.to_numpy(), b.column(4).offsets.to_numpy()
            tokens, ends = tokens[ends[0]:ends[-1]], ends - ends[0]
            keep = _all_in_filter(repeated.value, tokens)
            place = np.arange(len(tokens)) - np.repeat(ends[:-1], np.diff(ends))
            kept = np.concatenate(([0], np.cumsum(keep)))[ends].astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(kept), pa.array(x[keep], t)) for x, t in ((place, pa.int32()), (tokens, pa.int64()))]
            out = pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), b.column(3), *lists], names=["node", "n", "l", "copies", "pos", "tokens"])
            out = out.append_column("parity", b.column(5))
            yield out.filter(pa.array(np.diff(kept) > 0))

    return prefixes.mapInArrow(run, "node bigint, n int, l int, copies boolean, pos array<int>, tokens array<bigint>, parity array<bigint>")


def _one_each(rows: DataFrame) -> DataFrame:
    """One row for each node; only nodes that may have copies are shuffled."""
    return rows.where("NOT copies").unionByName(rows.where("copies").dropDuplicates(["node"])).drop("copies")


def _need(n: Column, m: Column, percent: int) -> Column:
    return F.floor((percent * (n.cast("bigint") + m) + (99 + percent)) / (100 + percent)).cast("int")


def _sets(texts: DataFrame, words: int, wanted, copies) -> DataFrame:
    def run(batches):
        for _, some in id_text_batches(batches):
            rows = []
            for s in shingle_sets(some, words):
                if len(s) and _in_filter(wanted.value, node := node_of(s)):
                    rows.append((node, _in_filter(copies.value, node), s.view(np.int64)))
            cols = list(zip(*rows)) if rows else [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.bool_(), pa.list_(pa.int64())))], names=["node", "copies", "set"])

    return _one_each(texts.mapInArrow(run, "node bigint, copies boolean, set array<bigint>"))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs (u, v) with ``linked``: the exact similarity of their sets reaches the bound."""
    both = (pairs.join(sets.select(F.col("node").alias("u"), F.col("set").alias("a")), "u")
            .join(sets.select(F.col("node").alias("v"), F.col("set").alias("b")), "v"))
    same = F.size(F.array_intersect("a", "b")).cast("bigint")
    return both.select("u", "v", (100 * same >= percent * (F.size("a") + F.size("b") - same)).alias("linked"))


def _checked(pairs: DataFrame, texts: DataFrame, words: int, copies, percent: int, name: str) -> DataFrame:
    """``_verified`` pairs, written; the sets come from one more reading of the texts."""
    pairs = stored(pairs, f"{name}-pairs")
    wanted = pairs.sparkSession.sparkContext.broadcast(bit_filter(pairs.select(F.explode(F.array("u", "v")).alias("node")), "node"))
    sets = stored(_sets(texts, words, wanted, copies), f"{name}-sets")
    wanted.destroy()
    out = stored(_verified(pairs, sets, percent), name)
    discard(sets)
    return out


# --------------------------------------------------------------------- join
def _bound(c: Column, n: Column, last: Column, m: Column, other_last: Column) -> Column:
    """No more is shared than the c shingles up to the last shared one and what comes after it."""
    return c + F.least(n - last, m - other_last) - 1


def _leaders(flat: DataFrame) -> DataFrame:
    """For each shingle that several prefixes have: their number, and the node
    in which it comes first, of equals the smallest set, then node."""
    first = F.min(F.struct("pos", "n", "node"))
    return flat.groupBy("token").agg(F.count(F.lit(1)).alias("c"), first.alias("o")).where("c > 1").select(
        "token", "c", F.col("o.node").alias("lead"), F.col("o.n").alias("lead_n"), F.col("o.pos").alias("lead_pos"))


def _star_pairs(met: DataFrame, percent: int) -> DataFrame:
    """For each node the leader with which it shares most of its prefix, if that
    can be enough; other pairs are left to ``_rest_pairs``."""
    need = _need(F.col("n"), F.col("lead_n"), percent)
    ok = ((F.col("node") != F.col("lead")) & (F.least("n", "lead_n") >= need)
          & (F.col("pos") <= F.col("n") - need) & (F.col("lead_pos") <= F.col("lead_n") - need))
    shared = met.where(ok).groupBy("node", "n", "lead", "lead_n").agg(F.count(F.lit(1)).alias("c"), F.max("pos").alias("pos"), F.max("lead_pos").alias("lead_pos"))
    shared = shared.where(_bound(F.col("c"), F.col("n"), F.col("pos"), F.col("lead_n"), F.col("lead_pos")) >= need)
    order = F.col("c") * (1 << 20) + F.col("lead").bitwiseAND(F.lit((1 << 20) - 1))
    best = shared.groupBy("node").agg(F.max_by("lead", order).alias("lead"))
    return best.select(F.least("node", "lead").alias("u"), F.greatest("node", "lead").alias("v")).distinct()


def _rest_pairs(short: DataFrame, labelled: DataFrame, percent: int) -> DataFrame:
    """Pairs of nodes with different labels that share enough of their prefixes.

    Nodes meet at shingles in their first ``n - need + 1`` places, of which one
    at least must be shared: directly at a shingle that ``FEW`` nodes or fewer
    have, else by size.  There the shorter set is looked up under its own size
    class, the longer one under every class a partner may have; shingles whose
    nodes all have one label are left out, and within a shingle and class only
    rows outside the commonest label meet all others.  Then each pair's longer
    prefixes are compared: l shingles must be shared, and what follows the last
    shared one must suffice."""
    step = max(1.01, (100 / percent) ** 0.5)  # the sizes that a partner may have span two classes or three
    klass = lambda n: F.floor(F.log(n.cast("double")) / float(np.log(step))).cast("int")
    n, pos = F.col("n"), F.col("pos")
    least = F.ceil(n.cast("bigint") * percent / 100).cast("int")
    labelled = labelled.where(pos <= n - least)
    rare = labelled.where(F.col("c") <= FEW).select("token", "node", "label", "n", "pos")
    labelled = labelled.where(F.col("c") > FEW)
    several = labelled.groupBy("token").agg(F.min("label").alias("a"), F.max("label").alias("b")).where("a <> b").select("token")
    base = labelled.join(several, "token").select("token", "node", "label", "n", "pos")
    index = base.where(pos <= n - _need(n, n, percent)).withColumn("class", klass(n)).withColumn("probe", F.lit(False))
    probe = base.withColumn("class", F.explode(F.sequence(klass(least), klass(n)))).withColumn("probe", F.lit(True))
    lowest = F.greatest(least, F.ceil(F.pow(F.lit(step), F.col("class"))).cast("int") - 1, F.lit(1))
    probe = probe.where(pos <= n - _need(n, lowest, percent))
    rows = index.unionByName(probe)
    by_label = rows.groupBy("token", "class", "label").agg(F.count(F.lit(1)).alias("c"), F.max("probe").alias("some_probe"), F.min("probe").alias("all_probe"))
    mixed = by_label.groupBy("token", "class").agg(F.max_by("label", "c").alias("major"), F.count(F.lit(1)).alias("labels"),
                                                   F.max("some_probe").alias("some_probe"), F.min("all_probe").alias("all_probe"))
    mixed = mixed.where("labels > 1 AND some_probe AND NOT all_probe").select("token", "class", "major")
    rows = stored(rows.join(mixed, ["token", "class"]).withColumn("minor", F.col("label") != F.col("major")).drop("major"), "mixed")
    side = lambda df, k, *more: df.select("token", *more, *(F.col(c).alias(f"{k}_{c}") for c in ("node", "label", "n", "pos")))
    x, y = side(rows.where("NOT probe"), "x", "class", "minor"), side(rows.where("probe"), "y", "class", "minor")
    need = _need(F.col("x_n"), F.col("y_n"), percent)
    can = F.least("x_pos", "y_pos") + F.least(F.col("x_n") - F.col("x_pos"), F.col("y_n") - F.col("y_pos"))
    ok = ((F.col("x_label") != F.col("y_label")) & ((F.col("x_n") < F.col("y_n")) | ((F.col("x_n") == F.col("y_n")) & (F.col("x_node") < F.col("y_node"))))
          & (F.col("x_n") >= need) & (F.col("x_pos") <= F.col("x_n") - need) & (F.col("y_pos") <= F.col("y_n") - need) & (can >= need))
    meet = lambda a, b, *by: a.join(b, ["token", *by]).where(ok).select("x_node", "y_node")
    pairs = meet(side(rare, "x"), side(rare, "y")).unionByName(meet(x.where("minor").drop("minor"), y.drop("minor"), "class")).unionByName(
        meet(x.where("NOT minor").drop("minor"), y.where("minor").drop("minor"), "class")).distinct()

    prefix = lambda k: short.select(*(F.col(c).alias(f"{k}_{c}") for c in ("node", "n", "l", "pos", "tokens")))
    both = stored(pairs, "places-pairs").join(prefix("x"), "x_node").join(prefix("y"), "y_node")
    few = F.least("x_l", "y_l")

    def within(k):
        """The prefix that this pair needs."""
        far = F.size(F.filter(f"{k}_pos", lambda p: p <= F.col(f"{k}_n") - need + few - 1))
        return F.slice(f"{k}_tokens", 1, far)

    both = both.withColumns({"shared": F.array_intersect(within("x"), within("y"))}).where(F.size("shared") >= few)
    place = lambda k: F.get(F.col(f"{k}_pos"), F.array_position(F.col(f"{k}_tokens"), F.element_at("shared", -1)).cast("int") - 1)
    both = both.where(_bound(F.size("shared"), F.col("x_n"), place("x"), F.col("y_n"), place("y")) >= need)
    return both.select(F.least("x_node", "y_node").alias("u"), F.greatest("x_node", "y_node").alias("v"))


def ngram_join(docs: DataFrame, words: int = 4, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_shingles, component_id (the
    smallest doc_id reachable by links: 100 * shared >= percent * united),
    component (a number for each component, null without shingles) and text_key
    (xxhash64 of the text).

    A-Z are lower-cased; words end at blanks and at tab to carriage return.
    Null and empty texts and those without a word have no shingles, are linked
    with nothing and are their own component.  Repeated rows are copies.  A null
    key gets a result row but is no component id, unless all keys of a component
    are null.  Shingles and sets are compared as 64-bit hashes.

    The texts are read four times and never shuffled: for frequencies, for
    prefixes, and for the sets of the pairs of either step.  Prefix shingles
    that no other prefix has are counted and then left behind.  Sets equal to each other are one node from the start.  A shingle
    that very many documents have in their prefix is aggregated with map-side
    combining and joined by a sort-merge join, whose large partitions Spark
    splits.  All texts are compared whole, without a cap anywhere."""
    spark, texts = docs.sparkSession, id_text(docs, id_col, text_col)
    first = stored(texts.withColumn("text_key", F.xxhash64("text")).mapInArrow(
        _first_pass(words), "doc_id bigint, text_key bigint, n bigint, node bigint, chunk int, lane int, counts binary"), "first")
    freq = shingle_frequencies(first)
    rows = first.where("chunk IS NULL").select("doc_id", "text_key", "n", "node")
    nodes = stored(rows.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("copies")), "nodes")
    copies = spark.sparkContext.broadcast(bit_filter(nodes.where("copies > 1"), "node"))
    table = spark.sparkContext.broadcast(freq.astype(np.int32) if freq.max(initial=0) < 1 << 31 else freq)
    prefixes = stored(texts.mapInArrow(_prefixes(words, percent, table, float(freq.mean()), copies),
                                       "node bigint, n int, l int, copies boolean, tokens array<bigint>, parity array<bigint>"), "prefixes")
    table.destroy()
    tokens = stored(prefixes.select(F.explode("tokens").alias("token")).groupBy("token").count().where("count > 1").select("token"), "tokens")
    repeated = spark.sparkContext.broadcast(bit_filter(tokens, "token"))
    short = stored(_one_each(_repeated(prefixes, repeated)), "short")
    repeated.destroy()
    discard(prefixes)
    flat = short.select("node", "n", F.inline(F.arrays_zip("pos", "tokens"))).withColumnRenamed("tokens", "token")
    met = stored(flat.join(_leaders(flat), "token"), "met")

    star = _checked(_may_be_near(_star_pairs(met, percent), short, percent), texts, words, copies, percent, "star")
    label = connected_components(star.where("linked").select("u", "v"))
    labelled = met.drop("lead", "lead_n", "lead_pos").join(label, "node", "left").withColumn("label", F.coalesce("root", "node"))
    rest = _may_be_near(_rest_pairs(short, labelled, percent), short, percent).join(star.select("u", "v"), ["u", "v"], "left_anti")
    more = _checked(rest, texts, words, copies, percent, "rest").where("linked").select("u", "v")
    copies.destroy()
    label = connected_components(label.select(F.col("node").alias("u"), F.col("root").alias("v")).unionByName(more))

    roots = label.join(nodes, "node").groupBy("root").agg(F.min("least").alias("component"))
    linked = label.join(roots, "root").select("node", "root", "component")
    smallest = nodes.select("node", "least").join(linked, "node", "left").select(
        "node", F.coalesce("component", "least").alias("component_id"), F.coalesce("root", "node").alias("component"))
    return rows.join(smallest, "node", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"),
                                                      "component", "text_key")


def keep_one_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one row of each component, the one with the smallest key
    (null keys last, equal ones by a hash of the text; of repeated rows one);
    rows without a word all stay, as null and empty texts have none.  All columns
    stay, whatever their names; an empty table stays empty."""
    found = stored(ngram_join(docs, id_col=id_col, text_col=text_col, **options).where("component IS NOT NULL"), "components")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    best = found.groupBy("component").agg(F.min(rank).alias("best"), F.count(F.lit(1)).alias("of")).where("of > 1")
    rest = found.join(best, "component")
    gone = rest.where(rank != F.col("best")).select("doc_id", "text_key", F.lit(0).alias("again"))
    again = rest.where(rank == F.col("best")).groupBy("doc_id", "text_key").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select(
        "doc_id", "text_key", F.lit(1).alias("again"))
    marks = stored(gone.unionByName(again).distinct().toDF("__id", "__key", "__again"), "gone")
    if marks.count() <= MOST_BROADCAST:
        marks = F.broadcast(marks)  # else the texts are shuffled
    plain, id_at, text_at = numbered(docs), docs.columns.index(id_col), docs.columns.index(text_col)
    same = (F.xxhash64(F.col(f"c{text_at}").cast("string")) == F.col("__key")) & F.col(f"c{id_at}").cast("bigint").eqNullSafe(F.col("__id"))
    left = plain.join(marks.where("__again = 0"), same, "left_anti")
    if not marks.where("__again = 1").isEmpty():
        repeated = left.join(marks.where("__again = 1"), same).drop("__again").dropDuplicates(["__id", "__key"]).select(*plain.columns)
        left = left.join(marks.where("__again = 1"), same, "left_anti").unionByName(repeated)
    return left.toDF(*docs.columns)
