"""Best-fit packing of tokenised documents by a grouping genetic algorithm.

Documents become token ids and then pieces of at most ``capacity`` tokens.
Pieces of equal length are interchangeable, so the search works on the
histogram of lengths, which never has more than ``capacity`` entries however
large the corpus is.  A packing is a set of bin kinds (how many pieces of
which lengths) with multiplicities.  The genes are whole bins: crossover
injects well-filled bins of one parent into the other, takes out bins that
would use a piece twice, and best-fits the displaced pieces.  Populations
live on islands, one Spark group each; after every epoch each island's best
packing migrates to the next island through a shuffle.  The best packing is
then dealt out to the pieces by their rank within their length.
"""

from __future__ import annotations

import json
import random
import re
import zlib
from bisect import insort

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import held, id_text, id_text_batches, stored


# ------------------------------------------------------------- tokenisation
#: Letters that lower-casing and composing leave alone or map one to one.
_LETTERS = "a-zß-öø-ÿ"
_PLAIN = re.compile("[^\\t\\n\\r -~À-ÖØ-öø-ÿ]")
#: Fixed: the tokenizer file's own splitting pattern, for the characters above.
_SPLIT = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[0-9]|[^\\s{_LETTERS}0-9]+")
#: Fixed: the normalizer of the tokenizer file; it leaves lower-cased plain parts as they are.
_NORMALIZER = {"type": "Sequence", "normalizers": [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit bytes.

    The tokenizer never merges across white space or across the parts that its
    splitting pattern yields, so ids of lower-cased parts are remembered (twice
    ``limit`` at most) and joined: "Word", "word," and "(word)" share an entry,
    and no whole words are kept.  New parts go to the tokenizer's model without
    being normalized and split once more.  Texts with other characters than
    plain Latin ones, or with the text of a special token, go to the tokenizer
    whole."""

    def __init__(self, path: str, limit: int = 100_000):
        from tokenizers import Tokenizer, pre_tokenizers

        self.tok, self.limit, self.parts = Tokenizer.from_file(path), limit, {}
        self.words: dict = {}  # stays empty: parts alone are remembered
        added = [t.content for t in self.tok.get_added_tokens_decoder().values()]
        spec = json.loads(self.tok.to_str())
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [{}])
        split = steps[0].get("pattern", {}).get("Regex", "")
        self.by_parts = (split == "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
                         and spec.get("normalizer") == _NORMALIZER)
        self.special = re.compile("|".join(map(re.escape, added)) or "(?!)")
        close = spec["model"].get("end_of_word_suffix")
        vocab = self.tok.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[k for t, k in vocab.items() if close and t.endswith(close)]] = True
        if self.by_parts:
            self.plain = Tokenizer(self.tok.model)  # the same model, not a second one
            self.plain.pre_tokenizer = pre_tokenizers.Sequence(
                [pre_tokenizers.WhitespaceSplit(), *(self.tok.pre_tokenizer[k] for k in range(1, len(steps)))])

    def ids(self, texts: list[str]) -> list[bytes]:
        return [np.asarray(e.ids, "<u4").tobytes() for e in self.tok.encode_batch_fast(texts, add_special_tokens=False)]

    def learn(self, parts: list[str]) -> None:
        """Ids of parts, many in one call: a part's last id is one that ends a word."""
        for at in range(0, len(parts), 500):
            some = parts[at:at + 500]
            got = np.asarray(self.plain.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            ends = (4 * (np.flatnonzero(self.ends[got]) + 1)).tolist()
            if len(ends) == len(some):
                data = got.tobytes()
                self.parts.update(zip(some, (data[a:b] for a, b in zip([0, *ends], ends))))
            else:
                self.parts.update(zip(some, self.ids(some)))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        out: list = [b""] * len(texts)
        plain, whole = [], []
        for k, t in enumerate(texts):
            if t:
                by_parts = self.by_parts and not _PLAIN.search(t) and not self.special.search(t)
                (plain if by_parts else whole).append(k)
        for k, ids in zip(whole, self.ids([texts[k] for k in whole])):
            out[k] = ids
        for at in range(0, len(plain), 50):
            some = [(k, _SPLIT.findall(texts[k].lower())) for k in plain[at:at + 50]]
            new = list(set().union(*(ps for _, ps in some)).difference(self.parts))
            self.learn(new)
            get = self.parts.__getitem__
            for k, ps in some:
                out[k] = b"".join(map(get, ps))
            # when full, what came first stays: it is the most frequent
            for p in new[:max(0, len(self.parts) - 2 * self.limit)]:
                del self.parts[p]
        return out


def encoder(path: str) -> Encoder:
    return held(("encoder", path), lambda: Encoder(path))


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0,
                 id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Pieces of every document: doc_id, piece, start, length, ids_crc32, and
    where the piece was made (``part``, and ``local_rank`` among that part's
    pieces of its length); ``ids`` on request.  A null or empty text is the end
    token alone.  A map over the rows, no shuffle."""

    def run(batches):
        enc, part = encoder(tokenizer_path), TaskContext.get().partitionId()
        end, step, seen = np.asarray([end_id], "<u4").tobytes(), 4 * capacity, np.zeros(capacity + 1, np.int64)
        for keys, texts in id_text_batches(batches):
            rows, owner = [], []
            for k, ids in enumerate(enc.encode(texts)):
                ids += end
                for piece, at in enumerate(range(0, len(ids), step)):
                    some = ids[at:at + step]
                    n = len(some) // 4
                    rows.append((piece, at // 4, n, zlib.crc32(some), part, int(seen[n]), some if with_ids else None))
                    owner.append(k)
                    seen[n] += 1
            cols = list(zip(*rows)) if rows else [[]] * 7
            out = [keys.take(pa.array(owner, pa.int64())), *(pa.array(c, t) for c, t in zip(cols, _TYPES))]
            if with_ids:
                out.append(pa.array([np.frombuffer(x, "<u4") for x in cols[6]], pa.list_(pa.int64())))
            yield pa.RecordBatch.from_arrays(out, names=_NAMES[:len(out)])

    schema = ("doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, part int, local_rank bigint"
              + ", ids array<bigint>" * with_ids)
    return id_text(docs, id_col, text_col).mapInArrow(run, schema)


_NAMES = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "local_rank", "ids"]
_TYPES = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64()]


# ---------------------------------------------------------- genetic search
# A bin kind is a tuple of (length, how many), longest first; a packing maps
# bin kinds to how many such bins there are.

def fill_of(kind: tuple) -> int:
    return sum(length * n for length, n in kind)


def grown(kind: tuple, length: int, n: int = 1) -> tuple:
    held = dict(kind)
    held[length] = held.get(length, 0) + n
    return tuple(sorted(held.items(), reverse=True))


def best_fit(packing: dict, rest: dict[int, int], capacity: int, order: list[int] | None = None) -> dict:
    """Put the pieces of ``rest`` (length to count) into the fullest bins that
    still take them, longest first (or in the given order); open bins as needed.
    Bins of a kind move together, so the work follows the number of kinds."""
    room: dict[int, dict] = {}
    for kind, n in packing.items():
        room.setdefault(capacity - fill_of(kind), {})[kind] = n
    sizes = sorted(room)
    for length in order or sorted(rest, reverse=True):
        left = rest.get(length, 0)
        while left:
            at = _first(sizes, length)
            if at is None:
                per = capacity // length
                full, odd = divmod(left, per)
                made = [(((length, per),), full)] * bool(full) + [(((length, odd),), 1)] * bool(odd)
                left = 0
            else:
                kind, n = room[at].popitem()
                k = min(n, left)
                if n > k:
                    room[at][kind] = n - k
                if not room[at]:
                    del room[at]
                    sizes.remove(at)
                made = [(grown(kind, length), k)]
                left -= k
            for kind, k in made:
                free = capacity - fill_of(kind)
                if free not in room:
                    room[free] = {}
                    insort(sizes, free)
                room[free][kind] = room[free].get(kind, 0) + k
    return {kind: n for kinds in room.values() for kind, n in kinds.items()}


def _first(sizes: list[int], least: int) -> int | None:
    from bisect import bisect_left

    k = bisect_left(sizes, least)
    return sizes[k] if k < len(sizes) else None


def crossover(a: dict, b: dict, counts: dict[int, int], capacity: int, rng: random.Random) -> dict:
    """A child of ``a`` with well-filled bins of ``b`` injected whole.  Bins of
    ``a`` stay as far as their pieces are still free; the others are taken apart
    and their pieces best-fitted."""
    rest, child = dict(counts), {}
    ranked = sorted(b, key=lambda k: (-fill_of(k), k))
    cut = max(1, int(len(ranked) * rng.uniform(0.2, 0.7)))
    for kind in ranked[:cut]:
        if rng.random() < 0.7:
            child[kind] = b[kind]
            for length, n in kind:
                rest[length] -= n * b[kind]
    for kind in sorted(a, key=lambda k: (-fill_of(k), k)):
        fits = min([a[kind], *(rest[length] // n for length, n in kind)])
        if fits > 0:
            child[kind] = child.get(kind, 0) + fits
            for length, n in kind:
                rest[length] -= n * fits
    return best_fit(child, {k: n for k, n in rest.items() if n}, capacity)


def mutate(packing: dict, capacity: int, rng: random.Random, share: float = 0.05) -> dict:
    """Take some of the emptiest bins and a few others apart and best-fit again."""
    ranked = sorted(packing, key=lambda k: (fill_of(k), k))
    few = set(ranked[:max(1, int(len(ranked) * share))]) | {k for k in ranked if rng.random() < share}
    rest: dict[int, int] = {}
    for kind in few:
        for length, n in kind:
            rest[length] = rest.get(length, 0) + n * packing[kind]
    order = sorted(rest, key=lambda x: -x * rng.uniform(0.8, 1.0))
    return best_fit({k: n for k, n in packing.items() if k not in few}, rest, capacity, order)


def fitness(packing: dict, capacity: int) -> tuple[int, float]:
    """Fewer bins first, then more unequal filling (a smaller number is better)."""
    return sum(packing.values()), -sum(n * (fill_of(k) / capacity) ** 2 for k, n in packing.items())


def _dump(packing: dict) -> str:
    return json.dumps(sorted(packing.items()))


def _load(state: str) -> dict:
    return {tuple(map(tuple, kind)): n for kind, n in json.loads(state)}


def evolve_packing(spark, counts: dict[int, int], capacity: int, islands: int = 6, epochs: int = 3,
                   generations: int = 4, population: int = 4, seed: int = 7) -> dict:
    """The best packing found for a histogram of lengths.  Each island is one
    group of a shuffled frame of packings; its elite is also sent to the next
    island.  Every packing is bounded by the histogram, not by the corpus."""
    least = -(-sum(k * n for k, n in counts.items()) // capacity)

    def step(epoch: int):
        def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
            island = int(key[0])
            rng = random.Random(f"{seed}/{island}/{epoch}")
            pool = [_load(s) for s in sorted(rows["state"]) if s]
            if not pool:
                pool = [best_fit({}, counts, capacity)] if island == 0 else []
                while len(pool) < population:
                    pool.append(best_fit({}, counts, capacity, sorted(counts, key=lambda x: -x * rng.uniform(0.9, 1.0))))
            rate = lambda p: fitness(p, capacity)
            for _ in range(generations):
                pool = sorted(pool, key=rate)[:population]
                if rate(pool[0])[0] <= least:
                    break
                a, b = rng.sample(pool, 2) if len(pool) > 1 else (pool[0], pool[0])
                child = crossover(a, b, counts, capacity, rng)
                pool += [child, mutate(child, capacity, rng)]
            pool = sorted(pool, key=rate)[:population]
            home = [(island, *rate(p), _dump(p)) for p in pool]
            return pd.DataFrame([*home, ((island + 1) % islands, *home[0][1:])], columns=["island", "bins", "score", "state"])
        return run

    schema = "island bigint, bins bigint, score double, state string"
    frame = spark.range(islands).select(F.col("id").alias("island"), F.lit("").alias("state"))
    for epoch in range(epochs):
        frame = stored(frame.groupBy("island").applyInPandas(step(epoch), schema), "islands").select("island", "bins", "score", "state")
        if frame.agg(F.min("bins")).first()[0] <= least:
            break
    return _load(frame.orderBy("bins", "score", "state").select("state").first()[0])


# ------------------------------------------------------------------ dealing
def slots(packing: dict) -> dict[str, np.ndarray]:
    """For each run of places that pieces of one length take: the run's first
    rank, places per bin, first sequence id and offset of the first place."""
    used: dict[int, int] = {}
    rows, seq = [], 0
    for kind, n in sorted(packing.items()):
        at = 0
        for length, per in kind:
            rows.append(((length << 48) + used.get(length, 0), per, seq, at))
            used[length] = used.get(length, 0) + per * n
            at += per * length
        seq += n
    rows.sort()
    table = np.array(rows, np.int64).reshape(-1, 4)
    return dict(zip(("key", "per", "seq", "at"), table.T.copy()))


def pack_pieces(pieces: DataFrame, capacity: int = 2048, **search) -> DataFrame:
    """``pieces`` (from ``token_pieces``, written) with sequence_id and offset."""
    spark = pieces.sparkSession
    by = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    counts = {int(r["length"]): int(r["n"]) for r in by.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # capacity rows at most
    table = spark.sparkContext.broadcast(slots(evolve_packing(spark, counts, capacity, **search) if counts else {}))
    # the rank of a piece within its length: pieces of that length in earlier parts, and its rank in its own part
    earlier = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    base = by.select(F.col("length").alias("l"), F.col("part").alias("p"), earlier.alias("base"))
    ranked = pieces.join(base, (F.col("length") == F.col("l")) & (F.col("part") == F.col("p"))).withColumn(
        "rank", F.col("base") + F.col("local_rank")).drop("l", "p", "base", "part", "local_rank")
    names = [c for c in ranked.columns if c != "rank"]

    def deal(batches):
        t = table.value
        for b in batches:
            length, rank = (b.column(b.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            k = np.searchsorted(t["key"], (length << 48) + rank, "right") - 1
            place = rank - (t["key"][k] & ((1 << 48) - 1))
            seq, nth = t["seq"][k] + place // t["per"][k], place % t["per"][k]
            yield pa.RecordBatch.from_arrays([*(b.column(b.schema.get_field_index(c)) for c in names),
                                              pa.array(seq), pa.array(t["at"][k] + nth * length)], [*names, "sequence_id", "offset"])

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ranked.select(names).schema)
    return ranked.mapInArrow(deal, f"{schema}, sequence_id bigint, offset bigint")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id",
                   text_col: str = "text", with_ids: bool = False, **search) -> DataFrame:
    """One row for each piece: doc_id, piece, start, length, ids_crc32 (and ids
    on request), sequence_id, offset.

    Every row of ``docs`` is packed, also with null or repeated keys; a null or
    empty text is one piece of the end token.  Only texts of more than
    ``capacity`` tokens are cut.  An empty table gives no rows.  Other columns
    are not read.  The pieces are written once (a few numbers each); equal
    lengths, however frequent, are ranked by parts and never meet in a task."""
    return pack_pieces(stored(token_pieces(docs, tokenizer_path, capacity, end_id, id_col, text_col, with_ids), "pieces"),
                       capacity, **search)
