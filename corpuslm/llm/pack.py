"""Best-fit packing by a grouping genetic algorithm (operator 5).

Documents are tokenized, cut into pieces of at most ``capacity`` tokens and
packed into sequences.  Only lengths matter to the search, so its rows are two
numbers a piece; the token ids are written once and join their sequence at the end.

A chromosome is a list of bins (groups of pieces).  Crossover injects whole
well-filled bins of one parent into another, removes the bins that now hold
duplicate pieces, and puts the displaced pieces back: they change places with
shorter ones where that fills a bin better, then go by best fit, largest
first.  The pieces are dealt by hash into demes of about ``deme_size`` pieces;
each deme is evolved on ``islands`` islands, which are tasks of their own.
After each epoch every island's elite (its best chromosome) migrates to the
next island of its deme; the last epoch's best island wins.

A deme leaves one or two badly filled bins.  Their pieces are not accepted:
bins below ``accept`` of the capacity, and below the median of their level, are dissolved and their pieces meet in
the next level's fewer demes, until one deme is left.  So waste does not grow
with the number of demes.  Pieces of exactly ``capacity`` tokens are sequences
by themselves and take no part.

A null or empty text is the end token alone.  A very long text is many pieces.  Repeated rows are packed
each; a piece's number is its place in the written pieces.  A null id is kept as
null.  Ties break by piece number.  An empty table gives no rows.  Other
columns are ignored.
"""

from __future__ import annotations

import os
import uuid
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain, combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslm.llm import vec
from corpuslm.session import ensure_checkpoint_dir

CAPACITY = 4096
END_ID = 1
OUT = 8  # of a bin's shortest pieces two may go out together


@dataclass(frozen=True)
class Params:
    capacity: int = CAPACITY
    deme_size: int = 1024
    islands: int = 2
    epochs: int = 2
    population: int = 4
    generations: int = 6
    accept: float = 0.995


# ------------------------------------------------------------ tokens
# byte classes of a text whose A-Z are lower-cased
_SPACE, _LETTER, _DIGIT, _MARK = 0, 1, 2, 3


def _byte_classes() -> tuple[np.ndarray, np.ndarray]:
    """The class of each byte, and the bytes that make a run of non-space
    "hard": outside plain ASCII and the Latin letters U+00C0 to U+023F, or an
    apostrophe (the tokenizer's contractions start with one)."""
    kind = np.full(256, _MARK, dtype=np.uint8)
    kind[~vec.SPACE_WORD] = _SPACE
    kind[0x30:0x3A] = _DIGIT
    kind[0x61:0x7B] = _LETTER
    kind[0x80:0xC0] = _LETTER
    kind[0xC3:0xC9] = _LETTER
    hard = np.zeros(256, dtype=bool)
    hard[[x for x in range(0x20) if vec.SPACE_WORD[x]]] = True
    hard[[0x27, 0x7F, 0xC0, 0xC1, 0xC2, *range(0xC9, 0x100)]] = True
    return kind, hard


KIND, HARD = _byte_classes()

# byte-level vocabularies write a byte as the character of its number if that
# prints, else as the next character from U+0100 on
_PRINTS = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
BYTE_CHARS = {b: 0x100 + k for k, b in enumerate(x for x in range(0x100) if x not in _PRINTS)}


class UnitIds:
    """Token ids by unit.  The tokenizer splits at white space, between
    letters and other characters and around each digit, and encodes each part
    for itself; so a text's ids are those of its units in order.  A hard run
    is one unit, which the tokenizer splits by itself.  Ids are kept by the
    unit's hash in a table (open addressing, array lookups) of at most
    ``entries`` units; a full table is emptied."""

    def __init__(self, path: str, entries: int = 1_500_000):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.entries = entries
        self._clear()

    def _clear(self) -> None:
        self.mask = (1 << (2 * self.entries - 1).bit_length()) - 1
        self.slots = np.zeros(self.mask + 1, dtype=np.uint64)  # 0: free
        self.number = np.zeros(self.mask + 1, dtype=np.int32)
        self.flat = np.zeros(1 << 16, dtype=np.uint32)
        self.begin = np.zeros(self.entries + 1, dtype=np.int64)
        self.n = self.used = 0

    def _find(self, h: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 if it is new."""
        at = (h & np.uint64(self.mask)).astype(np.int64)
        slot = self.slots[at]
        out = np.where(slot == h, self.number[at], -1)
        open_ = np.flatnonzero((slot != h) & (slot != 0))
        while len(open_):
            at[open_] = (at[open_] + 1) & self.mask
            slot = self.slots[at[open_]]
            hit = slot == h[open_]
            out[open_[hit]] = self.number[at[open_[hit]]]
            open_ = open_[~hit & (slot != 0)]
        return out

    def _learn(self, sl: vec.Slice, h: np.ndarray, s: np.ndarray, e: np.ndarray, hard: np.ndarray) -> None:
        """Encode new units (distinct hashes) and add them to the table."""
        raw, tokenize, full = sl.data.tobytes(), self.tokenizer.model.tokenize, self.tokenizer.encode
        found = []
        for a, z, by_tokenizer in zip(s.tolist(), e.tolist(), hard.tolist(), strict=True):
            unit = raw[a:z]
            if by_tokenizer:
                found.append(full(unit.decode(), add_special_tokens=False).ids)
                continue
            if not unit.isascii():
                unit = unit.decode().lower().encode()
            found.append([t.id for t in tokenize(unit.decode("latin-1").translate(BYTE_CHARS))])
        size = np.array([len(x) for x in found], dtype=np.int64)
        ids = np.fromiter(chain.from_iterable(found), dtype=np.uint32, count=int(size.sum()))
        if self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.zeros(len(self.flat) + len(ids), dtype=np.uint32)])
        self.flat[self.used: self.used + len(ids)] = ids
        self.begin[self.n + 1: self.n + 1 + len(h)] = self.used + np.cumsum(size)
        self.used += len(ids)
        at, left = (h & np.uint64(self.mask)).astype(np.int64), np.arange(len(h))
        while len(left):  # each free slot takes one of those that want it
            slot, one = np.unique(at[left], return_index=True)
            free = self.slots[slot] == 0
            put = left[one[free]]
            self.slots[slot[free]] = h[put]
            self.number[slot[free]] = self.n + put
            left = np.setdiff1d(left, put)
            at[left] = (at[left] + 1) & self.mask
        self.n += len(h)

    @staticmethod
    def units(sl: vec.Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Start, end, hardness of each unit of a slice (lower-cased in place),
        and each row's first unit."""
        sl.lower()
        data = sl.data[: sl.n]
        run, run_end, _ = sl.words(vec.SPACE_WORD)
        bad = np.flatnonzero(HARD[data])
        # the two signs among the letters, the letter whose lower case is two
        # characters, and the opening of a special token
        c3, c4, bar = (np.flatnonzero(data == x) for x in (0xC3, 0xC4, 0x7C))
        bad = np.concatenate([bad, c3[np.isin(sl.data[c3 + 1], (0x97, 0xB7))], c4[sl.data[c4 + 1] == 0xB0],
                              bar[(bar > 0) & (data[bar - 1] == 0x3C)]])
        hard_run = np.zeros(len(run), dtype=bool)
        hard_run[np.searchsorted(run, bad, side="right") - 1] = True
        kind = KIND[data]
        start = np.ones(sl.n, dtype=bool)
        start[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == _DIGIT)
        start &= kind != _SPACE
        if hard_run.any():
            edge = np.zeros(sl.n + 1, dtype=np.int8)
            edge[run[hard_run]] += 1
            edge[run_end[hard_run]] -= 1
            start &= np.cumsum(edge[:-1], dtype=np.int8) == 0
        start[run] = True
        s = np.flatnonzero(start)
        of = np.searchsorted(run, s, side="right") - 1
        e = np.minimum(np.append(s[1:], sl.n), run_end[of])
        return s, e, hard_run[of], np.searchsorted(s, sl.off)

    def encode(self, sl: vec.Slice) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a slice and each row's first id."""
        s, e, hard, first = self.units(sl)
        if not len(s):
            return np.zeros(0, dtype=np.uint32), np.zeros(sl.rows + 1, dtype=np.int64)
        h = sl.hash_spans(s, e)
        h[h == 0] = 1  # 0 marks a free slot
        number = self._find(h)
        if (number < 0).any():
            new = np.flatnonzero(number < 0)
            u, at = np.unique(h[new], return_index=True)
            if self.n + len(u) > self.entries:
                u, at = np.unique(h, return_index=True)
                new = np.arange(len(h))
                self.entries = max(self.entries, len(u))
                self._clear()
            at = new[at]
            self._learn(sl, u, s[at], e[at], hard[at])
            number[new] = self._find(h[new])
        n = self.begin[number + 1] - self.begin[number]
        end = np.cumsum(n)
        ids = self.flat[np.repeat(self.begin[number] - (end - n), n) + np.arange(int(end[-1]))]
        return ids, np.concatenate([[0], end])[first]


_UNIT_IDS: dict[str, UnitIds] = {}


def _tokenizer(path: str) -> UnitIds:
    """One per worker process: its table serves all tasks of the worker."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _UNIT_IDS:
        _UNIT_IDS[path] = UnitIds(path)
    return _UNIT_IDS[path]


def id_width(path: str) -> int:
    """The bytes that hold any id of the tokenizer: 2 or 4."""
    return 2 if _tokenizer(path).tokenizer.get_vocab_size() <= 1 << 16 else 4


def _pieces(path: str, capacity: int, width: int, fields: list[str]):
    kind = f"<u{width}"
    end = np.array([END_ID], dtype=kind).tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = _tokenizer(path)
        for b in batches:
            row, piece, start, length, cuts = [], [], [], [], []
            for sl in vec.slices(b.column(1)):
                flat, first = ids.encode(sl)
                for r in range(sl.rows):
                    t = flat[first[r]: first[r + 1]].astype(kind).tobytes() + end
                    for k, at in enumerate(range(0, len(t), width * capacity)):
                        cut = t[at: at + width * capacity]
                        row.append(sl.row0 + r)
                        piece.append(k)
                        start.append(at // width)
                        length.append(len(cut) // width)
                        cuts.append(cut)
            at = pa.array(row, type=pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(at), pa.array(piece, type=pa.int32()),
                 *(pa.array(x, type=pa.int64()) for x in (start, length)), pa.array(cuts, type=pa.binary())], names=fields)
    return run


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """``(doc_id, piece, start, length, ids)`` for every document row; ``ids`` are
    little-endian unsigned numbers of ``id_width`` bytes."""
    schema = T.StructType([T.StructField("doc_id", docs.schema["doc_id"].dataType), T.StructField("piece", T.IntegerType()),
                           T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
                           T.StructField("ids", T.BinaryType())])
    return docs.select("doc_id", "text").mapInArrow(
        _pieces(tokenizer_path, capacity, id_width(tokenizer_path), schema.names), schema)


# ------------------------------------------------------------ genetic algorithm
def best_fit(sizes: list[int], items: list[int], bins: list[list[int]], fill: list[int], capacity: int) -> None:
    """Put the items into the bins, largest first, each into the fullest bin
    that still takes it, else into a new one.  Changes bins and fill."""
    room = sorted((capacity - f, i) for i, f in enumerate(fill) if f < capacity)
    for it in sorted(items, key=lambda i: (-sizes[i], i)):
        k = bisect_left(room, (sizes[it], -1))
        if k < len(room):
            left, b = room.pop(k)
            bins[b].append(it)
            fill[b] += sizes[it]
        else:
            left, b = capacity, len(bins)
            bins.append([it])
            fill.append(sizes[it])
        if left > sizes[it]:
            insort(room, (left - sizes[it], b))


def fitness(fill: list[int], capacity: int) -> tuple[int, float]:
    """Fewer bins first, then fuller full bins (mean squared fill)."""
    return -len(fill), float(np.square(np.array(fill, dtype=float) / capacity).mean()) if fill else 0.0


def crossover(a: list[list[int]], b: list[list[int]], sizes: list[int], capacity: int, share: float,
              rng: np.random.Generator) -> list[list[int]]:
    """Whole well-filled bins of ``b`` go into ``a``: a random half of the
    ``share`` fullest.  Bins of ``a`` with a duplicate are removed; their other
    pieces are displaced and placed anew."""
    fill_b = [sum(sizes[i] for i in x) for x in b]
    full = sorted(range(len(b)), key=lambda i: (-fill_b[i], i))[: max(1, int(len(b) * share))]
    gift = [b[i] for i in full if rng.random() < 0.5]
    given = {i for x in gift for i in x}
    rest, loose = [], []
    for x in a:
        if given.isdisjoint(x):
            rest.append(x)
        else:
            loose += [i for i in x if i not in given]
    child = [list(x) for x in gift + rest]
    place(sizes, loose, child, capacity)
    return child


def swap_in(sizes: list[int], loose: list[int], bins: list[list[int]], fill: list[int], capacity: int) -> list[int]:
    """Fill bins better by exchange: one or two pieces of a bin go out, one or two
    displaced ones that are longer together come in.  Changes bins and fill; returns
    the pieces that are displaced now, which are shorter and so easier to place."""
    free = sorted((sizes[i], i) for i in loose)
    for b, items in enumerate(bins):
        if not free or fill[b] == capacity:
            continue
        best = (fill[b], (), ())
        items = sorted(set(items), key=lambda i: (sizes[i], i))
        outs = [(i,) for i in items] + list(combinations(items[:OUT], 2))
        for out in outs:
            held = fill[b] - sum(sizes[i] for i in out)
            room = capacity - held
            k = bisect_right(free, (room, len(sizes))) - 1
            if k >= 0 and held + free[k][0] > best[0]:
                best = (held + free[k][0], out, (k,))
            lo, hi = 0, k  # the best two: the ends move towards each other
            while len(out) == 1 and lo < hi:
                total = free[lo][0] + free[hi][0]
                if total <= room:
                    if held + total > best[0]:
                        best = (held + total, out, (lo, hi))
                    lo += 1
                else:
                    hi -= 1
        if best[1]:
            into = [free[k][1] for k in best[2]]
            bins[b] = [i for i in bins[b] if i not in best[1]] + into
            fill[b] = best[0]
            free = [x for k, x in enumerate(free) if k not in best[2]]
            for i in best[1]:
                insort(free, (sizes[i], i))
    return [i for _, i in free]


def place(sizes: list[int], loose: list[int], bins: list[list[int]], capacity: int) -> None:
    """Exchange, then best fit.  Changes the bins."""
    fill = [sum(sizes[i] for i in x) for x in bins]
    best_fit(sizes, swap_in(sizes, loose, bins, fill, capacity), bins, fill, capacity)


def scattered(sizes: list[int], capacity: int, rng: np.random.Generator) -> list[list[int]]:
    """A chromosome of its own: pieces enter in an order blurred at random, each into
    the fullest bin that takes it."""
    blurred = np.array(sizes, dtype=float) * rng.uniform(0.5, 1.5, size=len(sizes))
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []
    for it in np.argsort(-blurred, kind="stable").tolist():
        k = bisect_left(room, (sizes[it], -1))
        left, b = room.pop(k) if k < len(room) else (capacity, len(bins))
        if b == len(bins):
            bins.append([])
        bins[b].append(it)
        if left > sizes[it]:
            insort(room, (left - sizes[it], b))
    return bins


def mutate(a: list[list[int]], sizes: list[int], capacity: int, rng: np.random.Generator) -> list[list[int]]:
    """Dissolve the emptiest bin and a few random ones and place their pieces anew."""
    fill = [sum(sizes[i] for i in x) for x in a]
    gone = {int(np.argmin(fill)), *rng.integers(0, len(a), size=max(1, len(a) // 20)).tolist()}
    child = [list(x) for i, x in enumerate(a) if i not in gone]
    rng.shuffle(child)
    place(sizes, [i for g in gone for i in a[g]], child, capacity)
    return child


def evolve(sizes: list[int], immigrants: list[list[list[int]]], p: Params, seed: int) -> list[list[int]]:
    """One island's epoch; returns its elite.  The pool starts from the arriving elites, best fit by falling
    length and chromosomes of random orders.  An elite that arrives at the bound ceil(sum of lengths /
    capacity), which no packing can beat, is taken; else generations follow, crossover included, until one is there."""
    rng = np.random.default_rng(seed)
    bound = -(-sum(sizes) // p.capacity)
    weigh = lambda c: fitness([sum(sizes[i] for i in x) for x in c], p.capacity)
    pool = [list(map(list, c)) for c in immigrants]
    if pool and len(best := max(pool, key=weigh)) <= bound:
        return best
    first: list[list[int]] = []
    best_fit(sizes, list(range(len(sizes))), first, [], p.capacity)
    pool.append(first)
    while len(pool) < p.population:
        pool.append(scattered(sizes, p.capacity, rng))
    pool.sort(key=weigh, reverse=True)
    for _ in range(p.generations):
        child = []
        for _ in range(p.population // 2):
            i, j = rng.permutation(len(pool))[:2]
            child.append(crossover(pool[i], pool[j], sizes, p.capacity, 0.5, rng))
        child.append(mutate(pool[0], sizes, p.capacity, rng))
        pool = sorted(pool + child, key=weigh, reverse=True)[: p.population]
        if len(pool[0]) <= bound:
            break
    return pool[0]


def _bins_of(code: pd.Series) -> list[list[int]]:
    groups: dict[int, list[int]] = {}
    for i, c in enumerate(code.tolist()):
        groups.setdefault(c, []).append(i)
    return list(groups.values())


def _island(p: Params, epoch: int):
    """A group is one island of one deme: its pieces, with the bin of each in
    its own elite (``bin``) and in the arriving one (``guest``)."""
    def run(g: pd.DataFrame) -> pd.DataFrame:
        g = g.sort_values(["length", "pid"], ascending=[False, True], ignore_index=True)
        sizes = g["length"].tolist()
        known = [_bins_of(g[c]) for c in ("bin", "guest") if epoch]
        best = evolve(sizes, known, p, seed=int(g["deme"].iloc[0]) * 1009 + int(g["island"].iloc[0]) * 31 + epoch)
        place = np.zeros(len(g), dtype=np.int64)
        score = fitness([sum(sizes[i] for i in x) for x in best], p.capacity)
        for k, x in enumerate(best):
            place[x] = k
        return g.assign(bin=place, guest=place, n_bins=-score[0], fill=score[1])
    return run


_STATE = "deme long, island int, pid long, length long, bin long, guest long, n_bins long, fill double"


def _level(items: DataFrame, demes: int, p: Params, level: int) -> DataFrame:
    """``(pid, length, deme, bin)`` of the best island of each deme."""
    base = items.select(F.pmod(F.xxhash64(F.lit(level), "pid"), F.lit(demes)).alias("deme"), "pid", "length")
    state = base.select("deme", F.explode(F.sequence(F.lit(0), F.lit(p.islands - 1))).alias("island"), "pid", "length",
                        F.lit(0).cast("long").alias("bin"), F.lit(0).cast("long").alias("guest"),
                        F.lit(0).cast("long").alias("n_bins"), F.lit(0.0).alias("fill"))
    for epoch in range(p.epochs):
        if epoch:  # the elite of each island arrives at the next one
            moved = state.select("deme", ((F.col("island") + 1) % p.islands).alias("island"), "pid",
                                 F.col("bin").alias("guest"))
            state = state.drop("guest").join(moved, ["deme", "island", "pid"])
        state = state.groupBy("deme", "island").applyInPandas(_island(p, epoch), _STATE)
    state = state.checkpoint()
    best = state.groupBy("deme").agg(F.min_by("island", F.struct("n_bins", -F.col("fill"), "island")).alias("island"))
    return state.join(best, ["deme", "island"]).select("pid", "length", "deme", "bin")


def _placed(narrow: DataFrame, p: Params) -> DataFrame:
    """``(pid, sequence_id)`` of every piece ``(pid, length)``."""
    # a full piece is a sequence by itself; its number lies below all numbers of levels
    done = narrow.filter(F.col("length") >= p.capacity).select("pid", (-1 - F.col("pid")).alias("sequence_id"))
    left = narrow.filter(F.col("length") < p.capacity)
    level, n = 1, left.count()
    while n:
        demes = max(1, -(-n // p.deme_size))
        number = F.lit(level << 56) + F.col("deme") * (1 << 16) + F.col("bin")  # a deme has under 2^16 bins
        got = _level(left, demes, p, level).withColumn("sequence_id", number)
        if demes == 1:
            return done.unionByName(got.select("pid", "sequence_id"))
        fill = got.groupBy("sequence_id").agg(F.sum("length").alias("fill"))
        # the better half of the bins stays whatever its fill, so that each level has at most about half of the last one's pieces
        limit = min(p.accept * p.capacity, fill.agg(F.percentile_approx("fill", 0.5, 10000)).first()[0])
        got = got.join(fill, "sequence_id").checkpoint()
        done = done.unionByName(got.filter(F.col("fill") >= limit).select("pid", "sequence_id"))
        left = got.filter(F.col("fill") < limit).select("pid", "length")
        n, level = left.count(), level + 1
    return done


def sequences(docs: DataFrame, tokenizer_path: str, params: Params = Params()) -> DataFrame:
    """One row per sequence: ``sequence_id``, ``ids`` (its tokens as little-endian unsigned 32-bit
    numbers) and ``parts``, the pieces in their order: ``offset``, ``doc_id``, ``piece``, ``start``, ``length``."""
    p = params
    spark = docs.sparkSession
    # numbered as they are written; every later step reads what was written, the search its lengths only
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pieces-{uuid.uuid4().hex}"
    numbered = pieces(docs, tokenizer_path, p.capacity).withColumn("pid", F.monotonically_increasing_id())
    numbered.write.option("compression", "zstd").parquet(path)
    cut = spark.read.schema(numbered.schema).parquet(path)
    narrow = cut.select("pid", "length")
    before = Window.partitionBy("sequence_id").orderBy("pid").rowsBetween(Window.unboundedPreceding, -1)
    place = (_placed(narrow, p).join(narrow, "pid")
             .select("pid", "sequence_id", F.coalesce(F.sum("length").over(before), F.lit(0)).cast("long").alias("offset")))
    part = F.struct("offset", "doc_id", "piece", "start", "length", "ids")
    whole = cut.join(place, "pid").groupBy("sequence_id").agg(F.sort_array(F.collect_list(part)).alias("p"))  # capacity tokens
    joined = whole.select("sequence_id", F.col("p.ids").alias("ids"), F.transform("p", lambda x: x.dropFields("ids")).alias("parts"))
    schema = T.StructType([f if f.name != "ids" else T.StructField("ids", T.BinaryType()) for f in joined.schema])
    return joined.mapInArrow(_joined(id_width(tokenizer_path)), schema)


def _joined(width: int):
    """The ids of each row's pieces as one string of 32-bit numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cuts = b.column(1).to_pylist()
            ids = [np.frombuffer(b"".join(x), dtype=f"<u{width}").astype("<u4").tobytes() for x in cuts]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, type=pa.binary()), b.column(2)], names=b.schema.names)
    return run


def pack(docs: DataFrame, tokenizer_path: str, params: Params = Params()) -> DataFrame:
    """One row per piece, from the sequences: doc_id, piece, start, length, ids_crc32,
    sequence_id, offset."""
    own = lambda x: F.substring("ids", (4 * x["offset"] + 1).cast("int"), (4 * x["length"]).cast("int"))
    parts = F.transform("parts", lambda x: x.withField("ids_crc32", F.crc32(own(x))))
    each = sequences(docs, tokenizer_path, params).select("sequence_id", F.explode(parts).alias("x"))
    return each.select("x.doc_id", "x.piece", "x.start", "x.length", "x.ids_crc32", "sequence_id", "x.offset")
