"""Benchmark decontamination by a prefix-filtered set join (operator 8).

Each benchmark item is cut into windows of ``window`` consecutive words (an
item with fewer words, but not none, is one window).  A window is a set of
word shingles that a document must contain whole, so the necessary prefix of
the window's shingles, ordered by rarity, is its single rarest shingle: only
positions that hold that shingle are candidates.

1. Pass one over the documents counts how often each benchmark shingle
   occurs (all documents; counts are summed per task before the shuffle).
2. The rarest shingle of each window becomes its join token.
3. Pass two looks the join tokens up.  The shingle's place in the window gives
   the only possible start in the document (positional bound); the window must
   fit the document there (length bound); then all its words are compared.

No document text is shuffled.  The benchmark is the stated query set: it is
taken to the tasks in blocks of at most ``block_chars`` characters, measured
before, one pass over the documents per block.

Defined results.  A null or wordless text has ``n_words`` 0 and no hits.  Items
with a null id or without words are left out; an id that appears in several
rows names one item with the windows of all of them.  Repeated document rows
each get their own row in ``report``.  Empty tables give no rows (documents) or
no hits (benchmark).  Other columns are ignored by ``report`` and carried
unchanged by ``remove_contaminated``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslm.llm import vec

WINDOW = 13
SHINGLE = 3
BLOCK_CHARS = 16_000_000
MIN_SHARE = 20  # contaminated: hits are at least one word in MIN_SHARE

class Windows:
    """The distinct windows of one block of items: word hashes, items, and
    the shingles of each (of ``SHINGLE`` words, or the whole of a shorter
    window)."""

    def __init__(self, items: list[tuple[str, str]], window: int):
        self.names = sorted({i for i, _ in items})
        index = {name: k for k, name in enumerate(self.names)}
        found: dict[tuple[int, ...], set[int]] = {}
        texts = pa.array([t for _, t in items], type=pa.string())
        for sl in vec.slices(texts):
            s, e, first = sl.lower().words(vec.ALNUM_WORD)
            h = sl.hash_spans(s, e).tolist()
            for r in range(sl.rows):
                words = h[first[r]: first[r + 1]]
                if not words:
                    continue
                item = index[items[sl.row0 + r][0]]
                for i in range(max(1, len(words) - window + 1)):
                    found.setdefault(tuple(words[i: i + window]), set()).add(item)
        self.words = [np.array(w, dtype=np.uint64) for w in found]
        self.items = [sorted(v) for v in found.values()]
        self.shingles = []  # per window: hash of the shingle at each place
        for w in self.words:
            k = min(SHINGLE, len(w))
            g, _ = vec.grams(w, k, np.array([0, len(w)]))
            self.shingles.append(vec.mix(g + np.uint64(k)))
        self.tokens = np.unique(np.concatenate(self.shingles)) if self.words else np.zeros(0, dtype=np.uint64)

    def prefixes(self, counts: dict[int, int]) -> dict:
        """The join tokens: for each the windows it leads to and its place in
        them.  Rarity ties go to the smaller hash, so every window orders its
        shingles alike."""
        rows = []
        for w, sh in enumerate(self.shingles):
            rarest = min(range(len(sh)), key=lambda j: (counts.get(int(sh[j]), 0), int(sh[j])))
            rows.append((int(sh[rarest]), w, rarest))
        rows.sort()
        tok = np.array([r[0] for r in rows], dtype=np.uint64)
        uniq, start = np.unique(tok, return_index=True)
        length = np.array([len(w) for w in self.words], dtype=np.int64)
        flat = np.concatenate(self.words)
        return {"tokens": uniq, "start": np.append(start, len(rows)), "win": np.array([r[1] for r in rows]),
                "place": np.array([r[2] for r in rows]), "len": length, "words": flat,
                "word0": np.concatenate([[0], np.cumsum(length)[:-1]]), "items": self.items, "names": self.names}


class Lookup:
    """Membership of hashes in a sorted set: a bit table on the low bits
    first, then binary search for the few that pass."""

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        bits = max(16, min(24, int(len(keys)).bit_length() + 6))
        self.mask = np.uint64((1 << bits) - 1)
        self.table = np.zeros(1 << bits, dtype=bool)
        self.table[(keys & self.mask).astype(np.int64)] = True

    def find(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Indexes into ``h`` that are members, and their key numbers."""
        maybe = np.flatnonzero(self.table[(h & self.mask).astype(np.int64)])
        if not len(maybe) or not len(self.keys):
            return maybe[:0], maybe[:0]
        k = np.minimum(np.searchsorted(self.keys, h[maybe]), len(self.keys) - 1)
        same = self.keys[k] == h[maybe]
        return maybe[same], k[same]


def _doc_shingles(h: np.ndarray, first: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for k in range(1, SHINGLE + 1):
        g, at = vec.grams(h, k, first)
        yield vec.mix(g + np.uint64(k)), at


def _counter(tokens: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look, total = Lookup(tokens), np.zeros(len(tokens), dtype=np.int64)
        for b in batches:
            for sl in vec.slices(b.column(0)):
                s, e, first = sl.lower().words(vec.ALNUM_WORD)
                for g, _ in _doc_shingles(sl.hash_spans(s, e), first):
                    total += np.bincount(look.find(g)[1], minlength=len(tokens))
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, type=pa.int64()), pa.array(total[seen], type=pa.int64())],
                                         names=["token", "n"])
    return run


def _match(sl: vec.Slice, look: Lookup, p: dict) -> tuple[np.ndarray, np.ndarray, list[set[int]]]:
    """For a slice: each row's first word, the mask of hit words, and each
    row's occurring items."""
    s, e, first = sl.lower().words(vec.ALNUM_WORD)
    h = sl.hash_spans(s, e)
    items: list[set[int]] = [set() for _ in range(sl.rows)]
    cover = np.zeros(len(h) + 1, dtype=np.int64)
    for g, at in _doc_shingles(h, first):
        pos, key = look.find(g)
        if not len(pos):
            continue
        # one candidate for each (position, window led to by the token)
        n = p["start"][key + 1] - p["start"][key]
        entry = np.repeat(p["start"][key], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        start = np.repeat(at[pos], n) - p["place"][entry]
        row = np.searchsorted(first, np.repeat(at[pos], n), side="right") - 1
        win = p["win"][entry]
        fits = (start >= first[row]) & (start + p["len"][win] <= first[row + 1])
        start, row, win = start[fits], row[fits], win[fits]
        same = np.ones(len(start), dtype=bool)
        for j in range(int(p["len"].max())):
            live = np.flatnonzero(same & (p["len"][win] > j))
            if not len(live):
                break
            same[live] = h[start[live] + j] == p["words"][p["word0"][win[live]] + j]
        start, row, win = start[same], row[same], win[same]
        np.add.at(cover, start, 1)
        np.add.at(cover, start + p["len"][win], -1)
        for r, w in set(zip(row.tolist(), win.tolist(), strict=True)):
            items[r].update(p["items"][w])
    return first, np.cumsum(cover[:-1]) > 0, items


def _blocks(benchmark: DataFrame, block_chars: int) -> Iterator[list[tuple[str, str]]]:
    """The items, a block of bounded size at a time.  Items are dealt to
    blocks by a hash of their id; the size is measured first."""
    b = benchmark.select(F.col("item_id").cast("string").alias("i"), F.col("text").alias("t")).dropna()
    chars = b.agg(F.sum(F.length("t"))).first()[0] or 0
    n = max(1, math.ceil(chars / block_chars))
    for k in range(n):
        yield [(r["i"], r["t"]) for r in b.filter(F.pmod(F.xxhash64("i"), F.lit(n)) == k).collect()]


def _prefix_blocks(docs: DataFrame, benchmark: DataFrame, window: int, block_chars: int) -> Iterator[dict]:
    texts = docs.select("text")
    for items in _blocks(benchmark, block_chars):
        w = Windows(items, window)
        if not len(w.tokens):
            continue
        got = (texts.mapInArrow(_counter(w.tokens), "token long, n long")
               .groupBy("token").agg(F.sum("n").alias("n")).collect())  # at most the block's shingles
        yield w.prefixes({int(w.tokens[r["token"]]): r["n"] for r in got})


def contaminated(n_words, n_hit):
    return (n_hit > 0) & (MIN_SHARE * n_hit >= n_words)


_NONE = {"tokens": np.zeros(0, dtype=np.uint64), "names": [], "items": []}


def _measured(col: pa.Array, look: Lookup, p: dict) -> tuple[np.ndarray, np.ndarray, list[list[str]]]:
    """Of each row of a batch: words, hit words, sorted ids of its items."""
    words, hit, ids = [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.int64)], []
    for sl in vec.slices(col):
        first, mask, items = _match(sl, look, p)
        words.append(np.diff(first))
        hit.append(vec.sums(mask, first))
        ids += [sorted(p["names"][i] for i in s) for s in items]
    return np.concatenate(words), np.concatenate(hit), ids


def _reporter(shared, fields: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        look = Lookup(p["tokens"])
        for b in batches:
            words, hit, ids = _measured(b.column(1), look, p)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(words, type=pa.int64()), pa.array(hit, type=pa.int64()),
                 pa.array(ids, type=pa.list_(pa.string()))], names=fields)
    return run


def _spans(shared, fields: list[str], every_row: bool):
    """As ``_reporter``, but with the hit words as runs (start, end), which
    can be united over several blocks; rows without a hit only if asked."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        look = Lookup(p["tokens"])
        for b in batches:
            keep, words, runs, ids = [], [], [], []
            for sl in vec.slices(b.column(2)):
                first, mask, items = _match(sl, look, p)
                for r in range(sl.rows):
                    if not items[r] and not every_row:
                        continue
                    m = np.concatenate([[False], mask[first[r]: first[r + 1]], [False]])
                    keep.append(sl.row0 + r)
                    words.append(int(first[r + 1] - first[r]))
                    runs.append(np.flatnonzero(m[1:] != m[:-1]).tolist())
                    ids.append(sorted(p["names"][i] for i in items[r]))
            at = pa.array(keep, type=pa.int64())
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(at), b.column(1).take(at), pa.array(words, type=pa.int64()),
                 pa.array(runs, type=pa.list_(pa.int64())), pa.array(ids, type=pa.list_(pa.string()))], names=fields)
    return run


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        hit, ids = [], []
        for n, runs, items in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist(),
                                  strict=True):
            mask = np.zeros(n + 1, dtype=np.int64)
            for run in runs or []:
                np.add.at(mask, run[0::2], 1)
                np.add.at(mask, run[1::2], -1)
            hit.append(int((np.cumsum(mask) > 0).sum()))
            ids.append(sorted({i for x in items or [] for i in x}))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(hit, type=pa.int64()), pa.array(ids, type=pa.list_(pa.string()))],
            names=["doc_id", "n_words", "n_hit", "item_ids"])


def hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """``(doc_id, n_words, n_hit, item_ids array<string>)``, one row per
    document row.  With one block of items (the usual case) nothing is
    shuffled; with more, each further block gives only the documents that it
    hits, and the hit runs of a document are united by (doc_id, text hash)."""
    blocks = list(_prefix_blocks(docs, benchmark, window, block_chars)) or [_NONE]
    sc = docs.sparkSession.sparkContext
    shared = [sc.broadcast(p) for p in blocks]
    id_type = docs.schema["doc_id"].dataType
    out = T.StructType([T.StructField("doc_id", id_type), T.StructField("n_words", T.LongType()),
                        T.StructField("n_hit", T.LongType()),
                        T.StructField("item_ids", T.ArrayType(T.StringType()))])
    if len(shared) == 1:
        return docs.select("doc_id", "text").mapInArrow(_reporter(shared[0], out.names), out)
    d = docs.select("doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("k"), "text")
    part = T.StructType([T.StructField("doc_id", id_type), T.StructField("k", T.StringType()),
                         T.StructField("n_words", T.LongType()), T.StructField("runs", T.ArrayType(T.LongType())),
                         T.StructField("ids", T.ArrayType(T.StringType()))])
    every = d.mapInArrow(_spans(shared[0], part.names, True), part)
    rest = None
    for s in shared[1:]:
        one = d.mapInArrow(_spans(s, part.names, False), part).dropDuplicates(["doc_id", "k"])
        rest = one if rest is None else rest.unionByName(one)
    rest = rest.groupBy(F.col("doc_id").alias("i2"), F.col("k").alias("k2")).agg(  # one row a block at most
        F.collect_list("runs").alias("runs2"), F.collect_list("ids").alias("ids2"))
    both = every.join(rest, (F.col("k") == F.col("k2")) & F.col("doc_id").eqNullSafe(F.col("i2")), "left")
    none = F.array().cast("array<array<bigint>>"), F.array().cast("array<array<string>>")
    both = both.select("doc_id", "n_words", F.concat(F.array("runs"), F.coalesce("runs2", none[0])).alias("runs"),
                       F.concat(F.array("ids"), F.coalesce("ids2", none[1])).alias("ids"))
    return both.mapInArrow(_united, out)


def report(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The digest of ``hits``: item ids as a count and a SHA-256, and the
    verdict."""
    h = hits(docs, benchmark, window, block_chars)
    return h.select("doc_id", "n_words", "n_hit", F.size("item_ids").cast("long").alias("n_items"),
                    F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
                    contaminated(F.col("n_words"), F.col("n_hit")).alias("contaminated"))


def _filter(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = shared.value
        look = Lookup(p["tokens"])
        for b in batches:
            words, hit, _ = _measured(b.column(b.schema.get_field_index("text")), look, p)
            yield b.filter(pa.array(~contaminated(words, hit)))
    return run


def remove_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW,
                        block_chars: int = BLOCK_CHARS) -> DataFrame:
    """The rows of ``docs`` (all columns) that are not contaminated."""
    blocks = list(_prefix_blocks(docs, benchmark, window, block_chars)) or [_NONE]
    if len(blocks) == 1:
        shared = docs.sparkSession.sparkContext.broadcast(blocks[0])
        return docs.mapInArrow(_filter(shared), docs.schema)
    keyed = docs.withColumn("__key", F.sha2(F.coalesce("text", F.lit("")), 256))
    named = keyed.select(F.col("__key").alias("doc_id"), "text").dropDuplicates(["doc_id"])
    bad = hits(named, benchmark, window, block_chars).filter(contaminated(F.col("n_words"), F.col("n_hit")))
    return keyed.join(bad.select(F.col("doc_id").alias("__key")), "__key", "left_anti").select(*docs.columns)
