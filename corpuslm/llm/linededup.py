"""Line dedup by winnowing over line hashes (operator 10).

Lines are split at LF and hashed.  A gram is the shortest run of lines from a
line on that holds ``noise_words`` words; a span is the shortest such run of
``min_words`` words.  Of the grams inside each span the one of least hash is
selected as a fingerprint, so two equal runs of at least ``min_words`` words
always select the same gram (guarantee), and no match is shorter than
``noise_words`` words (noise limit).

Each fingerprint's occurrences are joined with its first one in the order
(doc_id, text digest, line); the match is extended line by line both ways, and
the lines of the later run are deleted.  Every deleted line equals a line
earlier in that order, so the first occurrence of any line always stays, and no
run of ``min_words`` words or more that occurs earlier is left whole.

Equal texts are one node from the first step on: a large group of copies costs
one row per task.  All copies but the first (least doc_id) lose all their lines
if the text has ``min_words`` words.  Only line hashes, a few bytes a line, are
shuffled up to the last join, which brings the cuts to the texts.  An occurrence
is matched with the first one only, never all with all.

Defined results.  A null text stays null, an empty text empty; both have no
words.  A text that loses all lines becomes empty.  A null doc_id sorts after
all others.  Repeated rows (same id, same text) are one document and get the
same result.  Ties between equal hashes in a span go to the first line.  An
empty table gives no rows.  Other columns are carried unchanged.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuslm.llm import vec

MIN_WORDS = 50
NOISE_WORDS = 40
LAST_ID = (1 << 63) - 1

_P = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_P_INV = pow(_P, -1, 1 << 64)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _first_least(h: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
    """Index of the first least ``h`` in each range lo..hi (inclusive), by
    doubling: after step k, ``best[i]`` is the answer for i .. i + 2**k - 1."""
    best = np.arange(len(h))
    out = np.full(len(lo), -1)
    size = hi - lo + 1
    step = 1
    while True:
        fit = np.flatnonzero((size >= step) & (size < 2 * step))
        if len(fit):
            a, b = best[lo[fit]], best[hi[fit] - step + 1]
            out[fit] = np.where(h[b] < h[a], b, a)
        if not len(size) or 2 * step > size.max():
            return out
        a, b = best[: len(best) - step], best[step:]
        best = np.concatenate([np.where(h[b] < h[a], b, a), best[len(best) - step:]])
        step *= 2


def fingerprints(h: np.ndarray, words: np.ndarray, first: np.ndarray, min_words: int,
                 noise_words: int) -> tuple[np.ndarray, np.ndarray]:
    """Line indexes and gram hashes of the selected grams of a slice; ``first``
    has each row's first line."""
    n = len(h)
    c = np.concatenate([[0], np.cumsum(words, dtype=np.int64)])
    row_end = np.repeat(first[1:], np.diff(first))
    gram_end = np.searchsorted(c, c[:-1] + noise_words)  # exclusive
    span_end = np.searchsorted(c, c[:-1] + min_words)
    s = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(h * _powers(_P, n), dtype=np.uint64)])
    stop = np.minimum(gram_end, n)
    gram = vec.mix((s[stop] - s[:-1]) * _powers(_P_INV, n) + (stop - np.arange(n)).astype(np.uint64))
    lo = np.flatnonzero(span_end <= row_end)
    if not len(lo):
        return lo, gram[:0]
    hi = np.searchsorted(gram_end, span_end[lo], side="right") - 1
    picked = np.unique(_first_least(gram, lo, np.maximum(hi, lo)))
    return picked, gram[picked]


def _scanner(min_words: int, noise_words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            hashes, counts, pos, keys = [], [], [], []
            for sl in vec.slices(b.column(2)):
                ws, _, _ = sl.words(vec.SPACE_WORD)
                s, e, first = sl.lines()
                h = sl.hash_spans(s, e)
                words = np.searchsorted(ws, e) - np.searchsorted(ws, s)
                at, gram = fingerprints(h, words, first, min_words, noise_words)
                cut = np.searchsorted(at, first)
                for r in range(sl.rows):
                    a, z = first[r], first[r + 1]
                    hashes.append(h[a:z].tobytes())
                    counts.append(int(words[a:z].sum()))
                    pos.append((at[cut[r]: cut[r + 1]] - a).astype(np.int32))
                    keys.append(gram[cut[r]: cut[r + 1]].view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(hashes, type=pa.binary()), pa.array(counts, type=pa.int64()),
                 pa.array(pos, type=pa.list_(pa.int32())), pa.array(keys, type=pa.list_(pa.int64()))],
                names=["doc", "node", "hashes", "words", "pos", "keys"])
    return run


def _run_of(h: np.ndarray, at: int, g: np.ndarray, to: int) -> tuple[int, int]:
    """The maximal equal run around h[at] = g[to], as lines of ``h``."""
    left = min(at, to)
    differ = np.flatnonzero(h[at - left: at] != g[to - left: to])
    lo = at - left + (int(differ[-1]) + 1 if len(differ) else 0)
    right = min(len(h) - at, len(g) - to)
    differ = np.flatnonzero(h[at: at + right] != g[to: to + right])
    return lo, at + (int(differ[0]) if len(differ) else right)


def _extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, pairs of positions, own lines, lines of the first
    occurrence) to the lines to delete."""
    for b in batches:
        cuts = []
        for pairs, own, other in zip(b.column(1).to_pylist(), b.column(2), b.column(3), strict=True):
            h = np.frombuffer(own.as_buffer(), dtype=np.uint64)
            g = np.frombuffer(other.as_buffer(), dtype=np.uint64)
            gone = np.zeros(len(h), dtype=bool)
            done: dict[int, int] = {}  # by shift: the end of the last run
            for p in sorted(pairs, key=lambda x: x["pos"]):
                at, to = p["pos"], p["to"]
                if at < done.get(at - to, 0):
                    continue
                lo, hi = _run_of(h, at, g, to)
                gone[lo:hi] = True
                done[at - to] = hi
            cuts.append(np.flatnonzero(gone).astype(np.int32))
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(cuts, type=pa.list_(pa.int32()))],
                                         names=["node", "cut"])


def _node(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def cuts(docs: DataFrame, min_words: int = MIN_WORDS, noise_words: int = NOISE_WORDS) -> DataFrame:
    """``(node, doc, words, cut array<int>)``: per distinct text (``node`` is
    its MD5) that repeats or has lines to delete, its first doc_id, its words and
    the lines that every document with this text loses."""
    rows = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)).alias("doc"),
                       _node(F.col("text")).alias("node"), F.col("text"))
    scanned = rows.mapInArrow(_scanner(min_words, noise_words), "doc long, node binary, hashes binary, words long, "
                                                                "pos array<int>, keys array<long>")
    nodes = scanned.groupBy("node").agg(F.min("doc").alias("doc"), F.max("doc").alias("last"),
                                        F.first("hashes").alias("hashes"), F.first("words").alias("words"),
                                        F.first("pos").alias("pos"), F.first("keys").alias("keys")).checkpoint()
    marks = (nodes.filter(F.size("keys") > 0)
             .select("doc", "node", F.explode(F.arrays_zip("pos", "keys")).alias("f"))
             .select(F.col("f.keys").alias("key"), F.struct("doc", "node", F.col("f.pos").alias("pos")).alias("m")))
    firsts = (marks.groupBy("key").agg(F.min("m").alias("one"), F.count(F.lit(1)).alias("n"))
              .filter(F.col("n") > 1).select("key", "one"))
    pairs = (marks.join(firsts, "key").filter(F.col("m") != F.col("one"))
             .groupBy(F.col("m.node").alias("node"), F.col("one.node").alias("other"))  # a text's own fingerprints
             .agg(F.collect_set(F.struct(F.col("m.pos").alias("pos"), F.col("one.pos").alias("to"))).alias("pairs")))
    own = nodes.select("node", "hashes")
    other = nodes.select(F.col("node").alias("other"), F.col("hashes").alias("theirs"))
    found = (pairs.join(own, "node").join(other, "other").select("node", "pairs", "hashes", "theirs")
             .mapInArrow(_extend, "node binary, cut array<int>")
             .groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("cut"))).alias("cut")))
    return (nodes.select("node", "doc", "words", "last").join(found, "node", "left")
            .filter(F.col("cut").isNotNull() | (F.col("last") > F.col("doc")))
            .select("node", "doc", "words", "cut"))


def dedup_lines(docs: DataFrame, min_words: int = MIN_WORDS, noise_words: int = NOISE_WORDS) -> DataFrame:
    """``docs`` with repeated runs of lines deleted from ``text``, plus
    ``__n_lines`` and ``__n_cut`` (lines before, lines deleted)."""
    todo = cuts(docs, min_words, noise_words).select(
        F.col("node").alias("__node"), F.col("doc").alias("__doc"), F.col("words").alias("__words"),
        F.col("cut").alias("__cut")).checkpoint()  # so that the join's stages can split a large group of copies
    d = docs.withColumn("__node", _node(F.col("text"))).join(todo, "__node", "left")
    lines = F.split("text", "\n", -1)
    copy = ((F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID)) > F.col("__doc"))
            & (F.col("__words") >= min_words))
    cut = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(F.col("__cut"), i)), "\n")
    n = F.when(F.col("text").isNull(), F.lit(0)).otherwise(F.size(lines)).cast("long")
    gone = (F.when(F.col("text").isNull(), F.lit(0)).when(copy, F.size(lines))
            .otherwise(F.coalesce(F.size("__cut"), F.lit(0))).cast("long"))
    new = (F.when(F.col("text").isNull(), F.col("text")).when(copy, F.lit(""))
           .when(F.col("__cut").isNotNull(), cut).otherwise(F.col("text")))
    return d.select(*[new.alias("text") if c == "text" else F.col(c) for c in docs.columns],
                    n.alias("__n_lines"), gone.alias("__n_cut"))
