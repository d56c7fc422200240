"""Hard negatives for contrastive training (operator 13): Strassen products of
anchor and candidate tiles, mergeable heaps of positives and of windows.

The vectors become integers, floor(256 * x), so every score is exact.  Anchors
are cut into blocks of about ``ANCHORS`` rows and all rows into blocks of about
``CANDIDATES``; each pair of blocks is one group of a cogrouped shuffle, and its
scores are one product of int64 tiles.  The product is Strassen's: both tiles
are halved in every direction, with a line of zeros where a side is odd, and
seven products of sums take the place of eight, down to a side of ``LEAF``.
Additions are exact modulo 2 ** 64 and so is the result.

A tile gives each anchor its first ``positives`` rows of the same label.  These
short lists merge: the first of all lists' firsts are the first of all.  A second
pass gives each anchor and positive the first ``negatives`` rows of another label
in the window that the positive's score sets, which merge in the same way.  So
a tile emits a bounded number of rows for each anchor, whatever it holds, and no
group is larger than a pair of blocks, however often a row or label occurs.

Defined results.  Rows with a null id, label or vector, or with a null or
non-finite component, take no part; an empty vector scores 0 with all.  A shorter
vector is filled up with zeros.  Other rows of an anchor are those of another
vec_id; rows that repeat are rows of their own, as candidates and as anchors.
Equal scores are ordered by vec_id.  Components saturate at the ends of a long;
scores are 64-bit integers.  An empty table, or one without anchors, gives no
rows.  Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ANCHORS, CANDIDATES = 512, 4096  # rows of a block, on average
LEAF = 16
SCALE = 256


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The product of two int64 matrices, exact modulo 2 ** 64."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return _leaf(a, b)
    a = np.pad(a, ((0, m % 2), (0, k % 2)))
    b = np.pad(b, ((0, k % 2), (0, n % 2)))
    r, s, t = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:r, :s], a[:r, s:], a[r:, :s], a[r:, s:]
    b11, b12, b21, b22 = b[:s, :t], b[:s, t:], b[s:, :t], b[s:, t:]
    m1 = strassen(a11 + a22, b11 + b22, leaf)
    m2 = strassen(a21 + a22, b11, leaf)
    m3 = strassen(a11, b12 - b22, leaf)
    m4 = strassen(a22, b21 - b11, leaf)
    m5 = strassen(a11 + a12, b22, leaf)
    m6 = strassen(a21 - a11, b11 + b12, leaf)
    m7 = strassen(a12 - a22, b21 + b22, leaf)
    c = np.empty((2 * r, 2 * t), dtype=np.int64)
    c[:r, :t] = m1 + m4 - m5 + m7
    c[:r, t:] = m3 + m5
    c[r:, :t] = m2 + m4
    c[r:, t:] = m1 - m2 + m3 + m6
    return c[:m, :n]


def _leaf(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if not a.size or not b.size:
        return np.zeros((a.shape[0], b.shape[1]), dtype=np.int64)
    top = [max(abs(int(x.min())), abs(int(x.max()))) for x in (a, b)]
    if a.shape[1] * top[0] * top[1] < 1 << 53:  # every partial sum is an integer that a double holds
        return (a.astype(np.float64) @ b.astype(np.float64)).astype(np.int64)
    return a @ b


def usable(vec: Column) -> Column:
    """A vector without null and non-finite components."""
    return vec.isNotNull() & F.forall(vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def integer_rows(embeddings: DataFrame) -> DataFrame:
    """``(row, vec_id, label, q)`` of the rows that take part; row is unique."""
    vec = F.col("embedding").cast("array<double>")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    e = embeddings.select("vec_id", "label", vec.alias("embedding")).filter(
        F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("embedding")))
    return e.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"),
                    label.cast("long").alias("label"),
                    F.transform("embedding", lambda x: F.floor(x * float(SCALE)).cast("long")).alias("q"))


def _matrix(t: pa.Table, dim: int) -> np.ndarray:
    """The vectors of a table as the rows of a matrix, filled up with zeros."""
    q = t.column("q").combine_chunks()
    off = np.asarray(q.offsets)
    size = np.diff(off)
    out = np.zeros((len(t), dim), dtype=np.int64)
    at = np.arange(off[-1] - off[0]) - np.repeat(off[:-1] - off[0], size)
    out[np.repeat(np.arange(len(t)), size), at] = q.flatten().to_numpy(zero_copy_only=False)
    return out


def _ints(t: pa.Table, name: str) -> np.ndarray:
    return t.column(name).to_numpy()


def _scores(anchors: pa.Table, cands: pa.Table, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores of a pair of blocks; the candidates' ids and labels, ids ascending,
    so that a stable sort by score leaves ties in the order of ids."""
    ids, labels = _ints(cands, "vec_id"), _ints(cands, "label")
    order = np.argsort(ids, kind="stable")
    return strassen(_matrix(anchors, dim), _matrix(cands, dim)[order].T), ids[order], labels[order]


def _block(key: str, n: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(17), F.col("row")), F.lit(n)).cast("int").alias(key)


def _tiles(anchors: DataFrame, rows: DataFrame, n_a: int, n_c: int, tile, schema: str) -> DataFrame:
    """Every pair of an anchor block and a candidate block once, through ``tile``."""
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    left = anchors.select(*[F.col(k).alias(k) for k in anchors.columns], _block("a", n_a)).withColumn("c", every(n_c))
    right = rows.select(*[F.col(k).alias(k) for k in rows.columns], _block("c", n_c)).withColumn("a", every(n_a))
    return left.groupBy("a", "c").cogroup(right.groupBy("a", "c")).applyInArrow(tile, schema)


def _first(d: DataFrame, keys: list[str], score: str, ident: str, n: int) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc(score), ident)
    return d.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= n)


def mine(embeddings: DataFrame, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
         every: int = 100, anchor_block: int = ANCHORS, candidate_block: int = CANDIDATES) -> DataFrame:
    """Hard negatives of the rows whose vec_id is divisible by ``every``: one row
    per anchor, positive and negative, with ranks and scores.  A negative's score is
    from low to high hundredths of the positive's."""
    rows = integer_rows(embeddings).checkpoint()  # written, so that a row keeps its number
    size = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("q")).alias("dim"),
                    F.count(F.when(F.col("vec_id") % every == 0, 1)).alias("anchors")).first()
    dim, n_c = max(size["dim"] or 0, 1), max(1, -(-size["n"] // candidate_block))
    n_a = max(1, -(-size["anchors"] // anchor_block))
    anchors = rows.filter(F.col("vec_id") % every == 0)

    def same(left: pa.Table, right: pa.Table) -> pa.Table:
        out = {k: [] for k in ("row", "positive_id", "positive_score")}
        if len(left) and len(right):
            s, ids, labels = _scores(left, right, dim)
            for i, (row, ident, label) in enumerate(zip(*(_ints(left, k) for k in ("row", "vec_id", "label")), strict=True)):
                at = np.flatnonzero((labels == label) & (ids != ident))
                at = at[np.argsort(-s[i, at], kind="stable")[:positives]]
                out["row"].append(np.full(len(at), row))
                out["positive_id"].append(ids[at])
                out["positive_score"].append(s[i, at])
        return _table(out)

    found = _first(_tiles(anchors, rows, n_a, n_c, same, "row long, positive_id long, positive_score long"),
                   ["row"], "positive_score", "positive_id", positives)
    listed = found.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("rank", "positive_id", "positive_score"))).alias("p"))
    ready = anchors.join(listed, "row").select(
        "row", "vec_id", "label", "q", F.col("p.positive_id").alias("p_id"), F.col("p.positive_score").alias("p_score"))

    def other(left: pa.Table, right: pa.Table) -> pa.Table:
        names = ("row", "place", "anchor_id", "positive_id", "positive_score", "negative_id", "negative_score")
        out = {k: [] for k in names}
        if len(left) and len(right):
            s, ids, labels = _scores(left, right, dim)
            of = zip(*(_ints(left, k) for k in ("row", "vec_id", "label")), left.column("p_id").to_pylist(),
                     left.column("p_score").to_pylist(), strict=True)
            for i, (row, ident, label, p_ids, p_scores) in enumerate(of):
                at = np.flatnonzero(labels != label)
                at = at[np.argsort(-s[i, at], kind="stable")]
                mine = s[i, at]
                for place, (p, score) in enumerate(zip(p_ids, p_scores, strict=True)):
                    # the whole scores from ceil(low * score / 100) to floor(high * score / 100)
                    least, most = -(-low * score // 100), high * score // 100
                    k = int(np.searchsorted(-mine, -most, side="left"))
                    take = at[k: k + negatives][mine[k: k + negatives] >= least]
                    for name, value in zip(names[:5], (row, place, ident, p, score), strict=True):
                        out[name].append(np.full(len(take), value))
                    out["negative_id"].append(ids[take])
                    out["negative_score"].append(s[i, take])
        return _table(out)

    schema = "row long, place long, anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long"
    hard = _first(_tiles(ready, rows, n_a, n_c, other, schema), ["row", "place"], "negative_score", "negative_id", negatives)
    return hard.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score", "place")


def _table(columns: dict[str, list[np.ndarray]]) -> pa.Table:
    return pa.table({k: pa.array(np.concatenate(v) if v else np.zeros(0), type=pa.int64()) for k, v in columns.items()})
