"""Approximate nearest neighbours by an adaptive dimension scan (operator 11).

Largest inner products become smallest distances: every vector gets one more
component that fills its length up to the longest one's, a query gets 0 there, and
then |q - v|^2 = |q|^2 + longest^2 - 2 <q, v>.  The vectors are rotated at random,
so that any first d of their D components hold a share of a distance that follows
the beta distribution with d/2 and (D - d)/2.

An index of lists (k-means, fitted on at most ``SAMPLE`` rows of least hash and
``SAMPLE_BYTES``, with every row assigned) is probed from the nearest list on, until
the probed lists hold ``SHARE`` of all rows.  The rows come in steps, each ``STEP_UP``
times as many as all before, chosen by hash; a row is scanned in one step only.  A
query enters a step with the 20th distance found so far, so a step finds about
20 * ``STEP_UP`` rows for it, however many rows there are.

In a step a list is cut into pieces of about ``PIECE`` rows and its queries into
blocks of about ``QUERIES``; each pair is one group of a cogrouped shuffle, however
large a list is.  There the piece lies in column blocks of ``BLOCK`` components.
After each block a candidate is abandoned if its partial distance is above the
1 - ``DOUBT`` quantile that a candidate at the query's current 20th distance would
have.  Those left at the end are scored on the original vectors, each pair summed
from the first component to the last.  The lists of 20 of all pieces and of the
steps before merge into the query's.

The test tables' vectors have no clusters, so nothing less than most of the rows
gives a recall of 0.9; hence ``SHARE``.  Tables of up to ``LIST_ROWS`` rows are
one list.

Defined results.  Vectors that are null, empty, zero or hold null or non-finite
components, and rows with a null vec_id, take no part.  Shorter vectors are filled
up with zeros.  A query's own rows are all of its vec_id; a repeated row is a
candidate, and a query, of its own.  Equal scores are ordered by vec_id.  A table
without queries gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

NEAREST = 20
SAMPLE, SAMPLE_BYTES = 16_384, 1 << 25
LIST_ROWS, MAX_LISTS = 2048, 1024  # beyond LIST_ROWS rows, an eighth of their root lists
STEP_UP = 8
PIECE, QUERIES = 4096, 4096
SHARE = 0.85
BLOCK = 16
DOUBT = 0.002
ROUNDS = 10
AT_ONCE, STEP = 128, 512  # queries and candidates whose distances are held at once


class Space:
    """The rotated space: scale, longest length, number of components and the
    rotation; all bounded by the number of components."""

    def __init__(self, dim: int, scale: float, longest2: float, seed: int = 11):
        self.dim, self.scale, self.longest2 = dim, scale, longest2
        self.full = -(-(dim + 1) // BLOCK) * BLOCK
        rng = np.random.default_rng(seed)
        turn, r = np.linalg.qr(rng.standard_normal((self.full, self.full)))
        self.turn = (turn * np.sign(np.diag(r)))[: dim + 1]
        # the share of a squared distance in the first d components, at most, but for DOUBT of the rotations
        self.share = {d: float(np.quantile(rng.beta(d / 2, (self.full - d) / 2, 1 << 18), 1 - DOUBT))
                      for d in range(BLOCK, self.full, BLOCK)}

    def rotated(self, v: np.ndarray, query: bool) -> np.ndarray:
        v = v / self.scale
        rest = np.zeros(len(v)) if query else np.sqrt(np.maximum(0.0, self.longest2 - (v * v).sum(1)))
        return np.column_stack([v, rest]) @ self.turn


def usable_rows(embeddings: DataFrame) -> DataFrame:
    """``(row, vec_id, v)`` of the rows that take part; row is unique."""
    v = F.col("v")
    e = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    sound = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    return e.filter(F.col("vec_id").isNotNull() & v.isNotNull() & sound).select(
        F.monotonically_increasing_id().alias("row"), "vec_id", "v")


def _matrix(col: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    off = np.asarray(col.offsets)
    size = np.diff(off)
    out = np.zeros((len(col), dim))
    at = np.arange(off[-1] - off[0]) - np.repeat(off[:-1] - off[0], size)
    out[np.repeat(np.arange(len(col)), size), at] = col.flatten().to_numpy(zero_copy_only=False)
    return out


def fit_lists(v: np.ndarray, n: int, seed: int = 7) -> np.ndarray:
    """Centres of ``n`` lists of the rows of a sample (Lloyd's rounds); an empty
    list takes the row that is farthest from its centre."""
    rng = np.random.default_rng(seed)
    centres = v[rng.choice(len(v), n, replace=False)]
    for _ in range(ROUNDS):
        at, far = _nearest(v, centres)
        total = np.zeros_like(centres)
        np.add.at(total, at, v)
        size = np.bincount(at, minlength=n)
        centres = total / np.maximum(size, 1)[:, None]
        empty = np.flatnonzero(size == 0)
        centres[empty] = v[np.argsort(-far, kind="stable")[: len(empty)]]
    return centres


def _distances(v: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (v * v).sum(1)[:, None] + (centres * centres).sum(1) - 2 * (v @ centres.T)


def _nearest(v: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = _distances(v, centres)
    at = d.argmin(1)
    return at, d[np.arange(len(v)), at]


def scan(space: Space, queries: np.ndarray, q_ids: np.ndarray, limits: np.ndarray, cands: np.ndarray, c_ids: np.ndarray,
         k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The adaptive scan of one piece: (query's place, candidate's place, score)
    of each query's ``k`` nearest candidates that it found.  ``limits`` has the
    score that a candidate must reach, minus infinity if any will do."""
    turned = space.rotated(cands, query=False)
    columns = [np.ascontiguousarray(turned[:, d: d + BLOCK]) for d in range(0, space.full, BLOCK)]
    found = []
    for at in range(0, len(queries), AT_ONCE):
        q = space.rotated(queries[at: at + AT_ONCE], query=True)
        ids = q_ids[at: at + AT_ONCE]
        # squared distances of the nearest so far; at first, those of the limit
        start = (q * q).sum(1) + space.longest2 - 2 * (limits[at: at + AT_ONCE] / space.scale / space.scale)
        best = np.repeat(np.maximum(0.0, start)[:, None], k, axis=1)
        kept = []
        for lo in range(0, len(cands), STEP):
            some = [c[lo: lo + STEP] for c in columns]
            i, j, part = _survivors(space, q, some, best.max(1), ids[:, None] != c_ids[lo: lo + STEP][None, :])
            kept.append((i, j + lo, part))
            new = np.full((len(q), len(some[0])), np.inf)
            new[i, j] = part
            best = np.partition(np.concatenate([best, new], axis=1), k - 1, axis=1)[:, :k]
        i, j, part = (np.concatenate(x) for x in zip(*kept, strict=True))
        near = part <= _loose(best.max(1))[i]
        i, j = i[near], j[near]
        score = np.zeros(len(i))
        for d in range(space.dim):  # from the first component to the last, so that equal vectors score alike
            score += queries[at + i, d] * cands[j, d]
        ok = score >= limits[at + i]
        i, j, score = i[ok], j[ok], score[ok]
        order = np.lexsort((c_ids[j], -score, i))
        i, j, score = i[order], j[order], score[order]
        first = np.searchsorted(i, i, side="left")
        top = np.arange(len(i)) - first < k
        found.append((at + i[top], j[top], score[top]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _loose(d: np.ndarray) -> np.ndarray:
    """A squared distance with room for the rounding of partial sums."""
    return d * (1 + 1e-9) + 1e-12


def _survivors(space: Space, q: np.ndarray, columns: list[np.ndarray], limit: np.ndarray,
               allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs that no test abandons, and their squared distances."""
    dist = np.maximum(0.0, _distances(q[:, :BLOCK], columns[0]))
    d, part = BLOCK, dist
    i = j = None
    for block in columns[1:]:
        bound = _loose(limit * space.share[d])
        if i is None:
            i, j = np.nonzero(allowed & (part <= bound[:, None]))
            part = dist[i, j]
        else:
            ok = part <= bound[i]
            i, j, part = i[ok], j[ok], part[ok]
        if len(i) * 4 > allowed.size:  # most are left: one product for all costs less
            part = part + np.maximum(0.0, _distances(q[:, d: d + BLOCK], block))[i, j]
        else:
            diff = q[i, d: d + BLOCK] - block[j]
            part = part + np.einsum("ij,ij->i", diff, diff)
        d += BLOCK
    if i is None:  # one block only
        i, j = np.nonzero(allowed)
        part = dist[i, j]
    ok = part <= _loose(limit)[i]
    return i[ok], j[ok], part[ok]


def search(embeddings: DataFrame, every: int = 20, k: int = NEAREST, share: float = SHARE,
           list_rows: int = LIST_ROWS, piece: int = PIECE, block: int = QUERIES) -> DataFrame:
    """``(query_id, rank, vec_id, score, query_row)``: the ``k`` nearest found of
    each row whose vec_id is divisible by ``every``."""
    rows = usable_rows(embeddings).checkpoint()  # written, so that a row keeps its number
    is_query = F.col("vec_id") % every == 0
    stat = rows.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("dim"), F.count(F.when(is_query, 1)).alias("asked"),
                    F.max(F.array_max(F.transform("v", F.abs))).alias("scale")).first()
    n, dim, scale = stat["n"], stat["dim"] or 1, stat["scale"] or 1.0
    longest2 = rows.agg(F.max(F.aggregate("v", F.lit(0.0), lambda a, x: a + (x / scale) * (x / scale)))).first()[0] or 0.0
    space = Space(dim, scale, longest2)
    centres = np.zeros((1, space.full))
    if n > list_rows:
        n_lists = min(MAX_LISTS, math.ceil(math.sqrt(n) / 8))
        bound = max(n_lists, min(SAMPLE, SAMPLE_BYTES // (8 * space.full)))
        some = rows.orderBy(F.xxhash64("vec_id", "row"), "row").limit(bound).select("v").toArrow()
        centres = fit_lists(space.rotated(_matrix(some.column("v"), dim), query=False), min(n_lists, len(some)))
    n_lists = len(centres)
    columns = "row long, vec_id long, v array<double>, list int"

    def assign(batches):
        for b in batches:
            at, _ = _nearest(space.rotated(_matrix(b.column("v"), dim), query=False), centres)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(at.astype(np.int32))], names=[*b.schema.names, "list"])

    # the first step's rows come first, each later step has STEP_UP - 1 times as many as all before it
    steps = 0 if n <= list_rows else math.ceil(math.log(n / list_rows, STEP_UP))
    share_of = F.pmod(F.xxhash64(F.lit(3), F.col("row")), F.lit(STEP_UP ** steps))
    step = F.lit(steps) - sum(((share_of % STEP_UP ** i == 0).cast("int") for i in range(1, steps + 1)), F.lit(0))
    held = rows.mapInArrow(assign, columns).withColumn("step", step).checkpoint()
    size = np.zeros((steps + 1, n_lists), dtype=np.int64)
    for r in held.groupBy("step", "list").count().collect():  # MAX_LISTS rows a step at most
        size[r["step"], r["list"]] = r["count"]
    whole = size.sum(0)

    def probe(batches):
        for b in batches:
            d = _distances(space.rotated(_matrix(b.column("v"), dim), query=True), centres)
            order = np.argsort(d, axis=1, kind="stable")
            before = np.cumsum(whole[order], axis=1) - whole[order]
            i, at = np.nonzero((before < share * whole.sum()) & (whole[order] > 0))
            yield pa.RecordBatch.from_arrays(
                [*(c.take(pa.array(i)) for c in b.columns), pa.array(order[i, at].astype(np.int32))],
                names=[*b.schema.names, "list"])

    asked = rows.filter(is_query)
    n_blocks = max(1, -(-stat["asked"] // block))
    found = None
    for now in range(steps + 1):
        probed = (asked.withColumn("limit", F.lit(float("-inf"))) if found is None else _limited(asked, found, k))
        left = probed.mapInArrow(probe, "row long, vec_id long, v array<double>, limit double, list int")
        new = _step(left, held.filter(F.col("step") == now), size[now], n_blocks, piece, space, k)
        found = _best(new if found is None else new.unionByName(found), k).checkpoint()
    w = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return found.select("query_id", F.row_number().over(w).alias("rank"), "vec_id", "score", "query_row")


def _best(found: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k).drop("rank")


def _limited(asked: DataFrame, found: DataFrame, k: int) -> DataFrame:
    """The queries with the score of their k-th found."""
    last = found.groupBy(F.col("query_row").alias("row")).agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
    limit = F.when(F.col("n") >= k, F.col("least")).otherwise(float("-inf"))
    return asked.join(last, "row", "left").select("row", "vec_id", "v", limit.alias("limit"))


def _step(asked: DataFrame, held: DataFrame, size: np.ndarray, n_blocks: int, piece: int, space: Space, k: int) -> DataFrame:
    """Scan a step's pieces: every pair of a piece and a block of its list's queries once."""
    pieces = [max(1, -(-int(x) // piece)) for x in size]
    of_list = F.element_at(F.array(*[F.lit(x) for x in pieces]), F.col("list") + 1)  # MAX_LISTS numbers
    dealt = lambda parts: F.pmod(F.xxhash64(F.lit(5), F.col("row")), parts).cast("int")
    every_of = lambda parts: F.explode(F.sequence(F.lit(0), (parts - 1).cast("int")))
    left = asked.select("row", "vec_id", "v", "limit", "list", dealt(F.lit(n_blocks)).alias("b"), every_of(of_list).alias("p"))
    right = held.select(*[F.col(c).alias(c) for c in ("row", "vec_id", "v", "list")], dealt(of_list).alias("p"),
                        every_of(F.lit(n_blocks)).alias("b"))
    keys = ["list", "p", "b"]

    def tile(a: pa.Table, c: pa.Table) -> pa.Table:
        ids = lambda t, x: t.column(x).to_numpy()
        if not len(a) or not len(c):
            return pa.table({x: pa.array([], type=pa.float64() if x == "score" else pa.int64())
                             for x in ("query_row", "query_id", "vec_id", "score")})
        i, j, score = scan(space, _matrix(a.column("v"), space.dim), ids(a, "vec_id"), ids(a, "limit"),
                           _matrix(c.column("v"), space.dim), ids(c, "vec_id"), k)
        return pa.table({"query_row": ids(a, "row")[i], "query_id": ids(a, "vec_id")[i], "vec_id": ids(c, "vec_id")[j], "score": score})

    schema = "query_row long, query_id long, vec_id long, score double"
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(tile, schema)
