"""Next-token datasets (DAT-*).

The token stream is the per-document token lists in key order.  Windows are
cut from fixed-size blocks of the stream, each block carrying the first
``L`` tokens of the next block as a halo, so no window ever needs a shuffle
of its own and no task holds more than one block.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslm.operators.clean import let
from corpuslm.operators.order import prefix_sum

BLOCK = 1 << 16  # tokens per block
WINDOWS_AT_ONCE = 1 << 14  # windows of a block that leave the Arrow node together


def token_stream(tokens: DataFrame, key: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """DAT-01: ``(gpos, id)``, one row per token, windows cross documents."""
    starts = prefix_sum(tokens.select(key, F.size(ids_col).cast("long").alias("n")), key, "n", "start")
    t = tokens.select(key, ids_col).join(starts.select(key, "start"), key)
    ex = t.select("start", F.posexplode(ids_col).alias("i", "id"))
    return ex.select((F.col("start") + F.col("i")).cast("long").alias("gpos"), F.col("id").cast("int").alias("id"))


def token_stream_from_occurrences(occ: DataFrame, key: str = "doc_id") -> DataFrame:
    """DAT-01 straight from word occurrences ``(key, pos, ids)``: no list per
    document is ever built, so one huge document is spread like any other.
    About 2-3x the cost of ``token_stream`` over per-document lists at sf0.1
    (it sorts occurrences, not documents); use it when single documents are
    too large for one task.

    The global order (key, pos) is packed into one long ``key * W + pos``
    (``W`` = longest document + 1, checked against overflow) and ranked by the
    two-level prefix sum, whose key-range buckets then cut a large document
    into several buckets."""
    # read three times below (bounds, bucket totals, running sums): materialise
    # the narrow id table once instead of re-tokenising and re-encoding
    o = (occ.filter(F.col("ids").isNotNull())
            .select(key, "pos", F.size("ids").cast("long").alias("n"), "ids").checkpoint())
    st = o.agg(F.max("pos").alias("mp"), F.max(key).alias("mk"), F.min(key).alias("lo")).first()
    if st["mp"] is None:
        return occ.sparkSession.createDataFrame([], "gpos bigint, id int")
    width = int(st["mp"]) + 1
    if (int(st["mk"]) - int(st["lo"]) + 1) * width >= 2 ** 62:
        raise ValueError("document keys too wide to pack with positions; rank documents first")
    packed = o.withColumn("__o", (F.col(key) - F.lit(st["lo"])) * F.lit(width) + F.col("pos"))
    starts = prefix_sum(packed, "__o", "n", "start")
    ex = starts.select("start", F.posexplode("ids").alias("k", "id"))
    return ex.select((F.col("start") + F.col("k")).cast("long").alias("gpos"), F.col("id").cast("int").alias("id"))


def token_runs(tokens: DataFrame, key: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """The token stream as ``(start, ids)``, one row per document: what blocks
    and windows are cut from without a row per token."""
    starts = prefix_sum(tokens.select(key, F.size(ids_col).cast("long").alias("n")), key, "n", "start")
    return tokens.select(key, F.col(ids_col).alias("ids")).join(starts.select(key, "start"), key).select("start", "ids")


def _blocks_of_runs(runs: DataFrame, L: int, block: int) -> DataFrame:
    """Blocks of ``(start, ids)`` rows: a document gives one slice per block
    that it touches, and what lies within the first ``L`` tokens of a block goes
    to the block before as well; one group-by brings the slices together."""
    end = F.col("start") + F.size("ids")

    def piece(blk: Column, length: int, to: Column, halo: bool) -> Column:
        lo, hi = F.greatest(F.col("start"), blk * block), F.least(end, blk * block + length)
        return F.struct(to.alias("blk"), F.lit(halo).alias("halo"), lo.alias("at"), F.slice(
            "ids", (lo - F.col("start") + 1).cast("int"), F.greatest(hi - lo, F.lit(0)).cast("int")).alias("part"))

    touched = F.sequence(F.floor(F.col("start") / block), F.floor((end - 1) / block))
    pieces = F.flatten(F.transform(touched, lambda k: F.array(piece(k, block, k, False), piece(k, L, k - 1, True))))
    rows = (runs.filter(F.size("ids") > 0).select(F.explode(pieces).alias("p")).select("p.*")
            .filter((F.size("part") > 0) & (F.col("blk") >= 0)))

    def joined(halo: bool) -> Column:  # "at" orders the slices; a block holds at most block + L tokens
        mine = F.sort_array(F.collect_list(F.when(F.col("halo") == halo, F.struct("at", "part"))))
        return F.flatten(F.transform(mine, lambda x: x["part"]))
    return rows.groupBy("blk").agg(joined(False).alias("toks"), joined(True).alias("halo"))


def count_tokens(stream: DataFrame) -> int:
    """Tokens of a stream ``(gpos, id)`` or of runs ``(start, ids)``."""
    if "ids" in stream.columns:
        return stream.agg(F.coalesce(F.sum(F.size("ids").cast("long")), F.lit(0))).first()[0]
    return stream.count()


def blocks(stream: DataFrame, L: int, block: int = BLOCK) -> DataFrame:
    """``(blk, toks, halo)``: the tokens of each block in order and the first
    ``L`` tokens after it (from the next blocks).  ``stream`` has one row per
    token (``gpos, id``) or per document (``start, ids``, see ``token_runs``)."""
    block = max(block, L)
    if "ids" in stream.columns:
        return _blocks_of_runs(stream, L, block)
    b = (stream.groupBy(F.floor(F.col("gpos") / block).cast("long").alias("blk"))
               .agg(F.sort_array(F.collect_list(F.struct("gpos", "id"))).alias("s"))
               .select("blk", F.transform("s", lambda x: x.getField("id")).alias("toks")))
    nxt = b.select((F.col("blk") - 1).alias("blk"), F.slice("toks", 1, L).alias("halo"))
    return b.join(nxt, "blk", "left").select(
        "blk", "toks", F.coalesce("halo", F.array().cast("array<int>")).alias("halo"))


def window_count(n_tokens: int, L: int) -> int:
    """DAT-03: ``N - L`` examples; short input gives none."""
    return max(0, n_tokens - L)


def windows(stream: DataFrame, L: int, stride: int = 1, block: int = BLOCK) -> DataFrame:
    """DAT-02: ``(win_id, x, y)`` with x = tok[i:i+L], y = tok[i+1:i+L+1] for
    window starts i = 0, stride, 2*stride, ... < N - L; ``win_id = i // stride``.
    Stride 1 is the reference's dataset (L-fold data); ``stride = L`` gives
    disjoint windows."""
    block = -(-max(block, L) // stride) * stride  # whole strides, at least L tokens; `blocks` takes it as it is
    n = count_tokens(stream)
    last_start = n - L - 1  # inclusive
    if last_start < 0:
        return stream.sparkSession.createDataFrame([], "win_id bigint, x array<int>, y array<int>")
    b = blocks(stream, L, block)
    per_block = block // stride

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(b.num_rows):
                blk = b.column(0)[i].as_py()
                first, due = blk * per_block, min(per_block, (last_start - blk * block) // stride + 1)
                if due <= 0:
                    continue
                arr = np.concatenate([c[i].values.to_numpy(zero_copy_only=False) for c in b.columns[1:]]).astype(np.int32)
                both = np.empty((0, L + 1), np.int32)
                if len(arr) > L:
                    both = np.lib.stride_tricks.sliding_window_view(arr, L + 1)[::stride][:due]
                for k in range(0, len(both), WINDOWS_AT_ONCE):
                    w = both[k: k + WINDOWS_AT_ONCE]
                    ends = np.arange(len(w) + 1, dtype=np.int32) * L
                    x, y = (pa.ListArray.from_arrays(ends, np.ascontiguousarray(side).ravel()) for side in (w[:, :-1], w[:, 1:]))
                    yield pa.RecordBatch.from_arrays([pa.array(first + k + np.arange(len(w))), x, y], names=["win_id", "x", "y"])
                # keys that repeat leave places of the stream empty: windows there are short
                for k in range(len(both), due, WINDOWS_AT_ONCE):
                    at = range(k, min(due, k + WINDOWS_AT_ONCE))
                    x, y = ([arr[j * stride + d: j * stride + d + L] for j in at] for d in (0, 1))
                    yield pa.RecordBatch.from_arrays([pa.array([first + j for j in at]), *(pa.array(v, pa.list_(pa.int32())) for v in (x, y))],
                                                     names=["win_id", "x", "y"])

    return b.select("blk", "toks", "halo").mapInArrow(cut, "win_id bigint, x array<int>, y array<int>")


def _hash_key(seed: int, epoch: Column, win_id: Column):
    return F.md5(F.concat_ws(":", F.lit(str(seed)), epoch.cast("string"), win_id.cast("string")))


def shuffle_batches(win_ids: DataFrame, batch_size: int = 32, epochs: int = 1, seed: int = 0,
                    rows_per_bucket: int = 2_000_000) -> DataFrame:
    """DAT-04: ``(epoch, batch, win_id)``: every window once per epoch in a
    new, repeatable order; the last batch may be short.

    The order is ``md5(seed:epoch:win_id)``; the position in it comes from a
    two-level count over ranges of the hash (uniform by construction, so no
    bucket is hot), never from a global sort."""
    spark = win_ids.sparkSession
    ep = spark.range(epochs).select(F.col("id").alias("epoch"))
    n = win_ids.count() * epochs
    w = win_ids.select("win_id").crossJoin(F.broadcast(ep))  # epochs: a handful of rows
    h = _hash_key(seed, F.col("epoch"), F.col("win_id"))
    buckets = max(1, math.ceil(n / rows_per_bucket))
    # first 8 hex digits spread uniformly over [0, 2**32); the product stays in a long up to 2**31 buckets
    hnum = F.conv(F.substring(h, 1, 8), 16, 10).cast("long")
    w = w.withColumn("hb", F.shiftright(hnum * F.lit(buckets).cast("long"), 32))
    totals = w.groupBy("epoch", "hb").agg(F.count(F.lit(1)).alias("c"))
    wb = Window.partitionBy("epoch").orderBy("hb").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("epoch", "hb", F.coalesce(F.sum("c").over(wb), F.lit(0)).alias("base"))
    wl = Window.partitionBy("epoch", "hb").orderBy("h", "win_id")
    # the hash, most of a row, is made again where the row has come to
    local = w.repartition("epoch", "hb").withColumn("h", h).withColumn("r", F.row_number().over(wl) - 1).drop("h")
    ranked = local.join(bases, ["epoch", "hb"])
    rank = F.col("base") + F.col("r")
    return ranked.select("epoch", F.floor(rank / batch_size).cast("long").alias("batch"), "win_id")


ROUNDS = 10  # half-rounds of the keyed permutation


def _sides(n: int) -> tuple[int, int]:
    """Two numbers near the root of ``n`` whose product is at least ``n``, by as little as can be found."""
    root = math.isqrt(n - 1) + 1
    a = min(range(root, root + 64), key=lambda c: -n % c)
    return a, -(-n // a)


def _network(x: Column, n: int, seed: int, epoch: Column, back: bool) -> Column:
    """A Feistel network over the pairs ``(v div b, v mod b)`` of an a-by-b table: by turns one
    half moves by a hash of the other.  The rounds in reverse order lead back.

    The table has ``a * b - n`` (fewer than a) places beyond n.  A number that lands there goes
    through the network again until it is inside; on its way it meets each of those places
    at most once, so the bound of the walk is exact, and few numbers walk at all."""
    a, b = _sides(n)
    order = range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)
    sign = -1 if back else 1

    def moved(half, other, size, i):
        key = F.pmod(F.xxhash64(F.lit(seed), epoch, i, other), F.lit(size).cast("long"))
        return F.pmod(half + key * sign, F.lit(size).cast("long"))

    def unrolled(v):  # compiled, and equal parts are shared; v is named in it some hundred times
        left, right = F.call_function("div", v, F.lit(b)), F.pmod(v, F.lit(b).cast("long"))
        for i in order:
            if i % 2 == 0:
                left = moved(left, right, a, F.lit(i))
            else:
                right = moved(right, left, b, F.lit(i))
        return left * b + right

    def one(v, i):
        left, right = F.call_function("div", v, F.lit(b)), F.pmod(v, F.lit(b).cast("long"))
        return F.when(i % 2 == 0, moved(left, right, a, i) * b + right).otherwise(left * b + moved(right, left, b, i))

    def through(v):  # a loop in an expression, which is interpreted
        return F.aggregate(F.array(*[F.lit(i) for i in order]), v, one)

    def inside(v):
        walk = F.sequence(F.lit(1), F.lit(a * b - n))
        return F.aggregate(walk, v, lambda w, _: F.when(w < n, w).otherwise(through(w)))
    if re.fullmatch(r"Column<'\w+'>", str(x)):  # a column as it is, no expression that would be copied
        once = unrolled(x.cast("long"))
        return once if a * b == n else F.when(once < n, once).otherwise(inside(once))
    once = through(x.cast("long"))
    if a * b == n:
        return once
    return let(once, lambda v: F.when(v < n, v).otherwise(inside(v)))


def window_at(place: Column, n: int, seed: int, epoch: Column) -> Column:
    """The window at a place (0..n-1) of an epoch's order."""
    n = max(1, n)
    return _network(place, n, seed, epoch.cast("long"), False)


def place_of(win_id: Column, n: int, seed: int, epoch: Column) -> Column:
    """The place (0..n-1) of a window in an epoch's order."""
    n = max(1, n)
    return _network(win_id, n, seed, epoch.cast("long"), True)


def keyed_batches(win_ids: DataFrame, n: int, batch_size: int = 32, epochs: int = 1, seed: int = 0) -> DataFrame:
    """DAT-04 without a shuffle: ``(epoch, batch, win_id)`` for windows numbered 0 to
    n - 1, by a keyed permutation instead of a sort.  A window's batch is computed where
    the window is, so any part of the table can be dealt alone; a number outside
    0..n-1 is an error."""
    inside = F.when((F.col("win_id") >= 0) & (F.col("win_id") < n), F.col("win_id")).otherwise(
        F.raise_error(F.lit(f"window numbers must lie in 0..{n - 1}")).cast("long"))
    w = win_ids.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(epochs - 1).cast("long"))).alias("epoch"), inside.alias("win_id"))
    return w.select("epoch", F.floor(place_of(F.col("win_id"), n, seed, F.col("epoch")) / batch_size).cast("long").alias("batch"), "win_id")


def step_windows(steps: DataFrame, n: int, batch_size: int = 32, seed: int = 0) -> DataFrame:
    """The windows of some training steps ``(step)``, in the order of ``keyed_batches``:
    ``(step, epoch, batch, slot, win_id)``.  Nothing but the step's number is looked at, so a
    run that starts again at step s has its batch at once."""
    per_epoch = -(-n // batch_size)
    if per_epoch == 0:
        return steps.sparkSession.createDataFrame([], "step bigint, epoch bigint, batch bigint, slot int, win_id bigint")
    s = steps.select(F.col("step").cast("long").alias("step")).select(
        "step", F.floor(F.col("step") / per_epoch).cast("long").alias("epoch"), F.pmod("step", F.lit(per_epoch)).cast("long").alias("batch"))
    s = s.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(batch_size - 1))))
    place = F.col("batch") * batch_size + F.col("slot")
    return s.filter(place < n).select("step", "epoch", "batch", "slot", window_at(place, n, seed, F.col("epoch")).alias("win_id"))


def eval_batches(win_ids: DataFrame, batch_size: int = 32, max_batches: int = 20) -> DataFrame:
    """DAT-05: evaluation batches in order, the first ``max_batches`` only."""
    return (win_ids.filter(F.col("win_id") < max_batches * batch_size)
                   .select(F.floor(F.col("win_id") / batch_size).cast("long").alias("batch"), "win_id"))


def lr_at(step: Column, max_steps: int, warmup: int = 500, max_lr: float = 3e-4,
          min_ratio: float = 0.1) -> Column:
    """Linear warm-up, cosine decay to ``min_ratio * max_lr``, flat after
    ``max_steps``.  Warm-up 0 skips the ramp; ``warmup == max_steps`` has no
    decay phase (the reference divides by zero there)."""
    min_lr = max_lr * min_ratio
    s = step.cast("double")
    if max_steps == warmup:
        decay = F.lit(min_lr)
    else:
        ratio = (s - warmup) / float(max_steps - warmup)
        decay = F.lit(min_lr) + 0.5 * (1.0 + F.cos(F.lit(math.pi) * ratio)) * (max_lr - min_lr)
    out = F.when(s > max_steps, F.lit(min_lr)).otherwise(decay)
    if warmup > 0:
        out = F.when(s < warmup, max_lr * (s + 1.0) / warmup).otherwise(out)
    return out


def training_manifest(n_batches: int, spark, max_steps: int = 15000, warmup: int = 500,
                      max_lr: float = 3e-4) -> DataFrame:
    """DAT-06: ``(step, epoch, batch, lr)``: step s uses batch ``s mod
    n_batches`` of epoch ``s div n_batches`` (the loader restarts with a new
    order when an epoch ends)."""
    if n_batches <= 0:
        return spark.createDataFrame([], "step bigint, epoch bigint, batch bigint, lr double")
    st = spark.range(max_steps).select(F.col("id").alias("step"))
    return st.select("step", (F.col("step") / n_batches).cast("long").alias("epoch"),
                     (F.col("step") % n_batches).alias("batch"),
                     F.round(lr_at(F.col("step"), max_steps, warmup, max_lr), 12).alias("lr"))
