"""Count-based next-token model (LM-*), serving the train / evaluate /
generate verbs.  This is a smoothed n-gram model, not a transformer.

* fit: counts of (context of up to n-1 tokens, next token) over the token
  stream, cut from stream blocks with an (n-1)-token halo; partial aggregation
  before the shuffle keeps a context that holds a third of the stream cheap.
* distribution: maximum likelihood or add-alpha per seen context (a window per
  context, bounded by the vocabulary); unseen contexts back off to their longest
  seen suffix, at last to the unigram model (context ``[]``).  Evaluation uses
  add-alpha smoothing so every target has a finite loss.
* sampling: temperature -> top-k (ties kept) -> softmax -> draw, with the
  uniform draw taken from ``md5(seed:prompt:step)`` so runs repeat.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslm.operators.clean import let
from corpuslm.operators.dataset import BLOCK, blocks
from corpuslm.session import prepare

HEX12 = float(16 ** 12)


def ngram_pairs(stream: DataFrame, n: int = 2, block: int = BLOCK) -> DataFrame:
    """``(ctx ARRAY<INT>, next INT)`` for every position of the stream."""
    b = blocks(stream, n - 1, block)

    def cut(arr):
        def one(i):
            return F.struct(F.slice(arr, i + 1, n - 1).alias("ctx"),
                            F.get(arr, i + n - 1).alias("next"))
        return F.transform(F.sequence(F.lit(0), F.size("toks") - 1), one)

    ex = b.select(F.explode(let(F.concat("toks", "halo"), cut)).alias("p"))
    return ex.select("p.ctx", "p.next").filter(F.col("next").isNotNull())


def fit_ngram(stream: DataFrame, n: int = 2) -> DataFrame:
    """LM-01: ``(ctx, next, c)`` for contexts of n-1 tokens and of every shorter
    length down to none (``ctx = []``), in one pass and one shuffle."""
    b = blocks(stream, max(n - 1, 1)).select("toks", "halo")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, BLOCKS_AT_ONCE):
                part = batch.slice(i, BLOCKS_AT_ONCE)
                yield from _count_levels([_numbers(part.column(c)) for c in (0, 1)], n)

    rows = b.mapInArrow(count, "ctx array<int>, next int, c bigint")
    return rows.groupBy("ctx", "next").agg(F.sum("c").alias("c"))


BLOCKS_AT_ONCE = 32  # blocks whose n-grams a task counts together


def _numbers(lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The values of a list column and how many each row has."""
    return (lists.flatten().to_numpy(zero_copy_only=False).astype(np.int32),
            pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64))


def _numbered(names: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names numbered from 0 in ascending order, and how often each occurs."""
    top = int(names.max(initial=-1)) + 1
    if top > 4 * len(names) + 1024 or names.min(initial=0) < 0:
        _, number, times = np.unique(names, return_inverse=True, return_counts=True)
        return number, times
    times = np.bincount(names, minlength=top)  # few names: count them in place, without a sort
    seen = np.flatnonzero(times)
    number = np.empty(top, np.int64)
    number[seen] = np.arange(len(seen))
    return number[names], times[seen]


def _count_levels(columns: list[tuple[np.ndarray, np.ndarray]], n: int) -> Iterator[pa.RecordBatch]:
    """Counts of ``(ctx, next)`` for contexts of 0 to n-1 tokens in some blocks, given as
    their tokens and halos.  An n-gram is named by the number of its first n-1 tokens
    and its last one, and numbered anew at each length, so no name outgrows a long."""
    (toks, n_toks), (halo, n_halo) = columns
    size = n_toks + n_halo
    begin = np.cumsum(size) - size
    arr = np.empty(int(size.sum()), np.int32)
    for values, lengths, to in ((toks, n_toks, begin), (halo, n_halo, begin + n_toks)):
        arr[np.arange(len(values)) + np.repeat(to - (np.cumsum(lengths) - lengths), lengths)] = values
    end = np.repeat(begin + size, n_toks)  # for each position of a block, where its row ends
    at = np.arange(len(toks)) + np.repeat(begin - (np.cumsum(n_toks) - n_toks), n_toks)
    low, times = _numbered(arr)
    letters = len(times)
    name = np.zeros(len(at), np.int64)
    for m in range(n):
        inside = at + m < end
        at, end, name = at[inside], end[inside], name[inside]
        if not len(at):
            return
        name, times = _numbered(name * letters + low[at + m])
        one = np.empty(len(times), np.int64)
        one[name] = at
        ctx = arr[one[:, None] + np.arange(m)].ravel() if m else np.empty(0, np.int32)
        yield pa.RecordBatch.from_arrays(
            [pa.ListArray.from_arrays(np.arange(len(times) + 1, dtype=np.int32) * m, ctx), pa.array(arr[one + m]), pa.array(times.astype(np.int64))],
            names=["ctx", "next", "c"])


def next_dist(counts: DataFrame, alpha: float = 0.0, vocab_size: int = 0) -> DataFrame:
    """LM-02: ``(ctx, next, c, total, p, logit)`` with ``logit = ln p``.  With
    ``alpha`` every token of the vocabulary gets that much more: seen ones have
    rows of their own, all others share the row of ``next = -1``, which gives the
    probability of each of them (none if the context has seen them all)."""
    w = Window.partitionBy("ctx")
    total = F.sum("c").over(w)
    if not alpha:
        return counts.select("ctx", "next", "c", total.alias("total"),
                             (F.col("c") / total).alias("p"), F.log(F.col("c") / total).alias("logit"))
    if vocab_size < 1:
        raise ValueError("add-alpha smoothing needs the size of the vocabulary")
    rest = (counts.groupBy("ctx").agg(F.sum("c").alias("total"), F.count(F.lit(1)).alias("k")).filter(F.col("k") < vocab_size)
            .select("ctx", F.lit(-1).cast("int").alias("next"), F.lit(0).cast("long").alias("c"), "total"))
    rows = counts.select("ctx", F.col("next").cast("int").alias("next"), F.col("c").cast("long").alias("c"), total.alias("total"))
    p = (F.col("c") + float(alpha)) / (F.col("total") + float(alpha) * vocab_size)
    return rows.unionByName(rest).select("ctx", "next", "c", "total", p.alias("p"), F.log(p).alias("logit"))


def cross_entropy(counts: DataFrame, targets: DataFrame, vocab_size: int,
                  alpha: float = 1.0, group: list[str] | None = None, n: int = 2) -> DataFrame:
    """LM-03: mean ``-ln p(next | ctx)`` of the targets (``next = -1`` is
    ignored), add-alpha smoothed.  A context that was never seen backs off to its
    longest suffix that was, at last to the empty one: one join per length.
    ``group`` gives one mean per group instead of one overall."""
    group = group or []
    # equal targets are counted before the joins: at most vocab_size ** n of them, however long the text
    t = targets.filter(F.col("next") != -1).groupBy(*group, "ctx", "next").agg(F.count(F.lit(1)).alias("times"))
    # only the contexts that some target can come to are summed up
    suffixes = F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda k: F.when(F.size("ctx") >= k, F.slice("ctx", F.size("ctx") - k + 1, k)))
    asked = t.select(F.explode(suffixes).alias("ctx")).filter(F.col("ctx").isNotNull()).distinct()
    counts = counts.select("ctx", "next", "c").join(asked, "ctx", "left_semi")
    totals = counts.groupBy("ctx").agg(F.sum("c").alias("total"))
    at, total = F.array().cast("array<int>"), F.lit(None).cast("long")
    for k in range(1, n):  # the longest one wins
        own = totals.filter(F.size("ctx") == k).select(F.col("ctx").alias(f"s{k}"), F.col("total").alias(f"t{k}"))
        t = t.withColumn(f"s{k}", F.when(F.size("ctx") >= k, F.slice("ctx", F.size("ctx") - (k - 1), k))).join(own, f"s{k}", "left")
        at, total = F.when(F.col(f"t{k}").isNotNull(), F.col(f"s{k}")).otherwise(at), F.coalesce(f"t{k}", total)
    t = t.select(*group, "next", "times", at.alias("ctx"), total.alias("total"))
    whole = totals.filter(F.size("ctx") == 0).agg(F.sum("total").alias("n_total"))
    j = t.join(counts.select("ctx", "next", "c"), ["ctx", "next"], "left").crossJoin(F.broadcast(whole))  # one row
    a = float(alpha)
    p = (F.coalesce("c", F.lit(0)) + a) / (F.coalesce("total", "n_total", F.lit(0)) + a * vocab_size)
    times = F.coalesce(F.sum("times"), F.lit(0))
    return j.groupBy(*group).agg(times.alias("n_targets"), F.try_divide(F.sum(-F.log(p) * F.col("times")), times).alias("loss"))


def window_targets(windows: DataFrame, n: int = 2) -> DataFrame:
    """Targets of next-token windows: for each t, next = ``y[t]`` and the context
    is the last n-1 tokens of x up to t (fewer at the start of a window)."""
    others = [c for c in windows.columns if c not in ("x", "y")]
    ex = windows.select(*others, "x", F.posexplode("y").alias("t", "next"))
    k = F.least(F.lit(n - 1), F.col("t") + 1)
    return ex.select(*others, "t", F.slice("x", F.col("t") + 2 - k, k).alias("ctx"), "next")


def estimate_loss(counts: DataFrame, eval_windows: DataFrame, vocab_size: int, batch_size: int = 32,
                  max_batches: int = 20, alpha: float = 1.0, n: int = 2) -> DataFrame:
    """LM-04/05: mean of per-batch mean losses over the first ``max_batches``
    evaluation batches (a short last batch weighs as much as a full one),
    and its perplexity."""
    w = eval_windows.filter(F.col("win_id") < max_batches * batch_size) \
                    .withColumn("batch", F.floor(F.col("win_id") / batch_size))
    per = cross_entropy(counts, window_targets(w.select("batch", "x", "y"), n), vocab_size, alpha, ["batch"], n)
    return per.agg(F.count(F.lit(1)).alias("n_batches"), F.avg("loss").alias("loss")) \
              .withColumn("perplexity", F.exp("loss"))


def softmax(dist: DataFrame, temperature: float = 0.8, top_k: int | None = 40) -> DataFrame:
    """LM-06/07: logits / T, keep the top k per context (``rank`` so ties
    all stay), softmax over what is kept: ``(ctx, next, q)``."""
    if temperature <= 0:
        raise ValueError("temperature must be > 0")
    d = dist.select("ctx", "next", (F.col("logit") / temperature).alias("z"))
    if top_k is not None:
        d = d.withColumn("rk", F.rank().over(Window.partitionBy("ctx").orderBy(F.desc("z")))) \
             .filter(F.col("rk") <= top_k).drop("rk")
    w = Window.partitionBy("ctx")
    e = F.exp(F.col("z") - F.max("z").over(w))
    d = d.withColumn("e", e)
    return d.select("ctx", "next", (F.col("e") / F.sum("e").over(w)).alias("q"))


def sampling_table(probs: DataFrame) -> DataFrame:
    """LM-08: ``(ctx, next, lo, hi, tot)``: cumulative ranges in token order."""
    w = Window.partitionBy("ctx").orderBy("next").rowsBetween(Window.unboundedPreceding, 0)
    hi = F.sum("q").over(w)
    # a range begins exactly where the one before it ends
    lo = F.coalesce(F.lag("hi").over(Window.partitionBy("ctx").orderBy("next")), F.lit(0.0))
    t = probs.withColumn("hi", hi).withColumn("lo", lo)
    return t.withColumn("tot", F.max("hi").over(Window.partitionBy("ctx"))).select("ctx", "next", "lo", "hi", "tot")


def uniform(seed: int, *parts: Column) -> Column:
    """Repeatable draw in [0, 1) from ``md5(seed:part:...)``."""
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]))
    return F.conv(F.substring(h, 1, 12), 16, 10).cast("double") / HEX12


def draw(requests: DataFrame, table: DataFrame, u_col: str = "u") -> DataFrame:
    """Pick ``next`` where ``lo <= u * tot < hi`` (equi-join on ctx, then a
    range filter within the context's few rows)."""
    j = requests.join(table, "ctx")
    x = F.col(u_col) * F.col("tot")
    return j.filter((F.col("lo") <= x) & (x < F.col("hi"))).drop("lo", "hi", "tot")


HELD_ENTRIES = 2_000_000  # entries of a sampling table that go to every task


def context_rows(table: DataFrame) -> DataFrame:
    """The sampling table with one row per context: ``(ctx, nexts, his, tot)``,
    his being the cumulative weights in token order (at most the vocabulary)."""
    e = F.array_sort(F.collect_list(F.struct("next", "hi")))
    return table.groupBy("ctx").agg(e.alias("e"), F.max("tot").alias("tot")).select(
        "ctx", F.col("e.next").alias("nexts"), F.col("e.hi").alias("his"), "tot")


def generate(prompts: DataFrame, table: DataFrame, max_tokens: int = 200, n: int = 2, seed: int = 0,
             checkpoint_every: int = 10, key: str = "prompt_id", held_entries: int = HELD_ENTRIES) -> DataFrame:
    """LM-09: extend every prompt ``max_tokens`` times.  The context is the last
    n-1 tokens; an unknown or empty context draws from the unigram row
    (``ctx = []``); an empty table extends nothing.  Output keeps the prompt:
    ``(key, ids)``.

    A table of at most ``held_entries`` entries goes to all tasks and all steps are
    made where the prompt is, without a shuffle.  A larger one is joined once a
    step, one row per context."""
    prepare(prompts.sparkSession)
    rows = context_rows(table).checkpoint()
    size = rows.agg(F.coalesce(F.sum(F.size("nexts").cast("long")), F.lit(0))).first()[0]
    if size <= held_entries:
        return _generate_in_place(prompts, rows, max_tokens, n, seed, key)
    uni = rows.filter(F.size("ctx") == 0).select(*[F.col(c).alias(f"u_{c}") for c in ("nexts", "his", "tot")])  # one row
    state = prompts.select(key, "ids").crossJoin(F.broadcast(uni))
    for step in range(max_tokens):
        held = F.size("ids")
        own = F.when(held >= n - 1, F.slice("ids", F.greatest(held - (n - 2), F.lit(1)), n - 1))
        j = state.withColumn("ctx", own).join(rows, "ctx", "left")
        x = uniform(seed, F.col(key), F.lit(step)) * F.coalesce("tot", "u_tot")
        at = F.size(F.filter(F.coalesce("his", "u_his"), lambda h: h <= F.col("x")))
        grown = F.concat("ids", F.array(F.get(F.coalesce("nexts", "u_nexts"), at).cast("int")))
        state = j.withColumn("x", x).select(key, grown.alias("ids"), "u_nexts", "u_his", "u_tot")
        if (step + 1) % checkpoint_every == 0:
            state = state.select(key, "ids").checkpoint().crossJoin(F.broadcast(uni))
    return state.select(key, "ids")


def _generate_in_place(prompts: DataFrame, rows: DataFrame, max_tokens: int, n: int, seed: int, key: str) -> DataFrame:
    held = prompts.sparkSession.sparkContext.broadcast({
        tuple(r["ctx"]): (r["nexts"], r["his"], r["tot"]) for r in rows.collect()})

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = held.value
        for b in batches:
            out = []
            for k, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                ids = list(ids or ())
                for step in range(max_tokens if table else 0):
                    own = tuple(ids[len(ids) - (n - 1):]) if len(ids) >= n - 1 else None
                    nexts, his, tot = table[own] if own in table else table[()]
                    u = int(hashlib.md5(f"{seed}:{k}:{step}".encode()).hexdigest()[:12], 16) / HEX12
                    ids.append(nexts[min(bisect.bisect_right(his, u * tot), len(nexts) - 1)])
                out.append(ids)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, type=pa.list_(pa.int32()))], names=[key, "ids"])

    schema = T.StructType([prompts.schema[key], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return prompts.select(key, "ids").mapInArrow(extend, schema)


def perplexity(loss: Column) -> Column:
    """LM-05."""
    return F.exp(loss)

