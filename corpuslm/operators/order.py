"""Global order without a global window: two-level sums over key ranges.

``Window.orderBy`` without ``partitionBy`` moves every row into one task.
Instead rows are grouped into key-range buckets of about equal numbers of rows;
each bucket sums its rows, the bucket totals are cumulated (one small window
over at most ``MAX_BUCKETS`` rows, broadcast back) and a per-bucket running sum
adds the local part.  Cost: one shuffle by bucket.

The bucket borders are quantiles of the key, found by one aggregate and written
into the plan as constants, so a task that is run again deals its rows alike.
The same in groups (``running``, ``rolling``): a group that holds a third of all
rows is cut into parts, and each part gets what the parts before it come to as one
more row, so nothing is joined.

Rows of one key value share a bucket.  Beyond ``MAX_BUCKETS * rows_per_bucket``
rows the buckets grow.
"""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_BUCKET = 2_000_000
MAX_BUCKETS = 100_000
FIRST_BORDERS = 1024  # quantiles that come with the row count; more are asked for when they are needed


def _quantiles(key: str, parts: int) -> Column:
    return F.percentile_approx(key, [i / parts for i in range(1, parts)], max(10_000, 10 * parts))


def place(key: Column, borders: list[int]) -> Column:
    """The number of ascending ``borders`` below the key, in two steps of about
    sqrt(borders) comparisons each."""
    step = max(1, math.isqrt(len(borders)))
    chunks = [borders[i: i + step] for i in range(0, len(borders), step)]
    last = [c[-1] for c in chunks if len(c) == step]
    full = F.size(F.filter(F.from_json(F.lit(json.dumps(last)), "array<bigint>"), lambda s: s < key))
    mine = F.get(F.from_json(F.lit(json.dumps(chunks)), "array<array<bigint>>"), full)
    rest = F.size(F.filter(F.coalesce(mine, F.array().cast("array<bigint>")), lambda s: s < key))
    return (full * step + rest).cast("long")


def bucket_of(df: DataFrame, key: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> Column:
    """The bucket of an integer ``key``: ascending with the key, about equal
    numbers of rows in each."""
    stats = df.agg(F.count(F.lit(1)).alias("n"), _quantiles(key, FIRST_BORDERS).alias("q")).first()
    n = stats["n"]
    if not n:
        return F.lit(0).cast("long")
    # enough buckets to keep every core busy, enough rows per bucket to bound the running-sum task
    cores = df.sparkSession.sparkContext.defaultParallelism
    buckets = max(1, min(MAX_BUCKETS, n, max(math.ceil(n / rows_per_bucket), 4 * cores)))
    borders = stats["q"] or []
    if buckets > FIRST_BORDERS:
        borders = df.agg(_quantiles(key, buckets).alias("q")).first()["q"]
    else:
        borders = [borders[i * FIRST_BORDERS // buckets - 1] for i in range(1, buckets)] if borders else []
    return place(F.col(key), sorted({int(b) for b in borders}))


def prefix_sum(df: DataFrame, key: str, size: Column | str, out: str = "start",
               rows_per_bucket: int = ROWS_PER_BUCKET, order: list[str] | None = None) -> DataFrame:
    """Add ``out`` = sum of ``size`` over all rows that come earlier in
    ``order`` (default: ``[key]``).  Buckets are ranges of the integer
    ``key``, which must be the first order column; ``order`` must be unique."""
    size_col = F.col(size) if isinstance(size, str) else size
    order = order or [key]
    d = df.withColumn("__b", bucket_of(df, key, rows_per_bucket)).withColumn("__s", size_col.cast("long"))
    totals = d.groupBy("__b").agg(F.sum("__s").alias("__t"))
    wb = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("__b", F.coalesce(F.sum("__t").over(wb), F.lit(0)).alias("__base"))
    wl = Window.partitionBy("__b").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = d.withColumn("__local", F.coalesce(F.sum("__s").over(wl), F.lit(0)))
    return (local.join(F.broadcast(bases), "__b")
                 .withColumn(out, (F.col("__base") + F.col("__local")).cast("long"))
                 .drop("__b", "__s", "__local", "__base"))


def last_before(df: DataFrame, key: str, value: str, out: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> DataFrame:
    """Add ``out`` = the last ``value`` that is not null among the rows of
    smaller ``key`` (a unique integer), null if there is none."""
    d = df.withColumn("__b", bucket_of(df, key, rows_per_bucket))
    known = F.when(F.col(value).isNotNull(), F.col(key))
    lasts = d.groupBy("__b").agg(F.max_by(value, known).alias("__l"))
    wb = Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    bases = lasts.select("__b", F.last("__l", ignorenulls=True).over(wb).alias("__base"))
    wl = Window.partitionBy("__b").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    local = d.withColumn("__local", F.last(value, ignorenulls=True).over(wl))
    return (local.join(F.broadcast(bases), "__b")
                 .withColumn(out, F.coalesce("__local", "__base")).drop("__b", "__local", "__base"))


FOLDS = {
    "sum": (F.sum, lambda c: F.coalesce(c, F.lit(0))),
    "min": (F.min, lambda c: c),
    "max": (F.max, lambda c: c),
}


def running(df: DataFrame, groups: list[str], part: Column, order: list[str], value: Column, fold: str, out: str) -> DataFrame:
    """Add ``out`` = the sum (0 of none), minimum or maximum (null of none) of ``value``
    over the rows of the same group that come earlier in ``order``.

    ``part`` is a number that ascends with the order and cuts a group into parts that
    fit a task.  Null groups, parts and values: a null group is a group, a null part
    the first part, a null value adds nothing."""
    take, none = FOLDS[fold]
    d = df.withColumn("__p", part).withColumn("__v", value)
    whole = d.groupBy(*groups, "__p").agg(take("__v").alias("__v"))
    before = Window.partitionBy(*groups).orderBy("__p").rowsBetween(Window.unboundedPreceding, -1)
    carried = whole.select(*groups, "__p", take("__v").over(before).alias("__v")).withColumn("__own", F.lit(False))
    rows = d.withColumn("__own", F.lit(True)).unionByName(carried, allowMissingColumns=True)
    w = Window.partitionBy(*groups, "__p").orderBy("__own", *order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn(out, none(take("__v").over(w))).filter("__own").drop("__p", "__v", "__own")


def rolling_mean(df: DataFrame, groups: list[str], pos: str, value: str, n: int, out: str, span: int) -> DataFrame:
    """Add ``out`` = the mean of the last ``n`` values up to each row's own, in a group's rows
    numbered by ``pos`` from 0 without gaps.  A group is cut into parts of ``span`` rows (at least
    ``n``); the last ``n - 1`` rows of a part are seen by the next one too."""
    span = max(span, n)
    p = F.floor(F.col(pos) / span).cast("long")
    seen = F.when(F.col(pos) % span >= span - (n - 1), F.array(p, p + 1)).otherwise(F.array(p))
    d = df.withColumn("__p", F.explode(seen))
    w = Window.partitionBy(*groups, "__p").orderBy(pos).rowsBetween(-(n - 1), 0)
    return d.withColumn(out, F.avg(value).over(w)).filter(F.col("__p") == p).drop("__p")
