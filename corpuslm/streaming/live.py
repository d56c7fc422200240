"""Metrics of running training jobs (STR-04, MET-01, MET-03 live).

``live_metrics`` keeps a state per run: the rows that the watermark has not passed yet,
the last ``n`` losses, the number of rows so far and the lowest evaluation.  A row waits until
the watermark passes its time, so rows that arrive out of order within the delay are
taken in order, and what is written in append mode never changes.  An event-time timer per
run wakes it; a run without waiting rows costs nothing in a micro-batch.

The state of a run is bounded by ``n`` losses and the rows of one watermark delay.  The rows
of one run go through one task a micro-batch, as they must be taken one after another;
finished logs are better read by the batch operators, which cut a run into parts.

Defined results.  Rows later than the watermark are dropped by Spark.  A row without a time has no place in
the run and is left out.  A null run is a run.  Rows of one time are taken by ``order``, then by
loss, null first; repeated rows count each.  A null loss counts as a step, adds nothing to a mean and never
wins; a NaN makes the means NaN, never wins and is no earlier evaluation.  An empty stream
gives no rows.  Other columns are ignored.
"""

from __future__ import annotations

import math
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from corpuslm.streaming.stream import run_available

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# the process that sets up a stream's state does not get the files of addPyFile: the
# processor goes there whole, not as a name to import
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_WAITING = T.StructType([T.StructField("us", T.LongType()), T.StructField("pos", T.LongType()),
                         T.StructField("loss", T.DoubleType())])
_SEEN = T.StructType([T.StructField("rows", T.LongType()), T.StructField("best", T.DoubleType()),
                      T.StructField("ring", T.ArrayType(T.DoubleType()))])


def _mean(losses: list[float | None]) -> float | None:
    """Summed from the oldest on, as a window over the rows is."""
    total, n = 0.0, 0
    for x in losses:
        if x is not None:
            total, n = total + x, n + 1
    return total / n if n else None


class _Run(StatefulProcessor):
    def __init__(self, out: T.StructType, log_every: int, eval_every: int):
        self.out, self.log_every, self.eval_every = out, log_every, eval_every

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", _WAITING)
        self.seen = handle.getValueState("seen", _SEEN)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        first = None
        for part in rows:
            # plain numbers and None; a loss that is null comes with its mark, since pandas makes it a NaN
            new = [(int(us), int(pos), None if gone else float(loss)) for us, pos, loss, gone in
                   zip(part["us"], part["pos"], part["loss"], part["no_loss"], strict=True)]
            if new:
                self.waiting.appendList(new)
                low = min(r[0] for r in new)
                first = low if first is None else min(first, low)
        if first is not None:
            self._wake(first)
        yield pd.DataFrame(columns=self.out.names)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        limit = timerValues.getCurrentWatermarkInMs() * 1000
        held = [tuple(r) for r in self.waiting.get()] if self.waiting.exists() else []
        ready = sorted((r for r in held if r[0] <= limit), key=_order)
        later = [r for r in held if r[0] > limit]
        if later:
            self.waiting.put(later)
            self._wake(min(r[0] for r in later))
        else:
            self.waiting.clear()
        yield self._take(key[0], ready)

    def _wake(self, us: int) -> None:
        self.handle.registerTimer(-(-us // 1000))

    def _take(self, run, ready: list[tuple]) -> pd.DataFrame:
        rows, best, ring = self.seen.get() if self.seen.exists() else (0, None, [])
        ring, out = list(ring), []
        for _, _, loss in ready:
            rows += 1
            ring = [*ring[max(0, len(ring) + 1 - self.log_every):], loss]
            mean = _mean(ring) if rows % self.log_every == 0 else None
            won = None
            if rows % self.eval_every == 0:
                number = loss is not None and not _is_nan(loss)
                won = number and loss < (math.inf if best is None else best)
                if number:
                    best = loss if best is None else min(best, loss)
            if rows % self.log_every == 0 or won is not None:
                val = None if won is None else loss
                out.append((run, rows, mean, val, won, _is_nan(mean), _is_nan(val)))
        if ready:
            self.seen.update((rows, best, ring))
        # pandas makes a NaN of a null and Arrow a null of either, hence the two marks
        return pd.DataFrame({f.name: pd.Series([r[i] for r in out], dtype=object) for i, f in enumerate(self.out)})

    def close(self) -> None:
        pass


def _is_nan(x: float | None) -> bool:
    return x is not None and math.isnan(x)


def _order(row: tuple) -> tuple:
    us, pos, loss = row
    # null, numbers, NaN: as Spark sorts them
    return us, pos, (0, 0.0) if loss is None else (2, 0.0) if _is_nan(loss) else (1, loss)


def live_metrics(log: DataFrame, log_every: int = 100, eval_every: int = 500, watermark: str = "10 minutes",
                 order: str | None = None) -> DataFrame:
    """A stream ``(run_id, loss, ts)`` as a stream of ``(run_id, step, avg_loss, val_loss,
    is_best)``, to be written in append mode.  ``step`` numbers a run's rows in time from 1.  A row comes at every
    ``log_every``-th step with the mean of the last ``log_every`` losses, and at every ``eval_every``-th with its loss
    and whether that is strictly lower than every earlier evaluation.  What a step does not have is null.

    ``order`` names a whole number that orders rows of one time.  The session's state store
    must be the RocksDB one when the query starts (``run_live`` sees to it)."""
    pos = F.coalesce(F.col(order).cast("long"), F.lit(0).cast("long")) if order else F.lit(0).cast("long")
    ts = F.col("ts").cast("timestamp")
    rows = (log.filter(F.col("ts").isNotNull())
               .select("run_id", F.col("loss").cast("double").alias("loss"), F.col("loss").isNull().alias("no_loss"),
                       ts.alias("ts"), F.unix_micros(ts).alias("us"), pos.alias("pos"))
               .withWatermark("ts", watermark))
    out = T.StructType([T.StructField("run_id", log.schema["run_id"].dataType), T.StructField("step", T.LongType()),
                        T.StructField("avg_loss", T.DoubleType()), T.StructField("val_loss", T.DoubleType()),
                        T.StructField("is_best", T.BooleanType()),
                        T.StructField("avg_nan", T.BooleanType()), T.StructField("val_nan", T.BooleanType())])
    taken = rows.groupBy("run_id").transformWithStateInPandas(
        _Run(out, log_every, eval_every), out, outputMode="Append", timeMode="EventTime")
    nan = F.lit(float("nan"))
    return taken.select("run_id", "step", F.when(F.col("avg_nan"), nan).otherwise(F.col("avg_loss")).alias("avg_loss"),
                        F.when(F.col("val_nan"), nan).otherwise(F.col("val_loss")).alias("val_loss"), "is_best")


def run_live(metrics: DataFrame, name: str = "live", root: str | None = None) -> str:
    """Run over all available input with states in RocksDB, which timers need; returns
    the sink path.  A start with the same root resumes."""
    spark = metrics.sparkSession
    before = spark.conf.get(PROVIDER)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        return run_available(metrics, name, "append", root=root)
    finally:
        spark.conf.set(PROVIDER, before)
