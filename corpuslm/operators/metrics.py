"""Training-run metrics (MET-*) over a log table ``(run_id, step, loss, ts)``
holding many runs.  Starts and last steps of runs are aggregates.  What looks back
over a run (rolling loss, running best) works on parts of ``SPAN`` steps of a run
(``order.running``, ``order.rolling_mean``), so a run that holds a third of all rows is
not one task's.  Rows of one run and step are taken by ascending loss.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslm.operators.dataset import lr_at
from corpuslm.operators.order import rolling_mean, running

RUN, STEP = "run_id", "step"


SPAN = 100_000  # steps of a run that one task looks at


def _part(span: int):
    return F.floor(F.col(STEP) / span).cast("long")


def _with_rolling(log: DataFrame, n: int, out: str, span: int) -> DataFrame:
    """The log with ``out``, the mean of a run's last ``n`` losses."""
    placed = running(log, [RUN], _part(span), [STEP, "loss"], F.lit(1), "sum", "__pos")
    return rolling_mean(placed, [RUN], "__pos", "loss", n, out, span).drop("__pos")


def _with_elapsed(rows: DataFrame, log: DataFrame) -> DataFrame:
    """Some rows of the log with ``elapsed``, the seconds since their run's first
    row, from exact microsecond counts.  A run's start is an aggregate, so a run
    that holds a third of all rows is not one task's."""
    us = F.unix_micros(F.col("ts").cast("timestamp"))
    start = log.groupBy(F.col(RUN).alias("__run")).agg(F.min(us).alias("__start"))
    return (rows.join(start, F.col(RUN).eqNullSafe(F.col("__run")))
                .withColumn("elapsed", (us - F.col("__start")) / 1e6).drop("__run", "__start"))


def rolling_loss(log: DataFrame, n: int = 100, span: int = SPAN) -> DataFrame:
    """MET-01: mean of the last ``n`` losses at every ``n``-th step."""
    return (_with_rolling(log, n, "avg_loss", span)
               .filter(F.col(STEP) % n == 0)
               .select(RUN, STEP, "avg_loss"))


def eval_points(log: DataFrame, every: int = 500) -> DataFrame:
    """MET-02: evaluation rows every ``every`` steps with perplexity."""
    return (log.filter(F.col(STEP) % every == 0)
               .select(RUN, STEP, F.col("loss").alias("val_loss"),
                       F.exp("loss").alias("perplexity")))


def mark_best(evals: DataFrame, loss_col: str = "val_loss", span: int = SPAN) -> DataFrame:
    """MET-03: strictly lower than every earlier evaluation of the run; a NaN
    never wins and is no earlier evaluation either."""
    number = F.when(~F.isnan(loss_col), F.col(loss_col))
    d = running(evals, [RUN], _part(span), [STEP, loss_col], number, "min", "__prev")
    best = number < F.coalesce("__prev", F.lit(float("inf")))
    return d.withColumn("is_best", F.coalesce(best, F.lit(False))).drop("__prev")


def best_checkpoint(evals: DataFrame, loss_col: str = "val_loss") -> DataFrame:
    """MET-04: per run the first step holding the lowest loss (one
    aggregate, partial per task).  A NaN is no loss; a run that has nothing
    else has no best checkpoint (nulls)."""
    key = F.when(~F.isnan(loss_col), F.struct(F.col(loss_col), F.col(STEP)))
    return evals.groupBy(RUN).agg(F.min(key).alias("b")).select(
        RUN, F.col("b." + STEP).alias("best_step"), F.col("b." + loss_col).alias("best_loss"))


def throughput(log: DataFrame, batch_size: int = 32, context: int = 256, every: int = 100) -> DataFrame:
    """MET-05: tokens processed so far per elapsed second, at logging steps;
    NULL while no time has passed."""
    tok = F.col(STEP) * batch_size * context
    return (_with_elapsed(log.filter(F.col(STEP) % every == 0), log)
               .select(RUN, STEP, "elapsed", F.try_divide(tok.cast("double"), F.col("elapsed")).alias("tokens_per_sec")))


def checkpoint_steps(log: DataFrame, every: int = 1500) -> DataFrame:
    """MET-06: steps that write a checkpoint: every ``every`` steps and the
    run's last step."""
    last = log.groupBy(F.col(RUN).alias("__run")).agg(F.max(STEP).alias("last"))
    d = log.join(last, F.col(RUN).eqNullSafe(F.col("__run")))
    return (d.filter((F.col(STEP) % every == 0) | (F.col(STEP) == F.col("last")))
             .select(RUN, STEP, (F.col(STEP) == F.col("last")).alias("is_final")))


def log_lines(log: DataFrame, log_every: int = 100, eval_every: int = 500, max_steps: int = 15000,
              warmup: int = 500, max_lr: float = 3e-4) -> DataFrame:
    """SNK-04 rows: ``step,train_loss,val_loss,lr,time,perplexity`` with the
    reference's fixed decimals (6, 6, 8, 2, 4), one line per evaluation."""
    d = _with_elapsed(_with_rolling(log, log_every, "train_loss", SPAN).filter(F.col(STEP) % eval_every == 0), log)
    lr = lr_at(F.col(STEP) - 1, max_steps, warmup, max_lr)
    line = _csv_line(F.col(STEP), F.col("train_loss"), F.col("loss"), lr, F.col("elapsed"), F.exp("loss"))
    return d.select(RUN, STEP, line.alias("line"))


@F.pandas_udf(T.StringType())
def _csv_line(step: pd.Series, train: pd.Series, val: pd.Series, lr: pd.Series,
              elapsed: pd.Series, ppl: pd.Series) -> pd.Series:
    """Python's ``%`` formatting rounds the exact binary value (Java's
    ``format_string`` rounds half-up on the shortest decimal); one call per
    evaluation row, a few per thousand training steps."""
    return pd.Series(["%d,%.6f,%.6f,%.8f,%.2f,%.4f" % row
                      for row in zip(step, train, val, lr, elapsed, ppl)])
