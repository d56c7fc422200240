"""Structured Streaming forms of the batch operators (STR-*).

Sources are file streams over parquet (``maxFilesPerTrigger``); checkpoints
and sink files go under a fresh folder in the session's checkpoint folder, or
under ``root``: a query started again with the same root resumes where it
stopped.  A micro-batch that is replayed overwrites its own files.  ``run_available`` drives a query with
``trigger(availableNow=True)``: everything present is processed, then the
query stops (no server, no port).
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslm.operators import bpe as B
from corpuslm.operators import clean as C
from corpuslm.operators.words import pretokenize
from corpuslm.session import ensure_checkpoint_dir


def _scratch(spark: SparkSession, name: str) -> str:
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, "streams", f"{name}-{uuid.uuid4().hex[:8]}")


def read_table_stream(spark: SparkSession, sf_dir: str, table: str, files_per_trigger: int = 1) -> DataFrame:
    """A parquet table as an unbounded source (schema taken from the files)."""
    path = f"{sf_dir.rstrip('/')}/{table}.parquet"
    schema = spark.read.parquet(path).schema
    # a stream's path must be a directory or a pattern; this pattern names the
    # table exactly, whether it is one file or a folder of part files
    return (spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
                 .parquet(path.removesuffix("t") + "[t]"))


def run_available(df: DataFrame, name: str, mode: str = "append", foreach_batch=None, root: str | None = None) -> str:
    """Run a streaming query over all available input; returns its sink path."""
    spark = df.sparkSession
    root = root or _scratch(spark, name)
    out = os.path.join(root, "out")
    w = df.writeStream.option("checkpointLocation", os.path.join(root, "chk")).outputMode(mode)
    if foreach_batch is not None:
        w = w.foreachBatch(lambda b, i: foreach_batch(b, i, out))
    else:
        w = w.format("parquet").option("path", out)
    q = w.trigger(availableNow=True).start()
    q.awaitTermination()
    return out


def clean_stream(docs: DataFrame, lowercase: bool = False) -> DataFrame:
    """STR-01: per-row cleaning; the batch operator is already row-local
    (arrays + one Arrow map node), so it runs unchanged on a stream."""
    return C.clean_corpus(docs, lowercase=lowercase).select("doc_id", "text")


def encode_stream_sink(merges, vocab):
    """STR-02: encode each micro-batch with a frozen tokenizer; the batch
    operator (distinct words, join back, ordered gather) runs per batch."""
    def sink(batch: DataFrame, batch_id: int, out: str):
        enc = B.encode_corpus(batch.select("doc_id", "text"), merges, vocab)
        enc.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
    return sink


def word_count_stream(docs: DataFrame) -> DataFrame:
    """STR-03: running word frequencies (stateful aggregation)."""
    return pretokenize(docs).groupBy("word").agg(F.count(F.lit(1)).alias("freq"))


def upsert_sink(keys: list[str]):
    """Write each micro-batch's updated rows to the folder of its batch id; the
    reader keeps the newest row per key (``latest``)."""
    def sink(batch: DataFrame, batch_id: int, out: str):
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")
    return sink


def latest(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    d = spark.read.parquet(path)
    cols = [c for c in d.columns if c not in keys and c != "batch"]
    agg = d.groupBy(*keys).agg(F.max_by(F.struct(*cols), "batch").alias("v"))
    return agg.select(*keys, *[F.col("v." + c).alias(c) for c in cols])


def run_metrics_stream(events: DataFrame, window: str = "1 hour", watermark: str = "10 minutes") -> DataFrame:
    """STR-04: tumbling mean loss and perplexity per run; rows later than the
    watermark are dropped."""
    ev = events.withColumn("ts", F.col("ts").cast("timestamp"))  # event time must be TIMESTAMP
    return (ev.withWatermark("ts", watermark)
                  .groupBy(F.window("ts", window).alias("w"), F.col("user_id").alias("run_id"))
                  .agg(F.avg(F.col("value") / 100.0).alias("mean_loss"), F.count(F.lit(1)).alias("n"))
                  .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"), "run_id", "mean_loss",
                          F.exp("mean_loss").alias("perplexity"), "n"))
