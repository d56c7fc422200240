"""Inputs derived from the driver tables, built alike in Spark and in SQL.

The oracle runs in DuckDB, which only knows the driver tables, so every view
here also has a SQL twin (a CTE) in :mod:`corpuslm.plans.oracles`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslm.operators.order import bucket_of, running


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Give a scan at least one partition per core.

    The test tables are one parquet row group each, so the scan is one task;
    a large input already arrives in thousands of splits and is left alone
    (no shuffle is added at scale)."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() < cores:
        return df.repartition(cores)
    return df


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text"))


def wiki_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document wrapped the way extracted dump files look: a ``<doc>``
    tag, the title twice (once after a blank line), a URL line, blank lines,
    double spaces after full stops, a line of spaces, a short line and the
    closing tag."""
    return wiki_of(documents(spark, sf_dir))


def wiki_of(d: DataFrame) -> DataFrame:
    """The ``wiki_raw`` projection of any ``(doc_id, text)`` frame (batch or
    stream)."""
    i = F.col("doc_id").cast("string")
    title = F.concat(F.lit("Title number "), i)
    text = F.concat(
        F.lit('<doc id="'), i, F.lit('" url="https://example.org/?curid='), i,
        F.lit('" title="'), title, F.lit('">\n'),
        title, F.lit("\n\n"), title, F.lit("\n"),
        F.lit("https://example.org/"), i, F.lit("\n\n\n"),
        F.replace(F.col("text"), F.lit(". "), F.lit(".  ")),
        F.lit("\n   \nshort\n</doc>"),
    )
    return d.select("doc_id", text.alias("text"))


def tagged_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with tags that begin in one and end in a later one, or nowhere."""
    d = documents(spark, sf_dir)
    opened = F.concat("text", F.lit('\n<doc id="'), F.col("doc_id").cast("string"))
    closed = F.concat(F.lit('" title="t">'), F.col("text"))
    return d.select("doc_id", F.when(F.col("doc_id") % 7 == 3, opened).when(F.col("doc_id") % 7 == 5, closed)
                    .when(F.col("doc_id") % 11 == 0, F.concat("text", F.lit(" <doc"))).otherwise(F.col("text")).alias("text"))


def noisy_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with characters the cleaner must remove or normalise:
    BEL and soft hyphen (category C), no-break space (NFKD -> space)."""
    d = documents(spark, sf_dir)
    t = F.replace(F.col("text"), F.lit("x"), F.lit("x\u0007"))
    t = F.replace(t, F.lit("qu"), F.lit("q\u00adu"))
    t = F.replace(t, F.lit(", "), F.lit(",\u00a0"))
    return d.select("doc_id", t.alias("text"))


def prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return (c.filter((F.col("turn") == 0) & (F.col("role") == "user"))
             .select(F.col("conv_id").alias("prompt_id"), "text"))


def train_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training runs from the event stream: one run per user, steps in time
    order, loss = value / 100.  A run is numbered in parts of the time, so that
    one of a third of all events is not one task's."""
    e = table(spark, sf_dir, "events")
    e = e.withColumn("us", F.unix_micros(F.col("ts").cast("timestamp")))
    e = running(e, ["user_id"], bucket_of(e, "us"), ["ts", "event_id"], F.lit(1), "sum", "before")
    return e.select(
        F.col("user_id").alias("run_id"),
        (F.col("before") + 1).cast("bigint").alias("step"),
        (F.col("value") / 100.0).alias("loss"),
        "ts",
    )
