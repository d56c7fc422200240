"""The corpus pipeline: five stages over ``documents``, in this order.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which the
caller may write as Parquet and read again as the next stage's docs.  All but
the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from corpuslm.llm import decontam, linededup, minhash, pack, quality
from corpuslm.session import prepare

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    prepare(spark)
    return quality.keep_good(docs.select(*COLUMNS))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated runs of lines are deleted from the texts; n_chars follows the
    text.  A text that loses all lines stays as an empty one."""
    from pyspark.sql import functions as F

    prepare(spark)
    d = linededup.dedup_lines(docs)
    n = F.when(F.col("__n_cut") > 0, F.length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("n_chars"))
    return d.select(*[n.alias(c) if c == "n_chars" else F.col(c) for c in COLUMNS])


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    prepare(spark)
    return minhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents contaminated by benchmark items go."""
    prepare(spark)
    return decontam.remove_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents, packed."""
    import public_tokenizers

    prepare(spark)
    return pack.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("quality rules", quality_rules), ("line dedup", line_dedup), ("near dedup", near_dedup),
          ("decontamination", decontamination), ("packing", packing)]

# the tokenizer and the genetic algorithm are not expressible in SQL; tests compare with a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written to the
    shared folder of the session and read again."""
    shared = prepare(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared.rstrip('/')}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES[:-1]):
        path = f"{folder}/{k}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
