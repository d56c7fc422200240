"""The queries of this subpackage: thin digests of its operators."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslm.llm import (chat, decontam, extract, linededup, minhash, negatives, neighbours, pack, pii, quality, shards,
                          trie, urls)
from corpuslm.session import prepare

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(fn: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return fn(spark, sf_dir)
    run.__name__, run.__doc__ = fn.__name__, fn.__doc__
    QUERIES[fn.__name__] = run
    return run


@query
def op4_distribution_divergence(spark, sf):
    """Every document's base counts and verdict."""
    return quality.report(table(spark, sf, "documents"))


@query
def op8_prefix_set_join(spark, sf):
    """Every document's words hit by benchmark windows."""
    return decontam.report(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@query
def op10_winnowed_lines(spark, sf):
    """Every document's text without repeated runs of lines."""
    d = linededup.dedup_lines(table(spark, sf, "documents").select("doc_id", "text"))
    return d.select("doc_id", "text", F.col("__n_lines").alias("n_lines"), F.col("__n_cut").alias("n_cut"))


@query
def op5_grouping_genetic(spark, sf):
    """Every document's pieces packed into sequences."""
    import public_tokenizers

    return pack.pack(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op6_prob_minhash(spark, sf):
    """Every document's near-duplicate class."""
    return minhash.classes(table(spark, sf, "documents"))


@query
def op2_virtual_slots(spark, sf):
    """Every document's shard, read back from the shards' files.  Records, files and the map of
    slots lie in the session's shared folder."""
    path = f"{prepare(spark).rstrip('/')}/shards-{uuid.uuid4().hex}"
    version = shards.write_shards(table(spark, sf, "documents"), path)
    return shards.placed(spark, path, version).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "vslot", F.lit(version).alias("map_version"))


@query
def op9_personal_data(spark, sf):
    """Every document's personal data."""
    return pii.report(table(spark, sf, "documents"))


@query
def op1_snapshot_collapse(spark, sf):
    """Every maximal conversation, rendered."""
    return chat.format_chats(table(spark, sf, "conversations"))


@query
def op3_path_templates(spark, sf):
    """Every page's verdict."""
    return urls.verdicts(table(spark, sf, "pages"))


@query
def op7_flat_blocks(spark, sf):
    """Every page's main text."""
    return extract.extract(table(spark, sf, "pages"))


@query
def op11_adaptive_scan(spark, sf):
    """The 20 nearest vectors found of every twentieth vector."""
    return neighbours.search(table(spark, sf, "embeddings")).select("query_id", "rank", "vec_id", "score")


@query
def op12_prefix_trie(spark, sf):
    """Every node of the trie of the rebuilt conversations."""
    return trie.prefix_trie(table(spark, sf, "conversations")).drop("k1", "k2")


@query
def op13_strassen(spark, sf):
    """Hard negatives of every hundredth vector."""
    return negatives.mine(table(spark, sf, "embeddings")).drop("place")
