"""Pre-tokenisation and word statistics (TOK-01..04)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslm.functions.text import WORD_PATTERN


def words_of(text: Column) -> Column:
    """``re.findall(r'\\w+|[^\\w\\s]', text.lower())`` as an array."""
    return F.regexp_extract_all(F.lower(text), F.lit(WORD_PATTERN), 0)


def pretokenize(df: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """TOK-01: one row per word occurrence ``(key, pos, word)``, pos from 0."""
    return df.select(key, F.posexplode(words_of(F.col(text_col))).alias("pos", "word"))


def word_freq(words: DataFrame, key: str = "doc_id") -> DataFrame:
    """TOK-02: count per word plus where it was first seen.

    ``min(struct(doc, pos))`` is associative, so both the count and the
    first-seen position are combined map-side before the shuffle: a word
    that holds a third of all occurrences costs one row per task.
    """
    first = F.min(F.struct(F.col(key).alias("doc"), F.col("pos").alias("pos")))
    return (words.groupBy("word")
                 .agg(F.count(F.lit(1)).alias("freq"), first.alias("first"))
                 .select("word", "freq",
                         F.col("first.doc").alias("first_doc"),
                         F.col("first.pos").cast("bigint").alias("first_pos")))


WORDS_AT_ONCE = 1 << 18  # words of a slice that an Arrow node encodes together
COUNTED_AT_ONCE = 1 << 21  # and counts together


def word_slices(batch: pa.RecordBatch, words: int = WORDS_AT_ONCE, at: int = 1) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Slices of a batch with about ``words`` words in its list column ``at``
    (one row at least), each with the lengths of its lists; a null list is empty."""
    lengths = pc.fill_null(pc.list_value_length(batch.column(at)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lengths)
    i = 0
    while i < len(lengths):
        before = ends[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(ends, before + words, "right")))
        yield batch.slice(i, j - i), lengths[i:j]
        i = j


def word_table(df: DataFrame, key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """TOK-01 + TOK-02 in one plan, the input of BPE training.

    The rows of ``word_freq`` without a row per occurrence: an Arrow node counts the
    words of a slice of documents and finds where each comes first, so what is
    sorted and shuffled is a row per word and slice."""
    if not isinstance(df.schema[key].dataType, (T.IntegralType, T.StringType)):
        return word_freq(pretokenize(df, key, text_col), key)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for part, lengths in word_slices(b, COUNTED_AT_ONCE):
                words = part.column(1).flatten().dictionary_encode()
                at, n = words.indices.to_numpy(zero_copy_only=False), len(words.dictionary)
                # rows of equal keys share a rank, so that the least place in any of them is found
                rank = pc.rank(part.column(0), "ascending", null_placement="at_start", tiebreaker="dense").to_numpy().astype(np.int64)
                pos = np.arange(len(at)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
                first = np.full(n, np.iinfo(np.int64).max)
                np.minimum.at(first, at, (np.repeat(rank, lengths) << 32) + pos)
                row = np.zeros(int(rank.max(initial=0)) + 1, np.int64)
                row[rank] = np.arange(len(rank))
                yield pa.RecordBatch.from_arrays(
                    [words.dictionary, pa.array(np.bincount(at, minlength=n)), part.column(0).take(pa.array(row[first >> 32])),
                     pa.array(first & 0xFFFFFFFF)], names=["word", "freq", "doc", "pos"])

    schema = T.StructType([T.StructField("word", T.StringType()), T.StructField("freq", T.LongType()),
                           T.StructField("doc", df.schema[key].dataType), T.StructField("pos", T.LongType())])
    counted = df.select(key, words_of(F.col(text_col)).alias("words")).mapInArrow(count, schema)
    return (counted.groupBy("word").agg(F.sum("freq").alias("freq"), F.min(F.struct("doc", "pos")).alias("first"))
                   .select("word", "freq", F.col("first.doc").alias("first_doc"), F.col("first.pos").alias("first_pos")))


def alphabet(freqs: DataFrame) -> DataFrame:
    """TOK-03: distinct characters of all words, sorted by code point,
    ids 0..n-1 (never truncated).

    Characters are deduplicated per word first (``array_distinct``) and then
    globally; the distinct set is small (bounded by the Unicode repertoire of
    the corpus), so numbering it with one ordered window is safe.  Spark sorts
    strings by UTF-8 bytes, which is code-point order.
    """
    chars = (freqs.select(F.explode(F.array_distinct(F.split("word", "", -1))).alias("token"))
                  .filter(F.length("token") > 0)
                  .distinct())
    from pyspark.sql import Window
    w = Window.orderBy("token")
    return chars.select("token", (F.row_number().over(w) - 1).cast("bigint").alias("id"))


def init_symbols(word: Column) -> Column:
    """TOK-04: a word as its characters."""
    return F.filter(F.split(word, "", -1), lambda s: F.length(s) > 0)
