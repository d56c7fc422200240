"""Byte-pair-encoding vocabulary: training, vocab ids, encode, decode
(TOK-04..17).

Training state is one row per *distinct* word of two or more characters,
``(word, freq, first_doc, first_pos, sym)``, where ``sym`` spells the
current symbols as `` a  b  c `` (every symbol wrapped in spaces; words
never contain white space).  Applying a merge ``(l, r)`` is then the native
``replace(' l  r ', ' lr ')``, which scans left to right without overlap,
exactly like the reference loop.

Adjacent pairs are counted once, weighted by word frequency, and then kept up to
date by the changes of each merge (``pair_deltas``); a merge is always the best
pair, (count desc, first seen), of the exact counts before it.  Training stops
below ``min_frequency``, without pairs, or when the vocabulary is full.
"""

from __future__ import annotations

import heapq
import uuid
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslm.operators.order import prefix_sum
from corpuslm.operators.pair_deltas import POS_BITS, SHORT, PairTable, count_pairs, cut_word, recount
from corpuslm.operators.word_blocks import advance, as_blocks
from corpuslm.operators.word_ids import WordIds
from corpuslm.operators.words import alphabet, word_slices, word_table, words_of
from corpuslm.session import prepare, remove


# ------------------------------------------------------------------ state
def wrap_symbols(word: Column) -> Column:
    """TOK-04: characters of a word as `` c1  c2 ... `` (one code point each)."""
    return F.regexp_replace(word, "(.)", " $1 ")


def symbols(sym: Column) -> Column:
    return F.split(F.trim(sym), "  ", -1)


WORDS_PER_PARTITION = 200_000
APPLY_AFTER = 64  # merges after which the blocks of words are made anew
WRITE_AFTER = 8  # times after which they are written as well, so that plans and lineage stay short
MERGES_AT_ONCE, AHEAD = 64, 96  # merges guessed for a round at most, pairs of the ranking they are guessed from
FEW_MERGES, CHEAP_ROUND = 8, 25_000  # where a round looks at more words a core, it guesses this many or twice what held


def initial_state(freqs: DataFrame) -> DataFrame:
    """Words that can hold a pair (two or more characters), each with its
    first-seen rank ``wrank`` (0 = first word of the text).  The rank comes
    from a two-level prefix sum over ``(first_doc, first_pos)``, so no single
    task orders all words."""
    multi = freqs.filter(F.length("word") >= 2)
    ranked = prefix_sum(multi.select("word", "freq", "first_doc", "first_pos", F.lit(1).alias("one")),
                        "first_doc", "one", "wrank", order=["first_doc", "first_pos"])
    # the ranking leaves one partition per bucket; spread the state over the
    # cluster once (hash of word), every round then runs fully parallel
    parts = max(freqs.sparkSession.sparkContext.defaultParallelism,
                -(-multi.count() // WORDS_PER_PARTITION))
    return (ranked.select("word", "freq", "wrank", wrap_symbols(F.col("word")).alias("sym"))
                  .repartition(parts, "word"))


def pair_counts(state: DataFrame) -> DataFrame:
    """TOK-05: ``(left, right, n, first)``; ``first`` packs (word rank,
    symbol index) of the earliest occurrence into one long, so the
    aggregate is a codegen'd hash aggregate of primitives."""
    s = symbols(F.col("sym"))
    n = F.size(s) - 1
    zipped = F.arrays_zip(F.slice(s, 1, n).alias("left"), F.slice(s, 2, n).alias("right"))
    ex = state.select("freq", "wrank", F.posexplode(zipped).alias("j", "p"))
    first = F.when(F.col("j") < (1 << POS_BITS), F.shiftleft(F.col("wrank"), POS_BITS) + F.col("j")).otherwise(
        F.raise_error(F.lit(f"a word of more than {1 << POS_BITS} characters cannot be ranked")))
    return ex.groupBy(F.col("p.left").alias("left"), F.col("p.right").alias("right")).agg(
        F.sum("freq").alias("n"), F.min(first).alias("first"))


def ranked_pairs(pairs: DataFrame) -> DataFrame:
    """TOK-06 order: highest count, ties to the pair seen first."""
    return pairs.orderBy(F.desc("n"), F.asc("first"))


def apply_merges(sym: Column, merges: list[tuple[str, str]]) -> Column:
    """TOK-07: apply merges in order, each left to right without overlap."""
    for left, right in merges:
        sym = F.replace(sym, F.lit(f" {left}  {right} "), F.lit(f" {left}{right} "))
    return sym


# ------------------------------------------------------------------ training
@dataclass
class BPEModel:
    """Alphabet + ordered merges; every list is bounded by ``vocab_size``."""
    alphabet: list[str]
    merges: list[tuple[str, str]]
    rounds: int = 0
    stop_reason: str = "vocab_full"
    rows_touched: list[int] = field(default_factory=list, repr=False)  # words looked at, by job

    @property
    def vocab(self) -> dict[str, int]:
        v = {c: i for i, c in enumerate(self.alphabet)}
        for rank, (l, r) in enumerate(self.merges):
            v[l + r] = len(self.alphabet) + rank
        return v

    def vocab_df(self, spark: SparkSession) -> DataFrame:
        """TOK-10: ``(token, id)``."""
        rows = sorted(self.vocab.items(), key=lambda kv: kv[1])
        return spark.createDataFrame(rows, "token string, id bigint")

    def merges_df(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(
            [(i, l, r) for i, (l, r) in enumerate(self.merges)], "rank bigint, left string, right string")


def _loop_session(spark: SparkSession, partitions: int) -> SparkSession:
    """A session of its own for the many small jobs of the merge loop: the pair
    aggregate is combined map-side, so AQE's re-planning has nothing to do there.
    The caller's settings stay as they are."""
    loop = spark.newSession()
    loop.conf.set("spark.sql.adaptive.enabled", "false")
    loop.conf.set("spark.sql.shuffle.partitions", str(max(1, partitions // 4)))
    return loop


def train_bpe(freqs: DataFrame, vocab_size: int = 5000, min_frequency: int = 2,
              max_merges_per_round: int | None = None, held_pairs: int = 1_000_000) -> BPEModel:
    """TOK-08/09: learn merges from a word-frequency table (TOK-02).

    The distinct words are written as blocks to the shared folder; a round
    looks at the words that hold a chosen pair and sums up how pair counts change
    (see ``pair_deltas``).  After ``APPLY_AFTER`` merges new blocks are made from the old ones, and
    each ``WRITE_AFTER`` times they are written in place of the first, since tasks with a lineage of
    some 60 such steps overflow the stack.  The driver holds the most frequent ``held_pairs`` pairs (twice that
    at most) and the merges.
    ``max_merges_per_round=1`` gives plain one-at-a-time training."""
    spark = freqs.sparkSession
    shared = prepare(spark)
    alpha = [r["token"] for r in alphabet(freqs).orderBy("id").collect()]
    vocab, merges = set(alpha), []
    path = first = f"{shared.rstrip('/')}/bpe-words-{uuid.uuid4().hex}"
    as_blocks(initial_state(freqs)).write.parquet(path)
    loop = _loop_session(spark, spark.sparkContext.defaultParallelism)
    words, older, links = loop.read.parquet(path).persist(), None, 0
    table = PairTable(held_pairs)
    table.fill(count_pairs(words, merges))
    applied = 0
    rounds, rows_touched, overlaps, known, stop = 0, [], {}, set(), "vocab_full"
    reach, cheap = MERGES_AT_ONCE, CHEAP_ROUND * spark.sparkContext.defaultParallelism
    while len(vocab) < vocab_size:
        best, why = table.best(min_frequency)
        if why == "refill":
            table.fill(count_pairs(words, merges))
            while table.floor and table.floor == max(table.n.values(), default=0):
                table.limit *= 2  # more pairs than it holds share the highest count
                table.fill(count_pairs(words, merges))
            continue
        if best is None and why != "ask":
            stop = why  # TOK-09
            break
        budget = min(vocab_size - len(vocab), max_merges_per_round or reach)
        ahead, before = reach * AHEAD // MERGES_AT_ONCE, len(merges)
        batch = table.guess(overlaps, budget, ahead) if best else []
        asked = {e[2] for e in table.top(ahead)} & table.late
        found = defaultdict(list)
        for r in recount(words, merges, batch, asked, table.near(ahead, known)).collect():
            found[r["step"]].append(r)
        overlaps |= {(r["left"], r["mid"], r["right"]): r["n"] for r in found[-2]}
        overlaps = {k: n for k, n in overlaps.items() if k[:2] in table.n and k[1:] in table.n}
        rows_touched.append(found[-3][0]["n"] if found[-3] else 0)
        if older is not None:  # the newer blocks are there now
            older.unpersist()
            older = None
        rounds += bool(batch)
        for step, (left, right) in enumerate(batch):
            if table.best(min_frequency)[0] != (left, right):
                break
            if left + right in vocab:  # cannot happen for this trainer; guard the proof
                raise AssertionError(f"merge re-creates existing token {left + right!r}")
            table.apply(found[step], {left + right})
            merges.append((left, right))
            vocab.add(left + right)
        else:
            table.apply(found[-1], set())  # first places after the whole batch
        if len(merges) - applied >= APPLY_AFTER:
            older, words, applied, links = words, advance(words, list(merges)), len(merges), links + 1
            if links == WRITE_AFTER:
                old, path, links = path, f"{first}-{len(merges)}", 0
                words.write.parquet(path)
                remove(spark, old)
                words = loop.read.parquet(path)
            words = words.persist()
        if batch:  # most words hold a text of the first merges, whose guesses seldom hold
            reach = MERGES_AT_ONCE if rows_touched[-1] <= cheap else min(MERGES_AT_ONCE, max(FEW_MERGES, 2 * (len(merges) - before)))
    for blocks in (words, older):
        if blocks is not None:
            blocks.unpersist()
    remove(spark, path)
    return BPEModel(alpha, merges, rounds, stop, rows_touched)


def tokenizer_info(model: BPEModel, spark: SparkSession) -> DataFrame:
    """TOK-16: vocabulary size (recounted, as the loader does) and merges."""
    return spark.createDataFrame([(len(model.vocab), len(model.merges))],
                                 "vocab_size bigint, num_merges bigint")


def token_report(tokens: DataFrame, docs: DataFrame, text_col: str = "text",
                 ids_col: str = "ids") -> DataFrame:
    """TOK-15: tokens, size at 2 bytes per token (uint16), characters per
    token; NULL instead of a division by zero for an empty corpus."""
    t = tokens.agg(F.coalesce(F.sum(F.size(ids_col)), F.lit(0)).cast("long").alias("tokens"))
    c = docs.agg(F.coalesce(F.sum(F.length(text_col)), F.lit(0)).cast("long").alias("chars"))
    r = t.crossJoin(c)  # two one-row frames
    return r.select("tokens", F.round(F.col("tokens") * 2 / F.lit(1048576.0), 6).alias("size_mb"),
                    "chars", F.round(F.try_divide(F.col("chars"), F.col("tokens")), 6).alias("chars_per_token"))


def oov_report(docs: DataFrame, vocab: dict[str, int], key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """TOK-13: ``(token, n)``, the characters of pre-tokenized words that the
    vocabulary (bounded by vocab_size) lacks, and how often they occur."""
    known = F.array(*[F.lit(c) for c in vocab if len(c) == 1]).cast("array<string>")
    chars = F.split(F.array_join(words_of(F.col(text_col)), ""), "", -1)
    ex = docs.select(F.explode(F.filter(chars, lambda c: (c != "") & ~F.array_contains(known, c))).alias("token"))
    return ex.groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def check_vocab(tokens: DataFrame, vocab_size: int, ids_col: str = "ids") -> DataFrame:
    """TOK-17: ids at or above the vocabulary size (possible with hand-edited
    files) and the largest id, in one aggregate."""
    ex = tokens.select(F.explode(ids_col).alias("id"))
    return ex.agg(F.lit(vocab_size).cast("long").alias("vocab_size"),
                  F.max("id").cast("long").alias("max_id"),
                  F.count(F.when(F.col("id") >= vocab_size, 1)).cast("long").alias("out_of_range"))


# ------------------------------------------------------------------ encode
def encode_word_py(word: str, ranks: dict) -> list[str]:
    """Tokens of one word: of all neighbours the pair of lowest rank, leftmost
    first, is joined until none has a rank.  Pieces form a linked list and
    candidate pairs a heap, so a word of n characters takes n log n steps; for a short
    word plain scans are faster."""
    if len(word) <= SHORT:
        return cut_word(word, ranks)
    piece = list(word)
    after, before = list(range(1, len(piece) + 1)), list(range(-1, len(piece) - 1))
    heap = []

    def offer(i):
        j = after[i] if i >= 0 else len(piece)
        if j < len(piece) and (rank := ranks.get((piece[i], piece[j]))) is not None:
            heapq.heappush(heap, (rank, i, piece[i], piece[j]))

    for i in range(len(piece)):
        offer(i)
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if piece[i] != left or j >= len(piece) or piece[j] != right:
            continue  # one of the two has been joined meanwhile
        piece[i], piece[j], after[i] = left + right, "", after[j]
        if after[j] < len(piece):
            before[after[j]] = i
        offer(before[i])
        offer(i)
    return [p for p in piece if p]


def _ids(tokens: list[str], vocab: dict[str, int]) -> list[int]:
    """Ids of tokens; an unknown one gives its first character's, if known."""
    return [vocab[t] if t in vocab else vocab[t[0]] for t in tokens if t in vocab or (t and t[0] in vocab)]


def encode_words(words: DataFrame, merges: list[tuple[str, str]], vocab: dict[str, int],
                 word_col: str = "word") -> DataFrame:
    """TOK-11/13 over a table of *distinct* words: ``(word, tokens, ids)``.

    The merge table is bounded by the vocabulary size and travels with the
    task closure; a pair listed twice keeps its last rank."""
    ranks = {}
    for i, (l, r) in enumerate(merges):
        ranks[(l, r)] = i

    schema = T.StructType([T.StructField("tokens", T.ArrayType(T.StringType())),
                           T.StructField("ids", T.ArrayType(T.IntegerType()))])

    @F.pandas_udf(schema)
    def enc(ws: pd.Series) -> pd.DataFrame:
        toks = [encode_word_py(w, ranks) for w in ws]
        return pd.DataFrame({"tokens": toks, "ids": [_ids(ts, vocab) for ts in toks]})

    e = words.select(word_col, enc(F.col(word_col)).alias("e"))
    return e.select(word_col, F.col("e.tokens").alias("tokens"), F.col("e.ids").alias("ids"))


def encode_corpus(docs: DataFrame, merges: list[tuple[str, str]], vocab: dict[str, int],
                  key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """TOK-12: ``(key, ids)`` for every document row, without any shuffle.

    Words are cut by Spark; one Arrow node looks at slices of about ``WORDS_AT_ONCE``
    words and encodes the distinct ones of a slice together (``word_ids``).  The
    merge table is bounded by the vocabulary size and travels with the task
    closure.  A null text has no ids."""
    ranks = {pair: i for i, pair in enumerate(merges)}

    def enc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = WordIds(merges, vocab, lambda word: _ids(encode_word_py(word, ranks), vocab))
        for b in batches:
            for part, lengths in word_slices(b):
                words = part.column(1).flatten().dictionary_encode()
                at = words.indices.to_numpy(zero_copy_only=False)
                size, each = ids_of(words.dictionary)
                n = size[at]
                ends = np.concatenate(([0], np.cumsum(n)))
                # the ids of a word lie together; an occurrence takes them from there
                place = np.arange(ends[-1]) + np.repeat((np.cumsum(size) - size)[at] - ends[:-1], n)
                cuts = ends[np.concatenate(([0], np.cumsum(lengths)))].astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(cuts, each[place])], names=[key, "ids"])

    # a map node, not a function: the optimizer would copy an expression into join keys
    schema = T.StructType([docs.schema[key], T.StructField("ids", T.ArrayType(T.IntegerType()))])
    return docs.select(key, words_of(F.col(text_col)).alias("words")).mapInArrow(enc, schema)


def encode_occurrences(docs: DataFrame, merges: list[tuple[str, str]], vocab: dict[str, int],
                       key: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(key, pos, word, ids)``: every word occurrence with the ids of its
    word (NULL ``word``/``ids`` for a document without words).  Distinct words
    are encoded once and joined back; nothing is grouped per document."""
    occ = docs.select(key, F.posexplode_outer(words_of(F.col(text_col))).alias("pos", "word"))
    distinct = occ.filter(F.col("word").isNotNull()).select("word").distinct()
    enc = encode_words(distinct, merges, vocab).select("word", "ids")
    return occ.join(enc, "word", "left")


def decode(tokens: DataFrame, vocab: DataFrame, key: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """TOK-14: concatenate token strings; unknown ids give ``''``; spaces are
    not restored.  The vocabulary (bounded by vocab_size) goes to all tasks as
    one row, an array with the token of id i at place i; nothing is shuffled."""
    top = vocab.agg(F.max("id")).first()[0]
    ids = vocab.sparkSession.range(0 if top is None else top + 1)
    named = ids.join(F.broadcast(vocab.select("id", "token")), "id", "left")
    listed = named.agg(F.transform(F.array_sort(F.collect_list(F.struct("id", F.coalesce("token", F.lit("")).alias("t")))),
                                   lambda s: s["t"]).alias("__tokens"))
    place = lambda i: F.get("__tokens", i)
    text = F.array_join(F.transform(F.coalesce(ids_col, F.array().cast("array<int>")),
                                    lambda i: F.when(i >= 0, F.coalesce(place(i), F.lit(""))).otherwise("")), "")
    return tokens.crossJoin(F.broadcast(listed)).select(key, text.alias("text"))  # one row


def train_from_text(docs: DataFrame, vocab_size: int = 5000, min_frequency: int = 2,
                    key: str = "doc_id", text_col: str = "text", **kw) -> BPEModel:
    """TOK-01 + TOK-02 + TOK-08 from a text table."""
    return train_bpe(word_table(docs, key, text_col), vocab_size, min_frequency, **kw)
