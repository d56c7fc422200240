"""Query registry: one callable ``(spark, sf_dir) -> DataFrame`` per
operator of the inventory.  Every query reads the driver tables (or views
Spark derives from them) in full."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslm.operators import bpe as B
from corpuslm.operators import clean as C
from corpuslm.operators import corpus_clean as CC
from corpuslm.operators import dataset as D
from corpuslm.operators import metrics as M
from corpuslm.operators import ngram as N
from corpuslm.operators import segments as SEG
from corpuslm.operators import split as S
from corpuslm.operators import words as W
from corpuslm.plans import views as V
from corpuslm.session import prepare, release, stored

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


_MEMO: dict = {}


def memo(fn):
    """Share an expensive intermediate (trained tokenizer, encoded corpus,
    fitted model) between the queries of one Spark application.  Everything
    memoised is written to the session's checkpoint folder, so a lost
    executor costs a re-read, not a recompute."""
    def run(spark, sf, *a):
        k = (fn.__name__, spark.sparkContext.applicationId, sf, a)
        if k not in _MEMO:
            _MEMO[k] = fn(spark, sf, *a)
        return _MEMO[k]
    run.__name__ = fn.__name__
    return run


def query(name: str):
    def deco(fn: Query) -> Query:
        def run(spark, sf):
            # checkpoints go to spark.checkpoint.dir (a private folder only
            # for a local session that has none)
            prepare(spark)
            return fn(spark, sf)
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = run
        return run
    return deco


def _text_query(view, fn):
    def run(spark, sf):
        return view(spark, sf).select("doc_id", fn(F.col("text")).alias("text"))
    return run


# ------------------------------------------------------------------ cleaning
query("cln_01")(_text_query(V.wiki_raw, C.strip_doc_open))
query("cln_02")(_text_query(V.wiki_raw, C.strip_doc_close))
query("cln_03")(_text_query(V.wiki_raw, lambda t: C.blank_url_lines(C.strip_doc_close(C.strip_doc_open(t)))))
query("cln_04")(_text_query(V.wiki_raw, lambda t: C.squeeze_blank(C.blank_url_lines(C.strip_doc_close(C.strip_doc_open(t))))))


@query("cln_05")
def cln_05(spark, sf):
    lines = C.explode_lines(V.wiki_raw(spark, sf))
    return lines.select("doc_id", F.col("line_no").cast("bigint").alias("line_no"), "line")


query("cln_06")(_text_query(V.wiki_raw, C.clean_before_nfkd))
query("cln_07")(_text_query(V.documents, C.nfkd))
query("cln_08")(_text_query(V.noisy_docs, C.nfkd))
query("cln_09")(_text_query(V.wiki_raw, C.squeeze_spaces))
query("cln_10")(_text_query(V.wiki_raw, lambda t: C.squeeze_newlines(C.squeeze_blank(t))))
query("cln_11")(_text_query(V.wiki_raw, lambda t: C.drop_short_lines(C.clean_before_nfkd(t))))
query("cln_12")(_text_query(V.documents, C.lower))
query("cln_13")(_text_query(V.wiki_raw, lambda t: C.assemble(C.drop_short_lines(C.clean_before_nfkd(t)))))


@query("cln_14")
def cln_14(spark, sf):
    return C.clean_corpus(V.wiki_raw(spark, sf)).select("doc_id", "text")


@query("cln_14_noisy")
def cln_14_noisy(spark, sf):
    return C.clean_corpus(V.noisy_docs(spark, sf), lowercase=True).select("doc_id", "text")


@query("cln_15")
def cln_15(spark, sf):
    return C.artifact_counts(V.wiki_raw(spark, sf))


@query("cln_16")
def cln_16(spark, sf):
    raw = V.wiki_raw(spark, sf)
    return C.clean_report(raw, C.clean_corpus(raw))


@query("cln_17")
def cln_17(spark, sf):
    return C.sample_lines(C.clean_corpus(V.wiki_raw(spark, sf)))


@memo
def joined_wiki(spark, sf):
    """``wiki_raw`` cleaned in corpus scope, materialised once."""
    return CC.clean_joined(V.wiki_raw(spark, sf)).checkpoint()


@query("cln_01_corpus")
def cln_01_corpus(spark, sf):
    """The lines of the corpus without tags, those over several documents included."""
    return CC.corpus_lines(CC.strip_open_joined(V.tagged_docs(spark, sf).checkpoint()).checkpoint())


@query("cln_14_corpus")
def cln_14_corpus(spark, sf):
    """The lines of the corpus cleaned as one text."""
    return CC.corpus_lines(joined_wiki(spark, sf))


SEGMENT = 256  # code points of a segment in the checked queries, so that most texts are cut


@query("cln_14_segments")
def cln_14_segments(spark, sf):
    """The same lines, with texts cut into segments of whole lines first."""
    cut = SEG.line_segments(V.wiki_raw(spark, sf), size=SEGMENT)
    return CC.corpus_lines(CC.clean_joined(cut, key="segment").checkpoint(), key="segment")


# ------------------------------------------------------------------ split
@memo
def cleaned_wiki(spark, sf):
    """Cleaned ``wiki_raw``, materialised once (reliable checkpoint) because
    the split reads it several times and cleaning runs Python for NFKD."""
    return C.clean_corpus(V.wiki_raw(spark, sf)).select("doc_id", "text").checkpoint()


@query("spl_01")
def spl_01(spark, sf):
    return S.with_offsets(cleaned_wiki(spark, sf))


@query("spl_02")
def spl_02(spark, sf):
    docs = cleaned_wiki(spark, sf)
    sp = S.split_point(docs, S.with_doc_offsets(docs))
    return spark.createDataFrame(
        [(sp["total_chars"], sp["split_idx"], sp["split_point"])],
        "total_chars bigint, split_idx bigint, split_point bigint")


@query("spl_03")
def spl_03(spark, sf):
    return S.split_corpus(cleaned_wiki(spark, sf))


@query("spl_04")
def spl_04(spark, sf):
    return S.split_report(S.split_corpus(cleaned_wiki(spark, sf)))


@query("spl_04_corpus")
def spl_04_corpus(spark, sf):
    return S.split_report(S.split_corpus(joined_wiki(spark, sf)))


# ------------------------------------------------------------------ words
@query("tok_01")
def tok_01(spark, sf):
    w = W.pretokenize(V.documents(spark, sf))
    return w.select("doc_id", F.col("pos").cast("bigint").alias("pos"), "word")


@query("tok_02")
def tok_02(spark, sf):
    return W.word_table(V.documents(spark, sf))


@query("tok_03")
def tok_03(spark, sf):
    return W.alphabet(W.word_table(V.documents(spark, sf)))


# ------------------------------------------------------------------ BPE
EXTRA_MERGES = 8  # merges beyond the alphabet in the checked training runs


@query("tok_04")
def tok_04(spark, sf):
    f = W.word_table(V.documents(spark, sf))
    return f.select("word", W.init_symbols(F.col("word")).alias("symbols"))


def _state(spark, sf):
    return B.initial_state(W.word_table(V.documents(spark, sf)))


@query("tok_05")
def tok_05(spark, sf):
    p = B.pair_counts(_state(spark, sf))
    return p.select("left", "right", F.col("n").cast("long").alias("n"),
                    F.shiftright("first", B.POS_BITS).alias("first_word"),
                    (F.col("first") % (1 << B.POS_BITS)).alias("first_j"))


@query("tok_06")
def tok_06(spark, sf):
    return B.ranked_pairs(B.pair_counts(_state(spark, sf))).limit(1).select("left", "right", "n")


@query("tok_07")
def tok_07(spark, sf):
    st = _state(spark, sf)
    best = B.ranked_pairs(B.pair_counts(st)).first()
    merged = B.apply_merges(F.col("sym"), [(best["left"], best["right"])])
    return st.select("word", B.symbols(merged).alias("symbols"))


@memo
def doc_model(spark, sf, extra: int = EXTRA_MERGES) -> B.BPEModel:
    """BPE over all documents with ``alphabet + extra`` tokens."""
    freqs = W.word_table(V.documents(spark, sf)).cache()
    n_alpha = W.alphabet(freqs).count()
    m = B.train_bpe(freqs, vocab_size=n_alpha + extra)
    freqs.unpersist()
    del freqs
    release(spark)
    return m


@query("tok_08")
def tok_08(spark, sf):
    return doc_model(spark, sf).merges_df(spark)


@query("tok_09")
def tok_09(spark, sf):
    """Stop rules: the held-out ``benchmark`` texts trained to exhaustion
    (vocab 5,000 is never reached; training ends below min_frequency)."""
    bench = V.table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    m = B.train_from_text(bench, vocab_size=5000, min_frequency=2)
    return spark.createDataFrame([(len(m.alphabet), len(m.merges), m.stop_reason)],
                                 "alphabet_size bigint, num_merges bigint, stop_reason string")


@query("tok_10")
def tok_10(spark, sf):
    return doc_model(spark, sf).vocab_df(spark)


@query("tok_11")
def tok_11(spark, sf):
    m = doc_model(spark, sf)
    distinct = W.pretokenize(V.documents(spark, sf)).select("word").distinct()
    return B.encode_words(distinct, m.merges, m.vocab).select("word", "tokens")


@memo
def _encoded_docs(spark, sf):
    m = doc_model(spark, sf)
    return m, stored(B.encode_corpus(V.documents(spark, sf), m.merges, m.vocab))


@query("tok_12")
def tok_12(spark, sf):
    return _encoded_docs(spark, sf)[1]


@query("tok_13")
def tok_13(spark, sf):
    """Held-out text (``benchmark``) with the documents' tokenizer: letters
    outside the alphabet fall back or are dropped."""
    m = doc_model(spark, sf)
    bench = V.table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    return B.encode_corpus(bench, m.merges, m.vocab)


@memo
def bench_model(spark, sf) -> B.BPEModel:
    """BPE over the ``benchmark`` texts with ``alphabet + EXTRA_MERGES`` tokens."""
    bench = V.table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    freqs = W.word_table(bench).checkpoint()
    return B.train_bpe(freqs, vocab_size=W.alphabet(freqs).count() + EXTRA_MERGES)


@query("tok_13_oov")
def tok_13_oov(spark, sf):
    """The documents under the tokenizer of ``benchmark``, whose alphabet lacks
    many of their characters."""
    m = bench_model(spark, sf)
    return B.encode_corpus(V.documents(spark, sf), m.merges, m.vocab)


@query("tok_13_report")
def tok_13_report(spark, sf):
    return B.oov_report(V.documents(spark, sf), bench_model(spark, sf).vocab)


@query("tok_14")
def tok_14(spark, sf):
    m, enc = _encoded_docs(spark, sf)
    return B.decode(enc, m.vocab_df(spark))


@query("tok_15")
def tok_15(spark, sf):
    _, enc = _encoded_docs(spark, sf)
    return B.token_report(enc, V.documents(spark, sf))


@query("tok_16")
def tok_16(spark, sf):
    return B.tokenizer_info(doc_model(spark, sf), spark)


@query("tok_17")
def tok_17(spark, sf):
    m, enc = _encoded_docs(spark, sf)
    return B.check_vocab(enc, len(m.vocab))


# The whole vocabulary of 5,000.  The queries above and below that stop EXTRA_MERGES
# beyond the alphabet stay, since SQL can follow them merge by merge.
VOCABULARY = 5000


@memo
def full_model(spark, sf) -> B.BPEModel:
    freqs = W.word_table(V.documents(spark, sf)).checkpoint()
    return B.train_bpe(freqs, vocab_size=VOCABULARY)


@memo
def full_tokens(spark, sf):
    m = full_model(spark, sf)
    return B.encode_corpus(V.documents(spark, sf), m.merges, m.vocab).checkpoint()


@query("tok_08_full")
def tok_08_full(spark, sf):
    return full_model(spark, sf).merges_df(spark)


@query("tok_10_full")
def tok_10_full(spark, sf):
    return full_model(spark, sf).vocab_df(spark)


@query("tok_11_full")
def tok_11_full(spark, sf):
    m = full_model(spark, sf)
    distinct = W.pretokenize(V.documents(spark, sf)).select("word").distinct()
    return B.encode_words(distinct, m.merges, m.vocab).select("word", "tokens")


@query("tok_12_full")
def tok_12_full(spark, sf):
    return full_tokens(spark, sf)


@query("tok_13_full")
def tok_13_full(spark, sf):
    m = full_model(spark, sf)
    bench = V.table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    return B.encode_corpus(bench, m.merges, m.vocab)


@query("tok_14_full")
def tok_14_full(spark, sf):
    return B.decode(full_tokens(spark, sf), full_model(spark, sf).vocab_df(spark))


@query("tok_15_full")
def tok_15_full(spark, sf):
    return B.token_report(full_tokens(spark, sf), V.documents(spark, sf))


@query("tok_16_full")
def tok_16_full(spark, sf):
    return B.tokenizer_info(full_model(spark, sf), spark)


@query("tok_17_full")
def tok_17_full(spark, sf):
    return B.check_vocab(full_tokens(spark, sf), len(full_model(spark, sf).vocab))


# ------------------------------------------------------------------ datasets
CONTEXT = 16      # context length of the checked datasets
BATCH = 32        # reference default batch size
EPOCHS = 2
SEED = 0


@memo
def runs(spark, sf):
    """Token stream of all documents under the 8-merge tokenizer with one row per
    document, what blocks are cut from; materialised once."""
    return stored(D.token_runs(_encoded_docs(spark, sf)[1]))


@query("dat_01")
def dat_01(spark, sf):
    return D.token_stream(_encoded_docs(spark, sf)[1])


@query("dat_01_segments")
def dat_01_segments(spark, sf):
    """The same stream from texts that are cut into segments before they are encoded."""
    m = doc_model(spark, sf)
    cut = SEG.word_segments(V.documents(spark, sf), size=SEGMENT)
    return D.token_stream(stored(B.encode_corpus(cut, m.merges, m.vocab, key="segment")), key="segment")


@query("dat_02")
def dat_02(spark, sf):
    return D.windows(runs(spark, sf), CONTEXT, stride=CONTEXT)


@query("dat_02_stride1")
def dat_02_stride1(spark, sf):
    """The reference's stride-1 dataset in full, summarised in one row."""
    w = D.windows(runs(spark, sf), CONTEXT, stride=1)
    return w.agg(F.count(F.lit(1)).alias("n_windows"),
                 F.sum(F.col("x")[0]).cast("long").alias("sum_x_first"),
                 F.sum(F.col("y")[CONTEXT - 1]).cast("long").alias("sum_y_last"),
                 F.sum(F.aggregate("x", F.lit(0).cast("long"), lambda a, v: a + v)).cast("long").alias("sum_x_all"))


@query("dat_03")
def dat_03(spark, sf):
    n = D.count_tokens(runs(spark, sf))
    return spark.createDataFrame([(n, CONTEXT, D.window_count(n, CONTEXT))],
                                 "n_tokens bigint, context_length bigint, n_windows bigint")


def _win_ids(spark, sf):
    return D.windows(runs(spark, sf), CONTEXT, stride=CONTEXT).select("win_id")


@query("dat_04")
def dat_04(spark, sf):
    return D.shuffle_batches(stored(_win_ids(spark, sf)), BATCH, EPOCHS, SEED)


@query("dat_04_keyed")
def dat_04_keyed(spark, sf):
    """Batches by the keyed permutation, summed up per epoch: every window once, and
    the place of a window leads back to it."""
    win_ids = stored(_win_ids(spark, sf))
    n = win_ids.count()
    b = D.keyed_batches(win_ids, n, BATCH, EPOCHS, SEED)
    placed = b.withColumn("place", D.place_of(F.col("win_id"), n, SEED, F.col("epoch")))
    back = D.window_at(F.col("place"), n, SEED, F.col("epoch")) == F.col("win_id")
    per = placed.withColumn("back", (back & (F.floor(F.col("place") / BATCH) == F.col("batch"))).cast("long")).groupBy("epoch", "batch").agg(
        F.count(F.lit(1)).alias("n"), F.sum("win_id").alias("s"), F.sum("back").alias("back"))
    once = b.groupBy("epoch", "win_id").agg(F.count(F.lit(1)).alias("c")).groupBy("epoch").agg(
        F.sum((F.col("c") == 1).cast("long")).alias("n_once"))
    return per.groupBy("epoch").agg(
        F.sum("n").alias("n_windows"), F.sum("s").alias("sum_windows"), F.sum("back").alias("n_back"),
        F.count(F.lit(1)).alias("n_batches"), F.sum((F.col("n") == BATCH).cast("long")).alias("n_full"),
        F.max_by("n", "batch").alias("n_last")).join(once, "epoch")


@query("dat_05")
def dat_05(spark, sf):
    return D.eval_batches(_win_ids(spark, sf), BATCH)


@query("dat_06")
def dat_06(spark, sf):
    n_win = _win_ids(spark, sf).count()
    return D.training_manifest(-(-n_win // BATCH), spark)


# ------------------------------------------------------------------ n-gram model
TEMP, TOPK, TOPK_SMALL, GEN_STEPS, ALPHA = 0.8, 40, 5, 200, 1.0
ORDERS = range(1, 5)  # n of the n-gram models that are compared


def _r9(c):
    return F.round(c, 9)


@memo
def lm_model(spark, sf):
    m, _ = _encoded_docs(spark, sf)
    return m, N.fit_ngram(runs(spark, sf), 2).checkpoint()


@memo
def bench_stream(spark, sf):
    m = doc_model(spark, sf)
    bench = V.table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    return D.token_runs(B.encode_corpus(bench, m.merges, m.vocab)).checkpoint()


@query("lm_01")
def lm_01(spark, sf):
    return lm_model(spark, sf)[1].select("ctx", "next", F.col("c").cast("long").alias("c"))


@query("lm_02")
def lm_02(spark, sf):
    d = N.next_dist(lm_model(spark, sf)[1])
    return d.select("ctx", "next", F.col("c").cast("long").alias("c"), F.col("total").cast("long").alias("total"),
                    _r9(F.col("p")).alias("p"), _r9(F.col("logit")).alias("logit"))


@query("lm_02_smoothed")
def lm_02_smoothed(spark, sf):
    """Add-alpha distributions; next = -1 stands for each token not seen."""
    m, counts = lm_model(spark, sf)
    d = N.next_dist(counts, ALPHA, len(m.vocab))
    return d.select("ctx", "next", "c", "total", _r9(F.col("p")).alias("p"), _r9(F.col("logit")).alias("logit"))


@memo
def lm_levels(spark, sf):
    """Counts of all contexts of 0 to 3 tokens."""
    return N.fit_ngram(runs(spark, sf), max(ORDERS)).checkpoint()


def _upto(counts, n):
    return counts.filter(F.size("ctx") < n)


@query("lm_02_orders")
def lm_02_orders(spark, sf):
    """Distributions after contexts of 0, 1, 2 and 3 tokens."""
    d = N.next_dist(lm_levels(spark, sf))
    return d.select("ctx", "next", F.col("c").cast("long").alias("c"), F.col("total").cast("long").alias("total"),
                    _r9(F.col("p")).alias("p"), _r9(F.col("logit")).alias("logit"))


def _by_order(one):
    out = None
    for n in ORDERS:
        row = one(n).withColumn("n", F.lit(n))
        out = row if out is None else out.unionByName(row)
    return out


@query("lm_03_orders")
def lm_03_orders(spark, sf):
    """Loss of the held-out text under models of order 1 to 4, which back off."""
    m, levels, held_out = doc_model(spark, sf), lm_levels(spark, sf), bench_stream(spark, sf)

    def one(n):
        return N.cross_entropy(_upto(levels, n), N.ngram_pairs(held_out, n), len(m.vocab), ALPHA, n=n)
    return _by_order(one).select("n", F.col("n_targets").cast("long").alias("n_targets"), _r9(F.col("loss")).alias("loss"))


@query("lm_04_orders")
def lm_04_orders(spark, sf):
    """Estimated validation loss of models of order 1 to 4."""
    m, levels = doc_model(spark, sf), lm_levels(spark, sf)
    w = D.windows(bench_stream(spark, sf), CONTEXT, stride=1)

    def one(n):
        return N.estimate_loss(_upto(levels, n), w, len(m.vocab), BATCH, 20, ALPHA, n)
    return _by_order(one).select("n", F.col("n_batches").cast("long").alias("n_batches"), _r9(F.col("loss")).alias("loss"),
                                 _r9(F.col("perplexity")).alias("perplexity"))


def _bench_loss(spark, sf):
    m, counts = lm_model(spark, sf)
    targets = N.ngram_pairs(bench_stream(spark, sf), 2)
    return N.cross_entropy(counts, targets, len(m.vocab), ALPHA)


@query("lm_03")
def lm_03(spark, sf):
    return _bench_loss(spark, sf).select(F.col("n_targets").cast("long").alias("n_targets"),
                                         _r9(F.col("loss")).alias("loss"))


@query("lm_04")
def lm_04(spark, sf):
    m, counts = lm_model(spark, sf)
    w = D.windows(bench_stream(spark, sf), CONTEXT, stride=1)
    r = N.estimate_loss(counts, w, len(m.vocab), BATCH, 20, ALPHA)
    return r.select(F.col("n_batches").cast("long").alias("n_batches"), _r9(F.col("loss")).alias("loss"),
                    _r9(F.col("perplexity")).alias("perplexity"))


@query("lm_05")
def lm_05(spark, sf):
    r = _bench_loss(spark, sf)
    return r.select(_r9(F.col("loss")).alias("loss"), _r9(N.perplexity(F.col("loss"))).alias("perplexity"))


@query("lm_06")
def lm_06(spark, sf):
    q = N.softmax(N.next_dist(lm_model(spark, sf)[1]), TEMP, None)
    return q.select("ctx", "next", _r9(F.col("q")).alias("q"))


@query("lm_07")
def lm_07(spark, sf):
    q = N.softmax(N.next_dist(lm_model(spark, sf)[1]), TEMP, TOPK_SMALL)
    return q.select("ctx", "next", _r9(F.col("q")).alias("q"))


@memo
def _table(spark, sf):
    m, counts = lm_model(spark, sf)
    return m, N.sampling_table(N.softmax(N.next_dist(counts), TEMP, TOPK)).checkpoint()


@query("lm_08")
def lm_08(spark, sf):
    _, t = _table(spark, sf)
    req = t.select("ctx").distinct().withColumn(
        "u", N.uniform(0, F.array_join(F.col("ctx").cast("array<string>"), ",")))
    return N.draw(req, t).select("ctx", F.col("next").cast("int").alias("next"))


@query("lm_09")
def lm_09(spark, sf):
    m, t = _table(spark, sf)
    pr = V.prompts(spark, sf).select(F.col("prompt_id").alias("doc_id"), "text")
    ids = B.encode_corpus(pr, m.merges, m.vocab).withColumnRenamed("doc_id", "prompt_id")
    gen = N.generate(ids, t, max_tokens=GEN_STEPS, n=2, seed=0)
    text = B.decode(gen.withColumnRenamed("prompt_id", "doc_id"), m.vocab_df(spark)) \
            .withColumnRenamed("doc_id", "prompt_id")
    return gen.join(text, "prompt_id").select("prompt_id", "ids", "text")


@memo
def full_runs(spark, sf):
    return D.token_runs(full_tokens(spark, sf)).checkpoint()


@query("dat_02_full")
def dat_02_full(spark, sf):
    """Disjoint windows under the whole vocabulary."""
    return D.windows(full_runs(spark, sf), CONTEXT, stride=CONTEXT)


@memo
def full_bench(spark, sf):
    m = full_model(spark, sf)
    bench = V.table(spark, sf, "benchmark").select(F.col("item_id").alias("doc_id"), "text")
    return D.token_runs(B.encode_corpus(bench, m.merges, m.vocab)).checkpoint()


@query("lm_04_full")
def lm_04_full(spark, sf):
    """Estimated validation loss of models of order 1 to 4 under the whole vocabulary."""
    m, levels = full_model(spark, sf), N.fit_ngram(full_runs(spark, sf), max(ORDERS)).checkpoint()
    w = D.windows(full_bench(spark, sf), CONTEXT, stride=1)

    def one(n):
        return N.estimate_loss(_upto(levels, n), w, len(m.vocab), BATCH, 20, ALPHA, n)
    return _by_order(one).select("n", F.col("n_batches").cast("long").alias("n_batches"), _r9(F.col("loss")).alias("loss"),
                                 _r9(F.col("perplexity")).alias("perplexity"))


@query("lm_09_full")
def lm_09_full(spark, sf):
    """200 tokens for every prompt under the whole vocabulary."""
    m, counts = full_model(spark, sf), N.fit_ngram(full_runs(spark, sf), 2)
    t = N.sampling_table(N.softmax(N.next_dist(counts), TEMP, TOPK)).checkpoint()
    pr = V.prompts(spark, sf).select(F.col("prompt_id").alias("doc_id"), "text")
    ids = B.encode_corpus(pr, m.merges, m.vocab).withColumnRenamed("doc_id", "prompt_id")
    return N.generate(ids, t, max_tokens=GEN_STEPS, n=2, seed=0)


# ------------------------------------------------------------------ run metrics
LOG_EVERY, EVAL_EVERY, SAVE_EVERY = 5, 10, 30   # the reference's 100/500/1500, scaled to the fixture


@query("met_01")
def met_01(spark, sf):
    r = M.rolling_loss(V.train_log(spark, sf), LOG_EVERY)
    return r.select("run_id", "step", _r9(F.col("avg_loss")).alias("avg_loss"))


@query("met_02")
def met_02(spark, sf):
    e = M.eval_points(V.train_log(spark, sf), EVAL_EVERY)
    return e.select("run_id", "step", _r9(F.col("val_loss")).alias("val_loss"),
                    _r9(F.col("perplexity")).alias("perplexity"))


@query("met_03")
def met_03(spark, sf):
    b = M.mark_best(M.eval_points(V.train_log(spark, sf), EVAL_EVERY))
    return b.select("run_id", "step", _r9(F.col("val_loss")).alias("val_loss"), "is_best")


@query("met_04")
def met_04(spark, sf):
    b = M.best_checkpoint(M.eval_points(V.train_log(spark, sf), EVAL_EVERY))
    return b.select("run_id", "best_step", _r9(F.col("best_loss")).alias("best_loss"))


@query("met_05")
def met_05(spark, sf):
    t = M.throughput(V.train_log(spark, sf), BATCH, 256, LOG_EVERY)
    return t.select("run_id", "step", F.round("elapsed", 6).alias("elapsed"),
                    F.round("tokens_per_sec", 6).alias("tokens_per_sec"))


@query("met_06")
def met_06(spark, sf):
    return M.checkpoint_steps(V.train_log(spark, sf), SAVE_EVERY)


@query("snk_04")
def snk_04(spark, sf):
    return M.log_lines(V.train_log(spark, sf), LOG_EVERY, EVAL_EVERY)


# ------------------------------------------------------------------ streaming
@query("str_01")
def str_01(spark, sf):
    from corpuslm.streaming import stream as STR
    docs = STR.read_table_stream(spark, sf, "documents").select("doc_id", "text")
    out = STR.run_available(STR.clean_stream(V.wiki_of(docs)), "clean")
    return spark.read.parquet(out).select("doc_id", "text")


@query("str_02")
def str_02(spark, sf):
    from corpuslm.streaming import stream as STR
    m = doc_model(spark, sf)
    docs = STR.read_table_stream(spark, sf, "documents").select("doc_id", "text")
    out = STR.run_available(docs, "encode", foreach_batch=STR.encode_stream_sink(m.merges, m.vocab))
    return spark.read.parquet(out).select("doc_id", "ids")


@query("str_03")
def str_03(spark, sf):
    from corpuslm.streaming import stream as STR
    docs = STR.read_table_stream(spark, sf, "documents").select("doc_id", "text")
    out = STR.run_available(STR.word_count_stream(docs), "wordfreq", "update",
                            foreach_batch=STR.upsert_sink(["word"]))
    return STR.latest(spark, out, ["word"]).select("word", F.col("freq").cast("long").alias("freq"))


@query("str_04")
def str_04(spark, sf):
    from corpuslm.streaming import stream as STR
    ev = STR.read_table_stream(spark, sf, "events")
    out = STR.run_available(STR.run_metrics_stream(ev), "runmetrics", "update",
                            foreach_batch=STR.upsert_sink(["window_start", "run_id"]))
    r = STR.latest(spark, out, ["window_start", "run_id"])
    return r.select("window_start", "run_id", _r9(F.col("mean_loss")).alias("mean_loss"),
                    _r9(F.col("perplexity")).alias("perplexity"), F.col("n").cast("long").alias("n"))


@query("str_04_append")
def str_04_append(spark, sf):
    """Append mode: a window comes once, when the watermark has passed its end."""
    from corpuslm.streaming import stream as STR
    out = STR.run_available(STR.run_metrics_stream(STR.read_table_stream(spark, sf, "events")), "runmetrics", "append")
    return spark.read.parquet(out).select("window_start", "run_id", _r9(F.col("mean_loss")).alias("mean_loss"),
                                          _r9(F.col("perplexity")).alias("perplexity"), F.col("n").cast("long").alias("n"))


@query("str_04_live")
def str_04_live(spark, sf):
    """Rolling means and best marks of running jobs, from a state per run with timers."""
    from corpuslm.streaming import live as L
    from corpuslm.streaming import stream as STR
    ev = STR.read_table_stream(spark, sf, "events")
    log = ev.select(F.col("user_id").alias("run_id"), (F.col("value") / 100.0).alias("loss"), "ts", "event_id")
    out = L.run_live(L.live_metrics(log, LOG_EVERY, EVAL_EVERY, order="event_id"))
    return spark.read.parquet(out).select("run_id", "step", _r9(F.col("avg_loss")).alias("avg_loss"),
                                          _r9(F.col("val_loss")).alias("val_loss"), "is_best")


# ------------------------------------------------------------------ sources / sinks
def _scratch(spark, name):
    import os
    import uuid

    from corpuslm.session import ensure_checkpoint_dir
    return os.path.join(ensure_checkpoint_dir(spark), "io", f"{name}-{uuid.uuid4().hex[:8]}")


def _line_report(spark, path, *keys):
    """Characters of the text, its newlines and carriage returns, and a sum that
    depends on the order of the lines."""
    from corpuslm.sources import io as IO
    lines = IO.read_lines(spark, path).checkpoint()
    last = lines.agg(F.max("path").alias("path")).first()["path"]
    open_end = last is not None and not IO.ends_with_newline(spark, last)
    weight = F.length("line") * (F.col("line_no") % WEIGHT)
    return IO.number_lines(lines).agg(
        (F.sum(F.length("line")) + F.count(F.lit(1)) - int(open_end)).cast("long").alias("chars"),
        (F.count(F.lit(1)) - int(open_end)).cast("long").alias("newlines"),
        F.sum(F.regexp_count("line", F.lit("\r"))).cast("long").alias("carriage_returns"),
        F.sum(weight).cast("long").alias("placed_chars"))


@query("src_01")
def src_01(spark, sf):
    """Raw text with CR LF read by byte ranges, in order."""
    out = _scratch(spark, "raw")
    (V.wiki_raw(spark, sf).orderBy("doc_id").select(F.replace("text", F.lit("\n"), F.lit("\r\n")).alias("v"))
      .write.option("lineSep", "\r\n").text(out))
    return _line_report(spark, out)


@query("snk_01_text")
def snk_01_text(spark, sf):
    """The plain text of both splits (corpus scope), written and read again."""
    from corpuslm.sources import io as IO
    out, pieces = _scratch(spark, "text"), S.split_corpus(joined_wiki(spark, sf)).checkpoint()
    IO.write_split(pieces, f"{out}/table", f"{out}/text")
    found = None
    for s in ("train", "val"):
        r = _line_report(spark, f"{out}/text/{s}").select(F.lit(s).alias("split"), "*")
        found = r if found is None else found.unionByName(r)
    return found


@query("src_02")
def src_02(spark, sf):
    from corpuslm.sources import io as IO
    out = _scratch(spark, "extracted")
    V.wiki_raw(spark, sf).orderBy("doc_id").select("text").coalesce(2).write.text(out)
    return IO.read_extracted(spark, out, glob="part-*")


@query("src_03")
def src_03(spark, sf):
    from corpuslm.sources import io as IO
    out = _scratch(spark, "split")
    IO.write_split(S.split_corpus(cleaned_wiki(spark, sf)), out)
    return IO.read_split(spark, out, "train").select("doc_id", "split", "text")


@query("snk_01")
def snk_01(spark, sf):
    from corpuslm.sources import io as IO
    out = _scratch(spark, "split")
    IO.write_split(S.split_corpus(cleaned_wiki(spark, sf)), out)
    return spark.read.parquet(out).select("doc_id", "split", "text")


@query("snk_02")
def snk_02(spark, sf):
    """Tokenizer JSON round trip (SNK-02 then SRC-04)."""
    from corpuslm.sources import io as IO
    m = doc_model(spark, sf)
    out = _scratch(spark, "vocab")
    IO.write_tokenizer(m.vocab_df(spark), m.merges_df(spark), out)
    vocab, merges = IO.read_tokenizer(spark, out)
    assert merges == m.merges
    return spark.createDataFrame(sorted(vocab.items(), key=lambda kv: kv[1]), "token string, id bigint")


@query("src_04")
def src_04(spark, sf):
    """The merges of a tokenizer JSON file, in order."""
    from corpuslm.sources import io as IO
    m = doc_model(spark, sf)
    out = _scratch(spark, "vocab")
    IO.write_tokenizer(m.vocab_df(spark), m.merges_df(spark), out)
    _, merges = IO.read_tokenizer(spark, out)
    return spark.createDataFrame([(i, l, r) for i, (l, r) in enumerate(merges)], "rank bigint, left string, right string")


@query("snk_03")
def snk_03(spark, sf):
    """Token files round trip (SNK-03 then SRC-05)."""
    from corpuslm.sources import io as IO
    out = _scratch(spark, "tokens")
    IO.write_tokens(_encoded_docs(spark, sf)[1], out)
    return IO.read_tokens(spark, out).select("doc_id", "ids")


@query("src_05")
def src_05(spark, sf):
    """Token files read back: tokens and the sum of their ids by document."""
    from corpuslm.sources import io as IO
    out = _scratch(spark, "tokens")
    IO.write_tokens(_encoded_docs(spark, sf)[1], out)
    total = F.aggregate("ids", F.lit(0).cast("long"), lambda a, v: a + v)
    return IO.read_tokens(spark, out).select("doc_id", F.size("ids").cast("long").alias("n_ids"), total.alias("sum_ids"))


@query("snk_03_uint16")
def snk_03_uint16(spark, sf):
    """The token stream as uint16 files, read back: a report per block of the stream."""
    from corpuslm.sources import token_files as TF
    out = _scratch(spark, "uint16")
    TF.write_token_files(runs(spark, sf), out)
    placed = F.aggregate(F.transform("ids", lambda v, i: v * ((F.col("start") + i) % WEIGHT)), F.lit(0).cast("long"), lambda a, v: a + v)
    return TF.read_token_files(spark, out).select(
        (F.col("start") / TF.RUN).cast("long").alias("block"), F.size("ids").cast("long").alias("n"), placed.alias("placed_ids"))


@query("src_05_uint16")
def src_05_uint16(spark, sf):
    """Disjoint windows straight from uint16 token files."""
    from corpuslm.sources import token_files as TF
    out = _scratch(spark, "uint16")
    TF.write_token_files(runs(spark, sf), out)
    return D.windows(TF.read_token_files(spark, out), CONTEXT, stride=CONTEXT)


# ------------------------------------------------------------------ from raw text to windows
WEIGHT = 9973  # places are weighted with their remainder, so that the sums depend on the order


@query("pipe_01")
def pipe_01(spark, sf):
    """Clean (corpus scope), split, learn BPE on the train part, encode both
    parts, two token streams, windows: a report per split."""
    pieces = S.split_corpus(joined_wiki(spark, sf)).checkpoint()
    train = pieces.filter("split = 'train'")
    freqs = W.word_table(train).checkpoint()
    m = B.train_bpe(freqs, vocab_size=W.alphabet(freqs).count() + EXTRA_MERGES)
    out = None
    for split in ("train", "val"):
        part = pieces.filter(F.col("split") == split)
        enc = B.encode_corpus(part, m.merges, m.vocab).checkpoint()
        lengths = S.split_report(part).filter(F.col("split") == split).select("split", "chars")
        tokens = enc.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0)).cast("long").alias("tokens"))
        w = D.windows(D.token_runs(enc).checkpoint(), CONTEXT, stride=CONTEXT)
        placed = F.aggregate(F.transform("x", lambda v, i: v * ((F.col("win_id") * CONTEXT + i) % WEIGHT)),
                             F.lit(0).cast("long"), lambda a, v: a + v)
        cut = w.agg(F.count(F.lit(1)).alias("n_windows"), F.sum(placed).alias("placed_ids"))
        one = lengths.crossJoin(tokens).crossJoin(cut).select(  # one-row frames
            "split", "chars", "tokens", F.round(F.col("tokens") * 2 / F.lit(1048576.0), 6).alias("size_mb"),
            F.round(F.try_divide("chars", "tokens"), 6).alias("chars_per_token"), "n_windows", "placed_ids")
        out = one if out is None else out.unionByName(one)
    return out


def queries() -> dict[str, Query]:
    return dict(REGISTRY)
