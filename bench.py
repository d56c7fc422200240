"""Headline jobs at one scale factor; prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Every job runs to completion through the ``noop`` sink (full execution, no
collect).  Times are wall-clock seconds per job on a warm session.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    vocab_size = int(os.environ.get("BENCH_VOCAB", "1000"))
    from pyspark.sql import functions as F

    from corpuslm.operators import bpe as B
    from corpuslm.operators import clean as C
    from corpuslm.operators import dataset as D
    from corpuslm.operators import metrics as M
    from corpuslm.operators import ngram as N
    from corpuslm.operators import split as S
    from corpuslm.operators import words as W
    from corpuslm.plans import views as V
    from corpuslm.session import get_spark

    spark = get_spark(master=f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    times: dict[str, float] = {}

    def run(name, fn):
        t0 = time.time()
        out = fn()
        times[name] = round(time.time() - t0, 3)
        return out

    def sink(df):
        df.write.mode("overwrite").format("noop").save()

    # warm-up: JVM, Python workers, parquet footers
    V.documents(spark, sf_dir).count()

    cleaned = run("clean", lambda: C.clean_corpus(V.wiki_raw(spark, sf_dir)).select("doc_id", "text").checkpoint())
    run("split", lambda: sink(S.split_corpus(cleaned)))
    freqs = run("word_freq", lambda: W.word_table(V.documents(spark, sf_dir)).checkpoint())
    model = run("bpe_train", lambda: B.train_bpe(freqs, vocab_size=vocab_size))
    enc = run("encode", lambda: B.encode_corpus(V.documents(spark, sf_dir), model.merges, model.vocab).checkpoint())
    stream = run("token_stream", lambda: D.token_runs(enc).checkpoint())
    run("token_stream_rows", lambda: sink(D.token_stream(enc)))
    run("windows_stride1", lambda: sink(D.windows(stream, 64, stride=1)))
    counts = run("ngram_fit", lambda: N.fit_ngram(stream, 2).checkpoint())
    run("ngram_loss", lambda: N.cross_entropy(counts, N.ngram_pairs(stream, 2), len(model.vocab)).collect())
    table = run("sampling_table", lambda: N.sampling_table(N.softmax(N.next_dist(counts), 0.8, 40)).checkpoint())
    prompts = V.prompts(spark, sf_dir).select(F.col("prompt_id").alias("doc_id"), "text")
    pids = B.encode_corpus(prompts, model.merges, model.vocab).withColumnRenamed("doc_id", "prompt_id")
    run("generate_10", lambda: sink(N.generate(pids, table, max_tokens=10)))
    run("run_metrics", lambda: sink(M.mark_best(M.eval_points(V.train_log(spark, sf_dir), 10))))

    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "pipeline_total", "value": total, "unit": "sec", "queries": times,
                      "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", ""),
                      "bpe_merges": len(model.merges), "bpe_rounds": model.rounds}))


if __name__ == "__main__":
    main()
