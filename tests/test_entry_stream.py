from conftest import SF0001


def test_entry_and_contract(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.count() > 0
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60


def test_stream_equals_batch(spark):
    from corpuslm.operators import clean as C
    from corpuslm.plans import views as V
    from corpuslm.streaming import stream as STR
    docs = STR.read_table_stream(spark, SF0001, "documents").select("doc_id", "text")
    out = STR.run_available(STR.clean_stream(V.wiki_of(docs)), "t_clean")
    s = sorted(map(tuple, spark.read.parquet(out).select("doc_id", "text").collect()))
    b = sorted(map(tuple, C.clean_corpus(V.wiki_raw(spark, SF0001)).select("doc_id", "text").collect()))
    assert s == b


def test_tokenizer_json_roundtrip(spark, tmp_path):
    from corpuslm.operators import bpe as B
    from corpuslm.operators import words as W
    from corpuslm.plans import views as V
    from corpuslm.sources import io as IO
    m = B.train_bpe(W.word_table(V.documents(spark, SF0001)), vocab_size=90)
    IO.write_tokenizer(m.vocab_df(spark), m.merges_df(spark), str(tmp_path / "v"))
    vocab, merges = IO.read_tokenizer(spark, str(tmp_path / "v"))
    assert vocab == m.vocab and merges == m.merges
    bad = tmp_path / "bad.json"
    bad.write_text('{"type": "subword", "vocab": {"a": 0}}')
    import pytest
    with pytest.raises(ValueError):
        IO.read_tokenizer(spark, str(bad))
