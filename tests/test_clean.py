import hypothesis.strategies as st
from hypothesis import HealthCheck, given, settings
from pyspark.sql import functions as F

from corpuslm.operators import clean as C
from corpuslm.operators.words import words_of
from spec_clean import spec_clean


def one(spark, col_fn, text):
    df = spark.createDataFrame([(0, text)], "doc_id long, text string")
    return df.select(col_fn(F.col("text")).alias("t")).first()["t"]


def test_blank_line_golden(spark):
    assert one(spark, C.squeeze_blank, "a\n\n\nb") == "a\n\nb"
    assert one(spark, C.squeeze_blank, "\n\na") == "\na"
    assert one(spark, C.squeeze_blank, "a\n\n\n") == "a\n"
    assert one(spark, C.squeeze_blank, "a\n  \n\t\nb") == "a\n\nb"


def test_url_lines(spark):
    assert one(spark, C.blank_url_lines, "https://x.org/a\nb") == "\nb"
    assert one(spark, C.blank_url_lines, "https://x.org/a \nb") == "https://x.org/a \nb"
    assert one(spark, C.blank_url_lines, "see https://x.org/a\nb") == "see https://x.org/a\nb"


def test_doc_tag_spans_lines(spark):
    assert one(spark, C.strip_doc_open, '<doc\n a="1">x</doc>') == "x</doc>"
    assert one(spark, C.strip_doc_close, "x</doc>") == "x"


def test_duplicate_title_across_blank(spark):
    t = "Title line one\n\nTitle line one\nbody text here ok"
    assert one(spark, C.dedup_adjacent, t) == "Title line one\n\nbody text here ok"


def _clean(spark, texts, lowercase=False):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = C.clean_corpus(df, lowercase=lowercase).orderBy("doc_id").collect()
    return [r["text"] for r in out]


def test_special_lines_match_spec(spark):
    texts = [
        "first line is long\n \nsecond line is long",
        "x y is a long line\nx y is a long line",
        "​\nabcdefghijk\n​​\nabcdefghijk",
        "\x1c\nline number one\n\x1c\x1d\nline number two",
        "café au lait, s'il vous plaît",
        "",
        "short",
        "  a  b  c  d  e  f  \n\n\n\nsecond paragraph here",
    ]
    assert _clean(spark, texts) == [spec_clean(t) for t in texts]


ALPHABET = list("ab c\n\t.é") + [" ", "​", " ", "\x1c", "https://", "<doc ", ">", "</doc>",
                                  "aaaaaaaaaaaa", "\n\n"]


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(ALPHABET), max_size=30).map("".join), min_size=1, max_size=12))
def test_clean_fuzz_matches_spec(spark, texts):
    assert _clean(spark, texts) == [spec_clean(t) for t in texts]
    assert _clean(spark, texts, lowercase=True) == [spec_clean(t, True) for t in texts]


def test_accents_become_separate_tokens(spark):
    df = spark.createDataFrame([(0, "Café")], "doc_id long, text string")
    cleaned = C.clean_corpus(df.select("doc_id", F.concat("text", F.lit(" is a word")).alias("text")))
    words = cleaned.select(words_of(F.col("text")).alias("w")).first()["w"]
    assert words[:2] == ["cafe", "́"]
