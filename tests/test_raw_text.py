"""Raw text by byte ranges and exact text export, against Python's text mode."""

import glob
import os
import random

import pytest
from corpuslm.sources import io as IO


@pytest.fixture
def small_ranges(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "4096", "spark.sql.files.openCostInBytes": "1"}
    old = {k: spark.conf.get(k) for k in keys}
    for k, v in keys.items():
        spark.conf.set(k, v)
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("end", ["", "\r\n", "\n", "\r", "\r\n\r\n"])
def test_one_file_by_ranges_equals_text_mode(spark, small_ranges, tmp_path, end):
    rng = random.Random(len(end))
    path = tmp_path / "raw.txt"
    lines = ["é" * rng.randint(0, 90) + rng.choice(["", " ", "x y", "\t"]) for _ in range(900)]
    raw = "".join(line + rng.choice(["\r\n", "\n", "\r"]) for line in lines) + "last" + end
    # a carriage return and its line feed on both sides of a range's border
    data = raw.encode()
    head = "a" * (4095 - 0) + "\r\n"
    path.write_bytes(head.encode() + data)
    with open(path, encoding="utf-8") as f:
        want = f.read()
    d = IO.read_lines(spark, str(path))
    assert d.rdd.getNumPartitions() >= 8
    for held in (IO.LINE_ROWS, 0):
        rows = sorted((r["line_no"], r["line"]) for r in IO.number_lines(d, held).collect())
        assert [n for n, _ in rows] == list(range(len(rows)))
        closed = IO.ends_with_newline(spark, str(path))
        assert "\n".join(line for _, line in rows) + "\n" * closed == want
    by_key = [r["line"] for r in d.orderBy("path", "block", "row").collect()]
    assert by_key == [line for _, line in rows]


def test_empty_file_has_no_lines(spark, tmp_path):
    (tmp_path / "raw.txt").write_bytes(b"")
    d = IO.read_lines(spark, str(tmp_path / "raw.txt"))
    assert IO.number_lines(d).count() == 0 and not IO.ends_with_newline(spark, str(tmp_path / "raw.txt"))


@pytest.mark.parametrize("texts", [["a", "b\nc", "", "énd"], ["x", ""], ["one\n"], ["", ""], [""], [None, "é" * 500, "z" * 300, "q"], []])
def test_text_export_is_exact(spark, tmp_path, texts):
    docs = spark.createDataFrame([(7 * i - 9, t, "s") for i, t in enumerate(texts)], "doc_id long, text string, k string").repartition(3)
    out = str(tmp_path / "out")
    IO.write_text(docs, out, part_bytes=64)
    files = sorted(f for f in glob.glob(f"{out}/**/part-*", recursive=True) if os.path.getsize(f) or not texts)
    assert b"".join(open(f, "rb").read() for f in files).decode() == "\n".join(t or "" for t in texts)
    assert all(os.path.getsize(f) <= 64 + 1001 for f in files)
