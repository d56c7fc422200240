"""uint16 token files: the array byte for byte, ranges, windows and failed writes."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpuslm.operators import dataset as D
from corpuslm.sources import token_files as TF


def _docs(spark, n=400, seed=5):
    rng = np.random.default_rng(seed)
    docs = [(i, [int(x) for x in rng.integers(0, 65536, rng.integers(0, 120))]) for i in range(n)]
    docs[3] = (3, [65535, 0])
    docs[7] = (7, [int(x) for x in rng.integers(0, 65536, 20_000)])  # longer than a file
    return docs, spark.createDataFrame(docs, "doc_id bigint, ids array<int>").repartition(5)


def _bytes(path):
    names = sorted(f for f in os.listdir(path) if f.endswith(".bin"))
    return names, b"".join(open(os.path.join(path, f), "rb").read() for f in names)


def test_round_trip(spark, tmp_path):
    docs, df = _docs(spark)
    flat = [x for _, ids in docs for x in ids]
    path = str(tmp_path / "tokens")
    TF.write_token_files(D.token_runs(df), path, file_tokens=8192)
    names, raw = _bytes(path)
    assert raw == np.array(flat, "<u2").tobytes()
    assert len(names) == -(-len(flat) // 8192) and len(names) > 4
    assert not [f for f in os.listdir(path) if f.startswith("_")]  # nothing of the job is left
    back = TF.read_token_files(spark, path, task_tokens=1000)
    assert back.rdd.getNumPartitions() > len(flat) // 1000
    rows = sorted(back.collect())
    assert [x for r in rows for x in r["ids"]] == flat
    for first, last in [(0, 1), (8191, 8193), (5000, 5000), (12_345, 30_000), (len(flat) - 1, None), (len(flat) + 9, None)]:
        got = sorted(TF.read_token_files(spark, path, first, last).collect())
        assert [x for r in got for x in r["ids"]] == flat[first:last]
    # windows straight from the files equal those of the token lists
    want = D.windows(D.token_runs(df), 16, stride=16)
    got = D.windows(TF.read_token_files(spark, path, task_tokens=3000), 16, stride=16)
    assert sorted(got.collect()) == sorted(want.collect())
    some = TF.read_windows(spark, path, [0, 511, 512, 700, 10 ** 9], 16, stride=16).collect()
    assert sorted(some) == sorted(want.filter(F.col("win_id").isin(0, 511, 512, 700)).collect())


def test_write_replaces_and_failure_leaves_the_folder(spark, tmp_path):
    path = str(tmp_path / "tokens")
    runs = lambda ids: spark.createDataFrame([(0, ids)], "start bigint, ids array<int>")
    TF.write_token_files(runs(list(range(9000))), path, file_tokens=4096)
    TF.write_token_files(runs([1, 2, 3]), path, file_tokens=4096)
    names, raw = _bytes(path)
    assert (names, raw) == (["tokens-" + "0" * 20 + ".bin"], b"\1\0\2\0\3\0")
    for bad in ([1, 65536], [-1], [1, None]):
        with pytest.raises(Exception, match="uint16|null"):
            TF.write_token_files(runs(bad), path, file_tokens=4096)
        assert _bytes(path) == (names, raw)
    with pytest.raises(Exception, match="gap"):
        TF.write_token_files(spark.createDataFrame([(0, [1] * 10), (4096, [2])], TF.SCHEMA), path, file_tokens=8192)
    assert _bytes(path) == (names, raw)
    assert not [f for f in os.listdir(path) if f.startswith("_")]


def test_empty_and_broken_folders(spark, tmp_path):
    path = str(tmp_path / "none")
    TF.write_token_files(spark.createDataFrame([], "start bigint, ids array<int>"), path)
    assert TF.read_token_files(spark, path).collect() == []
    two = str(tmp_path / "two")
    TF.write_token_files(spark.createDataFrame([(0, [5] * 9000)], TF.SCHEMA), two, file_tokens=4096)
    os.rename(os.path.join(two, f"tokens-{4096:020d}.bin"), os.path.join(two, "moved"))
    with pytest.raises(Exception, match="missing"):
        TF.read_token_files(spark, two).collect()
