"""Token arrays as fixed-width files (SNK-03, SRC-05).

A folder of files of little-endian unsigned 16-bit ids, each named by the place
of its first token in the stream.  Put together in the order of their names they
are the array; any range of it is read without the rest.

Written and read through a Python data source.  A task writes to a folder of
the job under a name of its own attempt; the commit moves the files of the
attempts that Spark has taken, so a task that is lost or runs twice leaves
nothing.  Paths are whatever ``pyarrow.fs`` opens (local, hdfs, s3, gs) and must
be shared by driver and executors.
"""

from __future__ import annotations

import math
import posixpath
import re
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition,
                                    WriterCommitMessage)

from corpuslm.operators.dataset import blocks
from corpuslm.sources.io import UINT16_MAX, check_uint16

WIDTH = 2                # bytes of a token
ROW = 1 << 12            # tokens of a row that is written
RUN = 1 << 16            # tokens of a row that is read
FILE_TOKENS = 1 << 26    # tokens of a file: 128 MB
TASK_TOKENS = 1 << 26    # tokens that one task reads
SCHEMA = "start bigint, ids array<int>"
NAME = re.compile(r"tokens-(\d{20})\.bin")


def _open(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(path)


def _files(path: str) -> list[tuple[int, str, int]]:
    """``(first token, file, tokens)`` in order; an error where the array has a gap."""
    store, root = _open(path)
    found = []
    for f in store.get_file_info(pafs.FileSelector(root)):
        named = NAME.fullmatch(f.base_name)
        if named:
            if f.size % WIDTH:
                raise ValueError(f"{f.path} holds {f.size} bytes, no whole number of tokens")
            found.append((int(named[1]), f.path, f.size // WIDTH))
    found.sort()
    at = 0
    for start, name, n in found:
        if start != at:
            raise ValueError(f"{name} follows token {at}: a file of the array is missing")
        at += n
    return found


@dataclass
class _Range(InputPartition):
    file: str
    start: int   # place of the file's first token
    first: int   # the range to read, places in the stream
    last: int


class _Reader(DataSourceReader):
    def __init__(self, options):
        self.path = options["path"]
        self.first = int(options.get("first", 0))
        self.last = int(options.get("last", -1))
        self.task_tokens = max(1, int(options.get("taskTokens", TASK_TOKENS)))

    def partitions(self):
        out = []
        for start, file, n in _files(self.path):
            lo = max(start, self.first)
            hi = start + n if self.last < 0 else min(start + n, self.last)
            for at in range(lo, hi, self.task_tokens):
                out.append(_Range(file, start, at, min(hi, at + self.task_tokens)))
        return out or [_Range("", 0, 0, 0)]

    def read(self, partition):
        if partition.last <= partition.first:
            return
        store, _ = _open(self.path)
        kind = pa.schema([("start", pa.int64()), ("ids", pa.list_(pa.int32()))])
        with store.open_input_file(partition.file) as f:
            for at in range(partition.first, partition.last, RUN):
                n = min(RUN, partition.last - at)
                raw = f.read_at(n * WIDTH, (at - partition.start) * WIDTH)
                ids = pa.array(np.frombuffer(raw, "<u2").astype(np.int32))
                lists = pa.ListArray.from_arrays(pa.array([0, n], pa.int32()), ids)
                yield pa.RecordBatch.from_arrays([pa.array([at], pa.int64()), lists], schema=kind)


@dataclass
class _Written(WriterCommitMessage):
    files: list  # (written file, name in the folder)


class _Writer(DataSourceArrowWriter):
    """Rows ``(start, ids, file)``, sorted by file and start within a task; a file's
    rows are all in one task.  ``file`` is the place of the file's first token."""

    def __init__(self, options, overwrite):
        self.path, self.overwrite = options["path"], overwrite
        self.job = f"_job-{uuid.uuid4().hex}"

    def write(self, iterator):
        store, root = _open(self.path)
        task = TaskContext.get()
        folder = posixpath.join(root, self.job)
        store.create_dir(folder, recursive=True)
        done, out, now, at = [], None, None, 0
        try:
            for batch in iterator:
                starts, files = batch.column("start").to_pylist(), batch.column("file").to_pylist()
                lists = batch.column("ids")
                for i, (start, file) in enumerate(zip(starts, files)):
                    if file != now:
                        if out is not None:
                            out.close()
                        name = f"tokens-{file:020d}.bin"
                        done.append((posixpath.join(folder, f"{task.taskAttemptId()}-{name}"), name))
                        out, now, at = store.open_output_stream(done[-1][0]), file, file
                    ids = lists[i].values.to_numpy(zero_copy_only=False)
                    if start != at:
                        raise ValueError(f"tokens from {start} on follow token {at}: the stream has a gap")
                    if len(ids) and (ids.min() < 0 or ids.max() > UINT16_MAX):
                        raise ValueError("token id outside 0..65535 cannot be stored as uint16")
                    out.write(ids.astype("<u2").tobytes())
                    at += len(ids)
        except BaseException:
            if out is not None:
                out.close()
            for written, _ in done:
                store.delete_file(written)
            raise
        if out is not None:
            out.close()
        return _Written(done)

    def commit(self, messages):
        store, root = _open(self.path)
        store.create_dir(root, recursive=True)
        old = [f.path for f in store.get_file_info(pafs.FileSelector(root)) if NAME.fullmatch(f.base_name)]
        if old and not self.overwrite:
            self.abort(messages)
            raise ValueError(f"{self.path} holds token files; use mode overwrite")
        for f in old:
            store.delete_file(f)
        for written, name in (f for m in messages if m is not None for f in m.files):
            store.move(written, posixpath.join(root, name))
        self.abort(messages)

    def abort(self, messages):
        store, root = _open(self.path)
        folder = posixpath.join(root, self.job)
        if store.get_file_info(folder).type != pafs.FileType.NotFound:
            store.delete_dir(folder)


class TokenFiles(DataSource):
    """The format ``uint16_tokens``."""

    @classmethod
    def name(cls):
        return "uint16_tokens"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return _Reader(self.options)

    def writer(self, schema, overwrite):
        return _Writer(self.options, overwrite)


def write_token_files(runs: DataFrame, path: str, file_tokens: int = FILE_TOKENS) -> None:
    """SNK-03: the token stream ``(start, ids)`` (``dataset.token_runs``) as uint16
    files of ``file_tokens`` tokens (rounded up to whole rows of 4,096), replacing
    token files that the folder holds.

    Each token moves once, to the task that writes its file; no task holds more than
    one Arrow batch of rows.  An id that is null or outside 0..65535, or a stream
    with a gap, fails the job and leaves the folder as it was.  No tokens: no files."""
    rows = math.ceil(max(1, file_tokens) / ROW)
    runs.sparkSession.dataSource.register(TokenFiles)
    nulls = F.exists("ids", lambda x: x.isNull())
    whole = runs.withColumn("ids", F.when(nulls, F.raise_error(F.lit("a token id is null"))).otherwise(F.col("ids")))
    (blocks(check_uint16(whole), 0, ROW)
     .select((F.col("blk") * ROW).alias("start"), F.col("toks").alias("ids"),
             (F.floor(F.col("blk") / rows) * rows * ROW).cast("long").alias("file"))
     .repartition("file").sortWithinPartitions("file", "start")
     .write.format(TokenFiles.name()).mode("overwrite").save(path))


def read_token_files(spark: SparkSession, path: str, first: int = 0, last: int | None = None,
                     task_tokens: int = TASK_TOKENS) -> DataFrame:
    """SRC-05: runs ``(start, ids)`` of the tokens ``first`` up to ``last`` (not
    included; null: the end) of a folder of ``write_token_files``.  Only their bytes
    are read, by tasks of at most ``task_tokens`` tokens.  A missing file or an odd
    size is an error."""
    spark.dataSource.register(TokenFiles)
    r = spark.read.format(TokenFiles.name()).option("first", str(first)).option("taskTokens", str(task_tokens))
    if last is not None:
        r = r.option("last", str(max(0, last)))
    return r.load(path)


def read_windows(spark: SparkSession, path: str, win_ids: list[int], L: int, stride: int = 1) -> DataFrame:
    """Some windows ``(win_id, x, y)`` of a token file folder: a few thousand numbers
    at most, as for one batch.  Only the bytes from the first to the last are read, so
    ask for windows that lie together."""
    if not win_ids:
        return spark.createDataFrame([], "win_id bigint, x array<int>, y array<int>")
    lo, hi = min(win_ids) * stride, max(win_ids) * stride + L + 1
    runs = read_token_files(spark, path, lo, hi)
    want = spark.createDataFrame([(int(w), int(w) * stride) for w in sorted(set(win_ids))], "win_id bigint, at bigint")
    end = F.col("start") + F.size("ids")
    from_, to = F.greatest("start", "at"), F.least(end, F.col("at") + L + 1)
    part = runs.join(F.broadcast(want), (F.col("start") < F.col("at") + L + 1) & (end > F.col("at"))).select(
        "win_id", from_.alias("from"), F.slice("ids", (from_ - F.col("start") + 1).cast("int"), (to - from_).cast("int")).alias("p"))
    toks = F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("from", "p"))), lambda s: s["p"]))
    return (part.groupBy("win_id").agg(toks.alias("t")).filter(F.size("t") == L + 1)
                .select("win_id", F.slice("t", 1, L).alias("x"), F.slice("t", 2, L).alias("y")))
