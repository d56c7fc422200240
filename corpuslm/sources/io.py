"""Sources and sinks (SRC-*, SNK-*).

Raw text and extracted dump files are read with Spark's text source; the
intermediate tables (splits, tokenizer, token lists) are parquet, with the
reference's file formats (plain text, vocab JSON) offered as exports.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpuslm.functions.text import WS
from corpuslm.operators.order import place, prefix_sum

UINT16_MAX = 65535


# ------------------------------------------------------------------ sources
def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """SRC-01 for small files: one row per file ``(path, text)``, UTF-8, universal
    newlines (``\\r\\n`` and ``\\r`` become ``\\n``, as Python's text mode does).
    A large file is read by ``read_lines``."""
    d = spark.read.text(path, wholetext=True)
    return d.select(F.input_file_name().alias("path"),
                    F.regexp_replace("value", "\r\n?", "\n").alias("text"))


LINE_ROWS = 100_000  # blocks whose line counts go to every task; beyond, they are joined


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """SRC-01 for files of any size: ``(path, block, row, line)`` in universal
    newlines (LF, CR LF and CR end a line), UTF-8.

    Spark cuts a file into byte ranges and gives each line to the range that it
    begins in, so one large file is read by many tasks.  ``(path, block, row)``
    orders the lines: the file, the start of the byte range, and a number that
    grows within it."""
    d = spark.read.text(path)
    return d.select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row"), F.col("value").alias("line"))


def number_lines(lines: DataFrame, held: int = LINE_ROWS) -> DataFrame:
    """Lines of ``read_lines`` with ``line_no``, from 0 over all files in path
    order.  Lines are counted by byte range; no line is moved if there are at most
    ``held`` ranges."""
    at = lines.groupBy("path", "block").agg(F.count(F.lit(1)).alias("n"), F.min("row").alias("first")).checkpoint()
    # one row per byte range (128 MB by default), in two levels: files, and the ranges of a file
    files = at.groupBy("path").agg(F.sum("n").alias("n"))
    whole = Window.orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("path", F.coalesce(F.sum("n").over(whole), F.lit(0)).alias("before"))
    in_file = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    at = at.withColumn("in_file", F.coalesce(F.sum("n").over(in_file), F.lit(0))).join(files, "path").select(
        "path", "block", (F.col("before") + F.col("in_file") - F.col("first")).alias("shift"))
    if at.count() <= held:
        at = F.broadcast(at)
    return lines.join(at, ["path", "block"]).select("path", "block", "row", (F.col("row") + F.col("shift")).alias("line_no"), "line")


def ends_with_newline(spark: SparkSession, path: str) -> bool:
    """Whether the last byte of one file ends a line; one byte is read."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    store = where.getFileSystem(spark._jsc.hadoopConfiguration())
    size = store.getFileStatus(where).getLen()
    if size == 0:
        return False
    with_last = store.open(where)
    try:
        with_last.seek(size - 1)
        return with_last.read() in (10, 13)
    finally:
        with_last.close()


def read_extracted(spark: SparkSession, directory: str, glob: str = "wiki_*") -> DataFrame:
    """SRC-02: every ``<doc id url title>`` ... ``</doc>`` block of a directory
    of extracted dump files as ``(doc_id, url, title, text)``; ``text`` keeps
    the tags so the cleaner sees what the reference sees.

    ``</doc>`` is the reader's record separator, so a large file is split over
    many tasks.  No text is lost: a block that is never closed is closed before
    the next one or at the end, and text outside blocks comes as rows without a
    doc_id (unless it is white space only)."""
    raw = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
                .option("lineSep", "</doc>").text(directory)
                .select(F.regexp_replace("value", "\r\n?", "\n").alias("value")))
    parts = raw.select(F.split("value", "(?=<doc" + WS + ")", -1).alias("p")).select(F.explode("p").alias("text"))
    is_block = F.rlike("text", F.lit(r"\A<doc" + WS))
    blocks = (parts.filter(~F.rlike("text", F.lit(r"\A" + WS + r"*\z")))
              .select(F.when(is_block, F.concat("text", F.lit("</doc>"))).otherwise(F.col("text")).alias("text")))

    def attr(name):
        return F.regexp_extract("text", r'^<doc\s[^>]*?\b' + name + r'="([^"]*)"', 1)
    return blocks.select(attr("id").try_cast("long").alias("doc_id"), attr("url").alias("url"),
                         attr("title").alias("title"), "text")


def read_split(spark: SparkSession, path: str, split: str) -> DataFrame:
    """SRC-03: one split of a table written by ``write_split``; the filter on
    the partition column prunes the other split's files."""
    return spark.read.parquet(path).filter(F.col("split") == split)


TOKENIZER_SCHEMA = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("vocab", T.MapType(T.StringType(), T.LongType())),
    T.StructField("merges", T.ArrayType(T.ArrayType(T.StringType()))),
    T.StructField("vocab_size", T.LongType()),
])


def read_tokenizer(spark: SparkSession, path: str) -> tuple[dict[str, int], list[tuple[str, str]]]:
    """SRC-04: vocab and merges of a tokenizer JSON file.  Missing or
    malformed ``vocab``/``merges`` is an error; the stored ``vocab_size`` is
    ignored (the size is recounted).  The tokenizer is bounded by its
    vocabulary, so it is the one object brought to the driver."""
    rows = (spark.read.schema(TOKENIZER_SCHEMA).option("multiLine", "true").option("mode", "FAILFAST")
                 .json(path).collect())
    if len(rows) != 1:
        raise ValueError(f"tokenizer file must hold one object, found {len(rows)}")
    r = rows[0]
    if r["vocab"] is None or r["merges"] is None:
        raise ValueError(f"{path} lacks the vocabulary or the merges")
    merges = []
    for m in r["merges"]:
        if m is None or len(m) != 2:
            raise ValueError(f"malformed merge {m!r}")
        merges.append((m[0], m[1]))
    return dict(r["vocab"]), merges


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """SRC-05: token lists ``(doc_id, ids)``."""
    return spark.read.parquet(path)


# ------------------------------------------------------------------ sinks
PART_BYTES = 128 << 20


def write_split(pieces: DataFrame, path: str, text_dir: str | None = None) -> None:
    """SNK-01: the split table, partitioned by ``split``; optionally the plain
    text of each split too (``write_text``)."""
    pieces.write.mode("overwrite").partitionBy("split").parquet(path)
    if text_dir:
        for s in ("train", "val"):
            write_text(pieces.filter(F.col("split") == s), f"{text_dir}/{s}")


def write_text(pieces: DataFrame, path: str, key: str = "doc_id", part_bytes: int = PART_BYTES) -> None:
    """SNK-01: the pieces joined with ``\\n`` in key order, as text files whose
    bytes, put together in the order of their names, are exactly that text.

    Byte offsets come from a two-level prefix sum over the lengths.  A part begins
    with the first piece at or after a multiple of ``part_bytes``, so it is no longer
    than that and one piece.  The writer ends every row with a newline; the last
    piece, which has none, is written by itself, with its last character in the
    newline's place.  Keys are unique integers; a null text is an empty piece."""
    t = pieces.select(F.col(key).cast("long").alias("k"), F.coalesce("text", F.lit("")).alias("text"))
    last = t.agg(F.max_by(F.struct("k", F.substring("text", -1, 1).alias("end")), "k").alias("x")).first()["x"]
    if last is None:  # no pieces: an empty file
        t.select(F.lit("0").alias("part"), "text").write.mode("overwrite").partitionBy("part").text(path)
        return
    starts = prefix_sum(t.select("k", (F.octet_length("text") + 1).alias("n")), "k", "n", "start")
    part = F.floor(F.col("start") / part_bytes)
    borders = [r["k"] for r in starts.groupBy(part.alias("part")).agg(F.min("k").alias("k")).orderBy("part").collect()]  # one a part
    digits = len(str(len(borders)))
    name = lambda c: F.lpad(c.cast("string"), digits, "0").alias("part")
    body = t.filter(F.col("k") < last["k"]).select("k", "text", name(place(F.col("k") + 1, borders) - 1))
    # sorted by the folder first, as the writer wants it, so that it does not sort again
    (body.repartition("part").sortWithinPartitions("part", "k").select("part", "text")
         .write.mode("overwrite").partitionBy("part").text(path))
    if last["end"]:
        tail = t.filter(F.col("k") == last["k"]).select(name(F.lit(len(borders))), F.expr("substring(text, 1, length(text) - 1)").alias("text"))
        tail.coalesce(1).write.mode("append").partitionBy("part").option("lineSep", last["end"]).text(path)


def tokenizer_json(vocab: DataFrame, merges: DataFrame) -> DataFrame:
    """SNK-02 payload: one row holding ``{type, vocab, merges, vocab_size}``
    as JSON (non-ASCII kept).  Built by two bounded aggregates."""
    v = vocab.agg(F.map_from_entries(F.collect_list(F.struct("token", "id"))).alias("vocab"),
                  F.count(F.lit(1)).alias("vocab_size"))
    m = merges.agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "left", "right"))),
                               lambda s: F.array(s["left"], s["right"])).alias("merges"))
    j = v.crossJoin(m)  # two one-row frames
    return j.select(F.to_json(F.struct(F.lit("subword").alias("type"), "vocab", "merges", "vocab_size"))
                    .alias("value"))


def write_tokenizer(vocab: DataFrame, merges: DataFrame, path: str) -> None:
    tokenizer_json(vocab, merges).coalesce(1).write.mode("overwrite").text(path)


def check_uint16(tokens: DataFrame, ids_col: str = "ids") -> DataFrame:
    """Fail the job when an id does not fit the uint16 token files."""
    bad = F.exists(ids_col, lambda x: (x < 0) | (x > UINT16_MAX))
    return tokens.withColumn(ids_col, F.when(bad, F.raise_error(
        F.lit("token id outside 0..65535 cannot be stored as uint16"))).otherwise(F.col(ids_col)))


def write_tokens(tokens: DataFrame, path: str, ids_col: str = "ids") -> None:
    """SNK-03: token lists as parquet with the uint16 range enforced."""
    check_uint16(tokens, ids_col).write.mode("overwrite").parquet(path)


LOG_SCHEMA = "step long, train_loss double, val_loss double, lr double, time double, perplexity double"


def write_log(lines: DataFrame, path: str) -> None:
    """SNK-04: metric lines ``(run_id, step, line)`` appended to a CSV log, a
    folder per run; every file carries the header."""
    cell = F.split("line", ",")
    names = [c.split()[0] for c in LOG_SCHEMA.split(", ")]
    (lines.select("run_id", *[F.get(cell, F.lit(i)).alias(c) for i, c in enumerate(names)])
          .write.mode("append").partitionBy("run_id").option("header", "true").csv(path))


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """The rows of a log written by ``write_log``, with its ``run_id``."""
    return spark.read.option("header", "true").schema(f"{LOG_SCHEMA}, run_id long").csv(path)
