"""Sharding by fixed virtual slots (operator 2), with DataFrame functions only.

A record's hash gives one of ``n_slots`` virtual slots for good; only the map
from slots to shards changes.  The map is a small versioned table: version 1
deals the slots round robin, ``rebalance`` makes the next version by moving and
swapping as few slots as it takes to even out the shards' bytes.  ``write_shards``
writes whole records, all columns, in one folder per shard under the newest stored
version, after editing it if its shards are uneven; ``placed`` reads the files back.

Only the bytes of each slot come to the driver (``n_slots`` rows, whatever the
input), and only the map (as many rows) is broadcast.  A hot source or a large
group of copies is spread, since the hash takes the id, the text's checksum, a hash
of the whole record and the ordinal among equal records; ordinals are dealt in blocks, so
no task lists more than ``RUN`` copies of one record.

A row's place in its shard is its slot's place among the shard's slots plus its
rank in the slot, so no task ranks more than one virtual slot.

Defined results.  A null text has size 1 and checksum 0, as an empty one.  A
null id is an id like any other.  A very long text is one record and weighs what it has.  Repeated rows
are all kept, each in a slot of its own ordinal.  Ties in a slot are broken by id, checksum and ordinal.  An
empty table gives no rows.  Other columns are kept; those named as one of ``OWN`` come back as they were, since
the record is stored as one struct.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

N_SHARDS = 8
N_SLOTS = 4096

SlotMap = dict[int, int]


RUN = 4096  # copies of one record that a task lists at a time
OWN = ["doc_id", "size", "text_crc32", "row_hash", "nth", "vslot"]


def _counted(docs: DataFrame, kept: list) -> DataFrame:
    """``kept`` and the key of every row, once per distinct value, with ``nth`` of each copy."""
    text = F.coalesce(F.col("text"), F.lit(""))
    key = ["doc_id", "size", "text_crc32", "row_hash"]
    d = docs.select(F.col("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"),
                    F.crc32(text.cast("binary")).alias("text_crc32"),
                    F.xxhash64(F.struct(*[F.col(f"`{c}`") for c in docs.columns])).alias("row_hash"), *kept)
    # repeated rows are counted, not ranked: one row a task however many there are
    same = d.groupBy(*d.columns).agg(F.count(F.lit(1)).alias("n"))
    runs = same.withColumn("first", F.explode(F.expr(f"sequence(1L, n, {RUN}L)")))
    many = F.col("n") > RUN
    spread = runs.filter(many).repartition(*key, "first")
    each = runs.filter(~many).unionByName(spread).withColumn(
        "nth", F.explode(F.expr(f"sequence(first, least(n, first + {RUN - 1}L))"))).drop("n", "first")
    return each


def records(docs: DataFrame, n_slots: int = N_SLOTS, kept: list | None = None) -> DataFrame:
    """``(doc_id, size, text_crc32, row_hash, nth, vslot)`` of every row, and the columns ``kept``."""
    slot = F.pmod(F.xxhash64("doc_id", "text_crc32", "row_hash", "nth"), F.lit(n_slots)).cast("int")
    return _counted(docs, kept or []).withColumn("vslot", slot)


def slot_bytes(recs: DataFrame) -> DataFrame:
    return recs.groupBy("vslot").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows"))


def first_map(n_slots: int = N_SLOTS, n_shards: int = N_SHARDS) -> SlotMap:
    """Version 1: slots dealt round robin."""
    return {v: v % n_shards for v in range(n_slots)}


def rebalance(slot_map: SlotMap, size: dict[int, int], n_shards: int = N_SHARDS) -> SlotMap:
    """The next version.  While it lowers the spread, the slot that best halves
    the gap moves from the fullest shard to the emptiest, or is swapped with one
    of its slots.  ``n_shards`` may differ from the map's: slots of shards that
    are gone move first."""
    new = dict(slot_map)
    load = [0] * n_shards
    held: list[set[int]] = [set() for _ in range(n_shards)]
    for v, s in sorted(new.items()):
        if s < n_shards:
            load[s] += size.get(v, 0)
            held[s].add(v)
    for v, s in sorted(new.items(), key=lambda x: (-size.get(x[0], 0), x[0])):
        if s >= n_shards:
            to = min(range(n_shards), key=lambda i: (load[i], i))
            new[v], load[to] = to, load[to] + size.get(v, 0)
            held[to].add(v)
    for _ in range(4 * len(new)):
        hi = max(range(n_shards), key=lambda i: (load[i], -i))
        lo = min(range(n_shards), key=lambda i: (load[i], i))
        gap = load[hi] - load[lo]
        options = [(abs(gap - 2 * size.get(v, 0)), v, -1) for v in held[hi] if 0 < size.get(v, 0) < gap]
        small = sorted(held[lo], key=lambda v: (size.get(v, 0), v))[:64]
        options += [(abs(gap - 2 * (size.get(v, 0) - size.get(w, 0))), v, w) for v in held[hi] for w in small
                    if 0 < size.get(v, 0) - size.get(w, 0) < gap]
        if not options or min(options)[0] >= gap:
            break
        _, v, w = min(options)
        for x, a, b in ((v, hi, lo), (w, lo, hi)):
            if x >= 0:
                held[a].remove(x)
                held[b].add(x)
                load[a] -= size.get(x, 0)
                load[b] += size.get(x, 0)
                new[x] = b
    return new


def map_table(spark: SparkSession, versions: dict[int, SlotMap]) -> DataFrame:
    """``(version, vslot, shard)``: all versions side by side."""
    rows = [(n, v, s) for n, m in sorted(versions.items()) for v, s in sorted(m.items())]
    return spark.createDataFrame(rows, "version int, vslot int, shard int")


def write_map(spark: SparkSession, versions: dict[int, SlotMap], path: str) -> None:
    map_table(spark, versions).coalesce(1).write.mode("overwrite").partitionBy("version").parquet(path)


def read_map(spark: SparkSession, path: str, version: int | None = None) -> SlotMap:
    """A stored version, by default the newest."""
    d = spark.read.parquet(path)
    if version is None:
        version = d.agg(F.max("version")).first()[0]
    return {r["vslot"]: r["shard"] for r in d.filter(F.col("version") == version).collect()}


def assign(recs: DataFrame, slot_map: SlotMap) -> DataFrame:
    """``recs`` with ``shard`` and ``slot``, the row's place in its shard
    (gapless from 0)."""
    spark = recs.sparkSession
    rows = {r["vslot"]: r["rows"] for r in slot_bytes(recs).collect()}  # n_slots rows at most
    base, held = {}, {}
    for v in sorted(slot_map):
        base[v] = held.get(slot_map[v], 0)
        held[slot_map[v]] = base[v] + rows.get(v, 0)
    placed = spark.createDataFrame([(v, s, base[v]) for v, s in sorted(slot_map.items())],
                                   "vslot int, shard int, __base long")
    rank = F.row_number().over(Window.partitionBy("vslot").orderBy("doc_id", "text_crc32", "size", "row_hash", "nth"))
    return (recs.withColumn("__rank", rank).join(F.broadcast(placed), "vslot")  # n_slots rows
            .withColumn("slot", (F.col("__base") + F.col("__rank") - 1).cast("long")).drop("__base", "__rank"))


def shard_by_bytes(docs: DataFrame, n_shards: int = N_SHARDS, n_slots: int = N_SLOTS) -> tuple[DataFrame, dict]:
    """The assignment under version 2 of the map (version 1 rebalanced by the
    measured bytes), and both versions."""
    recs = records(docs, n_slots).checkpoint()
    size = {r["vslot"]: r["bytes"] for r in slot_bytes(recs).collect()}
    versions = {1: first_map(n_slots, n_shards)}
    versions[2] = rebalance(versions[1], size, n_shards)
    return assign(recs, versions[2]), versions


def stored_versions(spark: SparkSession, path: str) -> dict[int, SlotMap]:
    """All versions of a stored map; none where nothing is stored yet."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not where.getFileSystem(spark._jsc.hadoopConfiguration()).exists(where):
        return {}
    versions: dict[int, SlotMap] = {}
    for r in spark.read.parquet(path).collect():  # n_slots rows a version
        versions.setdefault(r["version"], {})[r["vslot"]] = r["shard"]
    return versions


def edit_map(spark: SparkSession, path: str, size: dict[int, int], n_shards: int = N_SHARDS, n_slots: int = N_SLOTS) -> int:
    """Read the stored map, rebalance its newest version by the measured bytes and store the
    outcome as the next one.  A map that is not there starts with version 1; one that needs no
    move stays.  Returns the version to use.  A version is a folder of its own, and stored ones are not touched."""
    versions = stored_versions(spark, path)
    if not versions:
        versions[1] = first_map(n_slots, n_shards)
        write_version(spark, versions[1], 1, path)
    newest = max(versions)
    new = rebalance(versions[newest], size, n_shards)
    if new == versions[newest]:
        return newest
    write_version(spark, new, newest + 1, path)
    return newest + 1


def write_version(spark: SparkSession, slot_map: SlotMap, version: int, path: str) -> None:
    map_table(spark, {version: slot_map}).drop("version").coalesce(1).write.mode("overwrite").parquet(f"{path}/version={version}")


def write_shards(docs: DataFrame, path: str, n_shards: int = N_SHARDS, n_slots: int = N_SLOTS) -> int:
    """Write every record, all columns (as struct ``record``), to ``path/files/shard=...``, by the map stored at
    ``path/map``, which is edited first; returns its version.  Files of an earlier run are replaced."""
    spark = docs.sparkSession
    size = {r["vslot"]: r["bytes"] for r in slot_bytes(records(docs, n_slots)).collect()}
    version = edit_map(spark, f"{path}/map", size, n_shards, n_slots)
    record = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record")
    slots = spark.read.parquet(f"{path}/map").filter(F.col("version") == version).select("vslot", "shard")
    whole = records(docs, n_slots, [record]).join(F.broadcast(slots), "vslot")  # n_slots rows
    whole.write.mode("overwrite").partitionBy("shard").parquet(f"{path}/files")
    return version


def placed(spark: SparkSession, path: str, version: int) -> DataFrame:
    """``OWN``, ``shard`` and ``slot`` of every written record, from the files (their texts are not read)."""
    recs = spark.read.parquet(f"{path}/files").select(*OWN, F.col("shard").alias("in_shard"))
    return (assign(recs, read_map(spark, f"{path}/map", version))
            .withColumn("shard", F.col("in_shard").cast("int")).drop("in_shard"))
