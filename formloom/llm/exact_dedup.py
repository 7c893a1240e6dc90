"""Exact deduplication over an extendible-hash index.

The index has a directory of 2**depth slots, addressed by the leading bits of a text's hash. A bucket that holds more
distinct keys than its capacity is split: its local depth grows by one bit, and the directory doubles when a bucket
needs more bits than it has. Slot counts come from one aggregate, so all the doublings are resolved at once.

Entries are written to shared files, one owner task a bucket. Texts of one key form a chain within the bucket: the
owner sorts them and compares neighbours byte by byte, so that each link of a chain is one text with its size and
the id that stays. Only texts whose key occurs twice are sent to an owner, summed in each task first; a key
that occurs once is an entry without a text. A row then finds its entry by bucket and key, and where the chain has
several links, by the bytes of its text.

DataFrame functions only: no Python runs on the executors.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from formloom.llm.shared import Scratch, cut

CELL_BITS = 16  # leading bits that slot counts are first taken by; more where a bucket of so many is overfull
BROADCAST_BITS = 16  # a directory of up to so many bits is broadcast, a deeper one is joined by shuffle
BROADCAST_KEYS = 1_000_000  # keys of eight bytes that may be broadcast
SALTS = 64  # parts in which the copies of one text are summed before they meet at its owner


def hash_key(text: Column, hash_bits: int = 64) -> Column:
    """64-bit hash of a text; fewer bits force collisions, for tests of the chains."""
    key = F.xxhash64(text)
    return key if hash_bits == 64 else key.bitwiseAND(F.lit((1 << hash_bits) - 1))


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def slot_of(key: Column, depth: int) -> Column:
    """Directory slot: the leading bits of the mixed key (depth 0: the only slot)."""
    return F.shiftrightunsigned(F.xxhash64(key), 64 - depth) if depth else F.lit(0).cast("long")


def directory(keys: DataFrame, bucket_capacity: int, cell_bits: int = CELL_BITS) -> tuple[DataFrame, int]:
    """(slot, bucket, local_depth) of every directory slot, and the global depth, for the distinct keys of a table.

    The depth is the first at which no bucket is overfull; where cell_bits are too few, slots are counted by more. A
    bucket holds its capacity at most, whatever the input, as distinct keys differ in some bit.
    """
    bits = cell_bits
    while True:
        cells = cut(keys.groupBy(slot_of(F.col("key"), bits).alias("cell")).agg(F.count("*").alias("n")))
        by_depth = cells.select(F.explode(F.sequence(F.lit(0), F.lit(bits))).alias("depth"), "cell", "n")
        by_depth = by_depth.groupBy("depth", F.expr(f"shiftright(cell, {bits} - depth)").alias("slot")).agg(F.sum("n").alias("n"))
        fitting = by_depth.groupBy("depth").agg(F.max("n").alias("most")).where(F.col("most") <= bucket_capacity).agg(F.min("depth")).first()[0]
        if fitting is not None or cells.isEmpty() or bits >= 60:
            break
        bits += 4
    depth = fitting or 0
    filled = cells.groupBy(F.shiftright("cell", bits - depth).alias("slot")).agg(F.sum("n").alias("n"))
    slots = keys.sparkSession.range(1 << depth).select(F.col("id").alias("slot")).join(filled, "slot", "left").fillna(0, ["n"])
    # the smallest local depth at which the slot's bucket fits
    local = F.lit(depth)
    for d in range(depth):
        slots = slots.withColumn(f"fits_{d}", F.sum("n").over(W.partitionBy(F.shiftright("slot", depth - d))) <= bucket_capacity)
    for d in range(depth - 1, -1, -1):
        local = F.when(F.col(f"fits_{d}"), F.lit(d)).otherwise(local)
    slots = slots.withColumn("local_depth", local)
    bucket = F.expr(f"shiftleft(shiftright(slot, {depth} - local_depth), {depth} - local_depth)")
    return slots.select("slot", bucket.alias("bucket"), "local_depth"), depth


def placed(rows: DataFrame, slots: DataFrame, depth: int) -> DataFrame:
    """Rows with a key, and the bucket that the directory names for it."""
    if depth == 0:
        return rows.withColumns({"bucket": F.lit(0).cast("long"), "local_depth": F.lit(0)})
    sized = F.broadcast(slots) if depth <= BROADCAST_BITS else slots
    return rows.withColumn("slot", slot_of(F.col("key"), depth)).join(sized, "slot").drop("slot")


def build_index(docs: DataFrame, path: str, scratch: Scratch, bucket_capacity: int = 100_000, hash_bits: int = 64) -> tuple[DataFrame, DataFrame, int]:
    """Writes the index of the texts in (doc_id, text) to path; returns it with its directory and depth.

    One row per distinct text: bucket, local_depth, key, chain (place among the texts of that key), links (how many
    these are), keep_id (largest doc_id), group_size and, where links > 1, the text.
    """
    rows = docs.select("doc_id", "text", hash_key(F.col("text"), hash_bits).alias("key"))
    built = Scratch(docs.sparkSession)
    keys = built.written(rows.groupBy("key").agg(F.count("*").alias("n"), F.max("doc_id").alias("keep_id")), "keys")
    slots, depth = directory(keys, bucket_capacity)
    slots = scratch.written(slots, "directory")
    names = ["bucket", "local_depth", "key", "chain", "links", "keep_id", "group_size", "text"]
    single = placed(keys.where("n = 1"), slots, depth)
    single = single.withColumns({"chain": F.lit(1).cast("long"), "links": F.lit(1).cast("long"), "group_size": F.col("n"), "text": F.lit(None).cast("string")})
    twice = keys.where("n > 1").select("key")
    twice = F.broadcast(twice) if twice.count() <= BROADCAST_KEYS else twice
    # a text's copies are summed in SALTS parts, which its owner tells to be one text by their bytes
    salt = F.pmod(F.spark_partition_id(), F.lit(SALTS)).alias("salt")
    parts = rows.join(twice, "key", "left_semi").groupBy("key", "text", salt).agg(F.max("doc_id").alias("part_id"), F.count("*").alias("part_size"))
    owned = placed(parts, slots, depth).repartition("bucket", "key")
    chain = W.partitionBy("bucket", "key").orderBy("text")
    owned = owned.withColumn("other", F.coalesce(F.col("text") != F.lag("text").over(chain), F.lit(True)).cast("int"))
    owned = owned.withColumn("chain", F.sum("other").over(chain.rowsBetween(W.unboundedPreceding, 0)))
    links = owned.groupBy("bucket", "local_depth", "key", "chain").agg(F.max("part_id").alias("keep_id"), F.sum("part_size").alias("group_size"), F.first("text").alias("text"))
    links = links.withColumn("links", F.count("*").over(W.partitionBy("bucket", "key")))
    links = links.withColumn("text", F.when(F.col("links") > 1, F.col("text")))
    single.select(*names).unionByName(links.select(*names)).write.parquet(path)
    built.drop()
    return docs.sparkSession.read.parquet(path), slots, depth


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", bucket_capacity: int = 100_000, hash_bits: int = 64) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256, bucket, chain.

    Texts are equal when their bytes are; the row with the largest id stays. A null text counts as empty. A
    null id sorts below every other and stays only in a group that has no other id. Rows that repeat an id
    and its text are each returned, and each counts in group_size; of those, all that carry the kept id are
    marked kept. A very long text is a row like any other. Other columns are ignored, whatever their names; an
    empty table gives no rows.
    """
    return _found(docs, id_column, text_column, bucket_capacity, hash_bits, Scratch(docs.sparkSession)).drop("key")


def _found(docs: DataFrame, id_column: str, text_column: str, bucket_capacity: int, hash_bits: int, scratch: Scratch) -> DataFrame:
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column), F.lit("")).alias("text"))
    path = scratch.path("exact_index")
    index, slots, depth = build_index(rows, path, scratch, bucket_capacity, hash_bits)
    index = index.drop("local_depth")
    probes = rows.select("doc_id", hash_key(F.col("text"), hash_bits).alias("key"), sha256(F.col("text")).alias("text_sha256"))
    # the directory is read here too: a row is looked for in the bucket that it names
    probes = placed(probes, slots, depth).drop("local_depth")
    names = ["doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256", "bucket", "chain", "key"]
    found = probes.join(index.where("links = 1").drop("text"), ["bucket", "key"]).select(*names)
    chained = index.where("links > 1")
    if not chained.isEmpty():
        again = placed(rows.withColumn("key", hash_key(F.col("text"), hash_bits)), slots, depth).drop("local_depth")
        again = again.join(chained, ["bucket", "key", "text"]).withColumn("text_sha256", sha256(F.col("text")))
        found = found.unionByName(again.select(*names))
    return found


def keep_distinct(docs: DataFrame) -> DataFrame:
    """The rows of documents that exact_dedup keeps, with all their columns.

    Of rows that repeat the kept id with the same text one stays, whatever their other columns, and a null text is an
    empty one; such rows are looked for first, as the usual table has none and needs no further shuffle. Column
    names may be any: a row goes through as one struct.
    """
    name = ["doc_id", "text_sha256"]
    scratch = Scratch(docs.sparkSession)
    marked = _found(docs, "doc_id", "text", 100_000, 64, scratch).groupBy(*name, "kept").agg(F.count("*").alias("n"))
    marked = scratch.written(marked, "marked", keep=True)
    scratch.drop()
    # ids may be null: a join on two columns that are never null
    own = [F.coalesce("doc_id", F.lit(0)).alias("own_id"), F.concat("text_sha256", F.when(F.col("doc_id").isNull(), F.lit("-")).otherwise(F.lit(""))).alias("own_text")]
    gone = marked.where("not kept").select(*own)
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), sha256(F.coalesce("text", F.lit(""))).alias("text_sha256"))
    rows = rows.select("row", *own).join(gone, ["own_id", "own_text"], "left_anti")
    again = marked.where("kept and n > 1").select(*own)
    if not again.isEmpty():
        key = ["own_id", "own_text"]
        rows = rows.join(again, key, "left_anti").unionByName(rows.join(again, key, "left_semi").dropDuplicates(key))
    return rows.select("row.*")
