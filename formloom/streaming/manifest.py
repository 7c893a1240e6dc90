"""Resume as a stream: new files of a folder are work, a checkpoint is the set of what is done."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from formloom.operators.manifest import last_wins

MANIFEST = "seq long, rel_path string, fingerprint string, status string, seconds double"


def manifest_stream(spark: SparkSession, folder: str, files_per_trigger: int = 100, schema: str = MANIFEST) -> DataFrame:
    """Rows of the JSON files of a folder as they come; files_per_trigger bounds a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).json(folder)


def first_seen(rows: DataFrame, keys: list[str], time: str | None = None, lateness: str | None = None) -> DataFrame:
    """A2 on a stream: the first row of each key; with a time and a lateness the state is bounded."""
    return rows.dropDuplicates(keys) if time is None else rows.withWatermark(time, lateness).dropDuplicatesWithinWatermark(keys)


BUCKETS = 64


def bucket_of(keys: list[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def bucket_paths(spark: SparkSession, table_path: str, below: int | None = None) -> dict[int, list[str]]:
    """The folders of each bucket, the newest first, of whole versions (below a number). Names only: versions times buckets."""
    path = spark._jvm.org.apache.hadoop.fs.Path(table_path)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    found: dict[int, list[tuple[int, str]]] = {}
    for status in fs.listStatus(path) if fs.exists(path) else []:
        name = status.getPath().getName()
        whole = fs.exists(spark._jvm.org.apache.hadoop.fs.Path(status.getPath(), "_SUCCESS"))
        if name.startswith("version=") and whole and (below is None or int(name[8:]) < below):
            for part in fs.listStatus(status.getPath()):
                if part.getPath().getName().startswith("bucket="):
                    found.setdefault(int(part.getPath().getName()[7:]), []).append((int(name[8:]), part.getPath().toString()))
    return {b: [p for _, p in sorted(places, reverse=True)] for b, places in found.items()}


def upsert_latest(rows: DataFrame, table_path: str, checkpoint: str, keys: list[str], order: str, buckets: int = BUCKETS) -> StreamingQuery:
    """A1 on a stream: a table of the last row of each key, in buckets of keys.

    A batch reads and writes only the buckets that its keys fall into, as a version named by its number: done again after
    a failure, it reads what it read before and writes the same. Of each bucket the two newest versions are
    kept, as the last batch may be done again. latest_version() reads the newest of each.
    """

    def put(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        parted = batch.withColumn("bucket", bucket_of(keys, buckets))
        touched = {r.bucket for r in parted.select("bucket").distinct().collect()}
        before = [places[0] for b, places in bucket_paths(spark, table_path, number).items() if b in touched]
        both = batch if not before else spark.read.schema(batch.schema).parquet(*before).unionByName(batch)
        latest = last_wins(both, keys, order).select(*batch.columns).withColumn("bucket", bucket_of(keys, buckets))
        latest.repartition("bucket").write.mode("overwrite").partitionBy("bucket").parquet(f"{table_path}/version={number}")
        fs = spark._jvm.org.apache.hadoop.fs.Path(table_path).getFileSystem(spark._jsc.hadoopConfiguration())
        for b, places in bucket_paths(spark, table_path).items():
            for old in places[2:] if b in touched else ():
                fs.delete(spark._jvm.org.apache.hadoop.fs.Path(old), True)

    return rows.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_version(spark: SparkSession, table_path: str, schema: str = MANIFEST) -> DataFrame:
    """The table that upsert_latest keeps: the newest version of each bucket."""
    newest = [places[0] for places in bucket_paths(spark, table_path).values()]
    return spark.read.schema(schema).parquet(*newest) if newest else spark.createDataFrame([], schema)


def resume(work: DataFrame, done_path: str, checkpoint: str, keys: list[str], process: Callable[[DataFrame], DataFrame], buckets: int = BUCKETS) -> StreamingQuery:
    """Processes what isn't done yet, batch by batch, and writes what process() gives, as JSON in buckets of keys.

    A batch reads what batches before it did of its own buckets only, and writes a folder of its number: done again after a
    failure, it takes the same work and overwrites what it had written. A key is done when a row of it is ok.
    """

    def put(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        todo = batch.dropDuplicates(keys).withColumn("bucket", bucket_of(keys, buckets))
        touched = {r.bucket for r in todo.select("bucket").distinct().collect()}
        before = [p for b, places in bucket_paths(spark, done_path, number).items() if b in touched for p in places]
        if before:
            types = ", ".join(f"`{k}` {batch.schema[k].dataType.simpleString()}" for k in keys)
            todo = todo.join(spark.read.schema(f"{types}, status string").json(before).where("status = 'ok'").select(*keys).distinct(), keys, "left_anti")
        out = process(todo.select(*batch.columns)).withColumn("bucket", bucket_of(keys, buckets))
        out.write.mode("overwrite").partitionBy("bucket").json(f"{done_path}/version={number}")

    return work.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
