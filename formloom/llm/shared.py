"""Shared folder, sizing and normalisation helpers of the training-data operators."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir, else (tests only) a fresh temporary one."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        folder = current.get() if current.isDefined() else None
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='formloom-')}"
    if not spark.sparkContext._jsc.sc().getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other call uses."""
    return f"{shared_dir(spark)}/formloom-{uuid.uuid4().hex}/{name}"


def cut(df: DataFrame) -> DataFrame:
    """Cuts the lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Cuts the lineage with a Parquet table in the shared folder."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """The tables that one operator writes in the shared folder; drop() removes those that its result doesn't read."""

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def path(self, name: str) -> str:
        """A path that drop() removes."""
        self.paths.append(scratch_path(self.spark, name))
        return self.paths[-1]

    def written(self, df: DataFrame, name: str, keep: bool = False) -> DataFrame:
        """As written(); a table that is kept stays after drop()."""
        path = scratch_path(self.spark, name) if keep else self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self) -> None:
        """Call it when no plan that is still to run reads the tables: tasks of lost executors are then never run again from them."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        for path in self.paths:
            place = jvm.org.apache.hadoop.fs.Path(path).getParent()
            place.getFileSystem(conf).delete(place, True)
        self.paths = []


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))
