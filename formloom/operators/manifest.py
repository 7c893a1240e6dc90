"""Manifests, resume and work items (A1, A2, J3, TF3, TF4, W5, A23, A24)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def last_wins(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """A1: the row of each key that comes last; summed before the shuffle, so no sort of a key's rows."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), order).alias("r")).select(*keys, "r.*")


def first_wins(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """A2: the row of each key that comes first."""
    rest = [c for c in rows.columns if c not in keys]
    return rows.groupBy(*keys).agg(F.min_by(F.struct(*rest), order).alias("r")).select(*keys, "r.*")


def done_set(manifest: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that a run need not do again: those of status ok."""
    return manifest.where("status = 'ok'").select(*keys).distinct()


def pending(inputs: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Inputs that aren't done."""
    return inputs.join(done.select(*keys).distinct(), keys, "left_anti")


def split_pending(inputs: DataFrame, manifest: DataFrame, keys: list[str], require_ok: bool = False) -> DataFrame:
    """TF4, Q18: inputs with `action`: skipped where the embedded fingerprint fits, or the manifest has the key and the output is there.

    inputs: keys, embedded_fingerprint, fingerprint, output_exists.
    """
    known = manifest.where("status = 'ok'") if require_ok else manifest
    seen = known.select(*keys).distinct().withColumn("seen", F.lit(True))
    out = inputs.join(seen, keys, "left")
    skip = (F.col("embedded_fingerprint") == F.col("fingerprint")) | (F.coalesce("seen", F.lit(False)) & F.col("output_exists"))
    return out.withColumn("action", F.when(F.coalesce(skip, F.lit(False)), F.lit("skipped")).otherwise(F.lit("pending"))).drop("seen")


def odd_pages(files: DataFrame, n_pages: str) -> DataFrame:
    """TF3: a row per odd page, counted from 1."""
    return files.where(F.col(n_pages) >= 1).withColumn("page_num", F.explode(F.sequence(F.lit(1), F.col(n_pages), F.lit(2))))


def first_files_and_pages(items: DataFrame, file: str, page: str, n_files: int, n_pages: int) -> DataFrame:
    """Items of the first n files, and of those the first n pages. Files are ranked after they are made distinct."""
    files = items.select(file).distinct().orderBy(file).limit(n_files)
    return items.join(F.broadcast(files), file, "left_semi").orderBy(file, page).limit(n_pages)


def status_counts(rows: DataFrame) -> DataFrame:
    """Counts of ok, skipped and error; one row."""
    return rows.agg(F.count("*").alias("total"), *(F.count_if(F.col("status") == s).alias(f"n_{s}") for s in ("ok", "skipped", "error")))


def timing_totals(rows: DataFrame, key: str, steps: list[str]) -> DataFrame:
    """Total of each step and its mean a page (pages: at least 1)."""
    return rows.groupBy(key).agg(*(F.sum(c).alias(f"{c}_total") for c in steps), *((F.sum(c) / F.greatest(F.lit(1), F.count("*"))).alias(f"{c}_per_page") for c in steps))


def run_summary(rows: DataFrame, seconds: str) -> DataFrame:
    """SK5: the summary row of a run."""
    return rows.agg(F.lit("run_summary").alias("row_type"), F.count("*").alias("total"), F.count_if(F.col("status") == "ok").alias("ok"), F.count_if(F.col("status") == "error").alias("errors"), F.count_if(F.col("status") == "skipped").alias("skipped"), F.sum(seconds).alias("seconds"))


def matched_latest(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """SC10: last row of each key among those of status ok and a key that isn't empty."""
    good: Column = F.col("status") == "ok"
    for k in keys:
        good = good & F.col(k).isNotNull() & (F.col(k).cast("string") != "")
    return last_wins(rows.where(good), keys, order)
