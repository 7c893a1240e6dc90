"""Pages to documents (W1, W13, A25, J8, J9, IM17)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def segment_pages(pages: DataFrame, file: str, page: str, logo: str, least_pages: int = 3) -> DataFrame:
    """Adds is_first and document_id to pages.

    Page 0 begins a document, and so does every other page of a run of logo pages: the successor of a first page
    isn't looked at. Runs are islands of consecutive ranks, so all is windows over one sort of a file's pages.
    Files below least_pages are one document.
    """
    w = W.partitionBy(file).orderBy(page)
    ranked = pages.withColumn("rank", F.row_number().over(w) - 1).withColumn("n_pages", F.count("*").over(W.partitionBy(file)))
    ranked = ranked.withColumn("mark", F.col(logo) | (F.col("rank") == 0))
    ranked = ranked.withColumn("island", F.sum(F.when(F.col("mark"), 0).otherwise(1)).over(w.rowsBetween(W.unboundedPreceding, 0)))
    place = F.row_number().over(W.partitionBy(file, "island", "mark").orderBy(page)) - 1
    first = F.when(F.col("n_pages") < least_pages, F.col("rank") == 0).otherwise(F.col("mark") & (place % 2 == 0))
    out = ranked.withColumn("is_first", first)
    return out.withColumn("document_id", F.sum(F.col("is_first").cast("int")).over(w.rowsBetween(W.unboundedPreceding, 0)) - 1).drop("rank", "n_pages", "mark", "island")


def segment_fold(flags, min_gap: int = 1):
    """W1 for any gap, over an array of logo flags in page order: array of whether each page begins a document."""
    start = F.struct(F.lit(-1).alias("i"), F.lit(0).alias("last"), F.lit(False).alias("skip"), F.array().cast("array<boolean>").alias("out"))

    def step(a, flag):
        i = a["i"] + 1
        first = (i == 0) | (~a["skip"] & flag & (i - a["last"] > min_gap))
        return F.struct(i.alias("i"), F.when(first, i).otherwise(a["last"]).alias("last"), first.alias("skip"), F.concat(a["out"], F.array(first)).alias("out"))

    return F.aggregate(flags, start, step, lambda a: a["out"])


def document_pages(pages: DataFrame, file: str, page: str) -> DataFrame:
    """The pages of each document, in order."""
    return pages.groupBy(file, "document_id").agg(F.array_sort(F.collect_list(page)).alias("pages"))


def document_sizes(pages: DataFrame, file: str, page: str) -> DataFrame:
    return pages.groupBy(file, "document_id").agg(F.count("*").alias("n_pages"), F.min(page).alias("first_page"), F.max(page).alias("last_page"))


def single_document(pages: DataFrame, page: str, height: str) -> DataFrame:
    """Zones of files of one document: page 0 has fields and a table in its lower half, others a table."""
    first = F.col(page) == 0
    return pages.select("*", F.lit(0).alias("document_id"), first.alias("has_fields"), F.lit(True).alias("has_table"), F.when(first, F.bround(0.5 * F.col(height)).cast("int")).otherwise(F.lit(0)).alias("table_y0"), F.col(height).alias("table_y1"))


def with_ocr(regions: DataFrame, results: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Regions with what was read of them; '' and 0.0 where nothing was. keys: what names a region, beside its id."""
    keys = keys or ["region_id"]
    return regions.join(results.select(*keys, "text", "confidence"), keys, "left").fillna({"text": "", "confidence": 0.0})


def regions_to_documents(regions: DataFrame, pages: DataFrame, file: str, page: str) -> DataFrame:
    """Regions with the document of their page."""
    return regions.join(pages.select(file, page, "document_id"), [file, page])


def fields_band(pages: DataFrame, least: int = 40, margin: int = 20) -> DataFrame:
    """IM17: band of the fields: between the anchors if that is high enough, else from below the head to the table."""
    anchored = F.col("end_y") - F.col("begin_y") > least
    below, above = F.coalesce("logo_bottom", "header_bottom") + margin, F.col("table_top") - margin
    return pages.select("*", F.when(anchored, F.col("begin_y")).otherwise(below).alias("band_y0"), F.when(anchored, F.col("end_y")).otherwise(above).alias("band_y1"))
