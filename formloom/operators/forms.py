"""Forms from page images to validated results: classification, documents, crops, OCR, structure.

Pixels are read twice, each time a page at a time: once to classify pages, once to cut out regions when it is known which
document a page belongs to. All between and after is relational.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from formloom.functions import text as T
from formloom.operators import manifest, segment, validate, vision
from formloom.operators.vision import Template


@dataclass(frozen=True)
class Layout:
    """What pages look like. Without a logo a file is one document, whose first page has the fields."""

    logo: Template | None = None
    logo_threshold: float = 0.7
    logo_scales: tuple[float, ...] = (1.0,)
    anchors: tuple[tuple[Template, Template], ...] = field(default_factory=tuple)
    anchor_scales: tuple[float, ...] = (1.0,)
    table_from: float = 0.5  # where the table of a first page may begin
    header_rows: int = 1
    column: int | None = None  # the table's column that is read; none: the last
    need_dots: bool = True
    band_least: int = 40
    band_margin: int = 20
    search: int = 21  # window of the denoiser


PIXELS = ("rel_path", "page_num", "height", "width", "channels", "pixels")
CLASSES = "rel_path string, page_num int, height int, width int, logo boolean, confidence double, logo_bottom int, begin_y int, end_y int"
CLASS_SCHEMA = pa.schema([("rel_path", pa.string()), ("page_num", pa.int32()), ("height", pa.int32()), ("width", pa.int32()), ("logo", pa.bool_()), ("confidence", pa.float64()), ("logo_bottom", pa.int32()), ("begin_y", pa.int32()), ("end_y", pa.int32())])


def classified(pages: DataFrame, layout: Layout) -> DataFrame:
    """IM14, IM15: per page whether it bears the logo, how far that reaches, and the band between the anchors (0, 0 without)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                image = vision.image_of(r)
                hit = vision.detect_logo(image, layout.logo.at(), layout.logo_threshold, list(layout.logo_scales)) if layout.logo else {"detected": False, "confidence": 0.0}
                band = vision.anchored_band(image, list(layout.anchors), scales=list(layout.anchor_scales)) if layout.anchors else {"y0": 0, "y1": 0}
                bottom = hit["y"] + hit["h"] if hit["detected"] else 0
                row = {c: r[c] for c in PIXELS[:4]} | {"logo": hit["detected"], "confidence": hit["confidence"], "logo_bottom": bottom, "begin_y": band["y0"], "end_y": band["y1"]}
                yield pa.RecordBatch.from_pylist([row], CLASS_SCHEMA)

    return pages.select(*PIXELS).mapInArrow(run, CLASSES)


def documents(found: DataFrame, layout: Layout) -> DataFrame:
    """Adds is_first and document_id to classified pages."""
    marked = found if layout.logo else found.withColumn("logo", F.lit(False))
    return segment.segment_pages(marked, "rel_path", "page_num", "logo")


REGIONS = "rel_path string, document_id long, page_num int, kind string, grid_row int, column int, x int, y int, w int, h int, image_height int, image_width int, image binary, reason string"
REGION_SCHEMA = pa.schema([("rel_path", pa.string()), ("document_id", pa.int64()), ("page_num", pa.int32()), ("kind", pa.string()), *((c, pa.int32()) for c in ("grid_row", "column", "x", "y", "w", "h", "image_height", "image_width")), ("image", pa.binary()), ("reason", pa.string())])


def band_of(page: dict, table_top: int, layout: Layout) -> tuple[int, int] | None:
    """IM17: the fields' band of a first page: between the anchors, else from under the logo to above the table."""
    if page["end_y"] - page["begin_y"] > layout.band_least:
        return page["begin_y"], page["end_y"]
    y0, y1 = page["logo_bottom"] + layout.band_margin, table_top - layout.band_margin
    return (y0, y1) if y1 - y0 > layout.band_least else None


def regions_of(page: dict, layout: Layout) -> Iterator[dict]:
    """The regions of one page as rows of REGIONS; a reason in place of an image tells what couldn't be found."""
    image = vision.image_of(page)
    height, width = image.shape[:2]
    own = {c: page[c] for c in ("rel_path", "document_id", "page_num")}
    none = dict.fromkeys(("grid_row", "column", "x", "y", "w", "h", "image_height", "image_width", "image", "reason"))
    low = int(layout.table_from * height) if page["is_first"] else 0
    x, y, w, h = vision.table_boundary(image[low:])
    y += low
    if page["is_first"]:
        band = band_of(page, y, layout)
        if band is None:
            yield own | none | {"kind": "fields", "reason": "fields_band_ocr_fallback_skipped_invalid_band"}
        else:
            crop = vision.field_image(image[band[0] : band[1]], dots=False, search=layout.search)
            yield own | none | {"kind": "fields", "x": 0, "y": band[0], "w": width, "h": band[1] - band[0], "image_height": crop.shape[0], "image_width": crop.shape[1], "image": crop.tobytes()}
    xs, ys = vision.table_lines(image[y : y + h, x : x + w])
    columns = len(xs) - 1
    at = columns - 1 if layout.column is None else layout.column if layout.column >= 0 else columns + layout.column
    if len(ys) < 2 or not 0 <= at < columns:
        yield own | none | {"kind": "cell", "reason": "table_detection_failed"}
        return
    for row in range(layout.header_rows, len(ys) - 1):
        x0, x1, y0, y1 = x + xs[at], x + xs[at + 1], y + ys[row], y + ys[row + 1]
        crop = image[max(0, y0) : min(height, y1), max(0, x0) : min(width, x1)]
        if not crop.size or layout.need_dots and not vision.dotted(crop):
            continue
        bw = vision.cell_image(crop, search=layout.search)
        if not vision.is_empty(bw, 20):
            yield own | none | {"kind": "cell", "grid_row": row - layout.header_rows + 1, "column": at + 1, "x": x0, "y": y0, "w": x1 - x0, "h": y1 - y0, "image_height": bw.shape[0], "image_width": bw.shape[1], "image": bw.tobytes()}


def extracted(pages: DataFrame, placed: DataFrame, layout: Layout) -> DataFrame:
    """IM9-IM12, TF6, V12, V13: the regions of all pages, of pixels and the documents that pages belong to."""
    columns = ["document_id", "is_first", "logo_bottom", "begin_y", "end_y"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                yield pa.RecordBatch.from_pylist(list(regions_of(r, layout)), REGION_SCHEMA)

    both = pages.select(*PIXELS).join(placed.select("rel_path", "page_num", *columns), ["rel_path", "page_num"])
    return both.select(*PIXELS, *columns).mapInArrow(run, REGIONS)


def numbered(regions: DataFrame) -> DataFrame:
    """W2, W3, PR34: region ids; a cell's row is its grid row in the page, after all cells kept on earlier pages of its document."""
    kept = regions.where("image is not null")
    doc = W.partitionBy("rel_path", "document_id", "kind").orderBy("page_num").rangeBetween(W.unboundedPreceding, -1)
    row = (F.col("grid_row") + F.count("*").over(doc)).cast("int")
    page = F.col("page_num") + 1
    cell, band = F.format_string("table_p%d_r%d_c%d", page, "row", "column"), T.region_id(F.col("document_id"), page, F.lit("fields_band"))
    return kept.withColumn("row", F.when(F.col("kind") == "cell", row)).withColumn("region_id", F.when(F.col("kind") == "cell", cell).otherwise(band))


OCR = pa.schema([("rel_path", pa.string()), ("document_id", pa.int64()), ("region_id", pa.string()), ("text", pa.string()), ("confidence", pa.float64()), ("error", pa.string())])


def recognised(regions: DataFrame, ocr: Callable[[np.ndarray], tuple[str, float]]) -> DataFrame:
    """PR28, IM18: the text and confidence of every region; a failed call gives '' and 0.0, and its error."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                row = {c: r[c] for c in ("rel_path", "document_id", "region_id")} | {"text": "", "confidence": 0.0, "error": None}
                try:
                    image = np.frombuffer(r["image"], np.uint8).reshape(r["image_height"], r["image_width"])
                    row["text"], row["confidence"] = ocr(vision.for_ocr(image))
                except Exception as e:  # noqa: BLE001  any failure of a provider becomes a row
                    row["error"] = f"{type(e).__name__}: {e}"[:500]
                out.append(row)
            yield pa.RecordBatch.from_pylist(out, OCR)

    return regions.select("rel_path", "document_id", "region_id", "image_height", "image_width", "image").mapInArrow(run, "rel_path string, document_id long, region_id string, text string, confidence double, error string")


DOC = ["rel_path", "document_id"]


def structured(regions: DataFrame, texts: DataFrame) -> DataFrame:
    """Regions (numbered) with their text and triage: parsed, range_check, status and reason."""
    both = segment.with_ocr(regions.drop("image"), texts, [*DOC, "region_id"]).withColumn("value", F.col("text"))
    cells = validate.triaged(both.where("kind = 'cell'"), True)
    return cells.unionByName(validate.triaged(both.where("kind = 'fields'"), False))


def findings(rows: DataFrame) -> DataFrame:
    """C1, V1-V6 over structured regions: (rel_path, document_id, chk, detail). Fields are those whose region id ends in field_n."""
    key = F.struct(*DOC).alias("doc")
    numbers = rows.withColumn("field_no", T.field_number(F.col("region_id"))).where("field_no is not null")
    name = F.get(F.array(*map(F.lit, validate.FIELDS)), F.col("field_no") - 1)
    fields = numbers.groupBy(key, name.alias("field")).agg(F.min_by("parsed", "region_id").alias("value"))
    forms = fields.groupBy("doc").pivot("field", list(validate.FIELDS)).agg(F.first("value"))
    cells = rows.where("kind = 'cell'").select(key, F.col("page_num").cast("long") * 100_000 + F.col("row"), "value", "confidence").toDF("doc", "ord", "value", "confidence")
    return validate.validate_forms(forms, cells, fields, "doc").select("doc.*", "chk", "detail")


def results(placed: DataFrame, regions: DataFrame, rows: DataFrame, found: DataFrame) -> DataFrame:
    """D13, A25, ST1, V15, PR30: one row per file: rel_path, n_pages, n_documents, result (JSON).

    A document holds its pages in order, its fields, its cells by page and row, its findings and review reasons.
    """
    in_order = lambda *c: F.array_sort(F.collect_list(F.struct(*c)))
    region = ["region_id", "value", "confidence", "status", "reason", "x", "y", "w", "h"]
    pages = placed.groupBy(*DOC).agg(F.array_sort(F.collect_list("page_num")).alias("pages"), F.min("page_num").alias("first_page"))
    fields = rows.where("kind = 'fields'").groupBy(*DOC).agg(in_order("page_num", *region).alias("fields"))
    cells = rows.where("kind = 'cell'").groupBy(*DOC).agg(in_order("page_num", "row", "column", *region).alias("cells"))
    counts = rows.groupBy(*DOC).agg(F.count("*").alias("total_extractions"), F.count_if((F.col("status") == "auto_accepted") & (F.col("range_check") == "pass")).alias("auto_accepted"), F.count_if(F.col("status") == "manual_entry").alias("manual_entry"))
    warned = found.groupBy(*DOC).agg(in_order("chk", "detail").alias("warnings"))
    reasons = regions.where("reason is not null").groupBy(*DOC).agg(in_order("page_num", "reason").alias("manual_review"))
    whole = pages
    for part in (fields, cells, counts, warned, reasons):
        whole = whole.join(part, DOC, "left")
    own = [c for c in whole.columns if c != "rel_path"]
    files = whole.groupBy("rel_path").agg(F.sum(F.size("pages")).alias("n_pages"), F.count("*").alias("n_documents"), in_order(*own).alias("documents"))
    return files.select("rel_path", "n_pages", "n_documents", F.to_json(F.struct("n_pages", "n_documents", "documents")).alias("result"))


def process_forms(pages: DataFrame, layout: Layout, ocr: Callable[[np.ndarray], tuple[str, float]], keep: Callable[[DataFrame, str], DataFrame] = lambda df, _: df) -> DataFrame:
    """Results of the files of a page table (rel_path, page_num, height, width, channels, pixels).

    keep(table, name) may write a step and read it again: without it, steps that feed several others (pixels, calls of
    the OCR) are computed for each of them.
    """
    good = pages.where("pixels is not null")
    placed = keep(documents(classified(good, layout), layout), "pages")
    regions = keep(extracted(good, placed, layout), "regions")
    named = numbered(regions)
    rows = keep(structured(named, recognised(named, ocr)), "values")
    return results(placed, regions, rows, findings(rows))


def batch_plan(inputs: DataFrame, done: DataFrame, out_root: str, force: bool = False) -> DataFrame:
    """C11, SK7: inputs (rel_path) with out_path, and action: skipped where its result is there, unless forced."""
    out = F.concat(F.lit(out_root.rstrip("/") + "/"), T.path_stem(F.col("rel_path")), F.lit("/result.json"))
    planned = inputs.withColumn("out_path", out).join(done.select("out_path").distinct().withColumn("there", F.lit(True)), "out_path", "left")
    return planned.withColumn("action", F.when(F.col("there") & F.lit(not force), F.lit("skipped")).otherwise(F.lit("pending"))).drop("there")


def batch_items(plan: DataFrame, written: DataFrame, errors: DataFrame) -> DataFrame:
    """C11: a row per input: rel_path, out_path, status (ok, skipped, error), n_pages, error."""
    both = plan.join(written.select("rel_path", "n_pages"), "rel_path", "left").join(errors.select("rel_path", "error"), "rel_path", "left")
    status = F.when(F.col("action") == "skipped", F.lit("skipped")).when(F.col("n_pages").isNotNull(), F.lit("ok")).otherwise(F.lit("error"))
    error = F.when(status == "error", F.coalesce("error", F.lit("no pages")))
    return both.select("rel_path", "out_path", status.alias("status"), "n_pages", error.alias("error"))


def process_inputs(spark: SparkSession, in_root: str, out_root: str, render, layout: Layout, ocr, force: bool = False, max_files: int | None = None, fallback=None) -> tuple[DataFrame, DataFrame]:
    """C11: processes the PDF files of a tree and writes a result.json for each below out_root: (items, their counts).

    Files whose result is there are skipped unless forced; a file that can't be rendered is an error in its row. Steps
    are written below out_root/_steps, and results by the tasks, each whole or not at all.
    """
    from formloom.sources import providers, readers, sinks

    found = readers.files(spark, in_root, content=True)
    if max_files is not None:
        found = readers.in_path_order(found).limit(max_files)
    steps = f"{out_root.rstrip('/')}/_steps"

    def keep(df: DataFrame, name: str) -> DataFrame:
        df.write.mode("overwrite").parquet(f"{steps}/{name}")
        return spark.read.schema(df.schema).parquet(f"{steps}/{name}")

    done = readers.existing(spark, out_root, "result.json").select(F.col("path").alias("out_path"))
    plan = keep(batch_plan(found.select("rel_path"), done, out_root, force), "plan")
    todo = found.join(plan.where("action = 'pending'").select("rel_path"), "rel_path", "left_semi")
    pages = keep(providers.same_width(providers.rendered_pages(todo, render, fallback)), "rendered")
    out = keep(process_forms(pages, layout, ocr, keep), "results")
    sinks.write_files(out.join(plan.select("rel_path", "out_path"), "rel_path").select(F.col("out_path").alias("path"), F.col("result").cast("binary").alias("content")))
    items = keep(batch_items(plan, out, pages.where("error is not null").select("rel_path", "error").distinct()), "items")
    return items, manifest.status_counts(items)
