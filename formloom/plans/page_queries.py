"""Queries over boxes, lines, settings and batches: what pages, crops and runs are made of."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formloom.functions import text as T
from formloom.operators import evaluate, forms, layout, manifest, segment, survey, validate
from formloom.plans import bindings as B
from formloom.plans.layout_queries import PAGES, dots, grids, pages
from formloom.plans.registry import Registry
from formloom.session import table
from formloom.sources import sinks

query = Registry()
QUERIES, ORACLE_SQL = query.queries, query.sql
Frame, Session = DataFrame, SparkSession


@query(PAGES + "SELECT file, document_id, string_agg(page, ',' ORDER BY page) AS pages FROM d GROUP BY file, document_id")
def document_pages(spark: Session, sf: str) -> Frame:
    """A25."""
    found = segment.document_pages(pages(spark, sf), "file", "page")
    return found.select("file", "document_id", F.array_join(F.transform("pages", lambda p: p.cast("string")), ",").alias("pages"))


@query(PAGES + "SELECT file, page, document_id, 'doc' || document_id || '_p' || page || '_fields_band' AS region_id, CAST(document_id AS INTEGER) AS named FROM d WHERE page % 3 = 0")
def regions_to_documents(spark: Session, sf: str) -> Frame:
    """J9, PR34: regions of every third page, with their document, and the document that their id names."""
    placed = pages(spark, sf)
    regions = placed.where("page % 3 = 0").select("file", "page")
    found = segment.regions_to_documents(regions, placed, "file", "page").withColumn("region_id", T.region_id(F.col("document_id"), F.col("page"), F.lit("fields_band")))
    return found.select("file", "page", "document_id", "region_id", T.region_document(F.col("region_id")).alias("named"))


@query(
    """WITH RECURSIVE p AS (SELECT user_id AS file, event_type IN ('click', 'purchase', 'view') AS logo, row_number() OVER (PARTITION BY user_id ORDER BY event_id) - 1 AS i FROM events),
    r AS (SELECT file, i, true AS first, i AS last FROM p WHERE i = 0
          UNION ALL SELECT p.file, p.i, NOT r.first AND p.logo AND p.i - r.last > 3, CASE WHEN NOT r.first AND p.logo AND p.i - r.last > 3 THEN p.i ELSE r.last END FROM r JOIN p ON p.file = r.file AND p.i = r.i + 1)
    SELECT file, string_agg(CASE WHEN first THEN '1' ELSE '0' END, '' ORDER BY i) AS firsts FROM r GROUP BY file"""
)
def segment_with_gap(spark: Session, sf: str) -> Frame:
    """W1 with a gap of three pages."""
    flag = F.struct("event_id", F.col("event_type").isin("click", "purchase", "view").alias("logo"))
    files = table(spark, sf, "events").groupBy(F.col("user_id").alias("file")).agg(F.transform(F.array_sort(F.collect_list(flag)), lambda x: x["logo"]).alias("flags"))
    return files.select("file", F.array_join(F.transform(segment.segment_fold(F.col("flags"), 3), lambda b: F.when(b, "1").otherwise("0")), "").alias("firsts"))


DOTS = """WITH RECURSIVE dots AS (SELECT DISTINCT user_id AS k, event_id * 7 % 40 AS y, event_id % 600 AS x FROM events),
  d AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY y, x) AS i FROM dots),
  c AS (SELECT k, i, y, x, 0 AS cluster, CAST(y AS DOUBLE) AS s, 1 AS n FROM d WHERE i = 1
        UNION ALL SELECT d.k, d.i, d.y, d.x, CASE WHEN abs(d.y - c.s / c.n) <= 3 THEN c.cluster ELSE c.cluster + 1 END, CASE WHEN abs(d.y - c.s / c.n) <= 3 THEN c.s + d.y ELSE d.y END, CASE WHEN abs(d.y - c.s / c.n) <= 3 THEN c.n + 1 ELSE 1 END FROM c JOIN d ON d.k = c.k AND d.i = c.i + 1),
  clusters AS (SELECT k, cluster, arg_max(s / n, i) AS center, max(n) AS n_dots FROM c GROUP BY k, cluster)"""


@query(DOTS + " SELECT k, cluster, round(center, 6) AS center, n_dots FROM clusters")
def y_clusters(spark: Session, sf: str) -> Frame:
    """W8."""
    rows = dots(spark, sf).select("k", F.posexplode(layout.y_clusters(F.col("dots"))).alias("cluster", "c"))
    return rows.select("k", "cluster", F.round("c.center", 6).alias("center"), F.size("c.dots").alias("n_dots"))


NEAR = "dx BETWEEN 1 AND 60"
GAP = "dx > 60 AND dx <= 132 AND gaps < 2"
ALIKE = "abs(l.y - m.y) <= 3 AND abs(l.x_start - m.x_start) <= 6 AND abs(l.x_end - m.x_end) <= 6"
BETTER = "(l.length > m.length OR (l.length = m.length AND l.dot_count > m.dot_count))"


@query(
    DOTS
    + f""", xs AS (SELECT k, cluster, x, row_number() OVER (PARTITION BY k, cluster ORDER BY x) AS j FROM c),
    s AS (SELECT k, cluster, x, j, 0 AS run, 0 AS gaps FROM xs WHERE j = 1
          UNION ALL SELECT k, cluster, x, j, CASE WHEN {NEAR} OR ({GAP}) THEN run ELSE run + 1 END, CASE WHEN {NEAR} THEN gaps WHEN {GAP} THEN gaps + 1 ELSE 0 END FROM (SELECT xs.k, xs.cluster, xs.x, xs.j, s.run, s.gaps, xs.x - s.x AS dx FROM s JOIN xs ON xs.k = s.k AND xs.cluster = s.cluster AND xs.j = s.j + 1)),
    runs AS (SELECT k, cluster, run, min(x) AS x_start, max(x) AS x_end, max(x) - min(x) AS length, count(*) AS dot_count FROM s GROUP BY ALL HAVING count(*) >= 5 AND max(x) - min(x) >= 100),
    l AS (SELECT k, CAST(round_even(center, 0) AS INTEGER) AS y, x_start, x_end, length, CAST(dot_count AS INTEGER) AS dot_count, row_number() OVER (PARTITION BY k ORDER BY CAST(round_even(center, 0) AS INTEGER), x_start, x_end, length, dot_count) AS i FROM runs JOIN clusters USING (k, cluster)),
    m AS (SELECT k, i, y, x_start, x_end, length, dot_count, 0 AS kept FROM l WHERE i = 1
          UNION ALL SELECT l.k, l.i, CASE WHEN {ALIKE} AND NOT {BETTER} THEN m.y ELSE l.y END, CASE WHEN {ALIKE} AND NOT {BETTER} THEN m.x_start ELSE l.x_start END, CASE WHEN {ALIKE} AND NOT {BETTER} THEN m.x_end ELSE l.x_end END, CASE WHEN {ALIKE} AND NOT {BETTER} THEN m.length ELSE l.length END, CASE WHEN {ALIKE} AND NOT {BETTER} THEN m.dot_count ELSE l.dot_count END, CASE WHEN {ALIKE} THEN m.kept ELSE m.kept + 1 END FROM m JOIN l ON l.k = m.k AND l.i = m.i + 1)
    SELECT k, arg_max(y, i) AS y, arg_max(x_start, i) AS x_start, arg_max(x_end, i) AS x_end, arg_max(length, i) AS length, arg_max(dot_count, i) AS dot_count FROM m GROUP BY k, kept"""
)
def dot_lines(spark: Session, sf: str) -> Frame:
    """Clusters, their sequences, and the lines that stay."""
    clusters = dots(spark, sf).select("k", F.explode(layout.y_clusters(F.col("dots"))).alias("c"))
    runs = clusters.select("k", F.col("c.center").alias("y"), F.explode(layout.dot_sequences(F.array_sort(F.transform("c.dots", lambda d: d["x"])), low=1, high=60)).alias("run"))
    line = F.struct(F.bround("y").cast("int").alias("y"), F.element_at("run", 1).alias("x_start"), F.element_at("run", -1).alias("x_end"), (F.element_at("run", -1) - F.element_at("run", 1)).alias("length"), F.size("run").alias("dot_count"))
    found = runs.select("k", line.alias("line")).groupBy("k").agg(F.array_sort(F.collect_list("line")).alias("lines"))
    return found.select("k", F.explode(layout.distinct_lines(F.col("lines"))).alias("line")).select("k", "line.*")


@query("SELECT user_id AS k, count(DISTINCT event_id % 600) >= 5 AND max(event_id % 600) - min(event_id % 600) >= greatest(40.0, 0.35 * (user_id * 11 % 1700)) AS dotted FROM events GROUP BY user_id")
def cells_with_dots(spark: Session, sf: str) -> Frame:
    """V12."""
    rows = table(spark, sf, "events").groupBy(F.col("user_id").alias("k")).agg(F.collect_set(F.col("event_id") % 600).alias("xs"))
    return rows.select("k", layout.has_dots(F.col("xs"), F.col("k") * 11 % 1700).alias("dotted"))


BOXES = "SELECT l_orderkey AS k, l_partkey % 900 AS x, l_suppkey % 700 AS y, CAST(l_quantity AS BIGINT) * 12 AS w, l_partkey % 260 AS h FROM lineitem"


@query(f"SELECT DISTINCT k, x, y, w, h FROM (SELECT *, dense_rank() OVER (PARTITION BY k ORDER BY w * h DESC, y, x, w) AS rank FROM (SELECT DISTINCT * FROM ({BOXES})) WHERE w * h >= 0.02e0 * 1200000 AND w >= 80 AND h >= 80) WHERE rank <= 2")
def large_boxes(spark: Session, sf: str) -> Frame:
    """V14, W11, ST3."""
    boxes = table(spark, sf, "lineitem").selectExpr("l_orderkey AS k", "l_partkey % 900 AS x", "l_suppkey % 700 AS y", "cast(l_quantity AS bigint) * 12 AS w", "l_partkey % 260 AS h", "1200000 AS page").distinct()
    return layout.large_boxes(boxes, ["k"], "page", k=2).select("k", "x", "y", "w", "h")


@query(
    "WITH g AS (SELECT l_orderkey AS k, l_suppkey AS y, lead(l_suppkey) OVER (PARTITION BY l_orderkey ORDER BY l_suppkey) AS y1, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_suppkey) - 1 AS row FROM (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem)), "
    "x AS (SELECT DISTINCT l_orderkey AS k, l_partkey % 500 AS x FROM lineitem), c AS (SELECT k, x, lead(x) OVER (PARTITION BY k ORDER BY x) AS x1 FROM x), t AS (SELECT k, arg_max(x, x) AS x0, arg_max(x1, x) AS x1 FROM c WHERE x1 IS NOT NULL GROUP BY k) "
    "SELECT k, row AS grid_row, x0 AS x, y, least(x1, 400) - x0 AS w, least(y1, 70) - y AS h FROM g JOIN t USING (k) WHERE y1 IS NOT NULL AND row >= 1 AND least(x1, 400) - x0 > 0 AND least(y1, 70) - y > 0"
)
def clamped_cells(spark: Session, sf: str) -> Frame:
    """TF6: cells cut to a page of 400 by 70, without empty ones."""
    tables = grids(spark, sf).select("k", "y_lines", layout.target_column(F.col("x_lines")).alias("t")).where("t is not null")
    tables = tables.select("k", "y_lines", "t.x0", "t.x1", F.lit(400).cast("bigint").alias("page_w"), F.lit(70).cast("bigint").alias("page_h"))
    return layout.target_cells(tables, "k", size=("page_w", "page_h"))


@query(
    "WITH l AS (SELECT user_id AS k, event_id % 500 AS x1, event_id * 3 % 500 AS y1, event_id % 500 + CASE WHEN event_id % 2 = 0 THEN event_id % 300 ELSE event_id % 9 END AS x2, event_id * 3 % 500 + CASE WHEN event_id % 2 = 0 THEN event_id % 9 ELSE event_id % 300 END AS y2 FROM events) "
    "SELECT k, count(*) FILTER (abs(x2 - x1) >= 140 AND abs(y2 - y1) <= 6) AS n_h, count(*) FILTER (abs(y2 - y1) >= 140 AND abs(x2 - x1) <= 6) AS n_v, count(*) FILTER (abs(x2 - x1) >= 140 AND abs(y2 - y1) <= 6) >= 3 AND count(*) FILTER (abs(y2 - y1) >= 140 AND abs(x2 - x1) <= 6) >= 3 AS has_table FROM l GROUP BY k"
)
def table_grid_pages(spark: Session, sf: str) -> Frame:
    """V11, IM21."""
    lines = table(spark, sf, "events").selectExpr("user_id AS k", "event_id % 500 AS x1", "event_id * 3 % 500 AS y1", "event_id % 500 + CASE WHEN event_id % 2 = 0 THEN event_id % 300 ELSE event_id % 9 END AS x2", "event_id * 3 % 500 + CASE WHEN event_id % 2 = 0 THEN event_id % 9 ELSE event_id % 300 END AS y2")
    return validate.table_grid_page(lines, ["k"])


FIELD_STATUS = "CASE WHEN (k % 100) / 100.0e0 >= 0.70e0 THEN 'auto_accepted' WHEN (k % 100) / 100.0e0 >= 0.40e0 THEN 'review_queue' ELSE 'manual_entry' END"


@query(B.with_sql("base", "forms", "long") + f"SELECT k, field, {FIELD_STATUS} AS status, CASE WHEN {FIELD_STATUS} <> 'auto_accepted' THEN 'low_confidence' WHEN v * 40 > 10000 THEN 'validation_warning' END AS reason FROM long")
def validate_fields(spark: Session, sf: str) -> Frame:
    """V9, PR7: fields, whose reasons go by other rules than those of cells."""
    rows = B.long(spark, sf).select("k", "field", (F.col("v") * 40).cast("string").alias("value"), F.expr("(k % 100) / 100.0D").alias("confidence"))
    return validate.triaged(rows, False).select("k", "field", "status", "reason")


@query(B.with_sql("base", "forms") + " SELECT k, field, v FROM forms UNPIVOT INCLUDE NULLS (v FOR field IN (" + ", ".join(validate.FIELDS) + ")) WHERE k % 4 = 0")
def unpivoted_forms(spark: Session, sf: str) -> Frame:
    """TF8, of every fourth form."""
    return evaluate.unpivoted(B.forms(spark, sf).where("k % 4 = 0").select("k", *validate.FIELDS), ["k"], "v")


RATED = "SELECT field, n_fields, round_even(n_correct / n_fields, 4) AS accuracy, round_even(CASE WHEN err_n = 0 THEN 0.0e0 ELSE err_sum / err_n END, 2) AS mae FROM (SELECT field, count(*) AS n_fields, count(*) FILTER (coalesce(gt = pred, false)) AS n_correct, coalesce(sum(CASE WHEN NOT coalesce(gt = pred, false) THEN abs(gt - pred) END), 0) AS err_sum, count(CASE WHEN NOT coalesce(gt = pred, false) THEN abs(gt - pred) END) AS err_n FROM gt LEFT JOIN pred USING (k, field) WHERE gt IS NOT NULL GROUP BY field)"


@query(B.with_sql("base", "forms", "long", "gt", "pred") + RATED)
def field_rates(spark: Session, sf: str) -> Frame:
    """Accuracy and mean absolute error of each field."""
    metrics = evaluate.grouped_metrics(evaluate.detail(B.truth(spark, sf), B.predicted(spark, sf), ["k"]))
    return evaluate.rates(metrics.where("field is not null")).select("field", "n_fields", "accuracy", "mae")


@query("SELECT 'run_summary' AS row_type, count(*) AS total, count(*) FILTER (event_type NOT IN ('error', 'view')) AS ok, count(*) FILTER (event_type = 'error') AS errors, count(*) FILTER (event_type = 'view') AS skipped, CAST(sum(event_id % 60) AS BIGINT) AS seconds FROM events")
def run_summary(spark: Session, sf: str) -> Frame:
    """SK5."""
    rows = table(spark, sf, "events").selectExpr("CASE event_type WHEN 'error' THEN 'error' WHEN 'view' THEN 'skipped' ELSE 'ok' END AS status", "event_id % 60 AS seconds")
    return manifest.run_summary(rows, "seconds")


@query("SELECT page_id, CASE WHEN page_id % 7 IN (0, 1) THEN '' WHEN page_id % 7 = 2 THEN 'a b' ELSE 'x' || page_id END AS cell FROM pages")
def clean_cells(spark: Session, sf: str) -> Frame:
    """PR11."""
    cell = F.expr("CASE page_id % 7 WHEN 0 THEN NULL WHEN 1 THEN ' NaN ' WHEN 2 THEN ' a\\nb ' ELSE concat('  x', page_id) END")
    return table(spark, sf, "pages").select("page_id", T.clean_cell(cell).alias("cell"))


@query("SELECT doc_id, CASE WHEN doc_id % 15 < 12 THEN sha1(doc_id::VARCHAR) ELSE '' END AS fingerprint FROM documents")
def embedded_fingerprints(spark: Session, sf: str) -> Frame:
    """PR18: a comment in one of the first fifteen lines counts in the first twelve only."""
    line = F.concat(F.lit("<!-- fingerprint="), F.sha1(F.col("doc_id").cast("string").cast("binary")), F.lit(" -->\nend"))
    text = F.concat(F.repeat(F.lit("line\n"), (F.col("doc_id") % 15).cast("int")), line)
    return table(spark, sf, "documents").select("doc_id", T.embedded_fingerprint(text).alias("fingerprint"))


@query("SELECT event_id, x - 4 AS x, y - 4 AS y, w + 8 AS w, h + 8 AS h, greatest(0, w) * greatest(0, h) AS area FROM (SELECT event_id, event_id % 300 AS x, event_id % 200 AS y, event_id % 90 - 10 AS w, event_id % 40 - 5 AS h FROM events)")
def padded_boxes(spark: Session, sf: str) -> Frame:
    """PR20, PR36."""
    x, y, w, h = (F.expr(e) for e in ("event_id % 300", "event_id % 200", "event_id % 90 - 10", "event_id % 40 - 5"))
    return table(spark, sf, "events").select("event_id", T.pad_box(x, y, w, h, 4).alias("b"), T.box_area(w, h).alias("area")).select("event_id", "b.*", "area")


@query(
    "WITH r AS (SELECT event_id, event_id % 3 AS unit, (event_id % 140 - 20) / 100.0e0 AS a, (event_id * 7 % 140 - 20) / 100.0e0 AS b FROM events), s AS (SELECT event_id, CASE unit WHEN 0 THEN 1.0e0 WHEN 1 THEN 100.0e0 / 600 ELSE 0.36e0 * 100 / 600 END AS f, a, b FROM r) "
    "SELECT event_id, round(x0, 6) AS x0, round(y0, 6) AS y0, round(x1, 6) AS x1, round(y1, 6) AS y1 FROM (SELECT event_id, greatest(0.0e0, least(a, b) * 600 * f) AS x0, least(600.0e0, greatest(a, b) * 600 * f) AS x1, 0.0e0 AS y0, least(800.0e0, CASE WHEN f = 1 THEN 800.0e0 * 0.5e0 ELSE 50 * f * 6 END) AS y1 FROM s) WHERE x1 > x0"
)
def crop_rects(spark: Session, sf: str) -> Frame:
    """PR21, SK11: rectangles in all three units, cut to a page of 600 by 800 points."""
    a, b = F.expr("(event_id % 140 - 20) / 100.0D"), F.expr("(event_id * 7 % 140 - 20) / 100.0D")
    w, h, zero = F.lit(600.0), F.lit(800.0), F.lit(0.0)
    unit = F.col("event_id") % 3
    rect = F.when(unit == 0, T.crop_rect("norm", a, zero, b, F.lit(0.5), w, h)).when(unit == 1, T.crop_rect("pt", a * 100, zero, b * 100, F.lit(50.0), w, h)).otherwise(T.crop_rect("px", a * 100, zero, b * 100, F.lit(50.0), w, h))
    found = table(spark, sf, "events").select("event_id", rect.alias("r")).where("r is not null")
    return found.select("event_id", *(F.round(f"r.{c}", 6).alias(c) for c in ("x0", "y0", "x1", "y1")))


@query("SELECT event_id, CASE WHEN event_id % 5 > 1 THEN CAST(event_id % 50 AS DOUBLE) END AS x0, CASE WHEN event_id % 5 > 1 THEN 20.5e0 END AS y1, greatest(0.0e0, least(1.0e0, least((event_id % 30 - 5) / 10.0e0, 0.5e0))) AS low, greatest(0.0e0, least(1.0e0, greatest((event_id % 30 - 5) / 10.0e0, 0.5e0))) AS high FROM events")
def parsed_ranges(spark: Session, sf: str) -> Frame:
    """PR22, PR24: rectangles (two in five aren't whole) and fraction ranges, given in any order."""
    rect = T.parse_rect(F.expr("CASE event_id % 5 WHEN 0 THEN concat(event_id, ',1,2') WHEN 1 THEN '1,2,x,4' ELSE concat(event_id % 50, ', 2,3 ,20.5') END"))
    span = T.fraction_range(F.expr("concat((event_id % 30 - 5) / 10.0D, ',0.5')"))
    return table(spark, sf, "events").select("event_id", rect["x0"].alias("x0"), rect["y1"].alias("y1"), span["low"].alias("low"), span["high"].alias("high"))


@query("SELECT event_id, CASE event_id % 4 WHEN 0 THEN event_id % 5 + 1 WHEN 1 THEN 3 WHEN 2 THEN NULL ELSE 2 END AS n, CASE event_id % 4 WHEN 0 THEN 0.5e0 + (event_id % 5) * 0.25e0 WHEN 1 THEN 3.0e0 WHEN 3 THEN 1.5e0 END AS last, CASE event_id % 3 WHEN 0 THEN 'tha+eng' WHEN 1 THEN 'eng' ELSE '' END AS languages, event_id % 6 < 3 AS enabled, CAST(CASE WHEN event_id % 2 = 0 THEN 2 ELSE 0 END AS INTEGER) AS n_items FROM events")
def parsed_settings(spark: Session, sf: str) -> Frame:
    """PR23, PR29, PR31, PR37: scale lists, OCR languages, flags and comma lists as settings give them."""
    scales = T.scale_list(F.expr("CASE event_id % 4 WHEN 0 THEN concat('0.5:', 0.5D + (event_id % 5) * 0.25D, ':0.25') WHEN 1 THEN '1, 2,,3' WHEN 2 THEN '1:2:0' ELSE '0.5,1.5' END"))
    languages = T.language_codes(F.expr("CASE event_id % 3 WHEN 0 THEN array('th', 'en', 'TH') WHEN 1 THEN array('en') ELSE cast(array() AS array<string>) END"))
    flag = T.env_flag(F.expr("CASE event_id % 6 WHEN 0 THEN ' TRUE' WHEN 1 THEN '1' WHEN 2 THEN 'on ' WHEN 3 THEN 'off' WHEN 4 THEN NULL ELSE '2' END"))
    items = T.comma_list(F.expr("CASE WHEN event_id % 2 = 0 THEN ' a,, b ' ELSE ' , ' END"))
    return table(spark, sf, "events").select("event_id", F.when(scales.isNotNull(), F.size(scales)).cast("bigint").alias("n"), F.try_element_at(scales, F.lit(-1)).alias("last"), languages.alias("languages"), flag.alias("enabled"), F.size(items).alias("n_items"))


@query("SELECT 'a/' || page_id || '.pdf' AS rel_path, coalesce(CASE page_id % 3 WHEN 0 THEN 'district' WHEN 1 THEN 'partylist' END, 'district') AS kind, 'cropped/' || coalesce(CASE page_id % 3 WHEN 0 THEN 'district' WHEN 1 THEN 'partylist' END, 'district') || '/' || page_id || '.pdf' AS out_path FROM pages WHERE NOT (page_id % 3 = 0 AND page_id % 2 = 0)")
def crop_plan(spark: Session, sf: str) -> Frame:
    """SK12: files of no kind go with the districts; half of the districts are there already."""
    inputs = table(spark, sf, "pages").selectExpr("concat('a/', page_id, '.pdf') AS rel_path", "CASE page_id % 3 WHEN 0 THEN 'district' WHEN 1 THEN 'partylist' END AS kind")
    there = table(spark, sf, "pages").where("page_id % 3 = 0 and page_id % 2 = 0").selectExpr("concat('cropped/district/', page_id, '.pdf') AS out_path")
    return sinks.crop_plan(inputs, there, "kind", unknown="district")


@query("SELECT 'in/' || page_id || '.pdf' AS rel_path, 'out/in/' || page_id || '/result.json' AS out_path, CASE WHEN page_id % 4 = 0 THEN 'skipped' WHEN page_id % 5 = 0 THEN 'error' ELSE 'ok' END AS status, CASE WHEN page_id % 4 <> 0 AND page_id % 5 <> 0 THEN page_id % 9 END AS n_pages, CASE WHEN page_id % 4 <> 0 AND page_id % 5 = 0 THEN CASE WHEN page_id % 2 = 0 THEN 'corrupt' ELSE 'no pages' END END AS error FROM pages")
def batch_items(spark: Session, sf: str) -> Frame:
    """C11, SK7, A24: what a batch skips, does and fails at."""
    rows = table(spark, sf, "pages").withColumn("rel_path", F.concat(F.lit("in/"), F.col("page_id").cast("string"), F.lit(".pdf")))
    done = rows.where("page_id % 4 = 0").selectExpr("concat('out/in/', page_id, '/result.json') AS out_path")
    plan = forms.batch_plan(rows.select("rel_path"), done, "out/")
    written = rows.where("page_id % 4 <> 0 and page_id % 5 <> 0").selectExpr("rel_path", "page_id % 9 AS n_pages")
    return forms.batch_items(plan, written, rows.where("page_id % 2 = 0 and page_id % 5 = 0").selectExpr("rel_path", "'corrupt' AS error"))


@query(B.with_sql("lines") + "SELECT k, ord % 2 AS page_num, ord, 'table_p' || (ord % 2 + 1) || '_r' || (ord + CASE WHEN ord % 2 = 1 THEN (SELECT count(*) FROM lines AS o WHERE o.k = x.k AND o.ord % 2 = 0) ELSE 0 END) || '_c4' AS region_id FROM lines AS x")
def numbered_cells(spark: Session, sf: str) -> Frame:
    """Ids of cells that go on over the pages of a document."""
    rows = B.lines(spark, sf).selectExpr("concat('', k) AS rel_path", "0L AS document_id", "cast(ord % 2 AS int) AS page_num", "'cell' AS kind", "cast(ord AS int) AS grid_row", "4 AS column", "binary('x') AS image", "k", "ord")
    return forms.numbered(rows).select("k", F.col("page_num").cast("bigint").alias("page_num"), "ord", "region_id")


@query("SELECT l_orderkey AS k, count(*) AS n_cells, count(DISTINCT row) AS n_rows FROM (SELECT l_orderkey, l_linenumber AS row FROM lineitem) GROUP BY l_orderkey")
def cell_tables(spark: Session, sf: str) -> Frame:
    """SK10: the JSON of each table's cells, read again."""
    rows = table(spark, sf, "lineitem").selectExpr("l_orderkey AS k", "l_linenumber AS row", "0 AS col", "1 AS x", "2 AS y", "3 AS w", "4 AS h")
    cells = F.from_json("cells", "array<struct<row:int>>")
    found = sinks.cell_table(rows, "k").select("k", cells.alias("c"))
    return found.select("k", F.size("c").cast("bigint").alias("n_cells"), F.size(F.array_distinct(F.transform("c", lambda x: x["row"]))).cast("bigint").alias("n_rows"))


@query("SELECT n_name AS nation, p || '.pdf' AS file, province, constituency, amphoe, form_type FROM nation, (VALUES ('1', 'แพร่', 3, 'ลอง', 'district'), ('2', 'แพร่', 3, 'ลอง', 'partylist')) AS v(p, province, constituency, amphoe, form_type)")
def path_report(spark: Session, sf: str) -> Frame:
    """C15."""
    paths = F.array(F.lit("แพร่/เขตเลือกตั้งที่ 3/อ.ลอง/สส5-18/1.pdf"), F.lit("แพร่/เขตเลือกตั้งที่ 3/อ.ลอง/ส.ส.5-18(บช)/2.pdf"))
    found = survey.path_report(table(spark, sf, "nation").select(F.explode(paths).alias("path")))
    names = table(spark, sf, "nation").select(F.col("n_name").alias("nation"))
    return names.join(F.broadcast(found.distinct())).select("nation", "file", "province", "constituency", "amphoe", "form_type")
