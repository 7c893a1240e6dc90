"""Queries over pages, lines and vectors: segmentation and layout kernels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formloom.functions import text as T
from formloom.operators import layout, segment, validate
from formloom.plans import bindings as B
from formloom.plans.registry import Registry
from formloom.session import table

query = Registry()
QUERIES, ORACLE_SQL = query.queries, query.sql
Frame, Session = DataFrame, SparkSession

PAGES = "WITH p AS (SELECT user_id AS file, event_id AS page, event_type IN ('click', 'purchase', 'view') AS logo FROM events), r AS (SELECT *, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY file) AS n FROM p WINDOW w AS (PARTITION BY file ORDER BY page)), m AS (SELECT *, logo OR i = 0 AS mark FROM r), g AS (SELECT *, i - row_number() OVER (PARTITION BY file, mark ORDER BY page) AS run FROM m), s AS (SELECT *, CASE WHEN n < 3 THEN i = 0 ELSE mark AND (row_number() OVER (PARTITION BY file, mark, run ORDER BY page) - 1) % 2 = 0 END AS is_first FROM g), d AS (SELECT *, CAST(sum(is_first::INT) OVER (PARTITION BY file ORDER BY page) - 1 AS BIGINT) AS document_id FROM s) "


def pages(spark: Session, sf: str) -> Frame:
    rows = table(spark, sf, "events").selectExpr("user_id AS file", "event_id AS page", "event_type IN ('click', 'purchase', 'view') AS logo")
    return segment.segment_pages(rows, "file", "page", "logo")


@query(PAGES + "SELECT file, page, is_first, document_id FROM d")
def doc_segmentation(spark: Session, sf: str) -> Frame:
    return pages(spark, sf).select("file", "page", "is_first", "document_id")


@query(PAGES + "SELECT file, document_id, count(*) AS n_pages, min(page) AS first_page, max(page) AS last_page FROM d GROUP BY file, document_id")
def doc_pages(spark: Session, sf: str) -> Frame:
    return segment.document_sizes(pages(spark, sf), "file", "page")


@query(PAGES + "SELECT file, count(*) FILTER (is_first) AS n_first, count(*) AS n_pages FROM d GROUP BY file HAVING count(*) FILTER (is_first) * 2 > count(*)")
def first_page_warning(spark: Session, sf: str) -> Frame:
    return validate.first_page_warning(pages(spark, sf), "file")


@query("SELECT event_id, CAST(0 AS INTEGER) AS document_id, event_id % 4 = 0 AS has_fields, true AS has_table, CASE WHEN event_id % 4 = 0 THEN CAST(round_even(0.5e0 * (event_id % 999), 0) AS INTEGER) ELSE 0 END AS table_y0, CAST(event_id % 999 AS INTEGER) AS table_y1 FROM events")
def single_document(spark: Session, sf: str) -> Frame:
    rows = table(spark, sf, "events").selectExpr("event_id", "event_id % 4 AS page", "cast(event_id % 999 AS int) AS height")
    return segment.single_document(rows, "page", "height").select("event_id", "document_id", "has_fields", "has_table", "table_y0", "table_y1")


@query("WITH e AS (SELECT event_id AS id, event_id % 300 AS b, event_id % 400 AS e, 100 + event_id % 9 AS head, 900 AS t FROM events) SELECT id, CASE WHEN e - b > 40 THEN b ELSE CASE WHEN id % 2 = 0 THEN head ELSE 120 END + 20 END AS band_y0, CASE WHEN e - b > 40 THEN e ELSE t - 20 END AS band_y1 FROM e")
def fields_band(spark: Session, sf: str) -> Frame:
    rows = table(spark, sf, "events").selectExpr("event_id AS id", "event_id % 300 AS begin_y", "event_id % 400 AS end_y", "CASE WHEN event_id % 2 = 0 THEN 100 + event_id % 9 END AS logo_bottom", "120L AS header_bottom", "900L AS table_top")
    return segment.fields_band(rows).select("id", "band_y0", "band_y1")


@query(B.with_sql("lines") + "SELECT k, ord, page, ord + coalesce((SELECT count(*) FROM lines AS o WHERE o.k = x.k AND o.ord % 3 < x.page), 0) AS row_number FROM (SELECT k, ord, ord % 3 AS page FROM lines) AS x")
def row_offsets(spark: Session, sf: str) -> Frame:
    cells = B.lines(spark, sf).select("k", "ord", (F.col("ord") % 3).alias("page"))
    return validate.row_numbers(cells, "k", "page", "ord").select("k", "ord", "page", "row_number")


@query(B.with_sql("lines") + "SELECT k, ord, CASE WHEN ord % 4 = 0 THEN '' ELSE 't' || v END AS text, CASE WHEN ord % 4 = 0 THEN 0.0e0 ELSE confidence END AS confidence FROM lines")
def ocr_join(spark: Session, sf: str) -> Frame:
    """J8, PR34."""
    regions = B.lines(spark, sf).withColumn("region_id", T.region_id(F.col("k"), F.col("ord"), F.lit("cell")))
    results = regions.where("ord % 4 <> 0").select("region_id", F.concat(F.lit("t"), "v").alias("text"), "confidence")
    return segment.with_ocr(regions.drop("confidence"), results).select("k", "ord", "text", "confidence")


HOURS = "WITH h AS (SELECT event_type AS key, date_diff('day', TIMESTAMP '2024-01-01', date_trunc('day', ts)) * 24 + extract(hour FROM ts) AS pos, count(*) AS ink FROM events GROUP BY ALL) "


@query(HOURS + "SELECT key, min(pos) AS low, max(pos) AS high, CAST(round_even((min(pos) + max(pos)) / 2.0e0, 0) AS BIGINT) AS center FROM (SELECT key, pos, pos - row_number() OVER (PARTITION BY key ORDER BY pos) AS island FROM h JOIN (SELECT key, max(ink) AS top FROM h GROUP BY key) USING (key) WHERE ink >= 0.55e0 * top) GROUP BY key, island")
def ink_runs(spark: Session, sf: str) -> Frame:
    at = F.expr("cast(datediff(cast(ts AS date), date'2024-01-01') * 24 + hour(ts) AS bigint)")
    profile = table(spark, sf, "events").groupBy(F.col("event_type").alias("key"), at.alias("at")).agg(F.count("*").alias("ink"))
    return layout.ink_runs(profile, "key", "at", "ink")


XS = "WITH v AS (SELECT l_orderkey AS k, list(DISTINCT l_partkey % 150 ORDER BY l_partkey % 150) AS xs FROM lineitem GROUP BY l_orderkey), e AS (SELECT k, list_transform(xs, lambda x: [x]) AS xs FROM v) "


@query(XS + "SELECT k, array_to_string(list_reduce(xs, lambda a, x: CASE WHEN x[1] - a[-1] <= 3 THEN a ELSE list_concat(a, x) END), ',') AS kept, array_to_string(list_reduce(xs, lambda a, x: CASE WHEN x[1] - a[-1] <= 10 THEN list_concat(a[:-2], [CAST(round_even((a[-1] + x[1]) / 2.0e0, 0) AS BIGINT)]) ELSE list_concat(a, x) END), ',') AS merged FROM e")
def merge_nearby(spark: Session, sf: str) -> Frame:
    """W7a, W7b."""
    xs = F.array_sort(F.collect_set(F.col("l_partkey") % 150))
    rows = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(xs.alias("xs"))
    text = lambda a: F.array_join(F.transform(a, lambda x: x.cast("string")), ",")
    return rows.select("k", text(layout.merge_keep_first(F.col("xs"))).alias("kept"), text(layout.merge_running_mean(F.col("xs"))).alias("merged"))


def dots(spark: Session, sf: str) -> Frame:
    """Dots of a page: a user's events, with x and y from their number."""
    dot = F.struct((F.col("event_id") * 7 % 40).alias("y"), (F.col("event_id") % 600).alias("x"))
    return table(spark, sf, "events").groupBy(F.col("user_id").alias("k")).agg(F.array_sort(F.collect_set(dot)).alias("dots"))


GRID = "WITH xs AS (SELECT DISTINCT l_orderkey AS k, l_partkey % 500 AS x FROM lineitem), ys AS (SELECT DISTINCT l_orderkey AS k, l_suppkey AS y FROM lineitem), c AS (SELECT k, x, lead(x) OVER w AS x1, row_number() OVER w - 1 AS col FROM xs WINDOW w AS (PARTITION BY k ORDER BY x)), r AS (SELECT k, y, lead(y) OVER w AS y1, row_number() OVER w - 1 AS row FROM ys WINDOW w AS (PARTITION BY k ORDER BY y)) "


def grids(spark: Session, sf: str) -> Frame:
    return table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("k")).agg(F.collect_list(F.col("l_partkey") % 500).alias("x_lines"), F.collect_list("l_suppkey").alias("y_lines"))


@query(GRID + "SELECT k, row, col, x, y, x1 - x AS w, y1 - y AS h FROM c JOIN r USING (k) WHERE x1 IS NOT NULL AND y1 IS NOT NULL")
def grid_cells(spark: Session, sf: str) -> Frame:
    return layout.grid_cells(grids(spark, sf), "k")


@query(GRID + "SELECT k, arg_max(x, col) AS x0, arg_max(x1, col) AS x1, arg_min(x, col) AS first_x0 FROM c WHERE x1 IS NOT NULL GROUP BY k")
def target_column(spark: Session, sf: str) -> Frame:
    """PR33: the last column, and by index the first."""
    found = grids(spark, sf).select("k", layout.target_column(F.col("x_lines")).alias("t"), layout.target_column(F.col("x_lines"), 0).alias("f"))
    return found.where("t is not null").select("k", "t.x0", "t.x1", F.col("f.x0").alias("first_x0"))


@query(GRID + ", t AS (SELECT k, arg_max(x, col) AS x0, arg_max(x1, col) AS x1 FROM c WHERE x1 IS NOT NULL GROUP BY k) SELECT k, row AS grid_row, t.x0 AS x, y, t.x1 - t.x0 AS w, y1 - y AS h FROM r JOIN t USING (k) WHERE y1 IS NOT NULL AND row >= 1")
def target_cells(spark: Session, sf: str) -> Frame:
    """TF6."""
    tables = grids(spark, sf).select("k", "y_lines", layout.target_column(F.col("x_lines")).alias("t")).where("t is not null").select("k", "y_lines", "t.x0", "t.x1")
    return layout.target_cells(tables, "k")


VECTORS = "WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v FROM embeddings), z AS (SELECT vec_id, list_transform(v, lambda x: x - list_sum(v) / 64.0e0) AS v FROM e), p AS (SELECT a.vec_id, b.vec_id AS template_id, round(list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v)), 6) AS score FROM z AS a, z AS b WHERE b.vec_id < 10) "


@query(VECTORS + "SELECT vec_id, template_id, score FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY score DESC, template_id DESC) AS r FROM p) WHERE r = 1")
def best_template(spark: Session, sf: str) -> Frame:
    vectors = table(spark, sf, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    templates = vectors.where("vec_id < 10").select(F.col("vec_id").alias("template_id"), F.col("vector").alias("template"))
    return layout.best_template(vectors, templates, "vec_id")


@query("SELECT label, pos, count(*) AS ink FROM (SELECT label, unnest(range(64)) AS pos, unnest(embedding) AS v FROM embeddings) WHERE CAST(v AS DOUBLE) > 0.1e0 GROUP BY label, pos")
def projection_profile(spark: Session, sf: str) -> Frame:
    vectors = table(spark, sf, "embeddings").select("label", F.col("embedding").cast("array<double>").alias("v"))
    return layout.projection(vectors, "label", "v", 0.1).withColumnRenamed("at", "pos")


@query("SELECT conv_id, turn, round(list_sum(list_transform(string_split(text, ' '), lambda w: (length(w) % 100) / 100.0e0)) / len(string_split(text, ' ')), 6) AS confidence FROM conversations")
def ocr_confidence_mean(spark: Session, sf: str) -> Frame:
    words = F.transform(F.split("text", " "), lambda w: (F.length(w) % 100) / F.lit(100.0))
    return table(spark, sf, "conversations").select("conv_id", "turn", F.round(layout.ocr_confidence(words), 6).alias("confidence"))


@query("SELECT k, pos, CASE WHEN v % 7 = 0 THEN '' ELSE 'w' || v END AS text, CASE WHEN v % 7 = 0 THEN 0.0e0 ELSE 0.5e0 END AS confidence FROM (SELECT l_orderkey AS k, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS pos, CAST(l_quantity AS BIGINT) AS v FROM lineitem)")
def ocr_responses(spark: Session, sf: str) -> Frame:
    """PR28."""
    r = F.struct("ord", F.expr("struct(CASE WHEN v % 7 = 0 THEN 'failed' END AS error, CASE WHEN v % 2 = 0 THEN concat('w', v) END AS full_text, concat('w', v) AS annotation, 0.5D AS confidence)").alias("r"))
    batches = B.lines(spark, sf).groupBy("k").agg(F.array_sort(F.collect_list(F.struct("ord", "v"))).alias("o"), F.collect_list(r).alias("rs"))
    ordered = F.transform(F.array_sort("rs", lambda a, b: F.when(a["ord"] < b["ord"], -1).otherwise(1)), lambda x: x["r"])
    found = layout.ocr_responses(batches.select("k", F.transform("o", lambda x: x["ord"]).alias("image_ids"), ordered.alias("responses")), "k")
    return found.select("k", F.col("image_id").alias("pos"), "text", "confidence")


@query("SELECT event_id, CAST(least(greatest(x, 0), 500) AS INTEGER) AS x, CAST(greatest(least(greatest(x + 80, 0), 500) - least(greatest(x, 0), 500), 0) AS INTEGER) AS w FROM (SELECT event_id, event_id % 700 - 100 AS x FROM events)")
def box_clamp(spark: Session, sf: str) -> Frame:
    """PR20, PR36."""
    x = F.expr("cast(event_id % 700 - 100 AS int)")
    box = T.clamp_box(x, F.lit(0), F.lit(80), F.lit(10), F.lit(500), F.lit(100))
    return table(spark, sf, "events").select("event_id", box["x"].alias("x"), box["w"].alias("w"))


@query("SELECT event_id, CAST(least(a, b) AS INTEGER) AS y0, CAST(greatest(a, b) AS INTEGER) AS y1 FROM (SELECT event_id, round_even(least(greatest((event_id % 130) / 100.0e0 * 300, 0), 300), 0) AS a, round_even(least(greatest((event_id % 77) / 100.0e0 * 300, 0), 300), 0) AS b FROM events)")
def zone_pixels(spark: Session, sf: str) -> Frame:
    """PR19."""
    zone = T.zone_pixels(F.expr("(event_id % 130) / 100.0D"), F.expr("(event_id % 77) / 100.0D"), F.lit(300))
    return table(spark, sf, "events").select("event_id", zone["y0"].alias("y0"), zone["y1"].alias("y1"))
