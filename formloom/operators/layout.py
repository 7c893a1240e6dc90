"""One-dimensional layout kernels, as native folds and islands (W6-W12, TF5, TF6, PR27, PR28, PR33, IM5, IM13)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from formloom.functions.text import clamp_box


def ink_runs(profile: DataFrame, key: str, at: str, ink: str, fraction: float = 0.55) -> DataFrame:
    """Maximal runs of ink of at least the fraction of the greatest, with their centres (half to even)."""
    top = profile.groupBy(key).agg(F.max(ink).alias("top"))
    on = profile.join(top, key).where((F.col("top") > 0) & (F.col(ink) >= fraction * F.col("top")))
    island = on.withColumn("island", F.col(at) - F.row_number().over(W.partitionBy(key).orderBy(at)))
    return island.groupBy(key, "island").agg(F.min(at).alias("low"), F.max(at).alias("high")).select(key, "low", "high", F.bround((F.col("low") + F.col("high")) / 2.0).cast("bigint").alias("center"))


def merge_keep_first(sorted_values: Column, gap: int = 3) -> Column:
    """Values without those that lie within the gap of the last one kept."""
    empty = F.array().cast("array<bigint>")
    return F.aggregate(sorted_values, empty, lambda a, v: F.when((F.size(a) > 0) & (v - F.try_element_at(a, F.lit(-1)) <= gap), a).otherwise(F.concat(a, F.array(v.cast("bigint")))))


def merge_running_mean(sorted_values: Column, gap: int = 10) -> Column:
    """A value within the gap of the last one kept moves it to their mean, half to even."""
    empty = F.array().cast("array<bigint>")

    def step(a: Column, v: Column) -> Column:
        last = F.try_element_at(a, F.lit(-1))
        mean = F.bround((last + v) / 2.0).cast("bigint")
        return F.when((F.size(a) > 0) & (v - last <= gap), F.concat(F.slice(a, 1, F.size(a) - 1), F.array(mean))).otherwise(F.concat(a, F.array(v.cast("bigint"))))

    return F.aggregate(sorted_values, empty, step)


CLUSTERS = "array<struct<center:double,dots:array<struct<y:bigint,x:bigint>>>>"


def y_clusters(dots: Column, tolerance: float = 3.0) -> Column:
    """Dots (y, x), sorted, in clusters of y: a dot joins the last cluster within the tolerance of its running mean."""

    def step(a: Column, d: Column) -> Column:
        last = F.try_element_at(a, F.lit(-1))
        near = (F.size(a) > 0) & (F.abs(d["y"] - last["center"]) <= tolerance)
        joined = F.concat(last["dots"], F.array(d))
        center = F.aggregate(joined, F.lit(0.0), lambda s, x: s + x["y"]) / F.size(joined)
        grown = F.concat(F.slice(a, 1, F.size(a) - 1), F.array(F.struct(center.alias("center"), joined.alias("dots"))))
        return F.when(near, grown).otherwise(F.concat(a, F.array(F.struct(d["y"].cast("double").alias("center"), F.array(d).alias("dots")))))

    return F.aggregate(dots, F.array().cast(CLUSTERS), step)


def dot_sequences(xs: Column, low: int = 5, high: int = 15, gap_factor: float = 2.2, most_gaps: int = 2, least_dots: int = 5, least_length: int = 100) -> Column:
    """Sorted x of one line in sequences: steps of 5-15 go on, up to 33 twice a sequence; short ones are dropped."""
    start = F.struct(F.array().cast("array<array<bigint>>").alias("done"), F.array().cast("array<bigint>").alias("run"), F.lit(0).alias("gaps"))

    def step(a: Column, x: Column) -> Column:
        dx = x - F.try_element_at(a["run"], F.lit(-1))
        begins = F.size(a["run"]) == 0
        plain = (dx >= low) & (dx <= high)
        gap = (dx > high) & (dx <= gap_factor * high) & (a["gaps"] < most_gaps)
        longer = F.concat(a["run"], F.array(x.cast("bigint")))
        broken = F.struct(F.concat(a["done"], F.array(a["run"])).alias("done"), F.array(x.cast("bigint")).alias("run"), F.lit(0).alias("gaps"))
        return F.when(begins | plain, F.struct(a["done"].alias("done"), longer.alias("run"), a["gaps"].alias("gaps"))).when(gap, F.struct(a["done"].alias("done"), longer.alias("run"), (a["gaps"] + 1).alias("gaps"))).otherwise(broken)

    runs = F.aggregate(xs, start, step, lambda a: F.concat(a["done"], F.array(a["run"])))
    return F.filter(runs, lambda r: (F.size(r) >= least_dots) & (F.element_at(r, -1) - F.element_at(r, 1) >= least_length))


def distinct_lines(lines: Column, tolerance: int = 3) -> Column:
    """Lines (y, x_start, x_end, length, dot_count) sorted by y; of those nearly alike the longest stays."""

    def step(a: Column, line: Column) -> Column:
        last = F.try_element_at(a, F.lit(-1))
        alike = (F.size(a) > 0) & (F.abs(line["y"] - last["y"]) <= tolerance) & (F.abs(line["x_start"] - last["x_start"]) <= tolerance * 2) & (F.abs(line["x_end"] - last["x_end"]) <= tolerance * 2)
        better = (line["length"] > last["length"]) | ((line["length"] == last["length"]) & (line["dot_count"] > last["dot_count"]))
        return F.when(alike & ~better, a).when(alike, F.concat(F.slice(a, 1, F.size(a) - 1), F.array(line))).otherwise(F.concat(a, F.array(line)))

    return F.aggregate(lines, F.filter(lines, lambda _: F.lit(False)), step)


def grid_cells(grids: DataFrame, key: str) -> DataFrame:
    """TF5: cells between neighbouring lines, row by row, from arrays x_lines and y_lines."""
    xs, ys = F.array_sort(F.array_distinct("x_lines")), F.array_sort(F.array_distinct("y_lines"))
    spans = lambda v: F.transform(F.slice(v, 1, F.greatest(F.size(v) - 1, F.lit(0))), lambda a, i: F.struct(a.alias("low"), F.get(v, i + 1).alias("high")))
    rows = grids.select(key, xs.alias("xs"), F.posexplode(spans(ys)).alias("row", "y"))
    cells = rows.select(key, "row", "y", F.posexplode(spans(F.col("xs"))).alias("col", "x"))
    return cells.select(key, F.col("row").cast("bigint").alias("row"), F.col("col").cast("bigint").alias("col"), F.col("x.low").alias("x"), F.col("y.low").alias("y"), (F.col("x.high") - F.col("x.low")).alias("w"), (F.col("y.high") - F.col("y.low")).alias("h"))


def target_column(lines: Column, index: int | None = None) -> Column:
    """PR33: (x0, x1) of a column of sorted lines: the last, or by index (below 0: from the end); null with too few lines."""
    xs = F.array_sort(F.array_distinct(lines))
    n = F.size(xs) - 1
    at = n - 1 if index is None else (F.lit(index) if index >= 0 else n + index)
    return F.when((n >= 1) & (at >= 0) & (at < n), F.struct(F.get(xs, at).alias("x0"), F.get(xs, at + 1).alias("x1")))


def target_cells(tables: DataFrame, key: str, header_rows: int = 1, size: tuple[str, str] | None = None) -> DataFrame:
    """TF6: cells of the target column below the header rows, of (key, y_lines, x0, x1); cut to the page and without
    empty ones where size names the columns of its width and height."""
    ys = F.array_sort(F.array_distinct("y_lines"))
    page = list(size or ())
    out = tables.select(key, "x0", "x1", *page, ys.alias("ys")).select(key, "x0", "x1", *page, F.posexplode(F.transform(F.slice("ys", 1, F.greatest(F.size("ys") - 1, F.lit(0))), lambda a, i: F.struct(a.alias("y0"), F.get("ys", i + 1).alias("y1")))).alias("grid_row", "c"))
    out = out.where(F.col("grid_row") >= header_rows).select(key, *page, F.col("grid_row").cast("bigint").alias("grid_row"), F.col("x0").alias("x"), F.col("c.y0").alias("y"), (F.col("x1") - F.col("x0")).alias("w"), (F.col("c.y1") - F.col("c.y0")).alias("h"))
    if size is None:
        return out
    box = clamp_box(F.col("x"), F.col("y"), F.col("w"), F.col("h"), F.col(size[0]), F.col(size[1]))
    return out.select(key, "grid_row", box.alias("b")).select(key, "grid_row", "b.*").where("w > 0 and h > 0")


def has_dots(xs: Column, width: Column, least: int = 5) -> Column:
    """Whether dots make a line in a cell: at least five, over 40 px and 0.35 of its width."""
    return (F.size(xs) >= least) & (F.array_max(xs) - F.array_min(xs) >= F.greatest(F.lit(40.0), 0.35 * width))


def large_boxes(boxes: DataFrame, keys: list[str], page_area: str, fraction: float = 0.02, least: int = 80, k: int | None = None) -> DataFrame:
    """Boxes that are large enough, the largest first, k at most."""
    area = F.col("w") * F.col("h")
    good = boxes.where((area >= fraction * F.col(page_area)) & (F.col("w") >= least) & (F.col("h") >= least))
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(area.desc(), "y", "x"))
    ranked = good.withColumn("rank", rank)
    return ranked if k is None else ranked.where(F.col("rank") <= k)


def zncc(a: Column, b: Column) -> Column:
    """IM13: zero-mean normalised cross-correlation of two arrays of one length; null where one has no variance."""
    n = F.size(a)
    mean = lambda v: F.aggregate(v, F.lit(0.0), lambda s, x: s + x) / n
    centred = lambda v: F.get(F.transform(F.array(mean(v)), lambda m: F.transform(v, lambda x: x - m)), F.lit(0))
    ca, cb = centred(a), centred(b)
    dot = lambda v, w: F.aggregate(F.zip_with(v, w, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return F.get(F.transform(F.array(F.struct(ca.alias("a"), cb.alias("b"))), lambda p: F.try_divide(dot(p["a"], p["b"]), F.sqrt(dot(p["a"], p["a"]) * dot(p["b"], p["b"])))), F.lit(0))


def best_template(images: DataFrame, templates: DataFrame, key: str, block: int = 1000, last_wins: bool = True) -> DataFrame:
    """The template that fits each image best, of (key, vector) and (template_id, template).

    Templates are a stated set that is compared with all images, in blocks that are broadcast; of equal scores the last
    template wins, or the first. Blocks are drawn by a hash and made smaller until each holds at most `block`.
    """
    n = max(1, -(-templates.count() // block))
    while True:
        part = F.pmod(F.xxhash64("template_id"), F.lit(n))
        sizes = templates.groupBy(part.alias("part")).agg(F.count("*").alias("n")).agg(F.max("n")).first()[0] or 0
        if sizes <= block:
            break
        n += 1 + n // 4
    tie = F.col("template_id") if last_wins else -F.col("template_id")
    score = F.round(zncc(F.col("vector"), F.col("template")), 6).alias("score")
    pairs = [images.crossJoin(F.broadcast(templates.where(part == k))).select(key, "template_id", score) for k in range(n)]
    best = [p.groupBy(key).agg(F.max_by(F.struct("template_id", "score"), F.struct("score", tie)).alias("r")).select(key, "r.template_id", "r.score") for p in pairs]
    found = reduce(DataFrame.unionByName, best)
    return found if n == 1 else found.groupBy(key).agg(F.max_by(F.struct("template_id", "score"), F.struct("score", tie)).alias("r")).select(key, "r.template_id", "r.score")


def projection(cells: DataFrame, key: str, vector: str, threshold: float = 0.0) -> DataFrame:
    """IM5: how many of the vectors of each key are inked at each place."""
    return cells.select(key, F.posexplode(vector).alias("at", "v")).where(F.col("v") > threshold).groupBy(key, F.col("at").cast("bigint").alias("at")).agg(F.count("*").alias("ink"))


def ocr_confidence(words: Column) -> Column:
    """PR27: mean of the words' confidences (nested arrays are flattened first), 0.0 without any."""
    known = F.filter(words, lambda w: w.isNotNull())
    return F.when(F.size(known) > 0, F.aggregate(known, F.lit(0.0), lambda s, x: s + x) / F.size(known)).otherwise(F.lit(0.0))


def ocr_responses(batches: DataFrame, key: str) -> DataFrame:
    """PR28: a row per response of a batch, by its place among image_ids: an error gives '' and 0.0."""
    one = batches.select(key, "image_ids", F.posexplode("responses").alias("at", "r"))
    failed = F.col("r.error").isNotNull()
    return one.select(key, F.get("image_ids", F.col("at")).alias("image_id"), F.when(failed, F.lit("")).otherwise(F.coalesce("r.full_text", "r.annotation", F.lit(""))).alias("text"), F.when(failed, F.lit(0.0)).otherwise(F.coalesce("r.confidence", F.lit(0.0))).alias("confidence"))
