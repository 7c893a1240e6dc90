import random

import numpy as np
from pyspark.sql import functions as F

from formloom.operators import layout, segment, survey, vision


def fold_first(flags, min_gap=1):
    out, last, skip = [], 0, False
    for i, flag in enumerate(flags):
        first = i == 0 or (not skip and flag and i - last > min_gap)
        if first:
            last = i
        skip = first
        out.append(first)
    return out


def test_segmentation(spark):
    rng = random.Random(1)
    files = {f"f{k}": [rng.random() < 0.5 for _ in range(rng.randint(1, 30))] for k in range(60)}
    rows = spark.createDataFrame([(f, i, v) for f, vs in files.items() for i, v in enumerate(vs)], "file string, page int, logo boolean")
    got = {}
    for r in segment.segment_pages(rows, "file", "page", "logo").orderBy("file", "page").collect():
        got.setdefault(r.file, []).append((r.is_first, r.document_id))
    for f, vs in files.items():
        first = fold_first(vs) if len(vs) >= 3 else [True] + [False] * (len(vs) - 1)
        assert [x[0] for x in got[f]] == first
        assert [x[1] for x in got[f]] == [sum(first[: i + 1]) - 1 for i in range(len(vs))]
    arrays = spark.createDataFrame([(f, vs) for f, vs in files.items()], "file string, flags array<boolean>")
    for gap in (1, 3):
        for r in arrays.select("file", segment.segment_fold(F.col("flags"), gap).alias("o")).collect():
            assert r.o == fold_first(files[r.file], gap)


def py_clusters(dots, tolerance=3.0):
    out = []
    for y, x in dots:
        if out and abs(y - out[-1][0]) <= tolerance:
            out[-1][1].append((y, x))
            out[-1][0] = sum(d[0] for d in out[-1][1]) / len(out[-1][1])
        else:
            out.append([float(y), [(y, x)]])
    return out


def py_sequences(xs):
    runs, run, gaps = [], [], 0
    for x in xs:
        dx = x - run[-1] if run else 10
        if 5 <= dx <= 15:
            run.append(x)
        elif 15 < dx <= 33 and gaps < 2:
            run.append(x)
            gaps += 1
        else:
            runs.append(run)
            run, gaps = [x], 0
    return [r for r in [*runs, run] if len(r) >= 5 and r[-1] - r[0] >= 100]


def test_folds(spark):
    rng = random.Random(2)
    data = []
    for k in range(40):
        dots = sorted((rng.randint(0, 60), rng.randint(0, 400)) for _ in range(30))
        xs, x = [], 0
        for _ in range(60):
            x += rng.choice([3, 8, 12, 12, 12, 20, 30, 40])
            xs.append(x)
        data.append((k, dots, xs))
    rows = spark.createDataFrame([(k, [{"y": y, "x": x} for y, x in d], xs) for k, d, xs in data], "k int, dots array<struct<y:bigint,x:bigint>>, xs array<bigint>")
    got = {r.k: r for r in rows.select("k", layout.y_clusters(F.col("dots")).alias("c"), layout.dot_sequences(F.col("xs")).alias("s"), layout.merge_keep_first(F.col("xs"), 9).alias("a"), layout.merge_running_mean(F.col("xs"), 9).alias("b")).collect()}
    for k, dots, xs in data:
        clusters = py_clusters(dots)
        assert [len(c.dots) for c in got[k].c] == [len(c[1]) for c in clusters]
        assert np.allclose([c.center for c in got[k].c], [c[0] for c in clusters])
        assert got[k].s == py_sequences(xs)
        first, mean = [], []
        for x in xs:
            if not first or x - first[-1] > 9:
                first.append(x)
            if mean and x - mean[-1] <= 9:
                mean[-1] = round((mean[-1] + x) / 2)
            else:
                mean.append(x)
        assert got[k].a == first and got[k].b == mean


def test_distinct_lines(spark):
    schema = "lines array<struct<y:int,x_start:bigint,x_end:bigint,length:bigint,dot_count:int>>"
    rows = spark.createDataFrame([([(10, 0, 100, 100, 5), (12, 1, 104, 103, 6), (40, 0, 100, 100, 5)],)], schema)
    assert [x.y for x in rows.select(layout.distinct_lines(F.col("lines")).alias("o")).first().o] == [12, 40]


def test_zncc(spark):
    rows = spark.createDataFrame([([1.0, 2.0, 3.0], [2.0, 4.0, 6.0], [5.0, 5.0, 5.0])], "a array<double>, b array<double>, c array<double>")
    r = rows.select(layout.zncc(F.col("a"), F.col("b")).alias("x"), layout.zncc(F.col("a"), F.col("c")).alias("y")).first()
    assert abs(r.x - 1) < 1e-12 and r.y is None


def test_owner_lookup_takes_one_owner_a_key(spark):
    rows = spark.createDataFrame([("p1", "f1"), ("p2", "f1"), ("p3", ""), ("p4", "f9")], "province string, folder_id string")
    owners = spark.createDataFrame([("f1", "b"), ("f1", "a"), ("f1", "b"), ("p3", "c")], "key string, owner string")
    got = sorted((r.province, r.owner) for r in survey.owner_lookup(rows, owners).collect())
    assert got == [("p1", "a"), ("p2", "a"), ("p3", "c"), ("p4", "not_scanned")]


def test_survey(spark):
    rows = spark.createDataFrame([("a", 0, "n", "f1", 3, 100, 1, ""), ("b", 1, "n", "f1", 4, 200, 1, ""), ("c", 2, "", "", 0, 0, 1, ""), ("d", 3, "s", "f2", 0, 0, 1, ""), ("e", 4, "s", "f3", 0, 0, 1, "timeout")], "province string, ord int, region string, folder_id string, files int, bytes long, constituencies int, error string")
    tags = {(r.province, r.tag, r.detail) for r in survey.anomalies(rows).collect()}
    assert tags == {("a", "duplicate_folder_id", "b"), ("b", "duplicate_folder_id", "a"), ("c", "missing_link", ""), ("d", "empty_folder", "")}
    assert tuple(survey.global_totals(rows).first()) == (4, 4, 200)
    assert {tuple(r) for r in survey.region_totals(rows).collect()} == {("n", 2, 3, 100), ("ไม่ระบุ", 1, 0, 0), ("s", 2, 0, 0)}
    far = spark.createDataFrame([(f"p{i}", 100 if i else 10_000, 1) for i in range(10)], "province string, bytes long, constituencies int")
    assert [(r.province, r.direction) for r in survey.outliers(far, "province").collect()] == [("p0", "high")]
    assert survey.outliers(far.limit(2), "province").count() == 0 and survey.outliers(far.where("bytes = 100"), "province").count() == 0
    assert "regions" in survey.size_report(rows).first().report


def test_dots_and_grid():
    image = np.full((300, 600), 255, np.uint8)
    yy, xx = np.mgrid[:300, :600]
    for x in range(60, 521, 12):
        image[(yy - 120) ** 2 + (xx - x) ** 2 <= 4] = 0
    assert len(vision.detect_dots(image)) == 39
    grid = np.full((400, 600), 255, np.uint8)
    for k in range(7):
        x = 20 + k * 93
        grid[20:380, x : x + 3] = 0
    for k in range(6):
        y = 20 + k * 71
        grid[y : y + 3, 20:581] = 0
    xs, ys = vision.table_lines(grid)
    assert len(xs) == 7 and len(ys) == 6
    assert abs(xs[0] - 21) <= 2 and vision.table_boundary(grid)[2] >= 560


def test_logo():
    page = np.full((800, 600), 255, np.uint8)
    logo = np.full((60, 60), 255, np.uint8)
    yy, xx = np.mgrid[:60, :60]
    logo[abs(np.hypot(yy - 30, xx - 30) - 24) < 2] = 0
    logo[28:32], logo[:, 28:32] = 0, 0
    page[40:100, 200:260] = logo
    hit = vision.detect_logo(page, logo)
    assert hit["detected"] and abs(hit["x"] - 200) <= 3 and abs(hit["y"] - 40) <= 3 and hit["confidence"] >= 0.7
    other = np.full((800, 600), 255, np.uint8)
    other[50:90, 200:300] = 0
    miss = vision.detect_logo(other, logo, threshold=0.95)
    assert not miss["detected"] and miss["confidence"] < 0.95


def test_kernels():
    rng = np.random.default_rng(0)
    image = rng.integers(0, 255, (40, 50)).astype(np.uint8)
    t = image[10:18, 20:30]
    s = vision.match_template(image, t)
    assert s.shape == (33, 41) and divmod(int(s.argmax()), 41) == (10, 20) and abs(s.max() - 1) < 1e-6
    mask = np.zeros((6, 8), np.uint8)
    mask[1, 1], mask[2, 2], mask[4, 5:7] = 1, 1, 1
    assert vision.component_boxes(mask) == [(1, 1, 2, 2, 2), (5, 4, 2, 1, 2)]
    assert vision.is_empty(np.full((20, 20), 255, np.uint8)) and vision.for_ocr(np.zeros((10, 10), np.uint8)).min() == 255
    assert vision.heat_map(np.array([[-1.0, 0.5, 2.0]])).tolist() == [[0, 128, 255]] and vision.heat_map(np.array([[0.25]]), True).tolist() == [[191]]
    assert {m: vision.prepared(image, m).shape for m in ("raw", "eq", "blur", "otsu")}["eq"] == (40, 50)
