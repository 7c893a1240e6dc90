"""Pixel kernels and the form pipeline on drawn pages."""

import json

import numpy as np

from formloom.operators import forms, layout, vision
from formloom.sources import providers, readers, sinks
from formloom.streaming import manifest as stream


def logo_image():
    logo = np.full((40, 40), 255, np.uint8)
    yy, xx = np.mgrid[:40, :40]
    logo[abs(np.hypot(yy - 20, xx - 20) - 15) < 2] = 0
    logo[18:22, 5:35] = 0
    return logo


def anchor_image(kind):
    image = np.full((24, 60), 255, np.uint8)
    image[4:20, 4:10] = 0
    image[4:8 if kind else 20, 20:50] = 0
    image[(14 if kind else 4) : 20, 40:56] = 0
    return image


def draw_table(page, x0, y0, columns, rows, cw=110, ch=46, dotted_rows=()):
    """A grid of lines of two pixels; the last cells of dotted rows hold a dotted line and a stroke."""
    for k in range(columns + 1):
        page[y0 : y0 + rows * ch + 2, x0 + k * cw : x0 + k * cw + 2] = 0
    for k in range(rows + 1):
        page[y0 + k * ch : y0 + k * ch + 2, x0 : x0 + columns * cw + 2] = 0
    for r in dotted_rows:
        left, base = x0 + (columns - 1) * cw + 12, y0 + r * ch + 34
        for k in range(9):
            yy, xx = np.mgrid[-2:3, -2:3]
            page[base - 2 : base + 3, left + 10 * k : left + 10 * k + 5][np.hypot(yy, xx) <= 2.3] = 0
        page[y0 + r * ch + 10 : y0 + r * ch + 26, left + 20 : left + 26] = 0


def form_pages():
    first = np.full((900, 640), 255, np.uint8)
    first[20:60, 300:340] = logo_image()
    first[150:174, 40:100] = anchor_image(0)
    first[330:354, 40:100] = anchor_image(1)
    first[230:250, 200:400] = 30
    draw_table(first, 60, 520, 4, 7, dotted_rows=(1, 2, 4))
    second = np.full((900, 640), 255, np.uint8)
    draw_table(second, 60, 80, 4, 6, dotted_rows=(1, 5))
    blank = np.full((900, 640), 255, np.uint8)
    third = first.copy()
    return [first, second, blank, third]


LAYOUT = forms.Layout(search=7, logo=vision.Template.of("logo", logo_image()), anchors=((vision.Template.of("b2", 255 - anchor_image(0)), vision.Template.of("e2", anchor_image(1))), (vision.Template.of("b", anchor_image(0)), vision.Template.of("e", anchor_image(1)))))


def test_form_pipeline(spark, tmp_path):
    drawn = form_pages()

    def renderer(content):
        if content == b"locked":
            raise ValueError("password needed")
        for n, image in enumerate(drawn):
            yield n, *image.shape, 1, image.tobytes()

    def read_text(image):
        return str(int((image < 200).sum()) % 900), 0.9

    for name, content in (("a/1.pdf", b"x"), ("b/2.pdf", b"x"), ("locked.pdf", b"locked"), ("done.pdf", b"x")):
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_bytes(content)
    (tmp_path / "out/done").mkdir(parents=True)
    (tmp_path / "out/done/result.json").write_text("{}")
    items, counts = forms.process_inputs(spark, str(tmp_path / "in"), str(tmp_path / "out"), renderer, LAYOUT, read_text)
    assert {(r.rel_path, r.status, r.n_pages, r.error) for r in items.collect()} == {("a/1.pdf", "ok", 4, None), ("b/2.pdf", "ok", 4, None), ("locked.pdf", "error", None, "password"), ("done.pdf", "skipped", None, None)}
    assert tuple(counts.first()) == (4, 2, 1, 1)
    result = json.loads((tmp_path / "out/a/1/result.json").read_text())
    assert not list((tmp_path / "out").rglob("*.tmp")) and result["n_documents"] == 2
    one, two = sorted(result["documents"], key=lambda d: d["document_id"])
    assert (one["pages"], two["pages"]) == ([0, 1, 2], [3])
    assert [f["region_id"] for f in one["fields"]] == ["doc0_p1_fields_band"]
    assert abs(one["fields"][0]["y"] - 90) <= 4 and abs(one["fields"][0]["h"] - 324) <= 8  # the second pair of anchors, padded
    # rows: grid rows of the page, after the cells kept on earlier pages
    assert [c["region_id"] for c in one["cells"]] == [f"table_p{p}_r{r}_c4" for p, r in ((1, 1), (1, 2), (1, 4), (2, 4), (2, 8))]
    assert [c["status"] for c in one["cells"]] == ["auto_accepted"] * 5 and one["total_extractions"] == 6
    assert {r["reason"] for r in one["manual_review"]} == {"table_detection_failed"}
    values = [int(c["value"]) for c in one["cells"]]
    assert [w["chk"] for w in one["warnings"]] == (["table_column_sum"] if sum(values[:-1]) != values[-1] else [])
    again, counts = forms.process_inputs(spark, str(tmp_path / "in"), str(tmp_path / "out"), renderer, LAYOUT, read_text)
    assert tuple(counts.first()) == (4, 0, 3, 1)


def test_failed_calls_and_numbered_fields(spark):
    def broken(image):
        raise OSError("busy")

    regions = spark.createDataFrame([("a", 0, "field_1", 2, 2, b"\xff" * 4)], "rel_path string, document_id long, region_id string, image_height int, image_width int, image binary")
    assert [(r.text, r.confidence, r.error) for r in forms.recognised(regions, broken).collect()] == [("", 0.0, "OSError: busy")]
    figures = {1: 611, 2: 402, 3: 480, 4: 402, 5: 371, 6: 18, 7: 12, 8: 78}
    rows = [("a", 0, f"doc0_p1_field_{n}", "fields", 0, None, v, str(v), 0.9) for n, v in figures.items()]
    rows += [("a", 0, f"t{r}", "cell", 1, r, v, str(v), 0.9) for r, v in ((1, 210), (2, 161), (3, 370))]
    table = spark.createDataFrame(rows, "rel_path string, document_id long, region_id string, kind string, page_num int, row int, parsed long, value string, confidence double")
    assert {(r.chk, r.detail) for r in forms.findings(table).collect()} == {("ballot_breakdown_sum", "401 != 402"), ("table_column_sum", "371 != 370"), ("table_total_vs_valid_ballots", "370 != 371")}


def test_crop_kernels():
    rng = np.random.default_rng(2)
    page = form_pages()[0]
    cell = page[520 + 46 : 520 + 92, 60 + 330 : 60 + 440]
    assert vision.dotted(cell) and not vision.dotted(page[520 + 138 : 520 + 184, 60 + 330 : 60 + 440])
    bw = vision.cell_image(cell)
    assert set(np.unique(bw)) <= set(range(256)) and (bw < 200).sum() >= 60 and bw.shape[0] < 46
    lined = page[230:260, 380:560].copy()
    assert (vision.without_lines(lined) < 200).sum() < (lined < 200).sum()
    dots = np.full((40, 200), 255, np.uint8)
    for x in range(10, 190, 12):
        dots[20:24, x : x + 4] = 0
    dots[5:35, 95:125] = 0
    clean = vision.without_dots(dots)
    assert (clean[20:24, 10:14] == 255).all() and (clean[5:15, 95:125] == 0).all()
    flat = rng.integers(100, 130, (80, 96)).astype(np.uint8)
    assert vision.evened(flat).std() > flat.std() and vision.evened(np.full((9, 9), 7, np.uint8)).std() == 0
    noisy = np.full((30, 30), 120, np.uint8) + rng.integers(0, 4, (30, 30)).astype(np.uint8)
    assert vision.denoised(noisy, search=9).std() < noisy.std()
    assert vision.field_box(50, 30, 200, 400, 200) == (20, 0, 190, 110)
    assert vision.field_image(page[200:260, 180:420], search=5).shape == (60, 240)


def test_anchors():
    page = form_pages()[0]
    begin, end = (vision.Template.of(str(k), anchor_image(k)) for k in (0, 1))
    assert vision.anchored_band(page, [(begin, end)], scales=[1.0]) == {"y0": 90, "y1": 414, "pair": 0, "confidences": [1.0, 1.0]} or vision.anchored_band(page, [(begin, end)], scales=[1.0])["y0"] == 90
    assert vision.anchored_band(page, [(end, begin)], scales=[1.0])["pair"] is None  # the end above the begin
    assert vision.anchored_band(page[:, ::-1], [(begin, end)], threshold=0.95, scales=[1.0])["pair"] is None
    assert vision.head_zone(page, begin, end)["y0"] == 70
    assert begin.at(0.001).shape == (8, 8) and vision.scale_range(0.5, 0.7, 0.1) == [0.5, 0.6, 0.7]
    assert vision.fraction_box((100, 50), 0.9, -1, 1.0, 1.0) == (0, 45, 99, 100)


def test_template_diagnostic(spark):
    page = form_pages()[0]
    logo = vision.Template.of("logo", logo_image())
    hits = vision.template_hits(page, logo, ["raw", "eq", "blur", "otsu", "canny"], ["TM_CCOEFF_NORMED", "TM_SQDIFF_NORMED"], [0.9, 1.0], (0.2, 0.8, 0.0, 0.5))
    assert len(hits) == 10 and hits == sorted(hits, key=lambda h: -h["score"])
    raw = {h["method"]: h for h in hits if h["mode"] == "raw"}
    assert all((h["x"], h["y"], h["scale"]) == (300 - 128, 20, 1.0) and h["score"] > 0.99 for h in raw.values())
    pages = spark.createDataFrame([("a", 0, *page.shape, 1, page.tobytes())], "rel_path string, page_num int, height int, width int, channels int, pixels binary")
    found = vision.diagnosed(pages, [logo], ["raw", "canny"], ["TM_CCOEFF_NORMED"], [1.0]).collect()
    assert [r.rank for r in found] == [1, 2] and found[0].accepted


def test_grid_tables(spark):
    pages = spark.createDataFrame([("a", n, *p.shape, 1, p.tobytes()) for n, p in enumerate(form_pages()[:3])], "rel_path string, page_num int, height int, width int, channels int, pixels binary")
    tables = vision.page_tables(pages)
    rows = {r.page_num: r for r in tables.collect()}
    assert set(rows) == {0, 1} and (len(rows[0].x_lines), len(rows[0].y_lines), len(rows[1].y_lines)) == (5, 8, 7)
    cells = layout.grid_cells(tables.select("page_num", "x_lines", "y_lines"), "page_num")
    assert cells.where("page_num = 0").count() == 28 and abs(cells.where("page_num = 0 and row = 0 and col = 0").first().w - 110) <= 2


def test_written_files(spark, tmp_path):
    image = np.arange(48, dtype=np.uint8).reshape(4, 4, 3)
    rows = spark.createDataFrame([(f"{tmp_path}/x/{k}.png", sinks.png(image)) for k in range(3)] + [(f"{tmp_path}/e.json", None)], "path string, content binary")
    assert sinks.write_files(rows) == 4 and (tmp_path / "e.json").read_bytes() == b"" and len(list(tmp_path.rglob("*.png"))) == 3
    page = np.full((200, 100), 9, np.uint8)
    pages = spark.createDataFrame([("a", 0, 200, 100, 1, page.tobytes())], "rel_path string, page_num int, height int, width int, channels int, pixels binary")
    plan = spark.createDataFrame([("a", 0, "p", 0.0, 0.0, 18.0, 36.0), ("a", 0, "q", 900.0, 0.0, 901.0, 9.0)], "rel_path string, page_num int, path string, x0 double, y0 double, x1 double, y1 double")
    (crop,) = sinks.crops(pages, plan).collect()
    assert crop.path == "p" and crop.content[16:24] == (50).to_bytes(4, "big") + (100).to_bytes(4, "big")


def test_last_line_of_several_files_wins(spark, tmp_path):
    import os

    lines = lambda *pages: "\n".join(f'{{"rel_path":"a","status":"ok","page_num":{p}}}' for p in pages)
    for name, text, at in (("z.json", lines(1, 2), 1000), ("a.json", lines(3, 4, 5), 2000)):
        (tmp_path / name).write_text(text)
        os.utime(tmp_path / name, (at, at))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "60b")  # lines of a file lie in several splits
    try:
        assert [r.page_num for r in readers.vision_manifest(spark, str(tmp_path)).collect()] == [5]
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    truth = '{"rel_path":"a","page_num":1,"ink_type":"%s"}'
    (tmp_path / "gt").write_text(truth % "x" + "\n" + truth % "y")
    assert [r.ink_type for r in readers.ground_truth(spark, str(tmp_path / "gt")).collect()] == ["y"]


def test_page_of_other_widths(spark):
    pages = spark.createDataFrame([("a", 0, 1, 2, 1, b"\0\0", None), ("a", 1, 1, 3, 1, b"\0\0\0", None)], providers.PAGE)
    assert {bytes(r.pixels) for r in providers.same_width(pages).collect()} == {b"\0\0\xff", b"\0\0\0"}


def test_batches_done_twice(spark, tmp_path):
    src, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    put = lambda rows: spark.createDataFrame(rows, stream.MANIFEST).coalesce(1).write.mode("append").json(src)
    keys = ["rel_path", "fingerprint"]
    for n in range(4):
        put([(10 * n + k, f"f{k % (n + 2)}", "p", "ok", 1.0) for k in range(5)])
        stream.upsert_latest(stream.manifest_stream(spark, src), out, mark, keys, "seq", 4).awaitTermination()
        want = {r.rel_path: r.seq for r in stream.latest_version(spark, out).collect()}
        # the last batch again, as after a failure between its write and its commit
        for f in (tmp_path / "mark/commits").glob(f"*{n}*"):
            f.unlink()
        stream.upsert_latest(stream.manifest_stream(spark, src), out, mark, keys, "seq", 4).awaitTermination()
        assert {r.rel_path: r.seq for r in stream.latest_version(spark, out).collect()} == want
    assert want == {"f0": 30, "f1": 31, "f2": 32, "f3": 33, "f4": 34}
    assert all(len(p) <= 2 for p in stream.bucket_paths(spark, out).values())
    done, calls = str(tmp_path / "done"), []

    def process(todo):
        calls.append(sorted(r.rel_path for r in todo.collect()))
        return todo.withColumn("status", stream.F.lit("ok"))

    for again in (False, True):
        if again:
            for f in (tmp_path / "mark2/commits").glob("*0*"):
                f.unlink()
        stream.resume(stream.manifest_stream(spark, src), done, str(tmp_path / "mark2"), ["rel_path"], process).awaitTermination()
    assert calls[0] == calls[1] == [f"f{k}" for k in range(5)]
    put([(99, "f1", "p", "ok", 1.0), (98, "new", "p", "ok", 1.0)])
    stream.resume(stream.manifest_stream(spark, src), done, str(tmp_path / "mark2"), ["rel_path"], process).awaitTermination()
    assert calls[-1] == ["new"]
