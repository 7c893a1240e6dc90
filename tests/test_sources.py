import json

from pyspark.sql import functions as F

from formloom.operators import survey
from formloom.sources import providers, readers, sinks
from formloom.streaming import manifest as stream


def test_readers(spark, tmp_path):
    (tmp_path / "in/a").mkdir(parents=True)
    for name in ("a/1.pdf", "a/2.PDF", "3.txt"):
        (tmp_path / "in" / name).write_bytes(b"x")
    found = readers.files(spark, str(tmp_path / "in"))
    assert {r.rel_path for r in found.collect()} == {"a/1.pdf", "a/2.PDF"}
    lines = ['{"rel_path":"a","status":"ok","page_num":1,"seconds":1.0}', "{bad", '{"rel_path":"a","status":"ok","page_num":2}', '{"rel_path":"b","status":"error"}', '{"rel_path":"","status":"ok"}']
    (tmp_path / "m.jsonl").write_text("\n".join(lines))
    assert [(r.rel_path, r.page_num) for r in readers.vision_manifest(spark, str(tmp_path / "m.jsonl")).collect()] == [("a", 2)]
    (tmp_path / "links.csv").write_text("﻿province,url\n ก ,https://x/folders/Ab-1?u=1\nข,\n")
    assert [tuple(r) for r in readers.province_links(spark, str(tmp_path / "links.csv")).collect()] == [("ก", "https://x/folders/Ab-1?u=1", "Ab-1"), ("ข", "", "")]
    (tmp_path / "r/x").mkdir(parents=True)
    (tmp_path / "r/x/result.json").write_text(json.dumps({"documents": [{"fields": {"field_1": {"value": "7"}}, "table": {"last_column_values": [{"value": "3"}]}}]}))
    regions = readers.result_regions(readers.cv_results(spark, str(tmp_path / "r")))
    assert [(r.region_id, r.value) for r in regions.collect()] == [("field_1", "7")]
    (tmp_path / "env").write_text("# c\nexport A='1'\nB=2\n")
    assert readers.env_settings(spark, str(tmp_path / "env")) == {"A": "1", "B": "2"}


def test_sinks(spark, tmp_path):
    sinks.write_report(spark.range(2).withColumn("x", F.lit(1)), ["id", "gone"], str(tmp_path / "r"))
    assert spark.read.option("header", "true").csv(str(tmp_path / "r")).columns == ["id", "gone"]
    for seq in (1, 2):
        sinks.append_manifest(spark.range(1).select(F.lit("a").alias("rel_path")), str(tmp_path / "m"), seq)
    assert spark.read.json(str(tmp_path / "m")).count() == 2
    plan = sinks.crop_plan(spark.createDataFrame([("a/1.pdf", "district"), ("2.pdf", None)], "rel_path string, kind string"), spark.createDataFrame([], "out_path string"), "kind")
    assert [r.out_path for r in plan.collect()] == ["cropped/district/1.pdf"]


def test_providers(spark):
    def render(content):
        if content == b"locked":
            raise ValueError("password needed")
        for n, width in enumerate((2, 3)):
            yield n, 1, width, 1, bytes(width)

    files = spark.createDataFrame([("a", b"x"), ("b", b"locked")], "rel_path string, content binary")
    pages = providers.same_width(providers.rendered_pages(files, render)).collect()
    assert sorted((r.rel_path, r.width, r.error) for r in pages if r.rel_path == "a") == [("a", 3, None), ("a", 3, None)]
    assert [r.error for r in pages if r.rel_path == "b"] == ["password"]
    items = spark.createDataFrame([("a", 1, "f"), ("b", 1, "f")], "rel_path string, page_num int, fingerprint string")
    out = providers.call_model(items, "fake", lambda row: '```json\n{"x": 1}\n```' if row["rel_path"] == "a" else "no json", 2, tries=1)
    assert {(r.rel_path, r.status) for r in out.collect()} == {("a", "ok"), ("b", "error")}
    calls = []

    def flaky():
        calls.append(1)
        if len(calls) < 3:
            raise OSError("busy")
        return "done"

    assert providers.with_retry(flaky, 4, sleep=lambda s: None) == "done" and len(calls) == 3


def test_stream(spark, tmp_path):
    src, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    put = lambda rows: spark.createDataFrame(rows, stream.MANIFEST).coalesce(1).write.mode("append").json(src)
    put([(1, "a", "f", "ok", 1.0), (2, "a", "f", "error", 1.0)])
    for more in ([(3, "b", "f", "ok", 1.0)], [(4, "a", "f", "ok", 2.0)]):
        put(more)
        stream.upsert_latest(stream.manifest_stream(spark, src, 1), out, mark, ["rel_path", "fingerprint"], "seq").awaitTermination()
    assert {(r.rel_path, r.seq) for r in stream.latest_version(spark, out).collect()} == {("a", 4), ("b", 3)}
    assert stream.latest_version(spark, str(tmp_path / "none")).count() == 0
    rows = stream.first_seen(stream.manifest_stream(spark, src), ["rel_path"])
    rows.writeStream.format("memory").queryName("first_seen").trigger(availableNow=True).start().awaitTermination()
    assert {r.rel_path for r in spark.table("first_seen").collect()} == {"a", "b"} and spark.table("first_seen").count() == 2
    done = []
    query = stream.resume(stream.manifest_stream(spark, src, 1), str(tmp_path / "done"), str(tmp_path / "mark2"), ["rel_path"], lambda b: (done.append(b.count()), b.withColumn("status", F.lit("ok")))[1])
    query.awaitTermination()
    assert sum(done) == 2


def test_other_readers(spark, tmp_path):
    for name in ("a/1.PNG", "b/2.jpeg", "b/3.Tif", "c.bmp", "d.gif"):
        (tmp_path / "in" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "in" / name).write_bytes(name.encode())
    found = readers.files(spark, str(tmp_path / "in"), readers.IMAGE_SUFFIXES, content=True)
    assert [r.rel_path for r in readers.in_path_order(found).collect()] == ["a/1.PNG", "b/2.jpeg", "b/3.Tif", "c.bmp"]
    pages = providers.decoded_images(found, lambda content: (1, len(content), 1, content))
    assert {(r.rel_path, r.width) for r in pages.collect()} == {("a/1.PNG", 7), ("b/2.jpeg", 8), ("b/3.Tif", 7), ("c.bmp", 5)}
    (tmp_path / "md/x").mkdir(parents=True)
    (tmp_path / "md/x/1.md").write_bytes("จำนวน\n\xff".encode("latin-1", "replace") + b"\xff")
    (tmp_path / "md/2.txt").write_text("no")
    (one,) = readers.markdown(spark, str(tmp_path / "md")).collect()
    assert one.path.endswith("/x/1.md") and one.text.endswith("\ufffd")
    (tmp_path / "c.csv").write_text("const_id,name\n น่าน-2 ,x\nน่าน-1,y\n")
    assert {tuple(r) for r in readers.constituency_ids(spark, str(tmp_path / "c.csv")).collect()} == {("น่าน-2", "น่าน"), ("น่าน-1", "น่าน")}
    (tmp_path / "l.json").write_text(json.dumps([{"Path": "a/b.pdf", "Name": "b.pdf", "Size": 7, "MimeType": "x", "ModTime": "2024-01-02T03:04:05Z", "ID": "i"}]))
    (listed,) = readers.remote_listing(spark, str(tmp_path / "l.json")).collect()
    assert (listed.path, listed.size, listed.file_id, listed.owner) == ("a/b.pdf", 7, "i", None)
    (tmp_path / "chosen.txt").write_text(" น่าน \n\nแพร่\nน่าน\n")
    assert sorted(r.province for r in readers.selected(spark, str(tmp_path / "chosen.txt")).collect()) == ["น่าน", "แพร่"]
    assert readers.existing(spark, str(tmp_path / "nowhere"), "x").count() == 0


def test_other_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("t", [1, None], None)], "a string, b array<int>, c date")
    sinks.write_json(rows, str(tmp_path / "j"))
    assert [json.loads(line) for f in (tmp_path / "j").glob("*.json") for line in f.read_text().splitlines()] == [{"a": "t", "b": [1, None]}]
    sinks.write_text(rows, "a", str(tmp_path / "t"))
    assert [f.read_text() for f in (tmp_path / "t").glob("*.txt")] == ["t\n"]
    inputs = spark.createDataFrame([("a/1.pdf", "district"), ("2.pdf", None)], "rel_path string, kind string")
    there = spark.createDataFrame([("cropped/district/1.pdf",)], "out_path string")
    plan = lambda **options: sorted(r.out_path for r in sinks.crop_plan(inputs, there, "kind", **options).collect())
    assert plan() == [] and plan(overwrite=True) == ["cropped/district/1.pdf"]
    assert plan(unknown="partylist") == ["cropped/partylist/2.pdf"] and plan(unknown="district", overwrite=True) == ["cropped/district/1.pdf", "cropped/district/2.pdf"]


def test_other_providers(spark):
    files = spark.createDataFrame([("a", b"xxx"), ("bad", b"")], "rel_path string, content binary")

    def count(content):
        if not content:
            raise ValueError("file is damaged")
        return len(content)

    assert {tuple(r) for r in providers.page_counts(files, count).collect()} == {("a", 3, None), ("bad", None, "corrupt")}
    pages = providers.rendered_page(files.withColumn("page_num", F.lit(2)), lambda content, page, dpi: (page, count(content), 1, bytes(dpi)), dpi=4)
    assert {(r.rel_path, r.height, r.width, bytes(r.pixels or b""), r.error) for r in pages.collect()} == {("a", 2, 3, bytes(4), None), ("bad", None, None, b"", "corrupt")}

    def extract(content):
        yield 1, [["n\n1", None], ["nan", "z"]]
        yield 1, [["q", "r", "s"]]
        count(content)

    rows = providers.table_rows(files, extract)
    assert rows.where("error is not null").count() == 1
    whole = survey.page_tables(rows.where("rel_path = 'a'"))
    assert sorted(tuple(r) for r in whole.collect()) == [(1, 0, "n 1", "", ""), (1, 1, "", "z", ""), (1, 2, "q", "r", "s")]

    def size_of(key):
        if key == "bad":
            raise OSError("no such folder")
        return json.dumps({"bytes": 9})

    answers = providers.asked(files.unionByName(files), "rel_path", size_of, tries=1)
    assert {tuple(r) for r in answers.collect()} == {("a", '{"bytes": 9}', None), ("bad", None, "OSError: no such folder")}


def test_vision_batch_resumes(spark, tmp_path):
    """Work items come as files; what is done isn't called again, what failed is."""
    src, done, mark = (str(tmp_path / n) for n in ("in", "done", "mark"))
    schema = "rel_path string, page_num int, fingerprint string, attempt int"
    put = lambda rows: spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(src)
    keys = ["rel_path", "page_num", "fingerprint"]

    def call(row):
        if row["rel_path"] == "b" and row["page_num"] == 1:
            raise ValueError("refused")
        return '```json\n{"voter_stats": {"ballots_used": 5}}\n```'

    def run():
        work = stream.manifest_stream(spark, src, schema=schema)
        stream.resume(work, done, mark, keys, lambda todo: providers.call_model(todo, "m", call, 2, tries=1)).awaitTermination()
        return {(r.rel_path, r.page_num): (r.status, r.n) for r in spark.read.json(done).groupBy("rel_path", "page_num").agg(F.max_by("status", "seconds").alias("status"), F.count("*").alias("n")).collect()}

    put([("a", 1, "f", 1), ("b", 1, "f", 1), ("b", 3, "f", 1)])
    assert run() == {("a", 1): ("ok", 1), ("b", 1): ("error", 1), ("b", 3): ("ok", 1)}
    put([("a", 1, "f", 2), ("b", 1, "f", 2), ("c", 1, "f", 2)])
    assert {k: n for k, (_, n) in run().items()} == {("a", 1): 1, ("b", 1): 2, ("b", 3): 1, ("c", 1): 1}
