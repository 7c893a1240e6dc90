from pyspark.sql import functions as F

from formloom.operators import counts, evaluate, manifest, reconcile, validate

F_ = validate.FIELDS


def forms(spark, *rows):
    return spark.createDataFrame([(i, *(r.get(n) for n in range(1, 9))) for i, r in enumerate(rows)], "k long, " + ", ".join(f"{c} long" for c in F_))


GOOD = {1: 640, 2: 512, 3: 600, 4: 512, 5: 470, 6: 25, 7: 17, 8: 88}


def test_ballot_identities(spark):
    rows = forms(spark, GOOD, {4: 512, 5: 470, 6: 25, 7: 9}, {3: 700, 4: 512, 8: 88}, {2: 512, 4: 470}, {6: 3}, {})
    got = validate.ballot_identities(rows, ["k"]).collect()
    assert {(r.k, r.chk) for r in got} == {(1, "ballot_breakdown_sum"), (2, "ballot_allocation_sum"), (3, "voters_vs_ballots")}


def cells(spark, **tables):
    return spark.createDataFrame([(k, i, str(v) if v is not None else None) for k, vs in tables.items() for i, v in enumerate(vs)], "k string, ord int, value string")


def test_table_totals(spark):
    rows = cells(spark, ok=[41, 73, 19, 133], bad=[41, 73, 19, 140], one=[41], text=["x", 2, 9])
    assert [tuple(r) for r in validate.table_total_check(rows, "k").collect()] == [("bad", "table_column_sum", 133, 140)]
    stats = spark.createDataFrame([("t", 77)], "k string, valid_ballots long")
    assert validate.table_vs_valid(cells(spark, t=[12, 30, 42]), stats, "k").count() == 1


def test_completeness(spark):
    rows = spark.createDataFrame([(k, n) for k, n in (("all", 8), ("six", 6)) for n in range(n)], "k string, value int")
    assert [tuple(r) for r in validate.completeness(rows, "k").collect()] == [("six", "incomplete_fields", "missing 2")]


def test_all_findings_in_order(spark):
    rows = forms(spark, GOOD, {4: 512, 5: 470, 6: 25, 7: 9, 2: 500})
    table = cells(spark, **{"1": [200, 200, 401], "7": [1, 2, 4]}).select(F.col("k").cast("long").alias("k"), "ord", "value")
    fields = rows.unpivot(["k"], list(F_), "field", "value")
    got = [(r.k, r.chk, r.detail) for r in validate.validate_forms(rows, table, fields, "k").coalesce(1).orderBy("k").collect()]
    one = [("ballot_breakdown_sum", "504 != 512"), ("voters_vs_ballots", "500 != 512"), ("table_column_sum", "400 != 401"), ("table_total_vs_valid_ballots", "401 != 470"), ("incomplete_fields", "missing 3")]
    assert got == [(1, *f) for f in one] + [(7, "table_column_sum", "3 != 4")]


def test_vision_stats(spark):
    rows = [(1, "260", "8", "4", "272", "255"), (2, "260", "8", "4", "301", "255"), (3, "140", "2", "1", "143", "520"), (4, "90", None, None, None, None), (5, " 333", "11", "๖", "350", "320"), (6, "7x", "1", "1", "2", "3")]
    df = spark.createDataFrame(rows, "k int, valid_ballots string, invalid_ballots string, no_vote_ballots string, ballots_used string, total_candidate_votes string")
    assert {(r.k, r.chk) for r in validate.vision_stats_checks(df, ["k"]).collect()} == {(2, "ballot_sum"), (3, "votes_exceed_valid")}


def test_triage_reasons(spark):
    rows = spark.createDataFrame([("5", 0.9), ("5", 0.5), ("5000", 0.9), ("5000", 0.1), (None, None)], "value string, confidence double")
    assert [r.reason for r in validate.triaged(rows, True).collect()] == [None, "low_confidence", "outlier_value", "low_confidence", "low_confidence"]
    fields = validate.triaged(rows.withColumn("value", F.when(F.col("value") == "5000", "50000").otherwise(F.col("value"))), False)
    assert [r.reason for r in fields.collect()] == [None, "low_confidence", "validation_warning", "low_confidence", "low_confidence"]


def test_reconcile(spark):
    regions = spark.createDataFrame([("a", "doc0_field_5", 0, "1"), ("a", "field_5", 1, "431"), ("a", "field_9", 2, "3"), ("b", "field_1", 0, "62")], "k string, region_id string, ord int, value string")
    assert {tuple(r) for r in reconcile.cv_fields(regions, "k").collect()} == {("a", 5, 431), ("b", 1, 62)}
    columns = [f"{s}_{n}" for n in range(1, 8) for s in ("cv", "vision")] + ["cv_total", "vision_total", "candidate_sum"]
    rows = [("x", *[None] * 8, 431, 440, *[None] * 4, 215, 215, 205), ("y", *[None] * 8, 431, 431, *[None] * 4, None, 215, None)]
    got = reconcile.reconcile(spark.createDataFrame(rows, "k string, " + ", ".join(f"{c} long" for c in columns)), "k").collect()
    assert [tuple(r) for r in got] == [("x", "field_mismatch", "valid_ballots", 5, 431, 440, 9), ("x", "gemini_candidate_sum_mismatch", "sum(candidates.votes) vs total_candidate_votes", None, None, 215, 10)]
    assert reconcile.samples(spark.range(20).withColumn("g", F.lit(1)), "g", ["id"]).count() == 5


def test_candidate_total(spark):
    rows = spark.createDataFrame([([1, 2],), ([1, None],), ([],), (None,)], "v array<int>")
    assert [r[0] for r in rows.select(reconcile.candidate_total(F.col("v"))).collect()] == [3, None, None, None]


def test_evaluate(spark):
    truth = spark.createDataFrame([(1, "blue", "p", 64), (1, "blue", "p", None), (2, None, "p", 31)], "k int, ink string, province string, gt long").withColumn("field", F.lit("f")).where("gt is not null")
    pred = spark.createDataFrame([(1, "f", 71)], "k int, field string, pred long")
    rows = evaluate.detail(truth, pred, ["k"])
    assert {(r.k, r.correct, r.abs_error) for r in rows.collect()} == {(1, False, 7), (2, False, None)}
    metrics = evaluate.grouped_metrics(rows)
    assert {(r.gid, r.n_fields, r.err_sum, r.err_n) for r in metrics.where("gid = 7").collect()} == {(7, 2, 7, 1)}
    assert evaluate.with_strata_guard(metrics).where("gid = 5").count() == 0  # a single province
    assert evaluate.rates(metrics).where("gid = 7").first().mae == 7.0


def test_manifest(spark):
    rows = spark.createDataFrame([(1, "a", "f", "ok"), (2, "a", "f", "error"), (3, "b", "f", "error"), (4, "", "f", "ok")], "seq int, rel string, fp string, status string")
    assert {(r.rel, r.seq) for r in manifest.last_wins(rows, ["rel", "fp"], "seq").collect()} == {("a", 2), ("b", 3), ("", 4)}
    assert {(r.rel, r.seq) for r in manifest.matched_latest(rows, ["rel"], "seq").collect()} == {("a", 1)}
    inputs = spark.createDataFrame([("a", "x", "x", False), ("b", None, "x", True), ("c", None, "x", True)], "rel string, embedded_fingerprint string, fingerprint string, output_exists boolean")
    assert {(r.rel, r.action) for r in manifest.split_pending(inputs, rows, ["rel"]).collect()} == {("a", "skipped"), ("b", "skipped"), ("c", "pending")}
    assert {(r.rel, r.action) for r in manifest.split_pending(inputs, rows, ["rel"], require_ok=True).collect()} == {("a", "skipped"), ("b", "pending"), ("c", "pending")}
    pages = spark.createDataFrame([("a", 5), ("b", 0)], "rel string, n int")
    assert [r.page_num for r in manifest.odd_pages(pages, "n").collect()] == [1, 3, 5]


def test_counts(spark):
    text = "<!-- rel_path=district/1.md -->\n<!-- rel_path=other.md -->\n\n2.3 ผู้มาใช้สิทธิ : จำนวน ๔๐๒ คน กับ จำนวน 7 บัตร\nจำนวน 8 คนงาน\nจำนวน 3 บัตร์"
    files = spark.createDataFrame([("m.md", text), ("e.md", ""), ("n.md", None)], "path string, text string")
    got = sorted(counts.count_items(files).collect(), key=lambda r: r.order)
    assert [(r.order, r.schema, r.label, r.value, r.unit) for r in got] == [(0, "2.3", "ผู้มาใช้สิทธิ", 402, "คน"), (1, "2.3", "ผู้มาใช้สิทธิ : จำนวน ๔๐๒ คน กับ", 7, "บัตร"), (2, "", "", 3, "บัตร")]
    assert {r.rel_path for r in got} == {"district/1.md"}
    assert {(r.rel_path, len(r.counts)) for r in counts.count_files(files).collect()} == {("district/1.md", 3), ("e.md", 0), ("n.md", 0)}


def test_plans_stay_native(spark):
    from formloom.plans import catalog

    for name in ("ballot_identities", "reconcile_pipelines", "eval_metrics_grouping_sets", "count_extraction", "doc_segmentation"):
        plan = catalog.QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan
