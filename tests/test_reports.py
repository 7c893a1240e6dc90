"""Reports and rules that their queries don't show in full."""

import json

from pyspark.sql import functions as F

from formloom.operators import layout, survey


def provinces(spark):
    rows = [(f"p{k}", k, f"f{k}", 3, 1000 + k, 10, "") for k in range(9)] + [("far", 9, "f9", 3, 9000, 10, ""), ("none", 10, "", 0, 0, 1, ""), ("bad", 11, "f11", 0, 0, 1, "timeout")]
    return spark.createDataFrame(rows, "province string, ord long, folder_id string, files long, bytes long, constituencies long, error string").withColumn("region", F.lit("north"))


def test_outlier_detail(spark):
    values = [(1000 + k) / 10 for k in range(9)] + [900.0]
    mean = sum(values) / 10
    sigma = (sum((v - mean) ** 2 for v in values) / 10) ** 0.5
    found = [(r.province, r.detail) for r in survey.anomalies(provinces(spark)).collect() if r.tag == "size_outlier"]
    assert found == [("far", f"high outlier: {(900 - mean) / sigma:+.1f}σ per-constituency")]
    assert survey.outliers(provinces(spark).limit(2), "province").count() == 0


def test_size_report(spark):
    report = json.loads(survey.size_report(provinces(spark)).first().report)
    assert report["files"] == 30 and report["bytes"] == sum(1000 + k for k in range(9)) + 9000
    assert {(s["status"], s["n"]) for s in report["statuses"]} == {("scanned", 10), ("error", 1), ("skipped", 1)}
    assert {(a["tag"], a["n"]) for a in report["anomalies"]} == {("missing_link", 1), ("size_outlier", 1)}


def test_templates_in_blocks(spark):
    images = spark.createDataFrame([(k, [float((k * j) % 7) for j in range(9)]) for k in range(1, 6)], "vec_id long, vector array<double>")
    templates = images.unionByName(images.withColumn("vec_id", F.col("vec_id") + 10)).select(F.col("vec_id").alias("template_id"), F.col("vector").alias("template"))
    for last in (True, False):
        whole = sorted(layout.best_template(images, templates, "vec_id", last_wins=last).collect())
        assert whole == sorted(layout.best_template(images, templates, "vec_id", block=2, last_wins=last).collect())
        assert [r.template_id for r in whole] == [k + 10 * last for k in range(1, 6)]


def test_largest_first(spark):
    rows = spark.createDataFrame([("a", 1, 5), ("b", 2, 9), ("c", 3, 5)], "province string, ord long, bytes long")
    assert [r.province for r in survey.by_size(rows).collect()] == ["b", "a", "c"]


def test_master_listing_cells(spark, monkeypatch):
    """Folders that are large on either side, on both and on none; copies, folders of one side only, missing ones."""
    monkeypatch.setattr(survey, "CELL", 4)
    links = [(f"p{k}", k, f) for f, n in (("both", 30), ("linked", 50), ("filed", 1), ("small", 2), ("nowhere", 9), ("", 2), (None, 9)) for k in range(n)] + [("p0", 0, "both")] * 3
    files = [(f, k, None if k % 7 == 3 else f"{f}/{k}", k * 10) for f, n in (("both", 30), ("linked", 1), ("filed", 50), ("small", 3), ("unlinked", 9), ("", 2), (None, 9)) for k in range(n)] + [("both", 5, "both/5", 50)] * 3
    want = [(f, p, *rest) for p, _, f in links for g, *rest in files if f is not None and f == g]
    got = survey.master_listing(spark.createDataFrame(files, "folder_id string, ord long, path string, size long"), spark.createDataFrame(links, "province string, ord long, folder_id string"))
    assert got.columns == ["folder_id", "province", "ord", "path", "size"]
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, got.collect()), key=key) == sorted(want, key=key)


def test_master_listing_is_dealt(spark):
    """One folder's rows are made in all partitions, about evenly."""
    files = spark.range(2000, numPartitions=1).selectExpr("concat('f', id div 2000) AS folder_id", "id AS ord", "concat('x', id) AS path", "id AS size")
    links = spark.range(2000, numPartitions=1).selectExpr("concat('p', id) AS province", "id AS ord", "concat('f', id div 2000) AS folder_id")
    made = [r["count"] for r in survey.master_listing(files, links).groupBy(F.spark_partition_id()).count().collect()]
    assert sum(made) == 4_000_000 and len(made) == 2 and min(made) > 400_000


def test_master_listing_computes_a_file_once(spark):
    """Between what is computed of a file and the join that repeats it lies an exchange."""
    files = spark.range(40).selectExpr("concat('f', id % 2) AS folder_id", "id AS ord", "concat('x', id) AS path", "length(repeat('x', cast(id AS int))) AS size")
    links = spark.range(40).selectExpr("concat('p', id) AS province", "id AS ord", "concat('f', id % 3) AS folder_id")
    plan = survey.master_listing(files, links)._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    top = next(k for k, line in enumerate(plan) if "Join [" in line)
    at = next(k for k, line in enumerate(plan) if "length(" in line)
    above = [line for k, line in enumerate(plan[top:at], top) if depth(line) < min(map(depth, plan[k + 1 : at + 1]))]
    assert any("Exchange hashpartitioning" in line for line in above)
