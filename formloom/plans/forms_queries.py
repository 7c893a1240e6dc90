"""Queries over forms: validation, reconciliation, evaluation, manifests and text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formloom.functions import text as T
from formloom.functions.paths import path_metadata
from formloom.operators import counts, evaluate, manifest, reconcile, validate
from formloom.plans import bindings as B
from formloom.plans.registry import Registry
from formloom.session import table

query = Registry()
QUERIES, ORACLE_SQL = query.queries, query.sql
Frame, Session = DataFrame, SparkSession

IDENTITIES = """
  SELECT k, 'ballot_breakdown_sum' AS chk, (valid_ballots + invalid_ballots + no_vote_ballots) || ' != ' || ballots_used AS detail FROM forms WHERE valid_ballots + invalid_ballots + no_vote_ballots <> ballots_used
  UNION ALL SELECT k, 'ballot_allocation_sum', (ballots_used + ballots_remaining) || ' != ' || ballots_allocated FROM forms WHERE ballots_used + ballots_remaining <> ballots_allocated
  UNION ALL SELECT k, 'voters_vs_ballots', voters_appeared || ' != ' || ballots_used FROM forms WHERE voters_appeared <> ballots_used"""


@query(B.with_sql("base", "forms") + IDENTITIES)
def ballot_identities(spark: Session, sf: str) -> Frame:
    return validate.ballot_identities(B.forms(spark, sf), ["k"])


STATUS = "CASE WHEN confidence >= 0.70e0 THEN 'auto_accepted' WHEN confidence >= 0.40e0 THEN 'review_queue' ELSE 'manual_entry' END"
CHECKED = f"checked AS (SELECT k, ord, v AS parsed, CASE WHEN v BETWEEN 0 AND 1000 THEN 'pass' ELSE 'warning: out_of_range (' || v || ' not in [0,1000])' END AS range_check, {STATUS} AS status FROM cells)"


@query(B.with_sql("lines", "cells") + f", {CHECKED} SELECT *, CASE WHEN status = 'manual_entry' THEN 'low_confidence' WHEN range_check <> 'pass' THEN 'outlier_value' WHEN status <> 'auto_accepted' THEN 'low_confidence' END AS reason FROM checked")
def validate_cells(spark: Session, sf: str) -> Frame:
    return validate.triaged(B.text_cells(spark, sf), True).select("k", "ord", "parsed", "range_check", "status", "reason")


@query(B.with_sql("lines", "cells") + f", {CHECKED} SELECT k, ord, status, 'outlier_value' AS reason FROM checked WHERE status <> 'manual_entry' AND range_check <> 'pass' UNION ALL SELECT k, ord, status, 'low_confidence' FROM checked WHERE status = 'review_queue' AND range_check = 'pass'")
def review_queue(spark: Session, sf: str) -> Frame:
    rows = validate.triaged(B.text_cells(spark, sf), True)
    return rows.where("status <> 'manual_entry' and reason is not null").select("k", "ord", "status", "reason")


@query(B.with_sql("lines", "cells") + f", {CHECKED} SELECT count(*) AS total_extractions, count(*) FILTER (status = 'auto_accepted' AND range_check = 'pass') AS auto_accepted, count(*) FILTER (status <> 'manual_entry' AND NOT (status = 'auto_accepted' AND range_check = 'pass')) AS review_queue, count(*) FILTER (status = 'manual_entry') AS manual_entry FROM checked")
def triage_counts(spark: Session, sf: str) -> Frame:
    return validate.triage_counts(validate.triaged(B.text_cells(spark, sf), True))


TOTALS = "totals AS (SELECT k, count(*) AS n_rows, CAST(sum(v) - arg_max(v, ord) AS BIGINT) AS rows_sum, arg_max(v, ord) AS total FROM cells GROUP BY k)"


@query(B.with_sql("lines", "cells") + f", {TOTALS} SELECT k, 'table_column_sum' AS chk, rows_sum, total FROM totals WHERE n_rows >= 2 AND rows_sum <> total")
def table_total_check(spark: Session, sf: str) -> Frame:
    return validate.table_total_check(B.text_cells(spark, sf), "k")


@query(B.with_sql("base", "forms", "lines", "cells") + f", {TOTALS} SELECT k, 'table_total_vs_valid_ballots' AS chk, total, valid_ballots FROM totals JOIN forms USING (k) WHERE n_rows >= 2 AND total <> valid_ballots")
def table_vs_valid(spark: Session, sf: str) -> Frame:
    return validate.table_vs_valid(B.text_cells(spark, sf), B.forms(spark, sf), "k")


@query(B.with_sql("base", "forms", "long", "gt") + "SELECT k, 'incomplete_fields' AS chk, 'missing ' || (8 - count(gt)) AS detail FROM gt GROUP BY k HAVING count(gt) BETWEEN 1 AND 7")
def completeness(spark: Session, sf: str) -> Frame:
    return validate.completeness(B.truth(spark, sf).withColumnRenamed("gt", "value"), "k")


@query(
    B.with_sql("base", "forms")
    + """SELECT k, 'ballot_sum' AS chk, (valid_ballots + invalid_ballots + no_vote_ballots) || ' != ' || ballots_used AS detail FROM forms WHERE k % 37 <> 0 AND valid_ballots + invalid_ballots + no_vote_ballots <> ballots_used
    UNION ALL SELECT k, 'votes_exceed_valid', (90 + k % 110) || ' > ' || valid_ballots FROM forms WHERE k % 37 <> 0 AND 90 + k % 110 > valid_ballots"""
)
def vision_stats_checks(spark: Session, sf: str) -> Frame:
    """V7, V8, PR4: every 37th form has text that is no number."""
    text = lambda c: F.when(F.col("k") % 37 == 0, F.concat(F.col(c), F.lit("a"))).otherwise(F.concat(F.lit(" "), F.col(c)))
    stats = B.forms(spark, sf).withColumn("total_candidate_votes", F.expr("90 + k % 110"))
    names = ("valid_ballots", "invalid_ballots", "no_vote_ballots", "ballots_used", "total_candidate_votes")
    return validate.vision_stats_checks(stats.select("k", *(text(c).alias(c) for c in names)), ["k"])


@query(
    B.with_sql("base", "forms", "long", "gt", "lines", "cells")
    + f", {TOTALS} {IDENTITIES} UNION ALL SELECT k, 'table_column_sum', rows_sum || ' != ' || total FROM totals WHERE n_rows >= 2 AND rows_sum <> total UNION ALL SELECT k, 'table_total_vs_valid_ballots', total || ' != ' || valid_ballots FROM totals JOIN forms USING (k) WHERE n_rows >= 2 AND total <> valid_ballots UNION ALL SELECT k, 'incomplete_fields', 'missing ' || (8 - count(gt)) FROM gt GROUP BY k HAVING count(gt) BETWEEN 1 AND 7"
)
def validate_forms(spark: Session, sf: str) -> Frame:
    return validate.validate_forms(B.forms(spark, sf), B.text_cells(spark, sf), B.truth(spark, sf).withColumnRenamed("gt", "value"), "k")


@query(
    B.with_sql("base", "forms")
    + """SELECT k, 'ink' AS "column", 'required' AS rule FROM forms WHERE ink IS NULL UNION ALL SELECT k, 'region', 'enum' FROM forms WHERE region NOT IN ('ASIA', 'EUROPE') UNION ALL SELECT k, 'invalid_ballots', 'minimum' FROM forms WHERE invalid_ballots < 2"""
)
def schema_violations(spark: Session, sf: str) -> Frame:
    return validate.schema_violations(B.forms(spark, sf), ["k"], {"region": ("ASIA", "EUROPE")}, {"invalid_ballots": 2}, ["ink"])


@query(
    B.with_sql("base")
    + """SELECT k, 'fields_zone_templates_not_found' AS reason FROM base WHERE k % 3 = 0 UNION ALL SELECT k, 'region_templates_failed_fields_skipped' FROM base WHERE k % 5 = 0 UNION ALL SELECT k, 'fields_band_table_boundary_failed' FROM base WHERE k % 7 = 0
    UNION ALL SELECT k, 'fields_band_ocr_fallback_skipped_invalid_band' FROM base WHERE k % 11 = 0 UNION ALL SELECT k, 'table_detection_failed' FROM base WHERE k % 2 = 0 AND k % 13 = 0"""
)
def review_reasons(spark: Session, sf: str) -> Frame:
    pages = B.forms(spark, sf).selectExpr("k", "k % 3 <> 0 AS fields_zone_found", "k % 5 <> 0 AS region_templates_found", "k % 7 <> 0 AS table_boundary_found", "k % 11 <> 0 AS band_valid", "k % 2 = 0 AS has_table", "k % 13 <> 0 AS table_found")
    return validate.review_reasons(pages, ["k"])


NAMES = reconcile.VISION_NAMES
CANONICAL = [reconcile.ALIASES.get(n, n) for n in NAMES]


def cv_side(spark: Session, sf: str) -> Frame:
    """CV side: the truth's fields 1-7 as numbered regions, and the table's total."""
    number = F.create_map(*(x for n, c in enumerate(CANONICAL, 1) for x in (F.lit(c), F.lit(n))))
    regions = B.truth(spark, sf).select("k", F.concat(F.lit("doc0_p1_field_"), number[F.col("field")].cast("string")).alias("region_id"), F.lit(0).alias("ord"), F.col("gt").cast("string").alias("value"))
    fields = reconcile.cv_fields(regions, "k").groupBy("k").agg(*(F.max(F.when(F.col("field_no") == n, F.col("value"))).alias(f"cv_{n}") for n in range(1, 8)))
    return fields.join(validate.table_totals(B.text_cells(spark, sf), "k").select("k", F.col("total").alias("cv_total")), "k", "left")


def vision_side(spark: Session, sf: str) -> Frame:
    """Vision side: the predictions, a stated total of votes, and the candidates' votes."""
    wide = B.predicted(spark, sf).groupBy("k").agg(*(F.max(F.when(F.col("field") == c, F.col("pred"))).alias(n) for n, c in zip(NAMES, CANONICAL, strict=True)))
    long = reconcile.vision_fields(wide, "k")
    fields = long.groupBy("k").agg(*(F.max(F.when(F.col("field") == c, F.col("value"))).alias(f"vision_{n}") for n, c in enumerate(CANONICAL, 1)))
    votes = B.lines(spark, sf).groupBy("k").agg(F.collect_list(F.expr("CASE WHEN k % 41 = 0 AND ord = 2 THEN NULL ELSE v END")).alias("known"), F.count("*").alias("n"), F.sum("v").alias("s"))
    # collect_list leaves nulls out: a shorter list tells of one
    votes = votes.select("k", F.when(F.size("known") == F.col("n"), reconcile.candidate_total(F.col("known"))).alias("candidate_sum"), F.expr("s + (CASE WHEN k % 43 = 0 THEN 3 ELSE 0 END)").alias("vision_total"))
    return fields.join(votes, "k", "left")


PAIRS = (
    "cv AS (SELECT k, " + ", ".join(f"max(CASE WHEN field = '{c}' THEN gt END) AS cv_{n}" for n, c in enumerate(CANONICAL, 1)) + " FROM gt GROUP BY k), "
    "vi AS (SELECT k, " + ", ".join(f"max(CASE WHEN field = '{c}' THEN pred END) AS vision_{n}" for n, c in enumerate(CANONICAL, 1)) + " FROM pred GROUP BY k), "
    "votes AS (SELECT k, CASE WHEN k % 41 = 0 AND count(*) >= 2 THEN NULL ELSE CAST(sum(v) AS BIGINT) END AS candidate_sum, CAST(sum(v) + (CASE WHEN k % 43 = 0 THEN 3 ELSE 0 END) AS BIGINT) AS vision_total FROM lines GROUP BY k), "
    "pairs AS (SELECT cv.*, vi.* EXCLUDE (k), totals.total AS cv_total, candidate_sum, vision_total FROM cv JOIN vi USING (k) LEFT JOIN totals USING (k) LEFT JOIN votes USING (k)), diffs AS ("
    + " UNION ALL ".join(f"SELECT k, 'field_mismatch' AS chk, '{name}' AS field, CAST({n} AS INTEGER) AS field_index, cv_{n} AS cv_value, vision_{n} AS gemini_value, abs(cv_{n} - vision_{n}) AS diff FROM pairs WHERE cv_{n} <> vision_{n}" for n, name in enumerate(NAMES, 1))
    + " UNION ALL SELECT k, 'table_total_mismatch', 'total_candidate_votes', NULL, cv_total, vision_total, abs(cv_total - vision_total) FROM pairs WHERE cv_total <> vision_total"
    " UNION ALL SELECT k, 'gemini_candidate_sum_mismatch', 'sum(candidates.votes) vs total_candidate_votes', NULL, NULL, vision_total, abs(candidate_sum - vision_total) FROM pairs WHERE candidate_sum <> vision_total)"
)
RECONCILED = B.with_sql("base", "forms", "long", "gt", "pred", "lines", "cells") + f", {TOTALS}, {PAIRS} "


@query(RECONCILED + "SELECT * FROM diffs")
def reconcile_pipelines(spark: Session, sf: str) -> Frame:
    return reconcile.reconcile_pipelines(cv_side(spark, sf), vision_side(spark, sf), "k")


@query(RECONCILED + "SELECT chk, count(*) AS n FROM diffs GROUP BY chk")
def reconcile_counts(spark: Session, sf: str) -> Frame:
    return reconcile.discrepancy_counts(reconcile_pipelines(spark, sf))


@query(RECONCILED + "SELECT chk, k, field, rank FROM (SELECT chk, k, field, row_number() OVER (PARTITION BY chk ORDER BY k, field) AS rank FROM diffs) WHERE rank <= 5")
def reconcile_samples(spark: Session, sf: str) -> Frame:
    return reconcile.samples(reconcile_pipelines(spark, sf), "chk", ["k", "field"]).select("chk", "k", "field", F.col("rank").cast("bigint").alias("rank"))


@query(B.with_sql("lines") + "SELECT k, CASE WHEN k % 41 = 0 AND count(*) >= 2 THEN NULL ELSE CAST(sum(v) AS BIGINT) END AS total FROM lines GROUP BY k")
def candidate_total_null_aware(spark: Session, sf: str) -> Frame:
    votes = B.lines(spark, sf).groupBy("k").agg(F.collect_list(F.struct(F.expr("CASE WHEN k % 41 = 0 AND ord = 2 THEN NULL ELSE v END").alias("v"))).alias("c"))
    return votes.select("k", reconcile.candidate_total(F.transform("c", lambda x: x["v"])).alias("total"))


DETAIL = B.with_sql("base", "forms", "long", "gt", "pred") + ", d AS (SELECT gt.k, ink, province, gt.field, gt, pred, coalesce(gt = pred, false) AS correct, CASE WHEN NOT coalesce(gt = pred, false) THEN abs(gt - pred) END AS abs_error FROM gt LEFT JOIN pred ON gt.k = pred.k AND gt.field = pred.field WHERE gt IS NOT NULL) "


def scored(spark: Session, sf: str) -> Frame:
    return evaluate.detail(B.truth(spark, sf), B.predicted(spark, sf), ["k"])


@query(DETAIL + "SELECT k, field, gt, pred, correct, abs_error FROM d")
def eval_detail(spark: Session, sf: str) -> Frame:
    return scored(spark, sf).select("k", "field", "gt", "pred", "correct", "abs_error")


MEASURES = "count(*) AS n_fields, count(*) FILTER (correct) AS n_correct, CAST(coalesce(sum(abs_error), 0) AS BIGINT) AS err_sum, count(abs_error) AS err_n, coalesce(max(abs_error), 0) AS err_max"
METRICS = DETAIL + f", m AS (SELECT CAST(grouping(ink2, province2, field) AS BIGINT) AS gid, ink2 AS ink, province2 AS province, field, {MEASURES} FROM (SELECT *, coalesce(ink, 'unknown') AS ink2, coalesce(province, 'unknown') AS province2 FROM d) GROUP BY GROUPING SETS ((), (ink2), (province2), (field))) "


@query(METRICS + "SELECT * FROM m")
def eval_metrics_grouping_sets(spark: Session, sf: str) -> Frame:
    return evaluate.grouped_metrics(scored(spark, sf))


@query(METRICS + "SELECT m.* FROM m WHERE NOT (gid IN (3, 5) AND (SELECT count(*) FROM m AS o WHERE o.gid = m.gid) = 1)")
def eval_strata(spark: Session, sf: str) -> Frame:
    m = evaluate.with_strata_guard(evaluate.grouped_metrics(scored(spark, sf)))
    return m.select("gid", "ink", "province", "field", "n_fields", "n_correct", "err_sum", "err_n", "err_max")


@query(DETAIL + "SELECT count(*) AS n_forms, count(*) FILTER (exact) AS n_exact FROM (SELECT f.k, coalesce(bool_and(d.correct), false) AS exact FROM forms AS f LEFT JOIN d ON f.k = d.k GROUP BY f.k)")
def eval_form_exact(spark: Session, sf: str) -> Frame:
    return evaluate.form_exact(scored(spark, sf), B.forms(spark, sf), "k")


MANIFEST = "WITH manifest AS (SELECT event_id AS seq, user_id AS rel, event_type AS fp, CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS status, props FROM events) "


def events_manifest(spark: Session, sf: str) -> Frame:
    return table(spark, sf, "events").selectExpr("event_id AS seq", "user_id AS rel", "event_type AS fp", "CASE WHEN event_type = 'error' THEN 'error' ELSE 'ok' END AS status", "props")


@query(MANIFEST + "SELECT rel, fp, max(seq) AS seq, arg_max(status, seq) AS status, arg_max(props, seq) AS props FROM manifest GROUP BY rel, fp")
def manifest_latest(spark: Session, sf: str) -> Frame:
    return manifest.last_wins(events_manifest(spark, sf), ["rel", "fp"], "seq")


@query(MANIFEST + "SELECT rel, max(seq) AS seq, arg_max(fp, seq) AS fp, arg_max(status, seq) AS status, arg_max(props, seq) AS props FROM manifest WHERE status = 'ok' GROUP BY rel")
def manifest_latest_ok(spark: Session, sf: str) -> Frame:
    return manifest.matched_latest(events_manifest(spark, sf), ["rel"], "seq")


@query(MANIFEST + "SELECT rel, min(seq) AS seq, arg_min(fp, seq) AS fp FROM manifest GROUP BY rel")
def manifest_first(spark: Session, sf: str) -> Frame:
    return manifest.first_wins(events_manifest(spark, sf).select("rel", "seq", "fp"), ["rel"], "seq")


@query(MANIFEST + "SELECT c_custkey AS rel FROM customer WHERE NOT EXISTS (SELECT 1 FROM manifest WHERE status = 'ok' AND rel = c_custkey)")
def manifest_pending(spark: Session, sf: str) -> Frame:
    inputs = table(spark, sf, "customer").select(F.col("c_custkey").alias("rel"))
    return manifest.pending(inputs, manifest.done_set(events_manifest(spark, sf), ["rel"]), ["rel"])


@query(MANIFEST + "SELECT c_custkey AS rel, CASE WHEN c_custkey % 5 = 0 OR (c_custkey % 3 = 0 AND EXISTS (SELECT 1 FROM manifest WHERE rel = c_custkey)) THEN 'skipped' ELSE 'pending' END AS action FROM customer")
def resume_skip(spark: Session, sf: str) -> Frame:
    inputs = table(spark, sf, "customer").selectExpr("c_custkey AS rel", "CASE WHEN c_custkey % 5 = 0 THEN 'a' END AS embedded_fingerprint", "'a' AS fingerprint", "c_custkey % 3 = 0 AS output_exists")
    return manifest.split_pending(inputs, events_manifest(spark, sf), ["rel"]).select("rel", "action")


@query("SELECT o_orderkey AS k, CAST(p AS INTEGER) AS page_num FROM (SELECT o_orderkey, unnest(range(1, 2 + o_orderkey % 7, 2)) AS p FROM orders)")
def work_items_odd_pages(spark: Session, sf: str) -> Frame:
    files = table(spark, sf, "orders").selectExpr("o_orderkey AS k", "cast(1 + o_orderkey % 7 AS int) AS n_pages")
    return manifest.odd_pages(files, "n_pages").select("k", "page_num")


@query("SELECT l_orderkey AS k, l_linenumber AS page FROM (SELECT DISTINCT l_orderkey, l_linenumber, dense_rank() OVER (ORDER BY l_orderkey) AS r FROM lineitem) WHERE r <= 200 ORDER BY k, page LIMIT 500")
def first_n_files_pages(spark: Session, sf: str) -> Frame:
    items = table(spark, sf, "lineitem").selectExpr("l_orderkey AS k", "l_linenumber AS page").distinct()
    return manifest.first_files_and_pages(items, "k", "page", 200, 500)


@query(MANIFEST + "SELECT count(*) AS total, count(*) FILTER (status = 'ok') AS n_ok, count(*) FILTER (status = 'skipped') AS n_skipped, count(*) FILTER (status = 'error') AS n_error FROM manifest")
def status_counts(spark: Session, sf: str) -> Frame:
    return manifest.status_counts(events_manifest(spark, sf))


@query("SELECT o_custkey AS rel, CAST(sum(o_orderkey % 10) AS BIGINT) AS step_total, sum(o_orderkey % 10) / greatest(1, count(*)) AS step_per_page FROM orders GROUP BY o_custkey")
def timing_totals(spark: Session, sf: str) -> Frame:
    return manifest.timing_totals(table(spark, sf, "orders").selectExpr("o_custkey AS rel", "o_orderkey % 10 AS step"), "rel", ["step"])


@query("SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_payload(spark: Session, sf: str) -> Frame:
    fenced = table(spark, sf, "events").select("event_id", F.concat(F.lit("```json\n"), "props", F.lit("\n```")).alias("raw"))
    return fenced.select("event_id", T.unfenced_json(F.col("raw"), "k bigint")["k"].alias("k"))


@query("SELECT l_orderkey AS k, l_linenumber AS n, count(*) AS c, CAST(l_partkey * 1000 + l_quantity AS BIGINT) AS parsed, (l_partkey) || '.' || CAST(l_quantity AS BIGINT) AS digits FROM lineitem GROUP BY ALL")
def parse_int(spark: Session, sf: str) -> Frame:
    """PR1-PR3: a part number and a quantity of three digits in Thai digits, with a comma between; and with a dot."""
    thai = lambda c: F.translate(c, T.ASCII_DIGITS, T.THAI_DIGITS)
    q = F.col("l_quantity").cast("bigint")
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", thai(F.concat(F.col("l_partkey").cast("string"), F.lit(","), F.lpad(q.cast("string"), 3, "0"))).alias("raw"), thai(F.concat(F.lit("จำนวน "), F.col("l_partkey").cast("string"), F.lit("."), q.cast("string"))).alias("raw2"))
    return rows.groupBy(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), T.parse_int(F.col("raw")).alias("parsed"), T.digits_and_dots(F.col("raw2")).alias("digits")).agg(F.count("*").alias("c"))


BYTES = "n_chars * n_chars * n_chars * (1 + doc_id % 50)"
HUMAN = "CASE WHEN b <= 0 THEN '0 B' WHEN b < 1024 THEN b || ' B' " + " ".join(f"WHEN b < {1024 ** (p + 1)} THEN printf('%.2f {u}', b / {1024**p}.0e0)" for p, u in ((1, "KB"), (2, "MB"), (3, "GB"))) + f" ELSE printf('%.2f TB', b / {1024**4}.0e0) END"
BUCKET = "CASE WHEN b = 0 THEN '0 B' " + " ".join(f"WHEN b < {n} THEN '{label}'" for n, label in T.SIZE_BUCKETS) + " ELSE '20 GB+' END"


@query(f"SELECT doc_id, {HUMAN} AS human, {BUCKET} AS bucket FROM (SELECT doc_id, {BYTES} AS b FROM documents)")
def human_bytes(spark: Session, sf: str) -> Frame:
    b = F.expr(BYTES)
    return table(spark, sf, "documents").select("doc_id", T.human_bytes(b).alias("human"), T.size_bucket(b).alias("bucket"))


@query(f"SELECT page_id, CASE WHEN regexp_matches(f, '^[0-9]+$') THEN 'numeric' WHEN regexp_matches(f, '^[0-9]+-[0-9]+$') THEN 'numeric-range' WHEN regexp_matches(f, '^[\\x00-\\x7F]+$') THEN 'ascii' ELSE 'thai-or-mixed' END AS pattern FROM (SELECT page_id, CASE page_id % 4 WHEN 0 THEN page_id::VARCHAR WHEN 1 THEN page_id || '-' || (page_id + 1) WHEN 2 THEN 'file ' || page_id ELSE 'หน่วย' || page_id END AS f FROM pages)")
def filename_class(spark: Session, sf: str) -> Frame:
    name = F.expr("CASE page_id % 4 WHEN 0 THEN cast(page_id AS string) WHEN 1 THEN concat(page_id, '-', page_id + 1) WHEN 2 THEN concat('file ', page_id) ELSE concat('หน่วย', page_id) END")
    return table(spark, sf, "pages").select("page_id", T.filename_class(F.concat(name, F.lit(".pdf"))).alias("pattern"))


@query("SELECT page_id, CASE page_id % 3 WHEN 0 THEN 'district' WHEN 1 THEN 'partylist' END AS kind FROM pages")
def kind_from_path(spark: Session, sf: str) -> Frame:
    path = F.expr("CASE page_id % 3 WHEN 0 THEN 'a/District/partylist/x.md' WHEN 1 THEN 'PartyList/b/x.md' ELSE 'districts/x.md' END")
    return table(spark, sf, "pages").select("page_id", T.kind_of_path(path).alias("kind"))


@query(B.with_sql("base", "forms") + "SELECT k, region || '/' || province || '/' || k AS stem, k || '.pdf' AS name, region || '/' || province AS parent, '/out/' || province || '/' || k AS mirrored FROM forms")
def path_stems(spark: Session, sf: str) -> Frame:
    """PR32, SK7."""
    p = F.col("rel_path")
    return B.forms(spark, sf).select("k", T.path_stem(p).alias("stem"), T.file_name(p).alias("name"), T.parent_dir(p).alias("parent"), T.mirrored(F.concat(F.lit("/in/"), "province", F.lit("/"), T.file_name(p)), "/in", "/out").alias("mirrored"))


@query("SELECT doc_id, sha1(n_chars || ':' || (86400 * doc_id)) AS fp FROM documents")
def fingerprints(spark: Session, sf: str) -> Frame:
    modified = F.timestamp_seconds(F.col("doc_id") * 86400)
    return table(spark, sf, "documents").select("doc_id", T.fingerprint(F.col("n_chars"), modified).alias("fp"))


MD = """WITH md AS (SELECT l_orderkey AS k, l_linenumber AS n, l_partkey AS p, l_suppkey AS s, l_extendedprice AS e, CAST(l_quantity AS BIGINT) AS v, CASE WHEN l_orderkey % 3 = 0 THEN 'บัตร' ELSE 'คน' END AS unit, l_returnflag AS f FROM lineitem) """


@query(MD + "SELECT k, CASE WHEN n % 2 = 0 THEN n || '.' || (s % 9) ELSE '' END AS schema, 'ผู้มีสิทธิ ' || f AS label, v AS value, unit, count(*) AS c FROM md WHERE k % 10 <> 0 GROUP BY ALL")
def count_extraction(spark: Session, sf: str) -> Frame:
    """TF1: a line an item, in a file an order; Thai digits on even orders, no count where a letter follows, one where a mark does."""
    thai = lambda c: F.when(F.col("l_orderkey") % 2 == 0, F.translate(c, T.ASCII_DIGITS, T.THAI_DIGITS)).otherwise(c)
    lead = F.when(F.col("l_linenumber") % 2 == 0, F.concat(F.col("l_linenumber").cast("string"), F.lit("."), (F.col("l_suppkey") % 9).cast("string"), F.lit(" "))).otherwise(F.lit(""))
    tail = F.when(F.col("l_orderkey") % 10 == 0, F.lit("เสีย")).when(F.col("l_orderkey") % 10 == 1, F.lit("์")).otherwise(F.lit(""))
    unit = F.when(F.col("l_orderkey") % 3 == 0, F.lit("บัตร")).otherwise(F.lit("คน"))
    line = F.concat(thai(lead), F.lit("ผู้มีสิทธิ  "), "l_returnflag", F.lit(" : จำนวน "), thai(F.col("l_quantity").cast("bigint").cast("string")), F.lit(" "), unit, tail)
    files = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("path")).agg(F.array_join(F.array_sort(F.collect_list(line)), "\n").alias("text"))
    items = counts.count_items(files)
    return items.groupBy(F.col("path").alias("k"), "schema", "label", "value", "unit").agg(F.count("*").alias("c"))


@query(MD + "SELECT f.k AS path, coalesce(c, 0) AS n_counts FROM (SELECT DISTINCT k FROM md) AS f LEFT JOIN (SELECT k, count(*) AS c FROM md WHERE k % 2 = 0 GROUP BY k) AS g ON f.k = g.k WHERE f.k % 5 <> 0")
def count_files(spark: Session, sf: str) -> Frame:
    """C9, TF2: files with and without counts, of one kind by the path in their head."""
    line = F.expr("concat('จำนวน ', cast(l_quantity AS bigint), CASE WHEN l_orderkey % 2 = 0 THEN ' คน' ELSE ' คนไทย' END)")
    files = table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("path")).agg(F.concat(F.expr("CASE WHEN l_orderkey % 5 = 0 THEN '<!-- rel_path=partylist/1.md -->\n' ELSE '<!-- rel_path=district/1.md -->\n' END"), F.array_join(F.collect_list(line), "\n")).alias("text"))
    return counts.count_files(files, "district").select("path", F.size("counts").cast("bigint").alias("n_counts"))


# Paths with what they hold; the tests have them one by one.
PATHS = (
    ("เชียงราย/เขตเลือกตั้งที่ 7/อำเภอแม่จัน/2.ตำบลป่าซาง/2.แบบแบ่งเขต 5-18/หน่วย12 ม.4/ซาง 5-18 น12ม4.pdf", "เชียงราย", 7, "แม่จัน", "ป่าซาง", "district", 12, False),
    ("น่าน/เขตเลือกตั้งที่ ๒/อ.ปัว/ส.ส.5-18(บช)/สส5-18(บช) ต.ศิลาแลง.pdf", "น่าน", 2, "ปัว", "ศิลาแลง", "partylist", None, False),
    ("แพร่/เขตเลือกตั้งที่ 1/นอกเขต/ส.ส.5-17/ชุดที่6.pdf", "แพร่", 1, None, None, "district", None, True),
    ("data/raw/พะเยา/เขตเลือกตั้งที่ 3/อำเภอปง/ตำบลควร/สส5-18/scan.pdf", "พะเยา", 3, "ปง", "ควร", "district", None, False),
)


def sql_value(v) -> str:
    return "NULL" if v is None else f"'{v}'" if isinstance(v, str) else str(v)


@query("SELECT n_name AS nation, v.* FROM nation CROSS JOIN (VALUES " + ", ".join("(" + ", ".join(map(sql_value, r[1:])) + ")" for r in PATHS) + ") AS v(province, constituency, amphoe, tambon, form_type, unit_number, is_advance_voting)")
def path_metadata_parser(spark: Session, sf: str) -> Frame:
    paths = F.explode(F.array(*(F.lit(p[0]) for p in PATHS)))
    rows = table(spark, sf, "nation").select(F.col("n_name").alias("nation"), paths.alias("path"))
    return rows.select("nation", path_metadata(F.col("path")).alias("m")).select("nation", "m.province", "m.constituency", "m.amphoe", "m.tambon", "m.form_type", "m.unit_number", "m.is_advance_voting")
