"""Queries over file collections: totals, anomalies, owners, folder profiles."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formloom.functions import text as T
from formloom.operators import survey
from formloom.plans.registry import Registry
from formloom.session import table

query = Registry()
QUERIES, ORACLE_SQL = query.queries, query.sql
Frame, Session = DataFrame, SparkSession

FOLDER = "CASE WHEN c % 97 = 0 THEN '' ELSE concat('f', c % 1400) END"
REGION = "CASE c % 4 WHEN 0 THEN 'north' WHEN 1 THEN 'south' WHEN 2 THEN 'east' ELSE '' END"
COLUMNS = f"concat('p', c) AS province, c AS ord, {REGION} AS region, {FOLDER} AS folder_id, c % 11 AS files, bytes, constituencies, CASE WHEN c % 22 = 0 THEN 'timeout' ELSE '' END AS error"
SIZES = f"WITH own AS (SELECT o_custkey AS c, CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS bytes, count(*) AS constituencies FROM orders GROUP BY o_custkey), s AS (SELECT {COLUMNS} FROM own) "


def sizes(spark: Session, sf: str) -> Frame:
    own = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c")).agg(F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("bytes"), F.count("*").alias("constituencies"))
    return own.selectExpr(*split_columns(COLUMNS))


def split_columns(text: str) -> list[str]:
    """Top-level items of a SQL select list."""
    out, depth, item = [], 0, ""
    for ch in text:
        depth += (ch == "(") - (ch == ")")
        if ch == "," and depth == 0:
            out.append(item.strip())
            item = ""
        else:
            item += ch
    return [*out, item.strip()]


HOST, PATH = "regexp_extract(url, '^https?://([^/]+)', 1)", "regexp_extract(url, '^https?://[^/]+/([^?]*)', 1)"
OWNER = "CASE page_id % 6 WHEN 0 THEN '' WHEN 1 THEN 'a@ect.go.th' WHEN 2 THEN 'x.ect@gmail.com' WHEN 3 THEN 'p@gmail.com' WHEN 4 THEN 'i@uni.ac.th' ELSE 'q@hotmail.com' END"
LISTING = f"WITH f AS (SELECT page_id AS ord, {HOST} AS province, {PATH} AS path, {OWNER} AS owner, CAST(length(html) AS BIGINT) AS size FROM pages) "


def listing(spark: Session, sf: str) -> Frame:
    return table(spark, sf, "pages").selectExpr("page_id AS ord", f"{HOST} AS province", f"{PATH} AS path", f"{OWNER} AS owner", "cast(length(html) AS bigint) AS size")


@query(SIZES + "SELECT count(*) AS n_folders, CAST(sum(files) AS BIGINT) AS files, CAST(sum(bytes) AS BIGINT) AS bytes FROM (SELECT *, row_number() OVER (PARTITION BY folder_id ORDER BY bytes DESC, ord) AS r FROM s) WHERE r = 1 OR folder_id = ''")
def dedup_totals_global(spark: Session, sf: str) -> Frame:
    return survey.global_totals(sizes(spark, sf))


@query(SIZES + ", n AS (SELECT *, CASE WHEN region = '' THEN 'ไม่ระบุ' ELSE region END AS reg FROM s) SELECT reg AS region, count(*) AS provinces, CAST(sum(files) FILTER (r = 1 OR folder_id = '') AS BIGINT) AS files, CAST(sum(bytes) FILTER (r = 1 OR folder_id = '') AS BIGINT) AS bytes FROM (SELECT *, row_number() OVER (PARTITION BY reg, folder_id ORDER BY ord) AS r FROM n) GROUP BY reg")
def dedup_totals_region(spark: Session, sf: str) -> Frame:
    return survey.region_totals(sizes(spark, sf)).select("region", "provinces", "files", "bytes")


BUCKETS = "(VALUES " + ", ".join(f"('{b}')" for b in T.ALL_BUCKETS) + ")"
BUCKET = "CASE WHEN b = 0 THEN '0 B' " + " ".join(f"WHEN b < {n} THEN '{label}'" for n, label in T.SIZE_BUCKETS) + " ELSE '20 GB+' END"


@query(SIZES + f"SELECT v.bucket, count(h.bucket) AS n FROM {BUCKETS} AS v(bucket) LEFT JOIN (SELECT {BUCKET} AS bucket FROM (SELECT bytes * (ord % 500) AS b FROM s)) AS h USING (bucket) GROUP BY v.bucket")
def size_histogram(spark: Session, sf: str) -> Frame:
    return survey.size_histogram(spark, sizes(spark, sf).withColumn("b", F.expr("bytes * (ord % 500)")), "b")


KIND = "CASE WHEN owner = '' THEN 'error' WHEN owner LIKE '%@ect.go.th' THEN 'official' WHEN owner LIKE '%ect%' THEN 'ect_gmail' WHEN owner LIKE '%@gmail.com' OR owner LIKE '%@hotmail.com' OR owner LIKE '%@outlook.com' THEN 'personal' ELSE 'institutional' END"


@query(LISTING + f"SELECT ord, {KIND} AS email_type FROM f")
def email_class(spark: Session, sf: str) -> Frame:
    return listing(spark, sf).select("ord", T.email_class(F.col("owner")).alias("email_type"))


@query(LISTING + f"SELECT {KIND} AS email_type, count(*) AS n FROM f GROUP BY ALL")
def account_types(spark: Session, sf: str) -> Frame:
    return survey.account_types(listing(spark, sf), "owner")


@query("SELECT o_orderpriority AS province, count(DISTINCT o_custkey % 100) AS constituencies FROM orders GROUP BY o_orderpriority")
def distinct_constituencies(spark: Session, sf: str) -> Frame:
    rows = table(spark, sf, "orders").select(F.concat("o_orderpriority", F.lit("-"), (F.col("o_custkey") % 100).cast("string")).alias("const_id"))
    return survey.constituency_counts(rows, "const_id")


@query(SIZES + "SELECT folder_id, count(*) AS n FROM s WHERE folder_id <> '' GROUP BY folder_id HAVING count(*) > 1")
def shared_folders(spark: Session, sf: str) -> Frame:
    return survey.shared_folders(sizes(spark, sf))


OTHERS = "(SELECT string_agg(o.province, ', ' ORDER BY o.ord) FROM s AS o WHERE o.folder_id = s.folder_id AND o.ord <> s.ord)"


@query(SIZES + f"SELECT province, ord, folder_id, (SELECT count(*) FROM s AS o WHERE o.folder_id = s.folder_id AND o.ord <> s.ord) AS n_others, {OTHERS} AS others FROM s WHERE folder_id <> '' AND {OTHERS} IS NOT NULL")
def duplicate_folders(spark: Session, sf: str) -> Frame:
    return survey.duplicate_folders(sizes(spark, sf))


OUT = "far AS (SELECT province, CASE WHEN v > m THEN 'high' ELSE 'low' END AS direction FROM (SELECT province, bytes / constituencies AS v FROM s WHERE constituencies > 0 AND bytes > 0), (SELECT avg(bytes / constituencies) AS m, stddev_pop(bytes / constituencies) AS sd, count(*) AS n FROM s WHERE constituencies > 0 AND bytes > 0) WHERE n >= 3 AND sd > 0 AND abs(v - m) > 2 * sd)"


@query(SIZES + f", {OUT} SELECT * FROM far")
def outliers_2sigma(spark: Session, sf: str) -> Frame:
    return survey.outliers(sizes(spark, sf), "province").select("province", "direction")


TAGS = f"{OUT}, tags AS (SELECT province, 'missing_link' AS tag, '' AS detail FROM s WHERE folder_id = '' UNION ALL SELECT province, 'duplicate_folder_id', {OTHERS} FROM s WHERE folder_id <> '' AND {OTHERS} IS NOT NULL UNION ALL SELECT province, 'empty_folder', '' FROM s WHERE folder_id <> '' AND files = 0 AND error = '' UNION ALL SELECT province, 'size_outlier', direction FROM far)"


@query(SIZES + f", {TAGS} SELECT * FROM tags")
def anomalies_union(spark: Session, sf: str) -> Frame:
    """C4; of an outlier's detail only its direction, as its sigma depends on the order of a sum."""
    found = survey.anomalies(sizes(spark, sf))
    return found.withColumn("detail", F.when(F.col("tag") == "size_outlier", F.split("detail", " ")[0]).otherwise(F.col("detail")))


@query(SIZES + f", {TAGS} SELECT province, string_agg(tag, ',' ORDER BY tag) AS tags FROM (SELECT DISTINCT province, tag FROM tags) GROUP BY province")
def anomaly_tags(spark: Session, sf: str) -> Frame:
    return survey.anomaly_tags(survey.anomalies(sizes(spark, sf)))


@query("SELECT n_name AS province, coalesce(r_name, '') AS region FROM nation LEFT JOIN (SELECT * FROM region WHERE r_regionkey <> 2) ON n_regionkey = r_regionkey")
def region_lookup(spark: Session, sf: str) -> Frame:
    dim = table(spark, sf, "region").where("r_regionkey <> 2").selectExpr("r_regionkey AS n_regionkey", "r_name AS region")
    return survey.looked_up(table(spark, sf, "nation"), dim, "n_regionkey", "region", "").select(F.col("n_name").alias("province"), "region")


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM nation WHERE n_nationkey = c_nationkey AND n_nationkey % 5 = 1)")
def selected_semi(spark: Session, sf: str) -> Frame:
    """J6, SC17."""
    chosen = table(spark, sf, "nation").where("n_nationkey % 5 = 1")
    return table(spark, sf, "customer").join(chosen, F.col("c_nationkey") == F.col("n_nationkey"), "left_semi").select("c_custkey")


OWNED = "owned AS (SELECT folder_id AS key, 'u' || (ord % 1400) || CASE ord % 4 WHEN 0 THEN '@ect.go.th' WHEN 1 THEN '.ect@gmail.com' ELSE '@gmail.com' END AS owner FROM s WHERE folder_id <> '' AND ord % 3 <> 0 UNION ALL SELECT province, 'keeper@uni.ac.th' FROM s WHERE folder_id = '' AND ord % 2 = 0), first_owner AS (SELECT key, min(owner) AS owner FROM owned GROUP BY key)"


def owners(spark: Session, sf: str) -> Frame:
    """Owners of folders, several for some, and of provinces that have no folder."""
    rows = sizes(spark, sf)
    of_folders = rows.where("folder_id <> '' and ord % 3 <> 0").selectExpr("folder_id AS key", "concat('u', ord % 1400, CASE ord % 4 WHEN 0 THEN '@ect.go.th' WHEN 1 THEN '.ect@gmail.com' ELSE '@gmail.com' END) AS owner")
    return of_folders.unionByName(rows.where("folder_id = '' and ord % 2 = 0").selectExpr("province AS key", "'keeper@uni.ac.th' AS owner"))


@query(SIZES + f", {OWNED} SELECT province, coalesce(owner, 'not_scanned') AS owner FROM s LEFT JOIN first_owner ON key = CASE WHEN folder_id = '' THEN province ELSE folder_id END")
def owner_lookup(spark: Session, sf: str) -> Frame:
    return survey.owner_lookup(sizes(spark, sf), owners(spark, sf)).select("province", "owner")


@query(SIZES + f", {OWNED}, o AS (SELECT province, folder_id, coalesce(owner, 'not_scanned') AS owner FROM s LEFT JOIN first_owner ON key = CASE WHEN folder_id = '' THEN province ELSE folder_id END) SELECT province, folder_id, owner, CASE WHEN owner = 'not_scanned' THEN owner ELSE {KIND} END AS email_type, CASE WHEN folder_id = '' THEN 1 ELSE count(*) OVER (PARTITION BY folder_id) END AS n_sharing FROM o")
def owner_report(spark: Session, sf: str) -> Frame:
    return survey.owner_report(sizes(spark, sf), owners(spark, sf))


@query(SIZES + "SELECT s.province, s.folder_id, o.bytes FROM s JOIN (SELECT folder_id, arg_min(bytes, ord) AS bytes FROM s WHERE folder_id <> '' GROUP BY folder_id) AS o USING (folder_id)")
def shared_fan_out(spark: Session, sf: str) -> Frame:
    """The first province of a folder is scanned; all that link to it get what it found."""
    rows = sizes(spark, sf)
    scanned = rows.where("folder_id <> ''").groupBy("folder_id").agg(F.min_by("bytes", "ord").alias("bytes"))
    return survey.fanned_out(scanned, rows.select("province", "folder_id")).select("province", "folder_id", "bytes")


@query(LISTING + "SELECT province, count(*) AS files, CAST(sum(size) AS BIGINT) AS bytes, arg_min(owner, ord) AS owner FROM f GROUP BY province")
def province_files(spark: Session, sf: str) -> Frame:
    return survey.province_files(listing(spark, sf)).select("province", "files", "bytes", "owner")


@query(LISTING + "SELECT string_agg(owner, ',' ORDER BY owner) AS owners FROM (SELECT DISTINCT owner FROM f WHERE owner <> '')")
def distinct_owners(spark: Session, sf: str) -> Frame:
    return survey.owners_of(listing(spark, sf)).select(F.array_join("owners", ",").alias("owners"))


@query(LISTING + "SELECT province, count(*) AS files, count(*) FILTER (lower(path) LIKE '%.pdf') AS pdfs, count(DISTINCT regexp_replace(path, '/?[^/]*$', '')) AS folders, CAST(max(len(string_split(path, '/')) - 1) AS BIGINT) AS max_depth FROM f GROUP BY province")
def folder_profile(spark: Session, sf: str) -> Frame:
    return survey.folder_totals(listing(spark, sf), "province")


@query(LISTING + "SELECT province, depth, n FROM (SELECT *, row_number() OVER (PARTITION BY province ORDER BY n DESC, seen) AS r FROM (SELECT province, CAST(len(string_split(path, '/')) - 1 AS BIGINT) AS depth, count(*) AS n, min(ord) AS seen FROM f GROUP BY ALL)) WHERE r = 1")
def depth_mode(spark: Session, sf: str) -> Frame:
    return survey.dominant_depth(listing(spark, sf), "province", "ord")


@query(LISTING + ", x AS (SELECT DISTINCT province, unnest(range(len(string_split(path, '/')))) AS level, unnest(string_split(path, '/')) AS name FROM f), y AS (SELECT *, row_number() OVER (PARTITION BY province, level ORDER BY name) AS r FROM x) SELECT province, level, 'L' || (level + 1) || '(' || count(*) || '): ' || string_agg(name, ', ' ORDER BY name) FILTER (r <= 3) || CASE WHEN count(*) > 3 THEN ', ...' ELSE '' END AS signature FROM y GROUP BY province, level")
def level_signature(spark: Session, sf: str) -> Frame:
    return survey.level_signature(listing(spark, sf), "province")


@query(LISTING + "SELECT pattern, count(*) AS n FROM (SELECT province, string_agg(depth::VARCHAR, ',' ORDER BY depth) AS pattern FROM (SELECT DISTINCT province, len(string_split(path, '/')) - 1 AS depth FROM f) GROUP BY province) GROUP BY pattern")
def depth_patterns(spark: Session, sf: str) -> Frame:
    return survey.depth_patterns(listing(spark, sf), "province")


@query(LISTING + "SELECT ord, " + ", ".join(f"coalesce(string_split(path, '/')[{k}], '') AS level_{k}" for k in range(1, 5)) + " FROM f")
def leaf_levels(spark: Session, sf: str) -> Frame:
    """TF7."""
    return survey.levels(listing(spark, sf)).select("ord", *(f"level_{k}" for k in range(1, 5)))


@query(LISTING + "SELECT province, CASE WHEN regexp_matches(n, '^[0-9]+$') THEN 'numeric' WHEN regexp_matches(n, '^[\\x00-\\x7F]+$') THEN 'ascii' ELSE 'thai-or-mixed' END AS pattern, count(*) AS n FROM (SELECT province, regexp_replace(regexp_extract(path, '([^/]*)$', 1), '(.)\\.[^.]+$', '\\1') AS n FROM f) GROUP BY ALL")
def naming_patterns(spark: Session, sf: str) -> Frame:
    return survey.naming_patterns(listing(spark, sf), "province")


@query(LISTING + "SELECT count(*) AS total, count(nullif(owner, '')) AS n_owner, count(nullif(path, '')) AS n_path FROM f")
def parse_coverage(spark: Session, sf: str) -> Frame:
    rows = listing(spark, sf).select(F.nullif("owner", F.lit("")).alias("owner"), F.nullif("path", F.lit("")).alias("path"))
    return survey.coverage(rows, ["owner", "path"])


@query("SELECT page_id, regexp_extract('https://x/drive/folders/Ab_' || page_id || '-z?usp=1', 'folders/([a-zA-Z0-9_-]+)', 1) AS folder_id FROM pages")
def folder_ids(spark: Session, sf: str) -> Frame:
    """PR15, SC12."""
    url = F.concat(F.lit("https://x/drive/folders/Ab_"), F.col("page_id").cast("string"), F.lit("-z?usp=1"))
    return table(spark, sf, "pages").select("page_id", T.folder_id(url).alias("folder_id"))


@query("SELECT n_name AS province, coalesce(n, 0) AS constituencies FROM nation LEFT JOIN (SELECT c_nationkey, count(*) AS n FROM customer WHERE c_nationkey % 3 <> 0 GROUP BY c_nationkey) ON n_nationkey = c_nationkey")
def constituency_lookup(spark: Session, sf: str) -> Frame:
    """Counts of a dimension that some lack."""
    dim = table(spark, sf, "customer").where("c_nationkey % 3 <> 0").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("constituencies"))
    return survey.looked_up(table(spark, sf, "nation"), dim, "n_nationkey", "constituencies", 0).select(F.col("n_name").alias("province"), "constituencies")


SUMMARY = f"""{OUT}, n AS (SELECT *, CASE WHEN region = '' THEN 'ไม่ระบุ' ELSE region END AS reg FROM s), regional AS (SELECT *, row_number() OVER (PARTITION BY reg, folder_id ORDER BY ord) AS r FROM n), overall AS (SELECT *, row_number() OVER (PARTITION BY folder_id ORDER BY bytes DESC, ord) AS r FROM s)
  SELECT 'total' AS section, 'folders' AS name, count(*) AS n, CAST(sum(bytes) AS BIGINT) AS bytes FROM overall WHERE r = 1 OR folder_id = ''
  UNION ALL SELECT 'region', reg, count(*), CAST(sum(bytes) FILTER (r = 1 OR folder_id = '') AS BIGINT) FROM regional GROUP BY reg
  UNION ALL SELECT 'size', v.bucket, count(h.bucket), NULL FROM {BUCKETS} AS v(bucket) LEFT JOIN (SELECT {BUCKET} AS bucket FROM (SELECT bytes AS b FROM s)) AS h USING (bucket) GROUP BY v.bucket
  UNION ALL SELECT 'status', CASE WHEN folder_id = '' THEN 'skipped' WHEN error <> '' THEN 'error' ELSE 'scanned' END, count(*), NULL FROM s GROUP BY ALL
  UNION ALL SELECT 'anomaly', 'missing_link', count(*), NULL FROM s WHERE folder_id = '' HAVING count(*) > 0
  UNION ALL SELECT 'anomaly', 'duplicate_folder_id', count(*), NULL FROM (SELECT count(*) OVER (PARTITION BY folder_id) AS c FROM s WHERE folder_id <> '') WHERE c > 1 HAVING count(*) > 0
  UNION ALL SELECT 'anomaly', 'empty_folder', count(*), NULL FROM s WHERE folder_id <> '' AND files = 0 AND error = '' HAVING count(*) > 0
  UNION ALL SELECT 'anomaly', 'size_outlier', count(*), NULL FROM far HAVING count(*) > 0"""


@query(SIZES + f", {SUMMARY}")
def survey_summary(spark: Session, sf: str) -> Frame:
    return survey.survey_summary(spark, sizes(spark, sf))


@query(SIZES + "SELECT CASE WHEN folder_id = '' THEN 'skipped' WHEN error <> '' THEN 'error' ELSE 'scanned' END AS status, count(*) AS n FROM s GROUP BY ALL")
def survey_status(spark: Session, sf: str) -> Frame:
    return survey.survey_status(sizes(spark, sf))


FILES = LISTING + ", files AS (SELECT 'f' || (ord % 90) AS folder_id, ord, path, owner, size FROM f), links AS (SELECT 'p' || c_custkey AS province, c_custkey AS ord, 'f' || (c_custkey % 120) AS folder_id FROM customer) "


def folder_files(spark: Session, sf: str) -> Frame:
    return listing(spark, sf).selectExpr("concat('f', ord % 90) AS folder_id", "ord", "path", "owner", "size")


def folder_links(spark: Session, sf: str) -> Frame:
    return table(spark, sf, "customer").selectExpr("concat('p', c_custkey) AS province", "c_custkey AS ord", "concat('f', c_custkey % 120) AS folder_id")


SIZE_TEXT = "CASE WHEN b <= 0 THEN '0 B' WHEN b < 1024 THEN b || ' B' WHEN b < 1048576 THEN printf('%.2f KB', b / 1024.0e0) WHEN b < 1073741824 THEN printf('%.2f MB', b / 1048576.0e0) ELSE printf('%.2f GB', b / 1073741824.0e0) END"


@query(FILES + f"SELECT province, links.ord, folder_id, n AS files, b AS bytes, owner, {SIZE_TEXT} AS size_human FROM links JOIN (SELECT folder_id, count(*) AS n, CAST(sum(size) AS BIGINT) AS b, arg_min(owner, ord) AS owner FROM files GROUP BY folder_id) USING (folder_id)")
def listing_report(spark: Session, sf: str) -> Frame:
    """C7, ST2."""
    found = survey.by_size(survey.listing_report(folder_files(spark, sf), folder_links(spark, sf)))
    return found.select("province", "ord", "folder_id", "files", "bytes", "owner", "size_human")


@query(FILES + "SELECT province, folder_id, files.ord, path, size FROM links JOIN files USING (folder_id)")
def master_listing(spark: Session, sf: str) -> Frame:
    return survey.master_listing(folder_files(spark, sf), folder_links(spark, sf)).select("province", "folder_id", "ord", "path", "size")


@query(LISTING + ", d AS (SELECT province, CAST(len(string_split(path, '/')) - 1 AS BIGINT) AS depth, count(*) AS n, min(ord) AS seen FROM f GROUP BY ALL) SELECT province, files, pdfs, folders, max_depth, main_depth, depths FROM (SELECT province, count(*) AS files, count(*) FILTER (lower(path) LIKE '%.pdf') AS pdfs, count(DISTINCT regexp_replace(path, '/?[^/]*$', '')) AS folders, CAST(max(len(string_split(path, '/')) - 1) AS BIGINT) AS max_depth FROM f GROUP BY province) JOIN (SELECT province, depth AS main_depth FROM (SELECT *, row_number() OVER (PARTITION BY province ORDER BY n DESC, seen) AS r FROM d) WHERE r = 1) USING (province) JOIN (SELECT province, string_agg(depth::VARCHAR, ',' ORDER BY depth) AS depths FROM d GROUP BY province) USING (province)")
def folder_survey(spark: Session, sf: str) -> Frame:
    """C8."""
    return survey.folder_survey(listing(spark, sf), "province", "ord").select("province", "files", "pdfs", "folders", "max_depth", "main_depth", "depths")


@query(LISTING + "SELECT folder, pattern, n FROM (SELECT *, row_number() OVER (PARTITION BY folder ORDER BY n DESC, seen) AS r FROM (SELECT folder, CASE WHEN regexp_matches(name, '^[0-9]+$') THEN 'numeric' WHEN regexp_matches(name, '^[\\x00-\\x7F]+$') THEN 'ascii' ELSE 'thai-or-mixed' END AS pattern, count(*) AS n, min(ord) AS seen FROM (SELECT regexp_replace(path, '/?[^/]*$', '') AS folder, regexp_replace(regexp_extract(path, '([^/]*)$', 1), '(.)\\.[^.]+$', '\\1') AS name, ord FROM f) GROUP BY ALL)) WHERE r = 1")
def dominant_patterns(spark: Session, sf: str) -> Frame:
    return survey.dominant_patterns(listing(spark, sf), "ord")


@query(LISTING + ", p AS (SELECT province, string_agg(depth::VARCHAR, ',' ORDER BY depth) AS pattern FROM (SELECT DISTINCT province, len(string_split(path, '/')) - 1 AS depth FROM f) GROUP BY province) SELECT pattern, province, count(*) OVER (PARTITION BY pattern) AS n FROM p")
def depth_pattern_members(spark: Session, sf: str) -> Frame:
    return survey.depth_pattern_members(listing(spark, sf), "province")


@query(LISTING + "SELECT 'owner' AS attribute, owner AS value, count(*) AS n FROM f WHERE owner <> '' GROUP BY owner UNION ALL SELECT 'province', province, count(*) FROM f GROUP BY province")
def distinct_values(spark: Session, sf: str) -> Frame:
    rows = listing(spark, sf).select(F.nullif("owner", F.lit("")).alias("owner"), "province")
    return survey.distinct_values(rows, ["owner", "province"])


@query("SELECT n_nationkey AS page, row_no, trim('n ' || n_name) AS c0, CASE WHEN row_no >= 1 THEN 'r' || n_regionkey ELSE '' END AS c1, CASE WHEN row_no = 2 AND n_nationkey % 2 = 0 THEN 'x y' ELSE '' END AS c2 FROM nation, (VALUES (0), (1), (2)) AS v(row_no)")
def page_table_concat(spark: Session, sf: str) -> Frame:
    """C16, SO5: tables of one to three columns, with line breaks, blanks and missing values in their cells."""
    cells = "CASE row_no WHEN 0 THEN array(concat(' n\\n', n_name)) WHEN 1 THEN array(concat('n ', n_name, ' '), concat('r', n_regionkey)) ELSE array(concat('n ', n_name), concat('r', n_regionkey), CASE WHEN n_nationkey % 2 = 0 THEN 'x\\ny' ELSE 'NaN' END) END"
    rows = table(spark, sf, "nation").select("*", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))).alias("row_no"))
    return survey.page_tables(rows.selectExpr("n_nationkey AS page", "row_no", f"{cells} AS cells"))


@query(LISTING + ", u AS (SELECT province, string_split(path, '/') AS parts, unnest(range(len(string_split(path, '/')))) AS depth FROM f) SELECT province, array_to_string(parts[1:depth], '/') AS folder, CAST(depth AS INTEGER) AS depth, count(*) FILTER (depth = len(parts) - 1) AS files, count(*) AS files_below FROM u GROUP BY ALL")
def folder_counts(spark: Session, sf: str) -> Frame:
    """SC15."""
    return survey.folder_counts(listing(spark, sf), "province")
