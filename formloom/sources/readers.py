"""Sources: file listings, Markdown, JSON lines, CSV (SC1-SC2, SC7-SC15, SC17-SC18), with explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from formloom.functions.text import folder_id, without_last_dash
from formloom.operators.manifest import last_wins

STATS = "eligible_voters int, voters_appeared int, ballots_allocated int, ballots_used int, valid_ballots int, invalid_ballots int, no_vote_ballots int, ballots_remaining int"
EXTRACTION = "struct<form_type:string,province:string,constituency:int,amphoe:string,tambon:string,unit_number:int,voter_stats:struct<eligible_voters:int,showed_up:int,ballots_received:int,ballots_used:int,valid_ballots:int,invalid_ballots:int,no_vote_ballots:int,total_candidate_votes:int>,candidates:array<struct<number:int,name:string,party:string,votes:int>>>"
VISION_MANIFEST = f"rel_path string, page_num int, fingerprint string, status string, extraction {EXTRACTION}, model string, seconds double, error string, _corrupt_record string"
OCR_MANIFEST = "rel_path string, fingerprint string, status string, in_path string, out_md string, n_pages int, seconds double, error string, _corrupt_record string"
GROUND_TRUTH = f"rel_path string, page_num int, ink_type string, scan_quality string, form_type string, province string, voter_stats struct<{STATS.replace(' int', ':int').replace(' ', '')}>, flags array<string>"
REGION = "struct<value:string,raw_text:string,confidence:double,source:string>"
RESULT = f"documents array<struct<fields:map<string,{REGION}>,table:struct<total_rows:int,last_column_values:array<struct<id:string,page:int,row:int,value:string,confidence:double>>>>>, fields map<string,{REGION}>, table struct<total_rows:int,last_column_values:array<struct<id:string,page:int,row:int,value:string,confidence:double>>>, _corrupt_record string"
IMAGE_SUFFIXES = ("pdf", "png", "jpg", "jpeg", "tif", "tiff", "bmp")


def files(spark: SparkSession, root: str, suffixes: tuple[str, ...] = ("pdf",), content: bool = False) -> DataFrame:
    """SC1, SC2, SC7: (path, rel_path, length, modified) of a tree's files with these suffixes, in any case; content on request."""
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    suffix = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    rel = F.regexp_replace("path", "^(file:)?/*", "/")
    base = root.removeprefix("file:").rstrip("/")
    rel = F.when(rel.startswith(base + "/"), F.substring(rel, len(base) + 2, 1_000_000)).otherwise(F.element_at(F.split(rel, "/"), -1))
    own = ["path", rel.alias("rel_path"), "length", F.col("modificationTime").alias("modified")]
    return rows.where(suffix.isin(*suffixes)).select(*own, *(["content"] if content else []))


def in_path_order(rows: DataFrame, path: str = "rel_path") -> DataFrame:
    """Q17: ordered by path components, not by the text."""
    return rows.orderBy(F.split(path, "/"))


def markdown(spark: SparkSession, root: str) -> DataFrame:
    """SC8: (path, text) of the Markdown files of a tree."""
    rows = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.md").text(root, wholetext=True)
    return rows.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def existing(spark: SparkSession, root: str, name: str) -> DataFrame:
    """(path) of the files of a name in a tree, without a scheme; none where the tree isn't there."""
    place = spark._jvm.org.apache.hadoop.fs.Path(root)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        return spark.createDataFrame([], "path string")
    rows = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", name).load(root)
    return rows.select(F.regexp_replace("path", "^(file:)?/*", "/").alias("path"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(place, line) of the lines of text files that aren't blank. Places are in order: files by time of change and name, then lines.

    Files are split where they are large: a line's place is its split's first byte and its turn in the task that reads it.
    """
    rows = spark.read.text(path)
    meta = [F.col(f"_metadata.{c}").alias(c) for c in ("file_modification_time", "file_path", "file_block_start")]
    lines = rows.select(F.struct(*meta, F.monotonically_increasing_id().alias("turn")).alias("place"), F.col("value").alias("line"))
    return lines.where(F.trim("line") != "")


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """SC10: rows of JSON-lines files with the place of each (see numbered_lines), bad lines left out."""
    parsed = numbered_lines(spark, path).select("place", F.from_json("line", schema, {"columnNameOfCorruptRecord": "_corrupt_record"}).alias("r"))
    out = parsed.where("r is not null").select("place", "r.*")
    return out.where("_corrupt_record is null").drop("_corrupt_record") if "_corrupt_record" in out.columns else out


def vision_manifest(spark: SparkSession, path: str) -> DataFrame:
    """SC10, A1: last row of each file of status ok; pages of a file collapse to the last."""
    rows = json_lines(spark, path, VISION_MANIFEST)
    return last_wins(rows.where("status = 'ok' and coalesce(rel_path, '') <> ''"), ["rel_path"], "place")


def ground_truth(spark: SparkSession, path: str) -> DataFrame:
    """SC11, A1: last row of each page; a bad line is an error."""
    rows = numbered_lines(spark, path).select("place", F.from_json("line", GROUND_TRUTH, {"mode": "FAILFAST"}).alias("r")).select("place", "r.*")
    return last_wins(rows, ["rel_path", "page_num"], "place")


def cv_results(spark: SparkSession, root: str) -> DataFrame:
    """SC9, Q22: (dir, fields, table) of each readable result.json: its first document, else its top level."""
    rows = spark.read.schema(RESULT).option("multiLine", "true").option("mode", "PERMISSIVE").option("recursiveFileLookup", "true").option("pathGlobFilter", "result.json").json(root)
    first = F.try_element_at("documents", F.lit(1))
    good = rows.select(F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "").alias("dir"), F.coalesce(first["fields"], F.col("fields")).alias("fields"), F.coalesce(first["table"], F.col("table")).alias("table"), "_corrupt_record")
    return good.where("_corrupt_record is null").drop("_corrupt_record")


def result_regions(results: DataFrame) -> DataFrame:
    """Fields as rows (dir, region_id, ord, value), in the order of the file."""
    return results.select("dir", F.posexplode(F.map_entries("fields")).alias("ord", "e")).select("dir", F.col("e.key").alias("region_id"), "ord", F.col("e.value.value").alias("value"), F.col("e.value.confidence").alias("confidence"))


def province_links(spark: SparkSession, path: str) -> DataFrame:
    """SC12: province, folder_url, folder_id ('' if none); a byte-order mark is left out."""
    rows = spark.read.schema("province string, folder_url string").option("header", "true").csv(path)
    url = F.trim(F.coalesce("folder_url", F.lit("")))
    return rows.select(F.trim("province").alias("province"), url.alias("folder_url"), folder_id(url).alias("folder_id"))


def constituency_ids(spark: SparkSession, path: str) -> DataFrame:
    """SC13: const_id and its province."""
    rows = spark.read.option("header", "true").csv(path).select(F.trim("const_id").alias("const_id"))
    return rows.select("const_id", without_last_dash(F.col("const_id")).alias("province"))


def remote_listing(spark: SparkSession, path: str) -> DataFrame:
    """SC14: a landed JSON listing of a remote folder."""
    schema = "Path string, Name string, Size long, MimeType string, ModTime timestamp, ID string, Owner string"
    rows = spark.read.schema(schema).option("multiLine", "true").json(path)
    return rows.select(F.col("Path").alias("path"), F.col("Name").alias("name"), F.col("Size").alias("size"), F.col("MimeType").alias("mime_type"), F.col("ModTime").alias("modified"), F.col("ID").alias("file_id"), F.col("Owner").alias("owner"))


def selected(spark: SparkSession, path: str) -> DataFrame:
    """SC17: the names of a filter file, a line each."""
    return spark.read.text(path).select(F.trim("value").alias("province")).where("province <> ''").distinct()


def env_settings(spark: SparkSession, path: str) -> dict[str, str]:
    """SC18: KEY=VALUE lines of a settings file, on the driver; comments, 'export' and quotes are left out."""
    found = {}
    for row in spark.read.text(path).collect():
        line = row.value.strip().removeprefix("export ")
        if line and not line.startswith("#") and "=" in line:
            key, _, value = line.partition("=")
            found[key.strip()] = value.strip().strip("\"'")
    return found
