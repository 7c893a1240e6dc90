"""TF1, C9: counts out of OCR Markdown."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from formloom.functions.text import ascii_digits, kind_of_path, parse_int

# The phrases of a count, and of a leading number. The unit ends before any letter, digit or underscore.
D = "0-9๐๑๒๓๔๕๖๗๘๙"
COUNT = rf"จำนวน(?U:\s)+([{D}]+)(?U:\s)*(คน|บัตร)(?![\p{{L}}\p{{N}}_])"
LEAD = rf"^(?U:\s)*([{D}]+(?:\.[{D}]+)*)(?U:\s)+"
BREAK = r"\r\n|[\n\r\u000b\u000c\u001c-\u001e\u0085\u2028\u2029]"
HEADER = r"^<!--\s*rel_path=(.*?)\s*-->$"


def count_items(files: DataFrame) -> DataFrame:
    """One row per count of (path, text): path, rel_path, order, schema, label, value, unit, raw_line.

    Hits of a line are numbered by their place; a label is all that stands before its hit. Files without a count
    give no rows here (see count_files).
    """
    lines = files.select("path", header().alias("rel_path"), F.posexplode(F.split(F.coalesce("text", F.lit("")), BREAK)).alias("line_no", "line"))
    lines = lines.withColumn("bare", F.trim(F.regexp_replace("line", r"^(?U:\s)+|(?U:\s)+$", "")))
    kept = lines.where((F.col("bare") != "") & ~(F.col("bare").startswith("<!--") & F.col("bare").endswith("-->")))
    hits = F.expr(f"regexp_extract_all(line, r'{COUNT}', 0)")
    kept = kept.withColumn("hits", hits).where(F.size("hits") > 0)
    # the start of each hit: the first place of its text after the end of the hit before
    starts = F.aggregate(
        "hits",
        F.struct(F.lit(1).alias("from"), F.array().cast("array<int>").alias("at")),
        lambda a, h: F.struct((F.call_function("locate", h, F.col("line"), a["from"]) + F.length(h)).alias("from"), F.concat(a["at"], F.array(F.call_function("locate", h, F.col("line"), a["from"]))).alias("at")),
        lambda a: a["at"],
    )
    one = kept.select("path", "rel_path", "line_no", "line", F.posexplode(F.arrays_zip("hits", starts.alias("at"))).alias("hit_no", "hit"))
    before = F.regexp_replace(F.col("line").substr(F.lit(1), F.col("hit.at") - 1), r"^(?U:\s)+|(?U:\s)+$", "")
    label = F.regexp_replace(F.regexp_replace(F.regexp_replace("before", LEAD, ""), r"(?U:\s)+", " "), r"^[ :\-–—\t]+|[ :\-–—\t]+$", "")
    out = one.withColumn("before", before).select(
        "path",
        "rel_path",
        "line_no",
        "hit_no",
        ascii_digits(F.regexp_extract("before", LEAD, 1)).alias("schema"),
        label.alias("label"),
        parse_int(F.regexp_extract("hit.hits", COUNT, 1)).alias("value"),
        F.regexp_extract("hit.hits", COUNT, 2).alias("unit"),
        F.regexp_replace("line", r"^(?U:\s)+|(?U:\s)+$", "").alias("raw_line"),
    )
    order = F.row_number().over(W.partitionBy("path").orderBy("line_no", "hit_no")) - 1
    return out.where("value is not null").withColumn("order", order).drop("line_no", "hit_no")


def header() -> Column:
    """The path in the first rel_path comment of a text, else null."""
    bare = F.transform(F.split(F.coalesce("text", F.lit("")), BREAK), lambda x: F.trim(x))
    return F.nullif(F.regexp_extract(F.get(F.filter(bare, lambda x: x.rlike(HEADER)), F.lit(0)), HEADER, 1), F.lit(""))


def count_files(files: DataFrame, kind: str | None = None) -> DataFrame:
    """One row per file with its counts, an empty array without any: rel_path, path, counts."""
    items = count_items(files).groupBy("path").agg(F.array_sort(F.collect_list(F.struct("order", "schema", "label", "value", "unit", "raw_line"))).alias("counts"))
    out = files.select("path", header().alias("rel_path")).join(items, "path", "left").select(F.coalesce("rel_path", F.col("path").cast("string")).alias("rel_path"), "path", F.coalesce("counts", F.expr("cast(array() as array<struct<order:int,schema:string,label:string,value:bigint,unit:string,raw_line:string>>)")).alias("counts"))
    return out if kind is None else out.where(kind_of_path(F.col("rel_path")) == kind)
