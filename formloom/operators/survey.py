"""Surveys of file collections."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from formloom.functions.paths import path_metadata
from formloom.functions.text import ALL_BUCKETS, clean_cell, email_class, filename_class, human_bytes, size_bucket, without_last_dash


def largest_by_folder(rows: DataFrame) -> DataFrame:
    """Of the rows that share a folder the largest stays (of equals the first); rows without a folder all stay."""
    order = F.struct(F.col("bytes"), -F.col("ord"))
    own = [c for c in rows.columns if c != "folder_id"]
    shared = rows.where("folder_id <> ''").groupBy("folder_id").agg(F.max_by(F.struct(*own), order).alias("r")).select("r.*", "folder_id")
    return shared.select(*rows.columns).unionByName(rows.where("folder_id = '' or folder_id is null"))


def global_totals(rows: DataFrame) -> DataFrame:
    """Totals over distinct folders; one row."""
    return largest_by_folder(rows).agg(F.count("*").alias("n_folders"), F.sum("files").alias("files"), F.sum("bytes").alias("bytes"))


def region_totals(rows: DataFrame, unnamed: str = "ไม่ระบุ") -> DataFrame:
    """By region: all provinces; files and bytes of the first row of each folder in it."""
    named = rows.withColumn("region", F.when(F.coalesce("region", F.lit("")) == "", F.lit(unnamed)).otherwise(F.col("region")))
    first = named.where("folder_id <> ''").groupBy("region", "folder_id").agg(F.min_by(F.struct("files", "bytes"), "ord").alias("r")).select("region", "r.*")
    counted = first.unionByName(named.where("coalesce(folder_id, '') = ''").select("region", "files", "bytes"))
    sums = counted.groupBy("region").agg(F.sum("files").alias("files"), F.sum("bytes").alias("bytes"))
    return named.groupBy("region").agg(F.count("*").alias("provinces")).join(sums, "region")


def size_histogram(spark: SparkSession, rows: DataFrame, size: str) -> DataFrame:
    """Count of every bucket, empty ones too."""
    n = rows.groupBy(size_bucket(F.col(size)).alias("bucket")).agg(F.count("*").alias("n"))
    buckets = spark.range(1).select(F.explode(F.array(*map(F.lit, ALL_BUCKETS))).alias("bucket"))
    return buckets.join(n, "bucket", "left").select("bucket", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))


def account_types(rows: DataFrame, address: str) -> DataFrame:
    """Accounts of each class."""
    return rows.groupBy(email_class(F.col(address)).alias("email_type")).agg(F.count("*").alias("n"))


def constituency_counts(rows: DataFrame, const_id: str) -> DataFrame:
    """A6, PR35: distinct constituencies of each province."""
    return rows.groupBy(without_last_dash(F.col(const_id)).alias("province")).agg(F.count_distinct(const_id).alias("constituencies"))


def shared_folders(rows: DataFrame) -> DataFrame:
    """Folders that more than one province has."""
    return rows.where("folder_id <> ''").groupBy("folder_id").agg(F.count("*").alias("n")).where("n > 1")


def duplicate_folders(rows: DataFrame) -> DataFrame:
    """Each province that shares its folder, with how many others do, and their names in the order of the list."""
    groups = rows.where("folder_id <> ''").groupBy("folder_id").agg(F.array_sort(F.collect_list(F.struct("ord", "province"))).alias("all")).where(F.size("all") > 1)
    both = rows.join(groups, "folder_id")
    others = F.transform(F.filter("all", lambda x: x["ord"] != F.col("ord")), lambda x: x["province"])
    return both.select("province", "ord", "folder_id", (F.size("all") - 1).cast("bigint").alias("n_others"), F.array_join(others, ", ").alias("others"))


def outliers(rows: DataFrame, key: str, sigmas: float = 2.0) -> DataFrame:
    """Rows whose bytes a constituency lie beyond 2 population sigmas; at least three rows, and a sigma above 0.

    Mean and sigma are one aggregate of one row, joined back: no window over the whole table.
    """
    good = rows.where("constituencies > 0 and bytes > 0").select(key, (F.col("bytes") / F.col("constituencies")).alias("v"))
    stats = good.agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s"), F.count("*").alias("n"))
    both = good.join(F.broadcast(stats)).where("n >= 3 and s > 0")
    far = both.where(F.abs(F.col("v") - F.col("m")) > sigmas * F.col("s"))
    return far.select(key, F.when(F.col("v") > F.col("m"), F.lit("high")).otherwise(F.lit("low")).alias("direction"), ((F.col("v") - F.col("m")) / F.col("s")).alias("sigma"))


def anomalies(rows: DataFrame) -> DataFrame:
    """C4: (province, tag, detail) of (province, ord, folder_id, files, bytes, constituencies, error)."""
    missing = rows.where("coalesce(folder_id, '') = ''").select("province", F.lit("missing_link").alias("tag"), F.lit("").alias("detail"))
    shared = duplicate_folders(rows).select("province", F.lit("duplicate_folder_id").alias("tag"), F.col("others").alias("detail"))
    empty = rows.where("folder_id <> '' and files = 0 and coalesce(error, '') = ''").select("province", F.lit("empty_folder").alias("tag"), F.lit("").alias("detail"))
    far = outliers(rows, "province").select("province", F.lit("size_outlier").alias("tag"), F.format_string("%s outlier: %+.1fσ per-constituency", "direction", "sigma").alias("detail"))
    return missing.unionByName(shared).unionByName(empty).unionByName(far)


def anomaly_tags(found: DataFrame) -> DataFrame:
    """C4: tags of each province, without repeats."""
    return found.groupBy("province").agg(F.array_join(F.array_sort(F.collect_set("tag")), ",").alias("tags"))


def looked_up(rows: DataFrame, dim: DataFrame, key: str, value: str, default) -> DataFrame:
    """A value of a small dimension, or the default."""
    return rows.join(dim.select(key, value), key, "left").withColumn(value, F.coalesce(value, F.lit(default)))


def owner_lookup(rows: DataFrame, owners: DataFrame) -> DataFrame:
    """Owner by folder id, else by province, else not_scanned. Of several owners of a key the least counts, so that no row is repeated."""
    owners = owners.groupBy("key").agg(F.min("owner").alias("owner"))
    keyed = rows.withColumn("lookup", F.coalesce(F.nullif("folder_id", F.lit("")), "province"))
    return keyed.join(owners.select(F.col("key").alias("lookup"), "owner"), "lookup", "left").withColumn("owner", F.coalesce("owner", F.lit("not_scanned"))).drop("lookup")


def fanned_out(scanned: DataFrame, links: DataFrame) -> DataFrame:
    """What was scanned of a folder, for every province that links to it."""
    return links.join(scanned.drop("province"), "folder_id")


def province_files(listing: DataFrame) -> DataFrame:
    """Files, bytes and owner (of the first file) of each province."""
    return listing.groupBy("province").agg(F.count("*").alias("files"), F.sum("size").alias("bytes"), F.min_by("owner", "ord").alias("owner")).withColumn("size_human", human_bytes(F.col("bytes")))


def owners_of(listing: DataFrame) -> DataFrame:
    """A21, SO4: distinct owners without blank ones, in order; one row."""
    return listing.agg(F.array_sort(F.collect_set(F.nullif("owner", F.lit("")))).alias("owners"))


def folder_totals(paths: DataFrame, key: str) -> DataFrame:
    """Files, PDFs, folders and greatest depth, of (key, path)."""
    parts = F.split("path", "/")
    return paths.groupBy(key).agg(F.count("*").alias("files"), F.count_if(F.lower("path").endswith(".pdf")).alias("pdfs"), F.count_distinct(F.regexp_replace("path", "/?[^/]*$", "")).alias("folders"), F.max(F.size(parts) - 1).cast("bigint").alias("max_depth"))


def folder_counts(paths: DataFrame, key: str) -> DataFrame:
    """SC15: every folder of the paths of a key, with its depth and its files: its own, and those anywhere below it."""
    parts = F.split("path", "/")
    up = F.transform(F.sequence(F.lit(0), F.size(parts) - 1), lambda n: F.struct(n.alias("depth"), F.array_join(F.slice(parts, 1, n), "/").alias("folder"), (n == F.size(parts) - 1).alias("own")))
    folders = paths.select(key, F.explode(up).alias("f")).select(key, "f.*")
    return folders.groupBy(key, "folder", "depth").agg(F.count_if("own").alias("files"), F.count("*").alias("files_below"))


def dominant_depth(paths: DataFrame, key: str, order: str) -> DataFrame:
    """The commonest depth; of equals the one seen first."""
    depth = paths.select(key, order, (F.size(F.split("path", "/")) - 1).cast("bigint").alias("depth"))
    n = depth.groupBy(key, "depth").agg(F.count("*").alias("n"), F.min(order).alias("seen"))
    return n.groupBy(key).agg(F.max_by(F.struct("depth", "n"), F.struct(F.col("n"), -F.col("seen"))).alias("r")).select(key, "r.depth", "r.n")


def naming_patterns(paths: DataFrame, key: str) -> DataFrame:
    """Files of each name class."""
    return paths.groupBy(key, filename_class(F.element_at(F.split("path", "/"), -1)).alias("pattern")).agg(F.count("*").alias("n"))


def level_signature(paths: DataFrame, key: str, most: int = 3) -> DataFrame:
    """A17: 'L1(n): a, b, c, ...' of the distinct names of each level."""
    names = paths.select(key, F.posexplode(F.split("path", "/")).alias("level", "name")).distinct()
    ranked = names.groupBy(key, "level").agg(F.count("*").alias("n"))
    top = names.withColumn("rank", F.row_number().over(W.partitionBy(key, "level").orderBy("name"))).where(F.col("rank") <= most)
    shown = top.groupBy(key, "level").agg(F.array_join(F.array_sort(F.collect_list("name")), ", ").alias("shown"))
    text = F.format_string("L%d(%d): %s%s", F.col("level") + 1, "n", "shown", F.when(F.col("n") > most, F.lit(", ...")).otherwise(F.lit("")))
    return ranked.join(shown, [key, "level"]).select(key, F.col("level").cast("bigint").alias("level"), text.alias("signature"))


def depth_patterns(paths: DataFrame, key: str) -> DataFrame:
    """How many keys have each pattern of depths."""
    depth = paths.select(key, (F.size(F.split("path", "/")) - 1).alias("depth")).distinct()
    pattern = depth.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_set("depth")), lambda d: d.cast("string")), ",").alias("pattern"))
    return pattern.groupBy("pattern").agg(F.count("*").alias("n"))


def levels(paths: DataFrame, depth: int = 4) -> DataFrame:
    """TF7: the first parts of a path as columns, '' beyond its end."""
    parts = F.split("path", "/")
    return paths.select("*", *(F.coalesce(F.get(parts, k), F.lit("")).alias(f"level_{k + 1}") for k in range(depth)))


def coverage(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows of which each attribute is known; one row."""
    return rows.agg(F.count("*").alias("total"), *(F.count(c).alias(f"n_{c}") for c in columns))


def dominant_patterns(paths: DataFrame, order: str) -> DataFrame:
    """The commonest name class of the files of each folder; of equals the one seen first."""
    named = paths.select(F.regexp_replace("path", "/?[^/]*$", "").alias("folder"), filename_class(F.element_at(F.split("path", "/"), -1)).alias("pattern"), order)
    n = named.groupBy("folder", "pattern").agg(F.count("*").alias("n"), F.min(order).alias("seen"))
    return n.groupBy("folder").agg(F.max_by(F.struct("pattern", "n"), F.struct(F.col("n"), -F.col("seen"))).alias("r")).select("folder", "r.pattern", "r.n")


def depth_pattern_members(paths: DataFrame, key: str) -> DataFrame:
    """The pattern of depths of each key, as rows, with how many keys share it."""
    depth = paths.select(key, (F.size(F.split("path", "/")) - 1).alias("depth")).distinct()
    pattern = depth.groupBy(key).agg(F.array_join(F.transform(F.array_sort(F.collect_set("depth")), lambda d: d.cast("string")), ",").alias("pattern"))
    return pattern.join(pattern.groupBy("pattern").agg(F.count("*").alias("n")), "pattern")


def distinct_values(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(attribute, value, n): the distinct known values of each attribute, as rows."""
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("attribute"), F.col(c).cast("string").alias("value")) for c in columns)))
    return rows.select(pairs.alias("p")).select("p.*").where("value is not null").groupBy("attribute", "value").agg(F.count("*").alias("n"))


def by_size(rows: DataFrame) -> DataFrame:
    """ST2: the largest first, equals in the order of the list."""
    return rows.orderBy(F.col("bytes").desc(), "ord")


def survey_status(rows: DataFrame) -> DataFrame:
    """A10: how many provinces were scanned, failed, or have no link."""
    status = F.when(F.coalesce("folder_id", F.lit("")) == "", F.lit("skipped")).when(F.coalesce("error", F.lit("")) != "", F.lit("error")).otherwise(F.lit("scanned"))
    return rows.groupBy(status.alias("status")).agg(F.count("*").alias("n"))


def survey_summary(spark: SparkSession, rows: DataFrame) -> DataFrame:
    """The size survey as rows (section, name, n, bytes): total, regions, histogram, statuses and anomalies."""
    none = F.lit(None).cast("bigint").alias("bytes")
    total = global_totals(rows).select(F.lit("total").alias("section"), F.lit("folders").alias("name"), F.col("n_folders").alias("n"), "bytes")
    regions = region_totals(rows).select(F.lit("region").alias("section"), F.col("region").alias("name"), F.col("provinces").alias("n"), "bytes")
    buckets = size_histogram(spark, rows, "bytes").select(F.lit("size").alias("section"), F.col("bucket").alias("name"), "n", none)
    statuses = survey_status(rows).select(F.lit("status").alias("section"), F.col("status").alias("name"), "n", none)
    tags = anomalies(rows).groupBy("tag").agg(F.count("*").alias("n")).select(F.lit("anomaly").alias("section"), F.col("tag").alias("name"), "n", none)
    return total.unionByName(regions).unionByName(buckets).unionByName(statuses).unionByName(tags)


def owner_report(rows: DataFrame, owners: DataFrame) -> DataFrame:
    """Per province its owner, the class of the account, and how many provinces share its folder (1: none other)."""
    named = owner_lookup(rows, owners).withColumn("email_type", F.when(F.col("owner") == "not_scanned", F.lit("not_scanned")).otherwise(email_class(F.col("owner"))))
    return named.join(shared_folders(rows), "folder_id", "left").select("province", "folder_id", "owner", "email_type", F.coalesce("n", F.lit(1)).cast("bigint").alias("n_sharing"))


def listing_report(files: DataFrame, links: DataFrame) -> DataFrame:
    """C7, SK8, J7: files of scanned folders (folder_id, ord, size, owner) as totals of every province that links to the folder: province, ord, files, bytes, owner, size_human."""
    found = files.groupBy("folder_id").agg(F.count("*").alias("files"), F.sum("size").alias("bytes"), F.min_by("owner", "ord").alias("owner"))
    return fanned_out(found, links.select("province", "ord", "folder_id")).withColumn("size_human", human_bytes(F.col("bytes")))


#: Links, and files, of one folder that meet in one cell of the master listing, about.
CELL = 256


def master_listing(files: DataFrame, links: DataFrame) -> DataFrame:
    """SK8: every file of a folder once for each province that links to it.

    Folders are few and the result grows with a folder's links times its files, so it isn't dealt by folder. The links and
    the files of a folder are cut into runs of about CELL by a hash; a run of each is a cell, and cells are dealt out, so
    that a row is copied once for each run of the other side. Only folders beyond CELL are listed with their runs, by
    counts that read the same rows first; the others are one cell. The exchange also keeps what is computed of a file (a
    length, a path) out of the join, which would do it again for each province. The number of partitions is given, as
    bytes say little of the rows that a cell makes. The list of runs is rebalanced so that both sides of its join are plain exchanges.
    """
    runs = lambda rows, n: rows.groupBy("folder_id").agg(F.ceil(F.count("*") / CELL).alias(n))
    cut = runs(links, "link_runs").join(runs(files, "file_runs"), "folder_id").where("link_runs > 1 or file_runs > 1").hint("rebalance")
    partitions = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def dealt(rows: DataFrame, keep: list[str], own: str, other: str) -> DataFrame:
        hashed = rows.select(*keep, F.xxhash64(*rows.columns).alias("cut_by")).join(cut, "folder_id", "left")
        run = F.pmod("cut_by", F.coalesce(f"{own}_runs", F.lit(1))).alias(f"{own}_run")
        copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(f"{other}_runs", F.lit(1)) - 1)).alias(f"{other}_run")
        return hashed.select(*keep, run, copies).repartition(partitions, "folder_id", "link_run", "file_run")

    cells = dealt(links, ["province", "folder_id"], "link", "file").hint("merge")
    return cells.join(dealt(files, files.columns, "file", "link"), ["folder_id", "link_run", "file_run"]).drop("link_run", "file_run")


def folder_survey(paths: DataFrame, key: str, order: str) -> DataFrame:
    """A profile of each key's files: totals, commonest depth, pattern of depths."""
    depth = dominant_depth(paths, key, order).select(key, F.col("depth").alias("main_depth"))
    pattern = depth_pattern_members(paths, key).select(key, F.col("pattern").alias("depths"))
    return folder_totals(paths, key).join(depth, key).join(pattern, key)


def path_report(paths: DataFrame) -> DataFrame:
    """What path_metadata finds in each path, with the file's name."""
    return paths.select("path", path_metadata(F.col("path")).alias("m")).select("path", F.element_at(F.split("path", "/"), -1).alias("file"), "m.province", "m.constituency", "m.amphoe", "m.tambon", "m.form_type", "m.unit_number", "m.is_advance_voting")


def page_tables(tables: DataFrame) -> DataFrame:
    """C16, SO5, PR11: the cells of table rows (page, row_no, cells) as cleaned columns c0, c1, ...; narrow tables are filled with ''.

    As many columns as the widest row has, so all pages' tables stand below each other under one header.
    """
    width = tables.agg(F.coalesce(F.max(F.size("cells")), F.lit(0))).first()[0]
    cell = lambda k: F.coalesce(clean_cell(F.get("cells", F.lit(k))), F.lit("")).alias(f"c{k}")
    return tables.select("page", "row_no", *(cell(k) for k in range(width)))


def size_report(rows: DataFrame) -> DataFrame:
    """C5, SK16, PR30: the report as one JSON text, over totals, regions, statuses and anomalies."""
    statuses = survey_status(rows).agg(F.array_sort(F.collect_list(F.struct("status", "n"))).alias("statuses"))
    regions = region_totals(rows).agg(F.array_sort(F.collect_list(F.struct("region", "provinces", "files", "bytes"))).alias("regions"))
    found = anomalies(rows).groupBy("tag").agg(F.count("*").alias("n")).agg(F.array_sort(F.collect_list(F.struct("tag", "n"))).alias("anomalies"))
    return global_totals(rows).crossJoin(F.broadcast(regions)).crossJoin(F.broadcast(statuses)).crossJoin(F.broadcast(found)).select(F.to_json(F.struct("*")).alias("report"))
