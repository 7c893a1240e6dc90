"""Validation of forms: identities, ranges, triage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from formloom.functions.text import parse_int, range_check, strict_int, triage

# The eight fields of a form, in order.
FIELDS = ("eligible_voters", "voters_appeared", "ballots_allocated", "ballots_used", "valid_ballots", "invalid_ballots", "no_vote_ballots", "ballots_remaining")
FIELD_RANGE, CELL_RANGE = (0, 10_000), (0, 1_000)


def finding(check: str, failed: Column, detail: Column) -> Column:
    """A (chk, detail) struct where the rule fails; null where it holds or can't be told."""
    return F.when(failed, F.struct(F.lit(check).alias("chk"), detail.alias("detail")))


def ballot_findings() -> list[Column]:
    """V1, V2, V3 over the columns of FIELDS; a null makes a rule untold."""
    valid, invalid, none, used = (F.col(c) for c in ("valid_ballots", "invalid_ballots", "no_vote_ballots", "ballots_used"))
    remaining, allocated, appeared = F.col("ballots_remaining"), F.col("ballots_allocated"), F.col("voters_appeared")
    return [
        finding("ballot_breakdown_sum", valid + invalid + none != used, F.concat(valid + invalid + none, F.lit(" != "), used)),
        finding("ballot_allocation_sum", used + remaining != allocated, F.concat(used + remaining, F.lit(" != "), allocated)),
        finding("voters_vs_ballots", appeared != used, F.concat(appeared, F.lit(" != "), used)),
    ]


def exploded(df: DataFrame, keys: list[str], findings: list[Column]) -> DataFrame:
    """A row per finding, in the order given."""
    found = F.filter(F.array(*findings), lambda x: x.isNotNull())
    return df.select(*keys, F.explode(found).alias("f")).select(*keys, "f.chk", "f.detail")


def ballot_identities(forms: DataFrame, keys: list[str]) -> DataFrame:
    return exploded(forms, keys, ballot_findings())


def vision_stats_checks(stats: DataFrame, keys: list[str]) -> DataFrame:
    """V7, V8: stats of text, coerced strictly."""
    v = {c: strict_int(F.col(c).cast("string")) for c in ("valid_ballots", "invalid_ballots", "no_vote_ballots", "ballots_used", "total_candidate_votes")}
    total = v["valid_ballots"] + v["invalid_ballots"] + v["no_vote_ballots"]
    return exploded(
        stats,
        keys,
        [
            finding("ballot_sum", total != v["ballots_used"], F.concat(total, F.lit(" != "), v["ballots_used"])),
            finding("votes_exceed_valid", v["total_candidate_votes"] > v["valid_ballots"], F.concat(v["total_candidate_votes"], F.lit(" > "), v["valid_ballots"])),
        ],
    )


def table_totals(cells: DataFrame, key: str) -> DataFrame:
    """Per table: rows, sum of all but the last row, total (the last row), parsed (whether all rows are numbers).

    One aggregate: the last row is the one of the greatest ordinal; sums need no sort.
    """
    value = parse_int(F.col("value"))
    rows = cells.select(key, "ord", value.alias("v"))
    out = rows.groupBy(key).agg(F.count("*").alias("n_rows"), F.sum("v").alias("all_sum"), F.max_by("v", "ord").alias("total"), F.bool_and(F.col("v").isNotNull()).alias("parsed"))
    return out.select(key, "n_rows", (F.col("all_sum") - F.col("total")).alias("rows_sum"), "total", "parsed")


def table_total_check(cells: DataFrame, key: str) -> DataFrame:
    """V4: tables of two rows or more whose rows don't add up to their last."""
    return table_totals(cells, key).where("parsed and n_rows >= 2 and rows_sum <> total").select(key, F.lit("table_column_sum").alias("chk"), "rows_sum", "total")


def table_vs_valid(cells: DataFrame, forms: DataFrame, key: str) -> DataFrame:
    """V5: total of the table against the form's valid ballots."""
    totals = table_totals(cells, key).where("parsed and n_rows >= 2").select(key, "total")
    return totals.join(forms.select(key, "valid_ballots"), key).where("total <> valid_ballots").select(key, F.lit("table_total_vs_valid_ballots").alias("chk"), "total", "valid_ballots")


def completeness(fields: DataFrame, key: str) -> DataFrame:
    """V6: forms of some but not all eight fields (value null: not there)."""
    n = fields.where("value is not null").groupBy(key).agg(F.count("*").alias("n_fields"))
    return n.where("n_fields > 0 and n_fields < 8").select(key, F.lit("incomplete_fields").alias("chk"), F.concat(F.lit("missing "), 8 - F.col("n_fields")).alias("detail"))


def triaged(rows: DataFrame, is_cell: bool, auto: float = 0.70) -> DataFrame:
    """V9, PR7: adds parsed, range, status and reason to rows of value and confidence."""
    low, high = CELL_RANGE if is_cell else FIELD_RANGE
    out = rows.withColumn("parsed", parse_int(F.col("value")))
    out = out.withColumn("range_check", range_check(F.col("parsed"), low, high)).withColumn("status", triage(F.col("confidence"), auto))
    bad, status = F.col("range_check") != "pass", F.col("status")
    low_confidence = F.when(status != "auto_accepted", F.lit("low_confidence"))
    if is_cell:
        reason = F.when(status == "manual_entry", F.lit("low_confidence")).when(bad, F.lit("outlier_value")).otherwise(low_confidence)
    else:
        reason = F.coalesce(low_confidence, F.when(bad, F.lit("validation_warning")))
    return out.withColumn("reason", reason)


def triage_counts(rows: DataFrame) -> DataFrame:
    """V9: how many rows of triaged() are accepted, to be reviewed and to be typed in; one row."""
    auto = (F.col("status") == "auto_accepted") & (F.col("range_check") == "pass")
    manual = F.col("status") == "manual_entry"
    return rows.agg(F.count("*").alias("total_extractions"), F.count_if(auto).alias("auto_accepted"), F.count_if(~auto & ~manual).alias("review_queue"), F.count_if(manual).alias("manual_entry"))


def validate_forms(forms: DataFrame, cells: DataFrame, fields: DataFrame, key: str) -> DataFrame:
    """All findings of the forms, as (key, chk, detail): of the ballots, the table, then completeness.

    Cells and fields are summed once and joined to the forms, so that all rules are told of one row; a table or fields without
    a form are told of too. Q20: findings join the review queue but no count.
    """
    totals = table_totals(cells, key).where("parsed and n_rows >= 2").select(key, "rows_sum", "total")
    counted = fields.where("value is not null").groupBy(key).agg(F.count("*").alias("n_fields"))
    wide = forms.select(key, *FIELDS).join(totals, key, "full").join(counted, key, "full")
    total, n = F.col("total"), F.col("n_fields")
    rules = [
        *ballot_findings(),
        finding("table_column_sum", F.col("rows_sum") != total, F.concat("rows_sum", F.lit(" != "), "total")),
        finding("table_total_vs_valid_ballots", total != F.col("valid_ballots"), F.concat("total", F.lit(" != "), "valid_ballots")),
        finding("incomplete_fields", (n > 0) & (n < len(FIELDS)), F.concat(F.lit("missing "), len(FIELDS) - n)),
    ]
    return exploded(wide, [key], rules)


# Reasons of a document for manual review, with the flag that raises each.
REVIEW_REASONS = (
    ("fields_zone_templates_not_found", "not fields_zone_found"),
    ("region_templates_failed_fields_skipped", "not region_templates_found"),
    ("fields_band_table_boundary_failed", "not table_boundary_found"),
    ("fields_band_ocr_fallback_skipped_invalid_band", "not band_valid"),
    ("table_detection_failed", "has_table and not table_found"),
)


def review_reasons(pages: DataFrame, keys: list[str]) -> DataFrame:
    """A row per reason of each page."""
    found = F.filter(F.array(*(F.when(F.expr(rule), F.lit(reason)) for reason, rule in REVIEW_REASONS)), lambda x: x.isNotNull())
    return pages.select(*keys, F.explode(found).alias("reason"))


def schema_violations(rows: DataFrame, keys: list[str], enums: dict[str, tuple[str, ...]], minimums: dict[str, int], required: list[str]) -> DataFrame:
    """A row per rule that a ground-truth row breaks."""
    rules = [F.when(F.col(c).isNull(), F.struct(F.lit(c).alias("column"), F.lit("required").alias("rule"))) for c in required]
    rules += [F.when(~F.col(c).isin(*v), F.struct(F.lit(c).alias("column"), F.lit("enum").alias("rule"))) for c, v in enums.items()]
    rules += [F.when(F.col(c) < v, F.struct(F.lit(c).alias("column"), F.lit("minimum").alias("rule"))) for c, v in minimums.items()]
    return rows.select(*keys, F.explode(F.filter(F.array(*rules), lambda x: x.isNotNull())).alias("v")).select(*keys, "v.column", "v.rule")


def table_grid_page(lines: DataFrame, keys: list[str], least_length: int = 140, most_skew: int = 6) -> DataFrame:
    """V11, IM21: whether a page has at least three long lines of either direction, from (x1, y1, x2, y2)."""
    dx, dy = F.abs(F.col("x2") - F.col("x1")), F.abs(F.col("y2") - F.col("y1"))
    across, down = (dx >= least_length) & (dy <= most_skew), (dy >= least_length) & (dx <= most_skew)
    return lines.groupBy(*keys).agg(F.count_if(across).alias("n_h"), F.count_if(down).alias("n_v")).withColumn("has_table", (F.col("n_h") >= 3) & (F.col("n_v") >= 3))


def first_page_warning(pages: DataFrame, key: str) -> DataFrame:
    """Files of which more than half the pages begin a document."""
    return pages.groupBy(key).agg(F.count_if("is_first").alias("n_first"), F.count("*").alias("n_pages")).where("n_first * 2 > n_pages")


def row_numbers(cells: DataFrame, key: str, page: str, grid_row: str) -> DataFrame:
    """Row number of a kept cell: grid row in its page, after all cells kept on earlier pages of the document."""
    before = F.count("*").over(W.partitionBy(key).orderBy(page).rangeBetween(W.unboundedPreceding, -1))
    return cells.withColumn("offset", before).withColumn("row_number", F.col(grid_row) + F.col("offset"))
