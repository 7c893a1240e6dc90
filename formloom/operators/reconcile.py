"""Reconciliation of two extraction pipelines (PR25, PR26, A12-A14, C2)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from formloom.functions.text import field_number, parse_int

# Vision names of canonical fields, and the vision name of each numbered field (the eighth has none).
ALIASES = {"showed_up": "voters_appeared", "ballots_received": "ballots_allocated"}
VISION_NAMES = ("eligible_voters", "showed_up", "ballots_received", "ballots_used", "valid_ballots", "invalid_ballots", "no_vote_ballots")


def cv_fields(regions: DataFrame, key: str) -> DataFrame:
    """PR25: (key, field_no, value) of (key, region_id, ord, value); of ids with the same number the last counts."""
    numbered = regions.select(key, field_number(F.col("region_id")).alias("field_no"), "ord", parse_int(F.col("value")).alias("v")).where("field_no is not null")
    return numbered.groupBy(key, "field_no").agg(F.max_by("v", "ord").alias("value"))


def vision_fields(stats: DataFrame, key: str) -> DataFrame:
    """PR26, TF8: (key, field, value) of wide stats, under canonical names; other columns are ignored."""
    names = [c for c in VISION_NAMES if c in stats.columns]
    long = stats.select(key, F.explode(F.array(*(F.struct(F.lit(ALIASES.get(c, c)).alias("field"), F.col(c).cast("bigint").alias("value")) for c in names))).alias("s"))
    return long.select(key, "s.field", "s.value")


def candidate_total(votes: Column) -> Column:
    """Sum of an array of votes; null if it is empty or any is null."""
    whole = (F.size(votes) > 0) & F.forall(votes, lambda v: v.isNotNull())
    return F.when(whole, F.aggregate(votes, F.lit(0).cast("bigint"), lambda a, v: a + v.cast("bigint")))


def reconcile(pairs: DataFrame, key: str) -> DataFrame:
    """C2 over one wide row per matched form: cv_1..cv_7, vision_1..vision_7, cv_total, vision_total, candidate_sum.

    A row per difference: key, check, field, field_index, cv_value, gemini_value, diff. Nulls are skipped.
    """

    def row(check: str, field: str, index: int | None, cv: Column, vision: Column, diff: Column) -> Column:
        return F.struct(F.lit(check).alias("chk"), F.lit(field).alias("field"), F.lit(index).cast("int").alias("field_index"), cv.cast("bigint").alias("cv_value"), vision.cast("bigint").alias("gemini_value"), diff.cast("bigint").alias("diff"))

    rules = []
    for n, name in enumerate(VISION_NAMES, 1):
        cv, vision = F.col(f"cv_{n}"), F.col(f"vision_{n}")
        rules.append(F.when(cv != vision, row("field_mismatch", name, n, cv, vision, F.abs(cv - vision))))
    cv, vision, total = F.col("cv_total"), F.col("vision_total"), F.col("candidate_sum")
    rules.append(F.when(cv != vision, row("table_total_mismatch", "total_candidate_votes", None, cv, vision, F.abs(cv - vision))))
    none = F.lit(None).cast("bigint")
    rules.append(F.when(total != vision, row("gemini_candidate_sum_mismatch", "sum(candidates.votes) vs total_candidate_votes", None, none, vision, F.abs(total - vision))))
    return pairs.select(key, F.explode(F.filter(F.array(*rules), lambda x: x.isNotNull())).alias("d")).select(key, "d.*")


def reconcile_pipelines(cv: DataFrame, vision: DataFrame, key: str) -> DataFrame:
    """Inner join on the key, then the differences."""
    return reconcile(cv.join(vision, key), key)


def discrepancy_counts(differences: DataFrame) -> DataFrame:
    """How many of each check."""
    return differences.groupBy("chk").agg(F.count("*").alias("n"))


def samples(rows: DataFrame, group: str, order: list[str], k: int = 5) -> DataFrame:
    """ST5: the first k rows of each group."""
    return rows.withColumn("rank", F.row_number().over(W.partitionBy(group).orderBy(*order))).where(F.col("rank") <= k)
