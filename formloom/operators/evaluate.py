"""Scores of predictions against ground truth (J1, TF8, A3-A5, C3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from formloom.operators.validate import FIELDS


def unpivoted(wide: DataFrame, keys: list[str], value: str) -> DataFrame:
    """TF8: eight rows a form, null values too."""
    return wide.unpivot(keys, list(FIELDS), "field", value)


def detail(truth: DataFrame, predicted: DataFrame, keys: list[str]) -> DataFrame:
    """A row per field of which the truth is known: gt, pred, correct, abs_error (of wrong fields that are there)."""
    known = truth.where("gt is not null")
    both = known.join(predicted, [*keys, "field"], "left")
    correct = F.col("gt").eqNullSafe(F.col("pred"))
    return both.withColumn("correct", correct).withColumn("abs_error", F.when(~correct, F.abs(F.col("gt") - F.col("pred"))))


def measures() -> list:
    """A3: integers, from which rates and the mean absolute error follow."""
    return [F.count("*").alias("n_fields"), F.count_if("correct").alias("n_correct"), F.coalesce(F.sum("abs_error"), F.lit(0)).alias("err_sum"), F.count("abs_error").alias("err_n"), F.coalesce(F.max("abs_error"), F.lit(0)).alias("err_max")]


def grouped_metrics(rows: DataFrame) -> DataFrame:
    """A3-A5: overall, by ink type, province and field, in one pass; unknown groups are 'unknown'."""
    named = rows.withColumn("ink", F.coalesce("ink", F.lit("unknown"))).withColumn("province", F.coalesce("province", F.lit("unknown")))
    sets = [[], [F.col("ink")], [F.col("province")], [F.col("field")]]
    out = named.groupingSets(sets, F.col("ink"), F.col("province"), F.col("field")).agg(F.grouping_id().cast("bigint").alias("gid"), *measures())
    return out.select("gid", "ink", "province", "field", "n_fields", "n_correct", "err_sum", "err_n", "err_max")


def with_strata_guard(metrics: DataFrame) -> DataFrame:
    """Q15: strata of a single group are dropped. gid 3: ink, 5: province."""
    n = metrics.groupBy("gid").agg(F.count("*").alias("groups"))
    return metrics.join(F.broadcast(n), "gid").where("not (gid in (3, 5) and groups = 1)").drop("groups")


def form_exact(rows: DataFrame, truth_forms: DataFrame, key: str) -> DataFrame:
    """A3, Q7: how many forms of the truth are right in all their fields; forms without a known field aren't; one row."""
    per_form = rows.groupBy(key).agg(F.bool_and("correct").alias("exact"))
    return truth_forms.select(key).join(per_form, key, "left").agg(F.count("*").alias("n_forms"), F.count_if(F.coalesce("exact", F.lit(False))).alias("n_exact"))


def rates(metrics: DataFrame) -> DataFrame:
    """Q6: rates, rounded half to even; 0 where there is nothing to divide by."""
    accuracy = F.coalesce(F.try_divide(F.col("n_correct"), F.col("n_fields")), F.lit(0.0))
    mae = F.coalesce(F.try_divide(F.col("err_sum"), F.col("err_n")), F.lit(0.0))
    return metrics.withColumn("accuracy", F.bround(accuracy, 4)).withColumn("mae", F.bround(mae, 2))
