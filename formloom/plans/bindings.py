"""Adapters: the driver's tables as forms, cells, manifests, listings and lines.

Each is an integer function of the tables, written once as SQL expressions that Spark and DuckDB read alike.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from formloom.operators.validate import FIELDS
from formloom.session import table


def hit(n: int) -> str:
    return f"(CASE WHEN k % {n} = 0 THEN 1 ELSE 0 END)"


USED, REMAINING, INVALID, NONE = "(100 + k % 100)", "(20 + k % 50)", "(k % 7)", "(k % 5)"
FORM_COLUMNS = {
    "eligible_voters": "200 + k % 800",
    "voters_appeared": f"{USED} + {hit(19)}",
    "ballots_allocated": f"{USED} + {REMAINING} + {hit(31)}",
    "ballots_used": USED,
    "valid_ballots": f"{USED} - {INVALID} - {NONE} + 2 * {hit(23)}",
    "invalid_ballots": INVALID,
    "no_vote_ballots": NONE,
    "ballots_remaining": REMAINING,
}
INK = "CASE status WHEN 'F' THEN 'blue' WHEN 'O' THEN 'black' END"
SELECTED = ", ".join(f"{e} AS {c}" for c, e in FORM_COLUMNS.items())
UNPIVOTED = f"SELECT k, ink, province, field, v FROM forms UNPIVOT INCLUDE NULLS (v FOR field IN ({', '.join(FIELDS)}))"
GT = "CASE WHEN field = 'eligible_voters' AND k % 29 = 0 THEN NULL ELSE v END"
PRED = "CASE WHEN k % 17 = 0 THEN NULL WHEN k % 13 = 0 THEN v + k % 4 ELSE v END"

#: The adapters as SQL, in the order in which they build on each other.
SQL = {
    "base": "base AS MATERIALIZED (SELECT o_orderkey AS k, o_orderstatus AS status, n_name AS province, r_name AS region FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)",
    "forms": f"forms AS MATERIALIZED (SELECT k, province, region, {INK} AS ink, {SELECTED}, region || '/' || province || '/' || k || '.pdf' AS rel_path FROM base)",
    "long": f"long AS ({UNPIVOTED})",
    "gt": f"gt AS (SELECT k, ink, province, field, {GT} AS gt FROM long)",
    "pred": f"pred AS (SELECT k, field, {PRED} AS pred FROM long WHERE k % 11 <> 0)",
    "lines": "lines AS MATERIALIZED (SELECT l_orderkey AS k, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS ord, CAST(l_quantity AS BIGINT) AS v, (l_partkey % 100) / 100.0e0 AS confidence FROM lineitem)",
    "cells": f"cells AS (SELECT k, ord, v, confidence FROM lines UNION ALL SELECT k, count(*) + 1, CAST(sum(v) + max({hit(17)}) AS BIGINT), 0.9e0 FROM lines GROUP BY k)",
}


def with_sql(*names: str) -> str:
    return "WITH " + ", ".join(SQL[n] for n in names) + " "


def forms(spark: SparkSession, sf: str) -> DataFrame:
    orders, customer = table(spark, sf, "orders"), table(spark, sf, "customer")
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    places = customer.join(nation, customer.c_nationkey == nation.n_nationkey).join(region, nation.n_regionkey == region.r_regionkey)
    base = orders.join(places, orders.o_custkey == places.c_custkey).selectExpr("o_orderkey AS k", "o_orderstatus AS status", "n_name AS province", "r_name AS region")
    return base.selectExpr("k", "province", "region", f"{INK} AS ink", *(f"{e} AS {c}" for c, e in FORM_COLUMNS.items()), "concat(region, '/', province, '/', k, '.pdf') AS rel_path")


def long(spark: SparkSession, sf: str) -> DataFrame:
    return forms(spark, sf).unpivot(["k", "ink", "province"], list(FIELDS), "field", "v")


def truth(spark: SparkSession, sf: str) -> DataFrame:
    return long(spark, sf).selectExpr("k", "ink", "province", "field", f"{GT} AS gt")


def predicted(spark: SparkSession, sf: str) -> DataFrame:
    return long(spark, sf).where("k % 11 <> 0").selectExpr("k", "field", f"{PRED} AS pred")


def lines(spark: SparkSession, sf: str) -> DataFrame:
    w = W.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    return table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), F.row_number().over(w).cast("bigint").alias("ord"), F.col("l_quantity").cast("bigint").alias("v"), F.expr("(l_partkey % 100) / 100.0D").alias("confidence"))


def cells(spark: SparkSession, sf: str) -> DataFrame:
    rows = lines(spark, sf)
    total = rows.groupBy("k").agg((F.count("*") + 1).alias("ord"), (F.sum("v") + F.max(F.expr(hit(17)))).alias("v"), F.lit(0.9).alias("confidence"))
    return rows.unionByName(total)


def text_cells(spark: SparkSession, sf: str) -> DataFrame:
    return cells(spark, sf).select("k", "ord", F.col("v").cast("string").alias("value"), "confidence")
