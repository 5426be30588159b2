"""Inserts, updates and deletes: the whole table after the change, and what the change did."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import predicates as P
from quern.functions.fields import fields
from quern.operators import writes as W
from quern.plans.tables import round_to, table

COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


def orders(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "orders")


def new_rows(spark: SparkSession, directory: str) -> DataFrame:
    """A batch with, per finished order, a replacement and a second one for the same key, and a new order."""
    done = orders(spark, directory).filter("o_orderstatus = 'F'")
    first = done.withColumns({"o_totalprice": F.lit(1.0), "n": F.lit(1)})
    second = done.withColumns({"o_totalprice": F.round(F.col("o_totalprice") * 2, 2), "n": F.lit(2)})
    fresh = done.withColumns({"o_orderkey": F.col("o_orderkey") + 100_000_000, "n": F.lit(1)})
    return second.unionByName(first).unionByName(fresh).drop("o_orderpriority")


BATCH = """
WITH batch AS (
  SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice * 2, 2) AS o_totalprice, o_orderdate, NULL AS o_orderpriority
  FROM orders WHERE o_orderstatus = 'F'
  UNION ALL
  SELECT o_orderkey + 100000000, o_custkey, o_orderstatus, o_totalprice, o_orderdate, NULL FROM orders WHERE o_orderstatus = 'F')
"""


def upserted(spark: SparkSession, directory: str) -> DataFrame:
    return W.upsert(orders(spark, directory), new_rows(spark, directory), "o_orderkey", "n").rows


def upserted_counts(spark: SparkSession, directory: str) -> DataFrame:
    return W.upsert(orders(spark, directory), new_rows(spark, directory), "o_orderkey", "n").counts


def gone(spark: SparkSession, directory: str) -> DataFrame:
    """Keys to delete, repeated, some of them unknown."""
    dear = orders(spark, directory).filter("o_totalprice > 300000").select("o_orderkey")
    return dear.unionAll(dear).unionAll(dear.select(F.col("o_orderkey") + 100_000_000))


def deleted_by_ids(spark: SparkSession, directory: str) -> DataFrame:
    return W.delete_by_ids(orders(spark, directory), "o_orderkey", gone(spark, directory)).rows


def deleted_by_ids_count(spark: SparkSession, directory: str) -> DataFrame:
    return W.delete_by_ids(orders(spark, directory), "o_orderkey", gone(spark, directory)).counts


def deleted_where(spark: SparkSession, directory: str) -> DataFrame:
    """Rows for which the condition is unknown stay."""
    current = orders(spark, directory).withColumn("o_orderpriority", F.nullif("o_orderpriority", F.lit("5-LOW")))
    f = fields(current)
    return W.delete_where(current, P.gt(f["o_orderpriority"], "2") & P.lt(f["o_totalprice"], 400000.0)).rows


def updated_by_id(spark: SparkSession, directory: str) -> DataFrame:
    patch = {"o_totalprice": 1.5, "o_orderstatus": "X", "o_orderpriority": None}
    return W.update_by_id(orders(spark, directory), "o_orderkey", 42, patch).rows


def patches(spark: SparkSession, directory: str) -> DataFrame:
    """Per open order two patches, each giving other columns and both a price."""
    pending = orders(spark, directory).filter("o_orderstatus = 'O'")
    none = F.lit(None)
    first = pending.select(
        "o_orderkey",
        F.lit(1.0).alias("o_totalprice"),
        F.lit("9-NEW").alias("o_orderpriority"),
        none.cast("string").alias("o_orderstatus"),
        F.lit(1).alias("n"),
    )
    second = pending.select(
        "o_orderkey",
        (F.col("o_totalprice") + 0.5).alias("o_totalprice"),
        none.cast("string").alias("o_orderpriority"),
        F.when(F.col("o_totalprice") > 250000, "D").alias("o_orderstatus"),
        F.lit(2).alias("n"),
    )
    return second.unionByName(first)


def updated_batch(spark: SparkSession, directory: str) -> DataFrame:
    change = W.update_batch(orders(spark, directory), patches(spark, directory), "o_orderkey", "n")
    return change.rows.withColumn("o_totalprice", round_to("o_totalprice", 2))


def updated_where(spark: SparkSession, directory: str) -> DataFrame:
    current = orders(spark, directory)
    found = P.eq(fields(current)["o_orderpriority"], "1-URGENT") & P.lt(fields(current)["o_totalprice"], 100000.0)
    return W.update_where(current, found, {"o_totalprice": 500.0, "o_orderpriority": None}).rows


LISTED = ", ".join(COLUMNS)

QUERIES = {
    "DML1_upsert": (
        upserted,
        BATCH
        + f"SELECT {LISTED} FROM batch UNION ALL SELECT {LISTED} FROM orders WHERE o_orderkey NOT IN (SELECT o_orderkey FROM batch)",
    ),
    "DML1_upsert_counts": (
        upserted_counts,
        BATCH
        + "SELECT count(*) AS affected, count(*) FILTER (WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders)) AS created,"
        " count(*) FILTER (WHERE o_orderkey IN (SELECT o_orderkey FROM orders)) AS updated FROM batch",
    ),
    "DML2_delete_by_ids": (
        deleted_by_ids,
        f"SELECT {LISTED} FROM orders WHERE o_totalprice <= 300000",
    ),
    "DML2_delete_by_ids_count": (
        deleted_by_ids_count,
        "SELECT count(*) AS affected FROM orders WHERE o_totalprice > 300000",
    ),
    "DML3_delete_where": (
        deleted_where,
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, nullif(o_orderpriority, '5-LOW') AS o_orderpriority"
        " FROM orders WHERE NOT coalesce(nullif(o_orderpriority, '5-LOW') > '2' AND o_totalprice < 400000, false)",
    ),
    "DML4_update_by_id": (
        updated_by_id,
        "SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey = 42 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,"
        " CASE WHEN o_orderkey = 42 THEN 1.5 ELSE o_totalprice END AS o_totalprice, o_orderdate, o_orderpriority FROM orders",
    ),
    "DML5_update_batch": (
        updated_batch,
        "SELECT o_orderkey, o_custkey,"
        " CASE WHEN o_orderstatus = 'O' AND o_totalprice > 250000 THEN 'D' ELSE o_orderstatus END AS o_orderstatus,"
        " round(CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 0.5 ELSE o_totalprice END, 2) AS o_totalprice, o_orderdate,"
        " CASE WHEN o_orderstatus = 'O' THEN '9-NEW' ELSE o_orderpriority END AS o_orderpriority FROM orders",
    ),
    "DML6_update_where": (
        updated_where,
        "SELECT o_orderkey, o_custkey, o_orderstatus,"
        " CASE WHEN o_orderpriority = '1-URGENT' AND o_totalprice < 100000 THEN 500.0 ELSE o_totalprice END AS o_totalprice,"
        " o_orderdate, o_orderpriority FROM orders",
    ),
}
