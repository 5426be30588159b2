"""Tables laid out by key: changes that rewrite only some partitions, reads that look into some partitions or buckets."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions.fields import fields
from quern.operators.reads import with_ids
from quern.plans import changes
from quern.plans.rebuilding import scratch_database
from quern.plans.tables import round_to, table
from quern.sources import partitioned, versions

PARTS = 32


def _created(spark: SparkSession, directory: str) -> str:
    name = f"{scratch_database(spark)}.orders"
    partitioned.create(table(spark, directory, "orders"), name, "o_orderkey", PARTS)
    return name


def upserted(spark: SparkSession, directory: str) -> DataFrame:
    """The table after a batch, with what the write says it did."""
    name = _created(spark, directory)
    done = partitioned.upsert_into(spark, name, changes.new_rows(spark, directory), "n")
    return partitioned.rows(spark, name).withColumns({"created": F.lit(done.created), "updated": F.lit(done.updated)})


def deleted(spark: SparkSession, directory: str) -> DataFrame:
    name = _created(spark, directory)
    done = partitioned.delete_from(spark, name, changes.gone(spark, directory))
    return partitioned.rows(spark, name).withColumn("deleted", F.lit(done.deleted))


def updated(spark: SparkSession, directory: str) -> DataFrame:
    name = _created(spark, directory)
    done = partitioned.update_into(spark, name, changes.patches(spark, directory), "n")
    found = partitioned.rows(spark, name).withColumn("o_totalprice", round_to("o_totalprice", 2))
    return found.withColumn("updated", F.lit(done.updated))


def ids_in_partitions(spark: SparkSession, directory: str) -> DataFrame:
    return partitioned.rows_with_ids(spark, _created(spark, directory), [1, 2, 3, 32, 33, "34", 999_999_999, None])


def ids_in_buckets(spark: SparkSession, directory: str) -> DataFrame:
    """Orders by key from a published version that is dealt into buckets."""
    name = f"{scratch_database(spark)}.orders"
    version = versions.write_version(table(spark, directory, "orders"), name, "o_orderkey", 16)
    versions.publish(spark, name, [version])
    orders = spark.table(name)
    return with_ids(orders, fields(orders)["o_orderkey"], [1, 2, 3, 32, 33, "34", 999_999_999, None])


WANTED = "SELECT * FROM orders WHERE o_orderkey IN (1, 2, 3, 32, 33, 34)"

QUERIES = {
    "DML1_upsert_partitioned": (
        upserted,
        changes.BATCH
        + f""", counts AS (SELECT count(*) FILTER (WHERE o_orderkey NOT IN (SELECT o_orderkey FROM orders)) AS created,
  count(*) FILTER (WHERE o_orderkey IN (SELECT o_orderkey FROM orders)) AS updated FROM batch)
SELECT {changes.LISTED}, created, updated FROM batch, counts
UNION ALL SELECT {changes.LISTED}, created, updated FROM orders, counts WHERE o_orderkey NOT IN (SELECT o_orderkey FROM batch)""",
    ),
    "DML2_delete_partitioned": (
        deleted,
        f"SELECT {changes.LISTED}, (SELECT count(*) FROM orders WHERE o_totalprice > 300000) AS deleted"
        " FROM orders WHERE o_totalprice <= 300000",
    ),
    "DML5_update_partitioned": (
        updated,
        "SELECT *, (SELECT count(*) FROM orders WHERE o_orderstatus = 'O') AS updated FROM ("
        + changes.QUERIES["DML5_update_batch"][1]
        + ")",
    ),
    "RD2_ids_partitioned": (ids_in_partitions, WANTED),
    "RD2_ids_bucketed": (ids_in_buckets, WANTED),
}
