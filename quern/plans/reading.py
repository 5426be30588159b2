"""Reads by key, lists, pages, keyset batches, collapse and sorting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import predicates as P
from quern.functions.fields import fields
from quern.operators import reads as R
from quern.operators.sorting import asc, desc
from quern.plans.filters import NULLABLE_ORDERS, ORDER_COLUMNS, nullable_orders
from quern.plans.tables import table

COLUMNS = ", ".join(ORDER_COLUMNS)


def scan(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "orders")


def by_id(spark: SparkSession, directory: str) -> DataFrame:
    orders = nullable_orders(spark, directory)
    row = R.select_by_id(orders, fields(orders)["o_orderkey"], 42)
    return spark.createDataFrame([row] if row else [], orders.schema).select(*ORDER_COLUMNS)


def by_ids(spark: SparkSession, directory: str) -> DataFrame:
    """Orders of the customers of one segment: the ids are a table of their own."""
    orders, customer = nullable_orders(spark, directory), table(spark, directory, "customer")
    ids = customer.filter(P.eq(fields(customer)["c_mktsegment"], "BUILDING")).select("c_custkey")
    return R.with_ids(orders, fields(orders)["o_custkey"], ids).select(*ORDER_COLUMNS)


def count(spark: SparkSession, directory: str) -> DataFrame:
    orders = nullable_orders(spark, directory)
    some = P.gt(fields(orders)["o_totalprice"], 250000.0)
    counts = (R.select_count(orders), R.select_count(orders, some))
    return spark.createDataFrame([counts], "every bigint, expensive bigint")


def top(spark: SparkSession, directory: str) -> DataFrame:
    orders = nullable_orders(spark, directory)
    f = fields(orders)
    found = R.select_list(
        orders, P.eq(f["o_orderstatus"], "O"), [desc(f["o_totalprice"])], limit=500, key=f["o_orderkey"]
    )
    return found.select(*ORDER_COLUMNS)


def uncapped(spark: SparkSession, directory: str) -> DataFrame:
    orders = nullable_orders(spark, directory)
    f = fields(orders)
    return R.search(orders, P.ne(f["o_orderstatus"], "O"), [asc(f["o_orderdate"])], key=f["o_orderkey"]).select(
        *ORDER_COLUMNS
    )


def one(spark: SparkSession, directory: str) -> DataFrame:
    """The order with the highest price (found by a first job), which must be one."""
    orders = nullable_orders(spark, directory)
    highest = orders.agg(F.max("o_totalprice")).first()[0]
    row = R.select_one(orders, P.eq(fields(orders)["o_totalprice"], highest))
    return spark.createDataFrame([row], orders.schema).select(*ORDER_COLUMNS)


def page(spark: SparkSession, directory: str) -> DataFrame:
    orders = nullable_orders(spark, directory)
    f = fields(orders)
    found = R.select_page(
        orders, 3, 200, P.eq(f["o_priority"], "2-HIGH"), [asc(f["o_totalprice"])], key=f["o_orderkey"]
    )
    return found.rows.select(*ORDER_COLUMNS, F.lit(found.total).cast("bigint").alias("total"))


def batch(spark: SparkSession, directory: str) -> DataFrame:
    """The second batch of 300, over a sort key with missing values."""
    orders = nullable_orders(spark, directory)
    f = fields(orders)
    order = [desc(f["o_priority"]), asc(f["o_totalprice"])]
    first = R.select_after(orders, 300, sort=order, key=f["o_orderkey"], with_total=False)
    second = R.select_after(orders, 300, first.next, sort=order, key=f["o_orderkey"])
    return second.rows.select(*ORDER_COLUMNS, F.lit(second.total).cast("bigint").alias("total"))


def rest(spark: SparkSession, directory: str) -> DataFrame:
    """Everything behind a cursor, rows without a priority included."""
    orders = nullable_orders(spark, directory)
    f = fields(orders)
    order = [asc(f["o_priority"]), desc(f["o_totalprice"]), asc(f["o_orderkey"])]
    return orders.filter(R.after(orders, order, ("3-MEDIUM", "250000.0", "0"))).select(*ORDER_COLUMNS)


def after_timestamp(spark: SparkSession, directory: str) -> DataFrame:
    """The third batch of 400 events in time, as instants, which cursors hold as epoch microseconds."""
    events = table(spark, directory, "events").withColumn("at", F.col("ts").cast("timestamp"))
    f = fields(events)
    cursor = None
    for _ in range(2):
        cursor = R.select_after(events, 400, cursor, sort=[desc(f["at"])], key=f["event_id"], with_total=False).next
    found = R.select_after(events, 400, cursor, sort=[desc(f["at"])], key=f["event_id"], with_total=False)
    return found.rows.select("event_id", F.unix_micros("at").alias("micros"))


def collapsed(spark: SparkSession, directory: str) -> DataFrame:
    """The dearest order per customer."""
    orders = nullable_orders(spark, directory)
    f = fields(orders)
    found = R.search(orders, None, [desc(f["o_totalprice"])], collapse=f["o_custkey"], key=f["o_orderkey"])
    return found.select("o_custkey", *ORDER_COLUMNS)


def collapsed_nulls(spark: SparkSession, directory: str) -> DataFrame:
    """Missing values collapse into one row."""
    orders = nullable_orders(spark, directory)
    f = fields(orders)
    found = R.search(orders, None, [asc(f["o_totalprice"])], collapse=f["o_priority"], key=f["o_orderkey"])
    return found.select(*ORDER_COLUMNS)


def sorted_top(spark: SparkSession, directory: str) -> DataFrame:
    """Two sort keys; missing priorities come last although the direction is descending."""
    orders = nullable_orders(spark, directory)
    f = fields(orders)
    order = [desc(f["o_priority"]), asc(f["o_orderdate"])]
    return R.search(orders, None, order, limit=1000, key=f["o_orderkey"]).select(*ORDER_COLUMNS)


QUERIES = {
    "SRC1_scan": (
        scan,
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders",
    ),
    "RD1_select_by_id": (by_id, f"SELECT {COLUMNS} FROM {NULLABLE_ORDERS} WHERE o_orderkey = 42"),
    "RD2_select_batch_ids": (
        by_ids,
        f"SELECT {COLUMNS} FROM {NULLABLE_ORDERS}"
        " WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')",
    ),
    "RD3_select_count": (
        count,
        "SELECT count(*) AS every, count(*) FILTER (WHERE o_totalprice > 250000) AS expensive FROM orders",
    ),
    "RD4_select_list": (
        top,
        f"SELECT {COLUMNS} FROM {NULLABLE_ORDERS} WHERE o_orderstatus = 'O'"
        " ORDER BY o_totalprice DESC, o_orderkey LIMIT 500",
    ),
    "RD4_search_uncapped": (
        uncapped,
        f"SELECT {COLUMNS} FROM {NULLABLE_ORDERS} WHERE o_orderstatus <> 'O'",
    ),
    "RD5_select_one": (
        one,
        f"SELECT {COLUMNS} FROM {NULLABLE_ORDERS} WHERE o_totalprice = (SELECT max(o_totalprice) FROM orders)",
    ),
    "RD6_select_page": (
        page,
        f"SELECT {COLUMNS}, (SELECT count(*) FROM {NULLABLE_ORDERS} WHERE o_priority = '2-HIGH') AS total"
        f" FROM {NULLABLE_ORDERS} WHERE o_priority = '2-HIGH' ORDER BY o_totalprice, o_orderkey LIMIT 200 OFFSET 400",
    ),
    "RD7_select_after": (
        batch,
        f"SELECT {COLUMNS}, (SELECT count(*) FROM orders) AS total FROM {NULLABLE_ORDERS}"
        " ORDER BY o_priority DESC NULLS LAST, o_totalprice, o_orderkey LIMIT 300 OFFSET 300",
    ),
    "RD7_after_cursor": (
        rest,
        f"SELECT {COLUMNS} FROM {NULLABLE_ORDERS} WHERE o_priority > '3-MEDIUM' OR o_priority IS NULL"
        " OR (o_priority = '3-MEDIUM' AND (o_totalprice < 250000 OR (o_totalprice = 250000 AND o_orderkey > 0)))",
    ),
    "RD7_after_timestamp": (
        after_timestamp,
        "SELECT event_id, epoch_us(ts) AS micros FROM events ORDER BY ts DESC, event_id LIMIT 400 OFFSET 800",
    ),
    "RD9_collapse": (
        collapsed,
        f"SELECT o_custkey, {COLUMNS} FROM (SELECT *, row_number() OVER"
        f" (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS n FROM {NULLABLE_ORDERS}) WHERE n = 1",
    ),
    "RD9_collapse_missing": (
        collapsed_nulls,
        f"SELECT {COLUMNS} FROM (SELECT *, row_number() OVER"
        f" (PARTITION BY o_priority ORDER BY o_totalprice, o_orderkey) AS n FROM {NULLABLE_ORDERS}) WHERE n = 1",
    ),
    "SRT1_RD8_order_by_limit": (
        sorted_top,
        f"SELECT {COLUMNS} FROM {NULLABLE_ORDERS}"
        " ORDER BY o_priority DESC NULLS LAST, o_orderdate, o_orderkey LIMIT 1000",
    ),
}
