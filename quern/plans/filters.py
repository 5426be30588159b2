"""Predicates over orders, parts and line items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import predicates as P
from quern.functions.fields import fields
from quern.plans.tables import table

ORDER_COLUMNS = ["o_orderkey", "o_orderstatus", "o_totalprice", "o_priority"]
# o_orderpriority with one of its values taken as missing.
NULLABLE_ORDERS = "(SELECT *, nullif(o_orderpriority, '5-LOW') AS o_priority FROM orders)"
SELECT_ORDERS = f"SELECT o_orderkey, o_orderstatus, o_totalprice, o_priority FROM {NULLABLE_ORDERS} WHERE "


def nullable_orders(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "orders").withColumn("o_priority", F.nullif("o_orderpriority", F.lit("5-LOW")))


def _orders(condition):
    """Query: orders that meet ``condition(fields)``."""

    def query(spark: SparkSession, directory: str) -> DataFrame:
        orders = nullable_orders(spark, directory)
        return P.where(orders, condition(fields(orders))).select(*ORDER_COLUMNS)

    return query


def _parts(condition):
    def query(spark: SparkSession, directory: str) -> DataFrame:
        part = table(spark, directory, "part")
        return P.where(part, condition(fields(part))).select("p_partkey", "p_name", "p_brand")

    return query


def _script(spark: SparkSession, directory: str) -> DataFrame:
    lines = table(spark, directory, "lineitem")
    kept = P.script(
        lines, "l_extendedprice * (1 - l_discount) > :least AND l_returnflag = :flag", {"least": 50000.0, "flag": "R"}
    )
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_discount")


def _script_in_or(spark: SparkSession, directory: str) -> DataFrame:
    lines = P.with_script(table(spark, directory, "lineitem"), "heavy", "l_quantity * l_tax > :least", {"least": 3.5})
    f = fields(lines)
    kept = lines.filter(P.eq(f["l_returnflag"], "A") & (P.eq(f["heavy"], True) | P.ge(f["l_discount"], 0.1)))
    return kept.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_tax", "l_discount")


PART = "SELECT p_partkey, p_name, p_brand FROM part WHERE "

QUERIES = {
    "P1_eq": (
        _orders(lambda f: P.eq(f["o_orderstatus"], "F")),
        SELECT_ORDERS + "o_orderstatus = 'F'",
    ),
    "P2_ne": (
        _orders(lambda f: P.ne(f["o_priority"], "1-URGENT")),
        SELECT_ORDERS + "o_priority IS DISTINCT FROM '1-URGENT'",
    ),
    "P3_in": (
        _orders(lambda f: P.is_in(f["o_priority"], ["1-URGENT", "3-MEDIUM"])),
        SELECT_ORDERS + "o_priority IN ('1-URGENT', '3-MEDIUM')",
    ),
    "P4_compare": (
        _orders(
            lambda f: P.any_of(
                P.all_of(P.gt(f["o_totalprice"], 400000.0), P.ge(f["o_orderkey"], 100)),
                P.all_of(P.lt(f["o_totalprice"], 5000.0), P.le(f["o_custkey"], 1000000)),
            )
        ),
        SELECT_ORDERS + "(o_totalprice > 400000 AND o_orderkey >= 100) OR (o_totalprice < 5000 AND o_custkey <= 1000000)",
    ),
    "P5_between": (
        _orders(lambda f: P.between(f["o_totalprice"], 100000.0, 200000.0)),
        SELECT_ORDERS + "o_totalprice BETWEEN 100000 AND 200000",
    ),
    "P6_like": (_parts(lambda f: P.like(f["p_name"], "red")), PART + "contains(p_name, 'red')"),
    "P6_like_wildcards": (
        _parts(lambda f: P.like(f["p_name"], "e? *l")),
        PART + "p_name LIKE '%e_ %l%'",
    ),
    "P7_prefix": (_parts(lambda f: P.prefix(f["p_name"], "hot ")), PART + "starts_with(p_name, 'hot ')"),
    # No part's name needs a swap with an edit between its letters, where the two distances would differ.
    "P8_fuzzy_auto": (
        _parts(lambda f: P.fuzzy(f["p_name"], "rde bolt")),
        PART + "damerau_levenshtein(p_name, 'rde bolt') <= 2",
    ),
    "P8_fuzzy_one_edit": (
        _parts(lambda f: P.fuzzy(f["p_name"], "red bolts", 1)),
        PART + "damerau_levenshtein(p_name, 'red bolts') <= 1",
    ),
    "P9_is_null": (_orders(lambda f: P.is_null(f["o_priority"])), SELECT_ORDERS + "o_priority IS NULL"),
    "P13_script": (
        _script,
        "SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice, l_discount FROM lineitem"
        " WHERE l_extendedprice * (1 - l_discount) > 50000 AND l_returnflag = 'R'",
    ),
    "P13_script_in_or": (
        _script_in_or,
        "SELECT l_orderkey, l_linenumber, l_partkey, l_quantity, l_tax, l_discount FROM lineitem"
        " WHERE l_returnflag = 'A' AND (l_quantity * l_tax > 3.5 OR l_discount >= 0.1)",
    ),
    # "and" binds tighter than "or".
    "P14_or_and": (
        _orders(
            lambda f: P.eq(f["o_orderstatus"], "P")
            | P.le(f["o_totalprice"], 20000.0) & P.eq(f["o_priority"], "2-HIGH")
        ),
        SELECT_ORDERS + "o_orderstatus = 'P' OR (o_totalprice <= 20000 AND o_priority = '2-HIGH')",
    ),
    "P14_groups": (
        _orders(
            lambda f: P.all_of(
                P.any_of(P.eq(f["o_orderstatus"], "P"), P.le(f["o_totalprice"], 20000.0)),
                P.any_of(P.eq(f["o_priority"], "2-HIGH"), P.is_null(f["o_priority"])),
            )
        ),
        SELECT_ORDERS
        + "(o_orderstatus = 'P' OR o_totalprice <= 20000) AND (o_priority = '2-HIGH' OR o_priority IS NULL)",
    ),
    "P15_match_all": (_orders(lambda f: P.match_all()), SELECT_ORDERS + "true"),
}
