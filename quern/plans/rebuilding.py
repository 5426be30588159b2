"""Schemas, name mapping and published versions."""

from __future__ import annotations

import datetime
import uuid
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.errors import QueryError
from quern.plans.children import LINES, documents
from quern.plans.tables import table
from quern.sources import schema as S
from quern.sources import versions as V


@dataclass
class Order:
    """Orders as a user would declare them; other names and types than the stored ones."""

    orderKey: S.Long = field(metadata={"key": True, "stored": "o_orderkey"})
    customer: S.Integer = field(metadata={"stored": "o_custkey"})
    price: float = field(metadata={"stored": "o_totalprice"})
    orderDate: datetime.date = field(metadata={"stored": "o_orderdate"})
    priority: str = field(metadata={"stored": "o_orderpriority"})
    comment: str | None = field(metadata={"stored": "o_comment"}, default=None)


@dataclass
class Line:
    number: S.Integer = field(metadata={"stored": "line_no"})
    content: str = field(metadata={"stored": "body"})


@dataclass
class Document:
    id: int = field(metadata={"stored": "doc_id"})
    language: str = field(metadata={"stored": "lang"})
    lines: list[Line] = field(default_factory=list)


def conformed(spark: SparkSession, directory: str) -> DataFrame:
    """Orders cast to a declared schema; a declared column the table lacks is null."""
    orders = table(spark, directory, "orders")
    declared = S.stored_schema(S.derive(Order))
    S.check(orders, declared, policy="warn")
    return S.conform(orders, declared)


def renamed(spark: SparkSession, directory: str) -> DataFrame:
    """Stored names -> declared names, inside the children too."""
    out = S.from_stored(documents(spark, directory), S.derive(Document))
    return out.select("id", "language", F.explode("lines").alias("line")).select(
        "id", "language", F.col("line.number").cast("bigint").alias("number"), "line.content"
    )


def stored(spark: SparkSession, directory: str) -> DataFrame:
    """And back again."""
    declared = S.derive(Document)
    out = S.to_stored(S.from_stored(documents(spark, directory), declared), declared)
    return out.select("doc_id", "lang", F.explode("lines").alias("line")).select(
        "doc_id", "lang", F.col("line.line_no").cast("bigint").alias("line_no"), "line.body"
    )


def drifted(spark: SparkSession, directory: str) -> DataFrame:
    """Dear orders under an older schema: keys as text, no date."""
    orders = table(spark, directory, "orders").filter("o_totalprice > 250000")
    return orders.withColumn("o_orderkey", F.col("o_orderkey").cast("string")).drop("o_orderdate")


def copied_rows(spark: SparkSession, directory: str) -> DataFrame:
    target = table(spark, directory, "orders").filter("o_orderstatus <> 'P'")
    return V.copied(drifted(spark, directory), target, "o_orderkey")[0]


def copied_report(spark: SparkSession, directory: str) -> DataFrame:
    target = table(spark, directory, "orders").filter("o_orderstatus <> 'P'")
    return V.copied(drifted(spark, directory), target, "o_orderkey")[1]


def scratch_database(spark: SparkSession) -> str:
    """A database of its own in the shared folder that the session names, in place of the one made before."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        raise QueryError("set spark.checkpoint.dir to a folder that all executors share")
    for earlier in _MADE:
        spark.sql(f"DROP DATABASE IF EXISTS {earlier} CASCADE")
    _MADE.clear()
    name = f"quern_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared.rstrip('/')}/{name}'")
    _MADE.append(name)
    return name


_MADE: list[str] = []  # by this driver


def mismatched(spark: SparkSession, directory: str) -> DataFrame:
    """Per column that does not conform: what is wrong, and how many rows have a value there."""
    orders = table(spark, directory, "orders")
    problems = S.check(orders, S.stored_schema(S.derive(Order)), policy="warn")
    counted = orders.agg(*[F.count(c).alias(c) for c in orders.columns])
    filled = counted.unpivot([], orders.columns, "column", "filled")
    return problems.join(filled, "column", "left").select(
        "column", "problem", F.coalesce("filled", F.lit(0)).cast("bigint").alias("filled")
    )


def created(spark: SparkSession, directory: str) -> DataFrame:
    """A table created from the declared schema, filled, checked and read back."""
    name = f"{scratch_database(spark)}.declared"
    declared = S.stored_schema(S.derive(Order))
    S.create_if_absent(spark, name, declared)
    S.conform(table(spark, directory, "orders"), declared).write.format("parquet").insertInto(name)
    S.create_if_absent(spark, name, declared, policy="fail")
    return spark.table(name)


def reindexed(spark: SparkSession, directory: str) -> DataFrame:
    """One table copied into another by name: the rows it has afterwards, with the report beside each."""
    place = scratch_database(spark)
    drifted(spark, directory).write.format("parquet").saveAsTable(f"{place}.source")
    table(spark, directory, "orders").filter("o_orderstatus <> 'P'").write.format("parquet").saveAsTable(f"{place}.target")
    report = V.reindex(spark, f"{place}.source", f"{place}.target", "o_orderkey")
    return spark.table(f"{place}.target").select(
        "o_orderkey",
        "o_orderdate",
        F.lit(report.total).cast("bigint").alias("total"),
        F.lit(report.created).cast("bigint").alias("created"),
    )


def rebuilt(spark: SparkSession, directory: str) -> DataFrame:
    """Orders written as a table, then rebuilt twice: first into a view, then from version to version."""
    name = f"{scratch_database(spark)}.orders"
    table(spark, directory, "orders").write.format("parquet").saveAsTable(name)
    declared = S.stored_schema(S.derive(Order))
    V.rebuild(spark, name, declared)
    V.rebuild(spark, name, declared)
    return spark.table(name)


ORDER_SQL = (
    "SELECT o_orderkey, o_custkey::INTEGER AS o_custkey, o_totalprice, o_orderdate::DATE AS o_orderdate, o_orderpriority,"
    " NULL::VARCHAR AS o_comment FROM orders"
)
SOURCE_SQL = "(SELECT * FROM orders WHERE o_totalprice > 250000)"
TARGET_SQL = "(SELECT * FROM orders WHERE o_orderstatus <> 'P')"

QUERIES = {
    "SCH1_SCH2_conform": (conformed, ORDER_SQL),
    "SRC2_read_mapping": (
        renamed,
        LINES + "SELECT doc_id AS id, lang AS language, line_no AS number, body AS content FROM lines",
    ),
    "SNK1_write_mapping": (stored, LINES + "SELECT doc_id, lang, line_no, body FROM lines"),
    "REB1_reindex_rows": (
        copied_rows,
        f"SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, NULL::TIMESTAMP AS o_orderdate, o_orderpriority FROM {SOURCE_SQL}"
        " UNION ALL SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority"
        f" FROM {TARGET_SQL} WHERE o_totalprice <= 250000",
    ),
    "REB1_reindex_report": (
        copied_report,
        "SELECT count(*) AS total, count(*) FILTER (WHERE o_orderstatus = 'P') AS created,"
        " count(*) FILTER (WHERE o_orderstatus <> 'P') AS updated, 0::BIGINT AS conflicts"
        f" FROM {SOURCE_SQL}",
    ),
    "SCH2_mismatches": (
        mismatched,
        "SELECT 'o_custkey' AS column, 'type differs' AS problem, count(o_custkey) AS filled FROM orders"
        " UNION ALL SELECT 'o_orderdate', 'type differs', count(o_orderdate) FROM orders"
        " UNION ALL SELECT 'o_comment', 'missing', 0",
    ),
    "SCH3_create_if_absent": (created, ORDER_SQL),
    "REB1_reindex": (
        reindexed,
        f"WITH report AS (SELECT count(*) AS total, count(*) FILTER (WHERE o_orderstatus = 'P') AS created FROM {SOURCE_SQL})"
        f" SELECT o_orderkey, NULL::TIMESTAMP AS o_orderdate, total, created FROM {SOURCE_SQL}, report"
        f" UNION ALL SELECT o_orderkey, o_orderdate, total, created FROM {TARGET_SQL}, report WHERE o_totalprice <= 250000",
    ),
    "REB2_REB3_REB4_rebuild": (rebuilt, ORDER_SQL),
}
