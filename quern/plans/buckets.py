"""Aggregation trees over orders, line items, parts and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import predicates as P
from quern.functions.fields import fields
from quern.operators import aggregations as A
from quern.plans.filters import NULLABLE_ORDERS, nullable_orders
from quern.plans.tables import round_to, table

STATUS_BY_PRICE = (
    "SELECT o_orderstatus AS status, count(*) AS doc_count, round(avg(o_totalprice), 6) AS avg_price FROM orders"
    " WHERE o_totalprice BETWEEN 50000 AND 300000 GROUP BY 1"
)


def flagship(spark: SparkSession, directory: str) -> DataFrame:
    """Orders in a price range, per status with the average price, dearest status first."""
    orders = table(spark, directory, "orders")
    f = fields(orders)
    tree = A.terms("o_orderstatus", A.avg("o_totalprice", name="avg_price"), name="status", order_by="avg_price")
    found = A.aggregate(orders, P.between(f["o_totalprice"], 50000.0, 300000.0), tree)
    return found.buckets("status").withColumn("avg_price", round_to("avg_price", 6))


def terms(spark: SparkSession, directory: str) -> DataFrame:
    orders = nullable_orders(spark, directory)
    return A.aggregate(orders, None, A.terms("o_priority", name="priority")).buckets("priority")


def terms_boolean(spark: SparkSession, directory: str) -> DataFrame:
    orders = table(spark, directory, "orders").withColumn("dear", F.col("o_totalprice") > 250000)
    return A.aggregate(orders, None, A.terms("dear", name="dear")).buckets("dear")


def terms_size(spark: SparkSession, directory: str) -> DataFrame:
    """The 25 customers with most orders."""
    orders = table(spark, directory, "orders")
    return A.aggregate(orders, None, A.terms("o_custkey", name="customer", size=25)).buckets("customer")


def terms_size_per_parent(spark: SparkSession, directory: str) -> DataFrame:
    """Per status the three customers with most orders."""
    orders = table(spark, directory, "orders")
    tree = A.terms("o_orderstatus", A.terms("o_custkey", name="customer", size=3), name="status", size=2)
    return A.aggregate(orders, None, tree).buckets("status", "customer")


def terms_by_key(spark: SparkSession, directory: str) -> DataFrame:
    part = table(spark, directory, "part")
    tree = A.terms("p_brand", name="brand", size=10, order_by="_key", descending=False)
    return A.aggregate(part, None, tree).buckets("brand")


def metrics(spark: SparkSession, directory: str) -> DataFrame:
    lines = table(spark, directory, "lineitem")
    found = A.aggregate(
        lines,
        P.eq(fields(lines)["l_returnflag"], "R"),
        A.avg("l_extendedprice", name="avg_price"),
        A.max("l_shipdate", name="last_ship"),
        A.min("l_discount", name="min_discount"),
        A.sum("l_quantity", name="sum_quantity"),
    ).metrics()
    return found.withColumns({c: round_to(c, 6) for c in ("avg_price", "sum_quantity")})


def no_rows(spark: SparkSession, directory: str) -> DataFrame:
    """Over no rows a sum is zero, an average missing."""
    lines = table(spark, directory, "lineitem")
    none = P.lt(fields(lines)["l_quantity"], 0.0)
    return A.aggregate(
        lines, none, A.sum("l_quantity", name="sum_quantity"), A.avg("l_tax", name="avg_tax"), A.stats("l_tax", "tax")
    ).metrics()


def stats(spark: SparkSession, directory: str) -> DataFrame:
    lines = table(spark, directory, "lineitem")
    tree = A.terms("l_returnflag", A.stats("l_extendedprice", name="price"), name="flag")
    found = A.aggregate(lines, None, tree).buckets("flag")
    return found.withColumns({"price_avg": round_to("price_avg", 6), "price_sum": round_to("price_sum", 2)})


def cardinality(spark: SparkSession, directory: str) -> DataFrame:
    lines = table(spark, directory, "lineitem")
    tree = A.terms("l_returnflag", A.cardinality("l_partkey", name="parts", exact=True), name="flag")
    return A.aggregate(lines, None, tree).buckets("flag")


def cardinality_all(spark: SparkSession, directory: str) -> DataFrame:
    events = table(spark, directory, "events")
    return A.aggregate(events, None, A.cardinality("user_id", name="users", exact=True)).metrics()


def cardinality_approximate(spark: SparkSession, directory: str) -> DataFrame:
    """The exact count per flag, and whether the approximate one is within ten percent of it."""
    lines = table(spark, directory, "lineitem")
    tree = A.terms(
        "l_returnflag", A.cardinality("l_orderkey", name="about"), A.cardinality("l_orderkey", "exact", True), name="flag"
    )
    found = A.aggregate(lines, None, tree).buckets("flag")
    return found.select("flag", "exact", (F.abs(F.col("about") - F.col("exact")) <= 0.1 * F.col("exact")).alias("close"))


def histogram(unit: str, years: tuple[int, ...] = ()):
    """All orders, or those of some years, which leaves gaps to fill."""

    def query(spark: SparkSession, directory: str) -> DataFrame:
        orders = table(spark, directory, "orders")
        of_years = P.any_of(*[F.year("o_orderdate") == y for y in years]) if years else None
        tree = A.date_histogram("o_orderdate", unit, A.sum("o_totalprice", name="total"), name="start")
        return A.aggregate(orders, of_years, tree).buckets("start").withColumn("total", round_to("total", 2))

    return query


def histogram_sql(unit: str, years: tuple[int, ...] = ()) -> str:
    step = "3 months" if unit == "quarter" else f"1 {unit}"
    where = f" WHERE year(o_orderdate) IN ({', '.join(map(str, years))})" if years else ""
    return f"""
WITH rows AS (SELECT date_trunc('{unit}', o_orderdate)::TIMESTAMP AS b, o_totalprice FROM orders{where}),
span AS (SELECT min(b) AS lo, max(b) AS hi FROM rows),
every AS (SELECT unnest(generate_series(lo, hi, INTERVAL '{step}')) AS b FROM span)
SELECT epoch_ms(every.b) AS start, count(rows.b) AS doc_count, round(coalesce(sum(o_totalprice), 0), 2) AS total
FROM every LEFT JOIN rows ON rows.b = every.b GROUP BY every.b"""


def long_histogram(name: str, column: str, unit: str):
    """Millions of buckets with gaps filled, told by what they add up to."""

    def query(spark: SparkSession, directory: str) -> DataFrame:
        found = A.aggregate(table(spark, directory, name), None, A.date_histogram(column, unit, name="start")).buckets("start")
        return found.agg(
            F.count("*").alias("buckets"),
            F.count_if(F.col("doc_count") == 0).alias("empty"),
            F.sum("doc_count").alias("rows"),
            F.min("start").alias("first"),
            F.max("start").alias("last"),
            F.sum(F.col("start") % 1_000_003).alias("starts"),
        )

    return query


def long_histogram_sql(name: str, column: str, unit: str) -> str:
    return f"""
WITH counted AS (SELECT date_trunc('{unit}', {column})::TIMESTAMP AS b, count(*) AS n FROM {name} GROUP BY 1),
every AS (SELECT unnest(generate_series(min(b), max(b), INTERVAL '1 {unit}')) AS b FROM counted)
SELECT count(*) AS buckets, count(*) FILTER (n IS NULL) AS empty, CAST(sum(n) AS BIGINT) AS rows,
  epoch_ms(min(every.b)) AS first, epoch_ms(max(every.b)) AS last, CAST(sum(epoch_ms(every.b) % 1000003) AS BIGINT) AS starts
FROM every LEFT JOIN counted ON counted.b = every.b"""


def stats_dates(spark: SparkSession, directory: str) -> DataFrame:
    """Epoch milliseconds of order dates, per priority."""
    orders = table(spark, directory, "orders")
    tree = A.terms("o_orderpriority", A.stats("o_orderdate", name="at"), name="priority")
    found = A.aggregate(orders, None, tree).buckets("priority")
    return found.withColumns({"at_avg": round_to("at_avg", 2)})


def top_hits_many(spark: SparkSession, directory: str) -> DataFrame:
    """The 1500 dearest orders of each status."""
    orders = table(spark, directory, "orders")
    tree = A.terms("o_orderstatus", A.top_hits(1500, "o_totalprice", name="dearest"), name="status")
    found = A.aggregate(orders, None, tree, key="o_orderkey").hits("status", "dearest")
    return found.select("status", F.col("hit_rank").cast("bigint").alias("hit_rank"), "hit.o_orderkey", "hit.o_totalprice")


def histogram_per_parent(spark: SparkSession, directory: str) -> DataFrame:
    """Hours per event type; each type's gaps are filled within its own span."""
    events = table(spark, directory, "events")
    tree = A.terms("event_type", A.date_histogram("ts", "hour", A.avg("value"), name="hour"), name="type")
    found = A.aggregate(events, P.ge(fields(events)["value"], 30.0), tree).buckets("type", "hour")
    return found.withColumn("value", round_to("value", 9))


def histogram_min_count(spark: SparkSession, directory: str) -> DataFrame:
    events = table(spark, directory, "events")
    tree = A.date_histogram("ts", "hour", name="hour", format="yyyy-MM-dd HH:mm", min_doc_count=12)
    return A.aggregate(events, None, tree).buckets("hour")


def histogram_minute(spark: SparkSession, directory: str) -> DataFrame:
    events = table(spark, directory, "events")
    tree = A.date_histogram("ts", "minute", A.cardinality("user_id", name="users", exact=True), min_doc_count=1)
    return A.aggregate(events, None, tree).buckets("ts")


PRICE_RANGES = [A.Range(None, 950.0), A.Range(940.0, 1000.0, "middle"), A.Range(1000.0, 1050.0), A.Range(9999.0, None)]


def ranges(spark: SparkSession, directory: str) -> DataFrame:
    """Overlapping, open and empty ranges."""
    part = table(spark, directory, "part")
    tree = A.ranges("p_retailprice", PRICE_RANGES, A.avg("p_size", name="avg_size"), name="price")
    return A.aggregate(part, None, tree).buckets("price").withColumn("avg_size", round_to("avg_size", 6))


def terms_in_ranges(spark: SparkSession, directory: str) -> DataFrame:
    part = table(spark, directory, "part")
    tree = A.ranges("p_retailprice", PRICE_RANGES, A.terms("p_type", name="type", size=2), name="price")
    return A.aggregate(part, None, tree).buckets("price", "type")


def top_hits(spark: SparkSession, directory: str) -> DataFrame:
    orders = table(spark, directory, "orders")
    found = A.aggregate(orders, None, A.top_hits(40, "o_totalprice", ascending=True), key="o_orderkey")
    return found.hits("top_hits").select("hit.*")


def top_hits_per_bucket(spark: SparkSession, directory: str) -> DataFrame:
    """The three latest orders of each of the 50 customers with most orders."""
    orders = table(spark, directory, "orders")
    tree = A.terms("o_custkey", A.top_hits(3, "o_orderdate", name="latest"), name="customer", size=50)
    found = A.aggregate(orders, None, tree, key="o_orderkey").hits("customer", "latest")
    return found.select("customer", F.col("hit_rank").cast("bigint").alias("hit_rank"), "hit.o_orderkey", "hit.o_orderdate")


def drill_down(spark: SparkSession, directory: str) -> DataFrame:
    """Three levels: status, year, priority."""
    orders = table(spark, directory, "orders")
    tree = A.terms(
        "o_orderstatus",
        A.date_histogram(
            "o_orderdate",
            "year",
            A.terms("o_orderpriority", A.avg("o_totalprice", name="avg_price"), name="priority", order_by="avg_price", size=2),
            name="year",
        ),
        name="status",
    )
    found = A.aggregate(orders, None, tree).buckets("status", "year", "priority")
    return found.withColumn("avg_price", round_to("avg_price", 6))


def drill_down_parents(spark: SparkSession, directory: str) -> DataFrame:
    """Metrics of the parent level of a tree, in any order."""
    lines = table(spark, directory, "lineitem")
    tree = A.terms(
        "l_suppkey",
        A.avg("l_extendedprice", name="avg_price"),
        A.max("l_quantity", name="max_quantity"),
        A.terms("l_returnflag", name="flag"),
        name="supplier",
        size=20,
        order_by="avg_price",
        descending=False,
    )
    found = A.aggregate(lines, None, tree).buckets("supplier", "flag")
    return found


def cut_first(spark: SparkSession, directory: str) -> DataFrame:
    """Days of the five customers with most orders, whose rows are read again."""
    orders = table(spark, directory, "orders")
    days = A.date_histogram("o_orderdate", "day", A.sum("o_totalprice", name="total"), name="day", min_doc_count=1)
    tree = A.terms("o_custkey", days, name="customer", size=5, cut_first=True)
    found = A.aggregate(orders, None, tree).buckets("customer", "day")
    return found.withColumn("total", round_to("total", 2))


def cardinality_in_tree(spark: SparkSession, directory: str) -> DataFrame:
    """Decimal means and sums, and whether approximate counts are within five percent, on both levels of a tree."""
    lines = table(spark, directory, "lineitem").withColumn("price", F.col("l_extendedprice").cast("decimal(12,2)"))
    metrics = [A.cardinality("l_partkey", "parts"), A.avg("price", "mean"), A.sum("price", "total"), A.stats("price", "p")]
    tree = A.terms("l_returnflag", *metrics, A.terms("l_linestatus", *metrics, name="status"), name="flag")
    found = A.aggregate(lines, None, tree)
    upper = found.buckets("flag").withColumn("status", F.lit(None).cast("string"))
    both = upper.unionByName(found.buckets("flag", "status"))
    exact = lines.select("l_returnflag", "l_linestatus", "l_partkey").distinct()
    exact = exact.groupBy(F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status")).agg(F.count("*").alias("n"))
    joined = both.join(exact, ["flag", "status"], "left")
    close = F.coalesce(F.abs(F.col("parts") - F.col("n")) <= 0.05 * F.col("n"), F.lit(True))
    return joined.select(
        "flag", "status", "doc_count", close.alias("close"), *[F.col(c).cast("double").alias(c) for c in ("mean", "total", "p_min", "p_max", "p_avg")]
    )


def branches(spark: SparkSession, directory: str) -> DataFrame:
    """Three buckets side by side below one, with all buckets of the tree in one table."""
    orders = table(spark, directory, "orders")
    tree = A.terms(
        "o_orderstatus",
        A.max("o_totalprice", name="dearest"),
        A.terms("o_orderpriority", A.avg("o_totalprice", name="mean"), name="priority", size=3),
        A.date_histogram("o_orderdate", "year", A.cardinality("o_orderpriority", name="priorities"), name="year"),
        A.ranges("o_totalprice", ORDER_RANGES, A.sum("o_totalprice", name="total"), name="price"),
        name="status",
    )
    every = A.aggregate(orders, None, tree).all_buckets()
    value = F.map_values("metrics")[0]
    return every.select("path", F.array_join("keys", "|").alias("keys"), "doc_count", F.round(value, 2).alias("value"))


ORDER_RANGES = [A.Range(None, 100000.0, "low"), A.Range(50000.0, 200000.0, "middle"), A.Range(1e9, None, "none")]


def ranges_in_chain(spark: SparkSession, directory: str) -> DataFrame:
    """Terms above overlapping ranges above terms, with all buckets in one table."""
    part = table(spark, directory, "part")
    tree = A.terms(
        "p_type",
        A.ranges(
            "p_retailprice", PRICE_RANGES, A.avg("p_size", name="size"), A.terms("p_brand", A.max("p_size", "most"), name="brand", size=2), name="price"
        ),
        name="type",
        size=4,
    )
    every = A.aggregate(part, None, tree).all_buckets()
    value = F.when(F.size("metrics") > 0, F.map_values("metrics")[0])
    return every.select("path", F.array_join("keys", "|").alias("keys"), "doc_count", F.round(value, 6).alias("value"))


PRICE_CASES = """
(SELECT '*-950.0' AS price, 0 AS lo, 950 AS hi UNION ALL SELECT 'middle', 940, 1000
 UNION ALL SELECT '1000.0-1050.0', 1000, 1050 UNION ALL SELECT '9999.0-*', 9999, 1e18) r
"""

QUERIES = {
    "AGG1_AGG4_AGG3_status_by_price": (flagship, STATUS_BY_PRICE),
    "AGG1_terms": (
        terms,
        f"SELECT o_priority AS priority, count(*) AS doc_count FROM {NULLABLE_ORDERS} WHERE o_priority IS NOT NULL GROUP BY 1",
    ),
    "AGG1_terms_boolean": (
        terms_boolean,
        "SELECT (o_totalprice > 250000)::BIGINT AS dear, count(*) AS doc_count FROM orders GROUP BY 1",
    ),
    "AGG2_terms_size": (
        terms_size,
        "SELECT o_custkey AS customer, count(*) AS doc_count FROM orders GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 25",
    ),
    "AGG2_terms_size_per_parent": (
        terms_size_per_parent,
        """
WITH top AS (SELECT o_orderstatus FROM orders GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 2),
n AS (SELECT o_orderstatus AS status, o_custkey AS customer, count(*) AS doc_count FROM orders
      WHERE o_orderstatus IN (SELECT o_orderstatus FROM top) GROUP BY 1, 2)
SELECT status, customer, doc_count FROM
(SELECT *, row_number() OVER (PARTITION BY status ORDER BY doc_count DESC, customer) AS r FROM n) WHERE r <= 3""",
    ),
    "AGG3_terms_by_key": (
        terms_by_key,
        "SELECT p_brand AS brand, count(*) AS doc_count FROM part GROUP BY 1 ORDER BY 1 LIMIT 10",
    ),
    "AGG4_AGG7_metrics": (
        metrics,
        "SELECT round(avg(l_extendedprice), 6) AS avg_price, max(l_shipdate) AS last_ship, min(l_discount) AS min_discount,"
        " round(sum(l_quantity), 6) AS sum_quantity FROM lineitem WHERE l_returnflag = 'R'",
    ),
    "AGG7_no_rows": (
        no_rows,
        "SELECT coalesce(sum(l_quantity), 0) AS sum_quantity, avg(l_tax) AS avg_tax, count(l_tax) AS tax_count,"
        " min(l_tax) AS tax_min, max(l_tax) AS tax_max, avg(l_tax) AS tax_avg, coalesce(sum(l_tax), 0) AS tax_sum"
        " FROM lineitem WHERE l_quantity < 0",
    ),
    "AGG8_stats": (
        stats,
        "SELECT l_returnflag AS flag, count(*) AS doc_count, count(l_extendedprice) AS price_count,"
        " min(l_extendedprice) AS price_min, max(l_extendedprice) AS price_max,"
        " round(avg(l_extendedprice), 6) AS price_avg, round(sum(l_extendedprice), 2) AS price_sum FROM lineitem GROUP BY 1",
    ),
    "AGG9_cardinality": (
        cardinality,
        "SELECT l_returnflag AS flag, count(*) AS doc_count, count(DISTINCT l_partkey) AS parts FROM lineitem GROUP BY 1",
    ),
    "AGG9_cardinality_all": (cardinality_all, "SELECT count(DISTINCT user_id) AS users FROM events"),
    "AGG9_cardinality_approximate": (
        cardinality_approximate,
        "SELECT l_returnflag AS flag, count(DISTINCT l_orderkey) AS exact, true AS close FROM lineitem GROUP BY 1",
    ),
    **{
        f"AGG10_date_histogram_{unit}": (histogram(unit), histogram_sql(unit))
        for unit in ("day", "week", "month", "quarter", "year")
    },
    "AGG10_date_histogram_gaps": (histogram("month", (1995, 1998, 2001)), histogram_sql("month", (1995, 1998, 2001))),
    "AGG10_date_histogram_second": (long_histogram("events", "ts", "second"), long_histogram_sql("events", "ts", "second")),
    "AGG10_date_histogram_minute": (
        long_histogram("orders", "o_orderdate", "minute"),
        long_histogram_sql("orders", "o_orderdate", "minute"),
    ),
    "AGG8_stats_dates": (
        stats_dates,
        "SELECT o_orderpriority AS priority, count(*) AS doc_count, count(o_orderdate) AS at_count,"
        " min(epoch_ms(o_orderdate))::DOUBLE AS at_min, max(epoch_ms(o_orderdate))::DOUBLE AS at_max,"
        " round(avg(epoch_ms(o_orderdate)), 2) AS at_avg, sum(epoch_ms(o_orderdate))::DOUBLE AS at_sum"
        " FROM orders GROUP BY 1",
    ),
    "AGG14_top_hits_many": (
        top_hits_many,
        "SELECT status, r AS hit_rank, o_orderkey, o_totalprice FROM (SELECT o_orderstatus AS status, o_orderkey, o_totalprice,"
        " row_number() OVER (PARTITION BY o_orderstatus ORDER BY o_totalprice DESC, o_orderkey) AS r FROM orders) WHERE r <= 1500",
    ),
    "AGG10_date_histogram_per_parent": (
        histogram_per_parent,
        """
WITH rows AS (SELECT event_type, date_trunc('hour', ts)::TIMESTAMP AS b, value FROM events WHERE value >= 30),
every AS (SELECT event_type, unnest(generate_series(min(b), max(b), INTERVAL '1 hour')) AS b FROM rows GROUP BY event_type)
SELECT every.event_type AS type, epoch_ms(every.b) AS hour, count(rows.b) AS doc_count, round(avg(value), 9) AS value
FROM every LEFT JOIN rows ON rows.b = every.b AND rows.event_type = every.event_type GROUP BY every.event_type, every.b""",
    ),
    "AGG11_AGG12_format_min_doc_count": (
        histogram_min_count,
        "SELECT epoch_ms(date_trunc('hour', ts)::TIMESTAMP) AS hour, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M') AS hour_text,"
        " count(*) AS doc_count FROM events GROUP BY 1, 2 HAVING count(*) >= 12",
    ),
    "AGG12_date_histogram_minute": (
        histogram_minute,
        "SELECT epoch_ms(date_trunc('minute', ts)::TIMESTAMP) AS ts, count(*) AS doc_count, count(DISTINCT user_id) AS users"
        " FROM events GROUP BY 1",
    ),
    "AGG13_ranges": (
        ranges,
        f"SELECT r.price, count(p_partkey) AS doc_count, round(avg(p_size), 6) AS avg_size FROM {PRICE_CASES}"
        " LEFT JOIN part ON p_retailprice >= r.lo AND p_retailprice < r.hi GROUP BY 1",
    ),
    "AGG13_AGG16_terms_in_ranges": (
        terms_in_ranges,
        f"""
WITH n AS (SELECT r.price, p_type AS type, count(*) AS doc_count FROM {PRICE_CASES}
           JOIN part ON p_retailprice >= r.lo AND p_retailprice < r.hi GROUP BY 1, 2)
SELECT price, type, doc_count FROM
(SELECT *, row_number() OVER (PARTITION BY price ORDER BY doc_count DESC, type) AS k FROM n) WHERE k <= 2""",
    ),
    "AGG2_cut_first": (
        cut_first,
        """
WITH top AS (SELECT o_custkey FROM orders GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 5)
SELECT o_custkey AS customer, epoch_ms(date_trunc('day', o_orderdate)::TIMESTAMP) AS day, count(*) AS doc_count,
  round(sum(o_totalprice), 2) AS total FROM orders WHERE o_custkey IN (SELECT o_custkey FROM top) GROUP BY 1, 2""",
    ),
    "AGG9_cardinality_in_tree": (
        cardinality_in_tree,
        """
WITH l AS (SELECT l_returnflag AS flag, l_linestatus AS status, CAST(l_extendedprice AS DECIMAL(12, 2)) AS price FROM lineitem),
g AS (SELECT flag, status, count(*) AS doc_count, sum(price) AS s, min(price) AS lo, max(price) AS hi
  FROM l GROUP BY GROUPING SETS ((flag), (flag, status)))
SELECT flag, status, doc_count, true AS close, round(s::DOUBLE / doc_count, 6) AS mean, s::DOUBLE AS total, lo::DOUBLE AS p_min,
  hi::DOUBLE AS p_max, round(s::DOUBLE / doc_count, 6) AS p_avg FROM g""",
    ),
    "AGG16_branches": (
        branches,
        """
WITH o AS (SELECT *, epoch_ms(date_trunc('year', o_orderdate)::TIMESTAMP) AS year FROM orders),
p AS (SELECT o_orderstatus AS s, o_orderpriority AS k, count(*) AS n, avg(o_totalprice) AS v FROM o GROUP BY 1, 2
  QUALIFY row_number() OVER (PARTITION BY o_orderstatus ORDER BY count(*) DESC, o_orderpriority) <= 3),
e AS (SELECT o_orderstatus AS s, epoch_ms(unnest(generate_series(min(date_trunc('year', o_orderdate)::TIMESTAMP),
  max(date_trunc('year', o_orderdate)::TIMESTAMP), INTERVAL '1 year'))) AS y FROM o GROUP BY 1),
r AS (SELECT * FROM (VALUES ('low', -1.0, 100000.0), ('middle', 50000.0, 200000.0), ('none', 1e9, 1e18)) r(k, lo, hi))
SELECT 'status' AS path, o_orderstatus AS keys, count(*) AS doc_count, round(max(o_totalprice), 2) AS value FROM o GROUP BY 2
UNION ALL SELECT 'status/priority', s || '|' || k, n, round(v, 2) FROM p
UNION ALL SELECT 'status/year', s || '|' || y, count(o.o_orderkey), count(DISTINCT o_orderpriority)::DOUBLE
  FROM e LEFT JOIN o ON o.o_orderstatus = s AND o.year = y GROUP BY s, y
UNION ALL SELECT 'status/price', x.s || '|' || k, count(o.o_orderkey), round(coalesce(sum(o_totalprice), 0), 2)
  FROM (SELECT DISTINCT o_orderstatus AS s FROM o) x CROSS JOIN r
  LEFT JOIN o ON o.o_orderstatus = x.s AND o_totalprice >= lo AND o_totalprice < hi GROUP BY x.s, k""",
    ),
    "AGG13_ranges_in_chain": (
        ranges_in_chain,
        f"""
WITH top AS (SELECT p_type AS t, count(*) AS n FROM part GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 4),
q AS (SELECT t, price, count(p_partkey) AS n, avg(p_size) AS v FROM (SELECT t, r.* FROM top CROSS JOIN {PRICE_CASES.rstrip().removesuffix(' r')} r) x
  LEFT JOIN part ON p_type = t AND p_retailprice >= lo AND p_retailprice < hi GROUP BY 1, 2),
b AS (SELECT t, r.price, p_brand, count(*) AS n, max(p_size) AS v FROM top JOIN part ON p_type = t
  JOIN {PRICE_CASES} ON p_retailprice >= r.lo AND p_retailprice < r.hi GROUP BY 1, 2, 3
  QUALIFY row_number() OVER (PARTITION BY t, r.price ORDER BY count(*) DESC, p_brand) <= 2)
SELECT 'type' AS path, t AS keys, n AS doc_count, NULL::DOUBLE AS value FROM top
UNION ALL SELECT 'type/price', t || '|' || price, n, round(v, 6) FROM q
UNION ALL SELECT 'type/price/brand', t || '|' || price || '|' || p_brand, n, v::DOUBLE FROM b""",
    ),
    "AGG14_top_hits": (
        top_hits,
        "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority FROM orders"
        " ORDER BY o_totalprice, o_orderkey LIMIT 40",
    ),
    "AGG14_top_hits_per_bucket": (
        top_hits_per_bucket,
        """
WITH top AS (SELECT o_custkey FROM orders GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 50)
SELECT customer, hit_rank, o_orderkey, o_orderdate FROM
(SELECT o_custkey AS customer, o_orderkey, o_orderdate,
        row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS hit_rank
 FROM orders WHERE o_custkey IN (SELECT o_custkey FROM top)) WHERE hit_rank <= 3""",
    ),
    "AGG16_drill_down": (
        drill_down,
        """
WITH n AS (SELECT o_orderstatus AS status, epoch_ms(date_trunc('year', o_orderdate)::TIMESTAMP) AS year, o_orderpriority AS priority,
                  count(*) AS doc_count, avg(o_totalprice) AS a FROM orders GROUP BY 1, 2, 3)
SELECT status, year, priority, doc_count, round(a, 6) AS avg_price FROM
(SELECT *, row_number() OVER (PARTITION BY status, year ORDER BY a DESC, priority) AS r FROM n) WHERE r <= 2""",
    ),
    "AGG16_sub_terms_of_ordered_parents": (
        drill_down_parents,
        """
WITH top AS (SELECT l_suppkey FROM lineitem GROUP BY 1 ORDER BY avg(l_extendedprice), 1 LIMIT 20)
SELECT l_suppkey AS supplier, l_returnflag AS flag, count(*) AS doc_count FROM lineitem
WHERE l_suppkey IN (SELECT l_suppkey FROM top) GROUP BY 1, 2""",
    ),
}
