"""What the physical plans must, and must not, contain."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from quern.functions import predicates as P
from quern.functions.fields import fields
from quern.operators import writes as W
from quern.plans.tables import table
from tests.conftest import TESTDATA

QUERIES = entry.queries()


def plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize(
    "name, pushed",
    [
        ("P1_eq", "EqualTo(o_orderstatus,F)"),
        ("P5_between", "GreaterThanOrEqual(o_totalprice,100000.0)"),
        ("P6_like", "StringContains(p_name,red)"),
        ("P7_prefix", "StringStartsWith(p_name,hot )"),
        ("P13_script", "EqualTo(l_returnflag,R)"),
        ("AGG4_AGG7_metrics", "EqualTo(l_returnflag,R)"),
    ],
)
def test_filters_reach_the_scan(spark, name, pushed):
    assert pushed in plan(QUERIES[name](spark, TESTDATA))


@pytest.mark.parametrize(
    "name, columns",
    [
        ("AGG1_terms_boolean", "struct<o_totalprice:double>"),
        ("AGG9_cardinality", "struct<l_partkey:bigint,l_returnflag:string>"),
        ("AGG13_ranges", "struct<p_size:int,p_retailprice:double>"),
        ("TXT2_match_keyword", "struct<doc_id:bigint,lang:string,source:string>"),
        ("AGG15_nested", "struct<text:string,lang:string>"),
    ],
)
def test_only_needed_columns_are_read(spark, name, columns):
    shown = plan(QUERIES[name](spark, TESTDATA))
    assert f"ReadSchema: {columns}" in shown, shown


@pytest.mark.parametrize("name", ["RD4_select_list", "SRT1_RD8_order_by_limit", "AGG2_terms_size", "AGG14_top_hits", "RD6_select_page", "TXT3_TXT9_boosted_rank"])
def test_top_k_is_not_a_full_sort(spark, name):
    assert "TakeOrderedAndProject" in plan(QUERIES[name](spark, TESTDATA))


@pytest.mark.parametrize("name", ["RD9_collapse", "AGG14_top_hits_per_bucket", "AGG2_terms_size_per_parent"])
def test_groups_are_cut_before_the_shuffle(spark, name):
    assert "WindowGroupLimit" in plan(QUERIES[name](spark, TESTDATA))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_no_python_no_single_window(spark, name):
    shown = plan(QUERIES[name](spark, TESTDATA))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert bad not in shown


def test_matching_text_moves_no_rows(spark):
    assert "Exchange" not in plan(QUERIES["TXT2_match"](spark, TESTDATA))


def test_large_changes_do_not_force_a_broadcast(spark):
    """Joins carry no hint of their own, so their strategy follows the measured sizes."""
    orders = table(spark, TESTDATA, "orders")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch = orders.withColumn("n", F.lit(1))
        for df in (
            W.upsert(orders, batch, "o_orderkey", "n").rows,
            W.delete_by_ids(orders, "o_orderkey", batch.select("o_orderkey")).rows,
            W.update_batch(orders, batch.select("o_orderkey", "o_totalprice"), "o_orderkey", strict=False).rows,
        ):
            assert "SortMergeJoin" in plan(df) and "Broadcast" not in plan(df)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_ne_is_pushed(spark):
    orders = table(spark, TESTDATA, "orders")
    assert "Not(EqualNullSafe(o_orderstatus,F))" in plan(orders.filter(P.ne(fields(orders)["o_orderstatus"], "F")))


def test_hot_keys_can_be_split_in_id_joins(spark):
    """One id holds a third of the rows on both sides; with small thresholds the join splits it."""
    from quern.operators.reads import with_ids

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "50k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        hot = F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id"))
        rows = spark.range(0, 600_000, numPartitions=8).select(hot.alias("k"), F.col("id").alias("v"))
        ids = spark.range(0, 600_000, 3, numPartitions=8).select(
            F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("id")).alias("i")
        )
        found = with_ids(rows, fields(rows)["k"], ids).agg(F.sum("v").alias("s"), F.count("v").alias("n"))
        row = found.collect()[0]
        assert (row["n"], row["s"]) == (200_001, sum(range(0, 600_000, 3)) + 7)
        assert "skew=true" in found._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def scans(df):
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    return final.count("FileScan parquet")


def test_trees_read_their_rows_once(spark):
    from quern.operators import aggregations as A
    from quern.plans.buckets import drill_down, terms_size_per_parent

    orders = table(spark, TESTDATA, "orders")
    assert scans(drill_down(spark, TESTDATA)) == 1
    assert scans(terms_size_per_parent(spark, TESTDATA)) == 1
    tree = A.terms(
        "o_orderstatus",
        A.terms("o_orderpriority", A.date_histogram("o_orderdate", "year", A.terms("o_custkey", A.stats("o_totalprice"), size=2)), size=3),
        A.avg("o_totalprice", "mean"),
    )
    found = A.aggregate(orders, None, tree)
    assert scans(found.buckets("o_orderstatus", "o_orderpriority", "o_orderdate", "o_custkey")) == 1


def test_kept_buckets_force_no_broadcast(spark):
    from quern.operators import aggregations as A

    orders = table(spark, TESTDATA, "orders")
    tree = A.terms("o_custkey", A.top_hits(1, "o_totalprice", name="best"), size=1000)
    found = A.aggregate(orders, None, tree, key="o_orderkey").hits("o_custkey", "best")
    assert "strategy=broadcast" not in found._jdf.queryExecution().analyzed().toString()


def test_large_top_hits_are_cut_before_the_shuffle(spark):
    from quern.operators import aggregations as A

    orders = table(spark, TESTDATA, "orders")
    tree = A.terms("o_orderstatus", A.top_hits(2000, "o_totalprice", name="best"))
    found = A.aggregate(orders, None, tree, key="o_orderkey").hits("o_orderstatus", "best")
    assert "WindowGroupLimit" in found._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name, scans", [("AGG10_date_histogram_month", 1), ("AGG10_date_histogram_per_parent", 1)])
def test_gap_filling_shares_the_buckets(spark, name, scans):
    df = QUERIES[name](spark, TESTDATA)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert final.count("FileScan") == scans


@pytest.mark.parametrize("name", ["AGG2_terms_size_per_parent", "AGG10_date_histogram_per_parent", "AGG16_drill_down"])
def test_levels_of_trees_are_hash_aggregates(spark, name):
    shown = plan(QUERIES[name](spark, TESTDATA))
    assert "SortAggregate" not in shown and "HashAggregate" in shown


def test_conditions_on_one_child_field_read_only_it(spark, products, tmp_path):
    from quern.operators.reads import search
    from quern.operators.sorting import by_nested

    products.write.parquet(f"{tmp_path}/p")
    stored = spark.read.parquet(f"{tmp_path}/p")
    f = fields(stored)
    found = stored.filter(P.nested(f["skus"], lambda s: P.eq(s["spec"], "4K") | P.is_null(s["spec"]))).select("id")
    assert "skus:array<struct<spec:string>>" in plan(found)
    assert [r["id"] for r in found.collect()] == [90003]
    ordered = search(stored, None, [by_nested(f["skus"], "quantity", descending=True)], limit=2, key=f["id"]).select("id")
    assert "skus:array<struct<quantity:int>>" in plan(ordered)
    assert [r["id"] for r in ordered.collect()] == [90002, 90001]


def test_conditions_on_few_child_fields_leave_out_the_others(spark, tmp_path):
    child = F.struct(*[(F.col("id") * n % 7).alias(f"f{n}") for n in range(1, 6)])
    df = spark.range(40).select("id", F.when(F.col("id") > 0, F.array(child, child)).alias("kids"))
    df.write.parquet(f"{tmp_path}/k")
    stored = spark.read.parquet(f"{tmp_path}/k")

    def both(c):
        return P.gt(c["f2"], 3) & P.eq(c["f4"], 3)

    found = stored.filter(P.nested(fields(stored)["kids"], both)).select("id")
    assert "kids:array<struct<f2:bigint,f4:bigint>>" in plan(found)
    assert {r["id"] for r in found.collect()} == {i for i in range(1, 40) if i * 2 % 7 > 3 and i * 4 % 7 == 3}


def test_keyset_cursor_reaches_the_scan(spark):
    from quern.operators.reads import after
    from quern.operators.sorting import asc, desc

    orders = table(spark, TESTDATA, "orders")
    f = fields(orders)
    later = after(orders, [desc(f["o_orderdate"]), asc(f["o_orderkey"])], ("1998-01-01 00:00:00", "7"))
    shown = plan(orders.filter(later))
    assert "PushedFilters: [Or(Or(LessThan(o_orderdate,1998-01-01T00:00),IsNull(o_orderdate))" in shown
    assert "GreaterThan(o_orderkey,7)" in shown


def test_distance_box_reaches_the_scan(spark, products, tmp_path):
    from quern.functions import geo

    products.write.parquet(f"{tmp_path}/p")
    stored = spark.read.parquet(f"{tmp_path}/p")
    near = stored.filter(geo.geo_distance(fields(stored)["location"], "1500km", geo.Point(39.9, 116.4))).select("id")
    shown = plan(near)
    assert "GreaterThanOrEqual(location.lat," in shown and "LessThanOrEqual(location.lon," in shown
    assert {r["id"] for r in near.collect()} == {90001, 90002}


def test_upserts_group_their_batch_once(spark):
    df = entry.queries()["DML1_upsert"](spark, TESTDATA)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and "BroadcastHashJoin" in final
