"""The expected values of the product fixture, operator by operator."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.errors import QueryError
from quern.functions import geo
from quern.functions import predicates as P
from quern.functions import text as X
from quern.functions.fields import fields
from quern.operators import aggregations as A
from quern.operators import reads as R
from quern.operators.highlighting import select_highlighted
from quern.operators.ranking import rank
from quern.operators.sorting import asc, by_distance, by_nested, desc
from tests.conftest import SCHEMA, ids

BEIJING = geo.Point(39.90, 116.40)


def found(df, condition):
    return set(ids(P.where(df, condition)))


# ---- predicates ----


def test_comparisons(products, f):
    assert R.select_count(products, P.eq(f["onSale"], True)) == 2
    assert ids(R.select_list(products, P.gt(f["price"], 200.0), [desc(f["price"])])) == [90003, 90001]
    assert R.select_count(products, P.between(f["price"], 100.0, 500.0)) == 2
    assert found(products, P.like(f["productName"], "键盘")) == {90001}
    assert found(products, P.is_in(f["id"], 90001, 90003)) == {90001, 90003}
    assert found(products, P.is_in(f["id"], [])) == set()


def test_and_binds_tighter_than_or(products, f):
    off, cheap, many = P.eq(f["onSale"], False), P.le(f["price"], 200.0), P.ge(f["stock"], 50)
    assert found(products, off | cheap & many) == {90002, 90003}
    assert found(products, P.all_of(P.any_of(off, cheap), many)) == {90002}
    assert P.any_of() is None and P.all_of(None, P.all_of()) is None


def test_missing_values(four_products):
    f = fields(four_products)
    with_gap = four_products.withColumn("tag", F.when(F.col("id") == 90001, "x").when(F.col("id") == 90002, "y"))
    g = fields(with_gap)
    assert found(with_gap, P.ne(g["tag"], "x")) == {90002, 90003, 90004}
    assert found(with_gap, P.is_null(g["tag"])) == {90003, 90004}
    assert found(four_products, P.is_null(f["skus"])) == {90004}
    emptied = four_products.withColumn("skus", F.when(F.col("id") == 90001, F.slice("skus", 1, 0)).otherwise(F.col("skus")))
    assert found(emptied, P.is_null(fields(emptied)["skus"])) == {90001, 90004}


def test_refused_conditions(f):
    for wrong in (
        lambda: P.eq(f["description"], "x"),
        lambda: P.ne(f["description"], "x"),
        lambda: P.is_in(f["description"], "x"),
        lambda: P.like(f["description"], "x"),
        lambda: P.prefix(f["description"], "x"),
        lambda: P.fuzzy(f["description"], "x"),
        lambda: P.eq(f["price"], None),
        lambda: f["nothing"],
        lambda: geo.geo_distance(f["price"], "1km", BEIJING),
        lambda: by_distance(f["price"], BEIJING),
        lambda: P.nested(f["price"], lambda c: None),
        lambda: by_nested(f["price"], "x"),
        lambda: X.match(fields(T.StructType([]), ())["x"], "x"),
        lambda: geo.Point(91, 0),
        lambda: geo.Point(0, 181),
        lambda: geo.parse_distance("12 parsecs"),
        lambda: P.fuzzy(f["productName"], "x", 3),
    ):
        with pytest.raises((QueryError, AttributeError)):
            wrong()


def test_other_analyzers_are_refused(spark):
    schema = T.StructType([T.StructField("t", T.StringType(), True, {"analyzer": "ik_max_word"})])
    with pytest.raises(QueryError):
        X.match(fields(spark.createDataFrame([], schema))["t"], "x")


def test_fuzzy_and_prefix(products, f):
    assert found(products, P.fuzzy(f["productName"], "机械键盘 K871")) == {90001}
    assert found(products, P.fuzzy(f["productName"], "机械键盘 K871", 0)) == set()
    # two replaced characters would be within the automatic bound, three are not
    assert found(products, P.fuzzy(f["productName"], "机械鼠盘 K961")) == set()
    assert found(products, P.prefix(f["productName"], "机械")) == {90001}
    assert found(products, P.prefix(f["productName"], "无线")) == {90002}


def test_like_wildcards(spark):
    df = spark.createDataFrame([(1, "a*b"), (2, "axb"), (3, "a%b"), (4, "ab_"), (5, "a\\b")], "id int, s string")
    s = fields(df)["s"]
    assert found(df, P.like(s, "a?b")) == {1, 2, 3, 5}
    assert found(df, P.like(s, "a\\*b")) == {1}
    assert found(df, P.like(s, "a*b")) == {1, 2, 3, 4, 5}
    assert found(df, P.like(s, "%")) == {3}
    assert found(df, P.like(s, "_")) == {4}
    assert found(df, P.like(s, "\\\\")) == {5}


def test_script(products, f):
    assert ids(P.script(products, "stock > :least", {"least": 50})) == [90001]
    assert P.script(products, "stock >= 50").count() == 2
    mixed = P.with_script(products, "enough", "stock >= :n", {"n": 10})
    assert ids(mixed.filter(F.col("enough") & P.eq(fields(mixed)["onSale"], False))) == [90003]
    for source in ("", "  ", "stock + 1", "1 = 1) AS x, (2 = 2"):
        with pytest.raises(Exception):
            P.script(products, source).count()
    # a value that looks like SQL stays a value
    assert P.script(products, "productName = :n", {"n": "x' OR '1'='1"}).count() == 0


def test_geo(products, f):
    near = geo.geo_distance(f["location"], "1500km", BEIJING)
    assert found(products, near) == {90001, 90002}
    assert ids(R.search(products, None, [by_distance(f["location"], BEIJING)])) == [90001, 90002, 90003]
    away = {r["id"]: r["d"] / 1000 for r in products.select("id", geo.distance(f["location"], BEIJING).alias("d")).collect()}
    assert away[90002] == pytest.approx(1067.1, abs=0.1) and away[90003] == pytest.approx(1942.9, abs=0.1)
    both = near & P.nested(f["skus"], lambda s: P.eq(s["skuCode"], "SKU-B2"))
    assert found(products, both) == {90002}


def test_strict_points(spark):
    df = spark.createDataFrame([(95.0, 0.0)], "lat double, lon double")
    assert df.select(geo.point(F.col("lat"), F.col("lon"), strict=False).alias("p")).first()["p"] is None
    with pytest.raises(Exception, match="out of range"):
        df.select(geo.point(F.col("lat"), F.col("lon"))).collect()


def test_nested(products, f):
    assert found(products, P.nested(f["skus"], lambda s: P.eq(s["spec"], "4K") & P.le(s["quantity"], 5))) == {90003}
    # both values occur in 90003, but not in one child
    assert found(products, P.nested(f["skus"], lambda s: P.eq(s["spec"], "4K") & P.ge(s["quantity"], 6))) == set()
    with pytest.raises(QueryError):
        P.nested(f["skus"], lambda s: P.eq(s["colour"], "red"))


def test_inner_hits(products, f):
    rows = R.select_list_with_inner_hits(products, f["skus"], lambda s: P.eq(s["skuCode"], "SKU-C3"), 3).collect()
    assert [(r["id"], [c["quantity"] for c in r["inner_hits"]]) for r in rows] == [(90003, [5])]
    either = lambda s: P.is_in(s["skuCode"], "SKU-C3", "SKU-D4")
    rows = R.select_list_with_inner_hits(products, f["skus"], either, 1).collect()
    assert [len(r["inner_hits"]) for r in rows] == [1]
    with pytest.raises(QueryError):
        R.select_list_with_inner_hits(products, f["skus"], either, 0)


# ---- sorting and reads ----


def test_nested_sort(products, four_products, f):
    assert ids(R.search(products, None, [by_nested(f["skus"], "quantity", descending=True)])) == [90002, 90001, 90003]
    only_4k = by_nested(f["skus"], "quantity", descending=True, where=lambda s: P.eq(s["spec"], "4K"))
    assert ids(R.search(products, None, [only_4k], key=f["id"])) == [90003, 90001, 90002]
    g = fields(four_products)
    for descending in (False, True):
        order = [by_nested(g["skus"], "quantity", descending=descending)]
        assert ids(R.search(four_products, None, order))[-1] == 90004


def test_by_key(products, f):
    assert R.select_by_id(products, f["id"], 90001)["stock"] == 100
    assert R.select_by_id(products, f["id"], 1) is None
    assert set(ids(R.with_ids(products, f["id"], [90001, 90003, 5]))) == {90001, 90003}
    assert ids(R.with_ids(products, f["id"], [])) == []
    many = list(range(90002, 92002))
    assert set(ids(R.with_ids(products, f["id"], many))) == {90002, 90003}


def test_select_one(products, f):
    assert R.select_one(products, P.eq(f["id"], 90001))["id"] == 90001
    assert R.select_one(products, P.eq(f["id"], 1)) is None
    with pytest.raises(QueryError):
        R.select_one(products, P.eq(f["onSale"], True))


def test_pages(products, f):
    first = R.select_page(products, 1, 2, None, [asc(f["price"])], f["id"])
    second = R.select_page(products, 2, 2, None, [asc(f["price"])], f["id"])
    assert (ids(first.rows), ids(second.rows)) == ([90002, 90001], [90003])
    assert (first.total, first.pages) == (3, 2)
    assert R.select_page(products, 1, 2, key=f["id"], with_total=False).total is None
    with pytest.raises(QueryError):
        R.select_page(products, 1, 2)
    for current, size in ((2, 9000), (0, 5), (1, 0)):
        with pytest.raises(QueryError):
            R.select_page(products, current, size)


def test_limits(products, f):
    assert len(ids(R.select_list(products, limit=2))) == 2
    for limit in (0, 20000):
        with pytest.raises(QueryError):
            R.select_list(products, limit=limit)


def test_list_cap(spark):
    df = spark.range(1001)
    with pytest.raises(QueryError):
        R.select_list(df)
    assert R.select_list(df, limit=1001).count() == 1001
    assert R.search(df).count() == 1001
    assert R.select_list(df.limit(1000)).count() == 1000


def test_collapse(four_products):
    f = fields(four_products)
    same = P.eq(f["productName"], "机械键盘 K870")
    assert ids(R.select_list(four_products, same, [desc(f["price"])], collapse=f["productName"], key=f["id"])) == [90004]
    everything = R.select_list(four_products, None, [asc(f["price"])], collapse=f["productName"], key=f["id"])
    assert ids(everything) == [90002, 90001, 90003]


def test_collapse_of_many_counts_before_collapsing(spark):
    df = spark.range(1001).withColumn("one", F.lit(1))
    with pytest.raises(QueryError):
        R.select_list(df, collapse=fields(df)["one"])


def test_keyset(products, f):
    on_sale = P.eq(f["onSale"], True)
    seen, cursor = [], None
    for _ in range(2):
        batch = R.select_after(products, 1, cursor, on_sale, [desc(f["price"])], key=f["id"])
        seen += ids(batch.rows)
        cursor = batch.next
        assert batch.total == 2
    assert seen == [90001, 90002] and cursor is None
    assert R.select_after(products, 10, None, on_sale, key=f["id"]).next is None
    with pytest.raises(QueryError):
        R.select_after(products, 10001, key=f["id"])


# ---- full text ----


def test_match(products, f):
    assert found(products, X.match(f["description"], "无线")) == {90002}
    assert found(products, X.match(f["productName"], "显示器 U2723")) == {90003}
    assert found(products, X.match(f["productName"], "显示器")) == set()
    both = [f["productName"], f["description"]]
    assert found(products, X.multi_match([f["description"]], "无线鼠标", "phrase")) == {90002}
    assert found(products, X.multi_match([f["description"]], "鼠标 无线", "phrase")) == set()
    assert found(products, X.multi_match(both, "静音 4K")) == {90002, 90003}
    assert found(products, X.multi_match(both, "静音 4K", operator="and")) == set()
    assert found(products, X.multi_match(both, "静音 无线", operator="and")) == {90002}
    with pytest.raises(QueryError):
        X.multi_match([], "x")


def test_boost_decides_rank(products, f):
    def top(keyboard, mouse):
        queries = [
            X.text_query(f["description"], "键盘", boost=keyboard),
            X.text_query(f["description"], "鼠标", boost=mouse),
        ]
        return ids(rank(products, queries, f["id"]))

    assert top(10.0, 1.0) == [90001, 90002]
    assert top(1.0, 10.0) == [90002, 90001]


def test_highlight(products, f):
    query = X.text_query(f["description"], "无线")
    hits = select_highlighted(products, [query], [f["description"], f["productName"]], pre_tag="<b>", post_tag="</b>")
    row = hits.collect()[0]
    assert row["id"] == 90002 and list(row["highlights"]) == ["description"]
    assert row["highlights"]["description"] == ["静音<b>无</b><b>线</b>鼠标 办公首选"]
    plain = select_highlighted(products, [query], [f["description"]], limit=1, key=f["id"]).collect()[0]
    assert "<em>无</em>" in plain["highlights"]["description"][0]
    with pytest.raises(QueryError):
        select_highlighted(products, [query], [])


# ---- aggregations ----


def pairs(frame, *names):
    return [tuple(r[n] for n in names) for r in frame.collect()]


def test_metrics(products, f):
    found = A.aggregate(
        products,
        None,
        A.terms("onSale"),
        A.avg("price", name="mean"),
        A.max("price"),
        A.stats("stock"),
        A.cardinality("productName", name="names"),
    )
    assert pairs(found.buckets("onSale"), "onSale", "doc_count") == [(1, 2), (0, 1)]
    assert (found.value("mean"), found.value("price")) == (1142.5, 2899.0)
    assert found.stats("stock") == {"count": 3, "min": 10, "max": 100, "avg": pytest.approx(160 / 3), "sum": 160}
    assert found.value("names") == 3
    for wrong in (lambda: found.value("nothing"), lambda: found.value("stock"), lambda: found.stats("price"),
                  lambda: found.buckets("price"), lambda: found.hits("onSale")):
        with pytest.raises(QueryError):
            wrong()


def test_terms(products):
    assert A.aggregate(products, None, A.terms("productName")).buckets("productName").count() == 3
    assert A.aggregate(products, None, A.terms("productName", size=2)).buckets("productName").count() == 2
    for wrong in (
        lambda: A.terms("x", size=0),
        lambda: A.terms("x", order_by="nothing"),
        lambda: A.aggregate(products, None),
        lambda: A.aggregate(products, None, A.avg("price"), A.max("price")),
        lambda: A.aggregate(products, None, A.terms("description")),
        lambda: A.aggregate(products, None, A.nested("price")),
        lambda: A.aggregate(products, None, A.avg("skus")),
        lambda: A.aggregate(products, None, A.sum("productName")),
        lambda: A.aggregate(products, None, A.terms("price", A.avg("price"))),
        lambda: A.top_hits(0),
        lambda: A.ranges("price", []),
        lambda: A.date_histogram("launchDate", "fortnight"),
        lambda: A.date_histogram("launchDate", "day", min_doc_count=-1),
    ):
        with pytest.raises(QueryError):
            wrong()


def test_terms_order(products):
    def order(by, descending):
        tree = A.terms("onSale", A.avg("price", name="mean"), A.stats("stock"), order_by=by, descending=descending)
        return [r["onSale"] for r in A.aggregate(products, None, tree).buckets("onSale").collect()]

    assert order("mean", True) == [0, 1]
    assert order("_count", True) == [1, 0]
    assert order("_key", False) == [0, 1]
    assert order("stock.max", True) == [1, 0]


def test_sub_metrics(products):
    tree = A.terms("onSale", A.avg("price", name="mean"), A.max("price", name="most"))
    frame = A.aggregate(products, None, tree).buckets("onSale")
    assert pairs(frame, "onSale", "mean", "most") == [(1, 264.25, 399.0), (0, 2899.0, 2899.0)]


def test_date_histogram(products):
    every = A.aggregate(products, None, A.date_histogram("launchDate", "month", A.sum("stock", name="n"))).buckets("launchDate")
    rows = every.collect()
    assert [r["doc_count"] for r in rows] == [1, 0, 1, 0, 0, 1]
    assert [r["n"] for r in rows] == [100, 0, 50, 0, 0, 10]
    assert rows[0]["launchDate"] == 1767225600000
    some = A.aggregate(products, None, A.date_histogram("launchDate", "month", min_doc_count=1, format="yyyy-MM"))
    assert pairs(some.buckets("launchDate"), "launchDate_text", "doc_count") == [
        ("2026-01", 1), ("2026-03", 1), ("2026-06", 1),
    ]


def test_long_histograms_have_all_buckets(spark):
    df = spark.sql("SELECT explode(array(timestamp'2020-01-01 00:00:07', timestamp'2020-01-04 00:00:05')) AS t")
    found = A.aggregate(df, None, A.date_histogram("t", "second")).buckets("t")
    n, least, most, rows, distinct = found.selectExpr("count(*)", "min(t)", "max(t)", "sum(doc_count)", "count(distinct t)").first()
    assert n == distinct == 3 * 86400 - 1 and most - least == (n - 1) * 1000 and rows == 2
    assert A.aggregate(df, None, A.date_histogram("t", "second", min_doc_count=1)).buckets("t").count() == 2


@pytest.mark.parametrize("low,high", [(None, None), (2.0, 1.0), (1.0, 1.0)])
def test_ranges_of_nothing_are_refused(low, high):
    with pytest.raises(QueryError):
        A.Range(low, high)


def test_metrics_over_dates(products):
    day = 86_400_000
    dates = [20468, 20513, 20624]  # launch days since 1970
    found = A.aggregate(products, None, A.stats("launchDate", "d"), A.avg("launchDate", "a"), A.sum("launchDate", "s"))
    row = found.metrics().first()
    assert (row["d_count"], row["d_min"], row["d_max"], row["s"]) == (3, dates[0] * day, dates[2] * day, sum(dates) * day)
    assert row["a"] == row["d_avg"] == sum(dates) * day / 3
    tree = A.terms("onSale", A.avg("launchDate", "a"), A.terms("stock", A.max("launchDate", "last"), name="stock"), name="sale")
    assert dict(A.aggregate(products, None, tree).buckets("sale").select("sale", "a").collect()) == {
        1: (dates[0] + dates[1]) * day / 2,
        0: dates[2] * day,
    }


def test_dotted_metric_names(products):
    tree = A.terms("onSale", A.avg("price", "price.usd"), name="sale", order_by="price.usd")
    assert [r["price.usd"] for r in A.aggregate(products, None, tree).buckets("sale").collect()] == [2899.0, 264.25]
    tree = A.terms("onSale", A.stats("price", "p.x"), A.date_histogram("launchDate", "month", A.sum("stock", "s.t")), name="sale", order_by="p.x.min")
    found = A.aggregate(products, None, tree)
    assert [r["p.x_min"] for r in found.buckets("sale").collect()] == [2899.0, 129.5]
    assert found.buckets("sale", "launchDate").selectExpr("sum(`s.t`)").first()[0] == 160


def test_rolled_up_levels_keep_rows_without_lower_keys(spark):
    rows = spark.createDataFrame([("a", None, 1.0), ("a", "x", 3.0), ("b", None, None), (None, "x", 9.0)], "k string, l string, v double")
    tree = A.terms("k", A.avg("v", "m"), A.stats("v", "s"), A.terms("l", A.sum("v", "t"), name="l"), name="k")
    found = A.aggregate(rows, None, tree)
    assert [tuple(r) for r in found.buckets("k").collect()] == [("a", 2, 2.0, 2, 1.0, 3.0, 2.0, 4.0), ("b", 1, None, 0, None, None, None, 0.0)]
    assert [tuple(r) for r in found.buckets("k", "l").collect()] == [("a", "x", 1, 3.0)]


def test_histogram_of_nothing(products, f):
    none = A.aggregate(products, P.gt(f["price"], 1e9), A.date_histogram("launchDate", "day"))
    assert none.buckets("launchDate").count() == 0


def test_ranges(products):
    bounds = [A.Range(0.0, 1000.0, "budget"), A.Range(1000.0, None, "premium"), A.Range(None, 130.0), A.Range(1e6, 2e6)]
    frame = A.aggregate(products, None, A.ranges("price", bounds)).buckets("price")
    assert pairs(frame, "price", "doc_count") == [
        ("budget", 2), ("premium", 1), ("*-130.0", 1), ("1000000.0-2000000.0", 0),
    ]


def test_top_hits(products):
    tree = A.terms("onSale", A.top_hits(1, "launchDate", name="latest"))
    frame = A.aggregate(products, None, tree).hits("onSale", "latest")
    assert pairs(frame.select("onSale", "hit.id"), "onSale", "id") == [(0, 90003), (1, 90002)]
    top = A.aggregate(products, None, A.top_hits(2, "price"), A.top_hits(2, "price", ascending=True, name="low"))
    assert ids(top.hits("top_hits").select("hit.id")) == [90003, 90001]
    assert ids(top.hits("low").select("hit.id")) == [90002, 90001]


def test_nested_aggregation(products, four_products, f):
    found = A.aggregate(products, None, A.nested("skus", A.avg("quantity"), A.terms("spec", size=1)))
    assert pairs(found.nested("skus"), "doc_count", "quantity") == [(4, 38.75)]
    assert found.value("skus", "quantity") == 38.75
    off = A.aggregate(products, P.eq(f["onSale"], False), A.nested("skus", A.max("quantity", name="most")))
    assert pairs(off.nested("skus"), "doc_count", "most") == [(2, 10)]
    tree = A.terms("id", A.nested("skus", A.sum("quantity", name="n")), order_by="_key", descending=False)
    per_parent = A.aggregate(four_products, None, tree).nested("id", "skus")
    assert pairs(per_parent, "id", "doc_count", "n") == [(90001, 1, 60), (90002, 1, 80), (90003, 2, 15), (90004, 0, 0)]


def test_schema_of_fixture(products):
    assert products.schema["description"].metadata == SCHEMA["description"].metadata
