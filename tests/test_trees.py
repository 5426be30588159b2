"""Trees that read their rows once, against a plain evaluation of the same tree."""

import datetime
import decimal
import random

import pytest
from pyspark.sql import functions as F

from quern.errors import QueryError
from quern.operators import aggregations as A

D = decimal.Decimal
SCHEMA = "a string, b int, at timestamp_ntz, x double, n int, amount decimal(12,2), flag boolean"


def made(count, seed=3):
    rng = random.Random(seed)
    out = []
    for _ in range(count):
        # One value of the first key holds a third of the rows; every column has nulls.
        row = (
            rng.choice(["hot", "hot", "p", "q", "r", "s"]),
            rng.randrange(5),
            datetime.datetime(2019, 1, 1) + datetime.timedelta(days=rng.choice([0, 3, 40, 400, 1200, 1201])),
            rng.choice([-5.0, 0.0, 9.5, 10.0, 10.5, 20.0, 35.0, 1000.0]),
            rng.randrange(40),
            D(rng.randrange(-10_000, 10_000_000)) / 100,
            rng.random() < 0.5,
        )
        out.append(tuple(None if rng.random() < 0.06 else v for v in row))
    return out


ROWS = made(1500)
NAMES = [c.split()[0] for c in SCHEMA.split(", ")]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(5)


def millis(at):
    return int((at - datetime.datetime(1970, 1, 1)).total_seconds()) * 1000


def plain_keys(agg, row):
    value = row[NAMES.index(agg.field)]
    if value is None:
        return []
    if agg.kind == "range":
        return [r.label for r in agg.options["ranges"] if (r.low is None or value >= r.low) and (r.high is None or value < r.high)]
    if agg.kind == "date_histogram":
        return [millis(datetime.datetime(value.year, 1, 1))]
    return [int(value) if isinstance(value, bool) else value]


def plain_metric(agg, rows):
    values = [r[NAMES.index(agg.field)] for r in rows]
    values = [float(v) for v in values if v is not None]
    if agg.kind == "cardinality":
        return {agg.name: len(set(values))}
    if agg.kind == "sum":
        return {agg.name: sum(values)}
    found = {"count": len(values), "sum": sum(values), "min": min(values, default=None), "max": max(values, default=None)}
    found["avg"] = found["sum"] / len(values) if values else None
    if agg.kind == "stats":
        return {f"{agg.name}_{k}": v for k, v in found.items()}
    return {agg.name: found[agg.kind]}


def plain(aggs, rows, keys=(), path=()):
    """(path, keys) -> (count, metrics), buckets cut and gaps filled as declared."""
    out = {}
    for agg in aggs:
        if agg.kind not in A.BUCKETS:
            continue
        parts = {}
        if agg.kind == "range":
            parts = {r.label: [] for r in agg.options["ranges"]}
        for row in rows:
            for key in plain_keys(agg, row):
                parts.setdefault(key, []).append(row)
        if agg.kind == "date_histogram" and parts and not agg.options["min_doc_count"]:
            years = [datetime.datetime(1970, 1, 1) + datetime.timedelta(milliseconds=k) for k in parts]
            for year in range(min(years).year, max(years).year + 1):
                parts.setdefault(millis(datetime.datetime(year, 1, 1)), [])
        if agg.kind == "date_histogram":
            parts = {k: p for k, p in parts.items() if len(p) >= agg.options["min_doc_count"]}
        if agg.kind == "terms":
            by = agg.options["order_by"]

            def order(key):
                if by in ("_count", "_key"):
                    value = len(parts[key]) if by == "_count" else None
                else:
                    value = [v for m in agg.children if m.kind in A.METRICS for n, v in plain_metric(m, parts[key]).items() if n == by[1]][0]
                falling = agg.options["descending"]
                return (value is None and by != "_key", -value if value is not None and falling else value or 0, key)

            kept = sorted(parts, key=order)
            if by == "_key" and agg.options["descending"]:
                kept = sorted(parts, reverse=True)
            parts = {k: parts[k] for k in kept[: agg.options["size"]]}
        for key, part in parts.items():
            here, at = (*path, agg.name), (*keys, str(key))
            metrics = {n: v for m in agg.children if m.kind in A.METRICS for n, v in plain_metric(m, part).items()}
            out["/".join(here), at] = (len(part), metrics)
            out |= plain(agg.children, part, at, here) if part else {}  # nothing is listed below an empty bucket
    return out


def same(table, *tree):
    found = A.aggregate(table, None, *tree).all_buckets().collect()
    expected = plain(tree, ROWS)
    got = {(r["path"], tuple(r["keys"])): (r["doc_count"], r["metrics"]) for r in found}
    assert len(found) == len(got) and got.keys() == expected.keys()
    for key, (count, metrics) in expected.items():
        assert got[key][0] == count, key
        assert got[key][1].keys() == metrics.keys()
        for name, value in metrics.items():
            # Sketches of a few values are exact; decimal means have six digits.
            assert got[key][1][name] == (None if value is None else pytest.approx(value, abs=1e-6, rel=1e-9)), (key, name)


RANGES = [A.Range(None, 10.0), A.Range(9.5, 20.0, "wide"), A.Range(10.0, 20.0), A.Range(0.0, None), A.Range(5000.0, None, "none")]


def measures():
    return [A.avg("x", "mean"), A.sum("n", "total"), A.stats("amount", "money"), A.cardinality("b", "kinds"), A.avg("amount", "money_mean"), A.avg("n", "n_mean")]


TREES = {
    "chain": lambda: [A.terms("a", *measures(), A.terms("b", *measures(), name="b", size=2), name="a", size=3)],
    "gaps": lambda: [A.terms("a", A.date_histogram("at", "year", *measures(), name="year"), name="a", size=4)],
    "branches": lambda: [
        A.terms(
            "a",
            *measures(),
            A.terms("b", A.max("x", "top"), name="b", size=3, order_by="top"),
            A.date_histogram("at", "year", A.min("x", "low"), A.terms("flag", name="flag"), name="year"),
            A.ranges("x", RANGES, A.sum("amount", "money"), name="range"),
            name="a",
        )
    ],
    "ranges between": lambda: [A.terms("a", A.ranges("x", RANGES, *measures(), A.terms("b", *measures(), name="b"), name="range"), name="a", size=2)],
    "ranges first": lambda: [A.ranges("x", RANGES, *measures(), A.ranges("n", [A.Range(None, 20), A.Range(10, None)], A.avg("x", "mean"), name="n"), A.terms("a", name="a", size=1), name="x")],
    "cut first": lambda: [A.terms("a", A.terms("b", *measures(), A.terms("flag", name="flag"), name="b", size=2, cut_first=True), name="a", cut_first=True, size=2)],
    "cut inside": lambda: [A.terms("a", A.terms("b", *measures(), A.terms("flag", name="flag"), A.date_histogram("at", "year", name="year"), name="b", size=2, cut_first=True), A.ranges("x", RANGES, name="range"), name="a")],
    "exact inside": lambda: [A.terms("a", A.cardinality("n", "n", exact=True), A.terms("b", A.terms("flag", A.cardinality("x", "x"), name="flag"), name="b"), name="a", size=3)],
    "exact below": lambda: [A.terms("a", A.terms("b", A.cardinality("n", "n", exact=True), A.terms("flag", name="flag"), name="b"), A.ranges("x", RANGES, name="range"), name="a", size=3)],
    "dropped months": lambda: [A.date_histogram("at", "year", A.terms("a", A.sum("x", "s"), name="a", size=2, order_by="s"), name="year", min_doc_count=300)],
    "two trees": lambda: [A.terms("flag", A.terms("a", name="a"), name="flag"), A.ranges("amount", [A.Range(None, 50000.0), A.Range(50000.0, None)], A.terms("b", name="b", order_by="_key"), name="amount")],
}


@pytest.mark.parametrize("name", TREES)
def test_trees_equal_their_plain_evaluation(table, name):
    same(table, *TREES[name]())


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def stored(spark, table, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("trees") / "t")
    table.write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("name", ["chain", "gaps", "branches", "ranges between", "ranges first", "dropped months"])
def test_a_whole_tree_reads_its_rows_once(stored, name):
    """All levels and branches in one job, from one scan, with fixed-width hash aggregates and no copy of rows per range."""
    plan = final_plan(A.aggregate(stored, None, *TREES[name]()).all_buckets())
    assert plan.count("FileScan") == 1
    assert "SortAggregate" not in plan
    # Below the first shuffle rows are laid out once per path of a branching tree, never per range.
    below = [line for line in plan[: plan.index("FileScan")].rpartition("Exchange")[2].split("\n") if "Generate" in line]
    assert len(below) == (name in ("branches", "ranges first"))


def test_cut_first_groups_kept_rows_only(stored):
    tree = A.terms("a", A.date_histogram("at", "second", name="s", min_doc_count=1), name="a", size=1, cut_first=True)
    plan = final_plan(A.aggregate(stored, None, tree).buckets("a", "s"))
    assert plan.count("FileScan") == 2 and "LeftSemi" in plan


def test_top_hits_and_children_beside_shared_buckets(spark):
    kids = "array<struct<c:string,v:int>>"
    rows = [(i, "xyz"[i % 3], i % 2, [("k", i), ("m", -i)][: i % 3]) for i in range(30)]
    df = spark.createDataFrame(rows, f"id int, a string, b int, kids {kids}")
    tree = A.terms(
        "a",
        A.terms("b", A.top_hits(1, "id", name="last"), name="b", size=1),
        A.terms("id", name="id", size=2, order_by="_key"),
        A.nested("kids", A.terms("c", A.sum("v", "v"), A.terms("v", name="value", size=1), name="c")),
        name="a",
        size=2,
    )
    found = A.aggregate(df, None, tree, key="id")
    assert [(r["a"], r["b"], r["hit"]["id"]) for r in found.hits("a", "b", "last").collect()] == [("x", 0, 24), ("y", 0, 28)]
    assert [(r["a"], r["id"]) for r in found.buckets("a", "id").collect()] == [("x", 27), ("x", 24), ("y", 28), ("y", 25)]
    inside = {(r["a"], r["c"]): (r["doc_count"], r["v"]) for r in found.buckets("a", "kids", "c").collect()}
    assert inside == {("y", "k"): (10, sum(i for i in range(30) if i % 3 == 1))}
    assert [(r["a"], r["c"], r["value"]) for r in found.buckets("a", "kids", "c", "value").collect()] == [("y", "k", 1)]


def test_types_of_merged_metrics_are_those_of_plain_ones(table):
    flat = A.aggregate(table, None, A.terms("a", *measures(), name="a")).buckets("a").schema
    deep = A.aggregate(table, None, A.terms("a", *measures(), A.terms("b", *measures(), name="b"), name="a"))
    for frame in (deep.buckets("a"), deep.buckets("a", "b")):
        for field in flat:
            assert frame.schema[field.name].dataType == field.dataType, field.name


@pytest.mark.parametrize("precision, scale", [(4, 2), (28, 2), (38, 2), (38, 20), (38, 37), (30, 30)])
def test_types_of_wide_decimals(spark, precision, scale):
    df = spark.createDataFrame([("a", 1), ("a", 2)], "a string, b int").withColumn("d", F.lit(0.1).cast(f"decimal({precision},{scale})"))
    flat = A.aggregate(df, None, A.terms("a", A.avg("d", "m"), A.sum("d", "s"), name="a")).buckets("a")
    deep = A.aggregate(df, None, A.terms("a", A.avg("d", "m"), A.sum("d", "s"), A.terms("b", A.avg("d", "m"), name="b"), name="a"))
    assert deep.buckets("a").dtypes == flat.dtypes and deep.buckets("a").collect() == flat.collect()
    assert [r["m"] for r in deep.buckets("a", "b").collect()] == [flat.first()["m"]] * 2


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    for name in ("chain", "gaps", "branches", "ranges between"):
        assert A.aggregate(none, None, *TREES[name]()).all_buckets().collect() == []
    first = A.aggregate(none, None, *TREES["ranges first"]())
    assert [r["doc_count"] for r in first.buckets("x").collect()] == [0] * 5
    assert [r["total"] for r in first.buckets("x").collect()] == [0] * 5


def test_mistakes_raise_before_anything_runs(table):
    for wrong in (
        lambda: A.terms("a", A.terms("b", A.avg("a"), name="b"), name="a"),
        lambda: A.terms("a", A.date_histogram("b", "day"), name="a"),
        lambda: A.terms("a", A.terms("nothing"), name="a"),
        lambda: A.terms("a", A.terms("b", name="a"), name="a"),
    ):
        with pytest.raises(QueryError):
            A.aggregate(table, None, wrong())
    with pytest.raises(QueryError, match="no buckets"):
        A.aggregate(table, None, A.avg("x")).all_buckets()
