"""The nearest points by cells against the plain sort, and scripts on child fields."""

import math
import random

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from quern.errors import QueryError
from quern.functions import geo
from quern.functions import predicates as P
from quern.functions.fields import fields
from quern.operators.nearest import cell_counts, radius, select_nearest
from quern.operators.reads import search
from quern.operators.sorting import by_distance
from tests.test_plans import plan


@pytest.fixture(scope="module")
def places(spark, tmp_path_factory):
    rng = random.Random(5)
    spots = [(90.0, 10.0), (-90.0, 0.0), (89.9, -170.0), (0.0, 180.0), (0.0, -180.0), (10.0, 179.99), (10.0, -179.99), (0.0, 0.0)]
    points = spots + [(rng.uniform(-90, 90), rng.uniform(-180, 180)) for _ in range(400)]
    # A third of all points in one cell, several in one place.
    points += [(48.0 + rng.random(), 11.0 + rng.random()) for _ in range(200)] + [(48.5, 11.5)] * 30
    rows = [(i, p, i % 3) for i, p in enumerate(points)] + [(10_000 + i, None, 1) for i in range(5)]
    path = str(tmp_path_factory.mktemp("places") / "p")
    spark.createDataFrame(rows, "id int, at struct<lat:double,lon:double>, n int").repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("lat, lon", [(48.5, 11.5), (90, 0), (-90, 50), (89.95, 120), (0.0, 180.0), (5.0, -179.9), (-33.9, 151.2)])
@pytest.mark.parametrize("k", [1, 7, 60])
def test_nearest_equals_the_plain_sort(places, lat, lon, k):
    f = fields(places)
    origin = geo.Point(lat, lon)
    found = [r["id"] for r in select_nearest(places, f["at"], origin, k, f["id"]).collect()]
    assert found == [r["id"] for r in search(places, None, [by_distance(f["at"], origin)], k, key=f["id"]).collect()]


def test_conditions_few_points_and_none(places):
    f = fields(places)
    origin = geo.Point(48.2, 11.7)
    for condition, k in ((P.eq(f["n"], 1), 40), (P.lt(f["id"], 6), 20), (P.gt(f["id"], 638), 10), (P.lt(f["id"], 0), 3)):
        found = [r["id"] for r in select_nearest(places, f["at"], origin, k, f["id"], condition).collect()]
        assert found == [r["id"] for r in search(places, condition, [by_distance(f["at"], origin)], k, key=f["id"]).collect()]


def test_counts_are_sums_and_bound_the_radius(places):
    f = fields(places)
    cells = cell_counts(places, f["at"])
    assert cells.agg(F.sum("points")).first()[0] == 638
    parts = [cell_counts(places, f["at"], P.eq(f["n"], n)) for n in (0, 1, 2)]
    union = parts[0].union(parts[1]).union(parts[2])
    for lat, lon in ((48.5, 11.5), (90.0, 0.0), (12.0, 179.5)):
        origin = geo.Point(lat, lon)
        away = places.where("at is not null").select(geo.distance(f["at"], origin).alias("m"))
        for k in (1, 20, 638):
            reach = radius(cells, origin, k)
            assert reach == radius(union, origin, k)
            assert away.where(F.col("m") <= reach).count() >= k
        assert radius(cells, origin, 639) is None


def test_the_box_reaches_the_scan(places):
    f = fields(places)
    cells = cell_counts(places, f["at"])
    shown = plan(select_nearest(places, f["at"], geo.Point(48.5, 11.5), 10, f["id"], cells=cells))
    assert "GreaterThanOrEqual(at.lat," in shown and "LessThanOrEqual(at.lon," in shown and "TakeOrderedAndProject" in shown
    assert math.isclose(radius(cells, geo.Point(48.5, 11.5), 10), geo.EARTH_RADIUS_M * math.radians(1.0), rel_tol=1e-9)


def test_wrong_calls_raise(places):
    f = fields(places)
    for wrong in (0, None, 10_001):
        with pytest.raises(QueryError):
            select_nearest(places, f["at"], geo.Point(0, 0), wrong, f["id"])
    with pytest.raises(QueryError):
        select_nearest(places, f["n"], geo.Point(0, 0), 1, f["id"])
    with pytest.raises(QueryError, match="columns"):
        select_nearest(places, f["at"], geo.Point(0, 0), 1, f["id"], cells=places)


# ---- scripts on children ----

KIDS = "id int, color string, size int, kids array<struct<color:string,size:int,`odd name`:int,kids:int>>"


@pytest.fixture(scope="module")
def parents(spark):
    rows = [
        (1, "top", 0, [("red", 5, 1, 7), ("blue", 50, 2, 8)]),
        (2, "red", 99, [("green", 99, 3, 9)]),
        (3, None, None, []),
        (4, "x", 1, None),
        (5, "y", 2, [(None, None, None, None), ("red", 60, 4, 1)]),
        (6, "y", 2, [None]),
    ]
    return spark.createDataFrame(rows, KIDS)


def picked(df, source, **params):
    return [r["id"] for r in P.nested_script(df, fields(df)["kids"], source, params).orderBy("id").collect()]


def test_names_in_scripts_are_those_of_the_children(parents):
    assert picked(parents, "color = 'red'") == [1, 5]
    assert picked(parents, "color = 'red' and size > 50") == [5]
    assert picked(parents, "COLOR = :c AND Size between :low and :high", c="blue", low=50, high=50) == [1]
    with pytest.raises(AnalysisException):  # the name means the child field `kids`, a number
        picked(parents, "kids.color = 'green'")
    assert picked(parents, "kids = 9 and id = 2") == [2]
    assert picked(parents, "`odd name` = 4 -- a remark") == [5]
    assert picked(parents, "exists(array(1, 2), x -> x = `odd name`)") == [1]
    assert picked(parents, "size is null") == [5, 6]
    assert picked(parents, "true") == [1, 2, 5, 6]
    assert picked(parents, "color = :c", c="x' or 'a' = 'a") == []


def test_whole_children_by_the_name_of_their_array(spark):
    df = spark.createDataFrame([(1, [(1, "a")]), (2, [(2, "b")])], "id int, parts array<struct<n:int,t:string>>")
    assert [r["id"] for r in P.nested_script(df, fields(df)["parts"], "parts.n = :n and t = 'b'", {"n": 2}).collect()] == [2]


def test_hits_of_scripts(parents):
    found = P.with_script_hits(parents, "hits", fields(parents)["kids"], "size >= :n", 1, {"n": 5}).orderBy("id").collect()
    assert [[h["size"] for h in r["hits"]] for r in found] == [[5], [99], [], [], [60], []]
    marked = P.with_nested_script(parents, "any", fields(parents)["kids"], "size > 55").orderBy("id").collect()
    assert [r["any"] for r in marked] == [False, True, False, False, True, False]


def test_wrong_scripts_raise(parents):
    kids = fields(parents)["kids"]
    for wrong in (lambda: P.nested_script(parents, kids, " "), lambda: P.nested_script(parents, fields(parents)["size"], "true"),
                  lambda: P.with_script_hits(parents, "hits", kids, "true", 0)):
        with pytest.raises(QueryError):
            wrong()
    for wrong in ("nothing = 1", "size", "size >", "true, false"):
        with pytest.raises(Exception):
            P.nested_script(parents, kids, wrong).collect()
