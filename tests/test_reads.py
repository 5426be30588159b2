"""Reads and predicates against brute force on small inputs."""

import datetime
import decimal
import functools
import itertools
import random

import pytest
from pyspark.sql import functions as F

from quern.errors import QueryError
from quern.functions import geo
from quern.functions import predicates as P
from quern.functions.fields import fields
from quern.operators import reads as R
from quern.operators import writes as W
from quern.operators import topn
from quern.operators.sorting import Sort, asc, by_distance, desc
from quern.operators.topn import top_per_group


def edit_distance(a, b):
    """Insert, delete, replace, swap of neighbours; no part is edited twice."""
    d = [[i + j if i * j == 0 else 0 for j in range(len(b) + 1)] for i in range(len(a) + 1)]
    for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
        d[i][j] = min(d[i - 1][j] + 1, d[i][j - 1] + 1, d[i - 1][j - 1] + (a[i - 1] != b[j - 1]))
        if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
            d[i][j] = min(d[i][j], d[i - 2][j - 2] + 1)
    return d[len(a)][len(b)]


def test_fuzzy_equals_brute_force(spark):
    words = ["".join(w) for n in range(6) for w in itertools.product("abc", repeat=n)]
    df = spark.createDataFrame([(w,) for w in words], "w string").cache()
    w = fields(df)["w"]
    for value in ("", "a", "ab", "ca", "abc", "abca", "bacb", "aabb", "abcab"):
        for edits in (0, 1, 2):
            got = {r["w"] for r in df.filter(P.fuzzy(w, value, edits)).collect()}
            assert got == {x for x in words if edit_distance(value, x) <= edits}, (value, edits)


def test_fuzzy_with_a_long_value(spark):
    value = "".join(random.Random(1).choice("abcdefgh") for _ in range(300))

    def swap(text, i):
        return text[:i] + text[i + 1] + text[i] + text[i + 2 :]

    def changes(text):
        return (text, swap(text, 10), swap(swap(text, 10), 250), "z" + swap(text, 100), swap(text, 100)[:-1])

    rows = [*changes(value), swap(swap(swap(value, 10), 100), 250), value[1:-2], ""]
    df = spark.createDataFrame(list(enumerate(rows)), "i int, w string")
    for edits in (1, 2):
        got = {r["i"] for r in df.filter(P.fuzzy(fields(df)["w"], value, edits)).collect()}
        assert got == {i for i, r in enumerate(rows) if edit_distance(value, r) <= edits}


def test_automatic_edits():
    assert [P.auto_edits("x" * n) for n in (0, 2, 3, 5, 6, 20)] == [0, 0, 1, 1, 2, 2]


def test_missing_values_match_only_ne(spark):
    df = spark.createDataFrame([(1, None), (2, 5)], "id int, v int")
    v = fields(df)["v"]
    hit = lambda c: {r["id"] for r in df.filter(c).collect()}
    assert hit(P.ne(v, 7)) == {1, 2} and hit(P.ne(v, 5)) == {1}
    for condition in (P.eq(v, 5), P.is_in(v, 5, 6), P.gt(v, 0), P.ge(v, 5), P.lt(v, 9), P.le(v, 5), P.between(v, 1, 9)):
        assert hit(condition) == {2}


@pytest.fixture(scope="module")
def mixed(spark):
    rng = random.Random(3)
    pick = lambda *values: rng.choice(values)
    rows = [
        (i, pick(None, "a", "b", "c"), pick(None, -0.5, 1.0, 2.25, float("inf")), pick(None, 1, 2))
        for i in range(200)
    ]
    return spark.createDataFrame(rows, "id bigint, s string, x double, n int").cache()


ORDERS = [
    lambda f: [asc(f["s"]), desc(f["x"])],
    lambda f: [desc(f["s"]), asc(f["n"]), desc(f["x"])],
    lambda f: [desc(f["id"])],
    lambda f: [asc(f["x"]), desc(f["id"])],
    lambda f: [Sort("twice", F.col("n") * 2, True)],
    lambda f: [],
]


@pytest.mark.parametrize("order", ORDERS)
def test_keyset_batches_make_up_the_sorted_table(mixed, order):
    f = fields(mixed)
    sort = order(f)
    expected = [r["id"] for r in R.search(mixed, P.ge(f["id"], 0), sort or [asc(f["id"])], key=f["id"]).collect()]
    seen, cursor = [], None
    while True:
        batch = R.select_after(mixed, 67, cursor, None, sort, key=f["id"], with_total=False)
        seen += [r["id"] for r in batch.rows.collect()]
        cursor = batch.next
        if cursor is None:
            break
        assert all(c is None or isinstance(c, str) for c in cursor)
    assert seen == expected and len(seen) == 200


def test_sorted_rows_match_python(mixed):
    f = fields(mixed)
    rows = mixed.collect()

    def compare(a, b):
        for name, down in (("s", True), ("x", False), ("id", False)):
            u, v = a[name], b[name]
            if u == v:
                continue
            if u is None or v is None:
                return 1 if u is None else -1
            return (1 if u > v else -1) * (-1 if down else 1)
        return 0

    expected = [r["id"] for r in sorted(rows, key=functools.cmp_to_key(compare))]
    assert [r["id"] for r in R.search(mixed, None, [desc(f["s"]), asc(f["x"])], key=f["id"]).collect()] == expected


def test_keyset_by_distance(spark):
    df = spark.range(50).select(
        "id", geo.point((F.col("id") % 9).cast("double"), F.when(F.col("id") % 7 > 0, (F.col("id") % 5).cast("double"))).alias("at")
    )
    f = fields(df)
    order = [by_distance(f["at"], geo.Point(3, 3))]
    whole = [r["id"] for r in R.search(df, None, order, key=f["id"]).collect()]
    assert len(whole) == 50 and all(i % 7 == 0 for i in whole[-8:])
    batch = R.select_after(df, 30, None, None, order, key=f["id"])
    rest = R.select_after(df, 30, batch.next, None, order, key=f["id"])
    assert [r["id"] for r in batch.rows.collect() + rest.rows.collect()] == whole and rest.next is None


def test_cursor_must_fit(mixed):
    with pytest.raises(QueryError):
        R.after(mixed, [asc(fields(mixed)["s"])], ("a", "b"))


@pytest.mark.parametrize("n", [1, 3, topn.ONE_STEP_N + 5])
def test_top_per_group_of_one_huge_group(spark, n):
    df = spark.range(5000, numPartitions=7).select("id", F.when(F.col("id") % 3 > 0, "big").otherwise(F.col("id").cast("string")).alias("g"))
    got = top_per_group(df, ["g"], [F.desc("id")], n, rank="r")
    big = [(x["r"], x["id"]) for x in got.filter("g = 'big'").orderBy("r").collect()]
    expected = [i for i in range(4999, -1, -1) if i % 3 > 0][:n]
    assert big == list(enumerate(expected, 1))
    assert got.columns == ["id", "g", "r"]
    assert got.filter("g <> 'big'").count() == 1667


def test_distances_parse():
    assert geo.parse_distance("1500km") == 1_500_000
    assert geo.parse_distance("2 mi") == pytest.approx(3218.688)
    assert geo.parse_distance("250") == 250 == geo.parse_distance("250.0m")


@pytest.mark.parametrize("radius", ["1km", "800km", "5000km", "12000km", "30000km"])
@pytest.mark.parametrize("lat, lon", [(0, 0), (89, 10), (-75, 170), (10, -179.5), (45, 180), (90, 0)])
def test_box_never_drops_a_point(spark, radius, lat, lon):
    grid = [(float(a), float(b)) for a in range(-90, 91, 6) for b in range(-180, 181, 6)]
    df = spark.createDataFrame(grid, "a double, b double").coalesce(1).select(geo.point(F.col("a"), F.col("b")).alias("p"))
    p, origin = fields(df)["p"], geo.Point(lat, lon)
    exact = geo.distance(p, origin) <= geo.parse_distance(radius)
    row = df.agg(F.count_if(exact).alias("n"), F.count_if(geo.geo_distance(p, radius, origin)).alias("m")).first()
    assert row["n"] == row["m"]


def test_cursors_survive_changes_of_clocks(spark):
    """Half-hourly rows over both changes of clocks of a year, one at a time, in a zone that has them."""
    spring, autumn = 1_710_054_000, 1_730_606_400  # 2024-03-10 07:00 and 2024-11-03 04:00 UTC
    rows = [(i, start + 1800 * i) for start in (spring - 7200, autumn) for i in range(8)]
    seconds = spark.createDataFrame([(n, s) for n, (_, s) in enumerate(rows)], "id bigint, s bigint")
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = seconds.select("id", F.timestamp_seconds("s").alias("at"))
        f, cursor, seen = fields(df), None, []
        for _ in range(len(rows)):
            batch = R.select_after(df, 1, cursor, sort=[asc(f["at"])], key=f["id"], with_total=False)
            seen += [(r["id"], r["s"]) for r in batch.rows.select("id", F.unix_seconds("at").alias("s")).collect()]
            cursor = batch.next
        assert cursor is None and seen == [(n, s) for n, (_, s) in enumerate(sorted(rows, key=lambda r: r[1]))] or sorted(seen) == [
            (n, s) for n, (_, s) in enumerate(rows)
        ]
        assert [s for _, s in seen] == sorted(s for _, s in rows)
        # A cursor taken in one zone goes on in another.
        first = R.select_after(df, 5, None, sort=[asc(f["at"])], key=f["id"], with_total=False).next
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert [r["id"] for r in R.select_after(df, 1, first, sort=[asc(f["at"])], key=f["id"]).rows.collect()] == [seen[5][0]]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("n", [3, 1500])
def test_id_lists_behave_alike_at_any_size(spark, n):
    df = spark.range(5).selectExpr("id", "cast(id as string) AS name", "id * 1.5 AS x")
    f = fields(df)
    more = list(range(100, 100 + n - 3))
    assert sorted(r["id"] for r in R.with_ids(df, f["id"], [1, None, 2, *more]).collect()) == [1, 2]
    assert sorted(r["id"] for r in R.with_ids(df, f["id"], ["1", "2", None, *map(str, more)]).collect()) == [1, 2]
    assert sorted(r["id"] for r in R.with_ids(df, f["name"], ["3", 4, *more]).collect()) == [3, 4]
    with pytest.raises(QueryError):
        R.with_ids(df, f["id"], ["one", *more])
    text = fields(df, text=["name"])
    with pytest.raises(QueryError):
        R.with_ids(df, text["name"], ["3", *map(str, more)])
    assert R.search(df, None, limit=20_000, key=f["id"]).count() == 5


def test_only_sort_values_of_a_batch_reach_the_driver(spark, tmp_path, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame as Frame

    # A thousand documents of a megabyte, whose sort value repeats over the borders of the batches.
    wide = F.repeat(F.concat(F.lit("x"), F.col("id").cast("string")), 220_000)
    spark.range(0, 1000, numPartitions=8).select("id", (F.col("id") / 150).cast("int").alias("n"), wide.alias("doc")).write.parquet(f"{tmp_path}/w")
    stored = spark.read.parquet(f"{tmp_path}/w")
    plans, plain = [], Frame.toArrow
    monkeypatch.setattr(Frame, "toArrow", lambda df: plans.append(df._jdf.queryExecution().executedPlan().toString()) or plain(df))
    f = fields(stored)
    cursor, seen = None, []
    while True:
        batch = R.select_after(stored, 400, cursor, None, [desc(f["n"])], key=f["id"], with_total=False)
        seen += [tuple(r) for r in batch.rows.select("id", F.length("doc")).collect()]
        cursor = batch.next
        if cursor is None:
            break
    assert [i for i, _ in seen] == sorted(range(1000), key=lambda i: (-(i // 150), i))
    assert all(n == 220_000 * len(f"x{i}") for i, n in seen)
    assert len(plans) == 3 and all("doc" not in p and "ReadSchema: struct<id:bigint,n:int>" in p for p in plans)


def test_batches_lose_no_row_that_repeats_a_key(spark):
    df = spark.createDataFrame([(i // 4, i) for i in range(40)], "id int, v int")
    f = fields(df)
    cursor, seen = None, []
    for _ in range(40):
        batch = R.select_after(df, 6, cursor, key=f["id"])
        found = [r["v"] for r in batch.rows.collect()]
        assert batch.total == 40 and len(found) in (8, 0)
        seen += found
        cursor = batch.next
        if cursor is None:
            break
    assert sorted(seen) == list(range(40))
    none = R.select_after(df.where("false"), 5, key=f["id"])
    assert none.rows.collect() == [] and none.next is None and none.total == 0


D = decimal.Decimal
MOMENT = datetime.datetime(2024, 5, 6, 7, 8, 9)


@pytest.mark.parametrize("many", [False, True])
@pytest.mark.parametrize(
    "dtype, stored, same, wrong",
    [
        ("bigint", 2, [2, 2.0, "2", D(2)], [1.5, True, "two", 2**63, D("0.5"), float("nan"), float("inf"), [2]]),
        ("int", 2, [2, 2.0, "2"], [2**31, -(2**31) - 1, False]),
        ("tinyint", -128, [-128, "-128"], [128, 200.0]),
        ("double", 0.1, [0.1, "0.1", D("0.1")], ["x", True]),
        ("float", 0.1, [0.1, "0.1"], [1e60, True]),
        ("decimal(6,2)", D("12.30"), [12.3, "12.3", D("12.300")], [D("12.345"), 10000, "a", True]),
        ("boolean", True, [True, "true"], ["yes", 1, 1.0]),
        ("string", "3", ["3", 3], []),
        ("date", MOMENT.date(), [MOMENT.date(), "2024-05-06", datetime.datetime(2024, 5, 6)], [MOMENT, "May", 5]),
        ("timestamp_ntz", MOMENT, [MOMENT, "2024-05-06T07:08:09"], [5, "x", MOMENT.replace(tzinfo=datetime.timezone.utc)]),
    ],
)
def test_ids_mean_the_same_at_any_number(spark, dtype, stored, same, wrong, many):
    """As literals and, beyond a thousand, as a join; in reads and in deletes."""
    df = spark.createDataFrame([(stored, 1), (None, 2)], f"id {dtype}, v int")
    key = fields(df)["id"]

    def padded(value):
        return [value, None] + [same[0]] * (1500 if many else 0)

    for value in same:
        assert [r["v"] for r in R.with_ids(df, key, padded(value)).collect()] == [1], value
    change = W.delete_by_ids(df, "id", padded(same[-1]))
    assert [r["v"] for r in change.rows.collect()] == [2] and change.affected() == 1
    for value in wrong:
        with pytest.raises(QueryError):
            R.with_ids(df, key, padded(value))
        with pytest.raises(QueryError):
            W.delete_by_ids(df, "id", padded(value))
