"""Inserts, updates and deletes."""

import pytest
from pyspark.sql import functions as F

from quern.errors import QueryError
from quern.functions import predicates as P
from quern.functions.fields import fields
from quern.operators import writes as W
from tests.conftest import ids


def by_id(df):
    return {r["id"]: r for r in df.collect()}


def counts(change):
    return change.counts.first().asDict()


@pytest.fixture(scope="module")
def stock(spark):
    return spark.createDataFrame([(1, "a", 10), (2, "b", None), (3, None, 30)], "id bigint, name string, n int")


def test_upsert(spark, stock):
    batch = spark.createDataFrame([(2, "x", 1), (4, "y", 2), (2, "z", 3), (4, "w", 1)], "id bigint, name string, o int")
    change = W.upsert(stock, batch, "id", "o")
    rows = by_id(change.rows)
    assert (rows[2]["name"], rows[2]["n"], rows[4]["name"]) == ("z", None, "y")
    assert set(rows) == {1, 2, 3, 4} and rows[3]["n"] == 30
    assert counts(change) == {"affected": 2, "created": 1, "updated": 1} and change.affected() == 2
    assert W.upsert(stock, batch.limit(0), "id", "o").affected() == 0


def test_upsert_refuses(spark, stock):
    repeated = spark.createDataFrame([(2, "x"), (2, "y")], "id bigint, name string")
    with pytest.raises(Exception, match="repeats"):
        W.upsert(stock, repeated, "id").rows.collect()
    keyless = spark.createDataFrame([(None, "x")], "id bigint, name string")
    with pytest.raises(Exception, match="has no id"):
        W.upsert(stock, keyless, "id").rows.collect()
    with pytest.raises(QueryError):
        W.upsert(stock, spark.createDataFrame([(1, 2)], "id bigint, colour int"), "id")


def test_delete(spark, stock):
    change = W.delete_by_ids(stock, "id", [1, 9, 1, None])
    assert set(ids(change.rows)) == {2, 3} and change.affected() == 1
    assert W.delete_by_ids(stock, "id", []).affected() == 0
    many = W.delete_by_ids(stock, "id", range(3, 2003))
    assert set(ids(many.rows)) == {1, 2} and many.affected() == 1
    frame = spark.createDataFrame([(1,), (1,), (7,)], "k bigint")
    change = W.delete_by_ids(stock, "id", frame)
    assert set(ids(change.rows)) == {2, 3} and change.affected() == 1


def test_delete_where(stock, products, f):
    change = W.delete_where(products, P.eq(f["onSale"], False))
    assert change.affected() == 1 and set(ids(change.rows)) == {90001, 90002}
    # unknown is not a match
    assert set(ids(W.delete_where(stock, P.gt(fields(stock)["n"], 5)).rows)) == {2}
    for empty in (None, P.match_all(), P.all_of(P.any_of(), None)):
        with pytest.raises(QueryError):
            W.delete_where(stock, empty)


def test_update_by_id(stock):
    change = W.update_by_id(stock, "id", 2, {"id": 2, "name": None, "n": 5})
    assert tuple(by_id(change.rows)[2]) == (2, "b", 5) and change.affected() == 1
    assert W.update_by_id(stock, "id", 99, {"n": 5}).affected() == 0
    # What changes nothing does not count.
    assert W.update_by_id(stock, "id", 1, {}).affected() == W.update_by_id(stock, "id", 1, {"name": "a", "n": 10}).affected() == 0
    with pytest.raises(QueryError):
        W.update_by_id(stock, "id", 2, {"colour": 1})
    with pytest.raises(QueryError):
        W.update_by_id(stock, "id", None, {"n": 1})


def test_update_batch(spark, stock, products):
    patches = spark.createDataFrame(
        [(1, "p", None, 1), (1, None, 7, 2), (3, "q", 1, 1), (3, "r", None, 2), (3, None, None, 3)],
        "id bigint, name string, n int, o int",
    )
    change = W.update_batch(stock, patches, "id", "o")
    rows = {k: tuple(v) for k, v in by_id(change.rows).items()}
    assert rows == {1: (1, "p", 7), 2: (2, "b", None), 3: (3, "r", 1)} and change.affected() == 2
    assert change.rows.columns == stock.columns
    assert W.update_batch(stock, patches.limit(0), "id", "o").affected() == 0
    two = spark.createDataFrame([(90001, 459.0, None), (90002, None, 999)], "id bigint, price double, stock int")
    rows = by_id(W.update_batch(products, two, "id").rows)
    assert (rows[90001]["price"], rows[90001]["stock"]) == (459.0, 100)
    assert (rows[90002]["price"], rows[90002]["stock"]) == (129.5, 999)


def test_update_batch_refuses(spark, stock):
    unknown = spark.createDataFrame([(77, 1)], "id bigint, n int")
    with pytest.raises(QueryError):
        W.update_batch(stock, unknown, "id")
    assert W.update_batch(stock, unknown, "id", strict=False).affected() == 0
    with pytest.raises(Exception, match="has no id"):
        W.update_batch(stock, spark.createDataFrame([(None, 1)], "id bigint, n int"), "id")
    with pytest.raises(Exception, match="repeats"):
        W.update_batch(stock, spark.createDataFrame([(1, 1), (1, 2)], "id bigint, n int"), "id")


def test_update_where(products, f):
    change = W.update_where(products, P.eq(f["onSale"], True), {"price": 500.0})
    rows = by_id(change.rows)
    assert [rows[i]["price"] for i in (90001, 90002, 90003)] == [500.0, 500.0, 2899.0] and change.affected() == 2
    assert rows[90001]["stock"] == 100
    c3 = W.update_where(products, P.nested(f["skus"], lambda s: P.eq(s["skuCode"], "SKU-C3")), {"stock": 1, "price": None})
    assert [by_id(c3.rows)[i]["stock"] for i in (90001, 90002, 90003)] == [100, 50, 1] and c3.affected() == 1
    some = P.eq(f["onSale"], True)
    for wrong in (lambda: W.update_where(products, None, {"price": 1.0}), lambda: W.update_where(products, some, {}),
                  lambda: W.update_where(products, some, None), lambda: W.update_where(products, some, {"price": None})):
        with pytest.raises(QueryError):
            wrong()


def test_update_to_int_keeps_type(stock):
    assert W.update_where(stock, F.lit(True), {"n": "12"}).rows.schema["n"].dataType == stock.schema["n"].dataType
