"""Schemas, name mapping, published versions."""

import dataclasses
import datetime
import decimal
import enum
import re
import typing
import uuid
from dataclasses import dataclass, field

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.errors import QueryError
from quern.functions import geo
from quern.sources import schema as S
from quern.sources import versions as V
from tests.conftest import ROWS, ids


class Colour(enum.Enum):
    RED = 1


@dataclass
class Sku:
    skuCode: str
    quantity: S.Integer = field(metadata={"stored": "qty"})


@dataclass
class Product:
    id: int
    productName: str = field(metadata={"stored": "product_name"})
    description: typing.Annotated[str, S.Text()]
    price: decimal.Decimal
    stock: S.Integer
    skus: list[Sku]
    main: Sku | None = None
    cached: str = field(default="", metadata={"exist": False})


@dataclass
class Types:
    keywordField: str
    textField: typing.Annotated[str, S.Text("ik_max_word")]
    longField: S.Long
    intField: S.Integer
    shortField: S.Short
    byteField: S.Byte
    floatField: S.Float
    doubleField: float
    decimalField: decimal.Decimal
    boolField: bool
    dateField: datetime.date
    momentField: datetime.datetime
    timeField: datetime.time
    uuidField: uuid.UUID
    enumField: Colour
    placeField: geo.Point
    key: int = field(metadata={"key": True})


def test_derived_types():
    derived = S.derive(Types)
    found = {f.name: f.dataType.simpleString() for f in derived.fields}
    assert found == {
        "keywordField": "string", "textField": "string", "longField": "bigint", "intField": "int",
        "shortField": "smallint", "byteField": "tinyint", "floatField": "float", "doubleField": "double",
        "decimalField": "double", "boolField": "boolean", "dateField": "date", "momentField": "timestamp",
        "timeField": "time(6)", "uuidField": "string", "enumField": "string",
        "placeField": "struct<lat:double,lon:double>", "key": "bigint",
    }
    assert derived["textField"].metadata == {"analyzer": "ik_max_word"}
    assert S.key_of(derived) == "key"


def test_derived_names_and_children():
    derived = S.derive(Product)
    assert S.key_of(derived) == "id" and "cached" not in derived.fieldNames()
    stored = S.stored_schema(derived)
    assert stored.fieldNames() == ["id", "product_name", "description", "price", "stock", "skus", "main"]
    assert stored["skus"].dataType.simpleString() == "array<struct<skuCode:string,qty:int>>" == stored["main"].dataType.simpleString()


def test_refused_declarations():
    Loop = dataclasses.make_dataclass("Loop", [("id", int), ("items", list["Loop"])])
    cases = [
        dataclasses.make_dataclass("Listed", [("id", int), ("tags", list[str])]),
        dataclasses.make_dataclass("Keyless", [("name", str)]),
        dataclasses.make_dataclass("TwoKeys", [("a", int, field(metadata={"key": True})), ("b", int, field(metadata={"key": True}))]),
        dataclasses.make_dataclass("Odd", [("id", int), ("x", dict)]),
        int,
    ]
    for case in cases:
        with pytest.raises(QueryError):
            S.derive(case)
    Loop.__annotations__["items"] = list[Loop]
    with pytest.raises(QueryError, match="cycle"):
        S.derive(Loop)


def test_mapping_both_ways(spark):
    derived = S.derive(Product)
    rows = [(1, "n", "d", 1.5, 2, [("A", 7)], None), (2, None, None, None, None, None, [("B", 1)])]
    df = spark.createDataFrame(rows, derived)
    stored = S.to_stored(df, derived)
    assert stored.schema.simpleString() == S.stored_schema(derived).simpleString()
    assert stored.filter("skus[0].qty = 7").count() == 1
    back = S.from_stored(stored, derived)
    assert back.schema.simpleString() == df.schema.simpleString()
    assert sorted(map(str, back.collect())) == sorted(map(str, df.collect()))
    assert back.schema["description"].metadata["analyzer"] == "standard"
    assert S.from_stored(stored.drop("price"), derived).filter("price IS NULL").count() == 2


def test_conformance(spark):
    declared = T.StructType().add("a", "long").add("b", "string").add("c", "date")
    df = spark.createDataFrame([(1, "x", 2.0)], "a int, b string, extra double")
    rows = [tuple(r) for r in S.check(df, declared).collect()]
    assert rows == [("a", "type differs", "bigint", "int"), ("c", "missing", "date", None)]
    with pytest.raises(QueryError):
        S.check(df, declared, policy="fail")
    with pytest.raises(QueryError):
        S.check(df, declared, policy="ignore")
    fixed = S.conform(df, declared)
    assert S.check(fixed, declared, policy="fail").count() == 0
    assert tuple(fixed.first()) == (1, "x", None)


def test_arrays_of_structs_are_no_other_arrays(spark):
    have = spark.sql("SELECT array('a') AS skus, array(named_struct('x', 1)) AS lines").schema
    children = T.ArrayType(T.StructType([T.StructField("skuCode", T.StringType())]))
    declared = T.StructType([T.StructField("skus", children), T.StructField("lines", children)])
    assert [m["column"] for m in S.mismatches(have, declared)] == ["skus"]


def test_conform_goes_by_name_inside_children(spark):
    df = spark.createDataFrame([(1, [(5, "a")])], "id int, c array<struct<n:int,s:string>>")
    declared = T.StructType.fromDDL("id bigint, c array<struct<s:string,n:bigint,z:date>>")
    assert S.conform(df, declared).first()["c"][0].asDict() == {"s": "a", "n": 5, "z": None}


def test_bad_casts_raise(spark):
    df = spark.createDataFrame([("x",)], "a string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        S.conform(df, T.StructType().add("a", "long")).collect()


def test_create_if_absent(spark):
    declared = T.StructType().add("a", "long").add("b", "string", True, {"analyzer": "standard"})
    assert S.create_if_absent(spark, "fresh_table", declared) is None
    assert spark.table("fresh_table").count() == 0
    assert spark.table("fresh_table").schema["b"].metadata["analyzer"] == "standard"
    assert S.create_if_absent(spark, "fresh_table", declared).count() == 0
    with pytest.raises(QueryError):
        S.create_if_absent(spark, "fresh_table", T.StructType().add("a", "string"), policy="fail")


# ---- versions ----


@pytest.fixture
def name(spark):
    return f"t{uuid.uuid4().hex[:10]}"


def test_version_names():
    at = datetime.datetime(2026, 1, 2, 3, 4, 5, 67000)
    assert V.version_name("product", at) == "product_20260102030405067"
    assert re.fullmatch(r"product_\d{17}", V.version_name("product"))


def test_reindex(spark, products, name):
    products.write.saveAsTable(name)
    report = V.reindex(spark, name, name + "_copy", "id")
    assert (report.total, report.created, report.updated, report.conflicts) == (3, 3, 0, 0)
    again = V.reindex(spark, name, name + "_copy", "id")
    assert (again.total, again.created, again.updated) == (3, 0, 3)
    assert set(ids(spark.table(name + "_copy"))) == {90001, 90002, 90003}
    with pytest.raises(QueryError):
        V.reindex(spark, "nowhere", name, "id")


def test_reindex_into_published(spark, products, name):
    products.filter("id < 90003").write.saveAsTable(name + "_src")
    V.rebuild(spark, name, products.schema)
    report = V.reindex(spark, name + "_src", name, "id")
    assert (report.total, report.created) == (2, 2)
    assert len(V.versions_of(spark, name)) == 1 and set(ids(spark.table(name))) == {90001, 90002}


def test_rebuild_of_a_plain_table(spark, products, name):
    products.write.saveAsTable(name)
    built = V.rebuild(spark, name, products.schema)
    assert (built.previous, built.rows) == (name, 3) and V.versions_of(spark, name) == [built.version]
    assert set(ids(spark.table(name))) == {r[0] for r in ROWS}


def test_rebuild_of_a_published_version(spark, four_products, name):
    first = V.rebuild(spark, name, four_products.schema)
    assert (first.previous, first.rows) == (None, 0) and spark.table(name).count() == 0
    V.publish(spark, name, [V.write_version(four_products, name)])
    spark.sql(f"DROP TABLE {first.version}")
    (before,) = V.versions_of(spark, name)
    wider = T.StructType([f if f.name != "stock" else T.StructField("stock", T.LongType()) for f in four_products.schema])
    second = V.rebuild(spark, name, wider)
    assert (second.previous, second.rows) == (before, 4)
    assert not spark.catalog.tableExists(before)
    assert spark.table(name).schema["stock"].dataType == T.LongType()
    assert V.versions_of(spark, name) == [second.version]


def test_rebuild_refuses_several_versions(spark, products, name):
    parts = []
    for i in range(2):
        products.filter(F.col("id") % 2 == i).write.saveAsTable(f"{name}_{i}")
        parts.append(f"{name}_{i}")
    V.publish(spark, name, parts)
    assert spark.table(name).count() == 3
    tables = {t.name for t in spark.catalog.listTables()}
    with pytest.raises(QueryError):
        V.rebuild(spark, name, products.schema)
    assert {t.name for t in spark.catalog.listTables()} == tables and V.versions_of(spark, name) == parts


def test_scan(spark, products, name, tmp_path):
    products.write.saveAsTable(name)
    products.write.parquet(f"{tmp_path}/files")
    assert V.scan(spark, name).count() == 3 == V.scan(spark, f"{tmp_path}/files").count()
