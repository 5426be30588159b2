from __future__ import annotations

import datetime

import pytest
from pyspark.sql import types as T

from quern.functions.fields import ANALYZER, fields
from quern.session import local_session

TESTDATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = local_session(
        "4",
        4,
        **{
            "spark.sql.warehouse.dir": str(folder / "warehouse"),
            "spark.checkpoint.dir": str(folder / "checkpoints"),
        },
    )
    yield session
    session.stop()


SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("productName", T.StringType()),
        T.StructField("description", T.StringType(), True, {ANALYZER: "standard"}),
        T.StructField("price", T.DoubleType()),
        T.StructField("stock", T.IntegerType()),
        T.StructField("launchDate", T.DateType()),
        T.StructField("onSale", T.BooleanType()),
        T.StructField(
            "location", T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())])
        ),
        T.StructField(
            "skus",
            T.ArrayType(
                T.StructType(
                    [
                        T.StructField("skuCode", T.StringType()),
                        T.StructField("spec", T.StringType()),
                        T.StructField("quantity", T.IntegerType()),
                    ]
                )
            ),
        ),
    ]
)
DAY = datetime.date
ROWS = [
    (90001, "机械键盘 K870", "客制化机械键盘 红轴", 399.0, 100, DAY(2026, 1, 15), True, (39.90, 116.40), [("SKU-A1", "红轴 87键", 60)]),
    (90002, "无线鼠标 M590", "静音无线鼠标 办公首选", 129.5, 50, DAY(2026, 3, 1), True, (31.23, 121.47), [("SKU-B2", "静音款", 80)]),
    (90003, "显示器 U2723", "4K 专业显示器", 2899.0, 10, DAY(2026, 6, 20), False, (22.54, 114.06), [("SKU-C3", "4K", 5), ("SKU-D4", "2K", 10)]),
]
FOURTH = (90004, "机械键盘 K870", "客制化机械键盘 茶轴", 459.0, 80, DAY(2026, 2, 10), True, None, None)


@pytest.fixture(scope="session")
def products(spark):
    return spark.createDataFrame(ROWS, SCHEMA).cache()


@pytest.fixture(scope="session")
def four_products(spark):
    return spark.createDataFrame([*ROWS, FOURTH], SCHEMA).cache()


@pytest.fixture(scope="session")
def f(products):
    return fields(products)


def ids(df):
    return [r["id"] for r in df.select("id").collect()]
