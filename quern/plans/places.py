"""Geo predicates and sorts over customers, placed on a grid computed from their keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import geo
from quern.functions import predicates as P
from quern.functions.fields import fields
from quern.operators.nearest import cell_counts, select_nearest
from quern.operators.reads import search
from quern.operators.sorting import by_distance
from quern.plans.tables import table


def customers(spark: SparkSession, directory: str) -> DataFrame:
    key = F.col("c_custkey")
    lat = (key * 37 % 180 - 90).cast("double") + 0.25
    lon = (key * 91 % 360 - 180).cast("double") + 0.5
    return table(spark, directory, "customer").withColumn("place", geo.point(lat, lon))


PLACED = """
WITH placed AS (SELECT *, (c_custkey * 37) % 180 - 90 + 0.25::DOUBLE AS lat, (c_custkey * 91) % 360 - 180 + 0.5::DOUBLE AS lon
                FROM customer)
"""


def metres(lat: float, lon: float) -> str:
    return (
        f"2 * 6371008.7714 * asin(sqrt(least(1.0, pow(sin(radians(lat - {lat}) / 2), 2)"
        f" + cos(radians({lat})) * cos(radians(lat)) * pow(sin(radians(lon - {lon}) / 2), 2))))"
    )


def distances(spark: SparkSession, directory: str) -> DataFrame:
    c = customers(spark, directory)
    away = geo.distance(fields(c)["place"], geo.Point(22.54, 114.06))
    return c.select("c_custkey", F.round(away, 1).alias("metres"))


def valid(spark: SparkSession, directory: str) -> DataFrame:
    """Coordinates off the map become missing points when the check is not strict."""
    key = F.col("c_custkey")
    lat, lon = (key % 200 - 95).cast("double"), (key % 370 - 185).cast("double")
    c = table(spark, directory, "customer").withColumn("place", geo.point(lat, lon, strict=False))
    return c.filter(P.is_null(fields(c)["place"])).select("c_custkey", "c_name")


def within(radius: str, origin: geo.Point):
    def query(spark: SparkSession, directory: str) -> DataFrame:
        c = customers(spark, directory)
        return c.filter(geo.geo_distance(fields(c)["place"], radius, origin)).select("c_custkey", "c_name")

    return query


def within_sql(limit: float, lat: float, lon: float) -> str:
    return PLACED + f"SELECT c_custkey, c_name FROM placed WHERE {metres(lat, lon)} <= {limit}"


def nearest(spark: SparkSession, directory: str) -> DataFrame:
    c = customers(spark, directory)
    f = fields(c)
    order = [by_distance(f["place"], geo.Point(39.9, 116.4))]
    found = search(c, P.gt(f["c_acctbal"], 0.0), order, limit=50, key=f["c_custkey"])
    return found.select("c_custkey", "c_name")


def nearest_by_cells(stored: bool):
    """The same from a box that counts per cell bound, taken now or in two batches before."""

    def query(spark: SparkSession, directory: str) -> DataFrame:
        c = customers(spark, directory)
        f = fields(c)
        rich = P.gt(f["c_acctbal"], 0.0)
        batches = [cell_counts(c, f["place"], rich & (F.col("c_custkey") % 2 == n)) for n in (0, 1)]
        found = select_nearest(
            c, f["place"], geo.Point(39.9, 116.4), 50, f["c_custkey"], rich, batches[0].union(batches[1]) if stored else None
        )
        return found.select("c_custkey", "c_name")

    return query


def farthest_in_reach(spark: SparkSession, directory: str) -> DataFrame:
    c = customers(spark, directory)
    f = fields(c)
    origin = geo.Point(-33.87, 151.21)
    order = [by_distance(f["place"], origin, descending=True)]
    found = search(c, geo.geo_distance(f["place"], "2000mi", origin), order, limit=20, key=f["c_custkey"])
    return found.select("c_custkey", "c_name")


NEAREST = PLACED + f"SELECT c_custkey, c_name FROM placed WHERE c_acctbal > 0 ORDER BY {metres(39.9, 116.4)}, c_custkey LIMIT 50"

QUERIES = {
    "SRT2_nearest_by_cells": (nearest_by_cells(False), NEAREST),
    "SRT2_nearest_by_stored_cells": (nearest_by_cells(True), NEAREST),
    "GEO1_distance": (
        distances,
        PLACED + f"SELECT c_custkey, round({metres(22.54, 114.06)}, 1) AS metres FROM placed",
    ),
    "GEO2_range_check": (
        valid,
        "SELECT c_custkey, c_name FROM customer"
        " WHERE c_custkey % 200 - 95 NOT BETWEEN -90 AND 90 OR c_custkey % 370 - 185 NOT BETWEEN -180 AND 180",
    ),
    "P10_GEO3_geo_distance": (
        within("1500km", geo.Point(39.9, 116.4)),
        within_sql(1500000.0, 39.9, 116.4),
    ),
    "P10_geo_distance_date_line": (
        within("1200mi", geo.Point(-17.7, 178.0)),
        within_sql(1200 * 1609.344, -17.7, 178.0),
    ),
    "P10_geo_distance_pole": (
        within("900nmi", geo.Point(84.0, 20.0)),
        within_sql(900 * 1852.0, 84.0, 20.0),
    ),
    "SRT2_GEO4_order_by_distance": (
        nearest,
        PLACED + f"SELECT c_custkey, c_name FROM placed WHERE c_acctbal > 0 ORDER BY {metres(39.9, 116.4)}, c_custkey LIMIT 50",
    ),
    "SRT2_farthest_in_reach": (
        farthest_in_reach,
        PLACED
        + f"SELECT c_custkey, c_name FROM placed WHERE {metres(-33.87, 151.21)} <= 2000 * 1609.344"
        f" ORDER BY {metres(-33.87, 151.21)} DESC, c_custkey LIMIT 20",
    ),
}
