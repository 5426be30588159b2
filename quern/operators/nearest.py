"""The nearest points, without working out every distance.

Points are counted per cell of latitude and longitude. The cells closest to the origin that hold enough points together
give a radius that surely holds the nearest ones, and a box of that radius reaches the scan. The counts are one pass over
the coordinates, or a small stored table: counts are sums, so those of appended rows can simply be appended.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.errors import QueryError
from quern.functions import geo
from quern.functions import predicates as P
from quern.functions.fields import Field
from quern.operators.reads import check_limit, search
from quern.operators.sorting import by_distance

# Degrees to a side of a cell; there are at most 64,800.
SIDE = 1.0
CELLS = "lat_cell int, lon_cell int, points bigint"


def cell_counts(df: DataFrame, field: Field, condition: Column | None = None) -> DataFrame:
    """lat_cell, lon_cell, points: the number of points per cell; rows without a point are in none."""
    geo.check_point(field)
    lat, lon = field.col.getField("lat"), field.col.getField("lon")
    cells = P.where(df, condition).select(_cell(lat, 90).alias("lat_cell"), _cell(lon, 180).alias("lon_cell"))
    return cells.where("lat_cell is not null and lon_cell is not null").groupBy("lat_cell", "lon_cell").agg(F.count("*").alias("points"))


def _cell(degrees: Column, most: int) -> Column:
    """Cells are numbered from the equator and the zero meridian; the last one takes the pole or the date line in."""
    cell = F.least(F.floor(degrees / SIDE), F.lit(int(most / SIDE) - 1)).cast("int")
    return F.when(degrees.isNotNull(), cell)


def radius(cells: DataFrame, origin: geo.Point, k: int) -> float | None:
    """Metres around ``origin`` that hold ``k`` points or more, or None where there are fewer in all.

    At most ``k`` rows come to the driver, as every cell holds a point.
    """
    missing = {c.split()[0] for c in CELLS.split(", ")} - set(cells.columns)
    if missing:
        raise QueryError(f"cell counts have the columns {CELLS}; {sorted(missing)} are missing")
    summed = cells.groupBy("lat_cell", "lon_cell").agg(F.sum("points").alias("points")).where("points > 0")
    middle = F.struct(((F.col("lat_cell") + 0.5) * SIDE).alias("lat"), ((F.col("lon_cell") + 0.5) * SIDE).alias("lon"))
    kind = T.StructType([T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType())])
    # No point of a cell is farther from its middle than half a side along the meridian and half a side along a parallel.
    reach = geo.distance(Field("middle", middle, kind), origin) + geo.EARTH_RADIUS_M * math.radians(SIDE)
    held = 0
    for row in summed.select(reach.alias("reach"), "points").orderBy("reach").limit(k).collect():
        held += row["points"]
        if held >= k:
            return row["reach"]
    return None


def select_nearest(
    df: DataFrame,
    field: Field,
    origin: geo.Point,
    k: int,
    key: Field,
    condition: Column | None = None,
    cells: DataFrame | None = None,
) -> DataFrame:
    """The ``k`` rows that meet ``condition`` nearest to ``origin``, ties by ``key``, rows without a point last.

    The same rows as a search sorted by distance. ``cells`` are stored counts of the rows that meet the condition, all
    of them: too low a count only widens the box, one above the rows that are there may cut rows off.
    """
    geo.check_point(field)
    if k is None:
        raise QueryError("the nearest rows need a number")
    check_limit(k)
    metres = radius(cell_counts(df, field, condition) if cells is None else cells, origin, k)
    if metres is not None:
        # A metre more than the arithmetic of two formulas can differ by.
        condition = P.all_of(condition, geo.geo_distance(field, f"{metres + 1:.3f}m", origin))
    return search(df, condition, [by_distance(field, origin)], k, key=key)
