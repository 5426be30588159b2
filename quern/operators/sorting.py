"""Sort keys. Rows without a value come last in both directions."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from quern.errors import QueryError
from quern.functions import geo
from quern.functions.fields import Field, Fields


@dataclass(frozen=True, eq=False)
class Sort:
    name: str
    expr: Column
    descending: bool = False

    @property
    def column(self) -> Column:
        return self.expr.desc_nulls_last() if self.descending else self.expr.asc_nulls_last()


def asc(field: Field) -> Sort:
    return Sort(field.name, field.col)


def desc(field: Field) -> Sort:
    return Sort(field.name, field.col, descending=True)


def by_distance(field: Field, origin: geo.Point, descending: bool = False) -> Sort:
    return Sort(f"distance({field.name})", geo.distance(field, origin), descending)


def by_nested(
    field: Field,
    *child: str,
    descending: bool = False,
    where: Callable[[Fields], Column] | None = None,
) -> Sort:
    """By a field of the children: their smallest value ascending, their largest descending.

    ``child`` is a path when children are nested further. With ``where`` only children that meet it
    count; rows with none come last.
    """
    if not child:
        raise QueryError("by_nested needs the name of a child field")
    values = _values(field, child, where)
    best = F.array_max(values) if descending else F.array_min(values)
    return Sort(".".join((field.name, *child)), best, descending)


def _values(field: Field, path: tuple[str, ...], where: Callable[[Fields], Column] | None) -> Column:
    if not field.is_nested:
        raise QueryError(f"{field.name} is not a nested field")
    children = field.col
    if where is None and len(path) == 1:
        field.children_of(children)[path[0]]  # raises on unknown names
        return children[path[0]]  # the scan reads only this child field
    if where is not None:
        children = F.filter(children, lambda c: where(field.children_of(c)))
    if len(path) == 1:
        return F.transform(children, lambda c: field.children_of(c)[path[0]].col)
    return F.flatten(F.transform(children, lambda c: _values(field.children_of(c)[path[0]], path[1:], None)))


def columns(sorts) -> list[Column]:
    return [s.column for s in sorts]
