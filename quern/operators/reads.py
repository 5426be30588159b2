"""Reads: by key, lists, pages, keyset batches, collapse, inner hits.

Functions named ``select_*`` follow the document API: they check limits, and run a job to check a cap or
return values. ``search`` is the plain lazy form, without a cap and with any limit.
"""

from __future__ import annotations

import datetime
import decimal
import math
import struct
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.errors import QueryError
from quern.functions import predicates as P
from quern.functions.fields import Field, Fields
from quern.operators.sorting import Sort, asc, columns
from quern.operators.topn import key_set, top_per_group

# Rows a list may return without an explicit limit; reach of limit, page and batch.
LIST_CAP = 1000
WINDOW = 10000
# Up to this many ids are sent as literals, which reach the scan; more become a join with the same outcome.
MAX_LITERAL_IDS = 1000
# Bits of whole numbers by type name; texts taken as booleans.
WIDTHS = {"byte": 8, "short": 16, "integer": 32, "long": 64}
BOOLEANS = {"true": True, "false": False}


def check_limit(limit: int | None) -> None:
    if limit is not None and not 1 <= limit <= WINDOW:
        raise QueryError(f"limit must be 1 to {WINDOW}, not {limit}")


def check_positive(limit: int | None) -> None:
    if limit is not None and limit < 1:
        raise QueryError(f"limit must be at least 1, not {limit}")


def check_cap(matched: DataFrame, limit: int | None) -> None:
    """Refuse, rather than cut, a list of more than LIST_CAP rows when no limit was set."""
    if limit is None and matched.select(F.lit(1)).limit(LIST_CAP + 1).count() > LIST_CAP:
        raise QueryError(f"more than {LIST_CAP} rows match; set a limit, page through them or use search")


def search(
    df: DataFrame,
    condition: Column | None = None,
    sort: Sequence[Sort] = (),
    limit: int | None = None,
    collapse: Field | None = None,
    key: Field | None = None,
) -> DataFrame:
    """Filter, collapse, sort, limit. ``key`` breaks ties, which makes the outcome repeatable."""
    check_positive(limit)
    out = P.where(df, condition)
    order = columns(_total(sort, key))
    if collapse is not None:
        out = top_per_group(out, [collapse.col], order or [F.lit(1)], 1)
    if order and (sort or limit is not None):
        out = out.orderBy(*order)
    return out if limit is None else out.limit(limit)


def _total(sort: Sequence[Sort], key: Field | None) -> list[Sort]:
    sort = list(sort)
    if key is not None and all(s.name != key.name for s in sort):
        sort.append(asc(key))
    return sort


def select_by_id(df: DataFrame, key: Field, value: Any) -> Row | None:
    return df.filter(P.eq(key, value)).first()


def with_ids(df: DataFrame, key: Field, ids: DataFrame | Iterable[Any]) -> DataFrame:
    """Rows whose key is among ``ids``: a collection, or a one-column DataFrame of any size.

    Ids are taken as values of the key's type; a null id matches nothing.
    """
    if not isinstance(ids, DataFrame):
        ids = as_keys(key, ids)
        if len(ids) <= MAX_LITERAL_IDS:
            return df.filter(P.is_in(key, ids))
        ids = id_frame(df, key, ids)
    elif key.is_text:
        raise QueryError(f"text field {key.name} cannot be compared as a whole")
    wanted = key_set(ids, ids.columns[0], "__id")
    return df.join(wanted, key.col == F.col("__id"), "left_semi")


def as_keys(key: Field, ids: Iterable[Any]) -> list[Any]:
    """Ids as values of the key's type, without nulls. One that is no such value raises, however many there are."""
    if key.is_text:
        raise QueryError(f"text field {key.name} cannot be compared as a whole")
    try:
        return [_as_key(key.dtype, i) for i in ids if i is not None]
    except (ValueError, TypeError, ArithmeticError) as error:
        raise QueryError(f"an id is no {key.dtype.simpleString()}: {error}") from error


def _as_key(dtype: T.DataType, value: Any) -> Any:
    """The value in the key's type, the same whether it is then sent as a literal or as a row."""
    if isinstance(dtype, T.StringType):
        return str(value)
    if isinstance(dtype, T.BooleanType):
        return _one_of({True: True, False: False}, value) if isinstance(value, bool) else _one_of(BOOLEANS, value)
    if isinstance(dtype, T.NumericType):
        if isinstance(value, bool):
            raise ValueError(f"{value!r} is a boolean")
        return _as_number(dtype, value)
    if isinstance(dtype, T.DateType):
        if isinstance(value, datetime.datetime):
            if value.time() != datetime.time():
                raise ValueError(f"{value} is no whole day")
            return value.date()
        return datetime.date.fromisoformat(value) if isinstance(value, str) else _of(datetime.date, value)
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        if isinstance(value, str):
            value = datetime.datetime.fromisoformat(value)
        elif not isinstance(value, datetime.datetime):
            value = datetime.datetime.combine(_of(datetime.date, value), datetime.time())
        if value.tzinfo is not None and isinstance(dtype, T.TimestampNTZType):
            raise ValueError(f"{value} has a time zone")
        return value
    return value


def _as_number(dtype: T.NumericType, value: Any) -> Any:
    if isinstance(dtype, T.IntegralType):
        if isinstance(value, (float, decimal.Decimal)) and value != int(value):
            raise ValueError(f"{value} is not whole")
        number = int(value)
        if not -(1 << WIDTHS[dtype.typeName()] - 1) <= number < 1 << WIDTHS[dtype.typeName()] - 1:
            raise ValueError(f"{number} is out of range")
        return number
    if isinstance(dtype, T.DecimalType):
        number = decimal.Decimal(str(value) if isinstance(value, float) else value)
        with decimal.localcontext(prec=76):
            kept = number.quantize(decimal.Decimal(1).scaleb(-dtype.scale))
        if kept != number or kept.adjusted() >= dtype.precision - dtype.scale and kept:
            raise ValueError(f"{value} does not fit")
        return kept
    number = float(value)
    if isinstance(dtype, T.FloatType):
        kept = struct.unpack("f", struct.pack("f", number))[0]
        if math.isinf(kept) and not math.isinf(number):
            raise ValueError(f"{number} is out of range")
        return kept
    return number


def _one_of(known: dict, value: Any) -> Any:
    if not isinstance(value, (str, bool)) or value not in known:
        raise ValueError(f"{value!r} is neither true nor false")
    return known[value]


def _of(kind: type, value: Any) -> Any:
    if not isinstance(value, kind):
        raise ValueError(f"{value!r} is no {kind.__name__}")
    return value


def id_frame(df: DataFrame, key: Field, ids: Iterable[Any]) -> DataFrame:
    rows = [(i,) for i in ids]
    return df.sparkSession.createDataFrame(rows, f"__id {key.dtype.simpleString()}")


def select_count(df: DataFrame, condition: Column | None = None) -> int:
    return P.where(df, condition).count()


def select_list(
    df: DataFrame,
    condition: Column | None = None,
    sort: Sequence[Sort] = (),
    limit: int | None = None,
    collapse: Field | None = None,
    key: Field | None = None,
) -> DataFrame:
    """``search`` that raises when no limit is set and more than LIST_CAP rows match (before collapse)."""
    check_limit(limit)
    check_cap(P.where(df, condition), limit)
    return search(df, condition, sort, limit, collapse, key)


def select_one(df: DataFrame, condition: Column | None = None) -> Row | None:
    rows = P.where(df, condition).limit(2).collect()
    if len(rows) > 1:
        raise QueryError("one row expected, several match")
    return rows[0] if rows else None


@dataclass(frozen=True)
class Page:
    current: int
    size: int
    rows: DataFrame
    total: int | None

    @property
    def pages(self) -> int | None:
        return None if self.total is None else -(-self.total // self.size)


def select_page(
    df: DataFrame,
    current: int,
    size: int,
    condition: Column | None = None,
    sort: Sequence[Sort] = (),
    key: Field | None = None,
    with_total: bool = True,
) -> Page:
    """1-based page. The total is a job of its own; leave it out when not needed.

    Without a sort or a key no order holds pages apart, so one of them is needed.
    """
    if not sort and key is None:
        raise QueryError("a page needs a sort or a key")
    if current < 1 or size < 1:
        raise QueryError("page number and size start at 1")
    if current * size > WINDOW:
        raise QueryError(f"page reaches beyond row {WINDOW}; use select_after")
    matched = P.where(df, condition)
    order = columns(_total(sort, key))
    rows = matched.orderBy(*order).offset((current - 1) * size).limit(size)
    return Page(current, size, rows, matched.count() if with_total else None)


@dataclass(frozen=True)
class Batch:
    rows: DataFrame
    next: tuple[str | None, ...] | None
    total: int | None


def _types(df: DataFrame, order: Sequence[Sort]) -> list[T.DataType]:
    return [f.dataType for f in df.select(*[s.expr.alias(f"k{i}") for i, s in enumerate(order)]).schema.fields]


def _mark(expr: Column, dtype: T.DataType) -> Column:
    """A sort value as it stands in a cursor."""
    return (F.unix_micros(expr) if isinstance(dtype, T.TimestampType) else expr).cast("string")


def after(df: DataFrame, order: Sequence[Sort], cursor: Sequence[str | None]) -> Column:
    """Rows that come after ``cursor`` (one value per sort key, as text) in the given order.

    Timestamps are epoch microseconds in a cursor, so that no session zone and no change of clocks matters. Missing
    values sort last: after a value come the missing ones, and after a missing one those that are missing as well and
    come later by the remaining keys.
    """
    if len(cursor) != len(order):
        raise QueryError(f"cursor has {len(cursor)} values for {len(order)} sort keys")
    types = _types(df, order)
    found: Column | None = None
    for sort, text, dtype in reversed(list(zip(order, cursor, types))):
        if text is None:
            found = sort.expr.isNull() & (F.lit(False) if found is None else found)
            continue
        value = F.timestamp_micros(F.lit(int(text))) if isinstance(dtype, T.TimestampType) else F.lit(text).cast(dtype)
        beyond = (sort.expr < value) if sort.descending else (sort.expr > value)
        later = beyond | sort.expr.isNull()
        found = later if found is None else later | ((sort.expr == value) & found)
    return found


def select_after(
    df: DataFrame,
    size: int,
    cursor: Sequence[str | None] | None = None,
    condition: Column | None = None,
    sort: Sequence[Sort] = (),
    *,
    key: Field,
    with_total: bool = True,
) -> Batch:
    """The next ``size`` rows after ``cursor``, and the cursor to go on with (``None`` at the end).

    The cursor is a tuple of texts, so it can be stored or sent. Unlike an offset it does not make
    later batches dearer: the rows before it are filtered out at the scan.

    Only the sort values of the batch, at most WINDOW + 1 rows of them, come to the driver. ``rows`` is a filter from
    the cursor to the last row's sort values, so that wide documents stay on the cluster. Rows that repeat a key at the
    end of a batch are all in it.
    """
    if not 1 <= size <= WINDOW:
        raise QueryError(f"batch size must be 1 to {WINDOW}, not {size}")
    matched = P.where(df, condition)
    order = _total(sort, key)
    rest = matched if cursor is None else matched.filter(after(df, order, cursor))
    marks = [_mark(s.expr, t).alias(f"__mark{i}") for i, (s, t) in enumerate(zip(order, _types(df, order)))]
    found = rest.orderBy(*columns(order)).select(*marks).limit(size + 1).toArrow().to_pylist()
    total = matched.count() if with_total else None
    if not found:
        return Batch(rest.filter(F.lit(False)), None, total)
    last = tuple(found[:size][-1].values())
    beyond = after(df, order, last)
    rows = rest.filter(~F.coalesce(beyond, F.lit(False))).orderBy(*columns(order))
    return Batch(rows, last if len(found) > size else None, total)


def with_inner_hits(
    df: DataFrame,
    field: Field,
    child_condition: Callable[[Fields], Column],
    size: int,
    condition: Column | None = None,
    sort: Sequence[Sort] = (),
    limit: int | None = None,
    key: Field | None = None,
    hits: str = "inner_hits",
) -> DataFrame:
    """Rows with a matching child, plus their first ``size`` matching children as an array column."""
    if size <= 0:
        raise QueryError("inner hits size must be positive")
    if not field.is_nested:
        raise QueryError(f"{field.name} is not a nested field")
    found = search(df, P.all_of(P.nested(field, child_condition), condition), sort, limit, key=key)
    matching = F.filter(field.col, lambda c: child_condition(field.children_of(c)))
    return found.withColumn(hits, F.slice(matching, 1, size))


def select_list_with_inner_hits(
    df: DataFrame,
    field: Field,
    child_condition: Callable[[Fields], Column],
    size: int,
    condition: Column | None = None,
    sort: Sequence[Sort] = (),
    limit: int | None = None,
    key: Field | None = None,
) -> DataFrame:
    """``with_inner_hits`` behind the same cap as ``select_list``."""
    check_limit(limit)
    out = with_inner_hits(df, field, child_condition, size, condition, sort, limit, key)
    check_cap(P.where(df, P.all_of(P.nested(field, child_condition), condition)), limit)
    return out

