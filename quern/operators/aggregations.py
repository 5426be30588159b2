"""Trees of bucket and metric aggregations.

Each bucket path of the tree is one DataFrame: one column per key on the path, ``doc_count``, one column per
metric. Buckets that a ``terms`` size cuts off are removed before anything below them is computed.

A tree of buckets reads its rows once: they are grouped by all keys of each of its paths (a row counts once per path,
where the tree branches), and every level is rolled up from those groups, whose shuffle all levels share. The groups
hold mergeable states: counts, sums, extremes, and sketches for approximate cardinalities. A range level is grouped by
segments, the stretches between the bounds of its ranges, which are then added up, so that no row is copied per range.
Rows without a value for a lower key stay in the groups of the upper ones. Only exact cardinalities, top hits, nested
children and what lies below a ``cut_first`` level go back to the rows. Nothing is listed below an empty bucket.
"""

from __future__ import annotations

import builtins
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from dataclasses import field as dc_field
from functools import cache, reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.errors import QueryError
from quern.functions import predicates as P
from quern.functions.fields import Field, Fields, fields
from quern.operators.topn import own_shuffle, top_per_group

# Buckets of a terms level by default; calendar units with their shortest length in ms.
DEFAULT_TERMS = 100
UNIT_MS = {
    "second": 1_000,
    "minute": 60_000,
    "hour": 3_600_000,
    "day": 86_400_000,
    "week": 604_800_000,
    "month": 2_419_200_000,
    "quarter": 7_776_000_000,
    "year": 31_536_000_000,
}
DAY_MS = UNIT_MS["day"]
MONTHS = {"month": 1, "quarter": 3, "year": 12}
# Gaps are filled by blocks of this many buckets, so that no array and no task holds a long span.
BLOCK = 4096
# Digits of the widest decimals whose means are put together from sums.
WIDEST_MEAN = 24

BUCKETS = ("terms", "date_histogram", "range")
DATES = (T.DateType, T.TimestampType, T.TimestampNTZType)
METRICS = ("avg", "max", "min", "sum", "stats", "cardinality")
STATS = ("count", "min", "max", "avg", "sum")


@dataclass(frozen=True)
class Range:
    """``[low, high)``; an open end is None."""

    low: float | None = None
    high: float | None = None
    key: str | None = None

    def __post_init__(self):
        if self.low is None and self.high is None:
            raise QueryError("a range needs at least one end")
        if self.low is not None and self.high is not None and not self.low < self.high:
            raise QueryError(f"a range from {self.low} to {self.high} holds nothing")

    @property
    def label(self) -> str:
        ends = ["*" if end is None else str(float(end)) for end in (self.low, self.high)]
        return self.key or "-".join(ends)

    def holds(self, col: Column) -> Column:
        test = col.isNotNull()
        if self.low is not None:
            test = test & (col >= F.lit(self.low))
        if self.high is not None:
            test = test & (col < F.lit(self.high))
        return test


@dataclass(frozen=True, eq=False)
class Agg:
    kind: str
    field: str | None
    name: str
    children: tuple[Agg, ...] = ()
    options: dict = dc_field(default_factory=dict)


# ---- declaring aggregations ----


def terms(
    field: str,
    *aggs: Agg,
    name: str | None = None,
    size: int | None = None,
    order_by: str | None = None,
    descending: bool = True,
    cut_first: bool = False,
) -> Agg:
    """One bucket per value, the ``size`` first of them (100) by count, or by ``order_by``.

    ``cut_first`` finds the kept buckets in a pass of its own and reads their rows again for what lies below: for few
    buckets of many, above keys with nearly as many values as there are rows, which would make as many groups.

    ``order_by`` is ``_count``, ``_key``, or the name of a metric below this bucket (of stats: with ``.avg``
    and so on behind it). Ties go by key.
    """
    if size is not None and size <= 0:
        raise QueryError("terms size must be positive")
    if order_by not in (None, "_count", "_key"):
        below = {a.name: a for a in aggs if a.kind in METRICS}
        if order_by in below and below[order_by].kind != "stats":
            order_by = ("metric", order_by)
        else:
            head, _, part = order_by.rpartition(".")
            if part not in STATS or head not in below or below[head].kind != "stats":
                raise QueryError(f"terms cannot be ordered by {order_by!r}; metrics below it: {sorted(below)}")
            order_by = ("metric", f"{head}_{part}")
    options = {"size": size or DEFAULT_TERMS, "order_by": order_by or "_count", "descending": descending, "cut_first": cut_first}
    return _bucket("terms", field, aggs, name, options)


def date_histogram(
    field: str,
    interval: str,
    *aggs: Agg,
    name: str | None = None,
    format: str | None = None,
    min_doc_count: int | None = None,
) -> Agg:
    """One bucket per calendar unit, keyed by epoch milliseconds, empty ones in between included.

    Units begin in UTC whatever the session's time zone is; weeks begin on Monday.

    ``min_doc_count`` drops buckets with fewer rows; ``format`` adds the key as text.
    """
    if interval not in UNIT_MS:
        raise QueryError(f"unknown interval {interval!r}; one of {sorted(UNIT_MS)}")
    if min_doc_count is not None and min_doc_count < 0:
        raise QueryError("min_doc_count must not be negative")
    options = {"interval": interval, "format": format, "min_doc_count": min_doc_count or 0}
    return _bucket("date_histogram", field, aggs, name, options)


def ranges(field: str, bounds: Sequence[Range], *aggs: Agg, name: str | None = None) -> Agg:
    """One bucket per range, empty ones included. Ranges may overlap."""
    if not bounds:
        raise QueryError("ranges needs at least one range")
    labels = [b.label for b in bounds]
    if len(set(labels)) < len(labels):
        raise QueryError(f"range keys repeat: {labels}")
    return _bucket("range", field, aggs, name, {"ranges": tuple(bounds)})


def nested(field: str, *aggs: Agg, name: str | None = None) -> Agg:
    """One bucket of all children; the aggregations below it see the children's fields."""
    return _bucket("nested", field, aggs, name, {})


def top_hits(size: int, *by: str, ascending: bool = False, name: str = "top_hits") -> Agg:
    """The first ``size`` whole rows by the given fields."""
    if size <= 0:
        raise QueryError("top_hits size must be positive")
    return Agg("top_hits", None, name, (), {"size": size, "by": by, "ascending": ascending})


def _bucket(kind: str, field: str, aggs: Sequence[Agg], name: str | None, options: dict) -> Agg:
    _unique(aggs)
    return Agg(kind, field, name or field, tuple(aggs), options)


def _unique(aggs: Sequence[Agg]) -> None:
    names = [a.name for a in aggs]
    repeated = {n for n in names if names.count(n) > 1}
    if repeated:
        raise QueryError(f"aggregations share a name: {sorted(repeated)}; pass name=")


def avg(field: str, name: str | None = None) -> Agg:
    """Over dates, avg, sum and stats are of epoch milliseconds; max and min give dates."""
    return Agg("avg", field, name or field)


def max(field: str, name: str | None = None) -> Agg:
    return Agg("max", field, name or field)


def min(field: str, name: str | None = None) -> Agg:
    return Agg("min", field, name or field)


def sum(field: str, name: str | None = None) -> Agg:
    """Zero, not null, over no rows."""
    return Agg("sum", field, name or field)


def stats(field: str, name: str | None = None) -> Agg:
    """count, min, max, avg and sum, as columns ``<name>_count`` and so on."""
    return Agg("stats", field, name or field)


def cardinality(field: str, name: str | None = None, exact: bool = False) -> Agg:
    """Number of distinct values, approximate unless ``exact``."""
    return Agg("cardinality", field, name or field, (), {"exact": exact})


# ---- computing them ----


# DataFrames are put together when a result first asks for them: a tree has many, and each takes the driver time.
Later = Callable[[], DataFrame]


@dataclass(frozen=True, eq=False)
class _Key:
    column: str  # in rows
    name: str  # in results
    shown: Column  # its value in results


@dataclass(frozen=True, eq=False)
class _Once:
    """How the buckets of a tree are found in its groups."""

    columns: tuple[str, ...]  # of the groups
    states: dict[tuple[str, str], str]  # column by (field, what)
    keys: dict[Agg, str]  # column of a bucket's key; of ranges: of the segment
    sets: dict[Agg, Column]  # where paths branch: which rows are grouped by the bucket's path, perhaps with keys below it
    leaves: frozenset[Agg]  # whose groups are their buckets already


@dataclass(frozen=True, eq=False)
class _Scope:
    """What the aggregations of one level work on."""

    rows: Later  # with one column per key on the path
    fields: Fields
    row: Column  # a whole row of this scope, as a struct
    present: Column | None  # which rows are real (nested keeps a placeholder for childless parents)
    keys: tuple[_Key, ...] = ()
    # The rows' groups, with the same key columns, below the level at which a tree was grouped.
    groups: Later | None = None
    once: _Once | None = None
    tiebreak: Column | None = None
    path: tuple[str, ...] = ()

    @property
    def key_columns(self) -> list[str]:
        return [k.column for k in self.keys]

    @property
    def shown_keys(self) -> list[Column]:
        return [k.shown.alias(k.name) for k in self.keys]


def aggregate(
    df: DataFrame, condition: Column | None, *aggs: Agg, key: str | None = None, text: Sequence[str] = ()
) -> AggResult:
    """Filter, then aggregate. ``key`` breaks ties in top_hits."""
    if not aggs:
        raise QueryError("aggregate needs at least one aggregation")
    _unique(aggs)
    known = fields(df, text)
    df = P.where(df, condition)
    scope = _Scope(
        rows=lambda: df,
        fields=known,
        row=F.struct(*[known[n].col for n in known]),
        present=None,
        tiebreak=known[key].col if key else None,
    )
    result = AggResult()
    metrics = _metrics(aggs, scope.fields)
    if metrics:
        result.put((), "root", lambda: df.agg(*[c.alias(n) for n, c, _ in metrics]), aggs)
    _descend(scope, aggs, result)
    return result


def _descend(scope: _Scope, aggs: Sequence[Agg], result: AggResult) -> None:
    for agg in aggs:
        if agg.kind in BUCKETS:
            _add_bucket(scope, agg, result)
        elif agg.kind == "nested":
            _add_nested(scope, agg, result)
        elif agg.kind == "top_hits":
            _add_top_hits(scope, agg, result)


def _field(scope_fields: Fields, agg: Agg) -> Field:
    found = scope_fields[agg.field]
    if found.is_text:
        raise QueryError(f"text field {found.name} cannot be aggregated")
    if found.is_nested or isinstance(found.dtype, (T.StructType, T.ArrayType)):
        raise QueryError(f"{found.name} holds no single value; aggregate its children with nested")
    return found


def _measured(scope_fields: Fields, metric: Agg) -> Field:
    found = _field(scope_fields, metric)
    if metric.kind != "cardinality" and isinstance(found.dtype, (T.StringType, T.BooleanType)):
        raise QueryError(f"{metric.kind} needs numbers or dates, not {found.name}")
    return found


def _metrics(
    aggs: Sequence[Agg], scope_fields: Fields, only: Column | None = None
) -> list[tuple[str, Column, object]]:
    """(result name, aggregate expression, value over no rows) of the metrics among ``aggs``."""
    out = []
    for agg in aggs:
        if agg.kind not in METRICS:
            continue
        found = _measured(scope_fields, agg)
        col = found.col if only is None else F.when(only, found.col)
        if agg.kind in ("avg", "sum", "stats") and isinstance(found.dtype, DATES):
            col = _millis(found).cast("double") if only is None else F.when(only, _millis(found).cast("double"))
        if agg.kind == "stats":
            parts = [F.count(col), F.min(col), F.max(col), F.avg(col), F.coalesce(F.sum(col), F.lit(0))]
            fills = [0, None, None, None, 0]
            out += [(f"{agg.name}_{s}", p, f) for s, p, f in zip(STATS, parts, fills)]
        elif agg.kind == "cardinality":
            count = F.count_distinct(col) if agg.options["exact"] else F.approx_count_distinct(col)
            out.append((agg.name, count, 0))
        elif agg.kind == "sum":
            out.append((agg.name, F.coalesce(F.sum(col), F.lit(0)), 0))
        else:
            out.append((agg.name, getattr(F, agg.kind)(col), None))
    return out


def _add_bucket(scope: _Scope, agg: Agg, result: AggResult) -> None:
    found = _field(scope.fields, agg)
    if agg.kind == "date_histogram" and not isinstance(found.dtype, DATES):
        raise QueryError(f"date_histogram needs a date, not {found.name}")
    column = f"__k{len(scope.keys)}"
    path = scope.path + (agg.name,)
    if scope.once is None or agg not in scope.once.keys:
        scope = replace(scope, groups=None, once=None)
        if _shared_below(agg, scope.fields):
            scope = _grouped_once(scope, agg)
    if scope.once is None:
        metrics = _metrics(agg.children, scope.fields)
    else:
        metrics = _merged(agg.children, scope, agg in scope.once.leaves)
    _check_names(scope, agg, metrics)

    below = replace(scope, keys=scope.keys + (_Key(column, agg.name, _shown(agg, column)),), path=path)
    below = replace(below, rows=cache(lambda: _keyed(scope.rows(), agg, found, column)))
    if scope.once is not None:
        below = replace(below, groups=cache(lambda: _keyed_groups(scope, agg, column)))
    frame = cache(lambda: _level(scope, below, agg, found, column, metrics))
    result.put(path, agg.kind, lambda: _named(frame(), agg, below, metrics), agg.children, [n for n, _, _ in metrics])
    if any(a.kind not in METRICS for a in agg.children):
        _descend(_kept(below, agg, frame) if _is_cut(agg) else below, agg.children, result)


def _level(scope: _Scope, below: _Scope, agg: Agg, found: Field, column: str, metrics) -> DataFrame:
    """The buckets of a level."""
    if agg.kind == "range":
        return _ranges(scope, agg, found, column, metrics)
    frame = _grouped(below, agg, column, metrics)
    if agg.kind == "terms":
        return _terms(scope, agg, frame, column)
    least = agg.options["min_doc_count"]
    if least > 0:
        return frame.filter(F.col("doc_count") >= least)
    return _fill_gaps(frame, scope.key_columns, column, agg.options["interval"], metrics)


def _is_cut(agg: Agg) -> bool:
    """Whether a level may lack buckets that have rows."""
    return agg.kind == "terms" or agg.options.get("min_doc_count", 0) > 1


def _kept(below: _Scope, agg: Agg, frame: Later) -> _Scope:
    """Only what is in the buckets of the level."""

    @cache
    def kept() -> DataFrame:
        keys = frame().select(*below.key_columns)
        # Of the first terms level at most its size is left.
        return own_shuffle(keys) if len(below.keys) > 1 or agg.kind != "terms" else keys

    rows = cache(lambda: below.rows().join(kept(), below.key_columns, "left_semi"))
    groups = below.groups and cache(lambda: _only(below.groups(), kept(), below.key_columns))
    return replace(below, rows=rows, groups=groups)


def _only(groups: DataFrame, kept: DataFrame, keys: list[str]) -> DataFrame:
    """Groups in one of the kept buckets.

    A semi join would be moved below the grouping, and every level would read the rows again. An inner join on
    null-safe keys, which are unique, stays where it is.
    """
    renamed = kept.select(*[F.col(k).alias(f"{k}_kept") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"{k}_kept")) for k in keys]
    return groups.join(renamed, same).select(*groups.columns)


def _keyed(rows: DataFrame, agg: Agg, found: Field, column: str) -> DataFrame:
    """Rows with their key; of ranges, one copy per range that holds the row."""
    if agg.kind != "range":
        return rows.withColumn(column, _value(agg, found)).filter(F.col(column).isNotNull())
    bounds = agg.options["ranges"]
    inside = F.array_compact(F.array(*[F.when(b.holds(found.col), F.lit(i)) for i, b in enumerate(bounds)]))
    return rows.withColumn(column, F.explode(inside))


def _keyed_groups(scope: _Scope, agg: Agg, column: str) -> DataFrame:
    """Groups with their key; of ranges, one copy per range that holds the group's segment."""
    key = F.col(scope.once.keys[agg])
    # Conditions on groups also look at their number of rows, so that the optimizer leaves them above the groups:
    # all levels are to share those.
    groups = scope.groups().filter(F.when(key.isNotNull(), F.col("__n")) > 0)
    if agg.kind != "range":
        return groups.withColumn(column, key)
    by_segment = [[i for i, part in enumerate(_segments(agg)) if s in part] for s in range(len(_cuts(agg)) + 1)]
    held = F.array(*[F.array(*[F.lit(i) for i in found]).cast("array<int>") for found in by_segment])
    return groups.withColumn(column, F.explode(F.get(held, key)))


def _mergeable(metric: Agg, known: Fields) -> bool:
    if metric.kind in ("avg", "stats") and isinstance(dtype := _field(known, metric).dtype, T.DecimalType):
        # Beyond this a sum divided by a count has fewer digits than a mean over rows.
        return dtype.precision <= WIDEST_MEAN
    return metric.kind != "cardinality" or not metric.options["exact"]


def _shared(agg: Agg, known: Fields) -> bool:
    """Whether a bucket can be taken from groups."""
    return agg.kind in BUCKETS and all(_mergeable(m, known) for m in agg.children if m.kind in METRICS)


def _shared_below(agg: Agg, known: Fields) -> list[Agg]:
    """The buckets directly below this one that share its groups."""
    if not _shared(agg, known) or agg.options.get("cut_first"):
        return []
    return [a for a in agg.children if _shared(a, known)]


def _paths_below(agg: Agg, known: Fields) -> list[list[Agg]]:
    """The longest paths of buckets from here down that share groups."""
    below = _shared_below(agg, known)
    return [[agg, *path] for a in below for path in _paths_below(a, known)] if below else [[agg]]


def _grouped_once(scope: _Scope, top: Agg) -> _Scope:
    """The scope with its rows grouped by the keys of every path from ``top`` down, holding states of all metrics."""
    paths = _paths_below(top, scope.fields)
    keys: dict[Agg, str] = {}
    for agg in (a for path in paths for a in path):
        keys.setdefault(agg, f"__g{len(scope.keys)}_{len(keys)}")
    found = {agg: _field(scope.fields, agg) for agg in keys}
    states: dict[tuple[str, str], str] = {}
    columns = [F.count(F.lit(1)).alias("__n")]
    for metric in (m for a in keys for m in a.children if m.kind in METRICS):
        for what, value in _states(metric, _measured(scope.fields, metric)):
            if (metric.field, what) not in states:
                states[metric.field, what] = f"__s{len(states)}"
                columns.append(value.alias(states[metric.field, what]))
    by = [*scope.key_columns, *keys.values()]
    # Where paths branch, a row is counted in one set of groups per path, under the keys of that path.
    of_path = {a: [i for i, path in enumerate(paths) if a in path] for a in keys}
    sets = {a: F.col("__set") == of_path[a][0] for a in keys} if len(paths) > 1 else {}

    @cache
    def groups() -> DataFrame:
        values = {n: _segment(a, found[a]) if a.kind == "range" else _value(a, found[a]) for a, n in keys.items()}
        rows = scope.rows()
        if not sets:
            rows = rows.withColumns(values)
        else:
            # Not Spark's grouping sets: plans that hold those twice are not seen to be equal, and read their rows twice.
            rows = rows.withColumn(keys[top], values[keys[top]]).filter(F.col(keys[top]).isNotNull())
            rows = rows.withColumn("__set", F.explode(F.array(*[F.lit(i) for i in range(len(paths))])))
            rows = rows.withColumns(
                {n: F.when(F.col("__set").isin(of_path[a]), values[n]) for a, n in keys.items() if a is not top}
            )
        # A row without the first key is in no bucket of the tree.
        return rows.filter(F.col(keys[top]).isNotNull()).groupBy(*by, *(["__set"] if sets else [])).agg(*columns)

    names = (*by, *(["__set"] if sets else []), "__n", *states.values())
    leaves = {p[-1] for p in paths if all(a.kind != "range" for a in p)}
    return replace(scope, groups=groups, once=_Once(names, states, keys, sets, frozenset(leaves)))


def _number_of(metric: Agg, found: Field) -> tuple[Column, str]:
    """What avg, sum and stats are taken over, and a mark for the states of dates."""
    if metric.kind in ("avg", "sum", "stats") and isinstance(found.dtype, DATES):
        return _millis(found).cast("double"), " of ms"
    return found.col, ""


def _states(metric: Agg, found: Field) -> list[tuple[str, Column]]:
    """(what, aggregate over rows) whose results can be merged into the metric."""
    col, mark = _number_of(metric, found)
    # Decimals are added up as they are, other numbers of a mean as doubles.
    of_mean = col if isinstance(found.dtype, T.DecimalType) else col.cast("double")
    parts = {
        "avg": [("count", F.count(col)), ("mean sum", F.sum(of_mean))],
        "sum": [("sum", F.sum(col))],
        "min": [("min", F.min(col))],
        "max": [("max", F.max(col))],
        "stats": [("count", F.count(col)), ("mean sum", F.sum(of_mean)), ("sum", F.sum(col)), ("min", F.min(col)), ("max", F.max(col))],
        "cardinality": [("sketch", F.hll_sketch_agg(_hashable(found)))],
    }
    return [(what + mark, value) for what, value in parts[metric.kind]]


def _hashable(found: Field) -> Column:
    """The field as one of the types that sketches take."""
    if isinstance(found.dtype, (T.IntegerType, T.LongType, T.StringType, T.BinaryType)):
        return found.col
    return found.col.cast("bigint" if isinstance(found.dtype, T.IntegralType) else "string")


def _merged(
    aggs: Sequence[Agg], scope: _Scope, leaf: bool = False, only: Column | None = None
) -> list[tuple[str, Column, object]]:
    """What ``_metrics`` gives, from the states of groups: of several per bucket, or of the one that is the bucket."""

    def itself(col: Column) -> Column:
        return col

    add, least, most, union = (itself,) * 4 if leaf else (F.sum, F.min, F.max, F.hll_union_agg)
    out = []
    for agg in aggs:
        if agg.kind not in METRICS:
            continue
        found = _field(scope.fields, agg)
        mark = _number_of(agg, found)[1]
        decimal = found.dtype if isinstance(found.dtype, T.DecimalType) else None

        def state(what: str, mark=mark, agg=agg) -> Column:
            col = F.col(scope.once.states[agg.field, what + mark])
            return col if only is None else F.when(only, col)

        def total(what: str, decimal=decimal, state=state) -> Column:
            # Decimal sums of sums are brought back to the type of a sum over rows.
            summed = add(state(what))
            return summed if decimal is None else summed.cast(_decimal(decimal, 10, 0))

        def average(decimal=decimal, state=state, total=total) -> Column:
            mean = F.try_divide(total("mean sum"), add(state("count")))
            return mean if decimal is None else mean.cast(_decimal(decimal, 4, 4))

        if agg.kind == "stats":
            count = F.coalesce(add(state("count")), F.lit(0))
            parts = [count, least(state("min")), most(state("max")), average(), F.coalesce(total("sum"), F.lit(0))]
            out += [(f"{agg.name}_{s}", p, f) for s, p, f in zip(STATS, parts, [0, None, None, None, 0])]
        elif agg.kind == "avg":
            out.append((agg.name, average(), None))
        elif agg.kind == "sum":
            out.append((agg.name, F.coalesce(total("sum"), F.lit(0)), 0))
        elif agg.kind == "cardinality":
            out.append((agg.name, F.coalesce(F.hll_sketch_estimate(union(state("sketch"))), F.lit(0)), 0))
        else:
            out.append((agg.name, (least if agg.kind == "min" else most)(state(agg.kind)), None))
    return out


def _decimal(of: T.DecimalType, wider: int, finer: int) -> T.DecimalType:
    """The type Spark gives to sums (10, 0) and means (4, 4) of such decimals."""
    return T.DecimalType(builtins.min(38, of.precision + wider), builtins.min(38, of.scale + finer))


def _cuts(agg: Agg) -> list[float]:
    """The bounds of all ranges, in order. They cut the axis into segments, the first below the lowest bound."""
    ends = {end for r in agg.options["ranges"] for end in (r.low, r.high) if end is not None}
    return sorted(ends)


def _segment(agg: Agg, found: Field) -> Column:
    """The number of a value's segment: how many bounds are not above it."""
    return reduce(lambda a, b: a + b, [(found.col >= F.lit(cut)).cast("int") for cut in _cuts(agg)])


def _segments(agg: Agg) -> list[range]:
    """The segments of every range."""
    cuts = _cuts(agg)
    first = [0 if r.low is None else cuts.index(r.low) + 1 for r in agg.options["ranges"]]
    end = [len(cuts) + 1 if r.high is None else cuts.index(r.high) + 1 for r in agg.options["ranges"]]
    return [range(a, b) for a, b in zip(first, end)]


def _shown(agg: Agg, column: str) -> Column:
    """Ranges are shown by their labels."""
    if agg.kind == "range":
        return F.get(F.array(*[F.lit(r.label) for r in agg.options["ranges"]]), F.col(column))
    return F.col(column)


def _check_names(scope: _Scope, agg: Agg, metrics) -> None:
    names = [k.name for k in scope.keys] + [n for n, _, _ in metrics] + ["doc_count"]
    if agg.kind != "nested":
        names.append(agg.name)
    if agg.kind == "date_histogram" and agg.options["format"]:
        names.append(f"{agg.name}_text")
    repeated = {n for n in names if names.count(n) > 1}
    if repeated:
        raise QueryError(f"result columns would repeat: {sorted(repeated)}; pass name=")


def _grouped(below: _Scope, agg: Agg, column: str, metrics) -> DataFrame:
    """The buckets of a level: its keys, ``doc_count`` and the metrics."""
    values = [c.alias(n) for n, c, _ in metrics]
    if below.once is None:
        return below.rows().groupBy(*below.key_columns).agg(F.count(F.lit(1)).alias("doc_count"), *values)
    groups, whole = _of_set(below, agg)
    if agg in below.once.leaves:
        groups = groups.filter(F.pmod(whole, F.lit(2)) < 2)
        return groups.select(*below.key_columns, F.col("__n").alias("doc_count"), *values)
    rolled = groups.groupBy(*below.key_columns).agg(F.sum("__n").alias("doc_count"), *values, F.bit_xor(whole).alias("__whole"))
    return rolled.filter(F.col("__whole").isNotNull()).drop("__whole")


def _of_set(scope: _Scope, agg: Agg) -> tuple[DataFrame, Column]:
    """The groups that an aggregation is taken from, and a hash of all their columns.

    With every column of the groups in use at every level, all levels need the same shuffled groups, and Spark
    computes them once. Conditions on the hash are true for every row, which the optimizer cannot know.
    """
    groups = scope.groups()
    if agg in scope.once.sets:
        groups = groups.filter(F.when(scope.once.sets[agg], F.col("__n")) > 0)
    return groups, F.xxhash64(*scope.once.columns)


def _value(agg: Agg, found: Field) -> Column:
    """A row's key, null where it is in no bucket."""
    if agg.kind == "terms":
        return found.col.cast("bigint") if isinstance(found.dtype, T.BooleanType) else found.col
    return _unit_start(found, agg.options["interval"])


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _terms(scope: _Scope, agg: Agg, frame: DataFrame, column: str) -> DataFrame:
    by, size = agg.options["order_by"], agg.options["size"]
    by = F.col(_quoted(by[1]) if isinstance(by, tuple) else {"_count": "doc_count", "_key": column}[by])
    order = [by.desc_nulls_last() if agg.options["descending"] else by.asc_nulls_last(), F.asc(column)]
    if scope.keys:
        return top_per_group(frame, scope.key_columns, order, size, rank="__rank")
    return frame.orderBy(*order).limit(size)


def _millis(found: Field) -> Column:
    """Epoch milliseconds of a date, whatever the session's zone."""
    if isinstance(found.dtype, T.TimestampType):
        return F.unix_millis(found.col)
    ms = F.unix_date(found.col.cast("date")).cast("bigint") * DAY_MS
    if isinstance(found.dtype, T.TimestampNTZType):
        # The fraction of the second comes from date_part, which has six digits.
        seconds = F.hour(found.col) * 3600 + F.minute(found.col) * 60
        ms = ms + seconds.cast("bigint") * 1000 + F.floor(F.date_part(F.lit("SECOND"), found.col) * 1000).cast("bigint")
    return ms


def _unit_start(found: Field, unit: str) -> Column:
    """Epoch milliseconds of the start of the calendar unit, in UTC. No step depends on the session's zone."""
    ms = _millis(found)
    if unit in MONTHS:
        return _date_ms(F.trunc(_date(ms), unit))
    first_monday = 4 * DAY_MS if unit == "week" else 0
    return ms - F.pmod(ms - F.lit(first_monday), F.lit(UNIT_MS[unit]))


def _number(ms: Column, unit: str) -> Column:
    """Consecutive numbers of consecutive unit starts."""
    if unit in MONTHS:
        return ((F.year(_date(ms)) * 12 + F.month(_date(ms)) - 1) / MONTHS[unit]).cast("bigint")
    return F.floor((ms - F.lit(4 * DAY_MS if unit == "week" else 0)) / F.lit(UNIT_MS[unit]))


def _start(number: Column, unit: str) -> Column:
    """The unit start with this number."""
    if unit in MONTHS:
        month = number * MONTHS[unit]
        return _date_ms(F.make_date(F.floor(month / 12).cast("int"), (F.pmod(month, F.lit(12)) + 1).cast("int"), F.lit(1)))
    return number * F.lit(UNIT_MS[unit]).cast("bigint") + F.lit(4 * DAY_MS if unit == "week" else 0)


def _date(ms: Column) -> Column:
    return F.date_from_unix_date(F.floor(ms / F.lit(DAY_MS)).cast("int"))


def _date_ms(date: Column) -> Column:
    return F.unix_date(date).cast("bigint") * DAY_MS


def _key_text(ms: Column, pattern: str) -> Column:
    moment = _date(ms).cast("timestamp_ntz") + F.make_dt_interval(secs=F.pmod(ms, F.lit(DAY_MS)) / 1000)
    return F.date_format(moment, pattern)


def _fill_gaps(frame: DataFrame, parents: list[str], column: str, unit: str, metrics) -> DataFrame:
    """Add the empty buckets between the first and last one of each parent.

    Gaps come from the buckets, not from the rows: below parents every bucket is followed by the empty ones up to the
    next bucket. At the top, where a window would be one task, the span is laid out and joined with the buckets.
    """
    fills = {"doc_count": 0} | {n: fill for n, _, fill in metrics if fill is not None}
    number, others = _number(F.col(column), unit), [c for c in frame.columns if c not in (*parents, column)]
    if parents:
        following = F.lead(number).over(Window.partitionBy(*parents).orderBy(column))
        numbered = frame.withColumns({"__first": number, "__last": F.coalesce(following - 1, number)})
        numbers = _laid_out(numbered)
        mine = F.col("__number") == F.col("__first")
        values = {c: F.when(mine, F.col(_quoted(c))) for c in others}
        values |= {c: F.coalesce(values[c], F.lit(v)) for c, v in fills.items()}
        start = _start(F.col("__number"), unit).alias(column)
        return numbers.select(*parents, start, *[v.alias(c) for c, v in values.items()])
    # With every column in use, this side needs the same buckets as the join below, and Spark computes them once.
    whole = F.bit_xor(F.xxhash64(*[_quoted(c) for c in frame.columns])).alias("__whole")
    spans = frame.agg(F.min(number).alias("__first"), F.max(number).alias("__last"), whole)
    numbers = _laid_out(spans.filter("__first is not null and __whole is not null"))
    every = numbers.select(_start(F.col("__number"), unit).alias(column))
    filled = every.join(frame, [column], "left")
    return filled.withColumns({n: F.coalesce(F.col(_quoted(n)), F.lit(v)) for n, v in fills.items()})


def _laid_out(spans: DataFrame) -> DataFrame:
    """One row per ``__number`` from ``__first`` to ``__last``. The blocks of a long span are dealt out before."""
    starts = F.sequence("__first", "__last", F.lit(BLOCK).cast("bigint"))
    blocks = spans.withColumn("__block", F.explode(starts)).hint("rebalance")
    numbers = F.sequence("__block", F.least(F.col("__last"), F.col("__block") + BLOCK - 1))
    return blocks.withColumn("__number", F.explode(numbers))


def _ranges(scope: _Scope, agg: Agg, found: Field, column: str, metrics) -> DataFrame:
    """All ranges in one pass: each is a conditional aggregate, so empty ones are there by themselves."""
    packed, also = [], []
    if scope.once is None:
        rows = scope.rows()
    else:
        rows, whole = _of_set(scope, agg)
        also = [F.bit_xor(whole).alias("__whole")]
    for i, bound in enumerate(agg.options["ranges"]):
        if scope.once is None:
            inside = bound.holds(found.col)
            count, values = F.count_if(inside), _metrics(agg.children, scope.fields, only=inside)
        else:
            part = _segments(agg)[i]
            inside = F.col(scope.once.keys[agg]).between(part.start, part.stop - 1)
            count = F.coalesce(F.sum(F.when(inside, F.col("__n"))), F.lit(0))
            values = _merged(agg.children, scope, only=inside)
        packed.append(F.struct(F.lit(i).alias(column), count.alias("doc_count"), *[c.alias(n) for n, c, _ in values]))
    found_in = rows.groupBy(*scope.key_columns).agg(F.array(*packed).alias("__ranges"), *also)
    if also:
        # At the top no group at all leaves the hash null, and the ranges are empty all the same.
        found_in = found_in.filter(F.coalesce(F.pmod("__whole", F.lit(2)), F.lit(0)) < 2)
    return found_in.select(*scope.key_columns, F.inline("__ranges"))


def _add_nested(scope: _Scope, agg: Agg, result: AggResult) -> None:
    found = scope.fields[agg.field]
    if not found.is_nested:
        raise QueryError(f"{found.name} is not a nested field")
    child = f"__child{len(scope.path)}"
    # The outer form keeps parents without children, which count zero.
    rows = cache(lambda: scope.rows().select(*scope.key_columns, F.explode_outer(found.col).alias(child)))
    known = found.children_of(F.col(child))
    metrics = _metrics(agg.children, known)
    _check_names(scope, agg, metrics)
    path = scope.path + (agg.name,)

    def frame() -> DataFrame:
        values = [c.alias(n) for n, c, _ in metrics]
        return rows().groupBy(*scope.key_columns).agg(F.count(child).alias("doc_count"), *values)

    result.put(path, "nested", lambda: _named(frame(), agg, scope, metrics), agg.children)
    inside = replace(
        scope, rows=rows, fields=known, row=F.col(child), present=F.col(child).isNotNull(), tiebreak=None, path=path
    )
    _descend(inside, agg.children, result)


def _add_top_hits(scope: _Scope, agg: Agg, result: AggResult) -> None:
    columns = [scope.fields[n].col for n in agg.options["by"]]
    order = [c.asc_nulls_last() if agg.options["ascending"] else c.desc_nulls_last() for c in columns]
    if scope.tiebreak is not None:
        order.append(scope.tiebreak.asc())
    size = agg.options["size"]

    def hits() -> DataFrame:
        rows = scope.rows() if scope.present is None else scope.rows().filter(scope.present)
        if not scope.keys:
            return (rows.orderBy(*order) if order else rows).limit(size).select(scope.row.alias("hit"))
        ranked = top_per_group(rows, scope.key_columns, order or [F.lit(1)], size, rank="hit_rank")
        ranked = ranked.orderBy(*scope.key_columns, "hit_rank")
        return ranked.select(*scope.shown_keys, "hit_rank", scope.row.alias("hit"))

    result.put(scope.path + (agg.name,), "top_hits", hits, ())


def _named(frame: DataFrame, agg: Agg, scope: _Scope, metrics) -> DataFrame:
    """Result columns under their public names, buckets in their order."""
    columns, order = scope.shown_keys, list(scope.key_columns)
    if agg.kind == "terms":
        # At the top the limit has sorted them already.
        order = order[:-1] + ["__rank"] if len(order) > 1 else []
    elif agg.kind == "date_histogram" and agg.options["format"]:
        columns.append(_key_text(F.col(order[-1]), agg.options["format"]).alias(f"{agg.name}_text"))
    if order:
        frame = frame.orderBy(*order)
    return frame.select(*columns, "doc_count", *[_quoted(n) for n, _, _ in metrics])


def _as_double(frame: DataFrame, name: str) -> Column:
    dtype = frame.schema[name].dataType
    col = F.col(_quoted(name))
    return (_millis(Field(name, col, dtype)) if isinstance(dtype, DATES) else col).cast("double")


class AggResult:
    """The DataFrames of an aggregation tree, looked up by the names on the path to them."""

    def __init__(self):
        self._frames: dict[tuple[str, ...], tuple[str, Later]] = {}
        self._metrics: dict[tuple[str, ...], str] = {}
        self._columns: dict[tuple[str, ...], tuple[str, ...]] = {}

    def put(
        self, path: tuple[str, ...], kind: str, frame: Later, below: Sequence[Agg], metrics: Sequence[str] = ()
    ) -> None:
        self._frames[path] = (kind, cache(frame))
        self._columns[path] = tuple(metrics)
        for agg in below:
            if agg.kind in METRICS:
                self._metrics[path + (agg.name,)] = agg.kind

    def _frame(self, path: tuple[str, ...], *kinds: str) -> DataFrame:
        if path not in self._frames:
            raise QueryError(f"no aggregation {'/'.join(path)!r} of kind {kinds}")
        kind, frame = self._frames[path]
        if kind not in kinds:
            raise QueryError(f"aggregation {'/'.join(path)!r} is {kind}, not {kinds}")
        return frame()

    def metrics(self) -> DataFrame:
        """All metrics at the top of the tree, as one row."""
        return self._frame((), "root")

    def buckets(self, *path: str) -> DataFrame:
        return self._frame(path, *BUCKETS)

    def all_buckets(self) -> DataFrame:
        """path, keys, doc_count, metrics: every bucket of the tree as one DataFrame, for one job.

        Keys are texts, the path's first being the first; metrics are doubles, dates epoch milliseconds.
        """
        out = []
        for path, (kind, later) in self._frames.items():
            if kind in BUCKETS:
                frame = later()
                pairs = [(F.lit(n), _as_double(frame, n)) for n in self._columns[path]]
                metrics = F.create_map(*[c for pair in pairs for c in pair]) if pairs else F.create_map()
                out.append(
                    frame.select(
                        F.lit("/".join(path)).alias("path"),
                        F.array(*[F.col(_quoted(n)).cast("string") for n in path]).alias("keys"),
                        "doc_count",
                        metrics.cast("map<string,double>").alias("metrics"),
                    )
                )
        if not out:
            raise QueryError("the tree has no buckets")
        return reduce(DataFrame.union, out)

    def nested(self, *path: str) -> DataFrame:
        return self._frame(path, "nested")

    def hits(self, *path: str) -> DataFrame:
        return self._frame(path, "top_hits")

    def value(self, *path: str):
        """A single metric at the top of the tree or below a nested aggregation there."""
        if self._metrics.get(path, "stats") == "stats":
            raise QueryError(f"no single-valued metric {'/'.join(path)!r}")
        return self._single(path[:-1])[path[-1]]

    def stats(self, *path: str) -> dict:
        if self._metrics.get(path) != "stats":
            raise QueryError(f"no stats {'/'.join(path)!r}")
        row = self._single(path[:-1])
        return {s: row[f"{path[-1]}_{s}"] for s in STATS}

    def _single(self, path: tuple[str, ...]) -> Row:
        return self._frame(path, "root", "nested").first()
