"""Filter predicates. Each returns a boolean Column, to be combined with ``&`` and ``|``.

As in any Spark condition, ``a | b & c`` means ``a | (b & c)``. ``all_of`` and ``any_of`` do the same
for lists and skip ``None``; a list with nothing in it gives ``None``, the condition that matches all
rows on reads and that deletes and updates refuse.
"""

from __future__ import annotations

import functools
import operator
import re
from collections.abc import Callable, Iterable, Mapping
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.errors import QueryError
from quern.functions.fields import Field, Fields


def _not_text(field: Field, what: str) -> None:
    if field.is_text:
        raise QueryError(f"{what} does not apply to text field {field.name}; use match")


def _value(value: Any, what: str) -> Any:
    if value is None:
        raise QueryError(f"{what} needs a value; use is_null to look for missing ones")
    return value


def eq(field: Field, value: Any) -> Column:
    _not_text(field, "eq")
    return field.col == F.lit(_value(value, "eq"))


def ne(field: Field, value: Any) -> Column:
    """Not equal. Rows without a value match too."""
    _not_text(field, "ne")
    return ~field.col.eqNullSafe(F.lit(_value(value, "ne")))


def is_in(field: Field, *values: Any) -> Column:
    """One of the values, given one by one or as one collection. No values match nothing."""
    _not_text(field, "is_in")
    if len(values) == 1 and isinstance(values[0], Iterable) and not isinstance(values[0], (str, bytes)):
        values = tuple(values[0])
    wanted = [_value(v, "is_in") for v in values]
    return field.col.isin(wanted) if wanted else F.lit(False)


def gt(field: Field, value: Any) -> Column:
    return field.col > F.lit(_value(value, "gt"))


def ge(field: Field, value: Any) -> Column:
    return field.col >= F.lit(_value(value, "ge"))


def lt(field: Field, value: Any) -> Column:
    return field.col < F.lit(_value(value, "lt"))


def le(field: Field, value: Any) -> Column:
    return field.col <= F.lit(_value(value, "le"))


def between(field: Field, low: Any, high: Any) -> Column:
    """Both ends included."""
    return field.col.between(F.lit(_value(low, "between")), F.lit(_value(high, "between")))


def like(field: Field, value: str) -> Column:
    r"""Contains ``value``, in which ``*`` stands for any run, ``?`` for one character, ``\`` escapes.

    Written as LIKE: Spark turns the wildcard-free case into a ``contains`` that reaches the scan.
    """
    _not_text(field, "like")
    pattern, chars = "", iter(str(_value(value, "like")))
    for char in chars:
        if char == "*":
            pattern += "%"
        elif char == "?":
            pattern += "_"
        else:
            if char == "\\":
                char = next(chars, "\\")
            pattern += "\\" + char if char in "%_\\" else char
    return field.col.like("%" + pattern + "%")


def prefix(field: Field, value: str) -> Column:
    _not_text(field, "prefix")
    return field.col.startswith(F.lit(str(_value(value, "prefix"))))


def auto_edits(value: str) -> int:
    """Edits allowed by default: none below 3 characters, one below 6, else two."""
    return 0 if len(value) < 3 else 1 if len(value) < 6 else 2


def fuzzy(field: Field, value: str, edits: int | None = None) -> Column:
    """The whole value within ``edits`` (0-2) insertions, deletions, replacements or swaps of neighbours."""
    _not_text(field, "fuzzy")
    value = str(_value(value, "fuzzy"))
    edits = auto_edits(value) if edits is None else edits
    if edits not in (0, 1, 2):
        raise QueryError(f"fuzzy allows 0 to 2 edits, not {edits}")
    if edits == 0:
        return field.col == F.lit(value)
    col = field.col
    close = F.levenshtein(col, F.lit(value), edits) >= 0
    swapped = [
        (value[:i], value[i + 1] + value[i], value[i + 2 :])
        for i in range(len(value) - 1)
        if value[i] != value[i + 1]
    ]
    if not swapped:
        return close
    # A swap costs one edit, which plain Levenshtein counts as two. With one edit only the swapped values
    # themselves are added; with two the part before or after the swap may take one more edit.
    if edits == 1:
        near = col.isin([before + pair + after for before, pair, after in swapped])
    else:
        cases = F.array(
            *[
                F.struct(
                    F.lit(before).alias("before"),
                    F.lit(pair + after).alias("ending"),
                    F.lit(before + pair).alias("beginning"),
                    F.lit(after).alias("after"),
                )
                for before, pair, after in swapped
            ]
        )
        near = F.exists(cases, lambda case: _one_more_edit(col, case))
    in_reach = F.length(col).between(len(value) - edits, len(value) + edits)
    return in_reach & (close | near)


def _one_more_edit(col: Column, case: Column) -> Column:
    before, after, beginning, ending = (case[n] for n in ("before", "after", "beginning", "ending"))
    start = F.substring(col, F.lit(1), F.length(col) - F.length(ending))
    rest = F.substring(col, F.length(beginning) + 1, F.length(col))
    swap_in_rest = F.exists(
        F.sequence(F.lit(1), F.greatest(F.length(after) - 1, F.lit(1))),
        lambda i: rest
        == F.concat(
            F.substring(after, F.lit(1), i - 1),
            F.substring(after, i + 1, F.lit(1)),
            F.substring(after, i, F.lit(1)),
            F.substring(after, i + 2, F.length(after)),
        ),
    )
    return (col.endswith(ending) & (F.levenshtein(before, start, 1) >= 0)) | (
        col.startswith(beginning) & ((F.levenshtein(after, rest, 1) >= 0) | swap_in_rest)
    )


def is_null(field: Field) -> Column:
    """No value. An empty nested array counts as none."""
    if isinstance(field.dtype, T.ArrayType):
        return field.col.isNull() | (F.size(field.col) == 0)
    return field.col.isNull()


def nested(field: Field, condition: Callable[[Fields], Column]) -> Column:
    """Some single child meets the whole condition. Children may be nested further."""
    if not field.is_nested:
        raise QueryError(f"{field.name} is not a nested field")
    used, inside, prefix = field.child_fields_used(condition), field.dtype.elementType, field.name + "."
    # An array of just the fields in use lets the scan leave out the others. One field is an array by
    # itself; several are zipped, which pays when they are the smaller part of a child.
    if len(used) == 1:
        return F.exists(field.col[used[0]], lambda value: condition(Fields(inside, lambda _: value, prefix=prefix)))
    if 2 * len(used) <= len(inside):
        zipped = F.arrays_zip(*[field.col[n] for n in used])  # keeps the names
        return F.exists(zipped, lambda child: condition(Fields(inside, child.getField, prefix=prefix)))
    return F.exists(field.col, lambda child: condition(field.children_of(child)))


def all_of(*conditions: Column | None) -> Column | None:
    given = [c for c in conditions if c is not None]
    return functools.reduce(operator.and_, given) if given else None


def any_of(*conditions: Column | None) -> Column | None:
    given = [c for c in conditions if c is not None]
    return functools.reduce(operator.or_, given) if given else None


def match_all() -> None:
    """The condition that keeps every row."""
    return None


def with_script(df: DataFrame, name: str, source: str, params: Mapping[str, Any] | None = None) -> DataFrame:
    """Add the boolean Spark SQL expression ``source`` as column ``name``, to be used in a condition.

    ``source`` refers to parameters as ``:p``; their values are bound by Spark, never pasted in.
    """
    return _with_expression(df, name, source, params, T.BooleanType)


def _not_blank(source: str) -> None:
    if not source or not source.strip():
        raise QueryError("script source is blank")


def _with_expression(df: DataFrame, name: str, source: str, params: Mapping[str, Any] | None, kind: type) -> DataFrame:
    _not_blank(source)
    escaped, column = (text.replace("{", "{{").replace("}", "}}") for text in (source, quoted(name)))
    out = df.sparkSession.sql(f"SELECT *, ({escaped}\n) AS {column} FROM {{df}}", args=dict(params or {}), df=df)
    if out.columns != [*df.columns, name] or not isinstance(out.schema[name].dataType, kind):
        raise QueryError("script source must be one condition")
    return out


def script(df: DataFrame, source: str, params: Mapping[str, Any] | None = None) -> DataFrame:
    """The rows for which the Spark SQL condition ``source`` is true."""
    return with_script(df, "__script", source, params).filter("__script").drop("__script")


def with_nested_script(
    df: DataFrame, name: str, field: Field, source: str, params: Mapping[str, Any] | None = None
) -> DataFrame:
    """Add as column ``name`` whether some single child of ``field`` meets the Spark SQL condition ``source``.

    In ``source`` the names of the children's fields are those fields, also where the table has columns of these
    names; ``<field>.<child field>`` works too, and other names are the table's columns. Without a child: false.
    """
    return with_script(df, name, _over_children(field, "exists", source), params)


def nested_script(df: DataFrame, field: Field, source: str, params: Mapping[str, Any] | None = None) -> DataFrame:
    """The rows with a child for which the Spark SQL condition ``source`` is true."""
    return with_nested_script(df, "__script", field, source, params).filter("__script").drop("__script")


def with_script_hits(
    df: DataFrame, name: str, field: Field, source: str, size: int, params: Mapping[str, Any] | None = None
) -> DataFrame:
    """Add as column ``name`` the first ``size`` children that meet ``source``, as an array (empty where none does)."""
    if size <= 0:
        raise QueryError("the number of children must be positive")
    children = f"coalesce(slice({_over_children(field, 'filter', source)}, 1, {int(size)}), array())"
    return _with_expression(df, name, children, params, T.ArrayType)


def _over_children(field: Field, function: str, source: str) -> str:
    """``function`` (exists, filter) over the children with ``source`` as its condition.

    Spark's own parser binds the names: the condition stands inside one lambda per child field, whose variable has the
    field's name, and inner variables come before columns.
    """
    if not field.is_nested:
        raise QueryError(f"{field.name} is not a nested field")
    _not_blank(source)
    child = quoted(field.name)
    # Only fields whose name occurs in the text can be meant.
    used = [n for n in field.dtype.elementType.fieldNames() if re.search(rf"(?<!\w){re.escape(n)}(?!\w)", source, re.IGNORECASE)]
    inside = f"coalesce(({source}\n), false)"
    # A child field with the name of the array itself goes innermost, where it hides nothing the others need.
    for n in sorted(used, key=lambda n: n.lower() != field.name.lower()):
        inside = f"element_at(transform(array({child}.{quoted(n)}), {quoted(n)} -> {inside}), 1)"
    found = f"{function}({child}, {child} -> {inside})"
    return f"coalesce({found}, false)" if function == "exists" else found


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def where(df: DataFrame, condition: Column | None) -> DataFrame:
    """Filter, with ``None`` keeping every row."""
    return df if condition is None else df.filter(condition)
