"""Typed handles on the columns of a table, so that predicates can check what they are given."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.errors import QueryError

# Keys used in StructField.metadata.
ANALYZER = "analyzer"
TOKENS_OF = "tokens_of"
LENGTH_OF = "length_of"


@dataclass(frozen=True, eq=False)
class Field:
    """One column (or one child field inside a nested array) with its declared type."""

    name: str
    col: Column
    dtype: T.DataType
    analyzer: str | None = None
    tokens: Column | None = None
    n_tokens: Column | None = None

    @property
    def is_text(self) -> bool:
        return self.analyzer is not None

    @property
    def is_nested(self) -> bool:
        return isinstance(self.dtype, T.ArrayType) and isinstance(self.dtype.elementType, T.StructType)

    @property
    def is_geo(self) -> bool:
        return isinstance(self.dtype, T.StructType) and {"lat", "lon"} <= set(self.dtype.fieldNames())

    def children_of(self, child: Column) -> Fields:
        """The fields of one element of this nested array."""
        if not self.is_nested:
            raise QueryError(f"{self.name} is not a nested field")
        return Fields(self.dtype.elementType, child.getField, prefix=self.name + ".")

    def child_fields_used(self, condition: Callable[[Fields], Column]) -> list[str]:
        """The child fields that a condition on the children looks at, in their declared order."""
        used: set[str] = set()

        def note(name: str) -> Column:
            used.add(name)
            return F.col(name)

        condition(Fields(self.dtype.elementType, note, prefix=self.name + "."))
        return [n for n in self.dtype.elementType.fieldNames() if n in used]


class Fields(Mapping[str, Field]):
    """Name -> Field. An unknown name raises."""

    def __init__(
        self,
        schema: T.StructType,
        column: Callable[[str], Column],
        text: Iterable[str] = (),
        prefix: str = "",
    ):
        self._schema, self._column, self._prefix = schema, column, prefix
        self._text = set(text)
        unknown = self._text - set(schema.fieldNames())
        if unknown:
            raise QueryError(f"unknown field {sorted(unknown)}")
        self._token_columns = self._marked(TOKENS_OF)
        self._length_columns = self._marked(LENGTH_OF)

    def _marked(self, mark: str) -> dict[str, str]:
        """Field -> the stored column that belongs to it."""
        return {f.metadata[mark]: f.name for f in self._schema.fields if f.metadata and mark in f.metadata}

    def __getitem__(self, name: str) -> Field:
        if name not in self._schema.fieldNames():
            raise QueryError(f"unknown field {self._prefix}{name}")
        spec = self._schema[name]
        analyzer = (spec.metadata or {}).get(ANALYZER)
        if analyzer is None and name in self._text:
            analyzer = "standard"
        tokens, n_tokens = self._token_columns.get(name), self._length_columns.get(name)
        return Field(
            name=self._prefix + name,
            col=self._column(name),
            dtype=spec.dataType,
            analyzer=analyzer,
            tokens=self._column(tokens) if tokens else None,
            n_tokens=self._column(n_tokens) if n_tokens else None,
        )

    def __iter__(self) -> Iterator[str]:
        return iter(self._schema.fieldNames())

    def __len__(self) -> int:
        return len(self._schema)


def fields(df: DataFrame, text: Iterable[str] = ()) -> Fields:
    """Handles for a DataFrame. ``text`` names full-text columns that carry no analyzer metadata."""
    return Fields(df.schema, lambda name: F.col("`" + name.replace("`", "``") + "`"), text)
