"""Corpus statistics as a table: what BM25 needs to know about all rows, counted once and kept.

The table has one row per field with the number of its rows that hold a token and their tokens (``term`` is null), and
one per field and term with the number of rows that hold the term. Every number is a sum over rows, so the statistics
of a batch can simply be appended to the stored ones, taken off again when its rows are deleted, and added up at any
time: ``rank(..., corpus=)`` adds up what it reads, and looks at the rows of its own words only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.errors import QueryError
from quern.functions.fields import Field
from quern.functions.text import tokens

SCHEMA = "field string, term string, rows bigint, tokens bigint"
COLUMNS = ["field", "term", "rows", "tokens"]


def corpus_statistics(df: DataFrame, over: Sequence[Field]) -> DataFrame:
    """field, term, rows, tokens: the statistics of the text fields ``over`` of ``df``.

    One pass: every row gives its distinct terms, which are counted map-side, so that a term all rows hold is one row per
    task. Null and empty texts give nothing.
    """
    if not over:
        raise QueryError("statistics need at least one text field")
    names = [field.name for field in over]
    if len(set(names)) < len(names):
        raise QueryError(f"fields repeat: {names}")
    for field in over:
        if not field.is_text:
            raise QueryError(f"{field.name} is not a text field")
    # Columns of their own: a text is split once per row, and its tokens are counted in what that gave.
    split = df.select(
        *[F.coalesce(tokens(field), F.array().cast("array<string>")).alias(f"t{i}") for i, field in enumerate(over)],
        *[field.n_tokens.alias(f"n{i}") for i, field in enumerate(over) if field.n_tokens is not None],
    )
    texts = []
    for i, field in enumerate(over):
        found = F.col(f"t{i}")
        number = F.size(found) if field.n_tokens is None else F.col(f"n{i}")
        texts.append(F.struct(F.lit(field.name).alias("field"), found.alias("found"), number.cast("bigint").alias("n")))
    held = split.select(F.explode(F.array(*texts)).alias("e")).select("e.*").where(F.size("found") > 0)
    # First a null, which stands for the text as a whole.
    entries = F.concat(F.array(F.lit(None).cast("string")), F.array_distinct("found"))
    counted = held.select("field", "n", F.posexplode(entries).alias("at", "term")).select(
        "field",
        "term",
        F.lit(1).cast("bigint").alias("rows"),
        F.when(F.col("at") == 0, F.col("n")).otherwise(F.lit(0)).alias("tokens"),
    )
    return _added_up(counted)


def _added_up(parts: DataFrame) -> DataFrame:
    sums = [F.sum(c).alias(c) for c in ("rows", "tokens")]
    return parts.groupBy("field", "term").agg(*sums).where("rows <> 0").select(*COLUMNS)


def merge_statistics(*parts: DataFrame) -> DataFrame:
    """The statistics of all rows from those of disjoint parts, one row per field and term again."""
    if not parts:
        raise QueryError("nothing to merge")
    return _added_up(reduce(DataFrame.union, [check_statistics(p).select(*COLUMNS) for p in parts]))


def without_statistics(stored: DataFrame, deleted: DataFrame) -> DataFrame:
    """``stored`` less the statistics of rows that are gone. Those of rows as they were, where rows were updated."""
    taken_off = check_statistics(deleted).select("field", "term", (-F.col("rows")).alias("rows"), (-F.col("tokens")).alias("tokens"))
    return merge_statistics(stored, taken_off)


def check_statistics(table: DataFrame) -> DataFrame:
    missing = set(COLUMNS) - set(table.columns)
    if missing:
        raise QueryError(f"a statistics table has the columns {COLUMNS}; {sorted(missing)} are missing")
    return table
