"""Inserts, updates and deletes as batch jobs: current table + change -> new table.

Nothing is changed in place. The caller writes ``Change.rows`` as a new version and publishes it
(``quern.sources.versions``). A null in a patch means "not given"; a patch cannot clear a field.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from quern.errors import QueryError
from quern.functions import predicates as P
from quern.functions.fields import Fields, fields
from quern.operators.reads import MAX_LITERAL_IDS, as_keys, id_frame, with_ids
from quern.operators.topn import key_set


@dataclass(frozen=True)
class Change:
    """``rows``: the table after the change. ``counts``: one row that says what it did."""

    rows: DataFrame
    counts: DataFrame

    def affected(self) -> int:
        return self.counts.first()["affected"]


def _known(df: DataFrame, names: Iterable[str]) -> Fields:
    known = fields(df)
    for name in names:
        known[name]  # raises on unknown names
    return known


def _with_key(batch: DataFrame, key: str) -> DataFrame:
    missing = F.raise_error(F.lit(f"a row of the batch has no {key}")).cast(batch.schema[key].dataType)
    # The condition, which raising makes true, is what joins by the key add anyway: with it here, all uses of the
    # batch have the same plan up to its shuffle.
    return batch.withColumn(key, F.coalesce(F.col(key), missing)).filter(F.col(key).isNotNull())


def _full_row(current: DataFrame, batch: DataFrame, ordinal: str | None) -> list[Column]:
    """The table's columns from a row of the batch; those it lacks are null."""
    given = [c for c in batch.columns if c != ordinal]
    known = fields(current)
    return [(F.col(n) if n in given else F.lit(None)).cast(known[n].dtype).alias(n) for n in current.columns]


def _last_rows(current: DataFrame, batch: DataFrame, key: str, ordinal: str | None) -> DataFrame:
    """key and ``__row``: the last row per key of the batch, from groups that all uses share."""
    _known(current, [key, *(c for c in batch.columns if c != ordinal)])
    batch = _with_key(batch, key)
    if ordinal is not None:
        order = F.struct(F.col(ordinal).isNotNull(), F.col(ordinal))
        row = F.struct(*[c for c in batch.columns if c != ordinal])
        kept = batch.groupBy(key).agg(F.max_by(row, order).alias("__row"))
    else:
        repeated = F.raise_error(F.concat(F.lit(f"{key} repeats in the batch: "), F.col(key).cast("string")))
        kept = batch.groupBy(key).agg(F.count(F.lit(1)).alias("__n"), F.first(F.struct("*")).alias("__row"))
        kept = kept.filter(F.when(F.col("__n") == 1, True).otherwise(repeated.cast("boolean")))
    # Rows and keys come from the same shuffled groups, which Spark computes once: the condition, true for
    # every group, keeps their rows in use where only the keys are asked for.
    return kept.filter(F.col("__row").isNotNull())


# Columns of the row-by-row forms, which say what becomes of a row.
CREATED, UPDATED, DELETED = "__created", "__updated", "__deleted"


def flagged_upsert(current: DataFrame, batch: DataFrame, key: str, ordinal: str | None = None) -> DataFrame:
    """``upsert`` in one join: the rows after it, each marked as created, updated or neither.

    For writes that count what they write (``counted``). A key must not repeat in the table.
    """
    kept = _last_rows(current, batch, key, ordinal)
    given = kept.select("__row.*").select(F.struct(*_full_row(current, batch, ordinal)).alias("__new"))
    old = current.select(F.struct(*[F.col(c) for c in current.columns]).alias("__old"))
    joined = old.join(given, F.col("__old")[key] == F.col("__new")[key], "full")
    new, had = F.col("__new").isNotNull(), F.col("__old").isNotNull()
    values = [F.when(new, F.col("__new")[c]).otherwise(F.col("__old")[c]).alias(c) for c in current.columns]
    return joined.select(*values, (new & ~had).alias(CREATED), (new & had).alias(UPDATED), F.lit(False).alias(DELETED))


def patched(current: DataFrame, patches: DataFrame, key: str, ordinal: str | None = None) -> DataFrame:
    """``update_batch`` in one join, rows marked likewise. Patches for unknown keys change nothing."""
    given, patch = _patch(current, patches, key, ordinal)
    known = fields(current)
    joined = current.join(patch.withColumn("__hit", F.lit(1)), key, "left")
    merged = {c: F.coalesce(F.col(f"__new_{c}").cast(known[c].dtype), F.col(c)) for c in given}
    flags = {CREATED: F.lit(False), UPDATED: F.col("__hit").isNotNull(), DELETED: F.lit(False)}
    return joined.withColumns(merged | flags).select(*current.columns, CREATED, UPDATED, DELETED)


def flagged_delete(current: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """All rows, marked as deleted where their key is among ``ids`` (one column)."""
    field = _known(current, [key])[key]
    wanted = ids.select(F.col(ids.columns[0]).cast(field.dtype).alias("__id")).filter("__id is not null").distinct()
    joined = current.join(wanted, field.col == F.col("__id"), "left")
    return joined.select(*current.columns, F.lit(False).alias(CREATED), F.lit(False).alias(UPDATED), F.col("__id").isNotNull().alias(DELETED))


def counted(flagged: DataFrame, seen: Observation, *also: Column) -> DataFrame:
    """The rows that stay, without marks; the job that writes them leaves rows, created, updated and deleted in ``seen``.

    To be used behind the last shuffle: there a row is seen once, however often a task before it is run again.
    """
    stays = F.count_if(~F.col(DELETED)).alias("rows")
    counts = [F.count_if(name).alias(name.strip("_")) for name in (CREATED, UPDATED, DELETED)]
    return flagged.observe(seen, stays, *counts, *also).filter(~F.col(DELETED)).drop(CREATED, UPDATED, DELETED)


def upsert(current: DataFrame, batch: DataFrame, key: str, ordinal: str | None = None) -> Change:
    """Whole-row insert or replace by key; columns the batch lacks become null.

    The last row per key by ``ordinal`` counts. Without ``ordinal`` keys must be unique in the batch,
    and a repeated one raises. A null key raises.
    """
    kept = _last_rows(current, batch, key, ordinal)
    keys = kept.select(key)
    batch = kept.select("__row.*").select(*_full_row(current, batch, ordinal))
    rows = current.join(keys, key, "left_anti").unionByName(batch)
    present = current.select(key).withColumn("__hit", F.lit(1))
    counts = (
        keys
        .join(present, key, "left")
        .agg(F.count(F.lit(1)).alias("affected"), F.count("__hit").alias("updated"))
        .select("affected", (F.col("affected") - F.col("updated")).alias("created"), "updated")
    )
    return Change(rows, counts)


def delete_by_ids(current: DataFrame, key: str, ids: DataFrame | Iterable[Any]) -> Change:
    """Remove rows by key. ``ids`` is a collection or a one-column DataFrame of any size."""
    field = _known(current, [key])[key]
    if not isinstance(ids, DataFrame):
        ids = as_keys(field, ids)
        if len(ids) <= MAX_LITERAL_IDS:
            gone = P.is_in(field, ids)
            return Change(current.filter(~F.coalesce(gone, F.lit(False))), _count(current.filter(gone)))
        ids = id_frame(current, field, ids)
    wanted = key_set(ids, ids.columns[0], "__id")
    rows = current.join(wanted, field.col == F.col("__id"), "left_anti")
    return Change(rows, _count(with_ids(current, field, ids)))


def delete_where(current: DataFrame, condition: Column | None) -> Change:
    """Remove the rows that match. No condition raises."""
    _needs(condition, "delete")
    return Change(current.filter(~F.coalesce(condition, F.lit(False))), _count(current.filter(condition)))


def update_by_id(current: DataFrame, key: str, value: Any, patch: Mapping[str, Any]) -> Change:
    """Overlay the given values on the row with this key. No such row changes nothing.

    A row that has these values already does not count as affected.
    """
    if value is None:
        raise QueryError("update needs a key value")
    found = F.col(key) == F.lit(value)
    rest = {n: v for n, v in patch.items() if n != key and v is not None}
    _known(current, rest)
    changed = [~F.col(n).eqNullSafe(F.lit(v).cast(current.schema[n].dataType)) for n, v in rest.items()]
    differs = reduce(lambda a, b: a | b, changed, F.lit(False))
    return Change(_overlay(current, found, rest), _count(current.filter(found & differs)))


def update_where(current: DataFrame, condition: Column | None, patch: Mapping[str, Any]) -> Change:
    """Set the patch's values on every matching row. An empty patch or no condition raises."""
    _needs(condition, "update")
    if not any(v is not None for v in (patch or {}).values()):
        raise QueryError("update needs at least one value")
    return Change(_overlay(current, condition, patch), _count(current.filter(condition)))


def _patch(current: DataFrame, patches: DataFrame, key: str, ordinal: str | None) -> tuple[list[str], DataFrame]:
    """(patched columns, one row per key with their last given values as ``__new_*``)."""
    given = [c for c in patches.columns if c not in (key, ordinal)]
    known = _known(current, [key, *given])
    patches = _with_key(patches, key)
    if ordinal is not None:
        last = [F.max_by(c, F.when(F.col(c).isNotNull(), F.col(ordinal))).alias(c) for c in given]
    else:
        repeated = F.raise_error(F.concat(F.lit(f"{key} repeats in the patches: "), F.col(key).cast("string")))
        last = [F.first(c).alias(c) for c in given]
    grouped = patches.groupBy(key).agg(F.count(F.lit(1)).alias("__n"), *last)
    if ordinal is None:
        grouped = grouped.filter(F.when(F.col("__n") == 1, True).otherwise(repeated.cast("boolean")))
    patch = grouped.select(key, *[F.col(c).alias(f"__new_{c}") for c in given])
    return given, patch


def update_batch(
    current: DataFrame, patches: DataFrame, key: str, ordinal: str | None = None, strict: bool = True
) -> Change:
    """Overlay many patches, each with its own set of given (non-null) columns.

    Several patches to one key apply in ``ordinal`` order, so per column the last given value wins;
    without ``ordinal`` a repeated key raises. A null key raises, and so does a key that the table
    lacks unless ``strict`` is off; that check is a job over the keys alone.
    """
    given, patch = _patch(current, patches, key, ordinal)
    known = fields(current)
    present = current.select(key).withColumn("__hit", F.lit(1))
    counts = (
        patch.select(key)
        .join(present, key, "left")
        .agg(F.count("__hit").alias("affected"), F.count_if(F.col("__hit").isNull()).alias("missing"))
    )
    if strict:
        missing = counts.first()["missing"]
        if missing:
            raise QueryError(f"{missing} patched keys are not in the table")
    merged = {c: F.coalesce(F.col(f"__new_{c}").cast(known[c].dtype), F.col(c)) for c in given}
    rows = current.join(patch, key, "left").withColumns(merged).select(*current.columns)
    return Change(rows, counts)


def _needs(condition: Column | None, what: str) -> None:
    if condition is None:
        raise QueryError(f"{what} needs a condition; it would change every row")


def _overlay(current: DataFrame, found: Column, patch: Mapping[str, Any]) -> DataFrame:
    values = {n: v for n, v in patch.items() if v is not None}
    known = _known(current, values)
    hit = F.coalesce(found, F.lit(False))
    changed = {n: F.when(hit, F.lit(v).cast(known[n].dtype)).otherwise(known[n].col) for n, v in values.items()}
    return current.withColumns(changed) if changed else current


def _count(matched: DataFrame) -> DataFrame:
    return matched.agg(F.count(F.lit(1)).alias("affected"))
