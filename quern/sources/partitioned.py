"""Tables dealt into partitions by a hash of their key, so that a change rewrites only the partitions its keys fall into.

A batch's keys name its partitions. Only those are read, changed and written back by dynamic partition overwrite, which
writes beside the old files and swaps them in when the job is done; all other partitions keep their files. By-key reads
look into the partitions of their keys. What a write did is counted by the write itself.

One writer per table is assumed. A reader that lists files while a job swaps partitions may see some before and some
after; tables that need one step from state to state are published as versions (``quern.sources.versions``).
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from quern.errors import QueryError
from quern.functions.fields import fields
from quern.operators.reads import as_keys, id_frame, with_ids
from quern.operators.writes import DELETED, counted, flagged_delete, flagged_upsert, patched

PART = "__part"
# The bits of one of Spark's bitmaps, which tells the partitions that were written.
MOST_PARTS = 32_768
KEY_PROPERTY, PARTS_PROPERTY = "quern.key", "quern.parts"


@dataclass(frozen=True)
class Partitioned:
    name: str
    key: str
    parts: int

    def part_of(self, key: Column) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.parts)).cast("int")


@dataclass(frozen=True)
class Written:
    """What a write did, and how many partitions it rewrote."""

    created: int
    updated: int
    deleted: int
    partitions: int


def create(df: DataFrame, name: str, key: str, parts: int = 1024) -> Partitioned:
    """Write ``df`` as a new table of at most ``parts`` partitions. The key's type must not change later."""
    if not 1 <= parts <= MOST_PARTS:
        raise QueryError(f"a table has 1 to {MOST_PARTS} partitions, not {parts}")
    if PART in df.columns:
        raise QueryError(f"{PART} is the name of the partition column")
    fields(df)[key]
    table = Partitioned(name, key, parts)
    # Kept with the table, so that writes into it replace only the partitions they hold rows of.
    out = _dealt(df, table).write.format("parquet").option("partitionOverwriteMode", "dynamic")
    out.partitionBy(PART).saveAsTable(name)
    df.sparkSession.sql(f"ALTER TABLE {name} SET TBLPROPERTIES ('{KEY_PROPERTY}' = '{key}', '{PARTS_PROPERTY}' = '{parts}')")
    return table


def opened(spark: SparkSession, name: str) -> Partitioned:
    if not spark.catalog.tableExists(name):
        raise QueryError(f"table {name} does not exist")
    found = {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
    if PARTS_PROPERTY not in found:
        raise QueryError(f"table {name} is not partitioned by a key's hash")
    return Partitioned(name, found[KEY_PROPERTY], int(found[PARTS_PROPERTY]))


def rows(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name).drop(PART)


def rows_with_ids(spark: SparkSession, name: str, ids: DataFrame | Iterable[Any]) -> DataFrame:
    """``with_ids`` that reads only the partitions of the ids."""
    table = opened(spark, name)
    current = spark.table(name)
    key = fields(current)[table.key]
    if not isinstance(ids, DataFrame):
        ids = as_keys(key, ids)
    found = ids if isinstance(ids, DataFrame) else id_frame(current, key, ids)
    parts = _parts(spark, table, found, found.columns[0])
    some = current.filter(F.col(PART).isin(parts) if parts else F.lit(False))
    return with_ids(some, key, ids).drop(PART)


def upsert_into(spark: SparkSession, name: str, batch: DataFrame, ordinal: str | None = None) -> Written:
    """``writes.upsert`` on the partitions of the batch's keys."""
    table = opened(spark, name)
    return _rewritten(spark, table, batch, table.key, lambda current: flagged_upsert(current, batch, table.key, ordinal))


def update_into(spark: SparkSession, name: str, patches: DataFrame, ordinal: str | None = None) -> Written:
    """``writes.update_batch`` on the partitions of the patches' keys; patches for unknown keys change nothing."""
    table = opened(spark, name)
    return _rewritten(spark, table, patches, table.key, lambda current: patched(current, patches, table.key, ordinal))


def delete_from(spark: SparkSession, name: str, ids: DataFrame | Iterable[Any]) -> Written:
    """``writes.delete_by_ids`` on the partitions of the ids."""
    table = opened(spark, name)
    if not isinstance(ids, DataFrame):
        key = fields(spark.table(name))[table.key]
        ids = id_frame(spark.table(name), key, as_keys(key, ids))
    given = ids.filter(F.col(ids.columns[0]).isNotNull())
    return _rewritten(spark, table, given, given.columns[0], lambda current: flagged_delete(current, table.key, given))


def _parts(spark: SparkSession, table: Partitioned, df: DataFrame, key: str) -> list[int]:
    """The partitions of the keys in a column: at most as many numbers as the table has partitions."""
    of = F.col(key).cast(spark.table(table.name).schema[table.key].dataType)
    return [r[0] for r in df.select(table.part_of(of)).distinct().collect()]


def _dealt(df: DataFrame, table: Partitioned) -> DataFrame:
    """Rows next to the others of their partition; large partitions go to several tasks."""
    return df.withColumn(PART, table.part_of(F.col(table.key))).hint("rebalance", PART)


def _rewritten(
    spark: SparkSession, table: Partitioned, by: DataFrame, key: str, change: Callable[[DataFrame], DataFrame]
) -> Written:
    """Write the changed rows of the partitions that a batch names in place of those.

    One job reads, changes, counts and writes them.
    """
    parts = _parts(spark, table, by, key)
    if not parts:
        return Written(0, 0, 0, 0)
    current = spark.table(table.name).filter(F.col(PART).isin(parts)).drop(PART)
    seen = Observation()
    left = F.bitmap_construct_agg(F.when(~F.col(DELETED), F.col(PART))).alias("parts")
    out = counted(_dealt(change(current), table), seen, left).select(*current.columns, PART)
    out.write.mode("overwrite").insertInto(table.name)
    found = seen.get
    # Nothing is written to a partition without rows, which leaves its files as they were.
    for part in parts:
        if not found["parts"][part // 8] >> part % 8 & 1:
            spark.sql(f"ALTER TABLE {table.name} DROP IF EXISTS PARTITION ({PART} = {part})")
    spark.catalog.refreshTable(table.name)
    return Written(found["created"], found["updated"], found["deleted"], len(parts))
