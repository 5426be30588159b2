"""Tables published as versions: a view under the public name points at one written version.

Spark cannot overwrite a table it is reading, so every change is written as a new version and the
view is moved to it. One writer per name is assumed: rows that reach the old version after the copy
has started are not carried over.
"""

from __future__ import annotations

import datetime
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.errors import QueryError
from quern.operators.writes import counted, flagged_upsert, upsert
from quern.sources.schema import conform

VERSIONS = "versions"


@dataclass(frozen=True)
class CopyReport:
    total: int
    created: int
    updated: int
    conflicts: int = 0  # batch jobs replace whole versions, so rows cannot conflict


@dataclass(frozen=True)
class Rebuilt:
    version: str
    previous: str | None
    rows: int


def scan(spark: SparkSession, name: str) -> DataFrame:
    """A table or view by name, or parquet files by path."""
    return spark.read.parquet(name) if "/" in name else spark.table(name)


def version_name(name: str, at: datetime.datetime | None = None) -> str:
    """``name_yyyyMMddHHmmssSSS``."""
    at = at or datetime.datetime.now(datetime.timezone.utc)
    return f"{name}_{at:%Y%m%d%H%M%S}{at.microsecond // 1000:03d}"


def versions_of(spark: SparkSession, name: str) -> list[str] | None:
    """The versions a published view reads, or None when ``name`` is a plain table or absent."""
    if not spark.catalog.tableExists(name) or not _is_view(spark, name):
        return None
    for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect():
        if row["key"] == VERSIONS:
            return row["value"].split(",")
    raise QueryError(f"view {name} was not published as versions")


def _is_view(spark: SparkSession, name: str) -> bool:
    return spark.catalog.getTable(name).tableType == "VIEW"


def publish(spark: SparkSession, name: str, versions: Sequence[str]) -> None:
    """Point the view ``name`` at these versions."""
    body = " UNION ALL ".join(f"SELECT * FROM {v}" for v in versions)
    spark.sql(f"CREATE OR REPLACE VIEW {name} TBLPROPERTIES ('{VERSIONS}' = '{','.join(versions)}') AS {body}")


def write_version(df: DataFrame, name: str, key: str | None = None, buckets: int | None = None) -> str:
    """Write a new version of ``name``, which is not published yet.

    With a ``key`` the rows are dealt into ``buckets`` and sorted by it: reads by key then look into the buckets of
    their keys, and joins by the key leave the table where it is.
    """
    version = version_name(name)
    if (key is None) != (buckets is None):
        raise QueryError("a layout by key needs a key and a number of buckets")
    if key is not None and buckets < 1:
        raise QueryError("a table needs at least one bucket")
    try:
        if key is None:
            df.write.format("parquet").saveAsTable(version)
        else:
            dealt = df.repartition(buckets, F.col(f"`{key}`"))
            dealt.write.format("parquet").bucketBy(buckets, key).sortBy(key).saveAsTable(version)
    except Exception:
        df.sparkSession.sql(f"DROP TABLE IF EXISTS {version}")
        raise
    return version


def layout(spark: SparkSession, table: str) -> dict:
    """The ``key`` and ``buckets`` of a version, to write the next one like it; empty where it has none."""
    found = {r["col_name"]: r["data_type"] for r in spark.sql(f"DESCRIBE EXTENDED {table}").collect()}
    if "Num Buckets" not in found:
        return {}
    return {"key": found["Bucket Columns"].strip("[]`"), "buckets": int(found["Num Buckets"])}


def copied(source: DataFrame, target: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Every source row upserted into the target's schema: (rows of the target, one-row report)."""
    change = upsert(target, conform(source, target.schema), key)
    report = change.counts.select(
        F.col("affected").alias("total"), "created", "updated", F.lit(0).cast("bigint").alias("conflicts")
    )
    return change.rows, report


def reindex(spark: SparkSession, source: str, target: str, key: str) -> CopyReport:
    """Copy every row of ``source`` into ``target``, which is created when absent."""
    if not spark.catalog.tableExists(source):
        raise QueryError(f"table {source} does not exist")
    if not spark.catalog.tableExists(target):
        spark.table(source).write.format("parquet").saveAsTable(target)
        total = spark.table(target).count()
        return CopyReport(total, total, 0)
    current, old = spark.table(target), versions_of(spark, target)
    seen = Observation()
    flagged = flagged_upsert(current, conform(spark.table(source), current.schema), key).hint("rebalance")
    version = write_version(counted(flagged, seen), target, **layout(spark, old[0] if old else target))
    done = seen.get
    if old is None:
        spark.sql(f"DROP TABLE {target}")
        spark.sql(f"ALTER TABLE {version} RENAME TO {target}")
    else:
        publish(spark, target, [version])
        for name in old:
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    return CopyReport(done["created"] + done["updated"], done["created"], done["updated"])


def rebuild(spark: SparkSession, name: str, declared: T.StructType) -> Rebuilt:
    """Write a new version with the declared schema, move the view to it, drop the version before.

    Starts from nothing (an empty version is published), from a plain table (which the view then
    replaces), or from a view on one version. A view on several is refused.
    """
    exists = spark.catalog.tableExists(name)
    old = versions_of(spark, name) if exists else None
    if old is not None and len(old) > 1:
        raise QueryError(f"{name} reads several versions {old}; rebuild needs one")
    if not exists:
        version = write_version(spark.createDataFrame([], declared), name)
        publish(spark, name, [version])
        return Rebuilt(version, None, 0)
    seen = Observation()
    counted_rows = conform(spark.table(name), declared).observe(seen, F.count(F.lit(1)).alias("rows"))
    version = write_version(counted_rows, name, **layout(spark, old[0] if old else name))
    copied_rows = seen.get["rows"]
    if old is None:
        # The table gives way only when the view that replaces it can be made.
        aside = f"{version}_before"
        spark.sql(f"ALTER TABLE {name} RENAME TO {aside}")
        try:
            publish(spark, name, [version])
        except Exception:
            spark.sql(f"ALTER TABLE {aside} RENAME TO {name}")
            raise
        spark.sql(f"DROP TABLE {aside}")
        return Rebuilt(version, name, copied_rows)
    publish(spark, name, [version])
    spark.sql(f"DROP TABLE {old[0]}")
    return Rebuilt(version, old[0], copied_rows)
