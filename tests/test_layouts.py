"""Partitioned tables, whose changes leave other partitions alone, and versions dealt into buckets."""

import glob
import os
import uuid

import pytest
from pyspark.sql import functions as F

from quern.errors import QueryError
from quern.functions.fields import fields
from quern.operators import reads as R
from quern.operators import writes as W
from quern.sources import partitioned as PT
from quern.sources import versions as V
from tests.test_plans import plan as formatted


@pytest.fixture
def name():
    return f"laid_{uuid.uuid4().hex[:10]}"


@pytest.fixture
def table(spark, name):
    df = spark.range(500).select("id", (F.col("id") % 7).alias("v"), F.concat(F.lit("t"), "id").alias("s"))
    return PT.create(df, name, "id", 16)


def files(spark, name):
    """Files by partition."""
    place = spark.sql(f"DESCRIBE EXTENDED {name}").where("col_name = 'Location'").first()["data_type"].removeprefix("file:")
    found = {}
    for path in glob.glob(f"{place}/{PT.PART}=*/*.parquet"):
        found.setdefault(int(path.split(f"{PT.PART}=")[1].split("/")[0]), set()).add(os.path.basename(path))
    return found


def rows(spark, name):
    return {r["id"]: (r["v"], r["s"]) for r in PT.rows(spark, name).collect()}


def test_an_upsert_rewrites_only_its_partitions(spark, name, table):
    before, old = files(spark, name), rows(spark, name)
    assert len(before) == 16
    batch = spark.createDataFrame([(5, 1, 100), (5, 2, 200), (9999, 1, 1)], "id int, n int, v bigint")
    done = PT.upsert_into(spark, name, batch, "n")
    assert (done.created, done.updated, done.deleted) == (1, 1, 0) and done.partitions <= 2
    after = files(spark, name)
    changed = {p for p in after if after[p] != before.get(p)}
    assert len(changed) == done.partitions
    assert all(not (after[p] & before.get(p, set())) for p in changed)
    assert rows(spark, name) == old | {5: (200, None), 9999: (1, None)}
    assert spark.table(name).where(f"{PT.PART} in ({', '.join(map(str, changed))})").count() < 500


def test_deletes_and_patches(spark, name, table):
    old = rows(spark, name)
    done = PT.delete_from(spark, name, [1, "2", 3, 3, None, 77777])
    assert (done.created, done.updated, done.deleted) == (0, 0, 3)
    kept = {i: r for i, r in old.items() if i not in (1, 2, 3)}
    assert rows(spark, name) == kept
    patches = spark.createDataFrame([(4, None, "x"), (5, 50, None), (1, 9, "gone")], "id bigint, v bigint, s string")
    done = PT.update_into(spark, name, patches)
    assert (done.created, done.updated, done.deleted) == (0, 2, 0)
    assert rows(spark, name) == kept | {4: (kept[4][0], "x"), 5: (50, kept[5][1])}
    assert PT.delete_from(spark, name, []).partitions == 0
    assert PT.upsert_into(spark, name, patches.where("false")).partitions == 0


def test_emptied_partitions_are_dropped_and_filled_again(spark, name, table):
    one = [r["id"] for r in spark.table(name).where(f"{PT.PART} = 3").collect()]
    assert PT.delete_from(spark, name, one).deleted == len(one)
    assert 3 not in files(spark, name) and spark.table(name).count() == 500 - len(one)
    everything = spark.table(name).select("id")
    assert PT.delete_from(spark, name, everything).deleted == 500 - len(one)
    assert files(spark, name) == {} and rows(spark, name) == {}
    done = PT.upsert_into(spark, name, spark.range(20).select("id", F.lit(1).cast("bigint").alias("v")))
    assert (done.created, done.updated) == (20, 0) and len(rows(spark, name)) == 20


def test_changes_equal_those_of_whole_tables(spark, name, table):
    current = PT.rows(spark, name)
    batch = spark.range(450, 600).select("id", (F.col("id") * 2).alias("v"))
    expected = sorted(map(tuple, W.upsert(current, batch, "id").rows.collect()))
    PT.upsert_into(spark, name, batch)
    assert sorted(map(tuple, PT.rows(spark, name).collect())) == expected


def test_wrong_batches_change_nothing(spark, name, table):
    old, before = rows(spark, name), files(spark, name)
    for wrong in (
        spark.createDataFrame([(1, 1), (1, 2)], "id bigint, v bigint"),
        spark.createDataFrame([(None, 1)], "id bigint, v bigint"),
    ):
        with pytest.raises(Exception, match="repeats|has no id"):
            PT.upsert_into(spark, name, wrong)
    with pytest.raises(QueryError):
        PT.upsert_into(spark, name, spark.createDataFrame([(1, 1)], "id bigint, nothing bigint"))
    with pytest.raises(QueryError):
        PT.delete_from(spark, name, ["one"])
    assert rows(spark, name) == old and files(spark, name) == before
    for wrong in (0, 40_000):
        with pytest.raises(QueryError):
            PT.create(spark.range(3), name + "_x", "id", wrong)
    with pytest.raises(QueryError):
        PT.opened(spark, "nowhere")


def shown(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_reads_by_key_look_into_their_partitions(spark, name, table):
    found = PT.rows_with_ids(spark, name, [5, "7", None, 88888])
    assert sorted(r["id"] for r in found.collect()) == [5, 7]
    assert "PartitionFilters: [__part" in shown(found)
    many = spark.range(0, 400, 3)
    assert PT.rows_with_ids(spark, name, many).count() == 134
    assert PT.rows_with_ids(spark, name, []).collect() == []


@pytest.fixture
def bucketed(spark, name):
    df = spark.range(2000).select("id", (F.col("id") % 7).alias("v"))
    V.publish(spark, name, [V.write_version(df, name, "id", 8)])
    return spark.table(name)


def test_reads_by_key_look_into_their_buckets(spark, bucketed):
    # The plan tells the buckets only where the scan hands them out one per task; they are left out either way.
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")
    found = R.with_ids(bucketed, fields(bucketed)["id"], [3, 4, 12345])
    plan = formatted(found)
    assert "SelectedBucketsCount: " in plan and "SelectedBucketsCount: 8 out of 8" not in plan
    assert sorted(r["id"] for r in found.collect()) == [3, 4]
    spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")


def test_keyed_changes_leave_a_bucketed_table_where_it_is(spark, bucketed):
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        batch = spark.range(1500, 2500).select("id", F.lit(1).cast("bigint").alias("v"))
        change = W.upsert(bucketed, batch, "id")
        kept = shown(change.rows.select("id", "v"))
        scan = kept[: kept.index("FileScan")]
        assert "Exchange" not in scan and "SortMergeJoin" in scan and "Bucketed: true" in kept
        assert change.rows.count() == 2500 and change.counts.first()["updated"] == 500
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def test_new_versions_keep_the_layout(spark, name, bucketed):
    assert V.layout(spark, V.versions_of(spark, name)[0]) == {"key": "id", "buckets": 8}
    built = V.rebuild(spark, name, bucketed.schema)
    assert built.rows == 2000 and V.layout(spark, built.version) == {"key": "id", "buckets": 8}
    spark.range(1990, 2010).select("id", F.lit(5).cast("bigint").alias("v")).write.saveAsTable(name + "_src")
    report = V.reindex(spark, name + "_src", name, "id")
    assert (report.total, report.created, report.updated) == (20, 10, 10)
    assert V.layout(spark, V.versions_of(spark, name)[0]) == {"key": "id", "buckets": 8}
    assert spark.table(name).count() == 2010
    with pytest.raises(QueryError):
        V.write_version(bucketed, name, key="id")
    with pytest.raises(QueryError):
        V.write_version(bucketed, name, "id", 0)


def test_a_failed_write_leaves_no_version_behind(spark, name):
    spark.createDataFrame([("1",), ("x",)], "id string").write.saveAsTable(name)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast"):
        V.rebuild(spark, name, spark.range(1).schema)
    assert [t.name for t in spark.catalog.listTables() if t.name.startswith(name)] == [name]
    assert spark.table(name).count() == 2


def test_empty_tables_are_rebuilt_and_counted(spark, name):
    spark.range(5).where("id < 0").write.saveAsTable(name)
    assert V.rebuild(spark, name, spark.range(1).schema).rows == 0
    assert V.rebuild(spark, name, spark.range(1).schema).rows == 0
