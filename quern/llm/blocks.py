"""What the three searches share: queries in blocks of bounded size, vectors as matrices, merged rankings.

A search holds one block of its queries in every task and streams the other table past it. The rows that leave a
task are at most as many as the block asks for, whatever the table's size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import shared_folder
from quern.operators.topn import top_per_group

# Rankings from more tasks than this are merged in two steps.
FAN_IN = 64


def blocks(df: DataFrame, cost: Column, most: int) -> Iterator[DataFrame]:
    """``df`` in parts whose costs (bytes, as a rule) sum to at most ``most``; a dearer row is a part of its own.

    The rows are written once, those of like cost with as many to a file as fit in any case; a part is some of the files.
    """
    path = shared_folder(df.sparkSession, "blocks")
    size = F.greatest(cost, F.lit(1)).cast("bigint")
    # Costs up to 16, 256, 4096 and so on: one dear row does not give the cheap ones a file each.
    alike = F.length(F.hex(size - 1))
    found = [r[0] for r in df.select(alike).distinct().collect()]
    if not found:
        return
    for digits in found:
        few = df.where(alike == digits).write.option("maxRecordsPerFile", max(1, most // 16**digits))
        few.mode("append").parquet(path)
    stored = df.sparkSession.read.schema(df.schema).parquet(path)
    file = F.col("_metadata.file_name")
    names, total = [], 0
    for name, of_file in stored.groupBy(file.alias("name")).agg(F.sum(size)).toLocalIterator():
        if names and total + of_file > most:
            yield stored.where(file.isin(names))
            names, total = [], 0
        names.append(name)
        total += of_file
    if names:
        yield stored.where(file.isin(names))


def per_block(
    df: DataFrame, parts: Iterator[DataFrame], search: Callable[[DataFrame, Callable], DataFrame], schema: str
) -> DataFrame:
    """The results of ``search`` for all parts, each written before the next part is taken up.

    ``search`` gets a part and a function that broadcasts; what it broadcast is released once its results are written.
    """
    spark = df.sparkSession
    path = shared_folder(spark, "found")
    spark.createDataFrame([], schema).write.parquet(path)
    columns = spark.createDataFrame([], schema).columns
    for part in parts:
        held: list[Broadcast] = []

        def broadcast(value) -> Broadcast:
            held.append(spark.sparkContext.broadcast(value))
            return held[-1]

        search(part, broadcast).select(*columns).write.mode("append").parquet(path)
        for of_part in held:
            of_part.destroy()
    return spark.read.schema(schema).parquet(path)


def merged(found: DataFrame, keys: list[str], order: list[Column], k: int, rank: str = "rank") -> DataFrame:
    """The first ``k`` rows of every key, numbered, out of the first ``k`` of every task."""
    if found.rdd.getNumPartitions() > FAN_IN:
        found = found.withColumn("_part", F.spark_partition_id() % FAN_IN)
        found = top_per_group(found, [*keys, "_part"], order, k).drop("_part")
    return top_per_group(found, keys, order, k, rank=rank)


def finite(vector: str) -> Column:
    """Whether a vector is there and all its components are numbers."""
    whole = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.col(vector).isNotNull() & F.coalesce(whole, F.lit(False))


def extent(df: DataFrame, vector: str, scale: int) -> tuple[int, int]:
    """(length of the longest vector, largest magnitude of a component times ``scale``, rounded down)."""
    largest = F.array_max(F.transform(vector, lambda x: F.abs(x.cast("double"))))
    length, most = df.agg(F.max(F.size(vector)), F.max(largest)).first()
    return length or 0, int((most or 0.0) * scale) + 1


def whole_components(column: pa.Array, dims: int, scale: int, kind: type) -> np.ndarray:
    """floor(scale * x) of all vectors as a matrix of ``kind``, shorter vectors filled up with zeros."""
    flat = np.floor(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale)
    lengths = np.diff(column.offsets.to_numpy())
    if kind is object:
        flat = np.array([int(x) for x in flat], object)
    if len(lengths) and (lengths == dims).all():
        return flat.reshape(len(lengths), dims).astype(kind)
    out = np.zeros((len(lengths), dims), kind)
    out[np.arange(dims) < lengths[:, None]] = flat
    return out


def ids_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(ids with 0 for null, which of them are null)."""
    missing = column.is_null().to_numpy(zero_copy_only=False)
    return column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), missing


def best(scores: np.ndarray, ids: np.ndarray, missing: np.ndarray, k: int) -> np.ndarray:
    """Positions of the ``k`` highest scores, ties by smaller id, rows without an id last."""
    if scores.dtype == object:
        order = sorted(range(len(scores)), key=lambda i: (-scores[i], missing[i], ids[i]))
        return np.array(order[:k], np.int64)
    return np.lexsort((ids, missing, -scores))[:k]
