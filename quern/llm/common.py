"""What the training-data operators share: shared storage, native text forms, Arrow batches of columns."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# The characters that separate words: \x20 and \x09 to \x0D.
BLANKS = " \t\n\x0b\x0c\r"


def shared_folder(spark: SparkSession, what: str) -> str:
    """The path of a new folder that driver and executors share, below ``spark.checkpoint.dir``.

    Where that is unset, a local session gets a temporary folder; a cluster session raises, because a
    folder of one machine is not seen by the others.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="quern-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/quern/{what}-{uuid.uuid4().hex}"


def written(df: DataFrame, what: str) -> DataFrame:
    """``df`` as a table written to the shared folder and read again: computed once, its size known to the optimizer."""
    path = shared_folder(df.sparkSession, what)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def whole(text: str | Column) -> Column:
    """The text, with a null as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def without_blanks(text: Column) -> Column:
    for blank in BLANKS:
        text = F.replace(text, F.lit(blank), F.lit(""))
    return text


def map_columns(
    df: DataFrame, function: Callable[[Iterator[list[pa.Array]]], Iterator[list]], schema: str
) -> DataFrame:
    """``mapInArrow`` for functions from lists of column arrays to lists of columns, in the schema's order."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    arrow = to_arrow_schema(StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in function(batch.columns for batch in batches):
            arrays = [
                c.cast(f.type) if isinstance(c, pa.Array) else pa.array(c, f.type)
                for c, f in zip(columns, arrow, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.mapInArrow(run, schema)


def bit_of(values: list[Column], bits: int) -> Column:
    """A position from 1 to ``bits`` for these values."""
    return F.pmod(F.xxhash64(*values), F.lit(bits)) + 1


def bitmap(df: DataFrame, values: list[Column], bits: int) -> DataFrame:
    """The bits of all rows set, in at most ``bits`` / 32768 rows of 4 KB whatever the table's size."""
    bit = bit_of(values, bits)
    return df.groupBy(F.bitmap_bucket_number(bit).alias("_bit_bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(bit)).alias("_bit_map")
    )


def with_bit(df: DataFrame, values: list[Column], bitmaps: DataFrame, bits: int, name: str) -> DataFrame:
    """``df`` with whether the bit of its values is set. Always true for values that the bitmap was built from."""
    bit = bit_of(values, bits)
    position = F.bitmap_bit_position(bit)
    byte = F.conv(F.hex(F.substring(F.col("_bit_map"), (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    is_set = F.getbit(byte, (position % 8).cast("int")) == 1
    return (
        df.join(F.broadcast(bitmaps), F.bitmap_bucket_number(bit) == F.col("_bit_bucket"), "left")
        .withColumn(name, F.coalesce(is_set, F.lit(False)))
        .drop("_bit_bucket", "_bit_map")
    )


def may_contain(df: DataFrame, column: str, among: DataFrame, bits: int = 1 << 25) -> DataFrame:
    """Rows of ``df`` whose value may be in ``among`` (one column): none of those is missing, a few others are left.

    ``df`` is not shuffled. The filter that is broadcast has at most ``bits`` / 8 bytes.
    """
    bitmaps = bitmap(among, [F.col(among.columns[0])], bits)
    return with_bit(df, [F.col(column)], bitmaps, bits, "_bit_set").where("_bit_set").drop("_bit_set")


def one_row_each(
    df: DataFrame,
    text: str,
    value: Column,
    told: DataFrame,
    with_digest: Callable[[DataFrame], DataFrame],
    bits: int = 1 << 25,
) -> DataFrame:
    """``df`` without rows that ``told`` (value, digest, stays) says go; of several rows of one pair that stays, the one
    with the longest ``text``.

    Rows are told apart by their value and the digest that ``with_digest`` adds as ``_digest`` to rows packed into
    ``_row``, so that columns of ``df`` may have any names; nulls equal nulls. Only rows whose value may be in question
    get a digest and are joined; the others stay where they are.
    """
    packed = df.select(F.struct(*[F.col("`" + c.replace("`", "``") + "`") for c in df.columns]).alias("_row"), value.alias("_key"))
    gone = told.where("not stays").select(F.col("value").alias("_value"), F.col("digest").alias("_of"))
    repeats = written(
        told.where("stays").groupBy("value", "digest").agg(F.count("*").alias("rows")).where("rows > 1").select("value", "digest"),
        "rows-repeated",
    ).select(F.col("value").alias("_value"), F.col("digest").alias("_of"))
    asked_for = gone.union(repeats).select("_value")
    flagged = with_bit(packed, [F.col("_key")], bitmap(asked_for, [F.col("_value")], bits), bits, "_bit_set")
    same = F.col("_key").eqNullSafe(F.col("_value")) & (F.col("_digest") == F.col("_of"))
    asked = with_digest(flagged.where("_bit_set").select("_row", "_key"))
    left = asked.join(gone.union(repeats), same, "left_anti").select("_row")
    left = flagged.where("not _bit_set").select("_row").union(left)
    if not repeats.isEmpty():
        held = F.col("_row")[text]
        first = Window.partitionBy("_value", "_of").orderBy(F.length(whole(held)).desc(), F.xxhash64(held))
        ranked = asked.join(repeats, same).withColumn("_rank", F.row_number().over(first))
        left = left.union(ranked.where("_rank = 1").select("_row"))
    return left.select("_row.*")
