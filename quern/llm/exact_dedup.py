"""Exact duplicates by progressive refinement: length, then prefix hash, then full hash of what is left.

Two texts are equal when they are identical after deleting every character of ``[\\x20\\x09-\\x0D]``.

How it runs. The first read of the table keeps a few numbers per row: the stripped text's length, the hash
of its first characters, the original length. Lengths that occur once, then (length, prefix) pairs that
occur once, are proven unique. The pairs that remain are put into a bitmap of fixed size, which every task
of the second read holds: only rows whose bit is set have their full content hashed. No text is ever
shuffled, and a bitmap that fills up on a huge table only means that more rows are hashed.

Defined results:
- A null text counts as empty; all empty texts are one group.
- Of equal texts the row with the most code points in its original text stays, then the smallest key; a null
  key is smaller than any other.
- Rows that repeat a key are rows like all others; when they are in one group and their key stays, all of
  them are marked as kept. ``drop_copies`` leaves one of them, the one with the longest original.
- An empty table gives an empty result. Other columns are never read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.common import bitmap, one_row_each, whole, with_bit, without_blanks, written

def exact_groups(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    prefix: int = 256,
    bits: int = 1 << 25,
    hash_all: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: key, keep (the key of the row that stays), group_size, kept, text_sha256.

    ``text_sha256`` is null for rows that were proven unique without reading on, unless ``hash_all`` asks for
    every digest. ``bits``: the size of the bitmap that is broadcast, at most ``bits`` / 8 bytes.
    """
    stripped = without_blanks(whole(text))
    read = docs.select(
        F.col(key).alias("k"),
        F.octet_length(stripped).alias("n"),
        F.xxhash64(F.substring(stripped, 1, prefix)).alias("p"),
        F.length(whole(text)).cast("bigint").alias("points"),
        stripped.alias("stripped"),
    )
    pairs = written(read.groupBy("n", "p").agg(F.count("*").alias("rows")), "exact-pairs")
    lengths = pairs.groupBy("n").agg(F.sum("rows").alias("rows"), F.max("rows").alias("most"))
    # A length that occurs once needs no look at prefixes; one whose pairs are all single has no copy either.
    shared = lengths.where((F.col("rows") > 1) & (F.col("most") > 1)).select("n")
    alike = pairs.where("rows > 1").join(shared, "n", "left_semi").select("n", "p")
    pair = [F.col("n"), F.col("p")]
    marked = with_bit(read, pair, bitmap(alike, pair, bits), bits, "survives")
    hashed = written(
        marked.select(
            "k",
            "points",
            "survives",
            F.when(F.lit(hash_all) | F.col("survives"), F.sha2(F.col("stripped").cast("binary"), 256)).alias("sha"),
        ),
        "exact-hashed",
    )
    groups = written(
        hashed.where("survives")
        .groupBy("sha")
        .agg(F.count("*").alias("size"), F.min(F.struct(-F.col("points"), F.col("k"))).alias("best"))
        .where("size > 1")
        .select(F.col("sha").alias("group_sha"), "size", F.col("best.k").alias("best")),
        "exact-groups",
    )
    copies = F.col("size").isNotNull()
    return hashed.join(groups, hashed["sha"] == groups["group_sha"], "left").select(
        F.col("k").alias(key),
        F.when(copies, F.col("best")).otherwise(F.col("k")).alias("keep"),
        F.coalesce("size", F.lit(1)).cast("bigint").alias("group_size"),
        F.when(copies, F.col("best").eqNullSafe(F.col("k"))).otherwise(True).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of ``docs`` for each group of equal texts, all columns as they are; rows, not keys, are dropped."""
    copies = exact_groups(docs, key, text).where("group_size > 1")
    told = written(
        copies.select(F.col(key).alias("value"), F.col("text_sha256").alias("digest"), F.col("kept").alias("stays")),
        "exact-told",
    )
    digest = F.sha2(without_blanks(whole(F.col("_row")[text])).cast("binary"), 256)
    return one_row_each(docs, text, F.col(key), told, lambda rows: rows.withColumn("_digest", digest))
