"""Context-triggered piecewise hashing: document fingerprints that change only where the text does.

A rolling hash over the last ``SPAN`` bytes ends a chunk wherever it meets a condition that depends on the
block size, so that chunk borders move with the content. Each chunk gives one character; a fingerprint is
``block size:characters:characters at twice the block size``. Block sizes are ``LEAST`` times a power of two,
chosen from the text's length so that there are about 64 chunks, halved while there are fewer than 32.
Fingerprints are compared where their block sizes agree, by the edit distance of the characters.

How it runs. Whole texts are hashed in Python tasks, vectorised over their bytes; no text is cut short: after
63 borders the rest of the text is one chunk. Comparison is a native expression.

Defined results:
- A null text is empty. Empty texts have the fingerprint ``3::``; two of them are alike (1.0), and nothing
  else is like them (0.0). Equal texts have equal fingerprints.
- ``edited_pairs``: documents are ordered by descending id, nulls last, then by text; repeated rows are
  documents of their own. A single document is its own neighbour.
- An empty table gives an empty result. Other columns are never read, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import map_columns, whole

SPAN, LEAST, CHUNKS = 7, 3, 64
CHARACTERS = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
BASE = 0x9E3779B97F4A7C15  # odd, so that it has an inverse modulo 2**64
INVERSE = pow(BASE, -1, 1 << 64)
BYTE_VALUES = np.random.default_rng(7).integers(1, 1 << 63, 256, np.uint64)
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE and INVERSE to the powers from 0 to at least n, kept per worker."""
    if len(_POWERS[0]) <= n:
        size = 1 << (n + 1).bit_length()
        for i, factor in enumerate((BASE, INVERSE)):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS[0], _POWERS[1]


def fingerprint(text: str | None) -> str:
    data = np.frombuffer((text or "").encode(), np.uint8)
    n = len(data)
    if not n:
        return f"{LEAST}::"
    powers, inverses = _powers(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * powers[:n], out=sums[1:])
    rolling = sums[1:].copy()
    rolling[SPAN:] -= sums[1 : n + 1 - SPAN] if n > SPAN else 0
    mixed = (rolling * inverses[:n] * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(33)
    # Chunk ends for the block size LEAST * 2**k: the value is a multiple of LEAST * 2**k.
    ends = np.nonzero(mixed % np.uint64(LEAST) == 0)[0]
    at_ends = mixed[ends]
    k = 0
    while LEAST * 2**k * CHUNKS < n:
        k += 1

    def borders(k: int) -> np.ndarray:
        return ends[at_ends & np.uint64(2**k - 1) == 0] + 1

    while k and len(borders(k)) < CHUNKS // 2:
        k -= 1

    def characters(k: int) -> str:
        cuts = borders(k)[: CHUNKS - 1]
        starts = np.concatenate([[0], cuts])
        stops = np.concatenate([cuts, [n]])
        if starts[-1] == n:
            starts, stops = starts[:-1], stops[:-1]
        hashes = (sums[stops] - sums[starts]) * inverses[starts] * np.uint64(0xA0761D6478BD642F)
        return CHARACTERS[(hashes >> np.uint64(58)).astype(int)].tobytes().decode()

    return f"{LEAST * 2**k}:{characters(k)}:{characters(k + 1)}"


def likeness(a: Column, b: Column) -> Column:
    """From 0 to 1: the share of characters that need no edit, at the best block size both have."""

    def part(of: Column, i: int) -> Column:
        return F.element_at(F.split(of, ":"), i)

    def alike(x: Column, y: Column) -> Column:
        longer = F.greatest(F.length(x), F.length(y))
        return F.when(longer > 0, 1 - F.levenshtein(x, y) / longer).otherwise(0.0)

    size_a, size_b = part(a, 1).cast("bigint"), part(b, 1).cast("bigint")
    return (
        F.when(a == b, 1.0)
        .when(size_a == size_b, F.greatest(alike(part(a, 2), part(b, 2)), alike(part(a, 3), part(b, 3))))
        .when(size_a == 2 * size_b, alike(part(a, 2), part(b, 3)))
        .when(size_b == 2 * size_a, alike(part(a, 3), part(b, 2)))
        .otherwise(0.0)
    )


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, fingerprint per row."""
    kind = docs.schema[key].dataType.simpleString()

    def run(batches: Iterator[list]) -> Iterator[list]:
        for keys, texts in batches:
            yield [keys, [fingerprint(t.as_py()) for t in texts]]

    return map_columns(docs.select(key, text), run, f"`{key}` {kind}, fingerprint string")


def _in_ranges(docs: DataFrame, key: str, text: str, parts: int) -> DataFrame:
    """part, donor, k, t: documents dealt by ranges of ids, and the first of each range also as ``donor`` of the
    range that comes before it in descending order. Only ``parts`` bounds and heads reach the driver."""
    rows = docs.select(F.col(key).cast("bigint").alias("k"), whole(text).alias("t"))
    shares = [i / parts for i in range(1, parts)]
    found = docs.select(F.percentile_approx(F.col(key).cast("bigint"), shares, 10_000).alias("b")).first()["b"] if shares else []
    bounds = sorted(set(found or []))
    # How many bounds are below the id, by bisection; ids that are null come after all others.
    array = F.array(*[F.lit(b).cast("bigint") for b in bounds]) if bounds else F.array().cast("array<bigint>")
    below = F.aggregate(
        F.array(*[F.lit(2**i) for i in reversed(range(max(1, len(bounds)).bit_length()))]),
        F.lit(0),
        lambda low, step: F.when(
            (low + step <= len(bounds)) & (F.try_element_at(array, low + step) < F.col("k")), low + step
        ).otherwise(low),
    )
    part = F.when(F.col("k").isNull(), F.lit(-1)).otherwise(below)
    placed = rows.withColumn("part", part)
    heads = sorted(
        (r["part"], r["k"]) for r in placed.select("part", "k").groupBy("part").agg(F.max("k").alias("k")).collect()
    )
    spark = docs.sparkSession
    # The head of a range is needed after the end of the next range above it; the highest one after the lowest.
    wanted = [(k, heads[(i + 1) % len(heads)][0]) for i, (_, k) in enumerate(heads)]
    needed = spark.createDataFrame(wanted, "head bigint, target int")
    return (
        placed.join(F.broadcast(needed), F.col("k").eqNullSafe(F.col("head")), "left")
        .withColumn(
            "places",
            F.when(
                F.col("target").isNotNull(),
                F.array(
                    F.struct(F.col("part").alias("part"), F.lit(False).alias("donor")),
                    F.struct(F.col("target").alias("part"), F.lit(True).alias("donor")),
                ),
            ).otherwise(F.array(F.struct(F.col("part").alias("part"), F.lit(False).alias("donor")))),
        )
        .select(F.explode("places").alias("place"), "k", "t")
        .select("place.part", "place.donor", "k", "t")
    )


def edited_pairs(docs: DataFrame, key: str = "doc_id", text: str = "text", parts: int | None = None) -> DataFrame:
    """Per document: n_chars, the digest of its edited text, fingerprints of both, and how alike they are.

    The edited text is the document with its last third replaced by the beginning of the next document in
    descending order of ids (after the last: the first). ``near_next`` compares with that document itself.
    The table is shuffled once, by ranges of ids; a task holds two documents at a time.
    """
    spark = docs.sparkSession
    # Several ranges per partition even out how ranges hash to partitions.
    parts = parts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = (
        _in_ranges(docs, key, text, parts)
        .repartition("part")
        .sortWithinPartitions("part", "donor", F.col("k").desc_nulls_last(), "t")
    )

    def run(batches: Iterator[list]) -> Iterator[list]:
        before = None  # the row that waits for the next one: part, key, text, fingerprint
        done = None  # the part whose first donor has been used
        for columns in batches:
            rows = []
            for part, donor, k, t in zip(*(c.to_pylist() for c in columns), strict=True):
                if donor and done == part:
                    continue
                own = fingerprint(t)
                if before is not None and before[0] == part:
                    n = len(before[2])
                    edited = before[2][: n - n // 3] + t[: n // 3]
                    rows.append(
                        (before[1], n, hashlib.sha256(edited.encode()).hexdigest(), before[3], fingerprint(edited), own)
                    )
                before, done = (None, part) if donor else ((part, k, t, own), done)
            if rows:
                yield list(zip(*rows, strict=True))

    schema = (
        f"`{key}` bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, next string"
    )
    return map_columns(dealt, run, schema).select(
        key,
        "n_chars",
        "edited_sha256",
        "fingerprint",
        "edited_fingerprint",
        likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
        likeness(F.col("fingerprint"), F.col("next")).alias("near_next"),
    )
