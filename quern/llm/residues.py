"""Hard negatives by integer scores from residues: products modulo small primes in float32, then Chinese remaindering.

The scores of a block of anchors with a chunk of rows are one matrix product. It is taken modulo several small primes,
each in float32, where sums of products of balanced residues stay below 2**24 and are therefore exact; the signed
integer scores are put together again from the remainders. A first pass over the rows finds each anchor's positives. They
set windows of scores, and a second pass finds the first negatives inside each window.

Rows stay where they are, whatever their label. Anchors are broadcast in blocks, and a task gives back no more than its
best few rows per anchor or window.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.blocks import best, blocks, extent, finite, ids_of, merged, per_block, whole_components
from quern.llm.common import map_columns

# Bytes of anchors (8 to a component) broadcast at once; anchors and rows multiplied at once.
BLOCK_BYTES = 8 << 20
ANCHORS, ROWS = 512, 2048
# Primes from here downwards; float32 holds whole numbers up to 2**24.
LARGEST = 256
EXACT = 1 << 24


def primes_beyond(bound: int) -> list[int]:
    """The largest primes below LARGEST whose product tells all whole numbers from -bound to bound apart.

    Raises for bounds beyond all of them (about 2**330).
    """
    found, product = [], 1
    for n in range(LARGEST - 1, 2, -1):
        if product > 2 * bound:
            return found
        if all(n % d for d in range(2, int(n**0.5) + 1)):
            found.append(n)
            product *= n
    raise OverflowError(f"no primes below {LARGEST} for scores up to {bound}")


def balanced(matrix: np.ndarray, prime: int) -> np.ndarray:
    """Residues from -(prime - 1) / 2 to (prime - 1) / 2, as float32."""
    half = prime // 2
    return ((matrix + half) % prime - half).astype(np.float32)


def remainders(a: list[np.ndarray], b: list[np.ndarray], primes: list[int]) -> list[np.ndarray]:
    """``a @ b`` modulo every prime, from the residues of both, in slabs whose sums stay exact."""
    out = []
    for left, right, prime in zip(a, b, primes):
        slab = EXACT // (prime // 2) ** 2
        total = np.zeros((left.shape[0], right.shape[1]), np.int64)
        for at in range(0, left.shape[1], slab):
            total += (left[:, at : at + slab] @ right[at : at + slab]).astype(np.int64)
        out.append(total % prime)
    return out


def reconstructed(parts: list[np.ndarray], primes: list[int]) -> np.ndarray:
    """The signed whole numbers with these remainders: digits in the mixed base of the primes, one after the other.

    64-bit integers where the product of the primes fits, Python's otherwise.
    """
    product = 1
    for prime in primes:
        product *= prime
    kind = np.int64 if product < 1 << 62 else object
    total, base = np.zeros(parts[0].shape, kind), 1
    for part, prime in zip(parts, primes):
        digit = (part - total % prime).astype(np.int64) * pow(base, -1, prime) % prime
        total = total + digit.astype(kind) * base
        base *= prime
    return np.where(total > product // 2, total - product, total)


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    label: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: int = 256,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    A score is the inner product with the anchor of floor(scale * x). An anchor's positives are the ``positives``
    highest-scoring other rows of its label; for each, the ``negatives`` highest-scoring rows of another label with a score
    from ``low`` to ``high`` percent of the positive's are returned. Ties go by smaller id, rows without an id last. Below
    a score of 0 no such range holds anything.

    Rows with a null label, a null vector, or a null or non-finite component take no part. A row is not its own
    positive, nor is another row of its id; rows that repeat an id are otherwise anchors, positives and negatives
    each by itself. Shorter vectors count as filled up with zeros. Labels and ids are whole numbers. Other columns are ignored.
    """
    rows = vectors.where(finite(vector)).select(
        F.col(key).cast("bigint").alias("id"),
        F.col(vector).alias("vector"),
        label.cast("bigint").alias("label"),
        F.coalesce(is_anchor, F.lit(False)).alias("asks"),
    )
    rows = rows.where("label is not null")
    dims, most = extent(rows, "vector", scale)
    primes = primes_beyond(max(1, dims * most * most))
    how = (dims, scale, np.int64 if most < 1 << 53 else object, primes)
    anchors = rows.where("asks").drop("asks")
    found = per_block(
        rows,
        blocks(anchors, F.lit(8 * dims + 24), block_bytes),
        partial(_search_block, rows.drop("asks"), how, (positives, negatives, low, high)),
        "anchor bigint, positive bigint, rank int, id bigint, positive_score bigint, score bigint",
    )
    return found.select(
        F.col("anchor").alias("anchor_id"),
        F.col("positive").alias("positive_id"),
        "rank",
        F.col("id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def _search_block(rows: DataFrame, how: tuple, wanted: tuple, part: DataFrame, broadcast: Callable) -> DataFrame:
    dims, scale, kind, primes = how
    positives, negatives, low, high = wanted
    asked = part.toArrow()
    matrix = np.concatenate([whole_components(c, dims, scale, kind) for c in asked["vector"].chunks])
    anchors = (asked["id"].to_numpy(), asked["label"].to_numpy(), [balanced(matrix, p) for p in primes])
    shared = broadcast(anchors)
    order = [F.desc("score"), F.asc_nulls_last("id")]
    near = map_columns(rows, partial(_positives, shared, how, positives), "anchor int, id bigint, score bigint")
    # At most ``positives`` rows per anchor of the block.
    chosen = merged(near, ["anchor"], order, positives).orderBy("anchor", "rank").toArrow()
    windows = broadcast(_windows(chosen, len(anchors[0]), low, high))
    columns = "place int, anchor bigint, positive bigint, positive_score bigint, id bigint, score bigint"
    found = map_columns(rows, partial(_negatives, shared, windows, how, negatives), columns)
    return merged(found, ["place"], order, negatives)


def _windows(chosen: pa.Table, anchors: int, low: int, high: int) -> list[list[tuple]]:
    """Per anchor: (number of the window, positive's id, its score, least and highest score of a negative)."""
    out: list[list[tuple]] = [[] for _ in range(anchors)]
    columns = [chosen[c].to_pylist() for c in ("anchor", "id", "score")]
    for place, (anchor, positive, score) in enumerate(zip(*columns)):
        least, most = -(-low * score // 100), high * score // 100
        if least <= most:
            out[anchor].append((place, positive, score, least, most))
    return out


def _scored(shared: Broadcast, how: tuple, batches: Iterator[list[pa.Array]]) -> Iterator[tuple]:
    """(number of the first anchor, scores of some anchors with a chunk of rows, the rows' ids, nulls and labels)."""
    dims, scale, kind, primes = how
    residues = shared.value[2]
    for keys, vectors, labels in batches:
        for start in range(0, len(keys), ROWS):
            matrix = whole_components(vectors.slice(start, ROWS), dims, scale, kind).T
            columns = [balanced(matrix, p) for p in primes]
            ids, missing = ids_of(keys.slice(start, ROWS))
            of = labels.slice(start, ROWS).to_numpy(zero_copy_only=False)
            for first in range(0, len(residues[0]), ANCHORS):
                some = [r[first : first + ANCHORS] for r in residues]
                yield first, reconstructed(remainders(some, columns, primes), primes), ids, missing, of


class Best:
    """The best ``k`` rows so far, in order."""

    def __init__(self, k: int):
        self.k = k
        self.rows: list[tuple] = []  # score, whether the id is missing, id

    def least(self, otherwise):
        return self.rows[-1][0] if len(self.rows) == self.k else otherwise

    def add(self, scores, ids, missing) -> None:
        new = [(int(s), bool(m), int(i)) for s, i, m in zip(scores, ids, missing)]
        self.rows = sorted(self.rows + new, key=lambda r: (-r[0], r[1], r[2]))[: self.k]


def _positives(shared: Broadcast, how: tuple, k: int, batches: Iterator[list[pa.Array]]) -> Iterator[list]:
    anchor_ids, anchor_labels, _ = shared.value
    found = [Best(k) for _ in anchor_ids]
    for first, scores, ids, missing, labels in _scored(shared, how, batches):
        for number, line in enumerate(scores, first):
            same = (labels == anchor_labels[number]) & ~((ids == anchor_ids[number]) & ~missing)
            if (least := found[number].least(None)) is not None:
                same = same & (line >= least)
            at = np.flatnonzero(same)
            if len(at):
                at = at[best(line[at], ids[at], missing[at], k)]
                found[number].add(line[at], ids[at], missing[at])
    for number, ranking in enumerate(found):
        if ranking.rows:
            yield [
                [number] * len(ranking.rows),
                [None if m else i for _, m, i in ranking.rows],
                [s for s, _, _ in ranking.rows],
            ]


def _negatives(
    shared: Broadcast, windows: Broadcast, how: tuple, k: int, batches: Iterator[list[pa.Array]]
) -> Iterator[list]:
    anchor_ids, anchor_labels, _ = shared.value
    found = [[Best(k) for _ in of] for of in windows.value]
    for first, scores, ids, missing, labels in _scored(shared, how, batches):
        for number, line in enumerate(scores, first):
            if not found[number]:
                continue
            # From the least score that can still enter one of the windows to the highest that is in one.
            open_from = [b.least(w[3]) for b, w in zip(found[number], windows.value[number])]
            highest = max(w[4] for w in windows.value[number])
            other = (labels != anchor_labels[number]) & (line >= min(open_from)) & (line <= highest)
            at = np.flatnonzero(other)
            at = at[best(line[at], ids[at], missing[at], len(at))]
            falling = line[at]
            for ranking, window, least in zip(found[number], windows.value[number], open_from):
                inside = np.flatnonzero((falling <= window[4]) & (falling >= least))[:k]
                if len(inside):
                    ranking.add(falling[inside], ids[at[inside]], missing[at[inside]])
    for number, rankings in enumerate(found):
        for ranking, (place, positive, score, _, _) in zip(rankings, windows.value[number]):
            if n := len(ranking.rows):
                negatives = [None if m else i for _, m, i in ranking.rows]
                scores = [s for s, _, _ in ranking.rows]
                yield [[place] * n, [int(anchor_ids[number])] * n, [positive] * n, [score] * n, negatives, scores]
