"""Exact top-k search by inner product with MaxScore pruning.

A term is a dimension, its postings are the whole-number components of a chunk of candidates. Per chunk and query the
terms are ordered by the most that each can add to a score. The terms at the end whose bounds together stay
below the query's k-th best score are non-essential: a candidate cannot get in by them alone. Only the postings of the
essential terms are traversed; the others are probed a few at a time, and only for the candidates that could still
reach the k-th best score. Embeddings have a component in nearly every dimension, so that a term's postings are kept
as one column over the chunk instead of pairs of row and weight, and a dimension without weight adds nothing.

Candidates stay where they are. Queries are broadcast in blocks; each task keeps the best ``k`` candidates of every
query of the block, and these shards are merged.
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

# Bytes of query vectors (8 to a component) broadcast at once, of candidates in a chunk, and terms probed at a time.
BLOCK_BYTES = 8 << 20
CHUNK_BYTES = 1 << 20
PROBED = 8


def top_k(
    vectors: DataFrame,
    is_query: Column,
    key: str = "vec_id",
    vector: str = "embedding",
    k: int = 20,
    scale: int = 64,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """query_id, rank, ``key``, score: the ``k`` rows with the highest inner product per row where ``is_query``.

    Components are taken as floor(scale * x). Equal scores go by smaller id, rows without an id last. A row is not its
    own candidate, nor is another row of its id; otherwise rows that repeat an id are queries and candidates
    each by itself. Vectors that are null or hold null or non-finite components take no part; shorter vectors count as
    filled up with zeros, an empty one scores 0 with all. ``key`` is a whole number. Scores beyond 64 bits
    raise. Other columns are ignored.
    """
    rows = vectors.where(finite(vector)).select(
        F.col(key).cast("bigint").alias("id"), F.col(vector).alias("vector"), F.coalesce(is_query, F.lit(False)).alias("asks")
    )
    dims, most = extent(rows, "vector", scale)
    # Sums of products up to these sizes are exact in floating point; beyond them Python's integers are.
    bound = dims * most * most
    kind = np.float32 if bound < 1 << 24 else np.float64 if bound < 1 << 53 else object
    queries = rows.where("asks").select("id", "vector")
    found = per_block(
        rows,
        blocks(queries, F.lit(8 * dims + 16), block_bytes),
        partial(_search_block, rows.select("id", "vector"), (dims, scale, kind, k)),
        "query bigint, rank int, id bigint, score bigint",
    )
    return found.select(F.col("query").alias("query_id"), "rank", F.col("id").alias(key), "score")


def _search_block(rows: DataFrame, how: tuple, part: DataFrame, broadcast: Callable) -> DataFrame:
    dims, scale, kind, k = how
    asked = part.toArrow().combine_chunks()
    ids = asked["id"].to_numpy()
    weights = whole_components(_one(asked["vector"]), dims, scale, kind)
    shared = broadcast((ids, weights))
    found = map_columns(rows, partial(_search, shared, how), "number int, query bigint, id bigint, score bigint")
    return merged(found, ["number"], [F.desc("score"), F.asc_nulls_last("id")], k)


def _one(column: pa.ChunkedArray) -> pa.Array:
    return pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)


class Ranking:
    """The best ``k`` candidates so far of one query."""

    def __init__(self, k: int, kind: type):
        self.k, self.scores = k, np.zeros(0, kind)
        self.ids, self.missing = np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def least(self):
        """The score a candidate must reach, if there is one."""
        return self.scores[-1] if len(self.scores) == self.k else None

    def add(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        scores = np.concatenate([self.scores, scores])
        ids, missing = np.concatenate([self.ids, ids]), np.concatenate([self.missing, missing])
        kept = best(scores, ids, missing, self.k)
        self.scores, self.ids, self.missing = scores[kept], ids[kept], missing[kept]


def _search(shared: Broadcast, how: tuple, batches: Iterator[list[pa.Array]]) -> Iterator[list]:
    dims, scale, kind, k = how
    ids, weights = shared.value
    rankings = [Ranking(k, kind) for _ in ids]
    chunk = max(1, CHUNK_BYTES // (8 * max(1, dims)))
    for keys, vectors in batches:
        for start in range(0, len(keys), chunk):
            matrix = whole_components(vectors.slice(start, chunk), dims, scale, kind)
            _chunk(ids, weights, rankings, np.ascontiguousarray(matrix.T), *ids_of(keys.slice(start, chunk)))
    for number, ranking in enumerate(rankings):
        n = len(ranking.scores)
        if n:
            found = [None if m else int(i) for i, m in zip(ranking.ids, ranking.missing)]
            yield [[number] * n, [int(ids[number])] * n, found, [int(s) for s in ranking.scores]]


def _chunk(
    ids: np.ndarray,
    weights: np.ndarray,
    rankings: list[Ranking],
    postings: np.ndarray,
    rows: np.ndarray,
    missing: np.ndarray,
) -> None:
    """Offer one chunk of candidates, given as a row of components per dimension, to all queries."""
    dims = len(postings)
    high = postings.max(axis=1) if dims else np.zeros(0, postings.dtype)
    low = postings.min(axis=1) if dims else high
    for number, query in enumerate(weights):
        ranking = rankings[number]
        least = ranking.least
        # What a term adds at most; a candidate without the term gets 0 from it.
        bounds = np.maximum(np.maximum(query * high, query * low), 0)
        order = np.argsort(-bounds, kind="stable")
        # rest[i]: what all terms from the i-th on add at most, together.
        rest = np.append(np.cumsum(bounds[order][::-1])[::-1], 0)
        essential = dims if least is None else int(np.count_nonzero(rest[:-1] >= least))
        terms = order[:essential]
        scores = query[terms] @ postings[terms] if essential else np.zeros(len(rows), postings.dtype)
        left = np.flatnonzero(~((rows == ids[number]) & ~missing))
        at = essential
        while True:
            scores_left = scores[left]
            if least is not None:
                competitive = scores_left + rest[at] >= least
                left, scores_left = left[competitive], scores_left[competitive]
            if at >= dims or not len(left):
                break
            terms = order[at : at + PROBED]
            scores[left] = scores_left + query[terms] @ postings[np.ix_(terms, left)]
            at += len(terms)
        if len(left):
            ranking.add(scores_left, rows[left], missing[left])
