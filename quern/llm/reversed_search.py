"""Ranked lexical search the other way round: documents stream through an index of the items' terms.

The items that are to be searched for are few against the documents, so it is their terms that are indexed. A block of
the index is broadcast. A first pass over the documents counts them, their terms, and the documents per indexed term; a
second scores every document for all items of the block through the postings of its own terms, and keeps a heap
of the ``k`` best documents per item. The heaps of all tasks are merged.

No posting list of a document term is ever built, so a term that all documents hold is as cheap as any other: what
moves is one count per task and indexed term, and ``k`` rows per task and item.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.llm.blocks import blocks, ids_of, merged, per_block
from quern.llm.common import map_columns

# Bytes of item text whose index is broadcast at once; an index takes up to some ten times its text.
BLOCK_BYTES = 4 << 20
# Scores are 64-bit integers in thousandths of a logarithm times millionths of a saturation.
B_PERCENT = 75
K1_THOUSANDTHS = 1000

_LETTERS, _DIGITS = b"abcdefghijklmnopqrstuvwxyz", b"0123456789"


def _folded(byte: int) -> int:
    if byte >= 0x80 or byte in _LETTERS + _DIGITS:
        return byte
    return byte + 32 if byte + 32 in _LETTERS else 0x20


# UTF-8 byte to byte: A-Z to lower case, digits and bytes of characters beyond ASCII as they are, the rest to a blank.
_FOLD = bytes(map(_folded, range(256)))
# Rows of the first pass that count no term.
DOCUMENTS, TERMS = -1, -2


def terms(text: bytes) -> list[bytes]:
    """The maximal runs of ASCII letters and digits and of all other characters beyond ASCII, A-Z lower-cased."""
    return text.translate(_FOLD).split()


@dataclass
class Index:
    """Postings of the items of a block: which items hold a term, and how often."""

    numbers: dict[bytes, int]
    items: list[np.ndarray]
    repeats: list[np.ndarray]
    ids: list

    @staticmethod
    def of(ids: list, texts: list[bytes | None]) -> Index:
        postings: dict[bytes, list[tuple[int, int]]] = {}
        for item, text in enumerate(texts):
            for term, n in Counter(terms(text or b"")).items():
                postings.setdefault(term, []).append((item, n))
        return Index(
            {t: i for i, t in enumerate(postings)},
            [np.array([i for i, _ in p], np.int64) for p in postings.values()],
            [np.array([n for _, n in p], np.int64) for p in postings.values()],
            ids,
        )


@dataclass(frozen=True)
class Corpus:
    documents: int  # with at least one term
    terms: int  # with repeats
    weights: np.ndarray  # per indexed term


def search(
    docs: DataFrame,
    items: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    k: int = 10,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """item, rank, ``key``, score: the ``k`` documents that score highest above 0 per row of ``items``.

    Equal scores go by smaller id. ``key`` and ``item`` are whole numbers. Null and empty texts hold no terms: such
    documents count nowhere, such items find nothing. A document without an id is found after all others of its score,
    documents that repeat an id are found one by one, and every row of ``items`` is an item of its own. Texts of
    any length are read whole; one item's index must fit into a task. Other columns are ignored.
    """
    docs = docs.select(F.col(key).cast("bigint").alias("doc"), F.col(text).cast("binary").alias("text"))
    items = items.select(F.col(item).cast("bigint").alias("id"), F.col(item_text).cast("binary").alias("text"))
    cost = F.coalesce(F.octet_length("text"), F.lit(0)) + 16
    found = per_block(
        docs,
        blocks(items, cost, block_bytes),
        partial(_search_block, docs, k),
        "id bigint, rank int, doc bigint, score bigint",
    )
    return found.select(F.col("id").alias(item), "rank", F.col("doc").alias(key), "score")


def _search_block(docs: DataFrame, k: int, part: DataFrame, broadcast: Callable) -> DataFrame:
    rows = part.toArrow()
    index = Index.of(rows["id"].to_pylist(), rows["text"].to_pylist())
    shared = broadcast(index)
    counts = map_columns(docs, partial(_count, shared), "term int, n bigint")
    corpus = _corpus(dict(counts.groupBy("term").agg(F.sum("n")).toLocalIterator()), len(index.numbers))
    found = map_columns(
        docs, partial(_score, shared, corpus, k), "item int, id bigint, doc bigint, score bigint"
    )
    return merged(found, ["item"], [F.desc("score"), F.asc_nulls_last("doc")], k)


def _corpus(counts: dict[int, int], size: int) -> Corpus:
    n = counts.get(DOCUMENTS, 0)
    weights = [math.floor(1000 * math.log((2 * n + 2) / (2 * counts.get(t, 0) + 1))) for t in range(size)]
    return Corpus(n, counts.get(TERMS, 0), np.array(weights, np.int64))


def _count(shared: Broadcast, batches: Iterator[list[pa.Array]]) -> Iterator[list]:
    """Counts of this task's documents, of their terms, and of the documents per indexed term."""
    numbers = shared.value.numbers
    having: Counter[bytes] = Counter()
    documents = total = 0
    for _, texts in batches:
        for text in texts:
            found = terms(text.as_py() or b"")
            if found:
                documents += 1
                total += len(found)
                having.update(numbers.keys() & set(found))
    yield [[DOCUMENTS, TERMS, *(numbers[t] for t in having)], [documents, total, *having.values()]]


def _score(shared: Broadcast, corpus: Corpus, k: int, batches: Iterator[list[pa.Array]]) -> Iterator[list]:
    """This task's ``k`` best documents per item."""
    index: Index = shared.value
    heaps: list[list[tuple]] = [[] for _ in index.ids]
    # A score below this one cannot enter the item's heap.
    least = np.ones(len(index.ids), np.int64)
    for ids, texts in batches:
        docs, missing = ids_of(ids)
        for row, text in enumerate(texts):
            found = terms(text.as_py() or b"")
            if not found:
                continue
            share = 100 - B_PERCENT + B_PERCENT * len(found) * corpus.documents // corpus.terms
            scores = np.zeros(len(index.ids), np.int64)
            counts = Counter(found)
            for term in counts.keys() & index.numbers.keys():
                number, tf = index.numbers[term], counts[term]
                part = int(corpus.weights[number]) * (10**9 * tf // (K1_THOUSANDTHS * tf + 8 * share))
                scores[index.items[number]] += part * index.repeats[number]
            for item in np.flatnonzero(scores >= least):
                # Smaller ids are the greater entries, rows without an id the least ones.
                entry = (int(scores[item]), not missing[row], -int(docs[row]))
                heap = heaps[item]
                if len(heap) < k:
                    heapq.heappush(heap, entry)
                else:
                    heapq.heappushpop(heap, entry)
                if len(heap) == k:
                    least[item] = max(1, heap[0][0])
    entries = [(i, index.ids[i], -d if known else None, s) for i, h in enumerate(heaps) for s, known, d in h]
    yield [list(c) for c in zip(*entries)] if entries else [[], [], [], []]
