"""Packing token sequences by non-negative least squares over shallow length combinations.

Documents are tokenized once and cut into pieces: full windows, and one remainder shorter than the window.
Full windows are sequences of their own. Of the remainders only the histogram of lengths leaves the tasks: a
vector of ``window`` counts, whatever the corpus's size. On it

1. all combinations of at most three lengths that fill a window exactly are enumerated,
2. non-negative repeat counts x are sought that minimise ``|A x - histogram|`` (A: how often a combination
   uses a length), by accelerated projected gradients,
3. the counts are rounded, never using more pieces than there are, the largest first,
4. what is left is packed greedily: the longest piece left, then the longest that still fits.

The result is a list of patterns with repeat counts, at most a few thousand rows, from which every piece finds
its sequence by its rank among the pieces of its length. Ranks are counted in salted parts of a length, so
that a length with a third of all pieces is not one task's work.

Defined results:
- A null text is empty: a document of the separator alone. Repeated rows are documents of their own.
- Pieces of equal length are ranked by salt, document, start; ties of repeated rows in any order.
- An empty table gives an empty result. Other columns are never read, whatever their names.
"""

from __future__ import annotations

import base64
import functools
import json
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.llm.common import map_columns, written

PIECES = "doc bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


@functools.cache
def byte_bpe_encoder(ranks_path: str, pattern: str) -> Callable[[str], np.ndarray]:
    """From texts to ids of the byte-level vocabulary whose ranks lie in this file; special strings are plain text."""
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    encoding = tiktoken.Encoding("byte_bpe", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    return encoding.encode_ordinary


def byte_bpe_ids(text: str) -> np.ndarray:
    """Ids of text without added tokens by ``byte_bpe_50k.json``, from the rank file of the same vocabulary, which encodes four times as fast."""
    import public_tokenizers

    encode = byte_bpe_encoder(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    # Surrogates have no UTF-8 form; Spark's strings cannot hold them.
    return np.array(encode(text), "<u4")


@functools.cache
def added_tokens(json_path: str) -> dict[str, int]:
    """The tokens that the vocabulary's file adds to the merges; the library recognises them anywhere in a text."""
    with open(json_path, encoding="utf-8") as file:
        tokens = json.load(file).get("added_tokens", [])
    for token in tokens:
        if any(token.get(flag) for flag in ("single_word", "lstrip", "rstrip", "normalized")):
            raise ValueError(f"added token {token['content']!r} is not matched as it stands")
    return {token["content"]: token["id"] for token in tokens}


def vocabulary_ids(text: str) -> np.ndarray:
    """Ids of ``byte_bpe_50k.json`` with ``add_special_tokens=False``: added tokens by their own ids, the parts between by ranks."""
    import public_tokenizers

    added = added_tokens(public_tokenizers.path("byte_bpe_50k.json"))
    if not any(token in text for token in added):
        return byte_bpe_ids(text)
    longest_first = "|".join(map(re.escape, sorted(added, key=len, reverse=True)))
    parts = re.split(f"({longest_first})", text)
    return np.concatenate([np.array([added[p]], "<u4") if i % 2 else byte_bpe_ids(p) for i, p in enumerate(parts)])


def cut(
    docs: DataFrame,
    encode: Callable[[str], np.ndarray] = vocabulary_ids,
    window: int = 1024,
    separator: int = 0,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Full windows and the remainder of every document with its separator: PIECES."""

    def run(batches: Iterator[list]) -> Iterator[list]:
        for keys, texts in batches:
            rows = []
            for doc, content in zip(keys.to_pylist(), texts, strict=True):
                ids = np.append(encode(content.as_py() or ""), np.uint32(separator)).astype("<u4")
                for start in range(0, len(ids), window):
                    piece = ids[start : start + window]
                    rows.append((doc, start, len(piece), zlib.crc32(piece.tobytes()), len(ids)))
            if rows:
                yield list(zip(*rows, strict=True))

    return map_columns(docs.select(F.col(key).cast("bigint"), text), run, PIECES)


def combinations(window: int, lengths: np.ndarray) -> np.ndarray:
    """Rows of three lengths (0: none) that sum to the window, each in descending order, of the lengths given."""
    there = np.zeros(window + 1, bool)
    there[lengths] = True
    there[0] = True  # stands for no third piece
    a, b = np.meshgrid(np.arange(1, window), np.arange(1, window), indexing="ij")
    c = window - a - b
    fits = (a >= b) & (b >= c) & (c >= 0)
    a, b, c = a[fits], b[fits], c[fits]
    usable = there[a] & there[b] & there[c]
    return np.stack([a[usable], b[usable], c[usable]], axis=1)


def solve(combos: np.ndarray, histogram: np.ndarray, rounds: int = 400) -> np.ndarray:
    """Repeat counts x >= 0 that minimise ``|A x - histogram|`` (FISTA with restarts)."""
    size, n = len(histogram), len(combos)

    def used(x: np.ndarray) -> np.ndarray:
        total = sum(np.bincount(combos[:, i], x, size) for i in range(3))
        total[0] = 0
        return total

    def back(r: np.ndarray) -> np.ndarray:
        return r[combos].sum(axis=1)

    target = histogram.astype(float)
    target[0] = 0
    v = np.ones(n)
    for _ in range(20):  # the largest eigenvalue of A'A, by power iteration
        v = back(used(v))
        v /= np.linalg.norm(v)
    step = 1 / (1.05 * np.linalg.norm(back(used(v))) + 1e-12)
    x = y = np.zeros(n)
    t = 1.0
    for _ in range(rounds):
        gradient = back(used(y) - target)
        after = np.maximum(0, y - step * gradient)
        if np.dot(gradient, after - x) > 0:
            t = 1.0
        t_after = (1 + np.sqrt(1 + 4 * t * t)) / 2
        y = after + (t - 1) / t_after * (after - x)
        x, t = after, t_after
    return x


def plan(histogram: np.ndarray, window: int) -> list[tuple[tuple[int, ...], int]]:
    """Patterns (lengths that share a sequence) and how often each is used; together they use the histogram up.

    ``histogram[n]``: how many pieces have length n, for n from 0 to ``window``.
    """
    left = histogram.astype(np.int64).copy()
    patterns: list[tuple[tuple[int, ...], int]] = []

    def take(lengths: tuple[int, ...], times: int) -> None:
        if times > 0:
            patterns.append((lengths, times))
            for length in lengths:
                left[length] -= times

    def available(lengths: tuple[int, ...]) -> int:
        return min(int(left[n]) // lengths.count(n) for n in lengths)

    take((window,), int(left[window]))
    combos = combinations(window, np.nonzero(left)[0])
    if len(combos):
        x = solve(combos, left[:window])
        for rounded in (np.floor(x + 0.5), np.ceil(x)):  # first what the solution says, then what it hints at
            for i in np.argsort(-x, kind="stable"):
                if rounded[i] < 1:
                    if rounded is not x and x[i] <= 1e-9:
                        break
                    continue
                lengths = tuple(int(n) for n in combos[i] if n)
                take(lengths, min(int(rounded[i]), available(lengths)))
    while left.any():
        lengths, room = [], window
        counts = left.copy()
        while True:
            fitting = np.nonzero(counts[: room + 1])[0]
            if not len(fitting):
                break
            longest = int(fitting[-1])
            lengths.append(longest)
            counts[longest] -= 1
            room -= longest
        take(tuple(lengths), available(tuple(lengths)))
    return patterns


def slots(patterns: list[tuple[tuple[int, ...], int]], window: int) -> dict[int, tuple[np.ndarray, ...]]:
    """For every length the ranks at which a new slot begins, with that slot's first sequence, places per sequence and offset."""
    out: dict[int, list[tuple[int, int, int, int]]] = {}
    used = np.zeros(window + 1, np.int64)
    first = 0
    for lengths, times in patterns:
        offset = 0
        for length in dict.fromkeys(lengths):
            places = lengths.count(length)
            out.setdefault(length, []).append((int(used[length]), first, places, offset))
            used[length] += times * places
            offset += places * length
        first += times
    return {length: tuple(np.array(c, np.int64) for c in zip(*rows, strict=True)) for length, rows in out.items()}


def pack(
    spark: SparkSession,
    docs: DataFrame,
    encode: Callable[[str], np.ndarray] = vocabulary_ids,
    window: int = 1024,
    separator: int = 0,
    key: str = "doc_id",
    text: str = "text",
    part: int = 8192,
) -> DataFrame:
    """One row per piece: doc, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``part``: about how many pieces of one length are ranked by one task at once.
    """
    pieces = written(cut(docs, encode, window, separator, key, text), "packing-pieces")
    # At most ``window`` rows.
    counted = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    histogram = np.zeros(window + 1, np.int64)
    for length, n in counted.items():
        histogram[length] = n
    table = slots(plan(histogram, window), window)

    salts = int(histogram.max()) // part + 1
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc", "start"), F.lit(salts)).cast("int"))
    per_salt = salted.groupBy("length", "salt").agg(F.count("*").alias("n"))
    before = per_salt.select(
        F.col("length").alias("of"),
        F.col("salt").alias("part"),
        (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"),
    )
    ranked = salted.withColumn(
        "rank", F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc", "start"))
    )
    placed = ranked.join(before, (F.col("length") == F.col("of")) & (F.col("salt") == F.col("part"))).select(
        "doc", "start", "length", "ids_crc32", "doc_tokens", (F.col("before") + F.col("rank") - 1).alias("rank")
    )

    def assign(batches: Iterator[list]) -> Iterator[list]:
        for columns in batches:
            lengths, ranks = columns[2].to_numpy(), columns[5].to_numpy()
            sequence, offset = np.empty_like(ranks), np.empty_like(ranks)
            for length in np.unique(lengths):
                at = lengths == length
                begins, first, places, base = table[int(length)]
                slot = np.searchsorted(begins, ranks[at], "right") - 1
                inside = ranks[at] - begins[slot]
                sequence[at] = first[slot] + inside // places[slot]
                offset[at] = base[slot] + inside % places[slot] * length
            yield [*columns[:5], sequence, offset]

    return map_columns(placed, assign, f"{PIECES}, sequence_id bigint, offset bigint")
