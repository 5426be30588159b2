"""Similarity join on word shingles, filtered by prefixes under several global token orders.

Texts are lower-cased (A-Z) and split into words at ``[\\x20\\x09-\\x0D]``; a set holds the distinct runs of
``WORDS`` words, or the whole sequence of a shorter text. Two sets link when 5 * shared >= 4 * joint, a Jaccard
similarity of 0.8. Then, under any one order of all shingles, they share one of their first
``n - ceil(0.8 n) + 1`` shingles. A pair must pass that test under all ``ORDERS`` before it is verified.

How it runs.
1. Every text is read once to fingerprint its set, so that equal sets are one node, to draw a profile of it (how many
   shingles hash to each of about n / 4 to n / 2 buckets), and to count shingles in a table of fixed size. The orders put shingles whose counter is beyond what chance explains last, by size
   class, and are random otherwise, so that common lines and passages hardly ever fall into a prefix.
2. The prefixes under the first order are dealt by shingle and sorted by Spark; tasks stream over them and keep
   shingles of more than one node. The node that sorts first stands for the shingle, and every other node of
   the shingle is a candidate with that one only: no group is expanded into all its pairs.
3. Two sets share at most the sum of the smaller counts of their profiles. Pairs for which that is too little go
   before any text is moved. Texts of nodes in the other pairs are read again, through a filter of fixed size; a pair
   must share a shingle of its prefixes under the second and third order too, and is then verified on whole sets.
4. Nodes that link are joined to components. Only shingles that still span several components can hide a link,
   between nodes of one pivot: these are compared across components in blocks, by the same filters and
   verification, profiles first, and the components are joined anew. Pairs inside a component need
   no look, since they cannot change it.

Every link between different components is found: two sets that link share a shingle of their prefixes, so
that they meet in step 2 or 4. Shingles and sets are compared by 64-bit hashes.

Defined results:
- A null text or one without words has an empty set, links with nothing and is its own component.
- Equal sets link. Repeated rows of an id give a row each, all alike. Rows without an id form components under
  the smallest id linked with them, or null.
- An empty table gives an empty result. Other columns are never read, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from quern.llm.common import map_columns, may_contain, one_row_each, whole, written
from quern.llm.components import components

WORDS = 5
ORDERS = 3
COUNTERS = 1 << 23  # fixed size of the table of counts
CHUNK = 1 << 16  # counters per row of that table
_BLANK = np.zeros(256, bool)
_BLANK[[32, 9, 10, 11, 12, 13]] = True
_RANDOM = np.random.default_rng(9)
_BYTES = _RANDOM.integers(1, 1 << 63, 256, np.uint64)
_PLACES = _RANDOM.integers(1, 1 << 63, WORDS, np.uint64) | np.uint64(1)
_SHORT = _RANDOM.integers(1, 1 << 63, WORDS, np.uint64)
_SEEDS = _RANDOM.integers(1, 1 << 63, ORDERS, np.uint64)
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
MOST_BUCKETS = 13  # as a power of two, of a profile
_POWERS = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _mix(x: np.ndarray) -> np.ndarray:
    """A permutation of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS[0]) <= n:
        size = 1 << (n + 1).bit_length()
        for i, factor in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, factor, np.uint64)
            steps[0] = 1
            _POWERS[i] = np.multiply.accumulate(steps)
    return _POWERS[0], _POWERS[1]


def shingles(text: str | None) -> np.ndarray:
    """The set of a text as ascending 64-bit hashes."""
    data = np.frombuffer((text or "").encode().lower(), np.uint8)  # bytes.lower changes A-Z only
    blank = np.ones(len(data) + 2, bool)
    blank[1:-1] = _BLANK[data]
    starts = np.nonzero(blank[:-1] & ~blank[1:])[0]
    if not len(starts):
        return np.zeros(0, np.uint64)
    ends = np.nonzero(~blank[:-1] & blank[1:])[0]
    powers, inverses = _powers(len(data))
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTES[data] * powers[: len(data)], out=sums[1:])
    words = _mix((sums[ends] - sums[starts]) * inverses[starts])
    if len(words) < WORDS:
        whole_text = (words * _PLACES[: len(words)]).sum(dtype=np.uint64, keepdims=True)
        return _mix(whole_text + _SHORT[len(words) : len(words) + 1])
    runs = len(words) - WORDS + 1
    total = words[:runs] * _PLACES[0]
    for i in range(1, WORDS):
        total += words[i : i + runs] * _PLACES[i]
    return np.unique(_mix(total))


def node_of(found: np.ndarray) -> int:
    """A signed 64-bit fingerprint of a set."""
    total = _mix(found).sum(dtype=np.uint64, keepdims=True) + np.array([len(found)], np.uint64)
    return int(_mix(total).view(np.int64)[0])


def profile(found: np.ndarray) -> bytes:
    """How many shingles hash to each bucket, one byte each; a full byte stands for itself and whatever was beyond it."""
    power = min(MOST_BUCKETS, max(4, len(found).bit_length() - 2))
    at = (found >> np.uint64(64 - power)).astype(np.int64)
    return np.minimum(np.bincount(at, minlength=1 << power), 255).astype(np.uint8).tobytes()


def folded(profiles: list[bytes]) -> np.ndarray:
    """Profiles as rows of as many buckets as the shortest has: buckets of one beginning are added up."""
    width = min(map(len, profiles))
    table = np.empty((len(profiles), width), np.int16)
    for row, counts in zip(table, profiles, strict=True):
        found = np.frombuffer(counts, np.uint8)
        # What is cut off here counts as left out of the row.
        row[:] = found if len(found) == width else np.minimum(found.reshape(width, -1).sum(axis=1, dtype=np.int64), 32767)
    return table


def most_shared(one: np.ndarray, others: np.ndarray, n: int, sizes: np.ndarray) -> np.ndarray:
    """A bound on how many shingles a set shares with others, by their rows of :func:`folded`.

    What the counts of a row leave out of its set may be shared as well.
    """
    left_out = n - one.sum(dtype=np.int64) + sizes - others.sum(axis=1, dtype=np.int64)
    return np.minimum(one, others).sum(axis=1, dtype=np.int64) + left_out


def prefix(found: np.ndarray, order: int, levels: np.ndarray) -> np.ndarray:
    """The shingles of a set that come first under an order, as signed numbers.

    ``levels``: by counter, the size class of shingles; higher classes come later.
    """
    keys = _mix(found ^ _SEEDS[order]) >> np.uint64(8)
    keys |= levels[(found & np.uint64(COUNTERS - 1)).astype(np.int64)].astype(np.uint64) << np.uint64(56)
    most = len(found) // 5 + 1  # n - ceil(4 n / 5) + 1
    return found[np.argsort(keys, kind="stable")[:most]].view(np.int64)


# ---- step 1: nodes and counters


def _survey(batches: Iterator[list]) -> Iterator[list]:
    """Rows (doc, node, n, profile) of documents, and at the end rows (chunk, counts) of this task's counters."""
    counters = np.zeros(COUNTERS, np.uint32)
    waiting: list[np.ndarray] = []
    size = 0

    def count() -> None:
        nonlocal size
        if waiting:
            at = (np.concatenate(waiting) & np.uint64(COUNTERS - 1)).astype(np.int64)
            counters[:] += np.bincount(at, minlength=COUNTERS).astype(np.uint32)
        waiting.clear()
        size = 0

    for docs, texts in batches:
        ids, nodes, sizes, profiles = [], [], [], []
        for doc, text in zip(docs.to_pylist(), texts, strict=True):
            found = shingles(text.as_py())
            ids.append(doc)
            nodes.append(node_of(found) if len(found) else None)
            sizes.append(len(found))
            profiles.append(profile(found) if len(found) else None)
            waiting.append(found)
            size += len(found)
            if size > 2_000_000:
                count()
        none = [None] * len(ids)
        yield [ids, nodes, sizes, profiles, none, none]
    count()
    # One byte per counter is enough to tell apart what is common within one task.
    small = np.minimum(counters, 255).astype(np.uint8)
    for chunk in range(COUNTERS // CHUNK):
        part = small[chunk * CHUNK : (chunk + 1) * CHUNK]
        if part.any():
            yield [[None], [None], [None], [None], [chunk], [part.tobytes()]]


def _add_up(batches: Iterator[list]) -> Iterator[list]:
    totals: dict[int, np.ndarray] = {}
    for chunks, counts in batches:
        for chunk, part in zip(chunks.to_pylist(), counts, strict=True):
            total = totals.setdefault(chunk, np.zeros(CHUNK, np.int64))
            total += np.frombuffer(part.as_buffer(), np.uint8)
    for chunk, total in totals.items():
        yield [[chunk], [np.minimum(total, (1 << 32) - 1).astype("<u4").tobytes()]]


def _levels(counted: DataFrame) -> np.ndarray:
    """Size classes by counter: 0 for what chance makes of single shingles, then one more for every doubling."""
    totals = np.zeros(COUNTERS, np.uint32)
    for row in counted.toLocalIterator():  # COUNTERS / CHUNK rows, one after the other
        totals[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = np.frombuffer(row["counts"], "<u4")
    # The median is what a counter holds that no common shingle falls on; six deviations are beyond chance.
    usual = float(np.median(totals))
    levels = np.zeros(COUNTERS, np.uint8)
    for at in range(0, COUNTERS, CHUNK):
        extra = (totals[at : at + CHUNK] - usual) / (6 * np.sqrt(usual) + 4)
        levels[at : at + CHUNK] = np.where(extra < 1, 0, np.floor(np.log2(np.maximum(extra, 1))) + 1)
    return levels


# ---- step 2: shingles of more than one node


def _postings(levels: Broadcast, batches: Iterator[list]) -> Iterator[list]:
    for (texts,) in batches:
        tokens, nodes, sizes = [], [], []
        for text in texts:
            found = shingles(text.as_py())
            if len(found):
                first = prefix(found, 0, levels.value)
                tokens.append(first)
                nodes.append(np.full(len(first), node_of(found)))
                sizes.append(np.full(len(first), len(found), np.int32))
        if tokens:
            yield [np.concatenate(tokens), np.concatenate(nodes), np.concatenate(sizes)]


def _shared(batches: Iterator[list]) -> Iterator[list]:
    """Of rows sorted by (token, node), those of tokens with several nodes, each with the token's first node."""
    # Of the last token: token, first node, the last node's size, last node, the first one's size, whether it was given.
    last: tuple | None = None
    for columns in batches:
        token, node, size = (c.to_numpy() for c in columns)
        if not len(token):
            continue
        if last is not None:  # the group that began in an earlier batch
            token = np.concatenate([[last[0]], token])
            node = np.concatenate([[last[3]], node])
            size = np.concatenate([[last[2]], size]).astype(np.int32)
        fresh = np.ones(len(token), bool)
        fresh[1:] = (token[1:] != token[:-1]) | (node[1:] != node[:-1])
        token, node, size = token[fresh], node[fresh], size[fresh]
        begins = np.ones(len(token), bool)
        begins[1:] = token[1:] != token[:-1]
        starts = np.nonzero(begins)[0]
        group = np.cumsum(begins) - 1
        pivot, pivot_size = node[starts][group], size[starts][group]
        several = (np.diff(np.append(starts, len(token))) > 1)[group]
        if last is not None:  # the carried row is the last one seen of its token, whose first node is known
            pivot[group == 0], pivot_size[group == 0] = last[1], last[4]
            several[0] &= not last[5]
        tail = group == group[-1]
        given = bool(several[tail].any()) or (last is not None and group[-1] == 0 and last[5])
        first_node, first_size = pivot[tail][0], pivot_size[tail][0]
        last = (token[-1], first_node, size[-1], node[-1], first_size, given)
        yield [token[several], node[several], size[several], pivot[several], pivot_size[several]]


# ---- step 3: filters and verification


def _with_node(batches: Iterator[list]) -> Iterator[list]:
    for (texts,) in batches:
        found = [shingles(t.as_py()) for t in texts]
        yield [[node_of(f) if len(f) else None for f in found], texts]


def _may_link(batches: Iterator[list]) -> Iterator[list]:
    """Of pairs (a, b, n of both, profiles of both), those that may share enough."""
    for a, b, sizes_a, sizes_b, profiles_a, profiles_b in batches:
        keep = []
        for n, m, one, other in zip(*(c.to_pylist() for c in (sizes_a, sizes_b, profiles_a, profiles_b)), strict=True):
            table = folded([one, other])
            keep.append(bool(9 * most_shared(table[0], table[1:], n, np.array([m]))[0] >= 4 * (n + m)))
        chosen = pa.array(keep, pa.bool_())
        yield [a.filter(chosen), b.filter(chosen)]


def _verify(levels: Broadcast, batches: Iterator[list]) -> Iterator[list]:
    """Pairs that share a shingle of their prefixes under the other orders, too, and link on their whole sets."""
    kept: tuple[str, np.ndarray, list[np.ndarray]] = ("", shingles(""), [])
    others = range(1, ORDERS)
    for a, b, text_a, text_b in batches:
        links = []
        for one, other in zip(text_a, text_b, strict=True):
            one = one.as_py()
            if one != kept[0] or not kept[2]:
                found = shingles(one)
                kept = one, found, [prefix(found, order, levels.value) for order in others]
            left, right = kept[1], shingles(other.as_py())
            passed = all(
                np.isin(own, prefix(right, order, levels.value)).any() for order, own in zip(others, kept[2], strict=True)
            )
            shared = len(np.intersect1d(left, right, assume_unique=True)) if passed else 0
            links.append(passed and 100 * shared >= 80 * (len(left) + len(right) - shared))
        keep = pa.array(links, pa.bool_())
        yield [a.filter(keep), b.filter(keep)]


def _sizes_fit(a: str, b: str) -> Column:
    return (5 * F.col(a) >= 4 * F.col(b)) & (5 * F.col(b) >= 4 * F.col(a))


def _texts(nodes: DataFrame, rows: DataFrame, documents: DataFrame) -> DataFrame:
    """of, text: one row for each of these nodes, whose texts are read again."""
    # One document stands for each node.
    asked = nodes.select(F.col("node").alias("asked"))
    chosen = documents.join(asked, F.col("node") == F.col("asked"), "left_semi").groupBy("node").agg(
        F.min_by("doc", F.struct(F.col("doc").isNull(), "doc")).alias("doc")
    )
    read = may_contain(rows, "doc", chosen.select("doc")).select("text")
    read = map_columns(read, _with_node, "of bigint, text string")
    # The filter lets other rows through; their nodes are not asked for.
    wanted = read.join(asked, F.col("of") == F.col("asked"), "left_semi")
    return written(wanted.dropDuplicates(["of"]), "shingle-texts")


def _profiles(nodes: DataFrame, documents: DataFrame) -> DataFrame:
    """of, profile: one row for each of these nodes."""
    asked = nodes.select(F.col("node").alias("asked"))
    found = documents.join(asked, F.col("node") == F.col("asked"), "left_semi")
    return written(
        found.groupBy("node").agg(F.first("profile").alias("profile")).withColumnRenamed("node", "of"), "shingle-profiles"
    )


def _links(pairs: DataFrame, rows: DataFrame, documents: DataFrame, levels: Broadcast) -> DataFrame:
    """Of candidate pairs (a, b, n_a, n_b) of nodes under the first order, those that pass the other filters and link.

    Only texts of nodes in a pair whose profiles allow a link are read again.
    """

    def nodes(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()

    profiles = _profiles(nodes(pairs), documents)
    for end in ("b", "a"):
        own = profiles.select("of", F.col("profile").alias(f"profile_{end}"))
        pairs = pairs.join(own, F.col(end) == F.col("of")).drop("of")
    left = written(
        map_columns(
            pairs.select("a", "b", "n_a", "n_b", "profile_a", "profile_b"), _may_link, "a bigint, b bigint"
        ),
        "shingle-candidates",
    )
    texts = _texts(nodes(left), rows, documents)
    for end in ("b", "a"):
        own = texts.select("of", F.col("text").alias(f"text_{end}"))
        left = left.join(own, F.col(end) == F.col("of")).drop("of")
    return map_columns(left.select("a", "b", "text_a", "text_b"), partial(_verify, levels), "a bigint, b bigint")


# ---- step 4: links across components


def _overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """How many elements every two of the sets share."""
    n = len(sets)
    total = np.zeros((n, n), np.float32)
    values, at, counts = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(n), [len(s) for s in sets])
    several = counts > 1
    number = np.cumsum(several) - 1  # of the elements that more than one set has
    kept = several[at]
    owner, column = owner[kept], number[at][kept]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    for start in range(0, int(several.sum()), 4096):
        lo, hi = np.searchsorted(column, [start, start + 4096])
        has = np.zeros((n, 4096), np.float32)
        has[owner[lo:hi], column[lo:hi] - start] = 1
        total += has @ has.T
    return total


def _comparable(rows: list[tuple]) -> np.ndarray:
    """Which two rows (.., part, n, home, ..) are of different components and of fitting sizes, one at home in the band."""
    part, n, home = (np.array([r[i] for r in rows]) for i in (5, 6, 7))
    fit = (5 * n[:, None] >= 4 * n) & (5 * n >= 4 * n[:, None])
    return (part[:, None] != part) & fit & (home[:, None] | home)


def _by_group(batches: Iterator[list]) -> Iterator[list[tuple]]:
    """Rows that agree in their first four columns, which they are sorted by."""
    rows: list[tuple] = []
    for columns in batches:
        for row in zip(*(c.to_pylist() for c in columns), strict=True):
            if rows and rows[0][:4] != row[:4]:
                yield rows
                rows = []
            rows.append(row)
    if rows:
        yield rows


def _survivors(batches: Iterator[list]) -> Iterator[list]:
    """Rows of a group whose profile allows a link with a comparable one."""
    for rows in _by_group(batches):
        candidates = np.triu(_comparable(rows))
        if not candidates.any():
            continue
        table = folded([r[8] for r in rows])
        n = np.array([r[6] for r in rows])
        left = np.zeros(len(rows), bool)
        for i in np.nonzero(candidates.any(axis=1))[0]:
            others = np.nonzero(candidates[i])[0]
            near = others[9 * most_shared(table[i], table[others], n[i], n[others]) >= 4 * (n[i] + n[others])]
            left[near] = True
            left[i] |= len(near) > 0
        if left.any():
            yield list(zip(*(rows[i][:8] for i in np.nonzero(left)[0]), strict=True))


def _forest(levels: Broadcast, batches: Iterator[list]) -> Iterator[list]:
    """Links between the components of a group, as few as join what is joined.

    Candidates must share a shingle under every order; their whole sets decide.
    """
    for rows in _by_group(batches):
        sets = [shingles(r[8]) for r in rows]
        candidates = np.triu(_comparable(rows))
        for order in range(1, ORDERS):
            if candidates.any():
                candidates &= _overlaps([prefix(s, order, levels.value) for s in sets]) > 0
        if not candidates.any():
            continue
        shared = _overlaps(sets)
        n = np.array([r[6] for r in rows])
        linked = candidates & (100 * shared >= 80 * (n[:, None] + n - shared))
        parent = {r[5]: r[5] for r in rows}
        found = []
        for x, y in np.argwhere(linked):
            ends = []
            for end in (rows[x][5], rows[y][5]):
                while parent[end] != end:
                    parent[end] = parent[parent[end]]
                    end = parent[end]
                ends.append(end)
            if ends[0] != ends[1]:
                parent[ends[0]] = ends[1]
                found.append((rows[x][4], rows[y][4]))
        if found:
            yield list(zip(*found, strict=True))


def _links_across(
    shared: DataFrame, parts: DataFrame, rows: DataFrame, documents: DataFrame, levels: Broadcast, block: int
) -> DataFrame:
    """Links between components that step 3 could not see: those of two nodes that are no pivots.

    Such nodes share a shingle and so its pivot. A group, one pivot's and one band's, has the nodes of a class of
    size and those of the next; one of two that are compared is of the first, at home in the band. Groups of a
    single component, or with nobody at home, are left out. Larger groups are cut into blocks, and every two
    blocks compared in a task of their own, so that a task holds two blocks of texts at most and gives only
    links that join components, never the pairs it looks at.
    """
    key = ["pivot", "band", "one", "other"]
    placed = (
        shared.where("node <> pivot")
        .select("pivot", "node", "n")
        .distinct()
        .join(parts, F.col("node") == F.col("member"), "left")
        .withColumn("part", F.coalesce("component", "node"))
        .withColumn("class", F.floor(F.log(1.25, "n")).cast("int"))
        .select("pivot", "node", "n", "part", "class", F.explode(F.array(F.col("class"), F.col("class") - 1)).alias("band"))
        .select("pivot", "node", "n", "part", "band", (F.col("class") == F.col("band")).alias("home"))
    )
    placed = written(placed, "shingle-placed")
    spanning = written(
        placed.groupBy(F.col("pivot").alias("p"), F.col("band").alias("b"))
        .agg(F.min("part").alias("low"), F.max("part").alias("high"), F.count("*").alias("size"), F.count_if("home").alias("homes"))
        .where("low < high and homes > 0")
        .select("p", "b", F.ceil(F.col("size") / block).cast("int").alias("blocks")),
        "shingle-spanning",
    )
    own = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    pairs_of_blocks = F.transform(
        F.sequence(F.lit(0), F.col("blocks") - 1),
        lambda i: F.struct(F.least(own, i).alias("one"), F.greatest(own, i).alias("other")),
    )
    members = written(
        placed.join(spanning, (F.col("pivot") == F.col("p")) & (F.col("band") == F.col("b"))).select(
            "pivot", "band", F.inline(pairs_of_blocks), "node", "part", "n", "home"
        ),
        "shingle-members",
    )

    def grouped(members: DataFrame, table: DataFrame) -> DataFrame:
        joined = members.join(table, F.col("node") == F.col("of")).drop("of")
        return joined.repartition(*key).sortWithinPartitions(*key)

    profiles = _profiles(members.select("node").distinct(), documents)
    schema = "pivot bigint, band int, one int, other int, node bigint, part bigint, n int, home boolean"
    left = written(map_columns(grouped(members, profiles), _survivors, schema), "shingle-survivors")
    texts = _texts(left.select("node").distinct(), rows, documents)
    return map_columns(grouped(left, texts), partial(_forest, levels), "a bigint, b bigint")


def _parts(docs: DataFrame, key: str, text: str, block: int) -> tuple[DataFrame, DataFrame]:
    """(doc, node, n) per row of ``docs``, and (node, part, doc): each node's component and smallest document."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("bigint").alias("doc"), whole(text).alias("text"))
    survey = written(
        map_columns(rows, _survey, "doc bigint, node bigint, n int, profile binary, chunk int, counts binary"), "shingle-survey"
    )
    documents = survey.where("chunk is null").select("doc", "node", "n", "profile")
    counted = map_columns(
        survey.where("chunk is not null").select("chunk", "counts").repartition("chunk"),
        _add_up,
        "chunk int, counts binary",
    )
    levels = spark.sparkContext.broadcast(_levels(counted))

    postings = map_columns(rows.select("text"), partial(_postings, levels), "token bigint, node bigint, n int")
    shared = written(
        map_columns(
            postings.repartition("token").sortWithinPartitions("token", "node"),
            _shared,
            "token bigint, node bigint, n int, pivot bigint, pivot_n int",
        ),
        "shingle-shared",
    )
    first = written(
        shared.where((F.col("node") != F.col("pivot")) & _sizes_fit("n", "pivot_n"))
        .select(F.col("pivot").alias("a"), F.col("node").alias("b"), F.col("pivot_n").alias("n_a"), F.col("n").alias("n_b"))
        .distinct(),
        "shingle-pairs",
    )
    links = written(_links(first, rows, documents, levels), "shingle-links")
    parts = written(components(links, "a", "b"), "shingle-parts")

    more = written(_links_across(shared, parts, rows, documents, levels, block), "shingle-more")
    everything = links.union(more)

    # From nodes to documents: a component is named by its smallest document.
    joined = written(components(everything, "a", "b"), "shingle-components")
    by_node = documents.where("node is not null").groupBy("node").agg(F.min("doc").alias("doc"))
    named = (
        by_node.join(joined, F.col("node") == F.col("member"), "left")
        .select("node", F.coalesce("component", "node").alias("part"), "doc")
    )
    named = written(named, "shingle-named")
    levels.destroy()  # all that used it is written
    return documents, named


def linked_components(docs: DataFrame, key: str = "doc_id", text: str = "text", block: int = 1024) -> DataFrame:
    """key, n_shingles, component: the smallest key reachable by links, per row of ``docs``.

    ``block``: how many nodes of a group are compared with as many others by one task at once.
    """
    documents, named = _parts(docs, key, text, block)
    smallest = written(named.groupBy(F.col("part").alias("of")).agg(F.min("doc").alias("component")), "shingle-smallest")
    of_node = written(
        named.join(smallest, F.col("part") == F.col("of")).select(F.col("node").alias("of"), "component"),
        "shingle-of-node",
    )
    return documents.join(of_node, F.col("node") == F.col("of"), "left").select(
        F.col("doc").alias(key),
        F.col("n").cast("bigint").alias("n_shingles"),
        F.when(F.col("node").isNull(), F.col("doc")).otherwise(F.col("component")).alias("component"),
    )


def one_of_each(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each component: one with the smallest id, a null id last. Rows, not ids, are dropped;
    rows without a shingle stay."""
    documents, named = _parts(docs, key, text, 1024)
    least = F.min(F.struct(F.col("doc").isNull().alias("no_id"), "doc", "node"))
    best = written(named.groupBy(F.col("part").alias("of")).agg(least.alias("best")), "shingle-best")
    keeps = written(
        named.join(best, F.col("part") == F.col("of")).select(
            F.col("node").alias("of"), F.col("best.doc").alias("best_doc"), F.col("best.node").alias("best_node")
        ),
        "shingle-keeps",
    )
    stays = F.col("doc").eqNullSafe(F.col("best_doc")) & (F.col("node") == F.col("best_node"))
    told = written(
        documents.join(keeps, F.col("node") == F.col("of")).select(
            F.col("doc").alias("value"), F.col("node").alias("digest"), stays.alias("stays")
        ),
        "shingle-told",
    )

    def with_node(rows: DataFrame) -> DataFrame:
        schema = StructType([*rows.schema.fields, StructField("_digest", LongType())])
        return rows.mapInArrow(partial(_rows_with_node, text), schema)

    return one_row_each(docs, text, F.col(key).cast("bigint"), told, with_node)


def _rows_with_node(text: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [shingles(t.as_py()) for t in batch.column("_row").field(text)]
        nodes = pa.array([node_of(f) if len(f) else None for f in found], pa.int64())
        yield pa.RecordBatch.from_arrays([*batch.columns, nodes], [*batch.schema.names, "_digest"])
