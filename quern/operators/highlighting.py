"""Highlighting: matching rows with tagged fragments of the fields that hit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.errors import QueryError
from quern.functions import predicates as P
from quern.functions.fields import Field
from quern.functions.text import TextQuery, occurrence_pattern
from quern.operators.ranking import rank
from quern.operators.reads import check_cap, check_limit, search
from quern.operators.sorting import Sort

# Default tags, fragment length in characters and fragments per field.
PRE_TAG = "<em>"
POST_TAG = "</em>"
FRAGMENT_SIZE = 100
FRAGMENTS = 5

def fragment_pattern(size: int = FRAGMENT_SIZE) -> str:
    """Cuts a text into sentences, long ones at blanks, so that fragments stay near ``size`` characters.

    A stop ends a sentence before a blank only: inside ``3.14`` it does not. The wide stops are kept
    out by a lookbehind: as members of the class they make Java's matcher many times slower when
    several tasks run in one process.
    """
    inside = r"(?:[^.!?\n](?<![。！？])|[.!?]+[^\s.!?](?<![。！？]))"
    stop = r"(?:[.!?。！？]+(?:\s+|\z)|[.!?]*[。！？]+|\n+\s*)"
    return rf"{inside}{{0,{size - 1}}}{stop}|[^\n]{{1,{size}}}(?:\s+|\z)|\S+\s*"


def _marks_pattern(marks: Sequence[tuple[tuple[str, ...], bool]]) -> str:
    """Any of the (words, open end), longest first, in any case."""
    ordered = sorted(set(marks), key=lambda m: (-len(" ".join(m[0])), m))
    return "(?iu)(?:" + "|".join(occurrence_pattern(*m) for m in ordered) + ")"


def fragments(
    field: Field,
    queries: Sequence[TextQuery],
    pre_tag: str = PRE_TAG,
    post_tag: str = POST_TAG,
    size: int = FRAGMENT_SIZE,
    count: int | None = FRAGMENTS,
) -> Column:
    """array<string>: the first ``count`` (None: all) fragments of ``field`` with a hit, hits tagged."""
    marks = [m for q in queries if any(f.name == field.name for f in q.fields) for m in _marked(q, field)]
    nothing = F.array().cast("array<string>")
    if not marks:
        return nothing
    text = field.col.cast("string")
    if not field.is_text:
        tagged = F.array(F.concat(F.lit(pre_tag), text, F.lit(post_tag)))
        return F.when(text.isin([words[0] for words, _ in marks]), tagged).otherwise(nothing)
    pattern = F.lit(_marks_pattern(marks))
    replacement = F.lit(_literal(pre_tag) + "$0" + _literal(post_tag))
    pieces = F.regexp_extract_all(text, F.lit(fragment_pattern(size)), F.lit(0))
    hit = F.filter(pieces, lambda p: F.regexp_like(p, pattern))
    if count is not None:
        hit = F.slice(hit, 1, count)
    return F.transform(hit, lambda p: F.regexp_replace(p, pattern, replacement))


def _marked(query: TextQuery, field: Field) -> list[tuple[tuple[str, ...], bool]]:
    if field.is_text and query.type in ("phrase", "phrase_prefix"):
        return [(query.terms, query.type == "phrase_prefix")] if query.terms else []
    return [((t,), False) for t in query.terms_for(field)]


def _literal(tag: str) -> str:
    return tag.replace("\\", "\\\\").replace("$", "\\$")


def highlighted(
    df: DataFrame,
    queries: Sequence[TextQuery],
    over: Sequence[Field],
    condition: Column | None = None,
    sort: Sequence[Sort] = (),
    limit: int | None = None,
    key: Field | None = None,
    pre_tag: str = PRE_TAG,
    post_tag: str = POST_TAG,
    size: int = FRAGMENT_SIZE,
    count: int | None = FRAGMENTS,
    column: str = "highlights",
    ranked: bool = False,
    score: str = "score",
    corpus: DataFrame | None = None,
) -> DataFrame:
    """Matching rows plus a map from field name to fragments; fields without a hit are absent.

    ``ranked``: best score first, ties by ``key``, with the score as a column; ``limit`` then takes the top.
    ``corpus``: stored statistics for the scores, as in ``rank``. A limit needs ``ranked``, a sort or a key, else which rows it takes would be open.
    """
    if not over:
        raise QueryError("highlighting needs at least one field")
    if ranked:
        if sort or key is None:
            raise QueryError("ranked highlighting takes a key and no sort")
        found = rank(df, queries, key, condition, limit=limit, score=score, corpus=corpus)
    elif limit is not None and not sort and key is None:
        raise QueryError("a limit needs a sort, a key or ranked=True")
    else:
        found = search(df, _matching(queries, condition), sort, limit, key=key)
    entries = [F.struct(F.lit(f.name), fragments(f, queries, pre_tag, post_tag, size, count)) for f in over]
    return found.withColumn(column, F.map_filter(F.map_from_entries(F.array(*entries)), lambda _, v: F.size(v) > 0))


def select_highlighted(df: DataFrame, queries: Sequence[TextQuery], over: Sequence[Field], **options) -> DataFrame:
    """``highlighted`` behind the list cap: raises when no limit is set and too many rows match."""
    check_limit(options.get("limit"))
    out = highlighted(df, queries, over, **options)
    check_cap(P.where(df, _matching(queries, options.get("condition"))), options.get("limit"))
    return out


def _matching(queries: Sequence[TextQuery], condition: Column | None) -> Column:
    if not queries:
        raise QueryError("highlighting needs at least one text query")
    return P.all_of(P.any_of(*[q.condition for q in queries]), condition)
