"""Relevance ranking (BM25).

One pass over the text gathers the corpus numbers (rows, mean length, rows per query term) with a
map-side combined aggregate; a second scores the matching rows, each from its own text alone. Only
the single row of corpus numbers is exchanged, so nothing is shuffled by term or by document.

With a stored table of statistics (``quern.operators.statistics``) the first pass is a look at a few of its rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.errors import QueryError
from quern.functions import predicates as P
from quern.functions.fields import Field
from quern.functions.text import TextQuery, holds, length, occurrences
from quern.operators.reads import check_positive
from quern.operators.statistics import check_statistics

# The usual BM25 parameters.
K1 = 1.2
B = 0.75


def rank(
    df: DataFrame,
    queries: Sequence[TextQuery],
    key: Field,
    condition: Column | None = None,
    require: str = "any",
    limit: int | None = None,
    score: str = "score",
    ordered: bool = True,
    corpus: DataFrame | None = None,
) -> DataFrame:
    """Rows that match any (or ``require="all"``) of the queries, best score first, ties by key.

    ``condition`` filters without scoring. Clause scores add up, each times its boost. Sorting all
    matches without a limit makes Spark sample, and so score, them once more: ``ordered=False`` where
    the order is not needed.

    ``corpus`` is a statistics table that covers the queries' text fields; ``df`` may then be a part of the rows it
    was taken over. Only rows that hold a prefix (the open end of ``phrase_prefix``) are still counted in ``df``.
    """
    if not queries:
        raise QueryError("rank needs at least one text query")
    if require not in ("any", "all"):
        raise QueryError(f"require is 'any' or 'all', not {require!r}")
    check_positive(limit)
    combine = P.any_of if require == "any" else P.all_of
    matched = df.filter(P.all_of(combine(*[q.condition for q in queries]), condition))

    known = _Corpus(df, queries, corpus)
    total = _plus([F.lit(q.boost) * known.score(q) for q in queries])
    out = known.measured(matched).withColumn(score, total).select(*df.columns, score)
    if ordered or limit is not None:
        out = out.orderBy(F.desc(score), key.col.asc())
    return out if limit is None else out.limit(limit)


class _Corpus:
    """The measures per row that the queries need, and their totals over the whole table."""

    def __init__(self, df: DataFrame, queries: Sequence[TextQuery], stored: DataFrame | None = None):
        self._fields: dict[str, Field] = {}
        # (field name, words, open end) -> column with their number of occurrences
        self._counts: dict[tuple[str, tuple[str, ...], bool], str] = {}
        weighed = {}  # those whose rows are counted: all but whole phrases
        for query in queries:
            for field in query.fields:
                if field.is_text:
                    self._fields[field.name] = field
                    for words, open_end in _counted(query):
                        column = self._counts.setdefault((field.name, words, open_end), f"__n{len(self._counts)}")
                        if len(words) == 1:
                            weighed[field.name, words, open_end] = column
        kept = {} if stored is None else {k: c for k, c in weighed.items() if not k[2]}
        totals = [] if stored is not None else [t for name in self._fields for t in self._counted_lengths(name)]
        for (name, words, open_end), column in weighed.items():
            if (name, words, open_end) not in kept:
                totals.append(F.count_if(holds(self._fields[name], words, open_end)).alias(column))
        # One row each: of what is counted now, and of what was counted before.
        self._totals = [df.agg(*totals).select(F.struct("*")).scalar()] if totals else []
        self._places = {c: 0 for c in weighed.values()} | {n: 0 for f in self._fields for n in self._total_names(f)}
        if stored is not None and self._fields:
            self._totals.append(self._looked_up(check_statistics(stored), kept))
            self._places |= {c: len(self._totals) - 1 for c in kept.values()}
            self._places |= {n: len(self._totals) - 1 for f in self._fields for n in self._total_names(f)}

    def _counted_lengths(self, name: str) -> list[Column]:
        rows, mean = self._total_names(name)
        filled = F.nullif(length(self._fields[name]), F.lit(0))  # rows without a token do not count
        return [F.count(filled).alias(rows), F.avg(filled).alias(mean)]

    def _looked_up(self, stored: DataFrame, kept: dict) -> Column:
        """The same numbers from a statistics table, of which only the rows of these fields and words are read."""
        words = sorted({words[0] for _, words, _ in kept})
        wanted = F.col("term").isNull() | F.col("term").isin(words) if words else F.col("term").isNull()
        parts = []
        for name in self._fields:
            rows, mean = self._total_names(name)
            whole = (F.col("field") == name) & F.col("term").isNull()
            n, tokens = F.sum(F.when(whole, F.col("rows"))), F.sum(F.when(whole, F.col("tokens")))
            parts += [n.alias(rows), F.try_divide(tokens.cast("double"), n).alias(mean)]
        for (name, words, _), column in kept.items():
            of_word = (F.col("field") == name) & (F.col("term") == words[0])
            parts.append(F.coalesce(F.sum(F.when(of_word, F.col("rows"))), F.lit(0)).alias(column))
        found = stored.where(F.col("field").isin(list(self._fields)) & wanted)
        return found.agg(*parts).select(F.struct("*")).scalar()

    def _total(self, column: str) -> Column:
        return F.col(f"__totals{self._places[column]}")[column]

    def _total_names(self, name: str) -> tuple[str, str]:
        index = list(self._fields).index(name)
        return f"__rows{index}", f"__mean{index}"

    def _length_name(self, name: str) -> str:
        return f"__len{list(self._fields).index(name)}"

    def measured(self, df: DataFrame) -> DataFrame:
        """Add the totals, the token count per field, and the occurrences per (field, words)."""
        if not self._totals:
            return df
        measures = {self._length_name(n): length(f) for n, f in self._fields.items()}
        for (name, words, open_end), column in self._counts.items():
            measures[column] = F.coalesce(occurrences(self._fields[name], words, open_end), F.lit(0))
        return df.withColumns(measures | {f"__totals{i}": row for i, row in enumerate(self._totals)})

    def _idf(self, field: Field, words: tuple[str, ...], open_end: bool = False) -> Column:
        unknown = F.raise_error(F.lit(f"the corpus has no statistics of {field.name}")).cast("bigint")
        rows = F.coalesce(self._total(self._total_names(field.name)[0]), unknown)
        having = self._total(self._counts[field.name, words, open_end])
        return F.ln(F.lit(1.0) + (rows - having + 0.5) / (having + 0.5))

    def _saturated(self, field: Field, words: tuple[str, ...], open_end: bool = False) -> Column:
        n = F.col(self._counts[field.name, words, open_end])
        mean = self._total(self._total_names(field.name)[1])
        relative = F.lit(1 - B) + F.lit(B) * F.col(self._length_name(field.name)) / mean
        return F.when(n > 0, n * F.lit(K1 + 1) / (n + F.lit(K1) * relative)).otherwise(0.0)

    def _term(self, field: Field, term: str) -> Column:
        return self._idf(field, (term,)) * self._saturated(field, (term,))

    def score(self, query: TextQuery) -> Column:
        if query.type == "cross_fields":
            text = [f for f in query.fields if f.is_text]
            total = _plus([_best([self._term(f, t) for f in text]) for t in query.terms if text])
            return _if(query.condition, total)
        parts = [self._field_score(query, f) for f in query.fields]
        return _plus(parts) if query.type == "most_fields" else _best(parts)

    def _field_score(self, query: TextQuery, field: Field) -> Column:
        if not field.is_text:
            return _if(query.condition_in(field), F.lit(1.0))
        if not query.terms:
            return F.lit(0.0)
        if query.type in ("phrase", "phrase_prefix"):
            *parts, whole = _counted(query)
            return _plus([self._idf(field, *p) for p in parts]) * self._saturated(field, *whole)
        total = _plus([self._term(field, t) for t in query.terms])
        if query.operator == "or" and query.minimum_should_match is None:
            return total
        return _if(query.condition_in(field), total)


def _counted(query: TextQuery) -> list[tuple[tuple[str, ...], bool]]:
    """The (words, open end) whose occurrences a query counts: its terms; a phrase as a whole comes last."""
    terms, open_end = query.terms, query.type == "phrase_prefix"
    counted = [((t,), False) for t in terms]
    if query.type in ("phrase", "phrase_prefix") and terms:
        counted[-1] = ((terms[-1],), open_end)
        counted.append((terms, open_end))
    return counted


def _plus(parts: list[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts) if parts else F.lit(0.0)


def _best(parts: list[Column]) -> Column:
    return parts[0] if len(parts) == 1 else F.greatest(*parts)


def _if(condition: Column, score: Column) -> Column:
    return F.when(F.coalesce(condition, F.lit(False)), score).otherwise(0.0)
