"""Full text: tokens, match and multi-match conditions.

The ``standard`` analyzer splits at Unicode word boundaries and lower-cases. Han and Hiragana
characters are tokens of their own, Katakana runs are one token, and a word may hold an inner
apostrophe or full stop (``don't``, ``3.14``). It is one regular expression, run by Spark.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import lru_cache, reduce

import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.errors import QueryError
from quern.functions.fields import LENGTH_OF, TOKENS_OF, Field, fields

# The characters that join two letters, or two digits, into one word.
BETWEEN_LETTERS = ".:·'’"
BETWEEN_DIGITS = ".,;'’"

_LONE = r"\p{IsHan}\p{IsHiragana}"
_KANA = r"\p{IsKatakana}ー"
# The plain Latin letters come first: they decide most characters without a Unicode lookup.
_LETTER = rf"[a-zA-ZÀ-ÖØ-öø-ÿ[\p{{L}}\p{{M}}\p{{Nl}}&&[^{_LONE}{_KANA}]]]"
_DIGIT = r"\p{Nd}"
# Possessive quantifiers: a token never needs backtracking, and long runs need no deep recursion.
TOKEN = (
    rf"(?:{_LETTER}++(?:[{BETWEEN_LETTERS}]{_LETTER}++)*+"
    rf"|{_DIGIT}++(?:[{BETWEEN_DIGITS}]{_DIGIT}++)*+"
    rf"|_++)++"
    rf"|[{_LONE}]|[{_KANA}]++"
)
# For counting only: most words are plain and end in a blank, which is then taken with them.
_COUNTED = r"[a-zA-ZÀ-ÖØ-öø-ÿ]++[ \n\t,;!?()]|" + TOKEN
# The same for the few words of a query, which are split on the driver.
_PY_TOKEN = regex.compile(TOKEN, regex.V1)

TYPES = ("best_fields", "most_fields", "cross_fields", "phrase", "phrase_prefix")


_WORD = rf"(?:{_LETTER}|{_DIGIT}|_)"
_GAP = rf"(?:(?!{_WORD})[^{_LONE}{_KANA}])*+"


def occurrence_pattern(words: Sequence[str], open_end: bool = False) -> str:
    """Finds the words as whole tokens side by side, without splitting the text into tokens.

    Whether a place in the text is the edge of a token shows in the two characters on each side. The
    words come first and their edges are tested after them, so that the search is one for plain text.
    ``open_end`` lets the last word be the start of a longer token.
    """
    parts = []
    for i, word in enumerate(words):
        literal = regex.escape(word, special_only=True)
        start = _no_token_before(word[0], literal) if i == 0 else ""
        end = "" if open_end and i == len(words) - 1 else _no_token_after(word[-1])
        parts.append(literal + start + end)
    return _GAP.join(parts)


def _kind(char: str) -> tuple[str, str] | None:
    """(characters a token goes on with next to ``char``, regex for a join beyond them)."""
    if regex.match(r"[\p{Han}\p{Hiragana}]", char):
        return None
    if regex.match(r"[\p{Katakana}ー]", char):
        return f"[{_KANA}]", ""
    if char == "_":
        return _WORD, ""
    return _WORD, _DIGIT if char.isdecimal() else _LETTER


def _no_token_before(char: str, literal: str) -> str:
    if (kind := _kind(char)) is None:
        return ""
    same, joined = kind
    joins = BETWEEN_DIGITS if joined == _DIGIT else BETWEEN_LETTERS
    return rf"(?<!{same}{literal})" + (rf"(?<!{joined}[{joins}]{literal})" if joined else "")


def _no_token_after(char: str) -> str:
    if (kind := _kind(char)) is None:
        return ""
    same, joined = kind
    joins = BETWEEN_DIGITS if joined == _DIGIT else BETWEEN_LETTERS
    return rf"(?!{same})" + (rf"(?![{joins}]{joined})" if joined else "")


def _check_analyzer(field: Field) -> None:
    if field.analyzer not in (None, "standard"):
        raise QueryError(f"analyzer {field.analyzer!r} of {field.name} is not available, only 'standard'")


def tokenize(col: Column) -> Column:
    """array<string> of the tokens of a text column, in order, repeats kept."""
    return F.regexp_extract_all(F.lower(col), F.lit(TOKEN), F.lit(0))


@lru_cache(maxsize=1024)
def query_tokens(query: str) -> tuple[str, ...]:
    return tuple(_PY_TOKEN.findall(query.lower()))


def tokens(field: Field) -> Column:
    """The tokens of a field: stored ones when ``analyze`` kept them, else split now."""
    _check_analyzer(field)
    if not field.is_text:
        return F.when(field.col.isNotNull(), F.array(field.col.cast("string")))
    return field.tokens if field.tokens is not None else tokenize(field.col)


def analyze(df: DataFrame, names: Iterable[str], text: Iterable[str] = ()) -> DataFrame:
    """Add tokens and their number per text field, so that a written table is split once and not per query."""
    known = fields(df, text or names)
    added = {}
    for name in names:
        _check_analyzer(known[name])
        added[f"{name}__tokens"] = tokenize(known[name].col)
    df = df.withColumns(added)
    for name in names:
        df = df.withMetadata(f"{name}__tokens", {TOKENS_OF: name})
    return measure(df, names, text or names)


def measure(df: DataFrame, names: Iterable[str], text: Iterable[str] = ()) -> DataFrame:
    """Add the number of tokens per text field: all that ranking with stored statistics needs beside the text."""
    known = fields(df, text or names)
    added = {}
    for name in names:
        _check_analyzer(known[name])
        added[f"{name}__length"] = length(known[name])
    df = df.withColumns(added)
    for name in names:
        df = df.withMetadata(f"{name}__length", {LENGTH_OF: name})
    return df


# ---- conditions over one field ----


def holds(field: Field, words: Sequence[str], open_end: bool = False) -> Column:
    """The words occur as tokens side by side."""
    if field.tokens is not None:
        if len(words) == 1 and not open_end:
            return F.array_contains(field.tokens, words[0])
        return F.contains(_spaced(field.tokens), F.lit(" " + " ".join(words) + ("" if open_end else " ")))
    text = F.lower(field.col)
    # Every word is a substring of the text: a cheap test that leaves few rows to the pattern.
    present = reduce(lambda a, b: a & b, [F.contains(text, F.lit(w)) for w in dict.fromkeys(words)])
    return present & F.rlike(text, F.lit(occurrence_pattern(words, open_end)))


def occurrences(field: Field, words: Sequence[str], open_end: bool = False) -> Column:
    """How often they do."""
    if field.tokens is None:
        return F.regexp_count(F.lower(field.col), F.lit(occurrence_pattern(words, open_end)))
    if len(words) == 1:
        word = F.lit(words[0])
        return F.size(F.filter(field.tokens, (lambda t: t.startswith(word)) if open_end else (lambda t: t == word)))
    phrase = " " + "  ".join(words) + ("" if open_end else " ")
    joined = _spaced(field.tokens, "  ")
    return F.floor((F.length(joined) - F.length(F.replace(joined, F.lit(phrase), F.lit("")))) / len(phrase))


def length(field: Field) -> Column:
    """Number of tokens: the stored one where there is one."""
    if field.n_tokens is not None:
        return field.n_tokens
    if field.tokens is not None:
        return F.size(field.tokens)
    return F.regexp_count(field.col, F.lit(_COUNTED))  # lower-casing changes no number of tokens


def _spaced(token_array: Column, blank: str = " ") -> Column:
    """Tokens joined by blanks, with one at each end. Tokens hold no blanks, so neighbours show."""
    return F.concat(F.lit(" "), F.array_join(token_array, blank), F.lit(" "))


def required_matches(minimum: str | int | None, n: int) -> int:
    """How many of ``n`` terms must match, one at least.

    A count or a percentage (rounded down), negative for how many may miss; or steps such as
    ``"2<75% 9<-3"``: up to 2 terms all of them, up to 9 terms 75%, beyond that all but 3.
    """
    if minimum is None:
        return 1
    text = str(minimum).strip()
    if "<" in text:
        need = n
        for step in text.split():
            most, _, rule = step.partition("<")
            if n <= _whole(most, minimum):
                break
            need = required_matches(rule, n)
        return need
    amount = _whole(text.removesuffix("%"), minimum)
    size = n * abs(amount) // 100 if text.endswith("%") else abs(amount)
    return max(n - size if amount < 0 or text.startswith("-") else size, 1)


def _whole(text: str, minimum) -> int:
    if not regex.fullmatch(r"-?\d+", text):
        raise QueryError(f"cannot read minimum_should_match {minimum!r}")
    return int(text)


@dataclass(frozen=True, eq=False)
class TextQuery:
    """A full-text clause over one or more fields; see ``multi_match`` for its options."""

    fields: tuple[Field, ...]
    query: str
    type: str = "best_fields"
    operator: str = "or"
    minimum_should_match: str | int | None = None
    boost: float = 1.0

    @property
    def terms(self) -> tuple[str, ...]:
        return query_tokens(self.query)

    def terms_for(self, field: Field) -> tuple[str, ...]:
        """The query as this field sees it: split for text fields, whole otherwise."""
        return self.terms if field.is_text else (self.query,)

    @property
    def condition(self) -> Column:
        if self.type == "cross_fields":
            # Term by term: each may be found in any of the fields.
            never = F.lit(False)
            return self._enough(
                [reduce(_either, [F.coalesce(self._term_in(f, t), never) for f in self.fields]) for t in self.terms]
            )
        return reduce(_either, [self.condition_in(f) for f in self.fields])

    def condition_in(self, field: Field) -> Column:
        """The condition as far as it concerns one field."""
        if not field.is_text:
            if self.type == "phrase_prefix" and isinstance(field.dtype, T.StringType):
                return field.col.startswith(self.query)
            return field.col == F.lit(self.query)
        if self.type in ("phrase", "phrase_prefix") and self.terms:
            return holds(field, self.terms, open_end=self.type == "phrase_prefix")
        return self._enough([holds(field, (t,)) for t in self.terms])

    def _term_in(self, field: Field, term: str) -> Column:
        return holds(field, (term,)) if field.is_text else field.col == F.lit(self.query)

    def _enough(self, found: list[Column]) -> Column:
        """As many of the terms as the operator or minimum_should_match asks for."""
        need = len(found) if self.operator == "and" else required_matches(self.minimum_should_match, len(found))
        if not found or need > len(found):
            return F.lit(False)
        if need == len(found):
            return reduce(lambda a, b: a & b, found)
        if need == 1:
            return reduce(_either, found)
        return reduce(lambda a, b: a + b, [f.cast("int") for f in found]) >= need


def _either(a: Column, b: Column) -> Column:
    return a | b


# ---- what users call ----


def text_query(
    over: Field | Sequence[Field],
    query: str,
    type: str = "best_fields",
    operator: str = "or",
    minimum_should_match: str | int | None = None,
    boost: float = 1.0,
) -> TextQuery:
    """A clause for ``rank`` and ``highlighted``; its ``condition`` is what ``match`` returns."""
    over = (over,) if isinstance(over, Field) else tuple(over)
    if not over:
        raise QueryError("multi_match needs at least one field")
    if query is None:
        raise QueryError("match needs a query")
    if type not in TYPES:
        raise QueryError(f"unknown multi_match type {type!r}")
    if operator not in ("or", "and"):
        raise QueryError(f"unknown operator {operator!r}")
    if boost < 0:
        raise QueryError("boost must not be negative")
    for field in over:
        _check_analyzer(field)
    return TextQuery(over, str(query), type, operator, minimum_should_match, float(boost))


def match(field: Field, query: str) -> Column:
    """Any token of ``query`` occurs. On other than text fields: the whole value is equal."""
    return text_query(field, query).condition


def multi_match(
    over: Sequence[Field],
    query: str,
    type: str = "best_fields",
    operator: str = "or",
    minimum_should_match: str | int | None = None,
) -> Column:
    """``match`` over several fields.

    best_fields, most_fields: in one field at least (they differ in score only). cross_fields: each
    token in any field. phrase: the tokens side by side in order. phrase_prefix: likewise, the last
    being the start of a token. ``operator="and"`` asks for all tokens; ``minimum_should_match``
    ("75%" or a count, with "or") for some of them.
    """
    return text_query(over, query, type, operator, minimum_should_match).condition
