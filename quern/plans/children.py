"""Nested children: the lines of a document, each with its words.

The children are cut from the document's own text, row by row, so that building them moves no data
and no array can outgrow the row it comes from.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import predicates as P
from quern.functions.fields import fields
from quern.operators import aggregations as A
from quern.operators import reads as R
from quern.operators.sorting import by_nested
from quern.plans.tables import round_to, spread, table


def documents(spark: SparkSession, directory: str, with_words: bool = False) -> DataFrame:
    """doc_id, lang, source, lines: array of (line_no, body, n_chars[, words: array of (word, n_chars)])."""

    def words(line):
        return F.transform(
            F.split(line, " ", -1), lambda w: F.struct(w.alias("word"), F.length(w).cast("bigint").alias("n_chars"))
        )

    lines = F.transform(
        F.split("text", "\n", -1),
        lambda line, i: F.struct(
            (i + 1).alias("line_no"),
            line.alias("body"),
            F.length(line).cast("bigint").alias("n_chars"),
            *([words(line).alias("words")] if with_words else []),
        ),
    )
    docs = table(spark, directory, "documents")
    docs = spread(docs) if with_words else docs
    return docs.select("doc_id", "lang", "source", lines.alias("lines"))


LINES = """
WITH lines AS (SELECT doc_id, lang, source, unnest(range(1, len(l) + 1)) AS line_no, unnest(l) AS body
               FROM (SELECT doc_id, lang, source, string_split(text, chr(10)) AS l FROM documents))
"""
WORDS = LINES + ", words AS (SELECT *, unnest(string_split(body, ' ')) AS word FROM lines)"


def same_child(spark: SparkSession, directory: str) -> DataFrame:
    """A line that is both short and starts with "The"; two lines sharing this do not count."""
    docs = documents(spark, directory)
    f = fields(docs)
    found = P.nested(f["lines"], lambda c: P.prefix(c["body"], "The") & P.between(c["n_chars"], 1, 40))
    return docs.filter(found).select("doc_id", "lang")


def two_levels(spark: SparkSession, directory: str) -> DataFrame:
    """A line after the third that has a word of 12 or more characters starting with "th"."""
    docs = documents(spark, directory, with_words=True)
    f = fields(docs)
    found = P.nested(
        f["lines"],
        lambda line: P.gt(line["line_no"], 3)
        & P.nested(line["words"], lambda w: P.prefix(w["word"], "th") & P.ge(w["n_chars"], 12)),
    )
    return docs.filter(found).select("doc_id", "lang")


def no_children(spark: SparkSession, directory: str) -> DataFrame:
    """Documents without a single line over 60 characters: an empty array counts as missing."""
    docs = documents(spark, directory).withColumn("long_lines", F.filter("lines", lambda c: c["n_chars"] > 60))
    return docs.filter(P.is_null(fields(docs)["long_lines"])).select("doc_id", "lang")


def scripted(spark: SparkSession, directory: str) -> DataFrame:
    """Documents with a line whose length is beyond a share of its number, by a script whose names clash with columns."""
    docs = documents(spark, directory).withColumns({"n_chars": F.lit(-1), "body": F.lit("none")})
    source = "n_chars > :share * lines.line_no and body like concat(:start, '%') and lang <> 'de'"
    return P.nested_script(docs, fields(docs)["lines"], source, {"share": 20, "start": "The"}).select("doc_id", "lang")


def scripted_hits(spark: SparkSession, directory: str) -> DataFrame:
    """The first two lines per document that a script picks."""
    docs = documents(spark, directory)
    found = P.with_script_hits(docs, "hits", fields(docs)["lines"], "pmod(n_chars, line_no + :n) = 0", 2, {"n": 3})
    return found.select("doc_id", F.explode("hits").alias("hit")).select(
        "doc_id", F.col("hit.line_no").cast("bigint").alias("line_no"), "hit.n_chars"
    )


def inner_hits(spark: SparkSession, directory: str) -> DataFrame:
    """English documents with their first three short lines that hold "tion"."""
    docs = documents(spark, directory)
    f = fields(docs)
    found = R.with_inner_hits(
        docs,
        f["lines"],
        lambda c: P.like(c["body"], "tion") & P.le(c["n_chars"], 200),
        3,
        P.eq(f["lang"], "en"),
    )
    return found.select("doc_id", F.explode("inner_hits").alias("hit")).select(
        "doc_id", F.col("hit.line_no").cast("bigint").alias("line_no"), "hit.body"
    )


def sort_by_longest(spark: SparkSession, directory: str) -> DataFrame:
    docs = documents(spark, directory)
    f = fields(docs)
    order = [by_nested(f["lines"], "n_chars", descending=True)]
    return R.search(docs, None, order, limit=100, key=f["doc_id"]).select("doc_id", "lang")


def sort_by_word(spark: SparkSession, directory: str) -> DataFrame:
    """By the longest word two levels down."""
    docs = documents(spark, directory, with_words=True)
    f = fields(docs)
    order = [by_nested(f["lines"], "words", "n_chars", descending=True)]
    return R.search(docs, None, order, limit=100, key=f["doc_id"]).select("doc_id", "lang")


def sort_by_filtered(spark: SparkSession, directory: str) -> DataFrame:
    """By the shortest line that starts with "The"; documents without one come last."""
    docs = documents(spark, directory)
    f = fields(docs)
    order = [by_nested(f["lines"], "n_chars", where=lambda c: P.prefix(c["body"], "The"))]
    return R.search(docs, P.eq(f["lang"], "en"), order, limit=500, key=f["doc_id"]).select("doc_id", "source")


def line_metrics(spark: SparkSession, directory: str) -> DataFrame:
    docs = documents(spark, directory)
    tree = A.nested("lines", A.avg("n_chars", name="avg_chars"), A.max("n_chars", name="max_chars"))
    found = A.aggregate(docs, P.ne(fields(docs)["lang"], "en"), tree).nested("lines")
    return found.withColumn("avg_chars", round_to("avg_chars", 6))


def line_metrics_per_language(spark: SparkSession, directory: str) -> DataFrame:
    docs = documents(spark, directory)
    tree = A.terms("lang", A.nested("lines", A.stats("n_chars", name="chars"), name="lines"), name="lang")
    found = A.aggregate(docs, None, tree).nested("lang", "lines")
    return found.withColumn("chars_avg", round_to("chars_avg", 6))


def common_words(spark: SparkSession, directory: str) -> DataFrame:
    """The ten most frequent words per language, two levels of children down."""
    docs = documents(spark, directory, with_words=True)
    words = A.nested("words", A.terms("word", name="word", size=10), name="words")
    tree = A.terms("lang", A.nested("lines", words, name="lines"), name="lang")
    return A.aggregate(docs, None, tree).buckets("lang", "lines", "words", "word")


def longest_lines(spark: SparkSession, directory: str) -> DataFrame:
    """Per language the two longest lines."""
    docs = documents(spark, directory)
    lines = A.nested("lines", A.top_hits(2, "n_chars", "body", name="longest"), name="lines")
    found = A.aggregate(docs, None, A.terms("lang", lines, name="lang")).hits("lang", "lines", "longest")
    return found.select("lang", F.col("hit_rank").cast("bigint").alias("hit_rank"), F.md5("hit.body").alias("body"))


QUERIES = {
    "P13_nested_script": (
        scripted,
        LINES + "SELECT DISTINCT doc_id, lang FROM lines WHERE length(body) > 20 * line_no AND starts_with(body, 'The') AND lang <> 'de'",
    ),
    "P13_RD10_script_hits": (
        scripted_hits,
        LINES
        + """SELECT doc_id, line_no, length(body) AS n_chars FROM lines WHERE length(body) % (line_no + 3) = 0
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY line_no) <= 2""",
    ),
    "P11_nested_same_child": (
        same_child,
        LINES
        + "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM lines"
        " WHERE starts_with(body, 'The') AND length(body) BETWEEN 1 AND 40)",
    ),
    "P11_nested_in_nested": (
        two_levels,
        WORDS
        + "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM words"
        " WHERE line_no > 3 AND starts_with(word, 'th') AND length(word) >= 12)",
    ),
    "P9_is_null_nested": (
        no_children,
        LINES
        + "SELECT doc_id, lang FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM lines WHERE length(body) > 60)",
    ),
    "P12_RD10_inner_hits": (
        inner_hits,
        LINES
        + "SELECT doc_id, line_no, body FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS r"
        " FROM lines WHERE lang = 'en' AND contains(body, 'tion') AND length(body) <= 200) WHERE r <= 3",
    ),
    "SRT3_order_by_nested": (
        sort_by_longest,
        LINES + "SELECT doc_id, lang FROM lines GROUP BY 1, 2 ORDER BY max(length(body)) DESC, doc_id LIMIT 100",
    ),
    "SRT3_order_by_nested_in_nested": (
        sort_by_word,
        WORDS + "SELECT doc_id, lang FROM words GROUP BY 1, 2 ORDER BY max(length(word)) DESC, doc_id LIMIT 100",
    ),
    "SRT4_order_by_nested_filtered": (
        sort_by_filtered,
        LINES
        + "SELECT doc_id, source FROM lines WHERE lang = 'en' GROUP BY 1, 2"
        " ORDER BY min(length(body)) FILTER (WHERE starts_with(body, 'The')) NULLS LAST, doc_id LIMIT 500",
    ),
    "AGG15_nested": (
        line_metrics,
        LINES
        + "SELECT count(*) AS doc_count, round(avg(length(body)), 6) AS avg_chars, max(length(body)) AS max_chars"
        " FROM lines WHERE lang <> 'en'",
    ),
    "AGG15_AGG16_nested_per_bucket": (
        line_metrics_per_language,
        LINES
        + "SELECT lang, count(*) AS doc_count, count(*) AS chars_count, min(length(body)) AS chars_min,"
        " max(length(body)) AS chars_max, round(avg(length(body)), 6) AS chars_avg, sum(length(body))::BIGINT AS chars_sum"
        " FROM lines GROUP BY 1",
    ),
    "AGG15_AGG2_terms_in_nested_in_nested": (
        common_words,
        WORDS
        + "SELECT lang, word, doc_count FROM (SELECT lang, word, count(*) AS doc_count,"
        " row_number() OVER (PARTITION BY lang ORDER BY count(*) DESC, word) AS r FROM words GROUP BY 1, 2) WHERE r <= 10",
    ),
    "AGG14_top_hits_in_nested": (
        longest_lines,
        LINES
        + "SELECT lang, hit_rank, md5(body) AS body FROM (SELECT lang, body, row_number() OVER"
        " (PARTITION BY lang ORDER BY length(body) DESC, body DESC) AS hit_rank FROM lines) WHERE hit_rank <= 2",
    ),
}
