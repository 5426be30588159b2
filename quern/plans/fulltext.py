"""Full text over whole documents and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.functions import predicates as P
from quern.functions import text as X
from quern.functions.fields import fields
from quern.operators.highlighting import highlighted
from quern.operators.ranking import rank
from quern.operators.statistics import corpus_statistics, merge_statistics, without_statistics
from quern.plans.tables import round_to, spread, table

# The token rule in RE2. Characters that are tokens of their own get blanks around them beforehand.
L, N = r"[\p{L}\p{M}\p{Nl}]", r"\p{Nd}"
TOKEN_SQL = rf"(?:{L}+(?:[.:·''’]{L}+)*|{N}+(?:[.,;''’]{N}+)*|_+)+"


def tokens_sql(text: str) -> str:
    apart = rf"regexp_replace(lower({text}), '([\p{{Han}}\p{{Hiragana}}]|[\p{{Katakana}}ー]+)', ' \1 ', 'g')"
    return f"regexp_extract_all({apart}, '{TOKEN_SQL}')"


TOKENS = f"""
WITH tokens AS (SELECT doc_id, lang, source, {tokens_sql('text')} AS t FROM documents),
words AS (SELECT doc_id, unnest(t) AS w FROM tokens)
"""


def documents(spark: SparkSession, directory: str):
    docs = table(spark, directory, "documents")
    return docs, fields(docs, text=["text"])


def analyzed(spark: SparkSession, directory: str) -> DataFrame:
    docs, f = documents(spark, directory)
    docs, toks = spread(docs), X.tokens(f["text"])
    return docs.select("doc_id", toks.alias("t")).select(
        "doc_id", F.size("t").cast("bigint").alias("n_tokens"), F.md5(F.array_join("t", " ")).alias("digest")
    )


def matching(condition):
    def query(spark: SparkSession, directory: str) -> DataFrame:
        docs, f = documents(spark, directory)
        return docs.filter(condition(f)).select("doc_id", "lang", "source")

    return query


def matched_stored(spark: SparkSession, directory: str) -> DataFrame:
    """Match against tokens kept as a column."""
    docs, _ = documents(spark, directory)
    stored = X.analyze(docs, ["text"], text=["text"])
    f = fields(stored, text=["text"])
    return stored.filter(X.match(f["text"], "thth erer")).select("doc_id", "lang", "source")


def across(condition):
    """Text and language as two full-text fields."""

    def query(spark: SparkSession, directory: str) -> DataFrame:
        docs = table(spark, directory, "documents")
        f = fields(docs, text=["text", "lang"])
        return docs.filter(condition(f)).select("doc_id", "lang", "source")

    return query


def ranked(queries, require: str = "any", limit: int | None = 100, text=("text",)):
    def query(spark: SparkSession, directory: str) -> DataFrame:
        docs = spread(table(spark, directory, "documents"))
        f = fields(docs, text=text)
        found = rank(docs, queries(f), f["doc_id"], require=require, limit=limit, ordered=limit is not None)
        return found.select("doc_id", round_to("score", 6).alias("score"))

    return query


def ranked_with_corpus(spark: SparkSession, directory: str) -> DataFrame:
    """Ranking by statistics that were taken in two batches and added up."""
    docs, f = documents(spark, directory)
    even = F.col("doc_id") % 2 == 0
    parts = [corpus_statistics(spread(docs.where(c)), [f["text"]]) for c in (even, ~even)]
    found = rank(
        spread(docs),
        [X.text_query(f["text"], "thth erst", boost=10.0), X.text_query(f["text"], "thon")],
        f["doc_id"],
        limit=100,
        corpus=parts[0].union(parts[1]),
    )
    return found.select("doc_id", round_to("score", 6).alias("score"))


def statistics(spark: SparkSession, directory: str) -> DataFrame:
    """The statistics of all documents' text and language, from two batches of which one was deleted again."""
    docs = table(spark, directory, "documents")
    f = fields(docs, text=["text", "lang"])
    over = [f["text"], f["lang"]]
    stored, english = corpus_statistics(spread(docs), over), corpus_statistics(spread(docs.where("lang = 'en'")), over)
    return without_statistics(merge_statistics(stored, english), english)


def marked_ranked(spark: SparkSession, directory: str) -> DataFrame:
    """Fragments of the twenty best documents, with their scores."""
    docs, f = documents(spark, directory)
    found = highlighted(
        spread(docs),
        [X.text_query(f["text"], "thth"), X.text_query(f["text"], "erst", boost=3.0)],
        [f["text"]],
        limit=20,
        key=f["doc_id"],
        pre_tag="<b>",
        post_tag="</b>",
        ranked=True,
    )
    return found.select(
        "doc_id", round_to("score", 6).alias("score"), F.posexplode(F.col("highlights")["text"]).alias("pos", "fragment")
    ).withColumn("pos", F.col("pos").cast("bigint"))


def _has(*words: str) -> str:
    return "list_has_any(t, [" + ", ".join(f"'{w}'" for w in words) + "])"


def _all(*words: str) -> str:
    return "list_has_all(t, [" + ", ".join(f"'{w}'" for w in words) + "])"


PICK = TOKENS + "SELECT doc_id, lang, source FROM tokens WHERE "


def bm25_sql(weights: dict[str, float], limit: int | None = 100, having: str = "true") -> str:
    """Sum over words of weight * idf * saturated frequency."""
    values = ", ".join(f"('{w}', {b})" for w, b in weights.items())
    tail = f" ORDER BY s DESC, doc_id LIMIT {limit}" if limit else ""
    return (
        TOKENS
        + f""", q(w, boost) AS (VALUES {values}),
size AS (SELECT doc_id, len(t) AS len FROM tokens),
totals AS (SELECT count(*) AS n, avg(len) AS mean FROM size WHERE len > 0),
tf AS (SELECT doc_id, w, count(*) AS tf FROM words WHERE w IN (SELECT w FROM q) GROUP BY 1, 2),
df AS (SELECT w, count(*) AS df FROM tf GROUP BY 1),
scored AS (SELECT tf.doc_id, sum(boost * ln(1 + (n - df + 0.5) / (df + 0.5))
                  * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / mean))) AS s, count(*) AS found
           FROM tf JOIN df USING (w) JOIN q USING (w) JOIN size USING (doc_id), totals GROUP BY 1)
SELECT doc_id, round(s, 6) AS score FROM scored WHERE {having}{tail}"""
    )


def fields_rank_sql(words: list[str], combine: str) -> str:
    """BM25 over the fields text and lang. ``combine``: max or sum over fields of the sum over words, or
    "cross" for the sum over words of the max over fields."""
    listed = ", ".join(f"'{w}'" for w in words)
    inner, outer = ("w", "max") if combine == "cross" else ("field", "sum")
    last = "sum" if combine == "cross" else combine
    return (
        TOKENS
        + f""", pair AS (SELECT doc_id, 'text' AS field, t FROM tokens
         UNION ALL SELECT doc_id, 'lang' AS field, [lang] AS t FROM documents),
size AS (SELECT doc_id, field, len(t) AS len FROM pair),
totals AS (SELECT field, count(*) AS n, avg(len) AS mean FROM size WHERE len > 0 GROUP BY 1),
tf AS (SELECT doc_id, field, w, count(*) AS tf FROM (SELECT doc_id, field, unnest(t) AS w FROM pair)
       WHERE w IN ({listed}) GROUP BY 1, 2, 3),
df AS (SELECT field, w, count(*) AS df FROM tf GROUP BY 1, 2),
parts AS (SELECT doc_id, field, w, ln(1 + (n - df + 0.5) / (df + 0.5))
                 * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / mean)) AS s
          FROM tf JOIN df USING (field, w) JOIN size USING (doc_id, field) JOIN totals USING (field)),
grouped AS (SELECT doc_id, {outer}(s) AS s FROM parts GROUP BY doc_id, {inner})
SELECT doc_id, round({last}(s), 6) AS score FROM grouped GROUP BY doc_id"""
    )


def phrase_rank_sql(words: list[str], limit: int) -> str:
    phrase = "  ".join(words)
    weights = " + ".join(
        f"(SELECT ln(1 + (n - d + 0.5) / (d + 0.5)) FROM totals,"
        f" (SELECT count(*) AS d FROM tokens WHERE list_contains(t, '{w}')))"
        for w in words
    )
    return (
        TOKENS
        + f""", totals AS (SELECT count(*) AS n, avg(len(t)) AS mean FROM tokens WHERE len(t) > 0),
joined AS (SELECT doc_id, len(t) AS len, ' ' || array_to_string(t, '  ') || ' ' AS j FROM tokens),
tf AS (SELECT doc_id, len, (length(j) - length(replace(j, ' {phrase} ', ''))) // length(' {phrase} ') AS tf FROM joined)
SELECT doc_id, round(({weights}) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / mean)), 6) AS score
FROM tf, totals WHERE tf > 0 ORDER BY ({weights}) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len / mean)) DESC, doc_id LIMIT {limit}"""
    )


def marked(queries, count, lang=None):
    """One row per fragment of the matching documents, of one language or of all."""

    def query(spark: SparkSession, directory: str) -> DataFrame:
        docs, f = documents(spark, directory)
        found = highlighted(
            spread(docs), queries(f), [f["text"]], P.eq(f["lang"], lang) if lang else None, pre_tag="<b>", post_tag="</b>", count=count
        )
        return found.select("doc_id", F.posexplode(F.col("highlights")["text"]).alias("pos", "fragment")).select(
            "doc_id", F.col("pos").cast("bigint").alias("pos"), "fragment"
        )

    return query


def marked_sql(words: list[str], count: int | None, lang: str | None = None) -> str:
    # RE2 has no lookaround: neighbours are captured, and a second pass tags hits that share one.
    word, join = r"\p{L}\p{M}\p{Nl}\p{Nd}_", ".:·''’"
    left = rf"(^|[^{word}{join}\x{{E000}}]|(?:^|[^\p{{L}}\p{{M}}\p{{Nl}}])[{join}])"
    right = rf"($|[^{word}{join}\x{{E001}}]|[{join}](?:$|[^\p{{L}}\p{{M}}\p{{Nl}}]))"
    pattern = rf"(?is){left}({'|'.join(words)}){right}"

    def tag(value: str) -> str:
        return rf"regexp_replace({value}, '{pattern}', '\1' || chr(57344) || '\2' || chr(57345) || '\3', 'g')"

    inside = r"(?:[^.!?。！？\n]|[.!?]+[^\s.!?。！？])"
    stop = r"(?:[.!?。！？]+(?:\s+|\z)|[.!?]*[。！？]+|\n+\s*)"
    piece = rf"{inside}{{0,99}}{stop}|[^\n]{{1,100}}(?:\s+|\z)|\S+\s*"
    keep = f" WHERE pos < {count}" if count else ""
    return f"""
WITH pieces AS (SELECT doc_id, unnest(p) AS piece, unnest(range(1, len(p) + 1)) AS i
                FROM (SELECT doc_id, regexp_extract_all(text, '{piece}') AS p FROM documents{f" WHERE lang = '{lang}'" if lang else ""})),
tagged AS (SELECT doc_id, i, {tag(tag('piece'))} AS m FROM pieces),
hits AS (SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS pos,
                replace(replace(m, chr(57344), '<b>'), chr(57345), '</b>') AS fragment
         FROM tagged WHERE contains(m, chr(57344)))
SELECT doc_id, pos, fragment FROM hits{keep}"""


QUERIES = {
    "TXT1_analyze": (
        analyzed,
        TOKENS + "SELECT doc_id, len(t) AS n_tokens, md5(array_to_string(t, ' ')) AS digest FROM tokens",
    ),
    "TXT2_match": (matching(lambda f: X.match(f["text"], "Thth, erer!")), PICK + _has("thth", "erer")),
    "TXT2_match_keyword": (
        matching(lambda f: X.match(f["source"], "src3")),
        "SELECT doc_id, lang, source FROM documents WHERE source = 'src3'",
    ),
    "TXT2_match_stored_tokens": (matched_stored, PICK + _has("thth", "erer")),
    "TXT3_TXT9_boosted_rank": (
        ranked(lambda f: [X.text_query(f["text"], "thth erst", boost=10.0), X.text_query(f["text"], "thon")]),
        bm25_sql({"thth": 10.0, "erst": 10.0, "thon": 1.0}),
    ),
    "TXT9_rank": (
        ranked(lambda f: [X.text_query(f["text"], "with this from")], limit=None),
        bm25_sql({"with": 1.0, "this": 1.0, "from": 1.0}, limit=None),
    ),
    "TXT9_rank_with_corpus": (ranked_with_corpus, bm25_sql({"thth": 10.0, "erst": 10.0, "thon": 1.0})),
    "TXT9_statistics": (
        statistics,
        TOKENS
        + """, pair AS (SELECT doc_id, 'text' AS field, t FROM tokens
  UNION ALL SELECT doc_id, 'lang' AS field, [lang] AS t FROM documents WHERE lang IS NOT NULL)
SELECT field, NULL AS term, count(*) AS rows, CAST(sum(len(t)) AS BIGINT) AS tokens FROM pair WHERE len(t) > 0 GROUP BY field
UNION ALL SELECT field, term, count(*) AS rows, CAST(0 AS BIGINT) AS tokens
FROM (SELECT field, unnest(list_distinct(t)) AS term FROM pair) GROUP BY field, term""",
    ),
    "TXT9_rank_all_required": (
        ranked(
            lambda f: [X.text_query(f["text"], "erer"), X.text_query(f["text"], "than thes", operator="and")],
            require="all",
        ),
        bm25_sql({"erer": 1.0, "than": 1.0, "thes": 1.0}, having="found = 3"),
    ),
    "TXT4_multi_match": (
        across(lambda f: X.multi_match([f["text"], f["lang"]], "DE erst")),
        PICK + _has("de", "erst") + " OR lang = 'de'",
    ),
    "TXT4_multi_match_keyword": (
        matching(lambda f: X.multi_match([f["text"], f["source"]], "src3")),
        PICK + _has("src3") + " OR source = 'src3'",
    ),
    **{
        f"TXT5_{kind}_rank": (
            ranked(
                lambda f, kind=kind: [X.text_query([f["text"], f["lang"]], "de es erst", kind)],
                limit=None,
                text=("text", "lang"),
            ),
            fields_rank_sql(["de", "es", "erst"], combine),
        )
        for kind, combine in (("best_fields", "max"), ("most_fields", "sum"), ("cross_fields", "cross"))
    },
    "TXT5_cross_fields_and": (
        across(lambda f: X.multi_match([f["text"], f["lang"]], "es que", "cross_fields", operator="and")),
        PICK + "(" + _has("es") + " OR lang = 'es') AND (" + _has("que") + " OR lang = 'que')",
    ),
    "TXT5_cross_fields_or": (
        across(lambda f: X.multi_match([f["text"], f["lang"]], "fr thth", "cross_fields")),
        PICK + "(" + _has("fr", "thth") + " OR lang IN ('fr', 'thth'))",
    ),
    "TXT5_phrase": (
        matching(lambda f: X.multi_match([f["text"]], "in the", "phrase")),
        PICK + "contains(' ' || array_to_string(t, ' ') || ' ', ' in the ')",
    ),
    "TXT5_phrase_rank": (
        ranked(lambda f: [X.text_query(f["text"], "on the", "phrase")], limit=50),
        phrase_rank_sql(["on", "the"], 50),
    ),
    "TXT5_phrase_prefix": (
        matching(lambda f: X.multi_match([f["text"]], "of the tha", "phrase_prefix")),
        PICK + "contains(' ' || array_to_string(t, ' ') || ' ', ' of the tha')",
    ),
    "TXT6_operator_and": (
        matching(lambda f: X.multi_match([f["text"]], "than erer ble", operator="and")),
        PICK + _all("than", "erer", "ble"),
    ),
    "TXT7_minimum_should_match": (
        matching(lambda f: X.multi_match([f["text"]], "thth erer thon wasis", minimum_should_match="75%")),
        PICK + "len(list_intersect(t, ['thth', 'erer', 'thon', 'wasis'])) >= 3",
    ),
    "TXT7_minimum_should_match_count": (
        matching(lambda f: X.multi_match([f["text"]], "thth erer thon", minimum_should_match=2)),
        PICK + "len(list_intersect(t, ['thth', 'erer', 'thon'])) >= 2",
    ),
    "TXT8_highlight": (
        marked(lambda f: [X.text_query(f["text"], "with from")], 5, "en"),
        marked_sql(["with", "from"], 5, "en"),
    ),
    "TXT8_highlight_ranked": (
        marked_ranked,
        f"""SELECT r.doc_id, r.score, m.pos, m.fragment FROM ({bm25_sql({"thth": 1.0, "erst": 3.0}, limit=20)}) r
JOIN ({marked_sql(["thth", "erst"], 5)}) m ON m.doc_id = r.doc_id""",
    ),
    "TXT8_highlight_all_fragments": (
        marked(lambda f: [X.text_query(f["text"], "thth")], None),
        marked_sql(["thth"], None),
    ),
}
