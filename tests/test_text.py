"""Tokens, and the conditions that look for them without splitting, against brute force."""

import random

import pytest
from pyspark.sql import functions as F

from quern.errors import QueryError
from quern.functions import text as X
from quern.functions.fields import fields
from quern.operators.highlighting import fragments, highlighted
from quern.operators.ranking import rank
from quern.plans.tables import table
from tests.conftest import TESTDATA


def words(text):
    return list(X.query_tokens(text))


@pytest.mark.parametrize(
    "text, expected",
    [
        ("The QUICK-brown fox.", ["the", "quick", "brown", "fox"]),
        ("don't 3.14 a.b.c 12:30 1,000;5", ["don't", "3.14", "a.b.c", "12", "30", "1,000;5"]),
        ("M590 x_1 _ a1.b2", ["m590", "x_1", "_", "a1", "b2"]),
        ("静音无线鼠标 4K", ["静", "音", "无", "线", "鼠", "标", "4k"]),
        ("カタカナー ひら", ["カタカナー", "ひ", "ら"]),
        ("été Éàü naïve", ["été", "éàü", "naïve"]),
        ("", []),
        (" ...,;!? ", []),
    ],
)
def test_tokens(spark, text, expected):
    assert words(text) == expected
    assert spark.range(1).select(X.tokenize(F.lit(text))).first()[0] == expected


PIECES = ["a", "ab", "abc", "b", "1", "12", "_", ".", ",", "'", ":", " ", "  ", "\n", "-", "中", "文", "カ", "ー", "é", "A", "<"]


@pytest.fixture(scope="module")
def scraps(spark):
    rng = random.Random(7)
    rows = [(i, "".join(rng.choice(PIECES) for _ in range(rng.randint(0, 24)))) for i in range(3000)]
    df = spark.createDataFrame(rows, "id int, body string").repartition(4).cache()
    return df, {i: (text, words(text)) for i, text in rows}


def matching(df, condition):
    return {r["id"] for r in df.filter(condition).collect()}


def test_driver_and_executors_split_alike(spark, scraps):
    df, expected = scraps
    got = {r["id"]: r["t"] for r in df.select("id", X.tokenize(F.col("body")).alias("t")).collect()}
    assert got == {i: t for i, (_, t) in expected.items()}
    docs = table(spark, TESTDATA, "documents").select("text", X.tokenize(F.col("text")).alias("t")).collect()
    assert all(words(r["text"]) == r["t"] for r in docs)


def test_counts_equal_the_tokens(scraps):
    df, expected = scraps
    f = fields(df, text=["body"])["body"]
    wanted = ["a", "ab", "abc", "12", "_", "中", "カ", "カー", "a.b", "1,12", "a1", "é", "ab'a"]
    counts = {w: X.occurrences(f, (w,)).alias(f"w{i}") for i, w in enumerate(wanted)}
    rows = df.select("id", X.length(f).alias("len"), *counts.values()).collect()
    for r in rows:
        toks = expected[r["id"]][1]
        assert r["len"] == len(toks)
        assert [r[f"w{i}"] for i in range(len(wanted))] == [toks.count(w) for w in wanted]


def has_phrase(toks, phrase, open_end=False):
    n = len(phrase)
    for i in range(len(toks) - n + 1):
        part = toks[i : i + n]
        if part == phrase or (open_end and part[:-1] == phrase[:-1] and part[-1].startswith(phrase[-1])):
            return True
    return False


@pytest.mark.parametrize("stored", [False, True])
@pytest.mark.parametrize("query", ["a", "ab 12", "a b", "中 文", "中a", "カ a", "abc _ 1", "a.b ab", "12 a", "é"])
def test_conditions_equal_brute_force(scraps, query, stored):
    df, expected = scraps
    if stored:
        df = X.analyze(df, ["body"], text=["body"])
    f = fields(df, text=["body"])["body"]
    q = words(query)

    def brute(test):
        return {i for i, (_, toks) in expected.items() if test(toks)}

    assert matching(df, X.match(f, query)) == brute(lambda t: any(w in t for w in q))
    assert matching(df, X.multi_match([f], query, operator="and")) == brute(lambda t: all(w in t for w in q))
    assert matching(df, X.multi_match([f], query, "phrase")) == brute(lambda t: has_phrase(t, q))
    assert matching(df, X.multi_match([f], query, "phrase_prefix")) == brute(lambda t: has_phrase(t, q, True))
    assert matching(df, X.multi_match([f], query, minimum_should_match="50%")) == brute(
        lambda t: sum(w in t for w in q) >= max(1, len(q) // 2)
    )


def test_nothing_to_look_for(scraps):
    df, _ = scraps
    f = fields(df, text=["body"])["body"]
    for kind in X.TYPES:
        assert matching(df, X.multi_match([f], " ,. ", kind)) == set()


def test_fields_combine(spark):
    df = spark.createDataFrame(
        [(1, "red apple", "fresh"), (2, "red", "apple"), (3, "green", None), (4, None, "red apple pie")],
        "id int, a string, b string",
    )
    f = fields(df, text=["a", "b"])
    both = [f["a"], f["b"]]

    def hits(kind, **options):
        return matching(df, X.multi_match(both, "red apple", kind, **options))

    assert hits("best_fields") == {1, 2, 4} == hits("most_fields") == hits("cross_fields")
    assert hits("best_fields", operator="and") == {1, 4}
    assert hits("cross_fields", operator="and") == {1, 2, 4}
    assert hits("phrase") == {1, 4}
    assert matching(df, X.multi_match(both, "red app", "phrase_prefix")) == {1, 4}


@pytest.mark.parametrize(
    "rule, n, need",
    [
        (None, 4, 1), ("75%", 4, 3), ("75%", 3, 2), ("20%", 3, 1), (2, 4, 2), ("-1", 4, 3), ("-25%", 4, 3),
        ("-25%", 3, 3), ("2<75%", 2, 2), ("2<75%", 4, 3), ("2<-25% 9<-3", 12, 9), (7, 3, 7),
    ],
)
def test_required_matches(rule, n, need):
    assert X.required_matches(rule, n) == need


def test_bad_options(scraps):
    f = fields(scraps[0], text=["body"])["body"]
    for options in ({"type": "x"}, {"operator": "xor"}, {"boost": -1}):
        with pytest.raises(QueryError):
            X.text_query(f, "a", **options)
    with pytest.raises(QueryError):
        X.multi_match([f], "a b", minimum_should_match="some").alias("x")
    with pytest.raises(QueryError):
        X.match(f, None)


def test_rank_with_stored_tokens_is_the_same(scraps):
    df, _ = scraps
    for kind, query in (("best_fields", "ab 12"), ("phrase", "a b"), ("phrase_prefix", "a a"), ("cross_fields", "a 中")):
        scores = []
        for frame in (df, X.analyze(df, ["body"], text=["body"])):
            f = fields(frame, text=["body"])
            found = rank(frame, [X.text_query(f["body"], query, kind)], f["id"]).select("id", "score").collect()
            scores.append([(r["id"], round(r["score"], 9)) for r in found])
        assert scores[0] == scores[1] and scores[0]
        values = [s for _, s in scores[0]]
        assert values == sorted(values, reverse=True) and min(values) > 0


def test_rank_filters_and_options(spark):
    df = spark.createDataFrame([(1, "x y"), (2, "x"), (3, "y y z"), (4, None)], "id int, t string")
    f = fields(df, text=["t"])
    x, y = X.text_query(f["t"], "x"), X.text_query(f["t"], "y")
    ids = lambda d: [r["id"] for r in d.collect()]
    assert ids(rank(df, [x, y], f["id"], require="all")) == [1]
    assert ids(rank(df, [x], f["id"], condition=F.col("id") > 1)) == [2]
    assert ids(rank(df, [y], f["id"], limit=1)) == [3]
    assert set(ids(rank(df, [x, y], f["id"], ordered=False))) == {1, 2, 3}
    assert ids(rank(df, [X.text_query(f["id"], "2")], f["id"])) == [2]
    for wrong in (lambda: rank(df, [], f["id"]), lambda: rank(df, [x], f["id"], require="some"),
                  lambda: rank(df, [x], f["id"], limit=0)):
        with pytest.raises(QueryError):
            wrong()


def test_ranked_highlights_take_the_best(spark):
    df = spark.createDataFrame([(1, "cat and dog and more words"), (2, "cat cat"), (3, "dog"), (4, "cat")], "id int, t string")
    f = fields(df, text=["t"])
    cat = X.text_query(f["t"], "cat")
    rows = highlighted(df, [cat], [f["t"]], ranked=True, key=f["id"], limit=2).collect()
    best = rank(df, [cat], f["id"], limit=2).collect()
    assert [(r["id"], r["score"]) for r in rows] == [(r["id"], r["score"]) for r in best]
    assert all("<em>cat</em>" in r["highlights"]["t"][0] for r in rows)
    assert rank(df, [cat], f["id"], limit=20_000).count() == 3
    for options in ({"limit": 2}, {"ranked": True}):
        with pytest.raises(QueryError):
            highlighted(df, [cat], [f["t"]], **options)


def test_highlights_mark_whole_tokens(spark):
    df = spark.createDataFrame(
        [(1, "The cat. A cat's cat, concat; cat.alog CAT_1 \"Cat\""), (2, "in the end of the line"), (3, "no hit")],
        "id int, t string",
    )
    f = fields(df, text=["t"])

    def marked(*queries, **options):
        rows = highlighted(df, queries, [f["t"]], **options).collect()
        return {r["id"]: r["highlights"]["t"] for r in rows}

    joined = "".join(marked(X.text_query(f["t"], "cat"), size=1000)[1])
    assert joined == "The <em>cat</em>. A cat's <em>cat</em>, concat; cat.alog CAT_1 \"<em>Cat</em>\""
    assert marked(X.text_query(f["t"], "of the", "phrase")) == {2: ["in the end <em>of the</em> line"]}
    assert marked(X.text_query(f["t"], "the li", "phrase_prefix")) == {2: ["in the end of <em>the li</em>ne"]}
    assert marked(X.text_query(f["t"], "the"), pre_tag="$1\\", post_tag="$") == {
        1: ["$1\\The$ cat. "], 2: ["in $1\\the$ end of $1\\the$ line"],
    }


def test_fragments_keep_the_whole_text(spark):
    """All pieces put together are the text; a limit takes the first ones."""
    text = "word " * 300 + "needle. " + "x" * 500 + " needle! Short needle? " + "中" * 250 + "\n\nneedle"
    df = spark.createDataFrame([(1, text)], "id int, t string")
    f = fields(df, text=["t"])
    query = [X.text_query(f["t"], "needle word x 中")]
    got = df.select(fragments(f["t"], [X.text_query(f["t"], "needle")], count=None).alias("h")).first()["h"]
    assert sum(p.count("<em>needle</em>") for p in got) == 4
    assert len(df.select(fragments(f["t"], [X.text_query(f["t"], "needle")], count=2).alias("h")).first()["h"]) == 2
    everything = df.select(fragments(f["t"], query, "", "", count=None).alias("h")).first()["h"]
    assert all(len(p) <= 110 for p in everything if " " in p.strip() or "." in p)


def test_match_inside_children(spark):
    from pyspark.sql import types as T

    from quern.functions import predicates as P

    child = T.StructType(
        [T.StructField("body", T.StringType(), True, {"analyzer": "standard"}), T.StructField("n", T.IntegerType())]
    )
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("kids", T.ArrayType(child))])
    df = spark.createDataFrame(
        [(1, [("A red apple", 1), ("pie", 2)]), (2, [("apples", 1), ("red", 2)]), (3, None), (4, [(None, 2)])], schema
    )
    kids = fields(df)["kids"]
    assert matching(df, P.nested(kids, lambda c: X.match(c["body"], "APPLE pie"))) == {1}
    assert matching(df, P.nested(kids, lambda c: X.match(c["body"], "red") & P.eq(c["n"], 2))) == {2}
    assert matching(df, P.nested(kids, lambda c: X.multi_match([c["body"]], "red apple", "phrase"))) == {1}
    with pytest.raises(QueryError):
        P.nested(kids, lambda c: P.eq(c["body"], "pie"))
