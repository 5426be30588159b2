"""Stored corpus statistics: sums that add up, and the same ranking from them as from the rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from quern.errors import QueryError
from quern.functions import text as X
from quern.functions.fields import fields
from quern.operators.highlighting import highlighted
from quern.operators.ranking import rank
from quern.operators.statistics import corpus_statistics, merge_statistics, without_statistics

ROWS = [
    (1, "red apple red", "fruit"),
    (2, "apple pie and apple sauce", "food"),
    (3, None, "none"),
    (4, "", None),
    (5, " ... ", "Red"),
    (6, "the red, red car", "red car"),
    (7, "静音 apple 3.14 don't", "x"),
    (8, "applet apples", "apple"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(ROWS, "id int, body string, title string").repartition(3)


def handles(df):
    f = fields(df, text=["body", "title"])
    return [f["body"], f["title"]]


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def expected(given):
    out = Counter()
    tokens = Counter()
    for _, *texts in given:
        for field, text in zip(("body", "title"), texts):
            found = X.query_tokens(text or "")
            if found:
                out.update([(field, None), *((field, t) for t in set(found))])
                tokens[field, None] += len(found)
    return sorted([(f, t, n, tokens[f, t]) for (f, t), n in out.items()], key=repr)


def test_statistics_are_counts_over_rows(docs):
    assert rows(corpus_statistics(docs, handles(docs))) == expected(ROWS)


def test_statistics_of_parts_add_up_and_come_off_again(docs):
    first, second = docs.where("id < 5"), docs.where("id >= 5")
    parts = [corpus_statistics(d, handles(d)) for d in (first, second)]
    assert rows(merge_statistics(*parts)) == expected(ROWS)
    assert rows(without_statistics(merge_statistics(*parts), parts[0])) == expected(ROWS[4:])
    assert rows(without_statistics(parts[0], parts[0])) == []
    none = docs.where("false")
    assert rows(merge_statistics(parts[0], corpus_statistics(none, handles(none)))) == expected(ROWS[:4])


def test_statistics_of_stored_tokens_are_the_same(docs):
    stored = X.analyze(docs, ["body", "title"])
    assert rows(corpus_statistics(stored, handles(stored))) == expected(ROWS)


def queries(df):
    body, title = handles(df)
    return {
        "terms": [X.text_query(body, "red apple pie", boost=2.0), X.text_query(title, "red")],
        "phrase": [X.text_query(body, "red car", "phrase")],
        "prefix": [X.text_query([body, title], "red app", "phrase_prefix"), X.text_query(body, "appl", "phrase_prefix")],
        "cross": [X.text_query([body, title], "red apple", "cross_fields")],
        "unknown": [X.text_query(body, "red nowhere")],
    }


@pytest.mark.parametrize("kind", ["terms", "phrase", "prefix", "cross", "unknown"])
@pytest.mark.parametrize("prepared", ["text", "lengths", "tokens"])
def test_ranking_by_stored_statistics_is_the_same(docs, kind, prepared):
    df = {"text": docs, "lengths": X.measure(docs, ["body", "title"]), "tokens": X.analyze(docs, ["body", "title"])}[prepared]
    # The statistics of two batches, appended and not yet added up.
    corpus = corpus_statistics(df.where("id % 2 = 0"), handles(df)).union(corpus_statistics(df.where("id % 2 = 1"), handles(df)))
    key = fields(df)["id"]

    def found(**options):
        return [(r["id"], round(r["score"], 9)) for r in rank(df, queries(df)[kind], key, **options).collect()]

    plain = [(r["id"], round(r["score"], 9)) for r in rank(docs, queries(docs)[kind], fields(docs)["id"]).collect()]
    assert plain and found(corpus=corpus) == plain == found()


def test_part_of_the_rows_is_ranked_by_all_of_them(docs):
    corpus = corpus_statistics(docs, handles(docs))
    some = docs.where("id in (1, 2)")
    query = [X.text_query(handles(docs)[0], "apple")]
    whole = {r["id"]: r["score"] for r in rank(docs, query, fields(docs)["id"]).collect()}
    assert {r["id"]: r["score"] for r in rank(some, query, fields(some)["id"], corpus=corpus).collect()} == {
        i: pytest.approx(whole[i]) for i in (1, 2)
    }


def test_ranked_highlights_take_stored_statistics(docs):
    body = handles(docs)[0]
    query = [X.text_query(body, "apple")]
    options = {"ranked": True, "key": fields(docs)["id"], "limit": 2}
    plain = highlighted(docs, query, [body], **options).collect()
    assert highlighted(docs, query, [body], corpus=corpus_statistics(docs, handles(docs)), **options).collect() == plain


def test_statistics_replace_the_pass_over_all_text(spark, docs, tmp_path):
    X.measure(docs, ["body", "title"]).write.parquet(f"{tmp_path}/docs")
    stored = spark.read.parquet(f"{tmp_path}/docs")
    f = fields(stored, text=["body", "title"])
    corpus_statistics(stored, [f["body"]]).write.parquet(f"{tmp_path}/corpus")
    corpus = spark.read.parquet(f"{tmp_path}/corpus")
    found = rank(stored, [X.text_query(f["body"], "red pie")], f["id"], corpus=corpus).select("id", "score")
    plan = found._jdf.queryExecution().executedPlan().toString()
    # One scan of the documents, whose stored lengths are used, and one of the words' statistics.
    assert plan.count("FileScan") == 2 and "body__length" in plan
    assert "Or(IsNull(term),In(term, [pie,red]))" in plan and "EqualTo(field,body)" in plan
    # The only patterns run are those of the words, on rows that hold them.
    assert X._COUNTED not in plan
    assert [r["id"] for r in found.collect()] == [r["id"] for r in rank(docs, [X.text_query(fields(docs, ["body"])["body"], "red pie")], fields(docs)["id"]).collect()]


def test_wrong_statistics_raise(spark, docs):
    body, title = handles(docs)
    for wrong in ([], [body, body], [fields(docs)["id"]]):
        with pytest.raises(QueryError):
            corpus_statistics(docs, wrong)
    with pytest.raises(QueryError):
        merge_statistics()
    with pytest.raises(QueryError, match="columns"):
        rank(docs, [X.text_query(body, "red")], fields(docs)["id"], corpus=docs)
    only_title = corpus_statistics(docs, [title])
    with pytest.raises(Exception, match="no statistics of body"):
        rank(docs, [X.text_query(body, "red")], fields(docs)["id"], corpus=only_title).collect()
    # Where nothing matches, nothing is missed.
    assert rank(docs, [X.text_query(body, "nowhere")], fields(docs)["id"], corpus=only_title).collect() == []


def test_each_text_is_split_once(docs):
    """Not once more for its length, for whether it has tokens, or per array the tokens are put into."""
    plan = corpus_statistics(docs, handles(docs))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all(") == 2 and "regexp_count" not in plan


def test_stored_lengths_and_tokens_are_taken_as_they_are(docs):
    measured = X.measure(docs, ["body", "title"])
    plan = corpus_statistics(measured, handles(measured))
    assert rows(plan) == expected(ROWS)
    stored = X.analyze(docs, ["body", "title"]).drop("body__length", "title__length")
    assert rows(corpus_statistics(stored, handles(stored))) == expected(ROWS)
