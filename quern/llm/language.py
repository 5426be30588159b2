"""Language identification by words first, backing off to ever shorter character n-grams.

A known word scores by its log frequency in each language. For an unseen word, the longest known n-gram that
begins at each of its characters is looked up, from ``LONGEST`` characters down to one, and the word scores by
their mean. A text scores by the sum over its words; the score given is the posterior of the language chosen,
all languages being equally likely beforehand.

How it runs. The model is counted by Spark from labelled rows and holds at most ``max_words`` words and
``max_grams`` n-grams; that bounds what is collected and broadcast. Counting may use at most about ``max_rows`` rows,
those whose id hashes lowest. All three bounds are dealt out to the languages evenly, and what a small language leaves
over goes to the others: a rare language keeps all its rows, and its own most frequent words and n-grams, however large
the others are. Prediction reads every text whole and moves no rows; scores of unseen words are kept in a table per
Python worker that is bounded in rows and characters.

Defined results:
- A null text, an empty one, or one without a letter is ``und`` with score 0; so is any text if there are no
  labelled rows. Words are runs of letters of the lower-cased text.
- Equal scores go to the language that sorts first. Repeated rows are predicted alike.
- An empty table gives an empty result. Other columns are never read, whatever their names.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.llm.common import map_columns, written

UNDETERMINED = "und"
LONGEST = 4
KNOWN_ROWS = 400_000  # rows of a worker's table of scores: model and unseen words
KNOWN_CHARACTERS = 16_000_000  # of unseen words in that table, beyond those of the words looked up last
PART = 20_000  # words of a text that are looked up at once


@dataclass
class Model:
    """Log frequencies per language: row i of ``scores`` belongs to ``words`` and, after them, ``grams``."""

    languages: list[str]
    words: dict[str, int]
    grams: dict[str, int]
    scores: np.ndarray


def train(
    labelled: DataFrame,
    text: str = "text",
    lang: str = "lang",
    key: str = "doc_id",
    max_rows: int = 20_000,
    max_words: int = 60_000,
    max_grams: int = 60_000,
) -> Model:
    """Count the model from rows with a language; rows without one, or without text, say nothing."""
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text"), F.xxhash64(key, text).alias("h")
    )
    # One row per language; languages are few, and each has many rows behind it.
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    if sum(sizes.values()) > max_rows:
        quotas = _quotas(sizes, max_rows)
        shares = {x: int((1 << 40) * min(1.0, quotas[x] / n)) for x, n in sizes.items()}
        rows = rows.where(F.pmod("h", F.lit(1 << 40)) < _by_language(shares))
    words = written(
        rows.select("lang", F.explode(F.split(F.lower("text"), r"[^\p{L}]+")).alias("word"))
        .where("word <> ''")
        .groupBy("lang", "word")
        .agg(F.count("*").alias("n")),
        "language-words",
    )
    padded = F.concat(F.lit("_"), F.col("word"), F.lit("_"))
    grams = F.flatten(
        F.array(
            *[
                F.when(
                    F.length(padded) >= size,
                    F.transform(F.sequence(F.lit(1), F.length(padded) - size + 1), _piece(padded, size)),
                ).otherwise(F.array().cast("array<string>"))
                for size in range(1, LONGEST + 1)
            ]
        )
    )
    counted_grams = written(
        words.select("lang", "n", F.explode(grams).alias("word")).groupBy("lang", "word").agg(F.sum("n").alias("n")),
        "language-grams",
    )
    known, word_scores, languages = _frequent(words, max_words)
    if not languages:
        return Model([], {}, {}, np.zeros((0, 0)))
    pieces, gram_scores, _ = _frequent(counted_grams, max_grams)
    return Model(
        languages, known, {g: len(known) + i for g, i in pieces.items()}, np.concatenate([word_scores, gram_scores])
    )


def _quotas(sizes: dict[str, int], most: int) -> dict[str, int]:
    """``most`` dealt out evenly; what is beyond a small size goes to the larger ones."""
    quotas, left = {}, most
    for place, (lang, size) in enumerate(sorted(sizes.items(), key=lambda x: (x[1], x[0]))):
        quotas[lang] = min(size, left // (len(sizes) - place))
        left -= quotas[lang]
    return quotas


def _by_language(values: dict[str, int]) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[F.col("lang")]


def _piece(text, size):
    return lambda i: F.substring(text, i, F.lit(size))


def _frequent(counts: DataFrame, most: int) -> tuple[dict[str, int], np.ndarray, list[str]]:
    """Every language's most frequent strings (together at most ``most``), their smoothed log frequencies per language,
    and the languages."""
    totals = counts.groupBy("lang").agg(F.count("*").alias("strings"), F.sum("n").alias("n")).collect()
    if not totals:
        return {}, np.zeros((0, 0)), []
    languages = sorted(r["lang"] for r in totals)
    quotas = _quotas({r["lang"]: r["strings"] for r in totals}, most)
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "word"))
    frequent = counts.withColumn("place", place).where(F.col("place") <= _by_language(quotas))
    chosen = counts.join(frequent.select("word").distinct(), "word", "left_semi")
    pivot = chosen.groupBy("word").pivot("lang", languages).agg(F.sum("n"))
    escaped = [F.col("`" + x.replace("`", "``") + "`") for x in languages]
    top = pivot.select("word", *[F.coalesce(c, F.lit(0)).alias(f"n{i}") for i, c in enumerate(escaped)]).orderBy("word").collect()
    sums = {r["lang"]: r["n"] for r in totals}
    table = np.array([list(r)[1:] for r in top], float).reshape(len(top), len(languages))
    scores = np.log((table + 0.5) / (np.array([sums[x] for x in languages], float) + 0.5 * (len(top) + 1)))
    return {r["word"]: i for i, r in enumerate(top)}, scores, languages


class Scorer:
    """Looks words up, working out and keeping the scores of unseen ones."""

    def __init__(self, model: Model):
        self.model = model
        self.rows = np.empty((max(KNOWN_ROWS, 2 * len(model.scores)), len(model.languages)))
        self.rows[: len(model.scores)] = model.scores
        self.floor = model.scores.min(axis=0) if len(model.scores) else np.zeros(len(model.languages))
        self.forget()

    def forget(self) -> None:
        self.index = dict(self.model.words)
        self.used = len(self.model.scores)
        self.characters = 0

    def unseen(self, word: str) -> np.ndarray:
        padded, grams, found = f"_{word}_", self.model.grams, []
        for at in range(len(padded)):
            for size in range(min(LONGEST, len(padded) - at), 0, -1):
                i = grams.get(padded[at : at + size])
                if i is not None:
                    found.append(i)
                    break
        return self.model.scores[found].mean(axis=0) if found else self.floor

    def add(self, words: list[str]) -> np.ndarray:
        """The sum of the scores of at most PART words."""
        at = list(map(self.index.get, words))
        if None in at:
            missing = {w for w, i in zip(words, at, strict=True) if i is None}
            characters = sum(map(len, missing))
            if self.used + len(missing) > len(self.rows) or self.characters + characters > KNOWN_CHARACTERS:
                self.forget()
                missing = {w for w in words if w not in self.index}
            for word in missing:
                self.rows[self.used] = self.unseen(word)
                self.index[word] = self.used
                self.used += 1
                self.characters += len(word)
            at = list(map(self.index.__getitem__, words))
        return self.rows[at].sum(axis=0)

    def predict(self, text: str | None) -> tuple[str, float]:
        total, any_word = np.zeros(len(self.model.languages)), False
        words: list[str] = []
        for match in _RUNS.finditer((text or "").lower()):
            word = match.group()
            words += [word] if word.isalpha() else "".join(c if c.isalpha() else " " for c in word).split()
            if len(words) >= PART:
                total, any_word, words = total + self.add(words), True, []
        if words:
            total, any_word = total + self.add(words), True
        if not any_word or not self.model.languages:
            return UNDETERMINED, 0.0
        best = int(total.argmax())
        return self.model.languages[best], float(1 / np.exp(total - total[best]).sum())

    def keeps(self, text: str | None) -> bool:
        if not self.model.languages:
            return any(map(str.isalpha, text or ""))
        return self.predict(text)[0] != UNDETERMINED


_RUNS = re.compile(r"[^\W\d_]+")  # letters and, to be split off, numbers that are no decimal digits
_SCORERS: dict[str, Scorer] = {}  # of this Python worker: one, for the model used last


def identify(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, lang_pred, score per row of ``docs``."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    name = uuid.uuid4().hex
    kind = docs.schema[key].dataType.simpleString()
    return map_columns(
        docs.select(key, text),
        partial(_identify_batches, name, shared),
        f"`{key}` {kind}, lang_pred string, score double",
    )


def _scorer(name: str, shared: Broadcast) -> Scorer:
    if name not in _SCORERS:
        _SCORERS.clear()
        _SCORERS[name] = Scorer(shared.value)
    return _SCORERS[name]


def _identify_batches(name: str, shared: Broadcast, batches: Iterator[list]) -> Iterator[list]:
    scorer = _scorer(name, shared)
    for keys, texts in batches:
        found = [scorer.predict(t.as_py()) for t in texts]
        yield [keys, [f[0] for f in found], [f[1] for f in found]]


def held_out(key: str = "doc_id"):
    """Whether a row is kept out of training: crc32 of its id as text, modulo 5, is 0."""
    return F.coalesce(F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def keep_identified(docs: DataFrame, labelled: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` without the rows whose text has no identifiable language (``und``), all columns as they are.

    Where no row is labelled nothing can be told apart: then only rows whose text has no letter go.
    Nothing is joined: rows are predicted and dropped where they are read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(train(labelled, text=text, key=key))
    return docs.mapInArrow(partial(_keep_batches, uuid.uuid4().hex, shared, text), docs.schema)


def _keep_batches(name: str, shared: Broadcast, text: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    scorer = _scorer(name, shared)
    for batch in batches:
        keep = [scorer.keeps(t.as_py()) for t in batch.column(text)]
        yield batch.filter(pa.array(keep, pa.bool_()))
