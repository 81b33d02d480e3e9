"""Toxicity: gradient-boosted trees over dense features of a text, with isotonic calibration.

The lexicon is a short fixed list and what the labelled sample adds: words and word beginnings that
are much more frequent in toxic documents. Features of a sample document use a lexicon learned
without its fold, so the trees see the hit rates that unseen documents will have; the calibration is
fitted on margins of trees that did not see the document either.

A fit reads at most ``SAMPLE_ROWS`` labelled rows. Scoring is one pass over the texts.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factorspark.llm.batches import small_batches
from factorspark.llm.learning import Trees, fit_isotonic, fit_trees, in_order, labelled_sample, remainder
from factorspark.sources.staging import stage

SAMPLE_ROWS = 30_000
LEXICON_KEYS = 20_000
MIN_TOXIC = 4
MIN_ODDS = 12.0
MODULUS = 5
THRESHOLD = 0.5
NEAR = 5
WINDOW = 20

# Insults and forms of address that need no labels.
INSULTS = frozenset(
    "idiot idiots moron morons stupid dumb loser losers pathetic worthless scum trash garbage clown "
    "disgusting imbecile fool ugly vermin hate dummkopf arschloch idiota imbécil estúpido connard crétin".split()
)
YOU = frozenset(
    "you your yours yourself youre du dich dir dein deine ihr euch tu te toi ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros".split()
)
WORD = re.compile(r"[^\W\d_]+")
# entered once per run of letters and without going back: linear in texts without a break
MASKED = re.compile(r"(?<![^\W\d_])[^\W\d_]++[0-9@$*!|]++[^\W\d_]++[^\s,.;:?]*+")
DRAWN_OUT = re.compile(r"([^\W\d_])\1\1")
UNMASK = str.maketrans("013457@$!|", "oieastasil")
UPPER = bytes(range(65, 91))
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

FEATURES = (
    "hits log_hits density weight_density densest distinct near_you insults insult_density you_density "
    "capitals punctuation exclamations symbols masked masked_hits drawn_out log_words digits"
).split()


@dataclass
class Lexicon:
    """Weights of whole words and of word beginnings of four and five letters."""

    words: dict[str, float]
    four: dict[str, float]
    five: dict[str, float]

    @staticmethod
    def of(weights: dict[str, float]) -> Lexicon:
        starts = {key[:-1]: w for key, w in weights.items() if key.endswith("*")}
        return Lexicon(
            {key: w for key, w in weights.items() if not key.endswith("*")},
            {key: w for key, w in starts.items() if len(key) == 4},
            {key: w for key, w in starts.items() if len(key) == 5},
        )

    def weight(self, word: str) -> float:
        return self.words.get(word) or self.five.get(word[:5]) or self.four.get(word[:4]) or 0.0


def lexicon_keys(text: str) -> set[str]:
    """The words of a text, and the beginnings (marked ``*``) of the longer ones."""
    words = {word for word in WORD.findall(text.lower()) if len(word) > 2}
    return words | {w[:4] + "*" for w in words if len(w) > 4} | {w[:5] + "*" for w in words if len(w) > 5}


def features(text: str, lexicon: Lexicon) -> list[float]:
    """The values of ``FEATURES``; all zero for an empty text."""
    lower = text.lower()
    words = WORD.findall(lower)
    n = max(1, len(words))
    known, four, five = lexicon.words, lexicon.four, lexicon.five
    hits = [i for i, w in enumerate(words) if w in known or w[:5] in five or w[:4] in four]
    densest = near = 0
    for k, i in enumerate(hits):
        first = k
        while first and hits[first - 1] > i - WINDOW:
            first -= 1
            if k - first >= WINDOW:
                break
        densest = max(densest, k - first + 1)
        near += any(w in YOU for w in words[max(0, i - NEAR) : i + NEAR + 1])
    insults = sum(map(INSULTS.__contains__, words))
    masked = MASKED.findall(lower)
    unmasked = [w.translate(UNMASK).replace("*", "") for w in masked]
    raw = text.encode(errors="replace")
    size = max(1, len(raw))
    symbols = len(raw) - len(raw.translate(None, PUNCTUATION))
    return [
        len(hits),
        np.log1p(len(hits)),
        len(hits) / n,
        sum(lexicon.weight(words[i]) for i in hits) / n,
        densest,
        len({words[i] for i in hits}),
        near,
        insults,
        insults / n,
        sum(map(YOU.__contains__, words)) / n,
        (len(raw) - len(raw.translate(None, UPPER))) / size,
        symbols / size,
        raw.count(b"!") / size,
        (symbols - raw.count(b".") - raw.count(b",")) / size,
        len(masked) / n,
        sum(w in INSULTS or lexicon.weight(w) > 0 for w in unmasked),
        len(DRAWN_OUT.findall(lower)) / n,
        np.log1p(len(words)),
        (len(raw) - len(raw.translate(None, b"0123456789"))) / size,
    ]


@dataclass
class Model:
    lexicon: Lexicon
    trees: Trees | None
    knots: tuple[np.ndarray, np.ndarray]
    prior: float

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.trees is None:
            return np.full(len(texts), self.prior)
        if not texts:
            return np.empty(0)
        margin = self.trees.margin(np.array([features(text, self.lexicon) for text in texts], np.float64))
        return np.clip(np.interp(margin, *self.knots), 0.0, 1.0)


def _lexicons(sample: DataFrame) -> list[dict[str, float]]:
    """Log-odds weights of keys: learned without fold 0, 1, 2, and on the whole sample."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [column.to_pylist() for column in batch.columns]
            keys = [(key, label, fold) for text, label, fold in zip(*columns) for key in lexicon_keys(text)]
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*keys)], ["key", "label", "fold"])

    counts = [
        F.count_if((F.col("label") == label) & (F.col("fold") == fold)).alias(f"n{label}{fold}")
        for label in (0, 1)
        for fold in range(3)
    ]
    rows_in = sample.agg(*counts).first()
    toxic = F.col("n10") + F.col("n11") + F.col("n12")
    found = (
        sample.select("text", "label", "fold")
        .mapInArrow(rows, "key string, label long, fold long")
        .groupBy("key")
        .agg(*counts)
        .filter(toxic >= MIN_TOXIC)
        .filter(toxic * 4 > F.col("n00") + F.col("n01") + F.col("n02"))
        .orderBy(F.desc(toxic), "key")
        .limit(LEXICON_KEYS)
        .collect()
    )
    lexicons = []
    for left_out in (0, 1, 2, None):
        folds = [fold for fold in range(3) if fold != left_out]
        total = [sum(rows_in[f"n{label}{fold}"] for fold in folds) for label in (0, 1)]
        weights = {}
        for row in found:
            clean, bad = (sum(row[f"n{label}{fold}"] for fold in folds) for label in (0, 1))
            odds = (bad + 0.5) / (total[1] + 1) / ((clean + 0.5) / (total[0] + 1))
            if bad >= MIN_TOXIC - (left_out is not None) and odds >= MIN_ODDS:
                weights[row["key"]] = float(np.log(odds))
        lexicons.append(weights)
    return lexicons


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """A model from at most ``rows`` labelled documents whose CRC-32 remainder is not 0.

    With no labelled document the score is 0, and with a single class its label, for every text.
    """
    sample = stage(labelled_sample(small_batches(docs), labels, "toxic", MODULUS, rows), "toxic-sample")
    seen = {row["label"] for row in sample.select("label").distinct().collect()}
    if len(seen) < 2:
        return Model(Lexicon.of({}), None, (np.zeros(1), np.zeros(1)), float(max(seen, default=0)))
    *without, whole = [Lexicon.of(weights) for weights in _lexicons(sample)]

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, labels_, folds = (column.to_pylist() for column in batch.columns)
            values = [features(text, without[fold]) for text, fold in zip(texts, folds)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(values, pa.list_(pa.float64())), pa.array(labels_, pa.int32()), pa.array(folds, pa.int32())],
                ["x", "y", "fold"],
            )

    measured = sample.select("text", "label", "fold").mapInArrow(rows_of, "x array<double>, y int, fold int")
    table = measured.toArrow()
    rows_, x, y = in_order(table["x"].to_pylist(), table["y"].to_numpy())
    fold = table["fold"].to_numpy()[rows_]
    margins = np.zeros(len(y))
    for k in range(3):
        own = fold == k
        if own.any() and 0 < y[~own].mean() < 1:
            margins[own] = fit_trees(x[~own], y[~own]).margin(x[own])
    return Model(whole, fit_trees(x, y), fit_isotonic(margins, y), float(y.mean()))


def score(text: str | Column, model: Model) -> Column:
    """Probability that the text is toxic; a null text counts as empty."""

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.scores([x or "" for x in texts]))

    return scored(text)


def scores(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs(doc_id, text)`` to ``(doc_id, held_out, score, predicted)``, one row per row.

    ``held_out`` rows (remainder 0) are never learned from. Null texts are scored as empty ones;
    repeated rows and null doc_ids (held_out is null) stay; an empty table gives an empty result;
    other columns of ``docs`` are ignored.
    """
    model = fit(docs, labels, rows)
    scored = docs.select("doc_id", (remainder("doc_id", MODULUS) == 0).alias("held_out"), score("text", model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def rejected(text: str | Column, model: Model) -> Column:
    """Whether a filter drops the text."""
    return score(text, model) >= THRESHOLD
