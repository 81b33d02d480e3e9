"""Quality by hierarchical empirical Bayes: a document's own evidence, and what its site is like.

A logistic model on binned surface features gives each document a probability of being good. Paths
and hosts sum these probabilities. The spread between hosts, beyond what chance explains, says how
many documents a host needs before its own mean counts more than the global one; the spread of
paths within hosts says the same of paths. A path's posterior leaves out the document it is used for,
so nothing is counted twice, and a path of one document is its host's posterior. The log-odds of
document and path are added.

A fit reads at most ``SAMPLE_ROWS`` labelled rows; all sums cover all documents, by grouped
aggregates that combine before the shuffle. The driver sees a handful of totals.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factorspark.llm.batches import small_batches
from factorspark.llm.learning import fit_logistic, in_order, labelled_sample, logit, remainder, sigmoid
from factorspark.sources.staging import stage

SAMPLE_ROWS = 30_000
MODULUS = 5
BINS = 10
THRESHOLD = 0.5
MOST_SHRINKAGE = 1e9
UPPER = bytes(range(65, 91))
LETTERS = UPPER + bytes(range(97, 123))
HIGH = bytes(range(128, 256))
NOISE = b"*#$%&@^~_+=<>{}[]\\"


def features(text: str) -> list[float]:
    """Surface features; an empty text has all zero."""
    raw = text.encode(errors="replace")
    words = text.split()
    n, size = max(1, len(words)), max(1, len(raw))
    counts = Counter(words)
    letters = len(raw) - len(raw.translate(None, LETTERS))
    lines = [line for line in text.split("\n") if line]
    upper = len(raw) - len(raw.translate(None, UPPER))
    return [
        float(np.log1p(len(words))),
        sum(map(len, words)) / n,
        len(counts) / n**0.8,
        max(counts.values(), default=0) / n,
        sum(map(eq, words, words[1:])) / n,
        upper / max(1, letters),
        letters / size,
        raw.count(b"!") / n,
        raw.count(b"|") / n,
        (len(raw) - len(raw.translate(None, NOISE))) / n,
        (len(raw) - len(raw.translate(None, b"0123456789"))) / size,
        (raw.count(b".") + raw.count(b"?")) / n,
        raw.count(b",") / n,
        len(lines) / n,
        (len(lines) - len(set(lines))) / max(1, len(lines)),
        (len(raw) - len(raw.translate(None, HIGH))) / size,
    ]


@dataclass
class Model:
    cuts: list[np.ndarray]
    weights: np.ndarray | None
    prior: float

    def design(self, x: np.ndarray) -> np.ndarray:
        """One column per feature and bin."""
        columns = []
        for cut, values in zip(self.cuts, x.T):
            columns.append(np.eye(len(cut) + 1)[np.searchsorted(cut, values, side="right")])
        return np.concatenate(columns, axis=1)

    def probability(self, texts: list[str]) -> np.ndarray:
        if self.weights is None or not texts:
            return np.full(len(texts), self.prior)
        x = self.design(np.array([features(text) for text in texts], np.float64))
        return sigmoid(x @ self.weights[:-1] + self.weights[-1])


def fit(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """A model from at most ``rows`` labelled documents whose CRC-32 remainder is not 0.

    With no labelled document every text is good, with a single class it is that class.
    """
    sample = labelled_sample(small_batches(docs), labels, "quality", MODULUS, rows)

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = pa.array([features(text) for text in batch.column(0).to_pylist()], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([values, batch.column(1)], ["x", "y"])

    table = sample.select("text", "label").mapInArrow(measured, "x array<double>, y int").toArrow()
    _, x, y = in_order(table["x"].to_pylist(), table["y"].to_numpy())
    if len(y) == 0 or y.min() == y.max():
        return Model([], None, float(y[0]) if len(y) else 1.0)
    at = np.linspace(0, 1, BINS + 1)[1:-1]
    cuts = [np.unique(np.r_[np.quantile(c, at), np.quantile(np.unique(c), at)]) for c in x.T]
    model = Model(cuts, None, float(y.mean()))
    model.weights = fit_logistic(model.design(x), y)
    return model


def probability(text: str | Column, model: Model) -> Column:
    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(model.probability([x or "" for x in texts]))

    return scored(text)


def _shrinkage(variance: float, spread: float, groups: int, rows: int) -> float:
    """How many rows the prior is worth: within variance over the variance between groups, which is
    their spread less what ``groups`` means of ``rows`` rows would show by chance."""
    between = spread - variance * groups / rows
    return min(MOST_SHRINKAGE, variance / between) if between > variance / MOST_SHRINKAGE else MOST_SHRINKAGE


def _log_odds(p: Column) -> Column:
    bounded = F.least(F.greatest(p, F.lit(1e-6)), F.lit(1 - 1e-6))
    return F.log(bounded / (1 - bounded))


def judged(docs: DataFrame, model: Model, host: Column, path: Column, keep: Sequence[str]) -> DataFrame:
    """The columns ``keep`` of every row of ``docs(text, ..)`` as struct ``row``, and its score.

    Adds ``evidence`` (log-odds of the document alone), ``host_posterior``, ``path_posterior`` and
    ``score``. Null hosts and paths are groups of their own.
    """
    marked = stage(
        docs.select(
            F.struct(*[F.col(f"`{name}`") for name in keep]).alias("row"),
            host.alias("host"),
            path.alias("path"),
            probability("text", model).alias("p"),
        ),
        "evidence",
    )
    paths = stage(
        marked.groupBy("host", "path").agg(
            F.sum("p").alias("good"), F.count("*").alias("n"), F.sum(F.col("p") * F.col("p")).alias("squares")
        ),
        "paths",
    )
    all_ = paths.agg(F.sum("good").alias("good"), F.sum("n").alias("n"), F.sum("squares").alias("squares")).first()
    rows = all_["n"] or 1
    mean = (all_["good"] or 0.0) / rows
    variance = max((all_["squares"] or 0.0) / rows - mean**2, 1e-9)

    hosts = paths.groupBy("host").agg(F.sum("good").alias("good"), F.sum("n").alias("n"))
    away = F.col("good") / F.col("n") - F.lit(mean)
    spread = hosts.agg(F.sum(F.col("n") * away * away).alias("v"), F.count("*").alias("k")).first()
    strength = _shrinkage(variance, (spread["v"] or 0.0) / rows, spread["k"], rows)
    posterior = (F.col("good") + F.lit(strength * mean)) / (F.col("n") + F.lit(strength))
    hosts = hosts.select(F.col("host").alias("of"), posterior.alias("host_posterior"))

    sites = stage(paths.join(hosts, F.col("host").eqNullSafe(F.col("of"))).drop("of", "squares"), "sites")
    away = F.col("good") / F.col("n") - F.col("host_posterior")
    spread = sites.agg(F.sum(F.col("n") * away * away).alias("v"), F.count("*").alias("k")).first()
    strength = _shrinkage(variance, (spread["v"] or 0.0) / rows, spread["k"], rows)

    sites = sites.withColumnsRenamed({"host": "of_host", "path": "of_path"})
    here = F.col("host").eqNullSafe(F.col("of_host")) & F.col("path").eqNullSafe(F.col("of_path"))
    others = (F.col("good") - F.col("p") + strength * F.col("host_posterior")) / (F.col("n") - 1 + F.lit(strength))
    total = F.col("evidence") + _log_odds(F.col("path_posterior")) - F.lit(float(logit(mean)))
    return (
        marked.join(sites, here)
        .select("row", _log_odds(F.col("p")).alias("evidence"), "host_posterior", others.alias("path_posterior"))
        .withColumn("score", 1 / (1 + F.exp(-total)))
    )


def site_of() -> tuple[Column, Column]:
    """Host and path of a document: its source, and the language section of that source."""
    return F.col("source"), F.col("lang")


def scores(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> DataFrame:
    """``docs(doc_id, text, source, lang)`` to ``(doc_id, held_out, evidence, host_posterior,
    path_posterior, score, predicted)``, one row per row; predicted 1 means good.

    ``held_out`` rows (remainder 0) are never learned from. Null texts are judged as empty ones; null
    sources and languages are sites of their own; repeated rows and null doc_ids (held_out is null)
    stay; an empty table gives an empty result; other columns are ignored.
    """
    model = fit(docs, labels, rows)
    return judged(docs, model, *site_of(), keep=["doc_id"]).select(
        F.col("row.doc_id").alias("doc_id"),
        (remainder("row.doc_id", MODULUS) == 0).alias("held_out"),
        "evidence",
        "host_posterior",
        "path_posterior",
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
