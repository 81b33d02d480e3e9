"""Small learners in numpy, and the bounded sample of labelled rows they are fitted on."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factorspark.sources.staging import stage_counted


def remainder(doc_id: str, modulus: int) -> Column:
    """CRC-32 of the id as text, modulo ``modulus``; null for a null id."""
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(modulus)).cast("int")


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, modulus: int, rows: int) -> DataFrame:
    """``(doc_id, text, label, fold)`` of at most ``rows`` labelled documents with a remainder other than 0.

    The ids are those with the smallest hashes, so the sample is the same in every run. Null labels
    are left out, and an id labelled twice counts as the larger label. Rows with the same id and text
    are one document. ``fold`` (0 to 2) depends on the text, so copies share a fold. ``rows`` bounds
    the broadcast table of ids and, where ids have several texts, the sample itself.
    """
    ids = (
        labels.filter(F.col(label).isNotNull() & (remainder("doc_id", modulus) != 0))
        .groupBy("doc_id")
        .agg(F.max(label).cast("int").alias("label"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    fold = F.pmod(F.xxhash64("text"), F.lit(3)).cast("int").alias("fold")
    found, n = stage_counted(texts.join(F.broadcast(ids), "doc_id").select("doc_id", "text", "label").distinct(), "labelled")
    if n > rows:
        keyed = found.withColumn("text_hash", F.xxhash64("text"))
        first = keyed.select("doc_id", "text_hash").orderBy(F.xxhash64("doc_id"), "doc_id", "text_hash").limit(rows)
        found = keyed.join(F.broadcast(first), ["doc_id", "text_hash"], "left_semi")
    return found.select("doc_id", "text", "label", fold)


def in_order(values: list, labels: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows, features, labels) of a sample in an order of its own, whatever order it arrived in, so
    that sums over it are the same in every run."""
    width = len(values[0]) if values else 0
    x, y = np.array(values, np.float64).reshape(len(labels), width), labels.astype(np.float64)
    rows = np.lexsort((*x.T, y))
    return rows, x[rows], y[rows]


@dataclass
class Trees:
    """Boosted complete trees: per tree the features and thresholds of its inner nodes, level by
    level, and the values of its leaves."""

    start: float
    features: np.ndarray
    thresholds: np.ndarray
    leaves: np.ndarray

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.start)
        row = np.arange(len(x))
        for feature, threshold, leaf in zip(self.features, self.thresholds, self.leaves):
            node = np.zeros(len(x), np.int64)
            while node.min(initial=len(feature)) < len(feature):
                node = 2 * node + 1 + (x[row, feature[node]] >= threshold[node])
            out += leaf[node - len(feature)]
        return out


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def logit(p):
    p = np.clip(p, 1e-6, 1 - 1e-6)
    return np.log(p / (1 - p))


def fit_trees(
    x: np.ndarray, y: np.ndarray, rounds: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 32, ridge: float = 2.0
) -> Trees:
    """Gradient-boosted trees for logistic loss, on histograms of ``bins`` cuts per feature."""
    n, width = x.shape
    at = np.linspace(0, 1, bins // 2 + 1)[1:-1]
    # cuts by rows and by distinct values: a feature that is mostly zero still gets cuts above zero
    cuts = [np.unique(np.r_[np.quantile(c, at), np.quantile(np.unique(c), at)]) for c in x.T]
    size = max(len(c) for c in cuts) + 1
    binned = np.stack([np.searchsorted(c, col, side="right") for c, col in zip(cuts, x.T)])
    start = float(logit(y.mean()))
    margin = np.full(n, start)
    trees = ([], [], [])
    for _ in range(rounds):
        p = sigmoid(margin)
        gradient, curvature = p - y, p * (1 - p)
        node = np.zeros(n, np.int64)
        feature, threshold = [], []
        for level in range(depth):
            nodes = 1 << level
            best = np.full(nodes, 1e-6)
            chosen = np.zeros(nodes, np.int64)
            cut = np.full(nodes, size)
            for j in range(width):
                if not len(cuts[j]):
                    continue
                cell = node * size + binned[j]
                g = np.bincount(cell, gradient, nodes * size).reshape(nodes, size).cumsum(axis=1)
                h = np.bincount(cell, curvature, nodes * size).reshape(nodes, size).cumsum(axis=1)
                total_g, total_h = g[:, -1:], h[:, -1:]
                gain = g**2 / (h + ridge) + (total_g - g) ** 2 / (total_h - h + ridge) - total_g**2 / (total_h + ridge)
                gain[(h < 1) | (total_h - h < 1)] = 0
                gain = gain[:, : len(cuts[j])]
                k = gain.argmax(axis=1)
                found = gain[np.arange(nodes), k]
                better = found > best
                best[better], chosen[better], cut[better] = found[better], j, k[better]
            feature += chosen.tolist()
            threshold += [float(cuts[j][k]) if k < size else np.inf for j, k in zip(chosen, cut)]
            node = 2 * node + (binned[chosen[node], np.arange(n)] > cut[node])
        g = np.bincount(node, gradient, 1 << depth)
        h = np.bincount(node, curvature, 1 << depth)
        leaf = -rate * g / (h + ridge)
        margin += leaf[node]
        for kept, value in zip(trees, (feature, threshold, leaf)):
            kept.append(value)
    return Trees(start, np.array(trees[0]), np.array(trees[1]), np.array(trees[2]))


def fit_isotonic(score: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pool adjacent violators: increasing (score, probability) knots for interpolation."""
    order = np.argsort(score, kind="stable")
    pools: list[list[float]] = []  # sum of y, rows, lowest and highest score
    for s, label in zip(score[order].tolist(), y[order].tolist()):
        if pools and pools[-1][3] == s:
            pools[-1][0] += label
            pools[-1][1] += 1
        else:
            pools.append([label, 1, s, s])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            total, rows, _, high = pools.pop()
            pools[-1][0] += total
            pools[-1][1] += rows
            pools[-1][3] = high
    knots = [(edge, p[0] / p[1]) for p in pools for edge in dict.fromkeys(p[2:])]
    return np.array([k[0] for k in knots]), np.array([k[1] for k in knots])


def fit_logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 12) -> np.ndarray:
    """Weights (the last one is the constant) by Newton steps with a ridge on all but the constant."""
    x = np.c_[x, np.ones(len(x))]
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    weights = np.zeros(x.shape[1])
    weights[-1] = logit(y.mean())
    for _ in range(steps):
        p = sigmoid(x @ weights)
        gradient = x.T @ (p - y) + penalty * weights
        curvature = (x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curvature, gradient)
        weights -= step
        if np.abs(step).max() < 1e-6:
            break
    return weights
