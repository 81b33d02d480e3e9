"""Language identification with a byte convolutional network.

A text is cut into windows of ``WINDOW`` bytes, all of it. Bytes are embedded; filters of several
widths run over each window; each filter keeps its maximum, and a softmax layer turns the maxima
into probabilities. A document's probabilities are the mean of its windows', weighted by their bytes.

The network is trained in numpy on a bounded sample: about ``PER_LANGUAGE`` documents of each
language and ``MAX_WINDOWS`` windows, dealt evenly to the languages, but at least ``MIN_WINDOWS`` of each
that has them. Where it is applied, embedding and filter are folded
into one table per pair of bytes, so that a window costs a few look-ups per byte instead of the
multiplications.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from factorspark.llm.batches import small_batches
from factorspark.llm.learning import remainder

WINDOW = 256
WIDTHS = (2, 3, 4)
FILTERS = 16
EMBEDDING = 8
PER_LANGUAGE = 1_000
MAX_WINDOWS = 12_000
MIN_WINDOWS = 100
MAX_LANGUAGES = 1_000
EPOCHS = 3
BATCH = 64
STEP = 0.004
CHUNK = 1024
MODULUS = 4
HELD_OUT = 2
UNKNOWN = "und"


def windows(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(windows, owner, bytes used) of all texts; the last window of a text is padded with zeros."""
    counts = [-(-len(text) // WINDOW) for text in texts]
    padded = b"".join(text.ljust(n * WINDOW, b"\0") for text, n in zip(texts, counts))
    owner = np.repeat(np.arange(len(texts)), counts)
    used = np.full(len(owner), WINDOW)
    last = np.cumsum(counts) - 1
    for k, (text, n) in enumerate(zip(texts, counts)):
        if n:
            used[last[k]] = len(text) - (n - 1) * WINDOW
    return np.frombuffer(padded, np.uint8).reshape(-1, WINDOW), owner, used


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray  # 256 x EMBEDDING; byte 0 is padding and stays zero
    filters: list[np.ndarray]  # per width: width x EMBEDDING x FILTERS
    biases: list[np.ndarray]
    output: np.ndarray
    constant: np.ndarray

    def tables(self) -> list[list[np.ndarray]]:
        """Per width its look-up tables: one per pair of bytes, and one per byte for an odd width."""
        found = []
        for kernel, bias in zip(self.filters, self.biases):
            single = [self.embedding @ kernel[k] for k in range(len(kernel))]
            pairs = [
                (single[k][:, None, :] + single[k + 1][None, :, :]).reshape(-1, FILTERS).astype(np.float32)
                for k in range(0, len(kernel) - 1, 2)
            ]
            pairs[0] += bias.astype(np.float32)
            found.append(pairs + [single[-1].astype(np.float32)] * (len(kernel) % 2))
        return found

    def probabilities(self, data: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
        """Softmax of each window, in chunks, one position of all windows of a chunk at a time."""
        out = np.empty((len(data), len(self.languages)), np.float32)
        for first in range(0, len(data), CHUNK):
            chunk = np.ascontiguousarray(data[first : first + CHUNK].T)
            pairs = chunk[:-1].astype(np.int64) << 8 | chunk[1:]
            singles = chunk.astype(np.int64)
            maxima = []
            part = np.empty((chunk.shape[1], FILTERS), np.float32)
            value = np.empty_like(part)
            for width, own in zip(WIDTHS, tables):
                best = np.zeros_like(part)
                for at in range(WINDOW - width + 1):
                    np.take(own[0], pairs[at], axis=0, out=value)
                    for k, table in enumerate(own[1:], start=1):
                        source = pairs if 2 * k + 1 < width else singles
                        np.take(table, source[at + 2 * k], axis=0, out=part)
                        np.add(value, part, out=value)
                    np.maximum(best, value, out=best)  # starts at 0: the rectifier
                maxima.append(best)
            z = np.concatenate(maxima, axis=1) @ self.output + self.constant
            z = np.exp(z - z.max(axis=1, keepdims=True))
            out[first : first + CHUNK] = z / z.sum(axis=1, keepdims=True)
        return out


def train(data: np.ndarray, target: np.ndarray, languages: list[str], seed: int = 7) -> Network:
    """Adam on the cross-entropy of single windows."""
    random = np.random.default_rng(seed)
    embedding = random.normal(0, 0.5, (256, EMBEDDING))
    filters = [random.normal(0, (w * EMBEDDING) ** -0.5, (w, EMBEDDING, FILTERS)) for w in WIDTHS]
    biases = [np.zeros(FILTERS) for _ in WIDTHS]
    output = random.normal(0, 0.1, (FILTERS * len(WIDTHS), len(languages)))
    constant = np.zeros(len(languages))
    weights = [embedding, *filters, *biases, output, constant]
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    step = 0
    embedding[0] = 0
    for _ in range(EPOCHS):
        for rows in np.array_split(random.permutation(len(data)), max(1, len(data) // BATCH)):
            if not len(rows):
                continue
            x, y = data[rows], target[rows]
            vectors = embedding[x]
            hidden, where = [], []
            for kernel, bias in zip(filters, biases):
                width = len(kernel)
                z = sum(vectors[:, k : WINDOW - width + 1 + k] @ kernel[k] for k in range(width)) + bias
                best = z.argmax(axis=1)
                where.append(best)
                hidden.append(np.take_along_axis(z, best[:, None, :], axis=1)[:, 0])
            raw = np.concatenate(hidden, axis=1)
            active = np.maximum(raw, 0)
            z = active @ output + constant
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(y)), y] -= 1
            p /= len(y)
            back = (p @ output.T) * (raw > 0)
            d_embedding = np.zeros_like(embedding)
            d_filters = []
            for n, (kernel, best) in enumerate(zip(filters, where)):
                own = back[:, n * FILTERS : (n + 1) * FILTERS]
                d_kernel = np.zeros_like(kernel)
                for k in range(len(kernel)):
                    at = np.take_along_axis(x, best + k, axis=1)  # the bytes under the maxima
                    d_kernel[k] = np.einsum("nfe,nf->ef", embedding[at], own)
                    np.add.at(d_embedding, at, own[:, :, None] * kernel[k].T[None])
                d_filters.append(d_kernel)
            d_embedding[0] = 0
            d_biases = [back[:, n * FILTERS : (n + 1) * FILTERS].sum(axis=0) for n in range(len(WIDTHS))]
            gradients = [d_embedding, *d_filters, *d_biases, active.T @ p, p.sum(axis=0)]
            step += 1
            for w, g, m, v in zip(weights, gradients, first, second):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                w -= STEP * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return Network(languages, embedding, filters, biases, output, constant)


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Network | None:
    """A network from about ``per_language`` documents of each language, chosen by hash.

    Learns only from rows with a language, a text and a remainder other than ``HELD_OUT``; None if
    there are none. The most frequent ``MAX_LANGUAGES`` languages are learned.
    """
    usable = small_batches(docs).filter(
        F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.col("text") != "") & (remainder("doc_id", MODULUS) != HELD_OUT)
    )
    counts = usable.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MAX_LANGUAGES).collect()
    if not counts:
        return None
    quota = max(MIN_WINDOWS, MAX_WINDOWS // len(counts))
    # the shares are a small literal map, one entry per language
    share = F.element_at(
        F.create_map(*[F.lit(x) for row in counts for x in (row["lang"], min(1.0, per_language / row["count"]))]), F.col("lang")
    )
    hashed = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) / float(1 << 30)
    each = {row["lang"]: -(-quota // min(per_language, row["count"])) for row in counts}

    def drawn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Up to ``each`` windows of its language from anywhere in a text."""
        for batch in batches:
            langs, order, texts = (column.to_pylist() for column in batch.columns)
            out = []
            for lang, at, text in zip(langs, order, texts):
                data, _, _ = windows([text.encode()])
                picked = np.random.default_rng(at & 0xFFFFFFFF).permutation(len(data))[: each[lang]]
                out += [(lang, at, data[k].tobytes()) for k in picked]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["lang", "at", "data"])

    sample = usable.filter(hashed < share).select("lang", F.xxhash64("doc_id", "text").alias("at"), "text")
    place = F.row_number().over(Window.partitionBy("lang").orderBy("at", "data"))
    pooled = sample.mapInArrow(drawn, "lang string, at long, data binary").withColumn("place", place)
    rows = pooled.filter(F.col("place") <= quota).orderBy("at", "lang", "data").collect()
    languages = [row["lang"] for row in counts]
    number = {name: k for k, name in enumerate(languages)}
    data = np.frombuffer(b"".join(row["data"] for row in rows), np.uint8).reshape(-1, WINDOW)
    return train(data, np.array([number[row["lang"]] for row in rows], np.int64), languages)


def predictions(docs: DataFrame, network: Network | None) -> DataFrame:
    """``docs(doc_id, text)`` to ``(doc_id, lang_pred, score)``: the language and its probability.

    ``und`` with score 0 for a null text and for one without letters, or if nothing was learned.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = network.tables() if network else []
        for batch in batches:
            texts = batch.column(1).to_pylist()
            known = [network is not None and text is not None and any(map(str.isalpha, text)) for text in texts]
            data, owner, used = windows([text.encode() if ok else b"" for text, ok in zip(texts, known)])
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            if len(data):
                p = network.probabilities(data, tables) * used[:, None]
                starts = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
                total = np.add.reduceat(p, starts, axis=0) / np.add.reduceat(used, starts)[:, None]
                for k, probability in zip(owner[starts].tolist(), total):
                    best = int(probability.argmax())
                    names[k], scores[k] = network.languages[best], min(1.0, float(probability[best]))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(names, pa.string()), pa.array(scores)], ["doc_id", "lang_pred", "score"]
            )

    return docs.select("doc_id", "text").mapInArrow(rows, "doc_id long, lang_pred string, score double")


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """``docs(doc_id, text, lang)`` to ``(doc_id, held_out, lang_pred, score)``, one row per row.

    ``held_out`` rows (remainder 2) are never learned from, and a prediction sees the text alone.
    Repeated rows and null doc_ids (held_out is null) stay; an empty table gives an empty result;
    other columns are ignored.
    """
    held_out = (remainder("doc_id", MODULUS) == HELD_OUT).alias("held_out")
    return predictions(docs, fit(docs, per_language)).select("doc_id", held_out, "lang_pred", "score")
