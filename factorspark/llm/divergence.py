"""Divergence of the sources of a language, over the terms that its documents share.

Terms are counted by a pointer sort. A slice of texts is one byte buffer, as Arrow holds it; a pointer
marks each start of a word. The pointers are sorted by multikey quicksort with characters of eight
bytes: those equal so far, a run, are sorted by their next eight bytes, until the words end. An equal
run is a term, and its pointers say in which documents and sources it occurs. Document frequencies
add up over slices, as no document is split.

A term that does not occur in a source has the same probability as any other such term, so only
occurrences are stored. Two sources are compared over blocks of terms: a matrix of a slice of the
sources against all sources of the language, filled with that probability where a term is missing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factorspark.llm.batches import small_batches
from factorspark.sources.staging import stage

SLICE_BYTES = 8 << 20
# occurrences (source, term) in a block of terms: a block gives one row per two sources, so it has about
# as many, within these bounds
BLOCK_ENTRIES = (1 << 15, 1 << 20)
SOURCE_SLICE = 256
CELLS = 1 << 21  # of a matrix in memory
UNIT = 1_000_000_000
SMOOTHING = 5
SORTED_BYTES = 64  # what is still equal after these is compared as whole words

_COUNTED = "lang string, source string, term string, n long, df long"

# Bytes of a term, [^\x00-\x40\x5B-\x60\x7B-\x7F] in UTF-8, and their lower case.
IN_TERM = np.array([65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)])
LOWER = np.array([b + 32 if 65 <= b <= 90 else b for b in range(256)], np.uint8)
# which bytes of a character of eight a word with so many bytes left fills
_FILLED = np.array([(1 << 64) - (1 << (64 - 8 * k)) for k in range(9)], np.uint64)


def word_starts(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of every word of the texts that lie end to end in ``data``, cut at ``bounds``."""
    inside = IN_TERM[data]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    # words do not reach over the bounds of texts
    cut = bounds[(bounds > 0) & (bounds < len(data))]
    first[cut] = inside[cut]
    last[cut - 1] = inside[cut - 1]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def sorted_runs(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pointers in the order of their words, and the number of the run of equal words each is in."""
    size = end - start
    padded = np.r_[data, np.zeros(8, np.uint8)]
    order = np.arange(len(start))
    opens = np.zeros(len(start), bool)  # whether a run begins here
    opens[:1] = True
    places = np.arange(len(start))  # those whose words are not told apart yet
    for depth in range(0, SORTED_BYTES, 8):
        if not len(places):
            break
        at = order[places]
        left = np.clip(size[at] - depth, 0, 8)
        where = np.minimum(start[at] + depth, len(data))
        signs = np.lib.stride_tricks.sliding_window_view(padded, 8)[where].view(">u8").ravel()
        key = signs.astype(np.uint64) & _FILLED[left]
        run = np.cumsum(opens)[places]
        # the first pass has one run; later ones sort within the runs, which are slices
        by = np.argsort(key) if depth == 0 else np.lexsort((key, run))
        at, key = at[by], key[by]
        order[places] = at
        opens[places[1:]] |= (key[1:] != key[:-1]) | (run[1:] != run[:-1])
        # a word that fills this character goes on, with the others of its run
        goes_on = (key & np.uint64(255)) != 0
        number = np.cumsum(opens)
        alone = np.bincount(number) == 1
        places = places[goes_on & ~alone[number[places]]]
    if len(places):
        number = np.cumsum(opens)
        for slice_ in np.split(places, np.flatnonzero(np.diff(number[places])) + 1):
            words = sorted((data[start[k] : end[k]].tobytes(), k) for k in order[slice_].tolist())
            order[slice_] = [k for _, k in words]
            opens[slice_[1:]] |= np.array([x[0] != y[0] for x, y in zip(words, words[1:])], bool)
    return order, np.cumsum(opens) - 1


def count_terms(data: np.ndarray, bounds: np.ndarray, group: np.ndarray) -> tuple[list[bytes], np.ndarray]:
    """Terms of the texts between ``bounds``, in byte order, and rows ``(term, group, n, df)`` of their
    counts and document frequencies in the ``group`` of each text."""
    data = LOWER[data]
    start, end = word_starts(data, bounds)
    order, run = sorted_runs(data, start, end)
    if not len(order):
        return [], np.zeros((0, 4), np.int64)
    head = order[np.r_[True, run[1:] != run[:-1]]]
    terms = [data[a:b].tobytes() for a, b in zip(start[head].tolist(), end[head].tolist())]
    # texts numbered by group, so that one sort brings the groups of a run and their texts together
    by_group = np.argsort(group, kind="stable")
    number = np.empty(len(group), np.int64)
    number[by_group] = np.arange(len(group))
    text = np.searchsorted(bounds, start[order], side="right") - 1
    code = np.sort(run * np.int64(len(group)) + number[text])
    first = np.flatnonzero(np.r_[True, code[1:] != code[:-1]])
    times = np.diff(np.r_[first, len(code)])
    run, text = np.divmod(code[first], len(group))
    of = group[by_group][text]
    first = np.flatnonzero(np.r_[True, (run[1:] != run[:-1]) | (of[1:] != of[:-1])])
    df = np.diff(np.r_[first, len(run)])
    return terms, np.stack([run[first], of[first], np.add.reduceat(times, first), df], axis=1)


def term_counts(docs: DataFrame) -> DataFrame:
    """``docs(text, lang, source)`` to ``(lang, source, term, n, df)``; a row with term null stands for
    the group itself, so that groups without terms are listed."""

    def counted(buffers: list[np.ndarray], langs: list[str], sources: list[str]) -> pa.RecordBatch:
        names = list(dict.fromkeys(zip(langs, sources)))
        at = {name: k for k, name in enumerate(names)}
        group = np.array([at[name] for name in zip(langs, sources)], np.int64)
        bounds = np.cumsum([0] + [len(b) for b in buffers])
        terms, rows = count_terms(np.concatenate(buffers), bounds, group)
        groups = len(names)
        number = pa.array(np.r_[rows[:, 1], np.arange(groups)])
        term = pa.array(np.r_[rows[:, 0], np.zeros(groups, np.int64)], mask=np.r_[np.zeros(len(rows), bool), np.ones(groups, bool)])
        columns = [pa.array([name[k] for name in names], pa.string()).take(number) for k in (0, 1)]
        columns.append(pa.array(terms, pa.binary()).cast(pa.string()).take(term))
        zero = np.zeros(groups, np.int64)
        columns += [pa.array(np.r_[rows[:, k], zero]) for k in (2, 3)]
        return pa.RecordBatch.from_arrays(columns, [column.split()[0] for column in _COUNTED.split(", ")])

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        buffers, langs, sources, size = [], [], [], 0
        for batch in batches:
            text = batch.column(0).cast(pa.large_binary())
            _, offsets, data = text.buffers()
            ends = np.frombuffer(offsets, np.int64)[text.offset : text.offset + len(text) + 1]
            bytes_ = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
            names = [batch.column(k).to_pylist() for k in (1, 2)]
            for a, b, lang, source in zip(ends.tolist(), ends[1:].tolist(), *names):
                buffers.append(bytes_[a:b])
                langs.append(lang)
                sources.append(source)
                size += b - a
                if size >= SLICE_BYTES:
                    yield counted(buffers, langs, sources)
                    buffers, langs, sources, size = [], [], [], 0
        if buffers:
            yield counted(buffers, langs, sources)

    read = [F.coalesce(F.col(name), F.lit("")).alias(name) for name in ("text", "lang", "source")]
    counted_rows = small_batches(docs).select(*read).mapInArrow(rows, _COUNTED)
    return counted_rows.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def scaled_probability(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(UNIT * (count + SMOOTHING) / (total + SMOOTHING * terms)), in whole numbers of any size;
    null without terms."""
    above = (count + SMOOTHING).cast("decimal(25,0)") * F.lit(UNIT).cast("decimal(10,0)")
    below = F.nullif((total + terms * SMOOTHING).cast("decimal(25,0)"), F.lit(0).cast("decimal(25,0)"))
    return (F.call_function("div", above, below) + 1).cast("long")


def _compared(groups: DataFrame, entries: DataFrame, blocks: int, slices: int) -> DataFrame:
    """``(lang, source, item, value)``: the summed differences of every two sources of a language.

    ``groups(lang, source, p0)`` and ``entries(lang, source, term, p)``, where ``p0`` is the value of a
    term that the source does not have. A task takes a block of the terms of a language and a slice of its
    sources, and compares the slice with all sources."""
    block = F.pmod(F.xxhash64("term"), F.lit(blocks)).cast("int")
    every_block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    every_slice = F.explode(F.sequence(F.lit(0), F.lit(slices - 1)))
    absent = groups.select("lang", "source", F.lit(None).cast("string").alias("term"), F.col("p0").alias("p"))
    rows = absent.withColumn("block", every_block).unionByName(entries.withColumn("block", block))

    def compare(key: tuple, table: pd.DataFrame) -> pd.DataFrame:
        lang, _, slice_ = key
        is_source = table["term"].isna()
        sources = table[is_source].sort_values("source")
        names = sources["source"].to_numpy()
        p0 = sources["p"].fillna(0).to_numpy(np.int64)
        found = table[~is_source]
        source = np.searchsorted(names, found["source"].to_numpy()) if len(found) else np.zeros(0, np.int64)
        term, _ = pd.factorize(found["term"])
        p = found["p"].to_numpy(np.int64)
        by_term = np.argsort(term, kind="stable")
        source, term, p = source[by_term], term[by_term], p[by_term]
        own = np.arange(slice_, len(names), slices)
        total = np.zeros((len(own), len(names)), np.int64)
        n_terms, step = int(term[-1]) + 1 if len(term) else 0, max(1, CELLS // max(1, len(names)))
        for first in range(0, n_terms, step):
            a, b = np.searchsorted(term, [first, first + step])
            matrix = np.repeat(p0[:, None], min(step, n_terms - first), axis=1)
            matrix[source[a:b], term[a:b] - first] = p[a:b]
            for k, row in enumerate(own.tolist()):
                total[k] += np.abs(matrix - matrix[row]).sum(axis=1)
        k, j = np.nonzero(own[:, None] != np.arange(len(names)))
        return pd.DataFrame({"lang": lang, "source": names[own[k]], "item": names[j], "value": total[k, j]})

    dealt = rows.withColumn("slice", every_slice).groupBy("lang", "block", "slice")
    parts = dealt.applyInPandas(compare, "lang string, source string, item string, value long")
    return parts.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, min_docs: int = 30, top: int = 50) -> DataFrame:
    """``docs(text, lang, source)`` to ``(lang, source, part, item, value, rank)``.

    A language keeps the terms that at least ``min_docs`` of its documents have. In a group (lang, source)
    and in the language as a whole a kept term has a smoothed, scaled probability p. Part ``pair`` ranks
    the other sources of the language by the summed differences of their p, part ``term`` the ``top``
    terms of the group whose p is above that of the language, by the difference. Ties go by item.

    Null texts, languages and sources are empty strings; repeated rows are documents of their own; a
    group without terms, or of a language without kept terms, is compared like others; an empty table gives
    an empty result; other columns are ignored. Texts are taken whole: memory grows with the longest one.
    """
    counts = stage(term_counts(docs), "term-counts")
    per_term = counts.filter("term IS NOT NULL").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("df").alias("df"))
    kept = stage(per_term.filter(F.col("df") >= min_docs).drop("df"), "kept-terms")
    entries = stage(
        counts.filter("term IS NOT NULL").join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"),
        "kept-counts",
    )
    langs = kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total"))
    totals = entries.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    listed = counts.filter("term IS NULL").select("lang", "source")
    none = {"v": 0, "lang_total": 0, "total": 0}
    groups = stage(
        listed.join(langs, "lang", "left").join(totals, ["lang", "source"], "left").fillna(none)
        .withColumn("p0", scaled_probability(F.lit(0).cast("long"), F.col("total"), F.col("v"))),
        "groups",
    )
    shape = groups.groupBy("lang").count().agg(F.max("count").alias("sources")).first()
    sources = shape["sources"] or 0
    blocks = max(1, -(-entries.count() // min(max(sources**2, BLOCK_ENTRIES[0]), BLOCK_ENTRIES[1])))
    slices = max(1, -(-sources // SOURCE_SLICE))

    # the table of groups has a row per source: its size decides how it is joined
    scored = entries.join(groups, ["lang", "source"]).select(
        "lang",
        "source",
        "term",
        scaled_probability(F.col("n"), F.col("total"), F.col("v")).alias("p"),
        scaled_probability(F.col("lang_n"), F.col("lang_total"), F.col("v")).alias("q"),
    )
    scored = stage(scored, "scored-terms")
    pairs = _compared(groups.select("lang", "source", "p0"), scored.drop("q"), blocks, slices)
    over = scored.filter(F.col("p") > F.col("q")).select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    return _ranked(pairs, "pair").unionByName(_ranked(over, "term").filter(F.col("rank") <= top))


def _ranked(rows: DataFrame, part: str, group: Sequence[str] = ("lang", "source")) -> DataFrame:
    """Rows numbered per group, highest value first, ties by item. A filter on the number reaches the
    tasks before the shuffle, so no group is gathered whole for a few ranks."""
    by = Window.partitionBy(*group).orderBy(F.col("value").desc(), "item")
    return rows.select(*group, F.lit(part).alias("part"), "item", "value", F.row_number().over(by).alias("rank"))
