"""Texts without a break, signs that are no letters, rows that tie, and bins that share a gap."""

import random
import re
import time

import numpy as np
import pytest

from factorspark.llm import imatch, langid, packing, topk, toxicity


@pytest.mark.parametrize("text", ["x" * 10**6, "漢" * 10**6, "a1" * 500_000, "a" + "1" * 10**6, "1" * 10**6])
def test_features_of_unbroken_text_are_linear(text):
    began = time.process_time()
    toxicity.features(text, toxicity.Lexicon.of({"x": 1.0}))
    assert time.process_time() - began < 2


def test_masked_words_are_those_of_the_plain_pattern():
    plain = re.compile(r"[^\W\d_]+[0-9@$*!|]+[^\W\d_]+[^\s,.;:?]*")
    draw = random.Random(4)
    for _ in range(5000):
        text = "".join(draw.choices("ab1@*_ ,.é²漢", k=draw.randint(0, 16)))
        assert toxicity.MASKED.findall(text) == plain.findall(text), text


def test_texts_without_a_letter_have_no_language(spark):
    rows = [(k, f"the word and the other {k}", "en") for k in range(60)] + [(100, "½ ² ① Ⅷ 12 _ !", "en"), (101, "", "en"), (102, None, "en")]
    found = langid.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert {r.doc_id: r.lang_pred for r in found.collect() if r.doc_id >= 100} == dict.fromkeys((100, 101, 102), "und")


def test_likeness_follows_from_the_fingerprints(spark):
    draw = random.Random(2)
    words = [f"w{k}" for k in range(300)]
    rows = [(k, " ".join(draw.choices(words, k=40))) for k in range(150)]
    rows += [(200 + k, " ".join(f"rare{k}x{j}" for j in range(30)) + " w1 w2") for k in range(20)]  # few terms of the band
    found = imatch.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"), 0.02, 0.9).orderBy("doc_id").collect()
    kinds = {r.fingerprint.startswith("~") != r.edited_fingerprint.startswith("~") for r in found}
    assert kinds == {True, False} or {r.fingerprint[0] == "~" for r in found} == {True, False}
    prints = spark.createDataFrame(
        [(r.doc_id, r.fingerprint, r.edited_fingerprint, following.fingerprint) for r, following in zip(found, found[1:] + found[:1])],
        "doc_id long, own string, edited string, following string",
    )
    again = prints.select("doc_id", imatch.likeness(prints.own, prints.edited).alias("e"), imatch.likeness(prints.own, prints.following).alias("n"))
    assert {(r.doc_id, r.e, r.n) for r in again.collect()} == {(r.doc_id, r.near_edited, r.near_next) for r in found}


def test_ties_of_a_third_of_a_shard():
    draw = np.random.default_rng(7)
    points = draw.integers(-9, 9, (1500, 8))
    points[:600] = points[0]
    queries, own = points[::3], np.arange(1500)[::3]
    ties = draw.permutation(1500)
    asked, point, score = topk.search(points, np.arange(1500), ties, queries, own, np.full(len(own), topk.FLOOR), 20)
    scores = queries @ points.T
    for q in range(len(own)):
        rows = sorted((j for j in range(1500) if j != own[q]), key=lambda j: (-scores[q, j], ties[j]))[:20]
        assert sorted(point[asked == q].tolist()) == sorted(rows)
        assert sorted(score[asked == q].tolist()) == sorted(scores[q, rows].tolist())


def test_best_of_a_leaf():
    draw = np.random.default_rng(8)
    scores = draw.integers(0, 4, (200, 50))
    kept = topk._best_of_leaf(scores, 7)
    for row, mask in zip(scores, kept):
        assert np.flatnonzero(mask).tolist() == sorted(np.argsort(-row, kind="stable")[:7].tolist())


@pytest.mark.parametrize("low, high, n, most", [(250, 262, 2048, 4), (1, 1024, 4096, 16), (1, 12, 4096, 1)])
def test_sequences_over_the_bound(low, high, n, most):
    lengths = np.random.default_rng(3).integers(low, high, n)
    number, offset = packing.place(lengths, 1024)
    fills = np.bincount(number, lengths)
    assert fills.max() <= 1024 and number.max() + 1 <= -(-lengths.sum() // 1024) + most
    order = np.lexsort((offset, number))
    new = np.r_[True, number[order][1:] != number[order][:-1]]
    assert (offset[order][new] == 0).all()
    assert (offset[order][1:] == (offset + lengths)[order][:-1])[~new[1:]].all()


def test_many_equal_bins_are_quick():
    began = time.process_time()
    number, _ = packing.place(np.full(8192, 520), 1024)
    assert len(set(number.tolist())) == 8192 and time.process_time() - began < 5


def test_small_bins_against_all_packings():
    """With few pieces the result is never above first fit, and often the least there is."""

    def fewest(lengths, capacity):
        best = len(lengths)

        def put(k, bins):
            nonlocal best
            if len(bins) >= best:
                return
            if k == len(lengths):
                best = len(bins)
                return
            for j in {b: j for j, b in enumerate(bins)}.values():
                if bins[j] + lengths[k] <= capacity:
                    put(k + 1, bins[:j] + [bins[j] + lengths[k]] + bins[j + 1 :])
            put(k + 1, [*bins, lengths[k]])

        put(0, [])
        return best

    draw, exact = random.Random(1), 0
    for _ in range(60):
        lengths = [draw.randint(1, 19) for _ in range(9)]
        used = packing.place(np.array(lengths), 20)[0].max() + 1
        least = fewest(sorted(lengths, reverse=True), 20)
        assert least <= used <= least + 1
        exact += used == least
    assert exact >= 55
