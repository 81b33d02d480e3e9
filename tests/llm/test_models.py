"""Learned operators: held-out accuracy, their parts against plain computations, and odd input."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from factorspark.llm import langid, learning, quality, toxicity

DATA = "/root/testdata/sf0.01"
needs_data = pytest.mark.skipif(not os.path.isdir(DATA), reason="needs the test tables")


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{DATA}/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet(f"{DATA}/labels.parquet")


def messy_labels(spark):
    rows = [(k, k % 2, int(k % 5 == 0)) for k in range(100, 140)] + [(100, 1, 1), (None, 1, 1), (301, None, None), (9999, 0, 1)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


# learners


def test_trees_learn_an_interaction_and_margins_follow_the_leaves():
    random_ = np.random.default_rng(0)
    x = random_.normal(size=(4000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0.5)).astype(float)
    trees = learning.fit_trees(x[:3000], y[:3000])
    assert ((trees.margin(x[3000:]) > 0) == y[3000:]).mean() > 0.95
    row, total = x[3500], trees.start
    for features, thresholds, leaves in zip(trees.features, trees.thresholds, trees.leaves):
        node = 0
        while node < len(features):
            node = 2 * node + 1 + int(row[features[node]] >= thresholds[node])
        total += leaves[node - len(features)]
    assert trees.margin(x[3500:3501])[0] == pytest.approx(total)


def test_isotonic_is_increasing_and_keeps_the_mean():
    random_ = np.random.default_rng(1)
    score = np.round(random_.normal(size=2000), 2)
    y = (random_.random(2000) < learning.sigmoid(2 * score)).astype(float)
    at, value = learning.fit_isotonic(score, y)
    assert (np.diff(at) > 0).all() and (np.diff(value) >= 0).all()
    assert np.interp(score, at, value).mean() == pytest.approx(y.mean(), abs=0.01)


def test_logistic_finds_the_weights():
    random_ = np.random.default_rng(2)
    x = random_.normal(size=(20000, 2))
    y = (random_.random(20000) < learning.sigmoid(1.5 * x[:, 0] - 0.5 * x[:, 1] + 0.3)).astype(float)
    assert learning.fit_logistic(x, y) == pytest.approx([1.5, -0.5, 0.3], abs=0.08)


def test_sample_is_bounded_and_has_no_held_out_rows(messy, spark):
    labels = messy_labels(spark)
    assert learning.labelled_sample(messy, labels, "toxic", 5, 10).select("doc_id").distinct().count() <= 10
    got = learning.labelled_sample(messy, labels, "toxic", 5, 1000)
    assert got.filter(learning.remainder("doc_id", 5) == 0).count() == 0
    assert got.filter("doc_id = 301 or doc_id is null").count() == 0
    assert {r.label for r in got.filter("doc_id = 100").collect()} <= {1}  # labelled twice: the larger


# toxicity


@needs_data
def test_toxicity_on_held_out_rows(documents, labels):
    got = toxicity.scores(documents, labels).join(labels, "doc_id").filter("held_out").toPandas()
    assert got.score.between(0, 1).all()
    assert ((got.predicted == 1) & (got.toxic == 0)).mean() <= 0.02
    assert ((got.predicted == 1) & (got.toxic == 1)).sum() >= 0.6 * got.toxic.sum()


def test_toxicity_of_messy_rows(messy, messy_rows, spark):
    got = toxicity.scores(messy, messy_labels(spark)).toPandas()
    assert len(got) == len(messy_rows)
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.5)).all()
    assert got.held_out.isna().sum() == 2


def test_toxicity_without_labels_or_documents(messy, messy_rows, no_docs, no_labels):
    got = toxicity.scores(messy, no_labels).toPandas()
    assert len(got) == len(messy_rows) and (got.score == 0).all()
    assert toxicity.scores(no_docs, no_labels).count() == 0


def test_toxic_features():
    lexicon = toxicity.Lexicon.of({"zorg": 2.0, "blar*": 1.5, "quixo*": 1.0})
    names = dict(zip(toxicity.FEATURES, toxicity.features("You ZORG and blarfing, quixotry st4ab1e !!", lexicon)))
    assert names["hits"] == 3 and names["distinct"] == 3 and names["near_you"] == 3 and names["masked"] > 0
    assert not any(toxicity.features("", lexicon))


# quality


@needs_data
def test_quality_on_held_out_rows(documents, labels):
    got = quality.scores(documents, labels).join(labels, "doc_id").filter("held_out").toPandas()
    assert (got.predicted == got.quality).mean() >= 0.93
    assert ((got.predicted == 0) & (got.quality == 1)).sum() <= 0.03 * got.quality.sum()


def test_quality_of_messy_rows(messy, messy_rows, spark):
    got = quality.scores(messy, messy_labels(spark)).toPandas()
    assert len(got) == len(messy_rows) and got.score.between(0, 1).all()
    kept = quality.judged(messy, quality.Model([], None, 0.8), *quality.site_of(), keep=messy.columns)
    assert kept.select("row.*").columns == messy.columns


def test_quality_without_labels_or_documents(messy, no_docs, no_labels):
    assert quality.scores(messy, no_labels).filter("predicted = 0").count() == 0
    assert quality.scores(no_docs, no_labels).count() == 0


def test_sites_shrink_to_their_priors(spark, monkeypatch):
    # texts "g.." are good with 0.9, others with 0.1; host a is good, b is bad, c has one bad text
    class Plain:
        def probability(self, texts):
            return np.array([0.9 if text.startswith("g") else 0.1 for text in texts])

    rows = [(k, "g", "a", f"p{k % 2}") for k in range(200)] + [(500 + k, "b", "b", "p0") for k in range(200)]
    rows += [(900, "b", "c", "p9"), (901, "g", "a", "single"), (902, "b", None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string")
    got = quality.judged(docs, Plain(), *quality.site_of(), keep=["doc_id"]).select("row.doc_id", "*").toPandas().set_index("doc_id")
    assert len(got) == len(rows)
    assert got.host_posterior[0] > 0.85 and got.host_posterior[500] < 0.15
    # one document moves a host only part of the way from the mean
    assert 0.1 < got.host_posterior[900] < got.evidence.pipe(lambda e: (1 / (1 + np.exp(-e))).mean()) + 0.05
    # a path of one document has its host's posterior: its own evidence is left out
    assert got.path_posterior[901] == pytest.approx(got.host_posterior[901])
    assert got.score[900] > got.score[500]


# language


def plain_network(network, window):
    vectors = network.embedding[window]
    maxima = []
    for kernel, bias in zip(network.filters, network.biases):
        width = len(kernel)
        z = [sum(vectors[at + k] @ kernel[k] for k in range(width)) + bias for at in range(len(window) - width + 1)]
        maxima.append(np.maximum(np.max(z, axis=0), 0))
    z = np.concatenate(maxima) @ network.output + network.constant
    return np.exp(z) / np.exp(z).sum()


def test_tables_give_the_convolution():
    random_ = np.random.default_rng(0)
    data = random_.integers(0, 256, (40, langid.WINDOW)).astype(np.uint8)
    network = langid.train(data, random_.integers(0, 3, 40), ["a", "b", "c"])
    got = network.probabilities(data[:5], network.tables())
    for row, window in zip(got, data):
        assert row == pytest.approx(plain_network(network, window), abs=1e-4)


def test_windows_cover_all_bytes():
    texts = [b"", b"x" * 256, b"ab" * 300, b"\xc3\xa9"]
    data, owner, used = langid.windows(texts)
    assert [b"".join(data[k, : used[k]].tobytes() for k in np.flatnonzero(owner == n)) for n in range(4)] == texts


@needs_data
def test_language_on_held_out_rows(documents):
    found = langid.identify(documents)
    got = found.join(documents.select("doc_id", "lang"), "doc_id").filter("held_out").toPandas()
    assert (got.lang_pred == got.lang).mean() >= 0.97 and got.score.between(0, 1).all()


def test_language_of_messy_rows(messy, messy_rows):
    got = langid.identify(messy).toPandas()
    assert len(got) == len(messy_rows) and set(got.lang_pred) <= {"en", "de", "fr", "und"}
    und = {r.doc_id for r in messy.filter(F.col("text").isNull() | (F.trim("text") == "")).collect() if r.doc_id is not None}
    assert (got[got.doc_id.isin(und)].lang_pred == "und").all()


def test_language_without_anything_to_learn(no_docs, messy):
    assert langid.identify(no_docs).count() == 0
    nothing = langid.identify(messy.withColumn("lang", F.lit(None).cast("string"))).toPandas()
    assert set(nothing.lang_pred) == {"und"} and (nothing.score == 0).all()


def test_labelled_sample_is_bounded_by_documents(spark):
    rows = [(1, "copy")] * 300 + [(k, f"text {k}") for k in range(2, 40)] + [(5, f"other {k}") for k in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 40)], "doc_id long, toxic int")
    found = learning.labelled_sample(docs, labels, "toxic", 1_000_003, 1_000).collect()
    assert sorted((r.doc_id, r.text) for r in found) == sorted(set(rows))
    assert len(learning.labelled_sample(docs, labels, "toxic", 1_000_003, 30).collect()) == 30


def test_every_language_keeps_its_windows(spark, monkeypatch):
    monkeypatch.setattr(langid, "MAX_WINDOWS", 60)
    monkeypatch.setattr(langid, "MIN_WINDOWS", 10, raising=False)
    monkeypatch.setattr(langid, "train", lambda data, target, languages: np.bincount(target, minlength=len(languages)).tolist())
    rows = [(k, f"text {k} " * 60, f"l{k % 11}") for k in range(1_100)] + [(2_000 + k, f"rare {k} " * 300, "rare") for k in range(6)]
    counts = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"), per_language=50)
    assert counts == [10] * 12
