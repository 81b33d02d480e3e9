import random

import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# columns whose names the operators use themselves
CLASHING = ["row", "score", "size", "fp", "piece", "label", "block", "range", "place", "shard", "term", "at", "host", "p"]
ODD_TEXTS = [
    "",
    " \t\n",
    "one",
    "ünïcödé façade – “quoted” don't I'LL 12 3½ x²",
    "a\x00b \x1c\x1d c\x85d e  f",
    "ẹ́ Å İstanbul ΑΣ ﬁ",
    "漢字かな交じり文 한국어 עברית हिन्दी 😀👍🏽",
    "<|endoftext|> and <|startoftext|>inside<|endoftext|>",
    "  two   spaces\n\n\nlines \r\n\ttab ",
]


def prose(seed, words):
    random_ = random.Random(seed)
    syllables = "ka lo mi ren tus vel dor in an the of".split()
    out = ["".join(random_.choices(syllables, k=random_.randint(1, 3))) for _ in range(words)]
    return " ".join(word + random_.choice(["", "", "", ",", "."]) for word in out)


@pytest.fixture(scope="session")
def messy_rows():
    """Nulls in every column, empty, odd and very long texts, copies, near copies and repeated rows."""
    rows = [(k, text, "en", f"s{k % 3}", len(text)) for k, text in enumerate(ODD_TEXTS)]
    rows += [(100 + k, prose(k, 30 + 7 * k), ("en", "de", "fr")[k % 3], f"s{k % 4}", None) for k in range(40)]
    base = prose(1000, 400)
    rows += [(200 + k, base, "en", "s0", None) for k in range(12)]
    rows += [(300 + k, base + f" end{k}", "de", "s1", None) for k in range(12)]
    rows += [(400, prose(7, 30_000), "fr", None, None), (401, None, None, None, None), (None, None, "en", "s2", 3)]
    rows += [(None, prose(8, 50), None, "s3", None), (500, prose(9, 60), "en", "S", None), (500, prose(9, 60), "en", "S", None)]
    rows += [(-7, "minus", "en", "é", 5), (2**60, "far", "en", "", 3)]
    return rows


@pytest.fixture(scope="session")
def messy(spark, messy_rows):
    from pyspark.sql import functions as F

    docs = spark.createDataFrame(messy_rows, DOCS)
    return docs.select("*", *[F.lit("other").alias(name) for name in CLASHING]).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="session")
def no_labels(spark):
    return spark.createDataFrame([], "doc_id long, quality int, toxic int")
