"""Alignment of tokenizers, divergence of sources and shuffled shards, against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from factorspark.llm import alignment, divergence, sharding

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
NAMES = ("byte_bpe_50k.json", "piece_bpe_32k.model", "byte_bpe_50k.tiktoken")
PATHS = [public_tokenizers.path(name) for name in NAMES]


# --- alignment ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def plain_tokens():
    """(id, first byte, end) of every token of both tokenizers, by the libraries alone."""
    import sentencepiece
    from tokenizers import Tokenizer, pre_tokenizers

    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    # the sign of a byte, from texts whose bytes are known
    signs = {}
    split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    for k in range(128):
        signs[k] = split.pre_tokenize_str(chr(k))[0][0]
    several = [0x80 + 64 * k for k in range(30)] + [0xC0 + k for k in range(64)]
    several += [max(0x800, k << 12) for k in range(16) if k != 13] + [0xD000] + [max(0x10000, k << 18) for k in range(5)]
    for char in map(chr, several):
        signs |= zip(char.encode(), split.pre_tokenize_str(char)[0][0])
    bytes_of = {sign: byte for byte, sign in signs.items()}

    def spans(tokens):
        out, at = [], 0
        for k, raw in tokens:
            out.append((k, at, at + len(raw)))
            at += len(raw)
        return out

    def tokens(text):
        if not text:
            return [], []
        whole = (" " + text).encode()
        of_a = [(k, bytes(bytes_of[s] for s in a.id_to_token(k))) for k in a.encode(" " + text, add_special_tokens=False).ids]
        of_b = []
        for k in b.encode(text):
            piece = b.id_to_piece(k)
            byte = re.fullmatch(r"<0x([0-9A-F]{2})>", piece)
            of_b.append((k, bytes([int(byte[1], 16)]) if byte else piece.replace("▁", " ").encode()))
        if any(b"".join(raw for _, raw in side) != whole for side in (of_a, of_b)):
            return [], []
        return spans(of_a), spans(of_b)

    return tokens


def plain_alignment(texts, tokens):
    """Every overlap looked at, token by token."""
    links, groups = [], []
    for text in texts:
        a, b = tokens(text)
        links.append([(i, j) for i, s, e in a for j, t, f in b if s < f and t < e])
        cut, at = [], 0
        for end in sorted({e for _, _, e in a} & {e for _, _, e in b}):
            sides = [",".join(str(k) for k, s, e in side if at <= s and e <= end) for side in (a, b)]
            cut.append("|".join(sides))
            at = end
        groups.append((len(a), len(b), len(cut), ";".join(cut)))
    counts = Counter(link for of in links for link in of)
    highest = defaultdict(int)
    for (_, j), n in counts.items():
        highest[j] = max(highest[j], n)
    return [
        (n_a, n_b, n, len(of), sum(counts[x] == highest[x[1]] for x in of), sum(counts[x] for x in of),
         hashlib.sha256(written.encode()).hexdigest() if written else "")
        for of, (n_a, n_b, n, written) in zip(links, groups)
    ]


def test_alignment_of_odd_texts(spark, messy, messy_rows, plain_tokens, monkeypatch):
    monkeypatch.setattr(alignment, "BLOCK_ROWS", 17)  # several blocks in a task
    short = [row for row in messy_rows if len(row[1] or "") < 4000]
    short += [(600, "x▁y", "en", "s", 1), (601, "aaaa aaaaaa \n\n\n  b", "en", "s", 1)]
    docs = spark.createDataFrame(short, DOCS).withColumns({"row": F.lit(1), "pair": F.lit("x"), "block": F.lit("y")})
    rows = alignment.align(docs.repartition(3), *PATHS).collect()
    want = plain_alignment([row[1] for row in short], plain_tokens)
    assert Counter(map(tuple, rows)) == Counter((row[0], *found) for row, found in zip(short, want))
    assert sum(row.n_links > 0 for row in rows) > 60


def test_alignment_without_ranks_is_the_same(messy):
    assert Counter(map(tuple, alignment.align(messy, *PATHS).collect())) == Counter(
        map(tuple, alignment.align(messy, *PATHS[:2]).collect())
    )


def test_pair_counts_add_up(messy):
    found = alignment.align(messy, *PATHS).agg(F.sum("n_links")).first()[0]
    pairs = alignment.pair_counts(messy, *PATHS)
    assert pairs.agg(F.sum("count")).first()[0] == found
    assert pairs.filter("best").select("b").distinct().count() == pairs.select("b").distinct().count()


def test_alignment_of_empty_tables(spark, no_docs):
    assert alignment.align(no_docs, *PATHS).collect() == []
    nothing = spark.createDataFrame([(1, None, None, None, None), (None, "", None, None, None)], DOCS)
    zero = (0, 0, 0, 0, 0, 0, "")
    assert Counter(map(tuple, alignment.align(nothing, *PATHS).collect())) == Counter([(1, *zero), (None, *zero)])


def test_alignment_of_long_unbroken_text():
    aligner = alignment.Aligner(*PATHS)
    found = aligner.align(["ab" * 250_000, None, "漢字" * 20_000])
    assert found.sizes[1].tolist() == [0, 0, 0] and found.sizes[0].min() > 1000


# --- divergence ---------------------------------------------------------------------------------

WORDS = st.lists(st.sampled_from([b"a", b"ab", b"abcdefgh", b"abcdefghi", b"abcdefgh" * 9, b"abcdefgh" * 9 + b"z", "é".encode()]))


@given(WORDS)
@settings(max_examples=150, deadline=None)
def test_pointer_sort(words):
    data = np.frombuffer(b" ".join(words), np.uint8)
    start, end = divergence.word_starts(data, np.array([0, len(data)]))
    order, run = divergence.sorted_runs(data, start, end)
    assert [data[start[k] : end[k]].tobytes() for k in order] == sorted(words)
    assert len(set(run.tolist())) == len(set(words))


def test_words_end_with_their_text():
    texts = [b"ab", b"", b"cd", b"-", b"e"]
    bounds = np.cumsum([0] + [len(t) for t in texts])
    terms, rows = divergence.count_terms(np.frombuffer(b"".join(texts), np.uint8), bounds, np.zeros(5, np.int64))
    assert terms == [b"ab", b"cd", b"e"] and rows[:, 2:].tolist() == [[1, 1]] * 3


def plain_audit(rows, min_docs, top):
    docs = []
    for _, text, lang, source, _ in rows:
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        docs.append((lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower)))
    found = []
    for lang in {d[0] for d in docs}:
        own = [d for d in docs if d[0] == lang]
        df = Counter(term for d in own for term in set(d[2]))
        kept = [term for term, n in df.items() if n >= min_docs]

        def scaled(texts):
            counts = Counter(term for d in texts for term in d[2])
            total = sum(counts[term] for term in kept)
            return counts, {t: 1 + (10**9 * (counts[t] + 5)) // (total + 5 * len(kept)) for t in kept}

        _, q = scaled(own)
        sources = {s: scaled([d for d in own if d[1] == s]) for s in {d[1] for d in own}}
        for source, (counts, p) in sources.items():
            pairs = [(t, sum(abs(p[k] - o[k]) for k in kept)) for t, (_, o) in sources.items() if t != source]
            terms = [(k, p[k] - q[k]) for k in kept if counts[k] > 0 and p[k] > q[k]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(items, key=lambda x: (-x[1], x[0].encode()))[:most]
                found += [(lang, source, part, item, value, k + 1) for k, (item, value) in enumerate(ranked)]
    return Counter(found)


@pytest.mark.parametrize("min_docs, top", [(3, 7), (1, 50), (10_000, 50)])
def test_audit(messy, messy_rows, min_docs, top, monkeypatch):
    monkeypatch.setattr(divergence, "SLICE_BYTES", 5000)
    monkeypatch.setattr(divergence, "BLOCK_ENTRIES", (50, 200))
    monkeypatch.setattr(divergence, "SOURCE_SLICE", 2)
    monkeypatch.setattr(divergence, "CELLS", 64)
    rows = divergence.audit(messy, min_docs, top).collect()
    assert Counter(map(tuple, rows)) == plain_audit(messy_rows, min_docs, top)


def test_audit_with_a_hot_source_and_long_words(spark):
    random_ = random.Random(5)
    rows = [(k, " ".join(random_.choices(["the", "The", "of", "Été", "x" * 70, "x" * 71, "日本"], k=20)), "en", "hot", 1) for k in range(60)]
    rows += [(k, rows[0][1], "en", f"s{k % 5}", 1) for k in range(60, 90)]  # a third are copies
    rows += [(90, "y" * 400_000, "en", None, 1), (91, "y" * 400_000, "en", "", 1), (92, "1 2 3", None, "none", 1)]
    found = divergence.audit(spark.createDataFrame(rows, DOCS), 2, 50).collect()
    assert Counter(map(tuple, found)) == plain_audit(rows, 2, 50)


def test_audit_of_no_documents(no_docs):
    assert divergence.audit(no_docs).collect() == []


def test_probabilities_are_exact(spark):
    count, total, terms = 10**13 + 7, 10**15 + 3, 10**7
    p = spark.range(1).select(divergence.scaled_probability(*[F.lit(x).cast("long") for x in (count, total, terms)])).first()[0]
    assert p == 1 + (10**9 * (count + 5)) // (total + 5 * terms)


# --- shards -------------------------------------------------------------------------------------


@pytest.mark.parametrize("shards, bucket_bytes", [(40, 1 << 25), (7, 1000), (500, 1 << 25), (1, 200)])
def test_shards(messy, messy_rows, shards, bucket_bytes):
    rows = sharding.shuffled(messy, shards, bucket_bytes=bucket_bytes).collect()
    assert Counter((r.row.doc_id, r.row.text) for r in rows) == Counter((r[0], r[1]) for r in messy_rows)
    assert all(r.row.shard == "other" for r in rows)  # a column of that name stays the row's own
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    sizes = [len(slots[k]) for k in range(shards)]
    assert set(slots) <= set(range(shards)) and max(sizes) - min(sizes) <= 1
    assert all(sorted(found) == list(range(len(found))) for found in slots.values())


def test_shards_are_the_same_again(messy):
    def order(seed):
        return [(r.shard, r.slot, r.row.text) for r in sharding.shuffled(messy, 5, seed).orderBy("shard", "slot").collect()]

    assert order(1) == order(1) != order(2)


def test_order_is_random_and_copies_spread(spark):
    """A third of the rows are one row; neighbours of the table are no neighbours of the result."""
    docs = spark.range(0, 6000, 1, 4).select(
        F.when(F.col("id") < 2000, 0).otherwise(F.col("id")).alias("doc_id"),
        F.when(F.col("id") < 2000, F.lit("copy")).otherwise(F.col("id").cast("string")).alias("text"),
        F.col("id").alias("was"),
    )
    rows = sharding.shuffled(docs, 10, bucket_bytes=20_000).orderBy("shard", "slot").collect()
    copies = Counter(r.shard for r in rows if r.row.text == "copy")
    assert min(copies.values()) > 140 and max(copies.values()) < 260  # 200 expected
    was = np.array([r.row.was for r in rows])
    assert abs(np.corrcoef(was, np.arange(6000))[0, 1]) < 0.06
    assert (np.abs(np.diff(was)) == 1).sum() < 12  # two expected
    assert np.bincount(np.argmin(was.reshape(10, -1), axis=1) // 60, minlength=10).max() < 8


def test_shards_of_no_documents(no_docs):
    assert sharding.shuffled(no_docs).collect() == []
    with pytest.raises(ValueError):
        sharding.shuffled(no_docs, 0)


def test_written_shards(spark, messy, tmp_path):
    found = sharding.shuffled(messy.select("doc_id", "text"), 4)
    sharding.write_shards(found, str(tmp_path / "shards"))
    read = spark.read.parquet(str(tmp_path / "shards"))
    want = Counter((r.shard, r.slot, r.row.doc_id, r.row.text) for r in found.collect())
    assert Counter((r._shard, r._slot, r.doc_id, r.text) for r in read.collect()) == want


def test_digest_columns(spark, messy, messy_rows, tmp_path):
    from factorspark.llm import queries

    messy.select(*[column.split()[0] for column in DOCS.split(", ")]).write.parquet(str(tmp_path / "documents.parquet"))
    rows = queries.op13_shuffled_shards(spark, str(tmp_path)).collect()
    raw = [(r[0], (r[1] or "").encode()) for r in messy_rows]
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter((k, len(t) + 16, zlib.crc32(t)) for k, t in raw)
    assert {(r.law, r.grown_shard) for r in rows} == {("rows", None)}
