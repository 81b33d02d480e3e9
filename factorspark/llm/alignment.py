"""Alignment of two tokenizers over the same texts.

Where tokens of both end at the same byte, a text is cut into groups. Most groups are one token of A
and one of B with the same bytes: a map from A ids to B ids, made once from the two vocabularies,
tells them at sight, and they are counted in a vector as long as A's vocabulary, one per task. Only
the links of other, irregular groups enter the pair shuffle.

Documents are taken in blocks of bounded size. A block's links are staged per document, by their
place in the block's list of distinct pairs. The lists are exploded to (block, pair), so a pair is one
row per block however often it occurs; they are counted with the vectors, joined to the corpus-wide
counts and handed back to their blocks, where the sums per document are taken.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factorspark.llm.batches import small_batches
from factorspark.llm.pretokens import BYTE_PATTERN, is_plain, load_tokenizer, worker_state
from factorspark.sources.staging import stage

BLOCK_ROWS = 4096
BLOCK_CHARS = 1 << 21

_STAGED = "block long, docs binary, pairs array<long>, links array<long>"
_RESULT = (
    "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
)


def byte_of_sign() -> dict[str, int]:
    """Byte-level vocabularies write a byte as a visible sign: Latin-1 signs that can be seen stand for
    themselves, the others are numbered on from U+0100."""
    seen = [*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)]
    hidden = sorted(set(range(256)) - set(seen))
    return {chr(b): b for b in seen} | {chr(256 + k): b for k, b in enumerate(hidden)}


@dataclass
class Alignment:
    """Groups and links of the texts of one block.

    ``sizes`` has n_a, n_b and n_groups per text, ``digests`` the groups' SHA-256. ``same`` and ``other``
    hold links of identity and irregular groups as (text, key, times), sorted, where a key is an A id or
    the place of a pair in ``pairs``; ``links`` counts those.
    """

    sizes: np.ndarray
    digests: list[str]
    same: tuple[np.ndarray, np.ndarray, np.ndarray]
    pairs: np.ndarray
    links: np.ndarray
    other: tuple[np.ndarray, np.ndarray, np.ndarray]


def _counted(text: np.ndarray, key: np.ndarray, keys: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, key, times) of the distinct ones."""
    code, times = np.unique(text * np.int64(max(1, keys)) + key, return_counts=True)
    return *np.divmod(code, np.int64(max(1, keys))), times


class Aligner:
    """Two tokenizers with the bytes of their ids; A's is a byte-level BPE file of ``tokenizers`` (with,
    if given, the same vocabulary as ``tiktoken`` ranks), B's a ``sentencepiece`` model."""

    def __init__(self, a_path: str, b_path: str, a_ranks: str | None = None):
        import sentencepiece

        self.a = load_tokenizer(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        byte = byte_of_sign()
        vocabulary = self.a.get_vocab()
        self.a_bytes = [b""] * (max(vocabulary.values()) + 1)
        for token, k in vocabulary.items():
            # an added token may have signs of its own
            known = all(sign in byte for sign in token)
            self.a_bytes[k] = bytes(byte[sign] for sign in token) if known else token.encode()
        self.b_bytes = []
        for k in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(k)
            one = self.b.is_byte(k)
            self.b_bytes.append(bytes([int(piece[1:-1], 16)]) if one else piece.replace("▁", " ").encode())
        # a piece goes before the byte that spells the same
        by_bytes = {t: k for k, t in enumerate(self.b_bytes) if self.b.is_byte(k)}
        by_bytes |= {t: k for k, t in reversed(list(enumerate(self.b_bytes))) if not self.b.is_byte(k)}
        self.same_b = np.array([by_bytes.get(t, -1) if t else -1 for t in self.a_bytes], np.int64)
        self.a_size = np.array([len(t) for t in self.a_bytes], np.int64)
        self.b_size = np.array([len(t) for t in self.b_bytes], np.int64)
        # an id as it is written inside its side of a group, and at the end of it
        self.signs = [f"{k}{end}" for k in range(len(self.a_bytes)) for end in ",|"]
        self.signs += [f"{k}{end}" for k in range(len(self.b_bytes)) for end in ",;"]
        self.fast = None
        if a_ranks:
            import tiktoken

            with open(a_ranks, "rb") as lines:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def a_ids(self, text: str) -> list[int]:
        if self.fast and is_plain(text, ()):
            return self.fast.encode_ordinary(text)
        return self.a.encode(text, add_special_tokens=False).ids

    def ids(self, texts: list[str | None]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of A and B; none for texts that are null, empty or not spelled by the tokens' bytes."""
        a, b = [], []
        for text, of_b in zip(texts, self.b.encode([text or "" for text in texts], num_threads=1)):
            of_a = self.a_ids(" " + text) if text else []
            spelled = (" " + text).encode() if text else b""
            if any(b"".join(map(table.__getitem__, k)) != spelled for table, k in ((self.a_bytes, of_a), (self.b_bytes, of_b))):
                of_a, of_b = [], []
            a.append(of_a)
            b.append(of_b)
        return a, b

    def align(self, texts: list[str | None]) -> Alignment:
        """All texts in one go: their bytes are laid end to end, where every text ends a group."""
        a_lists, b_lists = self.ids(texts)
        n_a, n_b = (np.array([len(x) for x in lists], np.int64) for lists in (a_lists, b_lists))
        a, b = (np.fromiter((k for x in lists for k in x), np.int64) for lists in (a_lists, b_lists))
        a_end, b_end = np.cumsum(self.a_size[a]), np.cumsum(self.b_size[b])
        ends = np.intersect1d(a_end, b_end, assume_unique=True)
        a_group, b_group = np.searchsorted(ends, a_end), np.searchsorted(ends, b_end)
        in_a, in_b = np.bincount(a_group, minlength=len(ends)), np.bincount(b_group, minlength=len(ends))
        last_a, last_b = np.cumsum(in_a) - 1, np.cumsum(in_b) - 1
        text_of_a = np.repeat(np.arange(len(texts)), n_a)
        n_groups = np.bincount(text_of_a[last_a], minlength=len(texts))

        identity = (in_a == 1) & (in_b == 1) & (self.same_b[a[last_a]] == b[last_b])
        at = last_a[identity]
        same = _counted(text_of_a[at], a[at], len(self.a_bytes))
        # the ends of either side in irregular groups cut out one stretch per link
        cuts = np.union1d(a_end[~identity[a_group]], b_end[~identity[b_group]])
        at = np.searchsorted(a_end, cuts)
        pair = a[at] * len(self.b_bytes) + b[np.searchsorted(b_end, cuts)]
        pairs, place, links = np.unique(pair, return_inverse=True, return_counts=True)
        other = _counted(text_of_a[at], place, len(pairs))

        signs = np.empty(len(a) + len(b), np.int64)
        b_before = np.r_[0, last_b + 1][a_group]  # B ids of earlier groups
        signs[np.arange(len(a)) + b_before] = 2 * a + (np.arange(len(a)) == last_a[a_group])
        b_sign = 2 * b + (np.arange(len(b)) == last_b[b_group])
        signs[np.arange(len(b)) + last_a[b_group] + 1] = b_sign + 2 * len(self.a_bytes)
        bounds = np.r_[0, np.cumsum(n_a + n_b)].tolist()
        digests = []
        for start, end in zip(bounds, bounds[1:]):
            written = "".join([self.signs[k] for k in signs[start:end].tolist()])[:-1]
            digests.append(hashlib.sha256(written.encode()).hexdigest() if written else "")
        return Alignment(np.stack([n_a, n_b, n_groups], axis=1), digests, same, pairs, links, other)


def _per_text(found: tuple[np.ndarray, np.ndarray, np.ndarray], texts: int) -> tuple[pa.ListArray, pa.ListArray]:
    """Keys and times as one list per text, in the narrowest type that holds them."""
    text, key, times = found
    offsets = pa.array(np.searchsorted(text, np.arange(texts + 1)).astype(np.int32))
    narrow = [x.astype(np.min_scalar_type(x.max(initial=0))) for x in (key, times)]
    return tuple(pa.ListArray.from_arrays(offsets, pa.array(x)) for x in narrow)


def _packed(ids: pa.Array, found: Alignment) -> bytes:
    n = len(ids)
    same, same_times = _per_text(found.same, n)
    other, other_times = _per_text(found.other, n)
    sizes = [pa.array(column) for column in found.sizes.T]
    columns = [ids, *sizes, pa.array(found.digests, pa.string()), same, same_times, other, other_times]
    batch = pa.RecordBatch.from_arrays(columns, [str(k) for k in range(len(columns))])
    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, batch.schema) as stream:
        stream.write_batch(batch)
    return out.getvalue().to_pybytes()


def _blocks(docs: DataFrame, a_path: str, b_path: str, a_ranks: str | None) -> DataFrame:
    """One row per block: its documents, and its distinct irregular pairs with their links. At the end of
    a task one row more without block: the vector of identity links, as pairs."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = worker_state("aligners")
        if (a_path, b_path, a_ranks) not in kept:
            kept[a_path, b_path, a_ranks] = Aligner(a_path, b_path, a_ranks)
        aligner = kept[a_path, b_path, a_ranks]
        vector = np.zeros(len(aligner.a_bytes), np.int64)
        number = TaskContext.get().partitionId() << 32

        def row(block, docs_, pairs: np.ndarray, links: np.ndarray) -> pa.RecordBatch:
            lists = [pa.array([x], pa.list_(pa.int64())) for x in (pairs, links)]
            columns = [pa.array([block], pa.int64()), pa.array([docs_], pa.binary()), *lists]
            return pa.RecordBatch.from_arrays(columns, ["block", "docs", "pairs", "links"])

        def aligned(ids: list, texts: list) -> pa.RecordBatch:
            found = aligner.align(texts)
            np.add.at(vector, found.same[1], found.same[2])
            return row(number, _packed(pa.array(ids, pa.int64()), found), found.pairs, found.links)

        ids, texts, chars = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids.append(doc_id)
                texts.append(text)
                chars += len(text or "")
                if len(ids) >= BLOCK_ROWS or chars >= BLOCK_CHARS:
                    yield aligned(ids, texts)
                    ids, texts, chars, number = [], [], 0, number + 1
        if ids:
            yield aligned(ids, texts)
        used = np.flatnonzero(vector)
        if len(used):
            yield row(None, None, used * len(aligner.b_bytes) + aligner.same_b[used], vector[used])

    return small_batches(docs).select(F.col("doc_id").cast("long"), "text").mapInArrow(rows, _STAGED)


def _pair_counts(staged: DataFrame, b_ids: int) -> DataFrame:
    """``(pair, count, best, identity)``: links of the pair in the corpus, whether no other pair of its B
    id has more, and whether identity groups have it. The highest counts are one row per B id at most."""
    linked = staged.select("block", F.explode(F.arrays_zip("pairs", "links")).alias("of"))
    counts = stage(
        linked.groupBy(F.col("of.pairs").alias("pair"))
        .agg(F.sum("of.links").alias("count"), F.max(F.col("block").isNull()).alias("identity"))
        .withColumn("b", F.col("pair") % b_ids),
        "pair-counts",
    )
    highest = F.broadcast(counts.groupBy("b").agg(F.max("count").alias("highest")))
    return counts.join(highest, "b").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"), "identity")


def _sums(joined: DataFrame, same_count: np.ndarray, same_best: np.ndarray) -> DataFrame:
    """``(docs, answers)`` of each block to its documents."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                docs = pa.ipc.open_stream(batch.column(0)[k].as_py()).read_all().combine_chunks()
                answers = batch.column(1)[k].values
                n = docs.num_rows
                count, best = np.zeros(0, np.int64), np.zeros(0, np.int64)
                if answers is not None:
                    # the block listed its pairs in this order
                    order = np.argsort(answers.field("pair").to_numpy())
                    count = answers.field("count").to_numpy()[order]
                    best = answers.field("best").to_numpy(zero_copy_only=False).astype(np.int64)[order]
                count_sum, n_best = np.zeros(n, np.int64), np.zeros(n, np.int64)
                for at, of_count, of_best in ((5, same_count, same_best), (7, count, best)):
                    keys, times = (docs.column(at + j).chunk(0) for j in (0, 1))
                    text = np.repeat(np.arange(n), np.diff(keys.offsets.to_numpy()))
                    key, times = (x.values.to_numpy().astype(np.int64) for x in (keys, times))
                    np.add.at(count_sum, text, of_count[key] * times)
                    np.add.at(n_best, text, of_best[key] * times)
                ids, n_a, n_b, n_groups, digests = (docs.column(j).chunk(0) for j in range(5))
                n_links = n_a.to_numpy() + n_b.to_numpy() - n_groups.to_numpy()
                sums = [pa.array(x) for x in (n_links, n_best, count_sum)]
                names = [column.split()[0] for column in _RESULT.split(", ")]
                yield pa.RecordBatch.from_arrays([ids, n_a, n_b, n_groups, *sums, digests], names)

    return joined.mapInArrow(rows, _RESULT)


def align(docs: DataFrame, a_path: str, b_path: str, a_ranks: str | None = None) -> DataFrame:
    """``docs(doc_id, text)`` to one row per row: ``(doc_id, n_a, n_b, n_groups, n_links, n_best,
    count_sum, groups_sha256)``.

    A encodes a space and the text, B the text (it adds the space); special strings are plain text. Links
    are the pairs of an A and a B token that share bytes, ``count_sum`` adds up the corpus-wide counts
    of their id pairs, ``n_best`` counts those whose pair is the commonest of its B id. ``groups_sha256``
    is over ``a1,a2|b1;a3|b2``. Executors have to be able to read the tokenizer files.

    Null and empty texts, and those that the tokens do not spell byte by byte (a text with U+2581, say),
    have no tokens: zeros and ''. Null doc_ids stay; repeated rows count as often as they occur; an
    empty table gives an empty result; other columns are ignored. A block has at least one document, so
    memory grows with the longest text.
    """
    staged = stage(_blocks(docs, a_path, b_path, a_ranks), "alignment")
    aligner = Aligner(a_path, b_path)
    counts = stage(_pair_counts(staged, len(aligner.b_bytes)), "pair-ranks")

    # one row per A id at most
    same = counts.filter("identity").select("pair", "count", "best").toArrow()
    same_count, same_best = (np.zeros(len(aligner.a_bytes), np.int64) for _ in range(2))
    at = same["pair"].to_numpy() // len(aligner.b_bytes)
    same_count[at], same_best[at] = same["count"].to_numpy(), same["best"].to_numpy()

    asked = staged.filter(F.col("block").isNotNull()).select("block", F.explode("pairs").alias("pair"))
    answer = F.struct("pair", "count", "best")
    answers = asked.join(counts, "pair").groupBy("block").agg(F.collect_list(answer).alias("answers"))
    blocks = staged.filter(F.col("block").isNotNull()).select("block", "docs")
    return _sums(blocks.join(answers, "block", "left").select("docs", "answers"), same_count, same_best)


def pair_counts(docs: DataFrame, a_path: str, b_path: str, a_ranks: str | None = None) -> DataFrame:
    """``(a, b, count, best)``: links of every pair of ids in the corpus, and whether it is the commonest
    pair of its B id (ties included)."""
    b_ids = len(Aligner(a_path, b_path).b_bytes)
    counts = _pair_counts(stage(_blocks(docs, a_path, b_path, a_ranks), "alignment"), b_ids)
    a = F.floor(F.col("pair") / b_ids).cast("int")
    return counts.select(a.alias("a"), (F.col("pair") % b_ids).cast("int").alias("b"), "count", "best")
