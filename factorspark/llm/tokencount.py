"""Token counts: pieces are counted once per distinct pre-token and summed per document.

Documents are taken in blocks of bounded size. A block gives one row per distinct pre-token, with
the documents of the block that have it and how often: the table of pre-token frequencies per
document, packed. The rows are dealt by pre-token, so its pieces are counted once, where all of its
rows are; multiplied by the frequencies, they are summed per block and document. No ids are kept.

A pre-token of every document is one small row per block. Those that a quarter of a block's
documents have are dealt into ``SALTS`` parts, and counted once in each.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factorspark.llm.batches import small_batches
from factorspark.llm.pretokens import WORD_BPE, is_plain, load_tokenizer, special_strings

ORD_BITS = 13
TIMES_BITS = 32 - ORD_BITS
BLOCK_ROWS = 1 << ORD_BITS
BLOCK_CHARS = 1 << 25
FLUSH_BLOCKS = 1024
SALTS = 64
KNOWN_PIECES = 500_000
# A NUL before a letter, which no pre-token has, marks a special token, the list of a block's
# documents, and the salt at the end of a frequent pre-token.
SPECIAL = "\x00special"
LIST = "\x00list"
SALT = "\x00salt"

_ROWS = "piece string, block long, posted binary"


def pretokens(text: str, tokenizer, specials: tuple[str, ...], split_at: re.Pattern | None) -> list[str]:
    """The normalised pre-tokens of a text, with ``SPECIAL`` for each special token it spells."""
    if is_plain(text, specials):
        return WORD_BPE.findall(text.lower())
    found = []
    for part in split_at.split(text) if split_at else [text]:
        if part in specials:
            found.append(SPECIAL)
        elif part:
            plain = tokenizer.normalizer.normalize_str(part)
            found += [plain[a:b] for _, (a, b) in tokenizer.pre_tokenizer.pre_tokenize_str(plain)]
    return found


class _Block:
    """Pre-token frequencies of up to ``BLOCK_ROWS`` documents."""

    def __init__(self):
        self.ids: list = []
        self.sizes: list[int] = []
        self.chars = 0
        self.number: defaultdict[str, int] = defaultdict()
        self.number.default_factory = self.number.__len__
        self.pieces: list[int] = []
        self.times: list[int] = []
        self.distinct: list[int] = []

    def add(self, doc_id, n_bytes: int, text: str, found: list[str]) -> None:
        counts = Counter(found)
        self.ids.append(doc_id)
        self.sizes.append(n_bytes)
        self.chars += len(text)
        self.pieces.extend(map(self.number.__getitem__, counts))
        self.times.extend(counts.values())
        self.distinct.append(len(counts))

    def full(self) -> bool:
        return len(self.ids) >= BLOCK_ROWS or self.chars >= BLOCK_CHARS

    def packed(self, block: int) -> pa.RecordBatch:
        """A posting is 32 bits: the document's place in the block, and how often it has the piece."""
        pieces, times = np.array(self.pieces, np.int64), np.array(self.times, np.int64)
        place = np.repeat(np.arange(len(self.ids)), self.distinct)
        most = (1 << TIMES_BITS) - 1
        if times.max(initial=0) > most:  # more than fit are several postings
            often = -(-times // most)
            last = np.cumsum(often) - 1
            rest = times - (often - 1) * most
            pieces, place = np.repeat(pieces, often), np.repeat(place, often)
            times = np.full(len(pieces), most)
            times[last] = rest
        order = np.argsort(pieces, kind="stable")
        posted = (place[order] << TIMES_BITS | times[order]).astype("<u4")
        counts = np.bincount(pieces, minlength=len(self.number))
        names = list(self.number)
        for k in np.flatnonzero(counts > len(self.ids) / 4).tolist():
            names[k] += f"{SALT}{(block >> 32) % SALTS}"
        known = np.array([(i is not None, i or 0) for i in self.ids], "<i8")
        listed = known.tobytes() + np.array(self.sizes, "<i8").tobytes()
        ends = np.concatenate([[0], np.cumsum(4 * counts), [4 * len(posted) + len(listed)]]).astype("<i4")
        data = pa.py_buffer(posted.tobytes() + listed)
        column = pa.BinaryArray.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.tobytes()), data])
        names.append(f"{LIST}{block}")
        return pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(np.full(len(names), block)), column], ["piece", "block", "posted"]
        )


def _blocks(docs: DataFrame, path: str) -> DataFrame:
    """One row per block and distinct pre-token, and one that lists the documents of the block."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load_tokenizer(path)
        specials = special_strings(tokenizer)
        split_at = re.compile(f"({'|'.join(map(re.escape, specials))})") if specials else None
        number = TaskContext.get().partitionId() << 32
        block = _Block()
        for batch in batches:
            for doc_id, raw in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()).to_pylist()):
                text = (raw or b"").decode()
                block.add(doc_id, len(raw or b""), text, pretokens(text, tokenizer, specials, split_at))
                if block.full():
                    yield block.packed(number)
                    block, number = _Block(), number + 1
        if block.ids:
            yield block.packed(number)

    return small_batches(docs).select("doc_id", "text").mapInArrow(rows, _ROWS)


def _sums(dealt: DataFrame, path: str) -> DataFrame:
    """Rows dealt by pre-token to ``(block, posted, tokens)``: what a task has of each block.

    ``posted`` has places of documents and ``tokens`` their sums; the list of a block's documents
    passes through, with null tokens. Sums are handed on after ``FLUSH_BLOCKS`` blocks and the known
    counts dropped at ``KNOWN_PIECES``, so a task's memory is bounded.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load_tokenizer(path)
        known: dict[str, int] = {}
        at: dict[int, int] = {}
        sums = np.zeros((FLUSH_BLOCKS, BLOCK_ROWS), np.int64)

        def handed_on() -> pa.RecordBatch:
            where = [np.flatnonzero(sums[k]) for k in at.values()]
            places = [x.astype("<u2").tobytes() for x in where]
            tokens = [sums[k][x].astype("<i8").tobytes() for k, x in zip(at.values(), where)]
            out = [pa.array(list(at), pa.int64()), pa.array(places, pa.binary()), pa.array(tokens, pa.binary())]
            return pa.RecordBatch.from_arrays(out, ["block", "posted", "tokens"])

        # a slice has no more blocks than rows
        for batch in (b.slice(k, FLUSH_BLOCKS) for b in batches for k in range(0, b.num_rows, FLUSH_BLOCKS)):
            names = batch.column(0).to_pylist()
            lists = [k for k, name in enumerate(names) if name.startswith(LIST)]
            if lists:
                kept = batch.take(pa.array(lists))
                nothing = pa.nulls(len(lists), pa.binary())
                yield pa.RecordBatch.from_arrays([kept.column(1), kept.column(2), nothing], ["block", "posted", "tokens"])
                batch = batch.filter(pa.array([not name.startswith(LIST) for name in names]))
                names = batch.column(0).to_pylist()
            if not names:
                continue
            pieces = [name.partition(SALT)[0] for name in names]
            if len(known) > KNOWN_PIECES:
                known.clear()
            new = list({piece for piece in pieces if piece not in known})
            for piece, found in zip(new, tokenizer.encode_batch_fast(new, add_special_tokens=False)):
                known[piece] = 1 if piece == SPECIAL else len(found.ids)
            tokens = np.fromiter(map(known.__getitem__, pieces), np.int64, len(pieces))
            blocks, which = np.unique(batch.column(1).to_numpy(), return_inverse=True)
            if len(at) + len(blocks) > FLUSH_BLOCKS:
                yield handed_on()
                at.clear()
                sums[:] = 0
            rows_of = np.array([at.setdefault(b, len(at)) for b in blocks.tolist()])
            column = batch.column(2)
            _, offsets, data = column.buffers()
            ends = np.frombuffer(offsets, "<i4")[column.offset : column.offset + len(column) + 1]
            posted = np.frombuffer(data, "<u4", (ends[-1] - ends[0]) // 4, ends[0]).astype(np.int64)
            each = np.diff(ends) // 4
            place = posted >> TIMES_BITS
            amount = (posted & ((1 << TIMES_BITS) - 1)) * np.repeat(tokens, each)
            np.add.at(sums, (np.repeat(rows_of[which], each), place), amount)
        if at:
            yield handed_on()

    return dealt.mapInArrow(rows, "block long, posted binary, tokens binary")


def _documents(summed: DataFrame) -> DataFrame:
    """``(listed, posted, tokens)`` per block to its documents; the last two are lists of partial sums."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for listed, places, tokens in zip(*(column.to_pylist() for column in batch.columns)):
                n = len(listed) // 24
                known = np.frombuffer(listed, "<i8", 2 * n).reshape(-1, 2)
                sizes = np.frombuffer(listed, "<i8", n, 16 * n)
                total = np.zeros(n, np.int64)
                for where, part in zip(places, tokens):
                    total[np.frombuffer(where, "<u2")] += np.frombuffer(part, "<i8")
                columns = [pa.array(known[:, 1], mask=known[:, 0] == 0), pa.array(sizes), pa.array(total)]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_bytes", "n_tokens"])

    return summed.mapInArrow(rows, "doc_id long, n_bytes long, n_tokens long")


def token_counts(docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """``docs(doc_id, text)`` to ``(doc_id, n_bytes, n_tokens)``, one row per row.

    ``tokenizer_path`` is a ``tokenizers`` file with the word BPE's pre-tokenizer, readable on every
    executor. Null and empty texts have 0 bytes and 0 tokens; null and repeated doc_ids stay as they
    are; an empty table gives an empty result; other columns are ignored.
    """
    summed = _sums(_blocks(docs, tokenizer_path).repartition("piece"), tokenizer_path)
    partial = F.col("tokens").isNotNull()
    return _documents(
        summed.groupBy("block").agg(
            F.max(F.when(~partial, F.col("posted"))).alias("listed"),
            F.collect_list(F.when(partial, F.col("posted"))).alias("posted"),
            F.collect_list("tokens").alias("tokens"),
        ).drop("block")
    )
