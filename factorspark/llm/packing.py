"""Best-fit packing with swap-based local search.

A document becomes its token ids and an end id; what is longer than a sequence is cut into full
pieces from the end, so that only the first piece may be shorter. Full pieces are sequences of
their own. The others are dealt into shards of about ``SHARD_ROWS`` pieces, and each shard is
packed in one task: best fit in decreasing length, then exchanges between underfull bins, each of
which increases the sum of squared fills, to empty the emptiest bins. Every shard can leave a
fraction of one bin unused, which at this shard size is below a thousandth of its bins.
"""

from __future__ import annotations

import base64
import struct
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factorspark.llm.batches import small_batches
from factorspark.llm.pretokens import BYTE_PATTERN, is_plain, load_tokenizer, special_strings, worker_state
from factorspark.sources.staging import stage_observed

SHARD_ROWS = 8192

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PLACED = f"{_PIECES}, sequence_id long, offset long"


def encoder(tokenizer_path: str, ranks_path: str | None) -> Callable[[str], np.ndarray]:
    """Ids of a text by the ``tokenizers`` file.

    With the same vocabulary as a ``tiktoken`` file of ranks, plain texts go through that library,
    which is faster and gives the same ids; texts with special strings or other characters do not.
    """
    tokenizer = load_tokenizer(tokenizer_path)
    specials = special_strings(tokenizer)

    def slow(text: str) -> np.ndarray:
        return np.array(tokenizer.encode(text, add_special_tokens=False).ids, "<u4")

    if ranks_path is None:
        return slow
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    ordinary = tiktoken.Encoding("ranks", pat_str=BYTE_PATTERN, mergeable_ranks=ranks, special_tokens={})

    def ids(text: str) -> np.ndarray:
        return ordinary.encode_to_numpy(text, disallowed_special=()).astype("<u4") if is_plain(text, specials) else slow(text)

    return ids


def tokenized(docs: DataFrame, tokenizer_path: str, ranks_path: str | None, end_id: int, capacity: int) -> DataFrame:
    """``docs(doc_id, text)`` to one row per piece: place in the document, length and CRC of its ids."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = worker_state("encoders")
        if (tokenizer_path, ranks_path) not in kept:
            kept[tokenizer_path, ranks_path] = encoder(tokenizer_path, ranks_path)
        encode = kept[tokenizer_path, ranks_path]
        end = struct.pack("<I", end_id)
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = encode(text or "").tobytes() + end
                n = len(ids) // 4
                start, length = 0, n % capacity or min(n, capacity)
                piece = 0
                while start < n:
                    crc = zlib.crc32(ids[4 * start : 4 * (start + length)])
                    out.append((doc_id, piece, start, length, crc))
                    start, length, piece = start + length, capacity, piece + 1
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            columns = [pa.array(column, kind) for column, kind in zip(zip(*out), kinds)]
            if out:
                yield pa.RecordBatch.from_arrays(columns, _names(_PIECES))

    return small_batches(docs).select("doc_id", "text").mapInArrow(rows, _PIECES)


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Bins as lists of lengths; ``lengths`` in descending order. Gaps are looked up in a bit mask."""
    bins: list[list[int]] = []
    with_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    gaps = 0
    for length in lengths:
        room = gaps >> length
        if room:
            gap = length + (room & -room).bit_length() - 1
            at = with_gap[gap].pop()
            if not with_gap[gap]:
                gaps &= ~(1 << gap)
            bins[at].append(length)
        else:
            gap, at = capacity, len(bins)
            bins.append([length])
        rest = gap - length
        with_gap[rest].append(at)
        if rest:
            gaps |= 1 << rest
    return bins


class _Bins:
    """Underfull bins by gap: for each gap its bins and, as a bit mask, the lengths they hold."""

    def __init__(self, bins: list[list[int]], capacity: int):
        self.bins, self.capacity = bins, capacity
        self.gap = [capacity - sum(items) for items in bins]
        self.at: dict[int, set[int]] = {}
        self.masks: dict[int, tuple[int, int]] = {}
        self.held: dict[int, tuple[int, int]] = {}
        for k in range(len(bins)):
            self._put(k)

    def _put(self, k: int) -> None:
        gap = self.gap[k]
        if 0 < gap < self.capacity:
            self.at.setdefault(gap, set()).add(k)
            self.masks.pop(gap, None)

    def _take(self, k: int) -> None:
        gap = self.gap[k]
        if 0 < gap < self.capacity:
            self.at[gap].discard(k)
            if not self.at[gap]:
                del self.at[gap]
            self.masks.pop(gap, None)

    def _lengths(self, k: int) -> tuple[int, int]:
        """Bit masks of the lengths that a bin holds, and of the sums of two of its pieces."""
        if k not in self.held:
            one = twice = two = 0
            for length in self.bins[k]:
                bit = 1 << length
                twice |= one & bit
                one |= bit
            for length in set(self.bins[k]):
                two |= (one & ~(1 << length) | twice & 1 << length) << length
            self.held[k] = one, two
        return self.held[k]

    def mask(self, gap: int) -> tuple[int, int]:
        """The same masks for all bins with that gap."""
        if gap not in self.masks:
            one = two = 0
            for k in self.at[gap]:
                of_bin = self._lengths(k)
                one |= of_bin[0]
                two |= of_bin[1]
            self.masks[gap] = one, two
        return self.masks[gap]

    def exchange(self, i: int, give: list[int], j: int, get: list[int]) -> None:
        """Bin i gives and gets lengths, bin j the other way round."""
        for k, off, on in ((i, give, get), (j, get, give)):
            self._take(k)
            for length in off:
                self.bins[k].remove(length)
            self.bins[k].extend(on)
            self.held.pop(k, None)
            self.gap[k] += sum(off) - sum(on)
            self._put(k)

    def holder(self, gap: int, lengths: list[int]) -> int:
        """A bin with that gap which holds the length, if any."""
        wanted = sum(1 << length for length in lengths)
        return next(k for k in self.at[gap] if self._lengths(k)[0] & wanted == wanted)

    def holder_of_two(self, gap: int, total: int) -> tuple[int, list[int]]:
        """A bin with that gap and two of its pieces with that sum."""
        at = next(k for k in self.at[gap] if self._lengths(k)[1] >> total & 1)
        items = self.bins[at]
        one = next(x for x in items if total - x in items and (2 * x != total or items.count(x) > 1))
        return at, [one, total - one]


def _best_exchange(state: _Bins, i: int) -> tuple[int, list[int], int, list[int]] | None:
    """The exchange that moves most out of bin i into a fuller bin: (moved, give, j, get).

    Bin i gives one length or two, and gets nothing, or one smaller length; or it gives one and gets
    two. The receiver must become fuller than bin i was, which makes the squared fills grow. All
    receivers are covered: those of a gap are looked up by the lengths and pair sums that they hold.
    """
    own = sorted(state.bins[i], reverse=True)
    least = state.gap[i]  # a receiver has at most this gap
    best: tuple[int, list[int], int, list[int]] | None = None
    gives = [[a] for a in dict.fromkeys(own)]
    gives += {a + b: [a, b] for a, b in _pairs(own)}.values()
    single = len(set(own))
    state._take(i)
    try:
        for gap in sorted((g for g in state.at if g <= least), reverse=True):
            if best and gap <= best[0]:
                break  # no bin can take more than its gap
            mask, pairs = state.mask(gap)
            for give in gives:
                total = sum(give)
                moved, get = (total, []) if total <= gap else (0, [])
                if total > gap:
                    low = mask >> (total - gap)
                    if low:
                        smallest = total - gap + (low & -low).bit_length() - 1
                        if smallest < total:
                            moved, get = total - smallest, [smallest]
                if moved > (best[0] if best else 0):
                    best = (moved, give, state.holder(gap, get), get)
            if best and best[0] == gap:
                continue
            for give in gives[:single]:
                # the smallest two that keep the receiver within its gap
                least_two = max(0, give[0] - gap)
                low = pairs >> least_two
                total = least_two + (low & -low).bit_length() - 1
                if low and 0 < (moved := give[0] - total) > (best[0] if best else 0):
                    best = (moved, give, *state.holder_of_two(gap, total))
    finally:
        state._put(i)
    return best


def _pairs(own: list[int]) -> Iterator[tuple[int, int]]:
    """Every two lengths that a bin can give together, each two lengths once."""
    counts = Counter(own)
    lengths = list(counts)
    for n, a in enumerate(lengths):
        if counts[a] > 1:
            yield a, a
        for b in lengths[n + 1 :]:
            yield a, b


def local_search(bins: list[list[int]], capacity: int) -> list[list[int]]:
    """Empty bins by exchanges; each one increases the sum of squared fills, so the search ends.

    Bins are worked on from the emptiest on, each until it is empty or no exchange improves it, as long
    as the free room could still take in a bin.
    """
    state = _Bins(bins, capacity)
    spare = sum(state.gap) // capacity
    stuck: set[tuple[int, ...]] = set()  # contents without an exchange, as the bins stand
    for i in sorted(range(len(bins)), key=lambda k: -state.gap[k]):
        if not spare:
            break
        while state.bins[i] and 0 < state.gap[i]:
            items = tuple(sorted(state.bins[i]))
            if items in stuck:
                break
            found = _best_exchange(state, i)
            if not found:
                stuck.add(items)
                break
            _, give, j, get = found
            state.exchange(i, give, j, get)
            stuck.clear()
        spare -= not state.bins[i]
    return [items for items in state.bins if items]


def place(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of every piece."""
    order = np.argsort(-lengths, kind="stable")
    bins = local_search(best_fit(lengths[order].tolist(), capacity), capacity)
    # pieces of one length are interchangeable: hand them out in order
    waiting: dict[int, list[int]] = {}
    for row in order[::-1].tolist():
        waiting.setdefault(int(lengths[row]), []).append(row)
    number, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    for k, items in enumerate(bins):
        at = 0
        for length in items:
            row = waiting[length].pop()
            number[row], offset[row] = k, at
            at += length
    return number, offset


def pack(
    docs: DataFrame,
    tokenizer_path: str,
    ranks_path: str | None = None,
    end_id: int = 2,
    capacity: int = 1024,
    shard_rows: int = SHARD_ROWS,
) -> DataFrame:
    """Pack ``docs(doc_id, text)`` into sequences of at most ``capacity`` tokens, one row per piece.

    Returns ``(doc_id, piece, start, length, ids_crc32, sequence_id, offset)``. Null and empty texts
    have the end id alone; repeated rows are packed as often as they occur; null doc_ids stay; an
    empty table gives an empty result; other columns are ignored. ``tokenizer_path`` is a byte BPE
    file of ``tokenizers``, ``ranks_path`` optionally the same vocabulary for ``tiktoken``; executors
    have to be able to read both.
    """
    short = F.col("length") < capacity
    pieces, seen = stage_observed(
        tokenized(docs, tokenizer_path, ranks_path, end_id, capacity).withColumn("row", F.monotonically_increasing_id()),
        "pieces",
        short=F.count_if(short),
    )
    shards = max(1, -(-seen["short"] // shard_rows))
    whole = pieces.filter(~short).select(
        *_names(_PIECES), (F.col("row") * 2).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )

    def packed(table: pa.Table) -> pa.Table:
        table = table.sort_by("row")  # a repeated task packs a shard the same way
        number, offset = place(table["length"].to_numpy(), capacity)
        sequence = (table["shard"].to_numpy().astype(np.int64) << 32 | number) * 2 + 1
        kept = table.select(_names(_PIECES))
        return kept.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    dealt = pieces.filter(short).withColumn("shard", F.pmod(F.xxhash64("row"), F.lit(shards)).cast("int"))
    return whole.unionByName(dealt.groupBy("shard").applyInArrow(packed, _PLACED))


def _names(schema: str) -> list[str]:
    return [column.split()[0] for column in schema.split(", ")]
