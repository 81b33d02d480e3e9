"""SimHash near-duplicates: BK-trees over shards of fingerprints.

Shards. A fingerprint is cut into ``radius + 2`` blocks. Two fingerprints within ``radius`` bits
agree in at least two blocks, so they share one of the shards keyed by a pair of block values.
With the default radius that is 15 shards of about 2^21 values: a shard stays small when the corpus
grows, and no pair is lost. Copies are one fingerprint before any of this.

Trees. Each shard has a BK-tree: the children of a node are keyed by their Hamming distance to it,
and a search follows only the edges within ``radius`` of its own distance to the node. A tree stays
in the task that holds its shard: all trees together grow with the corpus, so sending them to every
executor would have no bound. Shards above ``SHARD_ROWS`` are dealt into parts, and every
two parts meet in a task of their own.

Links. A tree reports one link for each component it joins, not one for each pair, so a group of
thousands of near copies gives thousands of links. ``components`` does the rest.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factorspark.llm.batches import small_batches
from factorspark.llm.components import connected_components
from factorspark.sources.staging import stage

SEED = 42
BITS = 64
SHARD_ROWS = 4096


def fingerprint(text: bytes | None, width: int) -> int:
    """SimHash of the lower-cased words; 0 for a text without words.

    Words are separated by the six ASCII white-space characters, which is what ``bytes.split`` does,
    and ``bytes.lower`` changes A-Z only.
    """
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        hashes = [xxhash.xxh64_intdigest(joined, SEED)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        starts = (ends - lengths)[: len(words) - width + 1].tolist()
        digest = xxhash.xxh64_intdigest
        hashes = [digest(joined[s:e], SEED) for s, e in zip(starts, ends[width - 1 :].tolist())]
    return majority(np.array(hashes, np.uint64))


def majority(hashes: np.ndarray) -> int:
    """Bits that are set in over half of the hashes."""
    counts = np.zeros(BITS, np.int64)
    for first in range(0, len(hashes), 1 << 16):
        octets = hashes[first : first + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def with_fingerprints(docs: DataFrame, width: int) -> DataFrame:
    """``docs(doc_id, text)`` to ``(doc_id, fp)``; fp is the fingerprint as a signed long."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1).cast(pa.binary()).to_pylist()
            found = np.array([fingerprint(text, width) for text in texts], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found)], ["doc_id", "fp"])

    return small_batches(docs).select("doc_id", "text").mapInArrow(rows, "doc_id long, fp long")


def shard_keys(fp: str, radius: int) -> list:
    """One long per pair of blocks: the number of the pair, then the two block values."""
    blocks = radius + 2
    edges = [round(BITS * i / blocks) for i in range(blocks + 1)]
    values = [
        F.shiftrightunsigned(F.col(fp), low).bitwiseAND(F.lit((1 << (high - low)) - 1))
        for low, high in zip(edges, edges[1:])
    ]
    room = max(high - low for low, high in zip(edges, edges[1:]))
    if 2 * room > 56:
        raise ValueError("radius too small for shards of block pairs")
    return [
        F.lit(k << (2 * room)) + F.shiftleft(values[i], room) + values[j]
        for k, (i, j) in enumerate(combinations(range(blocks), 2))
    ]


def bk_tree(points: np.ndarray) -> tuple[int, dict]:
    """(index of the point, children by distance); every subtree starts with its first point.

    The points have to be distinct. Built by parts instead of point by point: what shares a
    distance to the root forms that child's subtree, exactly as repeated insertion would have it.
    """
    tree: tuple[int, dict] = (0, {})
    todo = [(tree, np.arange(1, len(points)))]
    while todo:
        (root, children), rest = todo.pop()
        if len(rest) == 0:
            continue
        apart = np.bitwise_count(points[rest] ^ points[root])
        for edge in np.unique(apart).tolist():
            members = rest[apart == edge]
            children[edge] = (int(members[0]), {})
            todo.append((children[edge], members[1:]))
    return tree


def bk_links(points: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links (as indexes) that connect all points within ``radius`` of each other, directly or not.

    All points search the tree together. A point meets only nodes inserted before it; the later
    ones meet it in turn. A link is kept if it joins two parts that were not yet connected.
    """
    part = np.arange(len(points))
    links: list[tuple[int, int]] = []
    todo = [(bk_tree(points), np.arange(1, len(points)))]
    while todo:
        (root, children), asking = todo.pop()
        apart = np.bitwise_count(points[asking] ^ points[root]).astype(np.int64)
        near = asking[apart <= radius]
        joined, first = np.unique(part[near], return_index=True)
        new = joined != part[root]
        if new.any():
            links += [(root, int(near[k])) for k in first[new]]
            part[np.isin(part, joined[new])] = part[root]
        for edge, child in children.items():
            going = asking[(np.abs(apart - edge) <= radius) & (asking > child[0])]
            if len(going):
                todo.append((child, going))
    return links


def near_links(nodes: DataFrame, radius: int) -> DataFrame:
    """``nodes(fp)``, distinct, to links (a, b) that connect what lies within ``radius`` bits."""
    keyed = nodes.select("fp", F.explode(F.array(*shard_keys("fp", radius))).alias("shard"))
    sizes = keyed.groupBy("shard").count().filter("count > 1")
    parts = F.ceil(F.col("count") / SHARD_ROWS).cast("int")
    other = F.sequence(F.lit(0), parts - 1)
    own = F.pmod(F.xxhash64("fp"), parts).cast("int")
    dealt = (
        keyed.join(sizes, "shard")
        .select("shard", "fp", own.alias("own"), F.explode(other).alias("other"))
        .select("shard", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "fp")
    )
    groups = dealt.repartition("shard", "i", "j").groupBy("shard", "i", "j").agg(F.collect_list("fp").alias("fps"))

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(0)
            flat = column.flatten().to_numpy().view(np.uint64)
            bounds = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())])
            out: set[tuple[int, int]] = set()
            for start, end in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                points = flat[start:end]
                out.update((int(points[i]), int(points[j])) for i, j in bk_links(points, radius))
            both = np.array(sorted(out), np.uint64).reshape(-1, 2).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

    return groups.select("fps").mapInArrow(rows, "a long, b long")


def near_duplicates(docs: DataFrame, width: int = 4, radius: int = 4) -> DataFrame:
    """Every row of ``docs(doc_id, text)`` with its fingerprint and component.

    Returns ``(doc_id, fp, component_id)``: the fingerprint as a signed long, and the smallest
    doc_id among all rows that links within ``radius`` bits lead to, the row itself included. A null
    or wordless text has fingerprint 0 and links like any other; repeated rows share a component;
    a component without any doc_id has a null id; an empty table gives an empty result. Other
    columns of ``docs`` are ignored.
    """
    marked = stage(with_fingerprints(docs, width), "fingerprints")
    return marked.join(component_of(marked, radius), "fp").select("doc_id", "fp", "component_id")


def component_of(marked: DataFrame, radius: int) -> DataFrame:
    """``marked(doc_id, fp)``, staged, to one row ``(fp, root, component_id)`` per fingerprint."""
    nodes = stage(marked.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "nodes")
    roots = connected_components(near_links(nodes.select("fp"), radius))
    rooted = nodes.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rooted.join(smallest, "root").select("fp", "root", "component_id")


def one_of_each(docs: DataFrame, width: int = 4, radius: int = 4) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each component the smallest doc_id stays.

    A null doc_id stays only if its component has no other, and of repeated rows one stays.
    """

    @F.pandas_udf("long")
    def marked_text(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            found = [fingerprint(text.encode() if text else None, width) for text in texts]
            yield pd.Series(np.array(found, np.uint64).view(np.int64))

    marked = stage(
        small_batches(docs).select(
            F.struct(*[F.col(f"`{name}`") for name in docs.columns]).alias("row"),
            "doc_id",
            marked_text("text").alias("fp"),
            F.monotonically_increasing_id().alias("place"),
        ),
        "marked",
    )
    placed = marked.select("doc_id", "fp", "place").join(component_of(marked.select("doc_id", "fp"), radius), "fp")
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "place")).alias("first")
    kept = placed.groupBy("root").agg(first).select(F.col("root").alias("of"), F.col("first.place").alias("stays"))
    # the rows that go are the smaller table
    gone = placed.join(kept, F.col("root") == F.col("of")).filter("place != stays").select("place")
    return marked.join(gone, "place", "left_anti").select("row.*")


def hex_fingerprint(fp: str = "fp"):
    """Sixteen lower-case hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
