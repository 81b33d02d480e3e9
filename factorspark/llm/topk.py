"""Exact top-k search by inner product: ball trees per shard, branch and bound.

Rows are dealt into shards, shards into chains, queries into blocks and blocks into lanes, all of
bounded size; a task has one chain and one lane. It holds the lane's queries and reads its shards one
by one: it builds the ball tree of a shard once and lets every query of the lane go down. A node is
followed only if its upper bound, ``q . centre + |q| * radius``, reaches the query's current kth
score, and each query opens its leaves in the order of their bounds. The kth score is shared: first
every block searches one shard, what it finds there is the floor from which all chains start, and
a chain hands the risen floor from shard to shard. What reaches the final merge is k rows for a query
and chain at most.

Scores are integers and exact: products run in floating point only while all sums are below 2^53.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factorspark.sources.staging import stage_observed

SHARD_ROWS = 16_384
BLOCK_ROWS = 8_192
CHAIN_SHARDS = 16
LANE_VALUES = 1 << 22  # components of the queries that a task holds, one block at least
TASKS_PER_CORE = 4  # chains and lanes get longer only while this many tasks are left
CELLS = 1 << 21  # scores of a leaf that are held at a time
LEAF_ROWS = 128
FLOOR = np.iinfo(np.int64).min

_HITS = "query long, query_id long, vec_id long, row long, score long"


def quantised(vectors: DataFrame, scale: int) -> DataFrame:
    """``vectors(vec_id, embedding)`` to ``(vec_id, row, dim, v)``, v the floor of scale * component.

    Without the vectors that are null, empty, hold a null or non-finite component, or are so large
    that a sum of squares could leave the range of a long.
    """
    parts = F.transform("embedding", lambda x: F.floor(x.cast("double") * scale))
    limit = F.lit(2.0**62) / F.greatest(F.size("embedding"), F.lit(1))
    sound = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double") * scale) < F.sqrt(limit) - 1))
    return vectors.filter(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & sound).select(
        "vec_id", F.monotonically_increasing_id().alias("row"), F.size("embedding").alias("dim"), parts.alias("v")
    )


def matrix(column: pa.ListArray | pa.ChunkedArray, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


class BallTree:
    """Nodes as arrays: centre, radius, and the range of rows; children of node n are listed."""

    def __init__(self, points: np.ndarray, leaf_rows: int = LEAF_ROWS):
        self.order = np.arange(len(points))
        self.centre: list[np.ndarray] = []
        self.radius: list[float] = []
        self.range: list[tuple[int, int]] = []
        self.children: list[list[int]] = []
        todo = [(0, len(points), -1)]
        while todo:
            start, end, parent = todo.pop()
            own = points[self.order[start:end]].astype(np.float64)
            centre = own.mean(axis=0)
            away = np.sqrt(((own - centre) ** 2).sum(axis=1))
            node = len(self.centre)
            self.centre.append(centre)
            self.radius.append(float(away.max()))
            self.range.append((start, end))
            self.children.append([])
            if parent >= 0:
                self.children[parent].append(node)
            if end - start > leaf_rows and self.radius[node] > 0:
                # halves along the line from the farthest point to the one farthest from that
                far = own[away.argmax()]
                other = own[((own - far) ** 2).sum(axis=1).argmax()]
                along = own @ (other - far)
                half = (end - start) // 2
                split = np.argpartition(along, half)
                self.order[start:end] = self.order[start:end][split]
                todo += [(start, start + half, node), (start + half, end, node)]

    def bounds(self, nodes: list[int], queries: np.ndarray, norms: np.ndarray) -> np.ndarray:
        """Upper bounds of the inner products, with room for rounding."""
        centre = np.array([self.centre[n] for n in nodes])
        radius = np.array([self.radius[n] for n in nodes])
        reach = norms[:, None] * radius
        return queries @ centre.T + reach + 1e-9 * (reach + norms[:, None] * np.linalg.norm(centre, axis=1)) + 1e-6


def _best(who: np.ndarray, score: np.ndarray, tie: np.ndarray, k: int) -> np.ndarray:
    """Indexes of the k highest scores of each ``who``, ties to the smaller ``tie``."""
    order = np.lexsort((tie, -score, who))
    first = np.r_[True, who[order][1:] != who[order][:-1]]
    rank = np.arange(len(order)) - np.flatnonzero(first)[np.cumsum(first) - 1]
    return order[rank < k]


def search(
    points: np.ndarray,
    rows: np.ndarray,
    ties: np.ndarray,
    queries: np.ndarray,
    own: np.ndarray,
    floor: np.ndarray,
    k: int,
    tree: BallTree | None = None,
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, point, score) of each query's best k points that reach its floor.

    ``own`` is each query's own row, which it never finds; ``ties`` orders points of equal score;
    ``tree`` is the tree of the points, if there is one already.
    """
    top = max(np.abs(points).max(initial=0), np.abs(queries).max(initial=0))
    kind = np.float64 if float(top) ** 2 * points.shape[1] < 2**53 else np.int64
    tree = tree or BallTree(points)
    exact_points, exact_queries = points.astype(kind), queries.astype(kind)
    asking = queries.astype(np.float64)
    norms = np.linalg.norm(asking, axis=1)
    floor = floor.copy()
    found = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))

    # down to the leaves, without the nodes whose bound is below the shared kth score
    alive = {0: np.arange(len(queries))}
    leaves: list[int] = []
    entry: list[tuple[np.ndarray, np.ndarray, int]] = []
    while alive:
        below: dict[int, np.ndarray] = {}
        for node, who in alive.items():
            bound = tree.bounds([node], asking[who], norms[who])[:, 0]
            keep = bound >= floor[who]
            if not tree.children[node]:
                entry.append((who[keep], bound[keep], node))
                leaves.append(node)
            elif keep.any():
                below.update(dict.fromkeys(tree.children[node], who[keep]))
        alive = below
    if not entry:
        return found
    who = np.concatenate([w for w, _, _ in entry])
    bound = np.concatenate([b for _, b, _ in entry])
    leaf = np.concatenate([np.full(len(w), n) for w, _, n in entry])
    order = np.lexsort((-bound, who))
    who, bound, leaf = who[order], bound[order], leaf[order]
    first = np.r_[True, who[1:] != who[:-1]] if len(who) else np.empty(0, bool)
    turn = np.arange(len(who)) - np.flatnonzero(first)[np.cumsum(first) - 1] if len(who) else who
    for step in range(int(turn.max(initial=-1)) + 1):
        # every query's next best leaf, unless its bound has fallen below the kth score
        now = (turn == step) & (bound >= floor[who])
        if not now.any():
            break
        parts = [found]
        for node in np.unique(leaf[now]).tolist():
            here = who[now & (leaf == node)]
            start, end = tree.range[node]
            members = tree.order[start:end]
            members = members[np.argsort(ties[members])]
            # a leaf of many equal points is searched for a few queries at a time, and each keeps its best k
            step_rows = max(1, CELLS // len(members))
            for asked in (here[a : a + step_rows] for a in range(0, len(here), step_rows)):
                scores = (exact_queries[asked] @ exact_points[members].T).astype(np.int64)
                hit = (scores >= floor[asked][:, None]) & (rows[members][None, :] != own[asked][:, None])
                if len(members) > k:
                    hit &= _best_of_leaf(np.where(hit, scores, np.iinfo(np.int64).min), k)
                i, j = np.nonzero(hit)
                parts.append((asked[i], members[j], scores[i, j]))
        asked, point, score = (np.concatenate(x) for x in zip(*parts))
        best = _best(asked, score, ties[point], k)
        found = (asked[best], point[best], score[best])
        # the kth score so far is a new floor
        counts = np.bincount(found[0], minlength=len(queries))
        lowest = np.full(len(queries), np.iinfo(np.int64).max)
        np.minimum.at(lowest, found[0], found[2])
        floor = np.where(counts >= k, np.maximum(floor, lowest), floor)
    return found


def _best_of_leaf(scores: np.ndarray, k: int) -> np.ndarray:
    """Which of each row's scores are its best k, the first ones of equal scores."""
    kth = np.partition(scores, -k, axis=1)[:, -k][:, None]
    above, equal = scores > kth, scores == kth
    return above | (equal & (np.cumsum(equal, axis=1) <= k - above.sum(axis=1)[:, None]))


def _tie_order(ids: pa.Array, rows: np.ndarray) -> np.ndarray:
    """Position of every row by (vec_id, null last, row)."""
    known = np.array(ids.is_valid())
    values = ids.fill_null(0).to_numpy(zero_copy_only=False)
    position = np.empty(len(rows), np.int64)
    position[np.lexsort((rows, values, ~known))] = np.arange(len(rows))
    return position


_TASK = ["dim", "chain", "lane"]


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple, pa.Table]]:
    """Rows that follow each other with the same task and shard, as ``(dim, chain, lane, shard)`` and table."""
    key, parts = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.stack([batch.column(name).to_numpy() for name in [*_TASK, "shard"]], axis=1)
        starts = np.r_[0, np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1, len(keys)]
        for start, end in zip(starts[:-1].tolist(), starts[1:].tolist()):
            this = tuple(keys[start].tolist())
            if parts and this != key:
                yield key, pa.Table.from_batches(parts)
                parts = []
            key = this
            parts.append(batch.slice(start, end - start))
    if parts:
        yield key, pa.Table.from_batches(parts)


class _Lane:
    """Queries of a task, their floors, and the best k rows that each has found so far."""

    def __init__(self, table: pa.Table, dim: int, k: int):
        self.k = k
        self.ids = table["vec_id"].combine_chunks()
        self.own = table["row"].to_numpy()
        self.home = table["home"].to_numpy()
        self.floor = table["floor"].combine_chunks().fill_null(FLOOR).to_numpy(zero_copy_only=False).copy()
        self.queries = matrix(table["v"], dim)
        # (query, vec_id, vec_id is null, row, score) of what was found
        self.found = [np.empty(0, np.int64) for _ in range(5)]

    def meet(self, shard: int, table: pa.Table, dim: int, block_rows: int) -> None:
        """Search the shard for all queries but those that have done so before."""
        ids, rows, points = table["vec_id"].combine_chunks(), table["row"].to_numpy(), matrix(table["v"], dim)
        known, values = np.array(ids.is_valid()), ids.fill_null(0).to_numpy(zero_copy_only=False)
        ties, tree = _tie_order(ids, rows), BallTree(points)
        waiting = np.flatnonzero(self.home != shard)
        for block in (waiting[a : a + block_rows] for a in range(0, len(waiting), block_rows)):
            who, point, score = search(
                points, rows, ties, self.queries[block], self.own[block], self.floor[block], self.k, tree
            )
            new = [block[who], values[point], (~known[point]).astype(np.int64), rows[point], score]
            among = np.isin(self.found[0], block)
            asked, vec, null, row, score = (np.concatenate([old[among], x]) for old, x in zip(self.found, new))
            place = np.empty(len(row), np.int64)
            place[np.lexsort((row, vec, null))] = np.arange(len(row))
            best = _best(asked, score, place, self.k)
            kept = [x[best] for x in (asked, vec, null, row, score)]
            self.found = [np.concatenate([old[~among], x]) for old, x in zip(self.found, kept)]
            # the kth score so far is the floor of the next shard
            counts = np.bincount(kept[0], minlength=len(self.own))
            lowest = np.full(len(self.own), np.iinfo(np.int64).max)
            np.minimum.at(lowest, kept[0], kept[4])
            self.floor = np.where(counts >= self.k, np.maximum(self.floor, lowest), self.floor)

    def hits(self) -> pa.RecordBatch:
        who, vec, null, row, score = self.found
        columns = [
            pa.array(self.own[who]),
            self.ids.take(pa.array(who)),
            pa.array(vec, mask=null.astype(bool)),
            pa.array(row),
            pa.array(score),
        ]
        return pa.RecordBatch.from_arrays(columns, ["query", "query_id", "vec_id", "row", "score"])


def _searched(members: DataFrame, asking: DataFrame, k: int, block_rows: int) -> DataFrame:
    """Search of every chain by the lanes that share ``dim``, ``chain`` and ``lane`` with it.

    ``members`` has the shard of each row; ``asking`` the floor of each query and its home, the shard
    that it does not search again. Queries come before the shards of their task, which are read one by one.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, lane = None, None
        for key, table in _runs(batches):
            *this, shard = key
            if this != task:
                if lane is not None:
                    yield lane.hits()
                task, lane = this, None
            if shard < 0:
                lane = _Lane(table, this[0], k)
            elif lane is not None:
                lane.meet(shard, table, this[0], block_rows)
        if lane is not None:
            yield lane.hits()

    own = [*_TASK, "shard", "home", "floor", "vec_id", "row", "v"]
    points = members.withColumns({"home": F.lit(-1), "floor": F.lit(None).cast("long")})
    both = asking.withColumn("shard", F.lit(-1)).select(own).unionByName(points.select(own))
    dealt = both.repartition(*_TASK).sortWithinPartitions(*_TASK, "shard", "row")
    return dealt.mapInArrow(rows, _HITS)


def _each(numbers: int) -> Column:
    """One row for each number from 0."""
    return F.explode(F.sequence(F.lit(0), F.lit(numbers - 1)))


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    scale: int = 64,
    shard_rows: int = SHARD_ROWS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The k rows with the highest inner product for every query row of ``vectors(vec_id, embedding)``.

    Returns ``(query_id, rank, vec_id, score)``. Components become ``floor(scale * x)``. Ties go to
    the smaller vec_id (null last, then the staged order); a query finds all rows but its own, and
    fewer than k if there are fewer. Vectors that are null, empty, or hold a null or non-finite
    component take no part, nor do those whose scores a long cannot hold; vectors only meet vectors
    of their own length. Repeated rows are rows of their own. A null vec_id is found like others and
    is a query if ``is_query`` says so. An empty table gives an empty result; other columns are ignored.
    """
    sound = quantised(vectors, scale).withColumn("asks", F.coalesce(is_query, F.lit(False)))
    figures = {"rows": F.count("*"), "asking": F.count_if("asks"), "dim": F.max("dim")}
    sound, seen = stage_observed(sound, "vectors", **figures)
    shards, blocks = max(1, -(-seen["rows"] // shard_rows)), max(1, -(-seen["asking"] // block_rows))
    tasks = max(1, TASKS_PER_CORE * vectors.sparkSession.sparkContext.defaultParallelism)
    chain = max(1, min(CHAIN_SHARDS, shards * blocks // tasks))
    chains = -(-shards // chain)
    lane = max(1, min(LANE_VALUES // (block_rows * (seen["dim"] or 1)), chains * blocks // tasks))
    lanes = -(-blocks // lane)

    spread = F.xxhash64("row")
    members = sound.withColumn("shard", F.pmod(spread, F.lit(shards)).cast("int")).drop("asks")
    asking = sound.filter("asks").withColumn("block", F.pmod(spread, F.lit(blocks)).cast("int")).drop("asks")
    asking = asking.withColumn("home", F.col("block") % shards)  # the first shard of a block

    # first every block searches its home: a chain of one shard and a lane of one block
    of_home = F.filter(F.sequence(F.lit(0), F.lit(blocks - 1)), lambda b: b % shards == F.col("shard"))
    first = _searched(
        members.withColumns({"chain": F.col("shard"), "lane": F.explode(of_home)}),
        asking.withColumns(
            {"chain": F.col("home"), "lane": F.col("block"), "home": F.lit(-1), "floor": F.lit(None).cast("long")}
        ),
        k,
        block_rows,
    )
    first, _ = stage_observed(first, "first", rows=F.count("*"))
    if shards == 1:
        found = first
    else:
        floors = first.groupBy("query").agg(F.min("score").alias("lowest"), F.count("*").alias("n"))
        known = asking.join(floors, F.col("row") == F.col("query"), "left").withColumn(
            "floor", F.when(F.col("n") >= k, F.col("lowest"))
        )
        rest = _searched(
            members.withColumns({"chain": F.floor(F.col("shard") / chain).cast("int"), "lane": _each(lanes)}),
            known.withColumns({"chain": _each(chains), "lane": F.floor(F.col("block") / lane).cast("int")}),
            k,
            block_rows,
        )
        found = first.unionByName(rest)
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "row")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
