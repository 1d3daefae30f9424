"""Exact top-k search by inner product with a KD-tree per shard (operator 2).

Vectors are dealt to shards of about ``SHARD_ROWS`` rows by a hash, so equal vectors, however many, spread. Each shard's tree
splits at the median of its widest dimension; every node keeps its tight bounding box. The largest inner product of a query
with any point of a box bounds a node, and nodes are visited best bound first until no bound can reach the
query's kth score. The search runs twice: in the query's own shard, which gives it a kth score, and then, starting from that
score, in all other shards; a shard whose root box cannot reach it is left at once. Queries stream through a shard in
batches, so a task holds one shard and one batch.

Vectors that are null, or hold a null or a non-finite component, take no part; nor do rows without id. A query meets vectors of its own number of
dimensions only. A row is its id and its whole-number vector: rows that repeat both are one row, and rows of one id with different vectors are rows
of their own, each a query if the id is asked for, which meet each other but never themselves. Ties go to the smaller id.
A vector so long that inner products or bounds of boxes might not be exact in doubles (2**53) fails the job. An empty table gives no rows. Columns other than the named ones are not read.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.storage import settle

SHARD_ROWS = 1024
LEAF_ROWS = 64
SCALE = 256
K = 5

#: Whole numbers up to this are exact in a double.
EXACT = 1 << 53

FOUND = "query_id bigint, query_key bigint, vec_id bigint, score bigint"


def whole_numbers(df: DataFrame, id_col: str, vector_col: str, scale: int = SCALE) -> DataFrame:
    """vec_id, vec (floor(scale * x) as whole numbers), key (a hash of the vector) and dims; only rows that take part."""
    values = F.transform(vector_col, lambda x: x.cast("double"))
    sound = F.col(vector_col).isNotNull() & F.forall(
        values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(math.inf))
    )
    scaled = F.transform(values, lambda x: F.floor(x * scale))
    # No sum of products of two vectors is above the larger of their sums of squares; a corner of a box of such
    # vectors is longer than they by the root of the number of dimensions at most.
    squares = F.aggregate(values, F.lit(0.0), lambda total, x: total + (F.abs(x * scale) + 1) * (F.abs(x * scale) + 1))
    exact = squares * F.sqrt(F.size(vector_col)) < EXACT
    too_long = F.raise_error(F.concat(F.lit("inner products would not be exact: vector "), F.col(id_col).cast("string")))
    rows = df.where(F.col(id_col).isNotNull() & sound).select(
        F.col(id_col).cast("bigint").alias("vec_id"), F.when(exact, scaled).otherwise(too_long.cast("array<bigint>")).alias("vec")
    )
    return rows.withColumns({"key": F.xxhash64("vec"), "dims": F.size("vec")}).dropDuplicates(["vec_id", "key"])


class Tree:
    """Median splits of whole-number vectors with tight boxes; nodes are numbered, children after their parent."""

    def __init__(self, ids: np.ndarray, keys: np.ndarray, points: np.ndarray, leaf_rows: int = LEAF_ROWS):
        self.ids, self.keys, self.points = ids, keys, points
        self.low: list[np.ndarray] = []
        self.high: list[np.ndarray] = []
        self.children: list[tuple[int, int] | None] = []
        self.rows: list[np.ndarray] = []
        self.split(np.arange(len(ids)), leaf_rows)
        self.lows, self.highs = np.array(self.low), np.array(self.high)

    def split(self, rows: np.ndarray, leaf_rows: int) -> int:
        own = self.points[rows]
        low, high = own.min(0), own.max(0)
        node = len(self.low)
        self.low.append(low)
        self.high.append(high)
        self.children.append(None)
        self.rows.append(rows)
        if len(rows) > leaf_rows and own.shape[1] and (high > low).any():
            widest = int((high - low).argmax())
            order = np.argsort(own[:, widest], kind="stable")
            half = len(rows) // 2
            left = self.split(rows[order[:half]], leaf_rows)
            right = self.split(rows[order[half:]], leaf_rows)
            self.children[node] = (left, right)
        return node

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """The largest inner product of each query (rows) with any point of each node's box."""
        return np.maximum(queries, 0) @ self.highs.T + np.minimum(queries, 0) @ self.lows.T

    def search(
        self, query: np.ndarray, bounds: np.ndarray, own_id: int, own_key: int, k: int, least: float
    ) -> list[tuple[int, int]]:
        """Up to k best (score, id) not below ``least``, best first; visits nodes best bound first."""
        best: list[tuple[float, int]] = []  # a heap of (score, -id), the worst on top
        queue = [(-bounds[0], 0)]
        while queue:
            bound, node = heapq.heappop(queue)
            # A node that only equals the kth score may still hold a smaller id.
            if -bound < least:
                break
            inner = self.children[node]
            if inner is not None:
                for child in inner:
                    if bounds[child] >= least:
                        heapq.heappush(queue, (-bounds[child], child))
                continue
            rows = self.rows[node]
            scores = self.points[rows] @ query
            reach = np.flatnonzero(scores >= least)
            if len(reach) > 2 * k:
                # The k + 1 best by (score, smaller id): one of them may be the query's own row.
                reach = reach[np.lexsort((self.ids[rows[reach]], -scores[reach]))[: k + 1]]
            for i in reach.tolist():
                row = rows[i]
                if self.ids[row] == own_id and self.keys[row] == own_key:
                    continue
                item = (float(scores[i]), -int(self.ids[row]))
                if len(best) < k:
                    heapq.heappush(best, item)
                elif item > best[0]:
                    heapq.heapreplace(best, item)
            if len(best) == k:
                least = max(least, best[0][0])
        return [(int(s), -i) for s, i in sorted(best, key=lambda x: (-x[0], -x[1]))]


def search_shards(vectors: DataFrame, asked: DataFrame, k: int) -> DataFrame:
    """Per query and shard its best rows. ``asked`` has query_id, query_key, vec, shard, dims and ``least`` (a known kth score or null)."""
    columns = ("shard", "dims", "kind", "id", "key", "vec", "least")
    rows = vectors.select("shard", "dims", F.lit(0).alias("kind"), F.col("vec_id").alias("id"), "key", "vec", F.lit(None).cast("bigint").alias("least"))
    wanted = asked.select("shard", "dims", F.lit(1).alias("kind"), F.col("query_id").alias("id"), F.col("query_key").alias("key"), "vec", "least")
    dealt = rows.unionByName(wanted).repartition("shard", "dims").sortWithinPartitions("shard", "dims", "kind")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here, gathered, tree = None, [], None

        def built() -> Tree | None:
            if not gathered:
                return None
            return Tree(*[np.concatenate([g[i] for g in gathered]) for i in range(3)])

        for batch in batches:
            shard, dims, kind = (batch.column(c).to_numpy() for c in columns[:3])
            ids, keys = batch.column("id").to_numpy(), batch.column("key").to_numpy()
            least = batch.column("least").to_pylist()
            vec = batch.column("vec")
            flat = vec.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            at = np.concatenate(([0], np.cumsum(dims)))
            # Stretches of rows of one shard, number of dimensions and kind.
            turn = np.flatnonzero((np.diff(shard) != 0) | (np.diff(dims) != 0) | (np.diff(kind) != 0)) + 1
            for a, b in zip([0, *turn.tolist()], [*turn.tolist(), len(shard)]):
                if a == b:
                    continue
                if (shard[a], dims[a]) != here:
                    here, gathered, tree = (shard[a], dims[a]), [], None
                points = flat[at[a] : at[b]].reshape(b - a, dims[a])
                if kind[a] == 0:
                    gathered.append((ids[a:b], keys[a:b], points))
                    continue
                if tree is None:
                    tree = built()
                if tree is None:
                    continue
                out = []
                for low in range(a, b, 512):
                    asked_here = points[low - a : min(low + 512, b) - a]
                    bounds = tree.bounds(asked_here)
                    for q, i in enumerate(range(low, min(low + 512, b))):
                        floor = -math.inf if least[i] is None else least[i]
                        if bounds[q, 0] < floor:
                            continue
                        for score, other in tree.search(asked_here[q], bounds[q], ids[i], keys[i], k, floor):
                            out.append((ids[i], keys[i], other, score))
                if out:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in zip(*out)], names=["query_id", "query_key", "vec_id", "score"]
                    )

    return dealt.mapInArrow(found, FOUND)


def best(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query with their ``rank``."""
    order = Window.partitionBy("query_id", "query_key").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(
    df: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K, scale: int = SCALE
) -> DataFrame:
    """query_id, rank, vec_id and score of the ``k`` largest inner products of every query row with the other rows."""
    vectors = whole_numbers(df, id_col, vector_col, scale)
    rows = df.agg(F.count(F.lit(1))).first()[0]
    shards = max(1, math.ceil(rows / SHARD_ROWS))
    dealt = settle(vectors.withColumn("shard", F.pmod(F.xxhash64("vec_id", "key"), F.lit(shards)).cast("int")))
    asked = dealt.where(is_query).select(
        F.col("vec_id").alias("query_id"), F.col("key").alias("query_key"), "vec", "dims", F.col("shard").alias("home")
    )
    first = settle(
        search_shards(
            dealt, asked.select("query_id", "query_key", "vec", "dims", F.col("home").alias("shard"), F.lit(None).cast("bigint").alias("least")), k
        )
    )
    kth = best(first, k).where(F.col("rank") == k).select("query_id", "query_key", F.col("score").alias("least"))
    known = asked.join(kth, ["query_id", "query_key"], "left")
    everywhere = known.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1)))).where("shard <> home")
    rest = search_shards(dealt, everywhere, k)
    return best(first.unionByName(rest), k).select("query_id", "rank", "vec_id", "score")
