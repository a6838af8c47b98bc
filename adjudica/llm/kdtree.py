"""Exact top-k search with one KD-tree per shard."""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from adjudica.llm.common import ORACLE, query
from adjudica.session import materialise

LEAF = 128
ROWS_PER_SHARD = 8192
QUERIES_PER_BLOCK = 128
_NONE = np.iinfo(np.int64).min


class Tree:
    """Median splits of a shard's points along their widest component, with the tight box of every node."""

    def __init__(self, ids: np.ndarray, points: np.ndarray) -> None:
        order = np.arange(len(ids))
        spans, children, low, high = [(0, len(ids))], [(-1, -1)], [], []
        for node, (a, b) in enumerate(spans):
            box = points[order[a:b]]
            low.append(box.min(axis=0))
            high.append(box.max(axis=0))
            width = high[-1] - low[-1]
            if b - a > LEAF and width.size and width.max() > 0:
                middle = (b - a) // 2
                order[a:b] = order[a:b][np.argpartition(box[:, int(width.argmax())], middle)]
                children[node] = len(spans), len(spans) + 1
                spans += [(a, a + middle), (a + middle, b)]
                children += [(-1, -1)] * 2
        self.ids, self.points = ids[order], points[order]
        self.spans, self.children = spans, children
        self.low, self.high = np.array(low), np.array(high)

    def search(self, query_ids: np.ndarray, queries: np.ndarray, k: int, known: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
        """Ids and scores of the k best points of each query, those left out that score below ``known``.

        Nodes are visited by the largest inner product their box allows. The search of a query ends at the first node
        that allows less than its kth score so far, which starts at what other shards have found already.
        """
        # Products of doubles are exact while they stay below 2**53.
        reach = max(1, int(np.abs(queries).max(initial=0))) * max(1, int(np.abs(self.points).max(initial=0))) * max(1, queries.shape[1])
        kind = np.float64 if reach < 1 << 53 else np.int64
        points, queries = self.points.astype(kind), queries.astype(kind)
        bounds = np.maximum(queries, 0) @ self.high.astype(kind).T + np.minimum(queries, 0) @ self.low.astype(kind).T
        out = []
        for own, vector, bound, least in zip(query_ids, queries, bounds.tolist(), known.tolist()):
            ids, scores = np.zeros(0, np.int64), np.zeros(0, np.int64)
            heap = [(-bound[0], 0)]
            while heap and -heap[0][0] >= least:
                _, node = heapq.heappop(heap)
                left, right = self.children[node]
                if left >= 0:
                    for child in (left, right):
                        if bound[child] >= least:
                            heapq.heappush(heap, (-bound[child], child))
                    continue
                a, b = self.spans[node]
                found = (points[a:b] @ vector).astype(np.int64)
                keep = (found >= least) & (self.ids[a:b] != own)
                ids, scores = np.concatenate((ids, self.ids[a:b][keep])), np.concatenate((scores, found[keep]))
                if len(ids) > k:
                    best = np.lexsort((ids, -scores))[:k]
                    ids, scores = ids[best], scores[best]
                if len(ids) == k:
                    least = max(least, int(scores.min()))
            out.append((ids, scores))
        return out


def _matrix(column: pa.ListArray | pa.ChunkedArray, rows: int) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(rows, -1)


def _build(table: pa.Table) -> pa.Table:
    tree = Tree(table.column("id").to_numpy(), _matrix(table.column("v"), table.num_rows))
    return pa.table({"dim": table.column("dim")[:1], "shard": table.column("shard")[:1], "tree": pa.array([pickle.dumps(tree)], pa.binary())})


def _block(table: pa.Table) -> pa.Table:
    ids, vectors = table.column("id").to_numpy(), _matrix(table.column("v"), table.num_rows)
    known = np.full(len(ids), _NONE)
    return pa.table({"dim": table.column("dim")[:1], "block": table.column("block")[:1], "queries": pa.array([pickle.dumps((ids, vectors, known))], pa.binary())})


_FOUND = "dim int, block int, queries binary, query_id array<long>, vec_id array<array<long>>, score array<array<long>>"


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                tree = pickle.loads(batch.column("tree")[i].as_py())
                ids, vectors, known = pickle.loads(batch.column("queries")[i].as_py())
                found = tree.search(ids, vectors, k, known)
                kth = np.array([s.min() if len(s) == k else _NONE for _, s in found], np.int64)
                lists = pa.list_(pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("dim")[i : i + 1], batch.column("block")[i : i + 1],
                        pa.array([pickle.dumps((ids, vectors, np.maximum(known, kth)))], pa.binary()),
                        pa.array([ids], pa.list_(pa.int64())),
                        pa.array([[x.tolist() for x, _ in found]], lists), pa.array([[x.tolist() for _, x in found]], lists),
                    ],
                    ["dim", "block", "queries", "query_id", "vec_id", "score"],
                )

    return run


def quantised(vectors: DataFrame, key: str, vector: str) -> DataFrame:
    """Columns id, v (components as whole numbers of 1/1024) and dim; unusable vectors and null ids are left out."""
    usable = F.col(vector).isNotNull() & F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    rows = vectors.where(usable & F.col(key).isNotNull())
    return rows.select(
        F.col(key).cast("long").alias("id"),
        F.transform(vector, lambda x: F.floor(x.cast("double") * 1024).cast("long")).alias("v"),
        F.size(vector).alias("dim"),
    )


def top_k(candidates: DataFrame, queries: DataFrame, k: int = 10, key: str = "vec_id", vector: str = "embedding", rows_per_shard: int = ROWS_PER_SHARD) -> DataFrame:
    """The k candidates with the largest inner product for each query, ties to the smaller id; exact.

    Candidates are dealt by a hash of their id into shards of about ``rows_per_shard`` rows, each with its own tree.
    Queries go in blocks. Every block first searches one shard; the kth score it finds there goes with it to all the
    others, which need to look no further than that. The shards' lists, k each at most, are merged by rank.

    Vectors that are null or hold null, NaN or infinite components take no part, nor do null ids. A query is compared with
    vectors of as many components as it has, but not with those of its own id. Repeated candidates are separate
    rows of the result; repeated queries are answered once. Other columns are left out; empty tables give no rows.

    Returns query_id, rank (from 1), vec_id and score.
    """
    points = quantised(candidates, key, vector)
    shards = max(1, -(-points.count() // rows_per_shard))
    asked = quantised(queries, key, vector).dropDuplicates(["id"])
    blocks = max(1, -(-asked.count() // QUERIES_PER_BLOCK))
    number = F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")
    trees = materialise(
        points.withColumn("shard", number).groupBy("dim", "shard").applyInArrow(_build, "dim int, shard int, tree binary"), "trees"
    )
    packed = asked.withColumn("block", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(blocks)).cast("int"))
    packed = packed.groupBy("dim", "block").applyInArrow(_block, "dim int, block int, queries binary")
    # A dimension may have fewer shards than there are numbers, so the first one is taken from those it has.
    homes = trees.groupBy("dim").agg(F.sort_array(F.collect_list("shard")).alias("shards"))
    routed = materialise(
        packed.join(homes, "dim").withColumn("home", F.get("shards", F.pmod("block", F.size("shards")))), "blocks"
    )
    columns = ["dim", "block", "queries", "tree"]
    at_home = routed.withColumn("shard", F.col("home")).join(trees, ["dim", "shard"]).select(*columns)
    first = materialise(at_home.mapInArrow(_search(k), _FOUND), "first")
    onward = first.select("dim", "block", "queries").join(routed.drop("queries"), ["dim", "block"])
    onward = onward.withColumn("shard", F.explode("shards")).where("shard <> home")
    others = onward.join(trees, ["dim", "shard"]).select(*columns).mapInArrow(_search(k), _FOUND)
    lists = first.union(others).select(F.explode(F.arrays_zip("query_id", "vec_id", "score")).alias("q"))
    hits = lists.select("q.query_id", F.explode(F.arrays_zip("q.vec_id", "q.score")).alias("h")).select("query_id", "h.vec_id", "h.score")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return hits.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


@query
def op9_kd_tree_search(spark, sf):
    """The 10 best partners of every vector whose id is divisible by 100, among all others."""
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding")
    return top_k(vectors, vectors.where("vec_id % 100 = 0"))


ORACLE["op9_kd_tree_search"] = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS q FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON len(a.q) = len(b.q) AND a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""
