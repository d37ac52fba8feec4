"""Exact top-k inner products with a KD-tree per shard.

Rows are dealt to shards by a hash of their id. In each shard a tree is built
by splitting the points at the median of the widest side of their box; every
node keeps the tight box of its points. A query walks a tree best first: the
bound of a node is the largest inner product that its box allows, and the walk
ends when the best bound left is below the kth score so far. A first round
searches one shard per block of queries; the kth score found there goes along
to all other shards, where most of each tree is then cut off at once.

Trees are written to the shared folder once. Queries go in blocks, so a task
holds one tree and one block however many rows or queries there are.
"""

from __future__ import annotations

import heapq
import io

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyhawk.llm.common import saved

SHARD_ROWS, BLOCK_ROWS, LEAF_ROWS = 4096, 2048, 32
SCALE = 256
#: scaled components are held within this, scores within what a long holds
LIMIT = 1 << 62
LOWEST, HIGHEST = -1 << 63, (1 << 63) - 1


def build(points: np.ndarray, ids: np.ndarray, leaf: int = LEAF_ROWS) -> dict[str, np.ndarray]:
    """A tree as arrays: points and ids in leaf order; per node the box (low,
    high), the rows (start, end) and the children (-1 in a leaf)."""
    order = np.argsort(ids, kind="stable")
    nodes: list[list] = []
    todo = [(0, len(order), -1, 0)]
    while todo:
        start, end, parent, side = todo.pop()
        own = points[order[start:end]]
        low, high = own.min(axis=0), own.max(axis=0)
        if parent >= 0:
            nodes[parent][4 + side] = len(nodes)
        nodes.append([low, high, start, end, -1, -1])
        spread = high - low
        if end - start > leaf and len(spread) and spread.max() > 0:
            half = (end - start) // 2
            order[start:end] = order[start:end][np.argpartition(own[:, spread.argmax()], half)]
            todo += [(start, start + half, len(nodes) - 1, 0), (start + half, end, len(nodes) - 1, 1)]
    low, high, start, end, left, right = (np.array(x) for x in zip(*nodes, strict=True))
    return {"points": points[order], "ids": ids[order], "low": low, "high": high,
            "start": start, "end": end, "left": left, "right": right}


def search(tree: dict[str, np.ndarray], query: np.ndarray, own: int, k: int, kth: float, bounds: np.ndarray) -> list:
    """The (score, id) of the k best points of a tree with scores of ``kth`` or more."""
    best: list[tuple[float, int]] = []  # heap of (score, -id)
    ahead = [(-bounds[0], 0)]
    left, right, start, end = tree["left"], tree["right"], tree["start"], tree["end"]
    while ahead:
        bound, node = heapq.heappop(ahead)
        if -bound < kth:
            break
        if left[node] >= 0:
            for child in (left[node], right[node]):
                if bounds[child] >= kth:
                    heapq.heappush(ahead, (-bounds[child], child))
            continue
        rows = slice(start[node], end[node])
        scores, ids = tree["points"][rows] @ query, tree["ids"][rows]
        for i in np.nonzero((scores >= kth) & (ids != own))[0]:
            item = (scores[i], -int(ids[i]))
            if len(best) < k:
                heapq.heappush(best, item)
            elif item > best[0]:
                heapq.heapreplace(best, item)
        if len(best) == k:
            kth = max(kth, best[0][0])
    return [(s, -i) for s, i in best]


def _matrix(raws, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(raws), np.int64).reshape(len(raws), dim)


def _planted(pdf: pd.DataFrame) -> pd.DataFrame:
    dim = int(pdf["dim"].iloc[0])
    out = io.BytesIO()
    np.savez(out, **build(_matrix(pdf["raw"], dim), pdf["id"].to_numpy()))
    return pd.DataFrame({"dim": [dim], "shard": [int(pdf["shard"].iloc[0])], "tree": [out.getvalue()]})


def _walk(k: int):
    def run(trees: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int, int]] = []
        if len(trees) and len(queries):
            tree = dict(np.load(io.BytesIO(trees["tree"].iloc[0])))
            dim = int(queries["dim"].iloc[0])
            q = _matrix(queries["raw"], dim)
            ids, kths = queries["id"].to_numpy(), queries["kth"].to_numpy()
            largest = int(max(np.abs(tree["points"]).max(initial=0), 1)) * int(max(np.abs(q).max(initial=0), 1))
            # exact in doubles, which multiply faster, or in 64 bits, or in numbers of any size
            if largest * max(dim, 1) < 1 << 63:
                kind = np.float64 if largest * max(dim, 1) < 1 << 53 else np.int64
            else:
                kind = object
            q = q.astype(kind)
            tree |= {n: tree[n].astype(kind) for n in ("points", "low", "high")}
            for at in range(0, len(q), 256):
                part = q[at:at + 256]
                bounds = np.maximum(part, 0) @ tree["high"].T + np.minimum(part, 0) @ tree["low"].T
                for i in range(len(part)):
                    own, kth = int(ids[at + i]), int(kths[at + i])
                    kth = float("-inf") if kth == LOWEST else kth
                    found += [(own, i2, min(max(int(s), LOWEST), HIGHEST)) for s, i2 in
                              search(tree, part[i], own, k, kth, bounds[i])]
        return pd.DataFrame(found, columns=["query_id", "id", "score"]).astype("int64")
    return run


def scaled(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, dim, raw): floor(SCALE * x) of every component as 64-bit numbers;
    only rows that can take part."""
    def run(batches):
        for batch in batches:
            ids, dims, raws = [], [], []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if i is None or v is None or None in v:
                    continue
                x = np.array(v, np.float64)
                if not np.isfinite(x).all():
                    continue
                ids.append(i)
                dims.append(len(x))
                with np.errstate(over="ignore"):
                    raws.append(np.clip(np.floor(SCALE * x), -LIMIT, LIMIT).astype(np.int64).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(dims, pa.int32()),
                                              pa.array(raws, pa.binary())], ["id", "dim", "raw"])
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vec_col).cast("array<double>").alias("v"))
    return rows.mapInArrow(run, "id long, dim int, raw binary")


def top_k(vectors: DataFrame, queries: Column, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
          shard_rows: int = SHARD_ROWS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """query_id, rank (from 1), id, score: the k best other rows of each query.

    ``queries``: condition on ``id`` that tells which rows are queries. Ties
    go to the smaller id; with fewer than k other rows all are returned. Null
    ids and vectors that are null or hold null or non-finite components take
    no part; vectors of other lengths than the query's are no candidates. Rows
    that repeat an id are all candidates, none of them for each other; where a
    query's id repeats, the best of all its rows are returned. Scores are exact;
    a scaled component beyond 2^62 is held there, and a score beyond the range
    of a long at its end. No rows give no rows.
    """
    rows = saved(scaled(vectors, id_col, vec_col).withColumn("asks", queries), "points")
    sizes = rows.groupBy("dim").agg(F.ceil(F.count("*") / shard_rows).alias("shards"),
                                    F.ceil(F.sum(F.col("asks").cast("int")) / block_rows).alias("blocks"))
    sizes = sizes.where("blocks > 0")  # a row per vector length
    spread = rows.join(sizes, "dim")
    trees = saved(spread.withColumn("shard", F.pmod(F.xxhash64("id", "raw"), F.col("shards"))).select("id", "dim", "raw", "shard")
                  .groupBy("dim", "shard").applyInPandas(_planted, "dim int, shard long, tree binary"), "trees")
    asked = (spread.where("asks").withColumn("block", F.pmod(F.xxhash64("id", "raw", F.lit(1)), F.col("blocks")))
             .withColumn("home", F.col("block") % F.col("shards")))
    cells = trees.join(sizes, "dim").withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    first = cells["shard"] == cells["block"] % cells["shards"]
    key = ["dim", "shard", "block"]

    def walked(trees: DataFrame, queries: DataFrame) -> DataFrame:
        return saved(trees.select(*key, "tree").groupBy(*key).cogroup(
            queries.select(*key, "id", "raw", "kth").groupBy(*key))
            .applyInPandas(_walk(k), "query_id long, id long, score long"), "found")

    near = walked(cells.where(first), asked.withColumn("shard", F.col("home")).withColumn("kth", F.lit(LOWEST)))
    kth = near.groupBy("query_id").agg(F.when(F.count("*") >= k, F.min("score")).alias("kth"))
    others = (asked.join(kth.withColumnRenamed("query_id", "id"), "id", "left").fillna({"kth": LOWEST})
              .withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.col("shards") - 1)))
              .where("shard <> home"))
    far = walked(cells.where(~first), others)
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "id")
    return (near.unionByName(far).withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)
            .select("query_id", "rank", "id", "score"))
