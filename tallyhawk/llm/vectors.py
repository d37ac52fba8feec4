"""Embedding near-duplicates: spherical k-means cells, blocked cosine products.

Unit vectors live in the cell of the nearest of k centroids (fitted on a bounded
sample, every row assigned). Two vectors of one cell are compared there, two of
different cells in the cell of the lower number, which the other vector visits.
It visits each lower cell that can hold a vector within the angle asked for, so
no pair is lost and none is compared twice; at worst all pairs are compared.

Inside a cell, vectors of one label are compared in blocks of rows: a task
multiplies a block of residents with another block, counts the links of each row
and keeps one edge per row to the smallest member of its component inside the
product, so pairs are never listed. Equal vectors are one node with a weight. A
cell that grows past one block is dealt over many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyhawk.llm.common import saved
from tallyhawk.llm.components import connected_components

THRESHOLD = 0.93
#: rows of the fitting sample at most, and numbers it may hold
SAMPLE_ROWS, SAMPLE_NUMBERS = 20_000, 4_000_000
#: rows wanted per cell and label, cells at most (the centroids are sent to every task)
CELL_ROWS, MOST_CELLS = 1024, 4096
BLOCK_ROWS = 1024
#: rows whose products with all centroids are held at once
ASSIGN_ROWS = 1024
#: far above the rounding of a product of unit vectors
SLACK = 1e-6


def prepared(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """uid (unique, fixed by being written), id, label, dim, raw (the vector as
    doubles, null unless it can link), digest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, raws = [], []
            for v in batch.column(2).to_pylist():
                x = np.asarray(v, np.float64) if v and None not in v else None
                usable = x is not None and bool(np.isfinite(x).all()) and float(np.abs(x).max()) > 0
                dims.append(len(x) if usable else None)
                raws.append((x + 0.0).tobytes() if usable else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(dims, pa.int32()), pa.array(raws, pa.binary())],
                ["id", "label", "dim", "raw"])
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("label"),
                          F.col(vec_col).cast("array<double>").alias("v"))
    out = rows.mapInArrow(run, "id long, label string, dim int, raw binary")
    return saved(out.select(F.monotonically_increasing_id().alias("uid"), "*", F.md5("raw").alias("digest")), "vectors")


def unit(raws: list[bytes]) -> np.ndarray:
    """Unit rows; scaled first, so that no square overflows or vanishes."""
    x = np.frombuffer(b"".join(raws), np.float64).reshape(len(raws), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 5) -> np.ndarray:
    """k unit centroids of unit rows; empty ones keep their place."""
    rng = np.random.default_rng(seed)
    c = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(rounds):
        home = np.concatenate([(x[i:i + 4096] @ c.T).argmax(axis=1) for i in range(0, len(x), 4096)])
        total = np.zeros_like(c)
        np.add.at(total, home, x)
        norm = np.linalg.norm(total, axis=1, keepdims=True)
        c = np.where(norm > 1e-12, total / np.maximum(norm, 1e-12), c)
    return c


def _fit(nodes: DataFrame, seed: int) -> dict[int, np.ndarray]:
    """Centroids per dimension, from a sample of fixed size; as many as the
    largest label of that dimension needs, as labels never meet."""
    sizes = {r["dim"]: r["n"] for r in nodes.groupBy("dim", "label").agg(F.count("*").alias("n"))
             .groupBy("dim").agg(F.max("n").alias("n"))
             .orderBy(F.desc("n"), "dim").limit(64).collect()}  # rarer dimensions get one cell each
    cells = {}
    for dim, n in sizes.items():
        k = min(MOST_CELLS, SAMPLE_NUMBERS // dim // 4, max(1, math.ceil(n / CELL_ROWS)))
        if k > 1:
            rows = (nodes.where(F.col("dim") == dim).orderBy(F.xxhash64("cid", F.lit(seed)))
                    .limit(min(SAMPLE_ROWS, SAMPLE_NUMBERS // dim)).select("raw").collect())
            cells[dim] = spherical_kmeans(unit([bytes(r["raw"]) for r in rows]), min(k, len(rows)), seed=seed)
    return cells


def lower_cells(x: np.ndarray, c: np.ndarray, threshold: float) -> tuple[np.ndarray, list[list[int]]]:
    """The cell of each unit row, and the cells of lower number it visits.

    Let b live in cell h, a in cell i, t be the angle between them and w the unit
    vector along c[h] - c[i]. Then a.w <= 0, so a is 90 degrees or more from w
    and b at least 90 - t, that is b.w <= sin(t). Cells for which b.w is greater
    than that at the widest angle asked for hold no partner of b.
    """
    most = math.sin(math.acos(min(threshold, 1.0))) if threshold > 0 else 1.0
    near = x @ c.T
    home = near.argmax(axis=1)
    gap = near[np.arange(len(x)), home][:, None] - near
    apart = np.sqrt(np.maximum(((c * c).sum(axis=1)[home][:, None] + (c * c).sum(axis=1)) - 2 * (c[home] @ c.T), 0))
    visit = (gap <= most * apart + SLACK) & (np.arange(len(c)) < home[:, None])
    row, cell = np.nonzero(visit)
    return home, [v.tolist() for v in np.split(cell, np.cumsum(visit.sum(axis=1))[:-1])]


def _assign(centroids, threshold: float):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for dim, part in pdf.groupby("dim"):
                c = centroids.value.get(int(dim))
                if c is None:
                    yield part.assign(home=0, lower=[[] for _ in range(len(part))])
                    continue
                for at in range(0, len(part), ASSIGN_ROWS):
                    some = part.iloc[at:at + ASSIGN_ROWS]
                    home, lower = lower_cells(unit(list(some["raw"])), c, threshold)
                    yield some.assign(home=home, lower=lower)
    return run


def _tile(threshold: float):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = int(pdf["bi"].iloc[0]), int(pdf["bj"].iloc[0])
        pdf = pdf.sort_values("cid").reset_index(drop=True)
        pick = pdf["block"].to_numpy()
        left, right = np.nonzero(pick == i)[0], np.nonzero(pick == j)[0]
        x = unit(list(pdf["raw"]))
        weight = pdf["weight"].to_numpy()
        count, root = np.zeros(len(pdf), np.int64), np.arange(len(pdf))
        a, b = np.nonzero(x[left] @ x[right].T >= threshold)
        a, b = left[a], right[b]
        if i == j:
            a, b = a[a < b], b[a < b]
        np.add.at(count, a, weight[b])
        np.add.at(count, b, weight[a])
        while len(a):  # smallest member of each component in this product
            low = np.minimum(root[a], root[b])
            old = root.copy()
            np.minimum.at(root, a, low)
            np.minimum.at(root, b, low)
            root = root[root]
            if (old == root).all():
                break
        cid = pdf["cid"].to_numpy()
        some = count > 0
        return pd.DataFrame({"cid": cid[some], "n": count[some], "root": cid[root[some]]})
    return run


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, seed: int = 5,
                    id_col: str = "vec_id", vec_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """One row per row of ``vectors``: id, n_links, component (smallest id
    reachable), kept (id is the component's; of rows that repeat that id all).

    Rows are compared only if their labels are equal and not null and their
    vectors have the same length. Vectors that are null, empty, zero or hold
    null or non-finite components link with nothing. Equal rows link with each
    other; a null id takes part but names no component (kept is then false if
    another names it, else true). No rows give no rows.
    """
    spark = vectors.sparkSession
    rows = prepared(vectors, id_col, vec_col, label_col)
    able = rows.where(F.col("raw").isNotNull() & F.col("label").isNotNull())
    nodes = saved(able.groupBy("label", "digest").agg(
        F.min("uid").alias("cid"), F.count("*").alias("weight"), F.min("id").alias("rep"),
        F.first("dim").alias("dim"), F.first("raw").alias("raw")), "vector-nodes")
    centroids = spark.sparkContext.broadcast(_fit(nodes, seed))
    placed = saved(nodes.select("cid", "label", "weight", "dim", "raw").mapInPandas(
        _assign(centroids, threshold),
        "cid long, label string, weight long, dim int, raw binary, home int, lower array<int>"), "vector-cells")
    key = ["label", "dim", "cell"]
    cells = placed.withColumn("cell", F.explode(F.concat(F.array("home"), "lower"))).withColumn("lives", F.col("cell") == F.col("home"))
    sizes = cells.groupBy(*key).agg(F.count_if("lives").alias("own"), F.count_if(~F.col("lives")).alias("guests"))
    sizes = sizes.where("own > 0 and own + guests > 1").select(
        *key, F.ceil(F.col("own") / BLOCK_ROWS).alias("own"), F.ceil(F.col("guests") / BLOCK_ROWS).alias("guests"))
    # blocks of residents are numbered first; guests meet residents only
    blocked = cells.join(sizes, key).withColumn("block", F.when(F.col("lives"), F.pmod(F.xxhash64("cid"), F.col("own"))).otherwise(
        F.col("own") + F.pmod(F.xxhash64("cid"), F.col("guests"))))
    others = F.when(F.col("lives"), F.col("own") + F.col("guests")).otherwise(F.col("own"))
    tiles = (blocked.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), others - 1)))
             .withColumn("bi", F.least("block", "other")).withColumn("bj", F.greatest("block", "other")))
    found = saved(tiles.select("cid", "weight", "raw", *key, "block", "bi", "bj").groupBy(*key, "bi", "bj").applyInPandas(
        _tile(threshold), "cid long, n long, root long"), "vector-links")
    joined = connected_components(found.select(F.col("cid").alias("u"), F.col("root").alias("v")))
    counts = found.groupBy("cid").agg(F.sum("n").alias("n"))
    nodes = (nodes.select("label", "digest", "cid", "weight", "rep").join(counts, "cid", "left")
             .join(joined.select(F.col("node").alias("cid"), "component"), "cid", "left")
             .withColumn("root", F.coalesce("component", "cid")))
    smallest = nodes.groupBy("root").agg(F.min("rep").alias("component"))
    nodes = nodes.drop("component").join(smallest, "root").select(
        "label", "digest", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), "component")
    out = rows.select("id", "label", "digest").join(nodes, ["label", "digest"], "left").select(
        "id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "id").alias("component"))
    return out.withColumn("kept", F.col("id").eqNullSafe(F.col("component")))
