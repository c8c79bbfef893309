"""Exact top-k search by inner product as a Voronoi join.

Components become floor(256 * x). Pivots, a bounded sample of vectors, cut the space into cells;
every vector belongs to its nearest pivot. A cell's summary is its number of vectors, the range of
their lengths along the pivot's direction, and their largest distance from that direction. From a
summary and a query alone follows the largest inner product that any vector of the cell can have
with the query. Each query is first solved in the cell with the largest such bound; the k-th best
score found there is a floor, and the query is replicated only to the other cells whose bound reaches
that floor (ties may win by their id). Data vectors move once. A cell of many vectors is split into
blocks of bounded size, each solved by itself: a block is held, its queries stream past, and the
results are merged by query.

Defined results: vectors that are NULL or hold a NULL or non-finite component take no part; vectors
of different lengths are compared as if padded by zeros; NULL ids take no part; rows that share an id
are one vector's copies and never find each other; equal scores go to the smaller id; an empty table
gives no rows; other columns are ignored. Scores are exact as long as they fit 63 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabwork.llm.common import stored

_ROW = "cell int, block int, kind int, id long, vector binary"


def quantised(vectors: DataFrame, id_column: str = "vec_id", column: str = "embedding") -> DataFrame:
    """Rows (id, vector) of whole-number components, as little-endian 64-bit integers."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    usable = vectors.where(F.col(id_column).isNotNull() & F.col(column).isNotNull() & F.forall(column, finite))
    return usable.select(F.col(id_column).alias("id"), F.transform(column, lambda x: F.floor(x.cast("double") * 256)).alias("vector"))


def _packed(vectors: list[np.ndarray], width: int) -> np.ndarray:
    out = np.zeros((len(vectors), width), np.int64)
    for row, v in zip(out, vectors):
        row[: len(v)] = v
    return out


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Binary vectors as rows, padded by zeros."""
    found = [np.frombuffer(x.as_buffer(), np.int64) if x.is_valid and len(x.as_buffer()) else np.empty(0, np.int64) for x in column]
    return _packed(found, width)


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whole-number inner products; by floating point where every sum is exact there."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if most < 2**53:
        return (a.astype(np.float64) @ b.T.astype(np.float64)).astype(np.int64)
    return a @ b.T


class Cells:
    """Pivots, and the summary of each cell."""

    def __init__(self, pivots: np.ndarray):
        self.pivots = pivots.astype(np.float64)
        lengths = np.linalg.norm(self.pivots, axis=1)
        self.directions = self.pivots / np.maximum(lengths, 1e-300)[:, None]
        self.squares = (self.pivots**2).sum(axis=1)
        n = len(pivots)
        self.count, self.low, self.high, self.aside = np.zeros(n, np.int64), np.zeros(n), np.zeros(n), np.zeros(n)

    def assign(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Cell, length along its direction and distance from it for each vector."""
        v = vectors.astype(np.float64)
        cell = (self.squares - 2 * v @ self.pivots.T).argmin(axis=1)
        along = np.einsum("ij,ij->i", v, self.directions[cell])
        return cell, along, np.sqrt(np.maximum((v**2).sum(axis=1) - along**2, 0))

    def bounds(self, queries: np.ndarray) -> np.ndarray:
        """Largest possible inner product of each query with a vector of each cell; -inf for empty cells."""
        q = queries.astype(np.float64)
        along = q @ self.directions.T
        aside = np.sqrt(np.maximum((q**2).sum(axis=1)[:, None] - along**2, 0))
        top = np.maximum(along * self.low, along * self.high) + aside * self.aside
        slack = 1 + 1e-9 * (np.abs(top) + np.linalg.norm(q, axis=1)[:, None] * (np.abs(self.low) + np.abs(self.high) + self.aside))
        return np.where(self.count > 0, top + slack, -np.inf)


def _solve(k: int, width: int):
    """Streams rows sorted by (cell, block, kind): holds a block's vectors, then answers each batch of its queries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_key, ids, parts, data = None, [], [], np.empty((0, width), np.int64)
        for batch in batches:
            cell, block, kind, own = (batch.column(i).to_numpy() for i in range(4))
            vectors = _matrix(batch.column(4), width)
            edges = np.flatnonzero((np.diff(cell) != 0) | (np.diff(block) != 0) | (np.diff(kind) != 0)) + 1
            for lo, hi in zip(np.concatenate([[0], edges]), np.concatenate([edges, [len(cell)]])):
                if lo == hi:
                    continue
                key = (cell[lo], block[lo])
                if key != held_key:
                    held_key, ids, parts = key, [], []
                if kind[lo] == 0:
                    ids.append(own[lo:hi])
                    parts.append(vectors[lo:hi])
                    continue
                if not parts:
                    continue
                if len(parts) > 1:
                    ids, parts = [np.concatenate(ids)], [np.concatenate(parts)]
                data, names = parts[0], ids[0]
                out = []
                for a in range(lo, hi, 256):
                    queries, asked = vectors[a : min(a + 256, hi)], own[a : min(a + 256, hi)]
                    scores = _products(queries, data)
                    for q, row in zip(asked, scores):
                        other = np.flatnonzero(names != q)
                        if len(other) > k:
                            floor = np.partition(row[other], len(other) - k)[len(other) - k]
                            other = other[row[other] >= floor]
                        best = other[np.lexsort((names[other], -row[other]))[:k]]
                        out += [(q, names[i], row[i]) for i in best]
                if out:
                    q, v, s = zip(*out)
                    yield pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.int64())], names=["query_id", "vec_id", "score"])

    return run


def _joined(data: DataFrame, queries: DataFrame, k: int, width: int) -> DataFrame:
    rows = data.unionByName(queries).repartition("cell", "block").sortWithinPartitions("cell", "block", "kind")
    return rows.mapInArrow(_solve(k, width), "query_id long, vec_id long, score long")


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def top_k(vectors: DataFrame, queries: Column, k: int = 5, pivots: int = 64, block_rows: int = 8192) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): for each row of ``vectors`` (id, vector) that ``queries`` marks, the best ``k`` others.

    ``pivots`` bounds the sample that cuts the space; ``block_rows`` bounds what one task holds at a time.
    """
    spark = vectors.sparkSession
    width = vectors.agg(F.max(F.size("vector"))).first()[0] or 0
    empty = "query_id long, rank int, vec_id long, score long"
    if not width:
        return spark.createDataFrame([], empty)
    sample = vectors.select("vector").distinct().orderBy(F.xxhash64("vector"), "vector").limit(pivots).collect()
    cells = Cells(_packed([np.array(r["vector"], np.int64) for r in sample], width))
    sent = spark.sparkContext.broadcast(cells)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(1)
            flat, offsets = lists.flatten().to_numpy(), np.concatenate([[0], np.cumsum([len(x) for x in lists])])
            found = _packed([flat[a:b] for a, b in zip(offsets[:-1], offsets[1:])], width)
            cell, along, aside = sent.value.assign(found)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(cell.astype(np.int32)), pa.array(along), pa.array(aside), pa.array([v.tobytes() for v in found], pa.binary()), batch.column(2)],
                names=["id", "cell", "along", "aside", "vector", "asked"])

    rows = vectors.select("id", "vector", F.coalesce(queries, F.lit(False)).alias("asked"))
    placed = stored(spark, rows.mapInArrow(place, "id long, cell int, along double, aside double, vector binary, asked boolean"), "voronoi")
    for r in placed.groupBy("cell").agg(F.count("*").alias("n"), F.min("along").alias("low"), F.max("along").alias("high"), F.max("aside").alias("aside")).collect():
        cells.count[r["cell"]], cells.low[r["cell"]], cells.high[r["cell"]], cells.aside[r["cell"]] = r["n"], r["low"], r["high"], r["aside"]
    blocks = -(-cells.count // block_rows)
    summary = spark.sparkContext.broadcast(cells)
    split = F.element_at(F.array(*[F.lit(int(b)) for b in np.maximum(blocks, 1)]), F.col("cell") + 1)
    data = placed.select("cell", F.pmod(F.xxhash64("id", "vector"), split).cast("int").alias("block"), F.lit(0).alias("kind"), "id", "vector")
    asked = placed.where("asked").select("id", "vector").dropDuplicates(["id", "vector"])

    def replicate(first: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                bounds = summary.value.bounds(_matrix(batch.column("vector"), width))
                home = bounds.argmax(axis=1)
                if first:
                    row, cell = np.arange(len(home)), home
                else:
                    floor = np.array([-np.inf if f is None else f for f in batch.column("floor").to_pylist()], float)
                    wanted = (bounds >= floor[:, None]) & (summary.value.count > 0)
                    wanted[np.arange(len(home)), home] = False
                    row, cell = np.nonzero(wanted)
                times = blocks[cell]
                row, cell = np.repeat(row, times), np.repeat(cell, times)
                block = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
                for lo in range(0, len(row), 10_000):
                    part = slice(lo, lo + 10_000)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(cell[part].astype(np.int32)), pa.array(block[part].astype(np.int32)), pa.array(np.ones(len(row[part]), np.int32)),
                         batch.column("id").take(pa.array(row[part])), batch.column("vector").take(pa.array(row[part]))],
                        names=["cell", "block", "kind", "id", "vector"])

        return run

    home = stored(spark, _best(_joined(data, asked.mapInArrow(replicate(True), _ROW), k, width), k), "voronoi-home")
    floors = home.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("floor"))
    others = asked.join(floors, "id", "left").mapInArrow(replicate(False), _ROW)
    away = _joined(data, others, k, width)
    return _best(home.drop("rank").unionByName(away), k).select("query_id", F.col("rank").cast("int"), "vec_id", "score")
