"""K-means: fit with restarts, labelling, inertia, elbow curve, profiles, scaled-versus-raw comparison.

A fit wants rows without missing values in the clustered columns and raises otherwise (impute first); labelling
gives such rows no label, and inertia leaves them out.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce
from operator import add, and_

from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from tabwork.functions.missing import nan_to_null
from tabwork.operators.profile import group_means
from tabwork.operators.scale import Scaler

SEED = 123
#: Rows beyond which vectors are dealt over all cores. Smaller tables stay as they are read, since the random starts depend on which rows stand together.
DEALT_ROWS = 50_000


@dataclass
class KMeansFit:
    """A fitted clustering: k centroids (k x columns numbers) and the inertia."""

    cols: list[str]
    centroids: list[list[float]]
    inertia: float

    def label(self, df: DataFrame, out: str = "cluster") -> DataFrame:
        return assign(df, self.centroids, self.cols, out)

    def centroid_table(self, spark: SparkSession) -> DataFrame:
        return centroid_table(spark, self.centroids, self.cols)


def centroid_table(spark: SparkSession, centroids: Sequence[Sequence[float]], cols: Sequence[str]) -> DataFrame:
    schema = StructType([StructField("cluster", IntegerType())] + [StructField(c, DoubleType()) for c in cols])
    return spark.createDataFrame([(i, *map(float, c)) for i, c in enumerate(centroids)], schema)


@contextmanager
def _vectors(df: DataFrame, cols: Sequence[str]):
    """Feature vectors kept for the iterations; many are dealt over all cores, as a file of one row group would else be one task of each iteration."""
    plain = df.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in cols])
    if plain.count() > DEALT_ROWS:
        plain = plain.repartition(max(plain.rdd.getNumPartitions(), df.sparkSession.sparkContext.defaultParallelism))
    data = VectorAssembler(inputCols=list(cols), outputCol="_features", handleInvalid="error").transform(plain).select("_features")
    data.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield data
    finally:
        data.unpersist()


def _best(data, cols, k, restarts, max_iter, tol, seed) -> KMeansFit:
    if k == 1:
        # The library wants k > 1: one cluster is the mean, its inertia the summed squared deviations.
        row = data.agg(Summarizer.metrics("count", "mean", "variance").summary(F.col("_features")).alias("s")).first()["s"]
        spread = float(sum(row["variance"])) * max(row["count"] - 1, 0)
        return KMeansFit(list(cols), [list(map(float, row["mean"]))], spread)
    best = None
    for attempt in range(restarts):
        model = KMeans(k=k, maxIter=max_iter, tol=tol, seed=seed + attempt, featuresCol="_features",
                       predictionCol="_label").fit(data)
        cost = model.summary.trainingCost
        if best is None or cost < best.inertia:
            best = KMeansFit(list(cols), sorted(list(map(float, c)) for c in model.clusterCenters()), cost)
    return best


def kmeans_fit(
    df: DataFrame, cols: Sequence[str], k: int, restarts: int = 10, max_iter: int = 300, tol: float = 1e-4, seed: int = SEED
) -> KMeansFit:
    """Best of ``restarts`` runs by inertia. Clusters are numbered by their centroids in ascending order."""
    with _vectors(df, cols) as data:
        return _best(data, cols, k, restarts, max_iter, tol, seed)


def _distances(centroids, cols) -> list[Column]:
    return [
        reduce(add, [
            (F.col(f"`{c}`").cast("double") - F.lit(float(v))) * (F.col(f"`{c}`").cast("double") - F.lit(float(v)))
            for c, v in zip(cols, centre)
        ])
        for centre in centroids
    ]


def _nearest(centroids, cols) -> Column:
    return F.array_min(F.array(*[
        F.struct(d.alias("d"), F.lit(i).alias("i")) for i, d in enumerate(_distances(centroids, cols))
    ]))


def _complete(df, cols) -> Column:
    """Whether a row has a value, and not NaN, in all columns."""
    return reduce(and_, [nan_to_null(c, df.schema[c].dataType).isNotNull() for c in cols])


def assign(df: DataFrame, centroids: Sequence[Sequence[float]], cols: Sequence[str], out: str = "cluster") -> DataFrame:
    """Add the index of the nearest centroid (lowest index when equally near), NULL for a row with a missing value. A row-wise expression."""
    return df.withColumn(out, F.when(_complete(df, cols), _nearest(centroids, cols)["i"]))


def inertia(df: DataFrame, centroids: Sequence[Sequence[float]], cols: Sequence[str]) -> DataFrame:
    """``(inertia)``: sum of squared distances to the nearest centroid, over the rows that ``assign`` gives a label."""
    return df.agg(F.sum(F.when(_complete(df, cols), F.array_min(F.array(*_distances(centroids, cols))))).alias("inertia"))


def elbow(
    df: DataFrame, cols: Sequence[str], ks: Sequence[int], restarts: int = 10, max_iter: int = 300, tol: float = 1e-4,
    seed: int = SEED,
) -> DataFrame:
    """``(k, inertia)`` over one cached set of vectors."""
    with _vectors(df, cols) as data:
        rows = [(int(k), float(_best(data, cols, k, restarts, max_iter, tol, seed).inertia)) for k in ks]
    return df.sparkSession.createDataFrame(rows, "k int, inertia double")


def profile(df: DataFrame, label: str = "cluster", cols: Sequence[str] | None = None) -> DataFrame:
    """Mean of every numeric column per cluster, in the units of ``df``."""
    return group_means(df, [label], cols)


def match_clusters(pairs: Sequence[tuple[int, int, int]], k: int) -> list[int]:
    """For each cluster of one clustering the cluster of the other that it is, one to one, with the most rows in common.

    ``pairs`` are (cluster, other cluster, rows). The assignment problem on the k x k table, by shortest augmenting paths.
    """
    rows = [[0] * k for _ in range(k)]
    for i, j, n in pairs:
        rows[i][j] += n
    match_of, row_price, col_price = [-1] * k, [0] * k, [0] * k  # match_of: the row of each column
    for start in range(k):
        reach, before, done = [math.inf] * k, [-1] * k, set()
        row, cost, last = start, 0, -1
        while True:
            for j in range(k):
                if j not in done:
                    length = cost - rows[row][j] - row_price[row] - col_price[j]
                    if length < reach[j]:
                        reach[j], before[j] = length, last
            last = min((j for j in range(k) if j not in done), key=lambda j: (reach[j], j))
            cost = reach[last]
            done.add(last)
            if match_of[last] < 0:
                break
            row = match_of[last]
        row_price[start] += cost
        for j in done - {last}:
            row_price[match_of[j]] += cost - reach[j]
            col_price[j] -= cost - reach[j]
        while last >= 0:
            earlier = before[last]
            match_of[last] = match_of[earlier] if earlier >= 0 else start
            last = earlier
    return [match_of.index(i) for i in range(k)]


def compare_scaling(
    df: DataFrame, cols: Sequence[str], k: int, kind: str = "minmax", restarts: int = 10, seed: int = SEED, train: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Cluster raw and scaled values of the same rows; ``train`` are the rows to fit on, all by default.

    Returns profiles ``(variant, cluster, column, mean)`` in original units, and the
    label crosstab ``(raw, scaled, n)``. Scaled clusters carry the number of the raw cluster that they match, each another one, so
    that the two share as many rows as possible: equal clusterings have equal labels.
    """
    fit_on = df if train is None else train
    model = Scaler(kind=kind, cols=list(cols)).fit(fit_on)
    raw = kmeans_fit(fit_on, cols, k, restarts, seed=seed)
    scaled = kmeans_fit(model.transform(fit_on), cols, k, restarts, seed=seed)
    # Both labels come from one projection: scaled copies of the columns sit beside the raw ones.
    copies = [f"_s{i}" for i in range(len(cols))]
    doubled = df.withColumns({f"_r{i}": F.col(f"`{c}`").cast("double") for i, c in enumerate(cols)})
    both = model.transform(doubled).withColumnsRenamed(dict(zip(cols, copies)))
    both = assign(both, scaled.centroids, copies, "_scaled").withColumnsRenamed({f"_r{i}": c for i, c in enumerate(cols)})
    both = assign(both, raw.centroids, cols, "raw").where("raw is not null")
    pairs = both.groupBy("raw", "_scaled").agg(F.count(F.lit(1)).alias("n")).collect()
    raw_of = match_clusters([(r["_scaled"], r["raw"], r["n"]) for r in pairs], k)
    both = both.withColumn("scaled", F.get(F.array(*[F.lit(i) for i in raw_of]), F.col("_scaled")))
    table = df.sparkSession.createDataFrame([(r["raw"], raw_of[r["_scaled"]], r["n"]) for r in pairs], "raw int, scaled int, n bigint")
    means = None
    for variant in ("raw", "scaled"):
        wide = both.groupBy(F.col(variant).alias("cluster")).agg(*[F.avg(f"`{c}`").alias(f"m{i}") for i, c in enumerate(cols)])
        long = wide.select(F.lit(variant).alias("variant"), "cluster", F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("mean")) for i, c in enumerate(cols)
        ])))
        means = long if means is None else means.unionByName(long)
    return means, table
