"""The small tables charts are drawn from, computed on Spark."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabwork.functions.bounded import join_group_rows
from tabwork.functions.missing import normalize_missing
from tabwork.functions.pvalues import t_quantile
from tabwork.operators.quantile import exact_quantiles

DEFAULT_BINS = 10


def _series(df, column, by):
    """Columns ``by..., x`` without missing values or groups."""
    return normalize_missing(df.select(*by, F.col(f"`{column}`").cast("double").alias("x"))).dropna()


def histogram(
    df: DataFrame, column: str, bins: int = DEFAULT_BINS, by: str | None = None, shared_edges: bool = False
) -> DataFrame:
    """Equal-width counts ``(by, bin, lo, hi, n)``; the last bin is closed, empty bins are present.

    With ``by`` each series spans its own range unless ``shared_edges``. A constant
    series spans value - 0.5 to value + 0.5. A value is in the bin whose given ``lo`` and ``hi`` enclose it, also where
    dividing by the width would round it into the next one.
    """
    keys = [by] if by else []
    data = _series(df, column, keys)
    low = F.when(F.col("a") == F.col("z"), F.col("a") - 0.5).otherwise(F.col("a"))
    high = F.when(F.col("a") == F.col("z"), F.col("z") + 0.5).otherwise(F.col("z"))
    if by and not shared_edges:
        ranges = data.groupBy(by).agg(F.min("x").alias("a"), F.max("x").alias("z"), F.count(F.lit(1)).alias("rows")).select(
            by, low.alias("lo_all"), high.alias("hi_all"), "rows"
        )
        placed = join_group_rows(data, ranges, keys, "rows").drop("rows")
        ranges = ranges.drop("rows")
    else:
        span = data.agg(F.min("x").alias("a"), F.max("x").alias("z")).select(low, high).first()
        fixed = [F.lit(span[0]).cast("double").alias("lo_all"), F.lit(span[1]).cast("double").alias("hi_all")]
        ranges = data.select(*keys).distinct() if by else df.sparkSession.range(1)
        ranges = ranges.select(*keys, *fixed).where("lo_all is not null")
        placed = data.select(*keys, "x", *fixed)

    def edge(i):
        return F.when(i == bins, F.col("hi_all")).otherwise(F.col("lo_all") + i * (F.col("hi_all") - F.col("lo_all")) / F.lit(float(bins)))

    near = F.floor((F.col("x") - F.col("lo_all")) / ((F.col("hi_all") - F.col("lo_all")) / F.lit(float(bins))))
    placed = placed.withColumn("near", F.greatest(F.least(near, F.lit(bins - 1)), F.lit(0)).cast("int"))
    index = F.when((F.col("near") > 0) & (F.col("x") < edge(F.col("near"))), F.col("near") - 1).when(
        (F.col("near") < bins - 1) & (F.col("x") >= edge(F.col("near") + 1)), F.col("near") + 1).otherwise(F.col("near"))
    counted = placed.select(*keys, index.alias("bin")).groupBy(*keys, "bin").agg(F.count(F.lit(1)).alias("n"))
    grid = ranges.select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    return grid.join(counted, [*keys, "bin"], "left").select(
        *keys, "bin", edge(F.col("bin")).alias("lo"), edge(F.col("bin") + 1).alias("hi"), F.coalesce("n", F.lit(0).cast("bigint")).alias("n"),
    )


def overlay_histograms(df: DataFrame, cols: Sequence[str], bins: int = DEFAULT_BINS, shared_edges: bool = False) -> DataFrame:
    """Histograms of several columns as series of one table ``(series, bin, lo, hi, n)``."""
    long = normalize_missing(df.select(*cols)).select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("series"), F.col(f"`{c}`").cast("double").alias("value")) for c in cols
    ])))
    return histogram(long, "value", bins, by="series", shared_edges=shared_edges)


def box_stats(df: DataFrame, column: str, by: str | None = None, whisker: float = 1.5) -> DataFrame:
    """``(by, n, q1, median, q3, whisker_lo, whisker_hi, n_outliers)``.

    Whiskers end at the last value within ``whisker`` IQRs of the box.
    """
    keys = [by] if by else []
    data = _series(df, column, keys)
    q = [F.get("q", F.lit(i)) for i in range(3)]
    boxes = exact_quantiles(data, ["x"], [0.25, 0.5, 0.75], by=keys).select(
        *keys, F.col("n").alias("rows"), q[0].alias("q1"), q[1].alias("median"), q[2].alias("q3"),
        (q[0] - whisker * (q[2] - q[0])).alias("fence_lo"), (q[2] + whisker * (q[2] - q[0])).alias("fence_hi"),
    )
    marks = ["q1", "median", "q3", "fence_lo", "fence_hi"]
    if by:
        joined = join_group_rows(data, boxes, keys, "rows")
    else:
        row = boxes.first()
        joined = data.select("x", *[F.lit(row[m] if row else None).cast("double").alias(m) for m in marks])
    inside = (F.col("x") >= F.col("fence_lo")) & (F.col("x") <= F.col("fence_hi"))
    return joined.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.max("q1").alias("q1"), F.max("median").alias("median"), F.max("q3").alias("q3"),
        F.min(F.when(inside, F.col("x"))).alias("whisker_lo"), F.max(F.when(inside, F.col("x"))).alias("whisker_hi"),
        F.count_if(~inside).alias("n_outliers"),
    )


#: Terms of the expansion of the kernel, and cells of values per bandwidth.
TERMS, CELLS_PER_BANDWIDTH = 12, 2
#: Beyond so many bandwidths from a cell its part of the density is below 1e-17 of its weight.
REACH = 9.0


def violin_error(terms: int = TERMS, cells: int = CELLS_PER_BANDWIDTH) -> float:
    """Bound on the error of ``violin``, as a share of the kernel's peak: density is off by no more than this / (h sqrt(2 pi)).

    A value lies within r = 1 / (2 cells) bandwidths of its cell's middle; the left out terms of the Hermite expansion are at most
    1.09 r^p / sqrt(p!) each (Cramer's inequality), and shrink faster than a geometric series.
    """
    r = 0.5 / cells
    return 1.09 * r**terms / math.sqrt(math.factorial(terms)) / (1 - r / math.sqrt(terms + 1))


def violin(
    df: DataFrame, column: str, by: Sequence[str], grid: int = 100, cut: float = 2.0, bins: int | None = None
) -> DataFrame:
    """Gaussian kernel density per group ``(by..., point, x, density)``, within ``violin_error()`` of the direct sum.

    Scott bandwidth n^(-1/5) * std; the grid runs ``cut`` bandwidths past the data.
    A fast Gauss transform: values meet in cells half a bandwidth wide, of which ``TERMS`` moments about the middle are summed map-side; the
    density at a grid point is the Hermite series of the moments of the cells in reach. Each row costs ``TERMS`` sums, whatever the
    grid; the grid meets cells, not rows.
    ``bins`` first counts rows into that many equal cells per group (a rounding of values to cell centres).
    """
    by = [by] if isinstance(by, str) else list(by)
    data = _series(df, column, by)
    stats = data.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"), F.stddev_samp("x").alias("sd"), F.min("x").alias("a"), F.max("x").alias("z")
    ).where("sd > 0").select(
        *by, "n", "a", "z", (F.pow(F.col("n").cast("double"), F.lit(-0.2)) * F.col("sd")).alias("h")
    )
    rows = join_group_rows(data, stats, by)
    if bins:
        width = (F.col("z") - F.col("a")) / F.lit(float(bins))
        cell = F.least(F.floor((F.col("x") - F.col("a")) / width), F.lit(bins - 1))
        rows = rows.groupBy(*by, "n", "a", "z", "h", cell.alias("cell")).agg(F.count(F.lit(1)).alias("w"))
        rows = rows.withColumn("x", F.col("a") + (F.col("cell") + 0.5) * width)
    else:
        rows = rows.withColumn("w", F.lit(1))

    side = F.col("h") / CELLS_PER_BANDWIDTH
    placed = rows.withColumn("cell", F.floor((F.col("x") - F.col("a")) / side))
    placed = placed.withColumn("u", (F.col("x") - F.col("a") - (F.col("cell") + 0.5) * side) / F.col("h") / math.sqrt(2))
    powers = [F.lit(1.0), F.col("u")]
    for p in range(2, TERMS):
        powers.append(powers[p // 2] * powers[p - p // 2])
    cells = placed.groupBy(*by, "n", "a", "z", "h", "cell").agg(F.array(*[F.sum(F.col("w") * u) / float(math.factorial(p)) for p, u in enumerate(powers)]).alias("moments"))

    step = (F.col("z") - F.col("a") + F.lit(2.0 * cut) * F.col("h")) / F.lit(float(grid - 1))
    at = F.col("a") - F.lit(float(cut)) * F.col("h") + F.col("point") * step
    middle = F.col("a") + (F.col("cell") + 0.5) * side
    place = (middle - F.col("a") + F.lit(float(cut)) * F.col("h")) / step
    first = F.greatest(F.ceil(place - REACH * F.col("h") / step), F.lit(0))
    last = F.least(F.floor(place + REACH * F.col("h") / step), F.lit(grid - 1))
    spread = cells.withColumns({"first": first, "last": last, "middle": middle}).where("first <= last")
    spread = spread.select(*by, "n", "a", "z", "h", "middle", "moments", F.explode(F.sequence("first", "last")).alias("point"))
    spread = spread.withColumn("v", (at - F.col("middle")) / F.col("h") / math.sqrt(2))
    zero = F.struct(F.lit(0.0).alias("before"), F.lit(1.0).alias("term"), F.lit(0.0).alias("total"))
    series = F.aggregate(F.sequence(F.lit(0), F.lit(TERMS - 1)), zero, lambda s, p: F.struct(
        s["term"].alias("before"), (2 * F.col("v") * s["term"] - 2 * p * s["before"]).alias("term"), (s["total"] + F.get("moments", p) * s["term"]).alias("total")))
    mass = spread.groupBy(*by, "point").agg(F.sum(series["total"] * F.exp(-F.col("v") * F.col("v"))).alias("mass"))
    points = stats.select("*", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(grid - 1).cast("bigint"))).alias("point"))
    return points.join(mass, [*by, "point"], "left").select(
        *by, F.col("point").cast("int").alias("point"), at.alias("x"),
        (F.greatest(F.coalesce("mass", F.lit(0.0)), F.lit(0.0)) / (F.col("n") * F.col("h")) / F.lit(2.5066282746310002)).alias("density"),
    )


def _fit_line(df, x, y, keys):
    data = normalize_missing(df.select(F.col(f"`{x}`").cast("double").alias("x"), F.col(f"`{y}`").cast("double").alias("y"), *keys)).dropna()
    base = data.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.regr_slope("y", "x").alias("slope"), F.regr_intercept("y", "x").alias("intercept"),
        F.regr_r2("y", "x").alias("r2"), F.avg("x").alias("x_mean"), F.regr_sxx("y", "x").alias("sxx"),
        F.regr_syy("y", "x").alias("_syy"), F.min("x").alias("x_min"), F.max("x").alias("x_max"),
    )
    spare = F.nullif((F.col("n") - 2).cast("double"), F.lit(0.0))
    return base.withColumn("sigma", F.sqrt(F.greatest(F.col("_syy") * (F.lit(1.0) - F.col("r2")), F.lit(0.0)) / spare))


def regression_line(df: DataFrame, x: str, y: str, by: str | None = None) -> DataFrame:
    """Least squares ``(by, n, slope, intercept, r2, x_mean, sxx, sigma)``; ``regression_band`` has its confidence band."""
    keys = [by] if by else []
    return _fit_line(df, x, y, keys).select(*keys, "n", "slope", "intercept", "r2", "x_mean", "sxx", "sigma")


def regression_band(df: DataFrame, x: str, y: str, by: str | None = None, grid: int = 100, level: float = 0.95) -> DataFrame:
    """The fitted line on ``grid`` points over the range of x, with the confidence band of the mean: ``(by, point, x, fit, lo, hi)``.

    The band is fit -+ t * sigma * sqrt(1/n + (x - mean)^2 / sxx), with the quantile of Student's t on n - 2 degrees of
    freedom; it is NULL for two rows. Groups whose x is constant, or of a single row, have no line.
    """
    if grid < 2 or not 0 < level < 1:
        raise ValueError("grid must be 2 at least and level between 0 and 1")
    keys = [by] if by else []
    fits = _fit_line(df, x, y, keys).where("sxx > 0").withColumn("t", t_quantile(F.lit((1 + level) / 2), (F.col("n") - 2).cast("double")))
    points = fits.withColumn("point", F.explode(F.sequence(F.lit(0), F.lit(grid - 1))))
    at = F.when(F.col("point") == grid - 1, F.col("x_max")).otherwise(F.col("x_min") + F.col("point") * (F.col("x_max") - F.col("x_min")) / float(grid - 1))
    points = points.withColumn("x", at).withColumn("fit", F.col("intercept") + F.col("slope") * F.col("x"))
    gap = F.col("x") - F.col("x_mean")
    half = F.col("t") * F.col("sigma") * F.sqrt(1.0 / F.col("n") + gap * gap / F.col("sxx"))
    return points.select(*keys, "point", "x", "fit", (F.col("fit") - half).alias("lo"), (F.col("fit") + half).alias("hi"))


def scatter_sample(df: DataFrame, key: str, cols: Sequence[str], n: int, by: str | None = None, seed: int = 123) -> DataFrame:
    """``n`` points per group, those with the least keyed hashes: the same rows on every run.

    A group of N rows needs about the n / N share of the hashes: rows above a cut somewhat beyond it are left out
    before any ranking, and the cut is raised in the rare case that it left too few. So only about n rows of a group are ranked.
    """
    keys = [by] if by else []
    hashed = df.select(key, *keys, *cols, F.md5(F.concat_ws("|", F.col(f"`{key}`").cast("string"), F.lit(str(seed)))).alias("_h"))
    if not by:
        return hashed.orderBy("_h", key).limit(n).drop("_h")
    groups = hashed.groupBy(by).agg(F.count(F.lit(1)).alias("_n"))
    share = F.conv(F.substr("_h", F.lit(1), F.lit(12)), 16, 10).cast("double") / float(16**12)
    slack = n + 10 * math.sqrt(n) + 30
    while True:
        cut = groups.select(F.struct(by).alias("_g"), F.when(F.col("_n") > slack, F.lit(float(slack)) / F.col("_n")).otherwise(F.lit(2.0)).alias("_cut"), "_n")
        under = join_group_rows(hashed.withColumn("_g", F.struct(by)), cut, ["_g"], "_n").where(share < F.col("_cut"))
        left = under.groupBy("_g", "_n").agg(F.count(F.lit(1)).alias("_left"))
        if left.where((F.col("_left") < n) & (F.col("_left") < F.col("_n"))).isEmpty() and left.count() == groups.count():
            break
        slack *= 4
    ordered = Window.partitionBy("_g").orderBy("_h", key)
    return under.withColumn("_r", F.row_number().over(ordered)).where(F.col("_r") <= n).select(key, *keys, *cols)


def scatter_density(df: DataFrame, x: str, y: str, bins: int = 50) -> DataFrame:
    """2-D counts ``(x_bin, y_bin, n)``: every row, at a size fit for a chart."""
    data = normalize_missing(df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"))).dropna()
    span = data.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()

    def place(c, low, high):
        if low is None or high == low:
            return F.lit(0)
        return F.least(F.floor((F.col(c) - F.lit(low)) / F.lit((high - low) / bins)).cast("int"), F.lit(bins - 1))

    return data.groupBy(place("x", span[0], span[1]).alias("x_bin"), place("y", span[2], span[3]).alias("y_bin")).agg(
        F.count(F.lit(1)).alias("n")
    )
