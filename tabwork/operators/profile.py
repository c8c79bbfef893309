"""Table profiling: info, describe, value counts, group means, crosstabs, Simpson check."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabwork.functions.columns import numeric_columns, sorted_levels
from tabwork.functions.missing import nan_to_null, normalize_missing
from tabwork.operators.quantile import approximate_quantiles, exact_quantiles


def shape(df: DataFrame) -> tuple[int, int]:
    return df.count(), len(df.columns)


def first_rows(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """First ``n`` rows under an explicit order (a top-n, not a full sort)."""
    return df.orderBy(*order).limit(n)


def table_info(df: DataFrame) -> DataFrame:
    """``(position, column, type, non_null)`` from one pass over the table."""
    wide = df.agg(*[
        F.count(nan_to_null(f.name, f.dataType)).alias(f"c{i}") for i, f in enumerate(df.schema)
    ])
    return wide.select(F.inline(F.array(*[
        F.struct(
            F.lit(i).alias("position"), F.lit(f.name).alias("column"),
            F.lit(f.dataType.simpleString()).alias("type"), F.col(f"c{i}").alias("non_null"),
        )
        for i, f in enumerate(df.schema)
    ])))


def describe(
    df: DataFrame, cols: Sequence[str] | None = None, by: Sequence[str] = (), exact: bool = True
) -> DataFrame:
    """``(by..., column, count, mean, std, min, q25, q50, q75, max)`` per numeric column.

    ``exact=False`` takes the quartiles from sketches (see ``approximate_quantiles``).
    """
    by = list(by)
    cols = numeric_columns(df, exclude=by) if cols is None else list(cols)
    data = normalize_missing(df.select(*by, *cols), cols)
    aggs = []
    for i, c in enumerate(cols):
        x = F.col(f"`{c}`").cast("double")
        aggs += [
            F.count(x).alias(f"n{i}"), F.avg(x).alias(f"a{i}"), F.stddev_samp(x).alias(f"s{i}"),
            F.min(x).alias(f"l{i}"), F.max(x).alias(f"h{i}"),
        ]
    stats = data.groupBy(*by).agg(*aggs).select(*by, F.inline(F.array(*[
        F.struct(*[
            F.lit(c).alias("column"), F.col(f"n{i}").alias("count"), F.col(f"a{i}").alias("mean"),
            F.col(f"s{i}").alias("std"), F.col(f"l{i}").alias("min"), F.col(f"h{i}").alias("max"),
        ])
        for i, c in enumerate(cols)
    ])))
    quantiles = (exact_quantiles if exact else approximate_quantiles)(data, cols, [0.25, 0.5, 0.75], by=by).drop("n")
    right = quantiles.select(*[F.col(b).alias(f"_{b}") for b in by], F.col("column").alias("_column"), "q")
    match = F.col("column") == F.col("_column")
    for b in by:
        match = match & F.col(b).eqNullSafe(F.col(f"_{b}"))
    stats = stats.join(right, match, "left")
    return stats.select(
        *by, "column", "count", "mean", "std", "min",
        F.get("q", F.lit(0)).alias("q25"), F.get("q", F.lit(1)).alias("q50"), F.get("q", F.lit(2)).alias("q75"), "max",
    )


def value_counts(df: DataFrame, cols: Sequence[str] | None = None, top: int | None = None) -> DataFrame:
    """``(column, value, count)`` without missing values.

    One column keeps its type; several are cast to text and counted in one job. ``top`` keeps the most frequent values
    of each column, equal counts by value: tasks keep their own top before they meet, so no column is sorted whole.
    """
    cols = df.columns if cols is None else list(cols)
    data = normalize_missing(df.select(*cols))
    if len(cols) == 1:
        long = data.select(F.lit(cols[0]).alias("column"), F.col(f"`{cols[0]}`").alias("value"))
    else:
        long = data.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in cols
        ])))
    counts = long.where("value is not null").groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    if top is None:
        return counts
    best = Window.partitionBy("column").orderBy(F.desc("count"), F.asc("value"))
    return counts.withColumn("_place", F.row_number().over(best)).where(F.col("_place") <= top).drop("_place")


def top_values(df: DataFrame, column: str, n: int | None = None) -> DataFrame:
    """Value counts of one column, most frequent first, equal counts by value."""
    ordered = value_counts(df, [column]).drop("column").orderBy(F.desc("count"), F.asc("value"))
    return ordered if n is None else ordered.limit(n)


def group_means(df: DataFrame, keys: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    """Mean per group of ``cols``, or of every numeric column. Rows with a missing key are left out."""
    keys = list(keys)
    cols = numeric_columns(df, exclude=keys) if cols is None else list(cols)
    data = normalize_missing(df.select(*keys, *cols)).dropna(subset=keys)
    return data.groupBy(*keys).agg(*[F.avg(f"`{c}`").alias(c) for c in cols])


def group_sizes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return normalize_missing(df.select(*keys)).dropna().groupBy(*keys).agg(F.count(F.lit(1)).alias("size"))


def crosstab(df: DataFrame, a: str, b: str, wide: bool = False, max_levels: int = 1000) -> DataFrame:
    """Counts of value pairs: long ``(a, b, n)``, or a matrix with 0 for absent pairs."""
    data = normalize_missing(df.select(a, b)).dropna()
    if not wide:
        return data.groupBy(a, b).agg(F.count(F.lit(1)).alias("n"))
    levels = sorted_levels(data, b, max_levels)
    return data.groupBy(a).pivot(b, levels).agg(F.count(F.lit(1))).fillna(0)


def simpson_check(df: DataFrame, x: str, by: str, control: str, a, b) -> DataFrame:
    """Mean difference ``b - a`` of ``x`` overall and inside each stratum of ``control``.

    The overall row has a NULL stratum; ``reversed`` marks strata whose difference
    has the opposite sign.
    """
    data = normalize_missing(df.select(x, by, control)).dropna(subset=[by, control])
    mean = lambda level: F.avg(F.when(F.col(by) == F.lit(level), F.col(x)))
    overall = data.agg(mean(a).alias("a"), mean(b).alias("b")).first()
    diff = None if overall.a is None or overall.b is None else overall.b - overall.a
    means = data.rollup(control).agg(
        F.grouping(control).cast("int").alias("is_overall"), mean(a).alias("mean_a"), mean(b).alias("mean_b")
    )
    delta = F.col("mean_b") - F.col("mean_a")
    return means.select(
        control, "is_overall", "mean_a", "mean_b", delta.alias("diff"),
        (F.signum(delta) * F.lit(diff).cast("double") < 0).alias("reversed"),
    )
