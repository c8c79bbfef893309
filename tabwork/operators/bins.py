"""Upper outliers and quantile bins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwork.functions.columns import columns_ending, numeric_columns
from tabwork.functions.missing import excess_over, normalize_missing
from tabwork.operators.profile import describe
from tabwork.operators.quantile import quantile_dict

SUFFIX = "_outliers"


def upper_fences(df: DataFrame, cols: Sequence[str], k: float) -> dict[str, float | None]:
    """Q3 + k * IQR of every column, from one quantile run."""
    quartiles = quantile_dict(df, cols, [0.25, 0.75])
    return {c: None if q is None else q[1] + k * (q[1] - q[0]) for c, q in quartiles.items()}


def upper_outliers(df: DataFrame, k: float, cols: Sequence[str] | None = None) -> DataFrame:
    """Add ``<column>_outliers``: distance above the upper fence, else 0; missing stays missing."""
    cols = numeric_columns(df) if cols is None else list(cols)
    data = normalize_missing(df)
    fences = upper_fences(data, cols, k)
    return data.withColumns({
        c + SUFFIX: F.lit(None).cast("double") if fences[c] is None
        else excess_over(F.col(f"`{c}`").cast("double"), fences[c])
        for c in cols
    })


def outlier_summary(df: DataFrame, suffix: str = SUFFIX) -> DataFrame:
    """describe() of the positive values of each outlier column, all columns together."""
    cols = columns_ending(df, suffix)
    positive = df.select(*[F.when(F.col(f"`{c}`") > 0, F.col(f"`{c}`")).alias(c) for c in cols])
    return describe(positive, cols)


def quantile_edges(df: DataFrame, column: str, q: int) -> list[float]:
    edges = quantile_dict(df, [column], [i / q for i in range(q + 1)])[column]
    if edges is None:
        raise ValueError(f"{column} has no values")
    if len(set(edges)) < len(edges):
        raise ValueError(f"bin edges of {column} are not unique: {edges}")
    return edges


def qcut(df: DataFrame, column: str, q: int, out: str) -> DataFrame:
    """Add ``out``: struct<bin, lo, hi> of right-closed quantile bins, lowest value included."""
    edges = quantile_edges(df, column, q)
    x = F.nanvl(F.col(f"`{column}`").cast("double"), F.lit(None).cast("double"))
    value = None
    for i in range(q):
        cell = F.struct(
            F.lit(i).alias("bin"), F.lit(float(edges[i])).alias("lo"), F.lit(float(edges[i + 1])).alias("hi")
        )
        inside = (x <= F.lit(float(edges[i + 1]))) & (x >= F.lit(float(edges[0])))
        value = F.when(inside, cell) if value is None else value.when(inside, cell)
    return df.withColumn(out, value)


def in_bin(df: DataFrame, out: str, i: int) -> DataFrame:
    """Rows of one quantile bin."""
    return df.where(F.col(f"{out}.bin") == i)
