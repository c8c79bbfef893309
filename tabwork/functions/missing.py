"""Missing-value rules shared by every operator.

A value is missing when it is NULL or, for floating columns, NaN.  Operators
turn NaN into NULL first, so that Spark's own NULL handling then gives the
wanted answer.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType


def nan_to_null(name: str, dtype) -> Column:
    if isinstance(dtype, (DoubleType, FloatType)):
        return F.expr(f"nanvl(`{name}`, CAST(NULL AS {dtype.simpleString()}))").alias(name)
    return F.col(f"`{name}`")


def normalize_missing(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """NaN becomes NULL in every float/double column (or in ``cols`` only)."""
    wanted = {
        f.name: nan_to_null(f.name, f.dataType)
        for f in df.schema
        if isinstance(f.dataType, (DoubleType, FloatType)) and (cols is None or f.name in cols)
    }
    return df.withColumns(wanted) if wanted else df


def not_true(condition: Column) -> Column:
    """Negation that keeps rows where the condition is unknown."""
    return ~F.coalesce(condition, F.lit(False))


def differs(a: Column, b: Column) -> Column:
    """Inequality where a missing side counts as different, even on both sides."""
    return F.coalesce(a != b, F.lit(True))


def agrees(a: Column, b: Column) -> Column:
    """Equality where a missing side counts as unequal."""
    return F.coalesce(a == b, F.lit(False))


def excess_over(x: Column, bound: Column | float) -> Column:
    """Distance above ``bound``, 0 below it; missing stays missing."""
    bound = bound if isinstance(bound, Column) else F.lit(float(bound))
    return F.when(x.isNotNull(), F.greatest(x - bound, F.lit(0.0)))
