"""Column selection, re-typing, recoding and one-hot helpers."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, DoubleType, FloatType, NumericType


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Names of the numeric columns; re-typed categorical ids are strings and so left out."""
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType) and f.name not in exclude]


def columns_ending(df: DataFrame, suffix: str) -> list[str]:
    return [c for c in df.columns if c.endswith(suffix)]


def drop_columns(df: DataFrame, cols: Sequence[str], strict: bool = True) -> DataFrame:
    """Drop by name. Spark ignores unknown names; ``strict`` makes them an error."""
    unknown = [c for c in cols if c not in df.columns]
    if strict and unknown:
        raise KeyError(f"columns not found: {unknown}")
    return df.drop(*cols)


def as_categorical(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Turn id columns into text, so that numeric operators skip them.

    Fractional types go through bigint: 6037.0 becomes '6037', not '6037.0'.
    """
    changed = {}
    for name in cols:
        dtype = df.schema[name].dataType
        column = F.col(f"`{name}`")
        if isinstance(dtype, (DoubleType, FloatType)):
            column = F.nanvl(column, F.lit(None).cast(dtype)).cast("bigint")
        elif isinstance(dtype, DecimalType):
            column = column.cast("bigint")
        changed[name] = column.cast("string")
    return df.withColumns(changed)


def map_codes(column: Column, mapping: Mapping) -> Column:
    """Code to label; codes outside the mapping become missing."""
    result = None
    for code, label in mapping.items():
        test = column == F.lit(code)
        result = F.when(test, F.lit(label)) if result is None else result.when(test, F.lit(label))
    if result is None:
        raise ValueError("empty mapping")
    return result


def sorted_levels(df: DataFrame, column: str, max_levels: int) -> list:
    """Distinct non-missing values of a column, sorted; an error beyond ``max_levels``.

    The limit sits on top of the distinct, so at most ``max_levels + 1`` values
    reach the driver.
    """
    rows = (
        df.select(F.col(f"`{column}`").alias("v")).where("v is not null").distinct()
        .limit(max_levels + 1).collect()
    )
    if len(rows) > max_levels:
        raise ValueError(f"{column} has more than {max_levels} levels")
    return sorted(r.v for r in rows)


def one_hot(
    df: DataFrame,
    column: str,
    drop_first: bool = True,
    max_levels: int = 200,
    rename: Mapping[str, str] | None = None,
    levels: Sequence | None = None,
    prefix: str = "",
) -> DataFrame:
    """Add one 0/1 column per level, named ``prefix`` and the level; a missing value gives 0 everywhere.

    A name that the table has already, or that two levels share, is an error: no column is replaced.
    """
    levels = sorted_levels(df, column, max_levels) if levels is None else list(levels)
    rename = rename or {}
    kept = levels[1:] if drop_first else levels
    source = F.col(f"`{column}`")
    names = [rename.get(str(level), prefix + str(level)) for level in kept]
    taken = {c.lower() for c in df.columns}
    clashes = sorted({n for i, n in enumerate(names) if n.lower() in taken or n.lower() in {m.lower() for m in names[:i]}})
    if clashes:
        raise ValueError(f"columns exist already or twice: {clashes}; give a prefix or rename them")
    return df.withColumns({name: F.coalesce((source == F.lit(level)).cast("int"), F.lit(0)) for name, level in zip(names, kept)})
