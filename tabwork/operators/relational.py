"""Latest record per key, and enrichment by lookup joins."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, keys: Sequence[str], order: str, ties: str = "keep", tie_break: Sequence[str] = ()
) -> DataFrame:
    """Rows holding the greatest ``order`` of their key.

    ``ties='keep'`` keeps every row on the last value.  The maximum is combined
    map-side, and the semi join shuffles on (key, order), so the rows of one hot
    key spread over many tasks; a rank() window would sort them in one.

    ``ties='first'`` keeps one row per key, the one with the greatest
    ``tie_break`` among the tied.  It is one aggregation with map-side combine:
    a key, however hot, sends at most one row per map task.

    Rows with a missing key or order value never match, as in a SQL self-join.
    """
    keys = list(keys)
    present = df.dropna(subset=[*keys, order])
    if ties == "keep":
        newest = present.groupBy(*keys).agg(F.max(order).alias(order))
        return present.join(newest, [*keys, order], "left_semi").select(*df.columns)
    if ties != "first":
        raise ValueError("ties must be 'keep' or 'first'")
    if not tie_break:
        raise ValueError("ties='first' needs tie_break columns that make the order total")
    rest = [c for c in df.columns if c not in keys]
    best = present.groupBy(*keys).agg(
        F.max_by(F.struct(*rest), F.struct(order, *tie_break)).alias("_row")
    )
    return best.select(*keys, "_row.*").select(*df.columns)


def enrich(df: DataFrame, lookups: Iterable[tuple[DataFrame, str, Sequence[str]]]) -> DataFrame:
    """Chain of left joins ``(lookup, key, columns)``; unmatched rows stay, with NULL.

    No broadcast hint: Spark broadcasts a lookup when its measured size is under
    ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, where adaptive
    execution splits a skewed (for example all-NULL) key on the left side.
    """
    for lookup, key, columns in lookups:
        df = df.join(lookup.select(key, *columns), key, "left")
    return df
