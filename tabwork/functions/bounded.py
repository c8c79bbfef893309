"""Broadcast behind a check of size."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

MAX_ROWS = 50_000
#: Bytes of one text in a broadcast row; with the rows this bounds what is sent.
MAX_TEXT = 256


def rows_if_small(df: DataFrame, max_rows: int = MAX_ROWS) -> list[Row] | None:
    """The rows of ``df``, or None if there are more than ``max_rows`` or one has a text beyond ``MAX_TEXT`` bytes; such a text is never fetched."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, (StringType, BinaryType))]
    if not texts:
        rows = df.limit(max_rows + 1).collect()
    else:
        short = reduce(Column.__and__, [F.coalesce(F.octet_length(F.col(f"`{c}`")), F.lit(0)) <= MAX_TEXT for c in texts])
        rows = [r[0] for r in df.select(F.when(short, F.struct(*[F.col(f"`{c}`") for c in df.columns]))).limit(max_rows + 1).collect()]
    return None if len(rows) > max_rows or None in rows else rows


def broadcast_if_small(df: DataFrame, max_rows: int = MAX_ROWS) -> DataFrame:
    """Meant for aggregated frames that join back to the rows they came from.

    Up to ``max_rows`` rows of bounded width are fetched once and broadcast, so the large side is not
    shuffled and the aggregate is not computed again.  Beyond that the frame is
    returned as it is, and the join shuffles, with adaptive skew handling.
    """
    rows = rows_if_small(df, max_rows)
    return df if rows is None else F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))


#: A group with more than this share of the rows is hot; there can be no more than its inverse of them.
HOT_SHARE = 0.001


def join_group_rows(data: DataFrame, stats: DataFrame, by: list[str], count: str = "n", max_rows: int = MAX_ROWS, how: str = "inner") -> DataFrame:
    """``data`` with the columns of its group's row in ``stats`` (one row per group, rows of the group in ``count``).

    Few groups are broadcast. Of many, those with more than ``HOT_SHARE`` of the rows are broadcast, as they are
    few by arithmetic, so their rows stay where they are; the others are small and meet in a shuffled join. Rows
    without a group there, and NULL groups, are left out unless ``how`` is "left".
    """
    rows = rows_if_small(stats, max_rows)
    if rows is not None:
        return data.join(F.broadcast(data.sparkSession.createDataFrame(rows, stats.schema)), by, how)
    total = stats.agg(F.sum(count)).first()[0]
    hot = stats.where(F.col(count) > HOT_SHARE * total)
    few = rows_if_small(hot, int(1 / HOT_SHARE))
    if few is None:  # only where texts of groups are wide
        return data.join(stats, by, how)
    marked = F.broadcast(data.sparkSession.createDataFrame(few, stats.schema))
    return data.join(marked, by).unionByName(data.join(marked.select(*by), by, "left_anti").join(stats, by, how))
