"""Helpers of the query catalogue: loading tables, and fixed derived tables as SQL text.

Derived tables add the missing values the given tables lack.  Their text names
tables in braces, so the same text serves Spark and the SQL check.
"""

from __future__ import annotations

import string
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

ORDERS_MASKED = """
SELECT o_orderkey, o_custkey, o_orderdate,
       CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS price,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS status,
       CASE WHEN o_orderkey % 3 <> 0 THEN NULL ELSE o_orderpriority END AS priority,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE CAST(o_custkey % 10 AS DOUBLE) END AS grade
FROM {orders}"""

PART_MASKED = """
SELECT p_partkey, p_type, p_retailprice,
       CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE CAST(p_size - 5 AS DOUBLE) END AS rooms,
       CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE CAST(p_size % 3 AS DOUBLE) END AS units
FROM {part}"""

LINEITEM_MASKED = """
SELECT l_orderkey, l_linenumber, l_returnflag,
       CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE l_quantity END AS a,
       CASE WHEN l_orderkey % 13 = 0 THEN NULL ELSE CAST(l_linenumber * 7 AS DOUBLE) END AS b,
       CASE WHEN l_orderkey % 17 = 0 THEN NULL ELSE l_extendedprice / 2000 END AS c
FROM {lineitem}"""

DOCS_LABELLED = """
SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
FROM {documents} d LEFT JOIN {labels} l ON d.doc_id = l.doc_id"""


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _names(text: str) -> set[str]:
    return {field for _, field, _, _ in string.Formatter().parse(text) if field}


def derive(spark: SparkSession, sf: str, text: str) -> DataFrame:
    return spark.sql(text, **{n: table(spark, sf, n) for n in _names(text)})


def plain(text: str) -> str:
    """The text with plain table names, for the SQL check."""
    return text.format(**{n: n for n in _names(text)})


def rd(column: Column | str, digits: int) -> Column:
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column, digits)


def sql_rd(expression: str, digits: int) -> str:
    """Rounding in the SQL check; adding zero turns -0.0 into 0.0."""
    return f"(round({expression}, {digits}) + 0e0)"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder in the shared storage that ``spark.checkpoint.dir`` names.

    Only a local master, whose tasks all see the same disk, may go without that setting.
    """
    shared = spark.conf.get("spark.checkpoint.dir", "")
    if not shared:
        if not spark.conf.get("spark.master", "").startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="tabwork-")
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
