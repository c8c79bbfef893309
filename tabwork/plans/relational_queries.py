"""Queries: joins, latest record per key, sources and sinks, column expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwork.functions.columns import as_categorical, columns_ending, drop_columns, map_codes, numeric_columns, one_hot
from tabwork.functions.missing import agrees, differs, excess_over, normalize_missing, not_true
from tabwork.operators.profile import first_rows, shape
from tabwork.operators.relational import enrich, latest_per_key
from tabwork.plans.base import (
    LINEITEM_MASKED, ORDERS_MASKED, PART_MASKED, derive, plain, rd, scratch_path, sql_rd, table,
)
from tabwork.sources.tables import acquire_cached, read_csv, read_table, run_sql, write_csv

# Customers with a nation code that may be missing or unknown, so that lookups leave NULLs.
CUSTOMER_CODED = """
SELECT c_custkey, c_name, c_acctbal,
       CAST(CASE WHEN c_custkey % 11 = 0 THEN NULL WHEN c_custkey % 7 = 0 THEN c_nationkey + 100 ELSE c_nationkey END AS DOUBLE) AS nation_id
FROM {customer}"""
DATE_TEXT = "CAST(CAST(o_orderdate AS DATE) AS STRING)"


def _latest(spark, sf, ties):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    newest = latest_per_key(orders, ["o_custkey"], "o_orderdate", ties, ["o_orderkey"] if ties == "first" else ())
    newest = newest.where("o_orderdate >= '2001-01-01' and o_orderdate < '2002-01-01'")
    joined = derive(spark, sf, CUSTOMER_CODED).where("c_name is not null and c_acctbal is not null").join(
        newest.select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", "o_totalprice", "o_orderdate"), "c_custkey"
    )
    nations = table(spark, sf, "nation").withColumn("nation_id", F.col("n_nationkey").cast("double"))
    regions = table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    wide = enrich(joined, [(nations, "nation_id", ["n_name", "n_regionkey"]), (regions, "n_regionkey", ["r_name"])])
    return wide.select(
        "c_custkey", "c_name", "c_acctbal", "nation_id", "o_orderkey", "o_totalprice",
        F.expr(DATE_TEXT).alias("order_date"), "n_name", "r_name",
    )


def latest_txn_enriched(spark, sf):
    return _latest(spark, sf, "keep")


def latest_txn_first_only(spark, sf):
    return _latest(spark, sf, "first")


NESTED_SQL = """
SELECT buyer.c_custkey, buyer.c_name, buyer.c_acctbal, buyer.nation_id, final.o_orderkey, final.o_totalprice,
       CAST(final.placed AS STRING) AS order_date, home.n_name, home.r_name
FROM (
    SELECT o_custkey, o_orderkey, o_totalprice, to_date(o_orderdate) AS placed
    FROM {orders} LEFT SEMI JOIN (
        SELECT o_custkey AS who, max(o_orderdate) AS at FROM {orders} GROUP BY o_custkey HAVING year(max(o_orderdate)) = 2001
    ) latest ON o_custkey = who AND o_orderdate = at
) final
JOIN (SELECT * FROM {customer_coded} WHERE c_name IS NOT NULL AND c_acctbal IS NOT NULL) buyer ON buyer.c_custkey = final.o_custkey
LEFT JOIN (SELECT n_nationkey, n_name, r_name FROM {nation} LEFT JOIN {region} ON r_regionkey = n_regionkey) home ON home.n_nationkey = buyer.nation_id
"""


def latest_txn_sql_text(spark, sf):
    """Nested tables in one SQL text; its check is the window form of the same question."""
    tables = {n: table(spark, sf, n) for n in ("orders", "nation", "region")}
    return run_sql(spark, NESTED_SQL, {"customer_coded": derive(spark, sf, CUSTOMER_CODED), **tables})


def full_table_select(spark, sf):
    return run_sql(spark, "SELECT * FROM {customer}", {"customer": table(spark, sf, "customer")})


def csv_write_read(spark, sf):
    path = scratch_path(spark, "csv")
    customer = table(spark, sf, "customer")
    write_csv(customer, path)
    return read_csv(spark, path, schema=customer.schema)


def csv_stored_index(spark, sf):
    """A CSV with an index stored in a column without a name, its types found by reading."""
    path = scratch_path(spark, "csv")
    orders = table(spark, sf, "orders")
    write_csv(orders.select((F.col("o_orderkey") * 3).alias("i"), "o_orderkey", rd("o_totalprice", 2).alias("price"), "o_orderstatus").toDF("", "number", "price", "status"), path)
    df = read_csv(spark, path)
    return df.withColumn("types", F.concat_ws(",", *[F.typeof(c) for c in df.columns]))


def cached_acquire(spark, sf):
    path = scratch_path(spark, "cache")
    build = lambda: derive(spark, sf, ORDERS_MASKED).groupBy("status").agg(F.count("price").alias("n_price"), F.max("price").alias("max_price"))
    acquire_cached(spark, build, path)
    return acquire_cached(spark, build, path)


def single_unit_filter(spark, sf):
    parts = derive(spark, sf, PART_MASKED)
    return parts.where(F.col("p_type").isin("STANDARD", "SMALL", "ECONOMY") & (F.col("rooms") > 0)).select("p_partkey", "p_type", "rooms", "units")


def keep_unknown_units(spark, sf):
    return derive(spark, sf, PART_MASKED).where(not_true(F.col("units") > 1)).select("p_partkey", "units")


def stacked_masks(spark, sf):
    li = table(spark, sf, "lineitem")
    return li.where((F.col("l_returnflag") == "R") & (F.col("l_linestatus") == "O")).select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )


def col_mismatch_rows(spark, sf):
    df = normalize_missing(derive(spark, sf, LINEITEM_MASKED))
    return df.where(differs(F.col("a"), F.col("b"))).select("l_orderkey", "l_linenumber", "a", "b")


def col_agreement_share(spark, sf):
    df = normalize_missing(derive(spark, sf, LINEITEM_MASKED))
    return df.agg(rd(F.avg(agrees(F.col("a"), F.col("b")).cast("int")), 8).alias("share"))


def row_min(spark, sf):
    df = normalize_missing(derive(spark, sf, LINEITEM_MASKED))
    return df.select("l_orderkey", "l_linenumber", rd(F.least("a", "b", "c"), 6).alias("smallest"))


def clip_at_zero(spark, sf):
    df = normalize_missing(derive(spark, sf, LINEITEM_MASKED))
    return df.select("l_orderkey", "l_linenumber", excess_over(F.col("a"), 30.0).alias("excess"))


def code_to_label(spark, sf):
    label = map_codes(F.col("c_nationkey"), {3: "Los Angeles", 7: "Orange", 11: "Ventura"})
    return table(spark, sf, "customer").select("c_custkey", label.alias("county"))


def categorical_ids(spark, sf):
    df = derive(spark, sf, ORDERS_MASKED)
    return as_categorical(df, ["o_custkey", "grade"]).select("o_orderkey", "o_custkey", "grade")


def one_hot_drop_first(spark, sf):
    df = derive(spark, sf, ORDERS_MASKED).select("o_orderkey", "status")
    return drop_columns(one_hot(df, "status", rename={"O": "is_open", "P": "is_pending"}), ["status"])


def one_hot_prefixed(spark, sf):
    """A table that has columns named as the levels already."""
    df = derive(spark, sf, ORDERS_MASKED).select("o_orderkey", "status", F.col("price").alias("O"), F.lit(1).alias("P"))
    return one_hot(df, "status", drop_first=False, prefix="status_").withColumn("O", rd("O", 2))


def numeric_and_suffix_columns(spark, sf):
    df = as_categorical(table(spark, sf, "lineitem"), ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"])
    numeric = df.select("l_orderkey", *numeric_columns(df))
    ending = columns_ending(numeric, "price")
    return numeric.groupBy().agg(
        *[rd(F.avg(c), 6).alias(f"mean_{c}") for c in numeric_columns(numeric)],
        *[F.max(c).alias(f"max_{c}") for c in ending],
    )


def ratio_and_percent(spark, sf):
    df = table(spark, sf, "lineitem")
    return df.select(
        "l_orderkey", "l_linenumber",
        rd(F.col("l_extendedprice") / F.col("l_quantity"), 8).alias("unit_price"), rd(F.col("l_discount") * 100, 6).alias("discount_pct"),
    )


def first_rows_ordered(spark, sf):
    return first_rows(table(spark, sf, "orders").select("o_orderkey", "o_totalprice"), ["o_totalprice", "o_orderkey"], 5)


def sorted_table(spark, sf):
    return table(spark, sf, "part").select("p_partkey", "p_name").orderBy("p_name", "p_partkey")


def table_shape(spark, sf):
    names = ("orders", "customer", "lineitem")
    rows = [(n, *shape(read_table(spark, "parquet", f"{sf}/{n}.parquet"))) for n in names]
    return spark.createDataFrame(rows, "name string, n_rows bigint, n_cols bigint")


QUERIES = {
    f.__name__: f for f in (
        latest_txn_enriched, latest_txn_first_only, latest_txn_sql_text, full_table_select, csv_write_read, cached_acquire,
        single_unit_filter, keep_unknown_units, stacked_masks, col_mismatch_rows, col_agreement_share, row_min, clip_at_zero,
        code_to_label, categorical_ids, one_hot_drop_first, one_hot_prefixed, csv_stored_index, numeric_and_suffix_columns, ratio_and_percent, first_rows_ordered,
        sorted_table, table_shape,
    )
}

_ORDERS, _PARTS, _LINES = plain(ORDERS_MASKED), plain(PART_MASKED), plain(LINEITEM_MASKED)


def _latest_sql(pick):
    return f"""
WITH ranked AS (
  SELECT *, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) AS rk,
         row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders)
SELECT c_custkey, c_name, c_acctbal, nation_id, o_orderkey, o_totalprice,
       CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date, n_name, r_name
FROM ({plain(CUSTOMER_CODED)}) c JOIN ranked ON c_custkey = o_custkey
LEFT JOIN nation ON nation_id = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey
WHERE {pick} = 1 AND o_orderdate >= TIMESTAMP '2001-01-01' AND o_orderdate < TIMESTAMP '2002-01-01'"""


ORACLE = {
    "latest_txn_enriched": _latest_sql("rk"),
    "latest_txn_first_only": _latest_sql("rn"),
    "latest_txn_sql_text": _latest_sql("rk"),
    "full_table_select": "SELECT * FROM customer",
    "csv_write_read": "SELECT * FROM customer",
    "cached_acquire": f"SELECT status, count(price) AS n_price, max(price) AS max_price FROM ({_ORDERS}) GROUP BY status",
    "single_unit_filter": f"SELECT p_partkey, p_type, rooms, units FROM ({_PARTS}) WHERE p_type IN ('STANDARD','SMALL','ECONOMY') AND rooms > 0",
    "keep_unknown_units": f"SELECT p_partkey, units FROM ({_PARTS}) WHERE (units > 1) IS NOT TRUE",
    "stacked_masks": "SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'O'",
    "col_mismatch_rows": f"SELECT l_orderkey, l_linenumber, a, b FROM ({_LINES}) WHERE (a = b) IS NOT TRUE",
    "col_agreement_share": f"SELECT {sql_rd('avg(CASE WHEN a = b THEN 1 ELSE 0 END)', 8)} AS share FROM ({_LINES})",
    "row_min": f"SELECT l_orderkey, l_linenumber, {sql_rd('least(a, b, c)', 6)} AS smallest FROM ({_LINES})",
    "clip_at_zero": f"SELECT l_orderkey, l_linenumber, CASE WHEN a > 30 THEN a - 30 WHEN a IS NOT NULL THEN 0e0 END AS excess FROM ({_LINES})",
    "code_to_label": "SELECT c_custkey, CASE c_nationkey WHEN 3 THEN 'Los Angeles' WHEN 7 THEN 'Orange' WHEN 11 THEN 'Ventura' END AS county FROM customer",
    "categorical_ids": f"SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, CAST(CAST(grade AS BIGINT) AS VARCHAR) AS grade FROM ({_ORDERS})",
    "one_hot_drop_first": f"SELECT o_orderkey, CASE WHEN status = 'O' THEN 1 ELSE 0 END AS is_open, CASE WHEN status = 'P' THEN 1 ELSE 0 END AS is_pending FROM ({_ORDERS})",
    "one_hot_prefixed": f"SELECT o_orderkey, status, {sql_rd('price', 2)} AS \"O\", 1 AS \"P\", " + ", ".join(
        f"CASE WHEN status = '{v}' THEN 1 ELSE 0 END AS \"status_{v}\"" for v in "FOP") + f" FROM ({_ORDERS})",
    "csv_stored_index": f"SELECT CAST(o_orderkey AS INT) AS number, {sql_rd('o_totalprice', 2)} AS price, o_orderstatus AS status, 'int,double,string' AS types FROM orders",
    "numeric_and_suffix_columns": "SELECT " + ", ".join(
        f"{sql_rd(f'avg({c})', 6)} AS mean_{c}" for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
    ) + ", max(l_extendedprice) AS max_l_extendedprice FROM lineitem",
    "ratio_and_percent": f"SELECT l_orderkey, l_linenumber, {sql_rd('l_extendedprice / l_quantity', 8)} AS unit_price, {sql_rd('l_discount * 100', 6)} AS discount_pct FROM lineitem",
    "first_rows_ordered": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 5",
    "sorted_table": "SELECT p_partkey, p_name FROM part ORDER BY p_name, p_partkey",
    "table_shape": "SELECT 'orders' AS name, count(*) AS n_rows, CAST(6 AS BIGINT) AS n_cols FROM orders UNION ALL SELECT 'customer', count(*), 5 FROM customer UNION ALL SELECT 'lineitem', count(*), 11 FROM lineitem",
}
