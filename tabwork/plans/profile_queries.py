"""Queries: profiling, aggregation, quantiles, bins and outliers."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwork.operators.bins import in_bin, outlier_summary, qcut, upper_outliers
from tabwork.operators.profile import (
    crosstab, describe, group_means, group_sizes, simpson_check, table_info, top_values, value_counts,
)
from tabwork.operators.quantile import approximate_quantiles, exact_quantiles
from tabwork.plans.base import DOCS_LABELLED, LINEITEM_MASKED, ORDERS_MASKED, derive, plain, rd, sql_rd, table

NUMBERS = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]
TENTHS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]


def _rounded(df, digits=4):
    doubles = {n for n, t in df.dtypes if t == "double"}
    return df.select(*[rd(F.col(f"`{c}`"), digits).alias(c) if c in doubles else F.col(f"`{c}`") for c in df.columns])


def table_info_masked(spark, sf):
    return table_info(derive(spark, sf, ORDERS_MASKED))


def describe_numeric(spark, sf):
    return _rounded(describe(table(spark, sf, "lineitem"), NUMBERS))


def describe_masked(spark, sf):
    return _rounded(describe(derive(spark, sf, ORDERS_MASKED), ["price", "grade"]))


def describe_by_group(spark, sf):
    return _rounded(describe(table(spark, sf, "events"), ["value"], by=["event_type"]))


def _near(df, asked):
    """Rows (column, rank, near) for the asked (column, rank, value): whether the value's rank in the column is within 1 % of the rows."""
    share = lambda test: F.avg(test.cast("double"))
    near = lambda r: (share(F.col(r["column"]) < r["value"]) <= r["rank"] + 0.01) & (share(F.col(r["column"]) <= r["value"]) >= r["rank"] - 0.01)
    cells = [F.struct(F.lit(r["column"]).alias("column"), F.lit(r["rank"]).alias("rank"), near(r).alias("near")) for r in asked]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def describe_approximate(spark, sf):
    """The whole table with sketched quartiles, which are given by whether each has its rank within 1 % of the rows."""
    df = table(spark, sf, "lineitem")
    found = describe(df, NUMBERS, exact=False)
    quartiles = [(r, q, f"q{round(100 * q)}") for r in found.collect() for q in (0.25, 0.5, 0.75)]
    near = _near(df, [{"column": r["column"], "rank": q, "value": r[name]} for r, q, name in quartiles])
    wide = near.groupBy("column").agg(*[F.bool_and(F.when(F.col("rank") == q, F.col("near"))).alias(f"q{round(100 * q)}_near") for q in (0.25, 0.5, 0.75)])
    return _rounded(found.drop("q25", "q50", "q75").join(wide, "column"))


def describe_approximate_quartiles(spark, sf):
    """The sketched quartiles alone, by whether each has its rank within 1 % of the rows."""
    df = table(spark, sf, "lineitem")
    rows = describe(df, NUMBERS, exact=False).collect()
    near = _near(df, [{"column": r["column"], "rank": n / 100, "value": r[f"q{n}"]} for r in rows for n in (25, 50, 75)])
    return near.select("column", F.round(F.col("rank") * 100).cast("int").alias("quartile"), "near")


def quantiles_sketched(spark, sf):
    """Sketched deciles of each event type, by whether each has its rank within 1 % of the type's rows."""
    df = table(spark, sf, "events")
    found = approximate_quantiles(df, ["value"], TENTHS, by=["event_type"]).select("event_type", "n", F.posexplode("q").alias("i", "at"))
    ranks = df.join(found, "event_type").groupBy("event_type", "n", "i").agg(
        F.avg((F.col("value") < F.col("at")).cast("double")).alias("below"), F.avg((F.col("value") <= F.col("at")).cast("double")).alias("upto"))
    want = F.get(F.array(*[F.lit(q) for q in TENTHS]), F.col("i"))
    return ranks.select("event_type", "n", "i", ((F.col("below") <= want + 0.01) & (F.col("upto") >= want - 0.01)).alias("near"))


def value_counts_one(spark, sf):
    return top_values(derive(spark, sf, ORDERS_MASKED), "status")


def value_counts_all(spark, sf):
    return value_counts(derive(spark, sf, ORDERS_MASKED), ["o_custkey", "status", "priority"])


def value_counts_top(spark, sf):
    """The three most frequent values of each column."""
    return value_counts(derive(spark, sf, ORDERS_MASKED), ["o_custkey", "status", "priority"], top=3)


def column_mean(spark, sf):
    return table(spark, sf, "orders").agg(rd(F.avg("o_totalprice"), 4).alias("mean_price"))


def filtered_means(spark, sf):
    df = table(spark, sf, "orders")
    pick = lambda s: F.avg(F.when(F.col("o_orderstatus") == s, F.col("o_totalprice")))
    return df.agg(*[rd(pick(s), 4).alias(f"mean_{s.lower()}") for s in "FOP"])


def group_means_one_key(spark, sf):
    return _rounded(group_means(derive(spark, sf, ORDERS_MASKED), ["status"], ["price"]))


def group_two_keys(spark, sf):
    return _rounded(group_means(table(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"], ["l_extendedprice"]))


def group_sizes_two_keys(spark, sf):
    return group_sizes(derive(spark, sf, DOCS_LABELLED), ["lang", "quality"])


def group_means_all_numeric(spark, sf):
    return _rounded(group_means(table(spark, sf, "lineitem").drop("l_orderkey", "l_partkey", "l_suppkey"), ["l_returnflag"]))


def crosstab_long(spark, sf):
    return crosstab(derive(spark, sf, ORDERS_MASKED), "status", "priority")


def crosstab_wide(spark, sf):
    wide = crosstab(derive(spark, sf, DOCS_LABELLED), "lang", "quality", wide=True)
    return wide.withColumnsRenamed({"0": "q0", "1": "q1"})


def _quantile_rows(frame, by=()):
    at = F.posexplode("q").alias("i", "v")
    return frame.select(*by, "column", at).select(*by, "column", "i", rd("v", 6).alias("value"))


def quantiles_exact(spark, sf):
    return _quantile_rows(exact_quantiles(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"], TENTHS))


def quantiles_by_cells(spark, sf):
    """The path of columns with very many distinct values, taken for every column."""
    return _quantile_rows(exact_quantiles(
        table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"], TENTHS, max_distinct=0, cell_rows=5000
    ))


def quantiles_by_group(spark, sf):
    return _quantile_rows(exact_quantiles(table(spark, sf, "events"), ["value"], TENTHS, by=["event_type"]), ["event_type"])


def quantiles_by_group_cells(spark, sf):
    return _quantile_rows(exact_quantiles(
        table(spark, sf, "events"), ["value"], TENTHS, by=["event_type"], max_distinct=0, cell_rows=500
    ), ["event_type"])


def simpson_reversal(spark, sf):
    df = simpson_check(table(spark, sf, "orders"), "o_totalprice", "o_orderstatus", "o_orderpriority", "F", "O")
    return _rounded(df)


def upper_outliers_columns(spark, sf):
    df = upper_outliers(table(spark, sf, "events").select("event_id", "value"), 1.5, ["value"])
    return df.select("event_id", "value", rd("value_outliers", 6).alias("value_outliers"))


def outliers_masked(spark, sf):
    df = upper_outliers(derive(spark, sf, LINEITEM_MASKED), 0.5, ["a", "c"])
    return df.select("l_orderkey", "l_linenumber", *[rd(f"{c}_outliers", 6).alias(f"{c}_outliers") for c in "ac"])


def outlier_summary_columns(spark, sf):
    df = upper_outliers(derive(spark, sf, LINEITEM_MASKED), 0.25, ["a", "b", "c"])
    return _rounded(outlier_summary(df), 6)


def qcut_bins(spark, sf):
    df = qcut(derive(spark, sf, ORDERS_MASKED), "price", 4, "cell")
    return df.select("o_orderkey", F.col("cell.bin").cast("double").alias("bin"), rd("cell.lo", 4).alias("lo"), rd("cell.hi", 4).alias("hi"))


def qcut_means(spark, sf):
    df = qcut(derive(spark, sf, ORDERS_MASKED), "price", 4, "cell").withColumn("bin", F.col("cell.bin"))
    return _rounded(group_means(df, ["bin"], ["grade"]), 8)


def qcut_one_bin(spark, sf):
    df = qcut(table(spark, sf, "orders"), "o_totalprice", 4, "cell")
    return in_bin(df, "cell", 2).select("o_orderkey", "o_totalprice")


QUERIES = {
    f.__name__: f for f in (
        table_info_masked, describe_numeric, describe_masked, describe_by_group, describe_approximate, describe_approximate_quartiles, quantiles_sketched, value_counts_one,
        value_counts_all, value_counts_top, column_mean, filtered_means, group_means_one_key, group_two_keys, group_sizes_two_keys,
        group_means_all_numeric, crosstab_long, crosstab_wide, quantiles_exact, quantiles_by_cells, quantiles_by_group,
        quantiles_by_group_cells, simpson_reversal, upper_outliers_columns, outliers_masked, outlier_summary_columns,
        qcut_bins, qcut_means, qcut_one_bin,
    )
}

_ORDERS, _LINES, _DOCS = plain(ORDERS_MASKED), plain(LINEITEM_MASKED), plain(DOCS_LABELLED)


def _describe_sql(source, cols, by="", digits=4, quartiles=True):
    group = f"GROUP BY {by}" if by else ""
    lead = f"{by}, " if by else ""
    quarter = lambda c: "".join(
        f", {sql_rd(f'quantile_cont(CAST({c} AS DOUBLE), {q})', digits)} AS {n}" for q, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75"))
    ) if quartiles else ""
    return " UNION ALL ".join(
        f"SELECT {lead}'{c}' AS \"column\", count({c}) AS count, {sql_rd(f'avg({c})', digits)} AS mean, "
        f"{sql_rd(f'stddev_samp({c})', digits)} AS std, CAST(min({c}) AS DOUBLE) AS min{quarter(c)}, CAST(max({c}) AS DOUBLE) AS max "
        f"FROM ({source}) {group}"
        for c in cols
    )


def _quantiles_sql(source, cols, by=""):
    lead, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return " UNION ALL ".join(
        f"SELECT {lead}'{c}' AS \"column\", {i} AS i, {sql_rd(f'quantile_cont({c}, {q})', 6)} AS value FROM {source} {group}"
        for c in cols for i, q in enumerate(TENTHS)
    )


_EDGES = "SELECT quantile_cont({0}, 0) e0, quantile_cont({0}, 0.25) e1, quantile_cont({0}, 0.5) e2, quantile_cont({0}, 0.75) e3, quantile_cont({0}, 1) e4 FROM ({1})"
_BIN = "CASE WHEN {0} <= e1 THEN 0 WHEN {0} <= e2 THEN 1 WHEN {0} <= e3 THEN 2 WHEN {0} <= e4 THEN 3 END"


def _excess(c, k, source):
    fence = f"(SELECT quantile_cont({c}, 0.75) + {k} * (quantile_cont({c}, 0.75) - quantile_cont({c}, 0.25)) FROM ({source}))"
    return f"CASE WHEN {c} IS NULL THEN NULL ELSE greatest({c} - {fence}, 0e0) END"


_SIMPSON = " UNION ALL ".join(
    f"SELECT {key} AS o_orderpriority, {flag} AS is_overall, avg(o_totalprice) FILTER (o_orderstatus = 'F') AS a, "
    f"avg(o_totalprice) FILTER (o_orderstatus = 'O') AS b FROM orders {group}"
    for key, flag, group in (("o_orderpriority", 0, "GROUP BY 1"), ("NULL", 1, ""))
)
_SUMMARY_SOURCE = "SELECT " + ", ".join(
    f"CASE WHEN {c}_o > 0 THEN {c}_o END AS {c}_outliers" for c in "abc"
) + " FROM (SELECT " + ", ".join(f"{_excess(c, 0.25, _LINES)} AS {c}_o" for c in "abc") + f" FROM ({_LINES}))"

ORACLE = {
    "table_info_masked": " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS \"column\", '{t}' AS type, count({c}) AS non_null FROM ({_ORDERS})"
        for i, (c, t) in enumerate([
            ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderdate", "timestamp_ntz"), ("price", "double"),
            ("status", "string"), ("priority", "string"), ("grade", "double"),
        ])
    ),
    "describe_numeric": _describe_sql("SELECT * FROM lineitem", NUMBERS),
    "describe_masked": _describe_sql(_ORDERS, ["price", "grade"]),
    "describe_by_group": _describe_sql("SELECT * FROM events", ["value"], by="event_type"),
    "describe_approximate_quartiles": "SELECT * FROM (VALUES " + ", ".join(f"('{c}', {q}, true)" for c in NUMBERS for q in (25, 50, 75)) + ") v(\"column\", quartile, near)",
    "describe_approximate": f"SELECT *, true AS q25_near, true AS q50_near, true AS q75_near FROM ({_describe_sql('SELECT * FROM lineitem', NUMBERS, quartiles=False)})",
    "quantiles_sketched": f"SELECT event_type, count(*) AS n, CAST(i AS INT) AS i, true AS near FROM events, range({len(TENTHS)}) r(i) GROUP BY event_type, i",
    "value_counts_one": f"SELECT status AS value, count(*) AS count FROM ({_ORDERS}) WHERE status IS NOT NULL GROUP BY 1",
    "value_counts_top": f"""
SELECT "column", value, count FROM (SELECT *, row_number() OVER (PARTITION BY "column" ORDER BY count DESC, value) AS place FROM ({" UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS count FROM ({plain(ORDERS_MASKED)}) WHERE {c} IS NOT NULL GROUP BY 2" for c in ("o_custkey", "status", "priority"))})) WHERE place <= 3""",
    "value_counts_all": " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS count FROM ({_ORDERS}) WHERE {c} IS NOT NULL GROUP BY 1, 2"
        for c in ("o_custkey", "status", "priority")
    ),
    "column_mean": f"SELECT {sql_rd('avg(o_totalprice)', 4)} AS mean_price FROM orders",
    "filtered_means": "SELECT " + ", ".join(
        sql_rd(f"avg(o_totalprice) FILTER (o_orderstatus = '{s}')", 4) + f" AS mean_{s.lower()}" for s in "FOP"
    ) + " FROM orders",
    "group_means_one_key": f"SELECT status, {sql_rd('avg(price)', 4)} AS price FROM ({_ORDERS}) WHERE status IS NOT NULL GROUP BY 1",
    "group_two_keys": f"SELECT l_returnflag, l_linestatus, {sql_rd('avg(l_extendedprice)', 4)} AS l_extendedprice FROM lineitem GROUP BY 1, 2",
    "group_sizes_two_keys": f"SELECT lang, quality, count(*) AS size FROM ({_DOCS}) WHERE quality IS NOT NULL GROUP BY 1, 2",
    "group_means_all_numeric": "SELECT l_returnflag, " + ", ".join(f"{sql_rd(f'avg({c})', 4)} AS {c}" for c in NUMBERS) + " FROM lineitem GROUP BY 1",
    "crosstab_long": f"SELECT status, priority, count(*) AS n FROM ({_ORDERS}) WHERE status IS NOT NULL AND priority IS NOT NULL GROUP BY 1, 2",
    "crosstab_wide": f"SELECT lang, count(*) FILTER (quality = 0) AS q0, count(*) FILTER (quality = 1) AS q1 FROM ({_DOCS}) WHERE quality IS NOT NULL GROUP BY 1",
    "quantiles_exact": _quantiles_sql("lineitem", ["l_quantity", "l_extendedprice"]),
    "quantiles_by_cells": _quantiles_sql("lineitem", ["l_quantity", "l_extendedprice"]),
    "quantiles_by_group": _quantiles_sql("events", ["value"], "event_type"),
    "quantiles_by_group_cells": _quantiles_sql("events", ["value"], "event_type"),
    "simpson_reversal": f"""
WITH m AS ({_SIMPSON})
SELECT o_orderpriority, is_overall, {sql_rd('a', 4)} AS mean_a, {sql_rd('b', 4)} AS mean_b, {sql_rd('b - a', 4)} AS diff,
       sign(b - a) * (SELECT b - a FROM m WHERE is_overall = 1) < 0 AS reversed FROM m""",
    "upper_outliers_columns": f"SELECT event_id, value, {sql_rd(_excess('value', 1.5, 'SELECT * FROM events'), 6)} AS value_outliers FROM events",
    "outliers_masked": "SELECT l_orderkey, l_linenumber, " + ", ".join(
        f"{sql_rd(_excess(c, 0.5, _LINES), 6)} AS {c}_outliers" for c in "ac"
    ) + f" FROM ({_LINES})",
    "outlier_summary_columns": f"WITH s AS ({_SUMMARY_SOURCE}) " + _describe_sql(
        "SELECT * FROM s", [f"{c}_outliers" for c in "abc"], digits=6
    ).replace("CAST(min(", "round(CAST(min(").replace("AS DOUBLE) AS min", "AS DOUBLE), 6) AS min")
    .replace("CAST(max(", "round(CAST(max(").replace("AS DOUBLE) AS max", "AS DOUBLE), 6) AS max"),
    "qcut_bins": f"""
WITH b AS (SELECT o_orderkey, {_BIN.format('price')} AS bin, e0, e1, e2, e3, e4 FROM ({_ORDERS}), ({_EDGES.format('price', _ORDERS)}))
SELECT o_orderkey, CAST(bin AS DOUBLE) AS bin, {sql_rd('CASE bin WHEN 0 THEN e0 WHEN 1 THEN e1 WHEN 2 THEN e2 WHEN 3 THEN e3 END', 4)} AS lo,
       {sql_rd('CASE bin WHEN 0 THEN e1 WHEN 1 THEN e2 WHEN 2 THEN e3 WHEN 3 THEN e4 END', 4)} AS hi FROM b""",
    "qcut_means": f"""
SELECT bin, {sql_rd('avg(grade)', 8)} AS grade FROM (
  SELECT grade, {_BIN.format('price')} AS bin FROM ({_ORDERS}), ({_EDGES.format('price', _ORDERS)})) WHERE bin IS NOT NULL GROUP BY 1""",
    "qcut_one_bin": f"""
SELECT o_orderkey, o_totalprice FROM orders, ({_EDGES.format('o_totalprice', 'SELECT * FROM orders')})
WHERE {_BIN.format('o_totalprice')} = 2""",
}
