"""Queries: tables that charts are drawn from."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwork.operators.plotdata import (
    box_stats, histogram, overlay_histograms, regression_band, regression_line, scatter_density, scatter_sample, violin,
)
from tabwork.operators.profile import value_counts
from tabwork.plans.base import LINEITEM_MASKED, derive, plain, rd, sql_rd, table


def _round(df, digits, *cols):
    return df.withColumns({c: rd(c, digits) for c in cols})


def hist_numeric(spark, sf):
    return _round(histogram(table(spark, sf, "lineitem"), "l_extendedprice", 100), 4, "lo", "hi")


def hist_default_bins(spark, sf):
    return _round(histogram(derive(spark, sf, LINEITEM_MASKED), "c"), 6, "lo", "hi")


def hist_on_edges(spark, sf):
    """Hundredths in bins of a hundredth: every value is an edge, up to rounding."""
    return _round(histogram(table(spark, sf, "lineitem"), "l_discount", 10), 6, "lo", "hi")


def hist_on_edges_by_group(spark, sf):
    return _round(histogram(table(spark, sf, "lineitem"), "l_quantity", 70, by="l_returnflag"), 6, "lo", "hi")


def hist_by_group(spark, sf):
    return _round(histogram(table(spark, sf, "events"), "value", 20, by="event_type"), 4, "lo", "hi")


def hist_shared_edges(spark, sf):
    return _round(histogram(table(spark, sf, "events"), "value", 20, by="event_type", shared_edges=True), 4, "lo", "hi")


def hist_overlay(spark, sf):
    return _round(overlay_histograms(derive(spark, sf, LINEITEM_MASKED), ["a", "b"], 20), 6, "lo", "hi")


def hist_categorical(spark, sf):
    return value_counts(table(spark, sf, "orders"), ["o_orderpriority"])


BOX = ("q1", "median", "q3")


def box_whole(spark, sf):
    return _round(box_stats(table(spark, sf, "events"), "value"), 6, *BOX)


def box_by_group(spark, sf):
    return _round(box_stats(table(spark, sf, "events"), "value", by="event_type"), 6, *BOX)


def violin_density(spark, sf):
    df = violin(table(spark, sf, "orders"), "o_totalprice", ["o_orderstatus"])
    return df.select("o_orderstatus", "point", rd("x", 3).alias("x"), rd(F.col("density") * 1e6, 7).alias("density_e6"))


def violin_two_keys(spark, sf):
    customers = table(spark, sf, "customer").withColumn("even", F.col("c_nationkey") % 2)
    df = violin(customers, "c_acctbal", ["c_mktsegment", "even"], grid=40)
    return df.select("c_mktsegment", "even", "point", rd("x", 4).alias("x"), rd(F.col("density") * 1e4, 7).alias("density_e4"))


def violin_from_bins(spark, sf):
    df = violin(table(spark, sf, "lineitem"), "l_extendedprice", ["l_returnflag"], bins=500)
    return df.select("l_returnflag", "point", rd("x", 3).alias("x"), rd(F.col("density") * 1e6, 6).alias("density_e6"))


LINE = ("slope", "intercept", "x_mean")


def line_of_fit(spark, sf):
    df = regression_line(table(spark, sf, "part"), "p_size", "p_retailprice")
    return df.withColumns({**{c: rd(c, 6) for c in LINE}, "r2": rd("r2", 9), "sxx": rd("sxx", 3), "sigma": rd("sigma", 6)})


def line_by_group(spark, sf):
    df = regression_line(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", by="l_returnflag")
    return df.withColumns({**{c: rd(c, 5) for c in LINE}, "r2": rd("r2", 10), "sxx": rd("sxx", 3), "sigma": rd("sigma", 5)})


def line_band(spark, sf):
    df = regression_band(table(spark, sf, "part"), "p_size", "p_retailprice", grid=20)
    return _round(df, 6, "x", "fit", "lo", "hi")


def line_band_by_group(spark, sf):
    df = regression_band(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", by="l_returnflag", grid=10, level=0.99)
    return _round(df, 5, "x", "fit", "lo", "hi")


def scatter_whole(spark, sf):
    return scatter_sample(table(spark, sf, "orders"), "o_orderkey", ["o_totalprice", "o_custkey"], 200)


def scatter_by_group(spark, sf):
    return scatter_sample(table(spark, sf, "orders"), "o_orderkey", ["o_totalprice"], 50, by="o_orderstatus")


def scatter_counts(spark, sf):
    return scatter_density(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", 20)


QUERIES = {
    f.__name__: f for f in (
        hist_numeric, hist_default_bins, hist_on_edges, hist_on_edges_by_group, hist_by_group, hist_shared_edges, hist_overlay, hist_categorical, box_whole,
        box_by_group, violin_density, violin_two_keys, violin_from_bins, line_of_fit, line_by_group, line_band, line_band_by_group, scatter_whole,
        scatter_by_group, scatter_counts,
    )
}

_LINES = plain(LINEITEM_MASKED)


def _hist_sql(source, x, bins, digits, by="", shared=False):
    keep = f"SELECT {x} AS x{f', {by} AS g' if by else ''} FROM ({source}) WHERE {x} IS NOT NULL"
    own = "GROUP BY g" if by and not shared else ""
    limits = "SELECT min(x) AS lo_all, max(x) AS hi_all" + (", g" if own else "") + f" FROM d {own}"
    if by and shared:
        limits = f"SELECT g, lo_all, hi_all FROM (SELECT DISTINCT g FROM d), ({limits})"
    lead = f"l.g AS {by}, " if by else ""
    width = f"(hi_all - lo_all) / {bins}e0"
    return f"""
WITH d AS ({keep}), l AS ({limits}),
b AS (SELECT l.*, CAST(i AS INTEGER) AS bin, lo_all + i * {width} AS lo, CASE WHEN i = {bins - 1} THEN hi_all ELSE lo_all + (i + 1) * {width} END AS hi FROM l, range({bins}) r(i)),
c AS (SELECT {'b.g, ' if by else ''}bin, count(*) AS n FROM b JOIN d ON x >= lo AND (x < hi OR bin = {bins - 1} AND x <= hi) {'AND d.g = b.g' if by else ''} GROUP BY ALL)
SELECT {lead}l.bin, {sql_rd('lo', digits)} AS lo, {sql_rd('hi', digits)} AS hi, coalesce(n, 0) AS n FROM b l LEFT JOIN c ON c.bin = l.bin {'AND c.g = l.g' if by else ''}"""


def _box_sql(by):
    lead, group, match = (f"{by}, ", f"GROUP BY {by}", f"USING ({by})") if by else ("", "", "ON TRUE")
    return f"""
WITH q AS (SELECT {lead}quantile_cont(value, 0.25) AS q1, median(value) AS med, quantile_cont(value, 0.75) AS q3 FROM events {group}),
f AS (SELECT *, value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside FROM events JOIN q {match})
SELECT {lead}count(*) AS n, {sql_rd('any_value(q1)', 6)} AS q1, {sql_rd('any_value(med)', 6)} AS median, {sql_rd('any_value(q3)', 6)} AS q3,
       min(value) FILTER (inside) AS whisker_lo, max(value) FILTER (inside) AS whisker_hi, count(*) FILTER (NOT inside) AS n_outliers
FROM f {group}"""


def _violin_sql(source, x, by, grid, x_digits, scale, name, digits, bins=None):
    keys, same = ", ".join(by), " AND ".join(f"d.{b} = s.{b}" for b in by)
    weighted = f"SELECT {keys}, x, 1 AS w FROM d"
    if bins:
        weighted = f"""SELECT {', '.join('d.' + b for b in by)}, a + (least(floor((x - a) / ((z - a) / {bins}e0)), {bins - 1}) + 0.5e0) * ((z - a) / {bins}e0) AS x,
                       count(*) AS w FROM d JOIN s ON {same} GROUP BY ALL"""
    return f"""
WITH d AS (SELECT {x} AS x, {keys} FROM ({source})),
s AS (SELECT {keys}, count(*) AS n, min(x) AS a, max(x) AS z, pow(count(*), -0.2e0) * stddev_samp(x) AS h FROM d GROUP BY {keys}),
g AS (SELECT s.*, CAST(i AS INTEGER) AS point, a - 2 * h + i * (z - a + 4 * h) / {grid - 1}e0 AS spot FROM s, range({grid}) r(i)),
w AS ({weighted})
SELECT {', '.join('g.' + b for b in by)}, point, {sql_rd('any_value(spot)', x_digits)} AS x,
       {sql_rd(f'sum(w * exp(-0.5e0 * pow((spot - x) / h, 2))) / any_value(n * h) / sqrt(2 * pi()) * {scale}', digits)} AS {name}
FROM g JOIN w ON {' AND '.join(f'g.{b} = w.{b}' for b in by)} GROUP BY {', '.join('g.' + b for b in by)}, point"""


def _line_sql(source, x, y, by, digits, r2_digits):
    lead, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return f"""
WITH f AS (SELECT {lead}count(*) AS n, regr_slope({y}, {x}) AS slope, regr_intercept({y}, {x}) AS intercept, regr_r2({y}, {x}) AS r2,
   avg({x}) AS x_mean, regr_sxx({y}, {x}) AS sxx, regr_syy({y}, {x}) AS syy FROM {source} {group})
SELECT {lead}n, {', '.join(f'{sql_rd(c, digits)} AS {c}' for c in LINE)}, {sql_rd('r2', r2_digits)} AS r2, {sql_rd('sxx', 3)} AS sxx,
       {sql_rd('sqrt(syy * (1 - r2) / (n - 2))', digits)} AS sigma FROM f"""


#: The t quantile by its expansion in 1 / dof (Fisher and Cornish), beside the normal one.
_Z = {0.95: 1.959963984540054, 0.99: 2.5758293035489004}


def _t_quantile_sql(level, dof):
    z = _Z[level]
    terms = [z, (z**3 + z) / 4, (5 * z**5 + 16 * z**3 + 3 * z) / 96, (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / 384,
             (79 * z**9 + 776 * z**7 + 1482 * z**5 - 1920 * z**3 - 945 * z) / 92160]
    return "(" + " + ".join(f"{t!r}e0 / pow({dof}, {i})" for i, t in enumerate(terms)) + ")"


def _band_sql(source, x, y, by, grid, level, digits):
    lead, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return f"""
WITH f AS (SELECT {lead}count(*) AS n, regr_slope({y}, {x}) AS slope, regr_intercept({y}, {x}) AS intercept, regr_r2({y}, {x}) AS r2,
   avg({x}) AS mean, regr_sxx({y}, {x}) AS sxx, regr_syy({y}, {x}) AS syy, min({x}) AS a, max({x}) AS z FROM {source} {group}),
p AS (SELECT *, CAST(i AS INTEGER) AS point, a + i * (z - a) / {grid - 1}e0 AS x FROM f, range({grid}) r(i)),
w AS (SELECT *, intercept + slope * x AS fit, {_t_quantile_sql(level, '(n - 2)')} * sqrt(syy * (1 - r2) / (n - 2)) * sqrt(1e0 / n + pow(x - mean, 2) / sxx) AS half FROM p)
SELECT {lead}point, {sql_rd('x', digits)} AS x, {sql_rd('fit', digits)} AS fit, {sql_rd('fit - half', digits)} AS lo, {sql_rd('fit + half', digits)} AS hi FROM w"""


_HASH = "md5(CAST(o_orderkey AS VARCHAR) || '|123')"
_CELL = "CAST(least(floor(({0} - (SELECT min({0}) FROM lineitem)) / (((SELECT max({0}) FROM lineitem) - (SELECT min({0}) FROM lineitem)) / 20e0)), 19) AS INTEGER)"
ORACLE = {
    "hist_numeric": _hist_sql("SELECT * FROM lineitem", "l_extendedprice", 100, 4),
    "hist_default_bins": _hist_sql(_LINES, "c", 10, 6),
    "hist_on_edges": _hist_sql("SELECT * FROM lineitem", "l_discount", 10, 6),
    "hist_on_edges_by_group": _hist_sql("SELECT * FROM lineitem", "l_quantity", 70, 6, by="l_returnflag"),
    "hist_by_group": _hist_sql("SELECT * FROM events", "value", 20, 4, by="event_type"),
    "hist_shared_edges": _hist_sql("SELECT * FROM events", "value", 20, 4, by="event_type", shared=True),
    "hist_overlay": _hist_sql(
        f"SELECT 'a' AS series, a AS v FROM ({_LINES}) UNION ALL SELECT 'b', b FROM ({_LINES})", "v", 20, 6, by="series"
    ),
    "hist_categorical": "SELECT 'o_orderpriority' AS \"column\", o_orderpriority AS value, count(*) AS count FROM orders GROUP BY 2",
    "box_whole": _box_sql(""),
    "box_by_group": _box_sql("event_type"),
    "violin_density": _violin_sql("SELECT * FROM orders", "o_totalprice", ["o_orderstatus"], 100, 3, "1e6", "density_e6", 7),
    "violin_two_keys": _violin_sql("SELECT *, c_nationkey % 2 AS even FROM customer", "c_acctbal", ["c_mktsegment", "even"], 40, 4, "1e4", "density_e4", 7),
    "violin_from_bins": _violin_sql("SELECT * FROM lineitem", "l_extendedprice", ["l_returnflag"], 100, 3, "1e6", "density_e6", 6, bins=500),
    "line_of_fit": _line_sql("part", "p_size", "p_retailprice", "", 6, 9),
    "line_by_group": _line_sql("lineitem", "l_quantity", "l_extendedprice", "l_returnflag", 5, 10),
    "line_band": _band_sql("part", "p_size", "p_retailprice", "", 20, 0.95, 6),
    "line_band_by_group": _band_sql("lineitem", "l_quantity", "l_extendedprice", "l_returnflag", 10, 0.99, 5),
    "scatter_whole": f"SELECT o_orderkey, o_totalprice, o_custkey FROM orders ORDER BY {_HASH}, o_orderkey LIMIT 200",
    "scatter_by_group": f"""
SELECT o_orderkey, o_orderstatus, o_totalprice FROM (
  SELECT *, row_number() OVER (PARTITION BY o_orderstatus ORDER BY {_HASH}, o_orderkey) AS r FROM orders) WHERE r <= 50""",
    "scatter_counts": f"SELECT {_CELL.format('l_quantity')} AS x_bin, {_CELL.format('l_extendedprice')} AS y_bin, count(*) AS n FROM lineitem GROUP BY 1, 2",
}
