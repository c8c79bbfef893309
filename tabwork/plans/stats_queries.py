"""Queries: hypothesis tests.

The SQL checks take p-values by other means than the library: closed forms for even
degrees of freedom, Simpson integration of the density otherwise.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwork.operators.bins import qcut
from tabwork.operators.stats import anova, chi2, expected_counts, pearson, ttest_ind, ttest_vs_overall
from tabwork.plans.base import DOCS_LABELLED, ORDERS_MASKED, derive, plain, rd, sql_rd, table
from tabwork.plans.profile_queries import _BIN, _EDGES

SIGNIFICANT = """
SELECT event_id, user_id, CASE WHEN event_type = 'click' THEN value * 1.3e0 ELSE value END AS value, event_type,
       CASE WHEN event_type IN ('click', 'view') THEN 'web' ELSE 'other' END AS channel,
       CASE WHEN value > 35 + 5 * (event_id % 3) OR event_type = 'view' THEN 'big' ELSE 'small' END AS size FROM {events}"""

ALIKE = "SELECT CAST(o_orderkey * 7919 % 1009 AS DOUBLE) AS noise, CAST(o_orderkey % 3 AS INT) AS third FROM {orders}"
EXACT = """
SELECT o_totalprice AS price, o_totalprice * 3 + 1 AS tripled, CASE WHEN o_orderkey % 2 = 0 THEN 'a' ELSE 'b' END AS side,
       CASE WHEN o_orderkey % 2 = 0 THEN 0.1e0 ELSE 0.7e0 END AS level, 0.1e0 AS flat FROM {orders}"""


def _round(df, **digits):
    return df.withColumns({c: rd(c, d) for c, d in digits.items()})


def ttest_two_sample(spark, sf):
    df = ttest_ind(derive(spark, sf, ORDERS_MASKED), "price", "status", "F", "O")
    return _round(df, mean_a=4, mean_b=4, t=7, p=7)


def ttest_significant(spark, sf):
    df = ttest_ind(derive(spark, sf, SIGNIFICANT), "value", "event_type", "click", "signup")
    return _round(df, mean_a=6, mean_b=6, t=7, p=7)


def anova_oneway(spark, sf):
    return _round(anova(table(spark, sf, "orders"), "o_totalprice", "o_orderpriority"), f=7, p=7)


def anova_three_groups(spark, sf):
    df = anova(derive(spark, sf, SIGNIFICANT), "value", "event_type", groups=["click", "view", "signup"])
    return _round(df, f=7, p=7)


def anova_alike_groups(spark, sf):
    """Three groups that are alike: F below 1."""
    return _round(anova(derive(spark, sf, ALIKE), "noise", "third"), f=7, p=7)


def tests_without_variance(spark, sf):
    """Exact fits and constant samples: p is 0 where the groups differ, 1 where they do not."""
    df = derive(spark, sf, EXACT)
    line = pearson(df, "price", "tripled").select(F.lit("line").alias("test"), "p", "reject")
    apart = ttest_ind(df, "level", "side", "a", "b").select(F.lit("apart").alias("test"), "p", "reject")
    same = ttest_ind(df, "flat", "side", "a", "b").select(F.lit("same").alias("test"), "p", "reject")
    groups = anova(df, "level", "side").select(F.lit("groups").alias("test"), "p", "reject")
    equal = anova(df, "flat", "side").select(F.lit("equal").alias("test"), "p", "reject")
    return line.unionByName(apart).unionByName(same).unionByName(groups).unionByName(equal)


def anova_many_groups(spark, sf):
    return _round(anova(table(spark, sf, "lineitem"), "l_quantity", "l_partkey"), f=7, p=7)


def anova_over_quartiles(spark, sf):
    df = qcut(derive(spark, sf, ORDERS_MASKED), "price", 4, "cell").withColumn("bin", F.col("cell.bin"))
    return _round(anova(df, "grade", "bin"), f=7, p=7)


def chi2_independence(spark, sf):
    return _round(chi2(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority"), chi2=7, p=7)


def chi2_two_by_two(spark, sf):
    return _round(chi2(derive(spark, sf, SIGNIFICANT), "channel", "size"), chi2=6, p=7)


def chi2_quality_by_toxic(spark, sf):
    return _round(chi2(derive(spark, sf, DOCS_LABELLED), "quality", "toxic"), chi2=7, p=7)


def chi2_many_levels(spark, sf):
    return _round(chi2(table(spark, sf, "orders"), "o_custkey", "o_orderpriority"), chi2=5, p=7)


def chi2_expected(spark, sf):
    return _round(expected_counts(table(spark, sf, "orders"), "o_orderstatus", "o_orderpriority"), expected=6)


def pearson_whole(spark, sf):
    return _round(pearson(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice"), r=9, t=6, p=7)


def pearson_by_group(spark, sf):
    return _round(pearson(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", by="l_returnflag"), r=9, t=6, p=7)


def ttest_by_group_vs_overall(spark, sf):
    df = ttest_vs_overall(table(spark, sf, "orders"), "o_totalprice", "o_custkey")
    return _round(df, mean=6, overall=5, t=6, p=6)


QUERIES = {
    f.__name__: f for f in (
        ttest_two_sample, ttest_significant, anova_oneway, anova_three_groups, anova_alike_groups, tests_without_variance, anova_many_groups, anova_over_quartiles, chi2_independence,
        chi2_two_by_two, chi2_quality_by_toxic, chi2_many_levels, chi2_expected, pearson_whole, pearson_by_group, ttest_by_group_vs_overall,
    )
} | {"anova_over_quartiles_p": anova_over_quartiles}  # the name it had while anova_over_quartiles left out p

_ORDERS, _EVENTS, _DOCS = plain(ORDERS_MASKED), plain(SIGNIFICANT), plain(DOCS_LABELLED)


def _simpson(density, upper, steps=800):
    weight = f"CASE WHEN i = 0 OR i = {steps} THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END"
    body = density.format(u=f"(i * {upper} / {steps}e0)")
    return f"({upper} / {3 * steps}e0 * list_sum([{weight} * {body} for i in range(0, {steps + 1})]))"


def _t_p(t, dof):
    scale = f"exp(lgamma(({dof} + 1) / 2e0) - lgamma({dof} / 2e0)) / sqrt({dof} * pi())"
    density = f"pow(1 + {{u}} * {{u}} / {dof}, -({dof} + 1) / 2e0)"
    return f"(1 - 2 * {scale} * {_simpson(density, f'abs({t})')})"


def _normal_p(z):
    return f"(1 - 2 / sqrt(2 * pi()) * {_simpson('exp(-{u} * {u} / 2)', z)})"


def _ttest(source, x, by, a, b, mean_digits):
    return f"""
WITH s AS (SELECT count({x}) FILTER ({by} = '{a}') AS n_a, count({x}) FILTER ({by} = '{b}') AS n_b,
    avg({x}) FILTER ({by} = '{a}') AS ma, avg({x}) FILTER ({by} = '{b}') AS mb,
    var_samp({x}) FILTER ({by} = '{a}') AS va, var_samp({x}) FILTER ({by} = '{b}') AS vb FROM ({source})),
t AS (SELECT *, n_a + n_b - 2 AS dof, (ma - mb) / sqrt(((n_a - 1) * va + (n_b - 1) * vb) / (n_a + n_b - 2) * (1e0 / n_a + 1e0 / n_b)) AS t FROM s),
p AS (SELECT *, {_t_p('t', 'dof')} AS p FROM t)
SELECT n_a, n_b, {sql_rd('ma', mean_digits)} AS mean_a, {sql_rd('mb', mean_digits)} AS mean_b, {sql_rd('t', 7)} AS t, dof,
       {sql_rd('p', 7)} AS p, p < 0.05 AS reject FROM p"""


def _f(source, x, by):
    return f"""
WITH d AS (SELECT {x} AS x, {by} AS g FROM ({source}) WHERE {x} IS NOT NULL AND {by} IS NOT NULL),
g AS (SELECT g, count(*) AS n, avg(x) AS m, var_pop(x) AS v FROM d GROUP BY 1),
s AS (SELECT count(*) - 1 AS d1, CAST(sum(n) AS BIGINT) - count(*) AS d2,
             sum(n * pow(m - (SELECT avg(x) FROM d), 2)) AS ssb, sum(n * v) AS ssw FROM g),
f AS (SELECT *, (ssb / d1) / (ssw / d2) AS f FROM s)"""


def _anova(source, x, by, p):
    return f"""{_f(source, x, by)},
p AS (SELECT *, {p} AS p FROM (SELECT *, d2 / (d2 + d1 * f) AS z, d2 / 2e0 AS b FROM f))
SELECT d1 AS dof_between, d2 AS dof_within, {sql_rd('f', 7)} AS f, {sql_rd('p', 7)} AS p, p < 0.05 AS reject FROM p"""


def _f_p(f):
    """Simpson integration of the density, over the root of F as that is smooth at 0."""
    scale = "lgamma((d1 + d2) / 2e0) - lgamma(d1 / 2e0) - lgamma(d2 / 2e0) + d1 / 2e0 * ln(d1 / CAST(d2 AS DOUBLE))"
    u = "greatest({u} * {u}, 1e-9)"
    return f"(1 - {_simpson(f'2 * {{u}} * exp({scale} + (d1 / 2e0 - 1) * ln({u}) - (d1 + d2) / 2e0 * ln(1 + d1 * {u} / d2))', f'sqrt({f})', 4000)})"


def _cells(source, a, b):
    return f"""
WITH d AS (SELECT {a} AS a, {b} AS b FROM ({source}) WHERE {a} IS NOT NULL AND {b} IS NOT NULL),
r AS (SELECT a, count(*) AS ra FROM d GROUP BY 1), c AS (SELECT b, count(*) AS cb FROM d GROUP BY 1),
o AS (SELECT a, b, count(*) AS n FROM d GROUP BY 1, 2),
cells AS (SELECT r.a, c.b, coalesce(n, 0) AS observed, ra * CAST(cb AS DOUBLE) / (SELECT count(*) FROM d) AS expected
          FROM r CROSS JOIN c LEFT JOIN o ON o.a = r.a AND o.b = c.b)"""


def _chi2(source, a, b, dof, statistic, p, digits):
    return f"""{_cells(source, a, b)},
x AS (SELECT sum({statistic}) AS chi2 FROM cells), p AS (SELECT chi2, {p} AS p FROM x)
SELECT {sql_rd('chi2', digits)} AS chi2, CAST({dof} AS BIGINT) AS dof, {sql_rd('p', 7)} AS p, p < 0.05 AS reject FROM p"""


def _pearson(by):
    lead, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return f"""
WITH c AS (SELECT {lead}count(*) AS n, corr(l_quantity, l_extendedprice) AS r FROM lineitem {group}),
t AS (SELECT *, n - 2 AS dof, r * sqrt((n - 2) / (1 - r * r)) AS t FROM c), p AS (SELECT *, {_t_p('t', 'dof')} AS p FROM t)
SELECT {lead}n, {sql_rd('r', 9)} AS r, {sql_rd('t', 6)} AS t, {sql_rd('p', 7)} AS p, p < 0.05 AS reject FROM p"""


_PLAIN = "pow(observed - expected, 2) / expected"
_YATES = "pow(greatest(abs(observed - expected) - 0.5e0, 0), 2) / expected"
_CHI8 = "exp(-chi2 / 2) * (1 + chi2 / 2 + pow(chi2 / 2, 2) / 2 + pow(chi2 / 2, 3) / 6)"
_WEB = f"SELECT * FROM ({_EVENTS}) WHERE event_type IN ('click', 'view', 'signup')"
_BINNED = f"SELECT grade, {_BIN.format('price')} AS bin FROM ({_ORDERS}), ({_EDGES.format('price', _ORDERS)})"
ORACLE = {
    "ttest_two_sample": _ttest(_ORDERS, "price", "status", "F", "O", 4),
    "ttest_significant": _ttest(_EVENTS, "value", "event_type", "click", "signup", 6),
    "anova_oneway": _anova("SELECT * FROM orders", "o_totalprice", "o_orderpriority", "pow(z, b) * (1 + b * (1 - z))"),
    "anova_three_groups": _anova(_WEB, "value", "event_type", "pow(z, b)"),
    "anova_alike_groups": _anova(plain(ALIKE), "noise", "third", "pow(z, b)"),
    "tests_without_variance": """
SELECT 'line' AS test, CASE WHEN corr(price, tripled) > 1 - 1e-12 THEN 0e0 END AS p, true AS reject FROM (""" + plain(EXACT) + """)
UNION ALL SELECT test, CASE WHEN apart THEN 0e0 ELSE 1e0 END, apart FROM (
  SELECT max(level) FILTER (side = 'a') <> min(level) FILTER (side = 'b') AS moved, max(flat) <> min(flat) AS differ FROM (""" + plain(EXACT) + """)) s,
  LATERAL (VALUES ('apart', s.moved), ('groups', s.moved), ('same', s.differ), ('equal', s.differ)) v(test, apart)""",
    "anova_many_groups": _anova("SELECT * FROM lineitem", "l_quantity", "l_partkey", _f_p("f")),
    "anova_over_quartiles": _anova(_BINNED, "grade", "bin", _f_p("f")),
    "anova_over_quartiles_p": _anova(_BINNED, "grade", "bin", _f_p("f")),
    "chi2_independence": _chi2("SELECT * FROM orders", "o_orderstatus", "o_orderpriority", 8, _PLAIN, _CHI8, 7),
    "chi2_two_by_two": _chi2(_EVENTS, "channel", "size", 1, _YATES, _normal_p("sqrt(chi2)"), 6),
    "chi2_quality_by_toxic": _chi2(_DOCS, "quality", "toxic", 1, _YATES, _normal_p("sqrt(chi2)"), 7),
    "chi2_many_levels": f"""{_cells("SELECT * FROM orders", "o_custkey", "o_orderpriority")},
x AS (SELECT sum({_PLAIN}) AS chi2, (count(DISTINCT a) - 1) * (count(DISTINCT b) - 1) AS dof FROM cells),
p AS (SELECT *, list_sum([exp(i * ln(chi2 / 2) - lgamma(i + 1) - chi2 / 2) FOR i IN range(0, dof // 2)]) AS p FROM x)
SELECT {sql_rd('chi2', 5)} AS chi2, dof, {sql_rd('p', 7)} AS p, p < 0.05 AS reject FROM p""",
    "chi2_expected": _cells("SELECT * FROM orders", "o_orderstatus", "o_orderpriority")
    + f" SELECT a AS o_orderstatus, b AS o_orderpriority, observed, {sql_rd('expected', 6)} AS expected FROM cells",
    "pearson_whole": _pearson(""),
    "pearson_by_group": _pearson("l_returnflag"),
    "ttest_by_group_vs_overall": f"""
WITH o AS (SELECT avg(o_totalprice) AS overall FROM orders),
g AS (SELECT o_custkey, count(*) AS n, avg(o_totalprice) AS mean, stddev_samp(o_totalprice) AS sd FROM orders GROUP BY 1),
t AS (SELECT g.*, overall, n - 1 AS dof, CASE WHEN n > 1 THEN (mean - overall) / (sd / sqrt(n)) END AS t FROM g, o),
p AS (SELECT *, CASE WHEN n > 1 THEN {_t_p('t', 'dof')} END AS p FROM t)
SELECT o_custkey, n, {sql_rd('mean', 6)} AS mean, {sql_rd('overall', 5)} AS overall, {sql_rd('t', 6)} AS t, dof, {sql_rd('p', 6)} AS p,
       p < 0.05 AS reject, CASE WHEN mean > overall THEN 'higher' WHEN mean < overall THEN 'lower' ELSE 'equal' END AS direction FROM p""",
}
