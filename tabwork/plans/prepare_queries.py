"""Queries: splits and scalers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwork.functions.normal import (
    PPF_CENTRAL_DEN, PPF_CENTRAL_NUM, PPF_MIDDLE_DEN, PPF_MIDDLE_NUM, PPF_TAIL_DEN, PPF_TAIL_NUM,
)
from tabwork.operators.scale import KINDS, NORMAL_CLIP, Scaler, scale_splits, unscale_splits, yeo_johnson
from tabwork.operators.split import split, split_views
from tabwork.plans.base import ORDERS_MASKED, derive, plain, rd, sql_rd, table

LAMBDA = 0.3


def split_rows(spark, sf):
    return split(table(spark, sf, "orders"), "o_orderkey").select("o_orderkey", "split")


def split_sizes(spark, sf):
    return split(table(spark, sf, "events"), "event_id", pct=0.15, seed=7).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


def split_two_keys(spark, sf):
    df = split(table(spark, sf, "conversations"), ["conv_id", "turn"], pct=0.2)
    return df.select("conv_id", "turn", "split")


def split_stratified(spark, sf):
    df = split(table(spark, sf, "customer"), "c_custkey", stratify="c_mktsegment")
    return df.select("c_custkey", "c_mktsegment", "split")


def split_stratified_masked(spark, sf):
    df = split(derive(spark, sf, ORDERS_MASKED), "o_orderkey", pct=0.12, stratify="status")
    return df.groupBy("status", "split").agg(F.count(F.lit(1)).alias("n"), F.min("o_orderkey").alias("first_key"), F.max("o_orderkey").alias("last_key"))


def split_many_strata(spark, sf):
    return split(table(spark, sf, "orders"), "o_orderkey", stratify="o_custkey").select("o_orderkey", "o_custkey", "split")


COLS = ["price", "grade"]


def _scaled(kind):
    def query(spark, sf):
        df = derive(spark, sf, ORDERS_MASKED).select("o_orderkey", *COLS)
        model = Scaler(kind=kind, cols=COLS).fit(df)
        return model.transform(df).select("o_orderkey", *[rd(c, 6).alias(c) for c in COLS])
    return query


def _roundtrip(kind):
    def query(spark, sf):
        df = derive(spark, sf, ORDERS_MASKED).select("o_orderkey", *COLS)
        model = Scaler(kind=kind, cols=COLS).fit(df)
        return model.inverse_transform(model.transform(df)).select("o_orderkey", *[rd(c, 4).alias(c) for c in COLS])
    return query


def scale_yeojohnson_fixed(spark, sf):
    """The power transform at a given power."""
    return table(spark, sf, "customer").select("c_custkey", rd(yeo_johnson(F.col("c_acctbal"), LAMBDA), 6).alias("scaled"))


def scale_yeojohnson_fit(spark, sf):
    """Fitted powers to two digits; the SQL check searches a grid of that step."""
    df = table(spark, sf, "events").select("value", F.col("event_id").cast("double").alias("place"))
    learned = Scaler(kind="yeojohnson").fit(df).learned
    return spark.createDataFrame([(c, round(v, 2)) for c, v in learned.items()], "column string, lambda double")


def scale_three_parts(spark, sf):
    parts = split(derive(spark, sf, ORDERS_MASKED).drop("o_custkey", "o_orderdate"), "o_orderkey")
    _, *scaled = scale_splits("minmax", *split_views(parts), keep=["o_orderkey"])
    named = [p.withColumn("part", F.lit(n)) for p, n in zip(scaled, ("train", "validate", "test"))]
    df = named[0].unionByName(named[1]).unionByName(named[2])
    return df.select("o_orderkey", "part", *[rd(c, 6).alias(c) for c in COLS])


def scale_inverse_three_parts(spark, sf):
    parts = split(derive(spark, sf, ORDERS_MASKED).drop("o_custkey", "o_orderdate"), "o_orderkey")
    model, *scaled = scale_splits("standard", *split_views(parts), keep=["o_orderkey"])
    back = unscale_splits(model, *scaled)
    return back[0].unionByName(back[1]).unionByName(back[2]).select("o_orderkey", *[rd(c, 4).alias(c) for c in COLS])


def scale_all_kinds(spark, sf):
    """Each kind fitted on train through the three-part form, and its training part turned back."""
    parts = split_views(split(derive(spark, sf, ORDERS_MASKED).drop("o_custkey", "o_orderdate"), "o_orderkey"))
    found = []
    for kind in KINDS:
        model, train, *_ = scale_splits(kind, *parts, keep=["o_orderkey"])
        found.append(model.inverse_transform(train).select(F.lit(kind).alias("kind"), "o_orderkey", *[rd(c, 4).alias(c) for c in COLS]))
    return reduce(DataFrame.unionByName, found)


QUERIES = {
    **{f.__name__: f for f in (split_rows, split_sizes, split_two_keys, split_stratified, split_stratified_masked, split_many_strata)},
    **{f"scale_{k}": _scaled(k) for k in ("minmax", "standard", "robust", "uniform", "quantile", "normal")},
    **{f"scale_roundtrip_{k}": _roundtrip(k) for k in ("minmax", "standard", "robust", "uniform", "quantile", "normal", "yeojohnson")},
    **{f.__name__: f for f in (scale_yeojohnson_fixed, scale_yeojohnson_fit, scale_three_parts, scale_inverse_three_parts, scale_all_kinds)},
}

_ORDERS = plain(ORDERS_MASKED)


def _split_sql(source, keys, pct="0.1e0", seed=123):
    hashed = "md5(" + " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in keys) + f" || '|{seed}')"
    return f"""
WITH r AS (SELECT *, row_number() OVER (ORDER BY {hashed}, {', '.join(keys)}) - 1 AS rk, count(*) OVER () AS n FROM ({source})),
z AS (SELECT *, ceil({pct} * n) AS nt FROM r),
parts AS (SELECT *, CASE WHEN rk < nt THEN 'test' WHEN rk < nt + ceil(2 * {pct} * (n - nt)) THEN 'validate' ELSE 'train' END AS split FROM z)"""


def _stratified_sql(source, key, strat, pct="0.1e0"):
    """Largest remainders, first for test, then for validate; strata of one row have no part in it."""
    def shares(name, counts, total):
        return f"""
{name}_q AS (SELECT s, c, c * {total} // nn AS low, c * {total} % nn AS rest, {total} AS total FROM (
    SELECT s, c, sum(c) OVER () AS nn FROM {counts}), sizes),
{name} AS (SELECT s, c, low + CASE WHEN row_number() OVER (ORDER BY rest DESC, s NULLS FIRST) <= total - sum(low) OVER () THEN 1 ELSE 0 END AS k FROM {name}_q)"""
    return f"""
WITH src AS (SELECT *, {strat} AS s FROM ({source})),
counts AS (SELECT s, count(*) AS c FROM src GROUP BY 1),
n0 AS (SELECT CAST(sum(c) AS BIGINT) AS n FROM counts),
sizes AS (SELECT n, CAST(ceil({pct} * n) AS BIGINT) AS nt, CAST(ceil(2 * {pct} * (n - CAST(ceil({pct} * n) AS BIGINT))) AS BIGINT) AS nv FROM n0),
usable AS (SELECT * FROM counts WHERE c > 1 OR (SELECT count(*) FROM counts) = 1),
{shares('t', 'usable', 'nt')},
left_over AS (SELECT s, c - k AS c FROM t),
{shares('v', 'left_over', 'nv')},
r AS (SELECT src.*, row_number() OVER (PARTITION BY s ORDER BY md5(CAST({key} AS VARCHAR) || '|123'), {key}) - 1 AS rk FROM src),
parts AS (SELECT r.*, CASE WHEN rk < t.k THEN 'test' WHEN rk < t.k + v.k THEN 'validate' ELSE 'train' END AS split
          FROM r LEFT JOIN t ON r.s IS NOT DISTINCT FROM t.s LEFT JOIN v ON r.s IS NOT DISTINCT FROM v.s)"""


_TRAIN = "SELECT * FROM m"


def _stat_sql(place, width):
    each = ", ".join(f"{place.format(c)} AS {c}_p, {width.format(c)} AS {c}_w" for c in COLS)
    values = ", ".join(f"{sql_rd(f'({c} - {c}_p) / {c}_w', 6)} AS {c}" for c in COLS)
    return f"WITH m AS ({_ORDERS}), s AS (SELECT {each} FROM ({_TRAIN})) SELECT o_orderkey, {values} FROM m, s"


def _poly(x, coefficients):
    text = repr(coefficients[0])
    for c in coefficients[1:]:
        text = f"({text} * {x} + {c!r})"
    return text


def _ppf_sql(p):
    q, r = f"({p} - 0.5e0)", f"sqrt(-ln(least({p}, 1 - {p})))"
    c, m, t = f"(0.180625e0 - {q} * {q})", f"({r} - 1.6e0)", f"({r} - 5e0)"
    return f"""CASE WHEN abs({q}) <= 0.425e0 THEN {q} * {_poly(c, PPF_CENTRAL_NUM)} / {_poly(c, PPF_CENTRAL_DEN)}
 ELSE sign({q}) * CASE WHEN {r} <= 5 THEN {_poly(m, PPF_MIDDLE_NUM)} / {_poly(m, PPF_MIDDLE_DEN)}
 ELSE {_poly(t, PPF_TAIL_NUM)} / {_poly(t, PPF_TAIL_DEN)} END END"""


def _knot_sql(count, normal=False):
    """Quantile transform by joining each distinct value to the knots around it."""
    parts, margin = [], "1e-7" if normal else "0e0"
    steps = ", ".join(repr(k / (count - 1)) for k in range(count))
    for c in COLS:
        parts.append(f"""
{c}_k AS (SELECT unnest(range({count})) AS k, unnest(quantile_cont({c}, [{steps}])) AS v FROM train),
{c}_n AS (SELECT max(k) * 1e0 AS top, min(v) AS low, max(v) AS high FROM {c}_k),
{c}_d AS (SELECT v, min(k) / any_value(top) AS a, max(k) / any_value(top) AS b FROM {c}_k, {c}_n GROUP BY v),
{c}_w AS (SELECT *, lead(v) OVER (ORDER BY v) AS v1, lead(a) OVER (ORDER BY v) AS a1 FROM {c}_d),
{c}_u AS (SELECT x, CASE WHEN {f"x - {margin} < low" if normal else "x <= low"} THEN 0e0 WHEN {f"x + {margin} > high" if normal else "x >= high"} THEN 1e0
     WHEN x = v THEN (a + b) / 2 ELSE b + (x - v) / (v1 - v) * (a1 - b) END AS u
  FROM (SELECT DISTINCT {c} AS x FROM m WHERE {c} IS NOT NULL) CROSS JOIN {c}_n ASOF LEFT JOIN {c}_w ON x >= v)""")
    value = "u"
    if normal:
        value = f"CASE WHEN u <= 0 THEN -{NORMAL_CLIP} WHEN u >= 1 THEN {NORMAL_CLIP} ELSE greatest(least({_ppf_sql('u')}, {NORMAL_CLIP}), -{NORMAL_CLIP}) END"
    pick = ", ".join(f"(SELECT {sql_rd(value, 6)} FROM {c}_u WHERE x = m.{c}) AS {c}" for c in COLS)
    return f"WITH m AS ({_ORDERS}), train AS ({_TRAIN}), {','.join(parts)} SELECT o_orderkey, {pick} FROM m"


# Values are not negative here; power 0 is the logarithm.
_YEO_SQL = "CASE WHEN j = 0 THEN ln(1 + x) ELSE (pow(x + 1, j / 100e0) - 1) / nullif(j / 100e0, 0) END"
_BACK = f"SELECT o_orderkey, {', '.join(f'{sql_rd(c, 4)} AS {c}' for c in COLS)} FROM ({_ORDERS})"
_MASKED_SPLIT = _split_sql(_ORDERS, ["o_orderkey"])
ORACLE = {
    "split_rows": _split_sql("SELECT * FROM orders", ["o_orderkey"]) + " SELECT o_orderkey, split FROM parts",
    "split_sizes": _split_sql("SELECT * FROM events", ["event_id"], "0.15e0", 7) + " SELECT split, count(*) AS n FROM parts GROUP BY 1",
    "split_two_keys": _split_sql("SELECT * FROM conversations", ["conv_id", "turn"], "0.2e0") + " SELECT conv_id, turn, split FROM parts",
    "split_stratified": _stratified_sql("SELECT * FROM customer", "c_custkey", "c_mktsegment") + " SELECT c_custkey, c_mktsegment, split FROM parts",
    "split_stratified_masked": _stratified_sql(_ORDERS, "o_orderkey", "status", "0.12e0")
    + " SELECT status, split, count(*) AS n, min(o_orderkey) AS first_key, max(o_orderkey) AS last_key FROM parts GROUP BY 1, 2",
    "scale_minmax": _stat_sql("min({0})", "max({0}) - min({0})"),
    "scale_standard": _stat_sql("avg({0})", "stddev_pop({0})"),
    "scale_robust": _stat_sql("median({0})", "quantile_cont({0}, 0.75) - quantile_cont({0}, 0.25)"),
    "scale_uniform": _knot_sql(100),
    "scale_quantile": _knot_sql(1000),
    "scale_normal": _knot_sql(1000, normal=True),
    **{f"scale_roundtrip_{k}": _BACK for k in ("minmax", "standard", "robust", "uniform", "quantile", "normal", "yeojohnson")},
    "scale_yeojohnson_fixed": f"SELECT c_custkey, {sql_rd(f'CASE WHEN c_acctbal >= 0 THEN (pow(c_acctbal + 1, {LAMBDA}e0) - 1) / {LAMBDA}e0 ELSE -(pow(1 - c_acctbal, {2 - LAMBDA}e0) - 1) / {2 - LAMBDA}e0 END', 6)} AS scaled FROM customer",
    "scale_yeojohnson_fit": " UNION ALL ".join(f"""
SELECT '{c}' AS "column", arg_max(lam, score) AS lambda FROM (
  SELECT j / 100e0 AS lam, -count(*) / 2e0 * ln(var_pop({_YEO_SQL})) + (j / 100e0 - 1) * sum(ln(1 + x)) AS score
  FROM (SELECT CAST({c} AS DOUBLE) AS x FROM events), range(-100, 201) g(j) GROUP BY j)"""
        for c in ("value", "place")
    ).replace("CAST(place", "CAST(event_id"),
    "scale_three_parts": _MASKED_SPLIT + """, lim AS (SELECT min(price) pl, max(price) ph, min(grade) gl, max(grade) gh FROM parts WHERE split = 'train')
SELECT o_orderkey, split AS part, """ + f"{sql_rd('(price - pl) / (ph - pl)', 6)} AS price, {sql_rd('(grade - gl) / (gh - gl)', 6)} AS grade FROM parts, lim",
    "scale_inverse_three_parts": _BACK,
    "scale_all_kinds": _MASKED_SPLIT + f" SELECT kind, o_orderkey, {', '.join(f'{sql_rd(c, 4)} AS {c}' for c in COLS)} FROM parts, unnest({list(KINDS)}) k(kind) WHERE split = 'train'",
    "split_many_strata": _stratified_sql("SELECT * FROM orders", "o_orderkey", "o_custkey") + " SELECT o_orderkey, o_custkey, split FROM parts",
}
