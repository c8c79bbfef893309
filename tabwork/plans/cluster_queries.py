"""Queries: k-means."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwork.operators.cluster import assign, centroid_table, compare_scaling, elbow, inertia, kmeans_fit, profile
from tabwork.operators.profile import crosstab
from tabwork.operators.scale import Scaler
from tabwork.operators.split import split
from tabwork.plans.base import derive, plain, rd, sql_rd, table
from tabwork.plans.customers import FEATURES, cluster_customers, prepare_customers

# Given centres for the queries that only place points.
CENTRES = [[500.0, 3.0], [3000.0, 18.0], [6500.0, 8.0], [9000.0, 20.0]]
COLS = ["c_acctbal", "c_nationkey"]

# Five well-parted groups: the best clustering is known, so the fit can be checked.
PLANTED = """
SELECT c_custkey, c_nationkey % 5 AS planted, CAST((c_nationkey % 5) * 40 AS DOUBLE) + c_acctbal / 5000 AS u,
       CAST((c_nationkey % 5) * (c_nationkey % 5) * 25 AS DOUBLE) - c_acctbal / 8000 AS v FROM {customer}"""
SHOPPERS = """
SELECT c_custkey AS customer_id, CASE WHEN c_custkey % 2 = 0 THEN 'Male' ELSE 'Female' END AS gender,
       18 + c_custkey % 52 AS age, CAST(floor(c_acctbal / 80 + 15) AS BIGINT) AS annual_income, c_custkey * 7 % 100 AS spending_score FROM {customer}"""

LINE = """
SELECT c_custkey, c_custkey % 11 AS g, pow(CAST(3 AS DOUBLE), CAST(c_custkey % 11 AS DOUBLE)) + CAST(c_custkey % 7 AS DOUBLE) / 100 AS u,
       CAST(c_custkey % 5 AS DOUBLE) / 100 AS v FROM {customer}"""
MASKED = "SELECT c_custkey, CASE WHEN c_custkey % 6 <> 0 THEN c_acctbal END AS c_acctbal, CASE WHEN c_custkey % 10 <> 0 THEN c_nationkey END AS c_nationkey FROM {customer}"
SEGMENTS = """
SELECT c_custkey AS customer_id, CASE WHEN c_custkey % 4 >= 2 THEN 'Male' ELSE 'Female' END AS gender, 30 + 20 * (c_custkey % 2) + c_custkey % 3 AS age,
       20 + 80 * (c_custkey % 2) + c_custkey % 5 AS annual_income, 15 + 60 * (c_custkey % 2) + c_custkey % 7 AS spending_score FROM {customer}"""


def kmeans_assign(spark, sf):
    return assign(table(spark, sf, "customer"), CENTRES, COLS).select("c_custkey", "cluster")


def kmeans_inertia(spark, sf):
    return inertia(table(spark, sf, "customer"), CENTRES, COLS).select(rd("inertia", 1).alias("inertia"))


def kmeans_profile(spark, sf):
    df = profile(assign(table(spark, sf, "customer"), CENTRES, COLS), cols=COLS)
    return df.select("cluster", *[rd(c, 6).alias(c) for c in COLS])


def kmeans_by_class(spark, sf):
    wide = crosstab(assign(table(spark, sf, "customer"), CENTRES, COLS), "c_mktsegment", "cluster", wide=True)
    return wide.withColumnsRenamed({str(i): f"cluster_{i}" for i in range(len(CENTRES))})


def kmeans_fit_planted(spark, sf):
    """Centroids of the fitted clustering, by their order along u."""
    fit = kmeans_fit(derive(spark, sf, PLANTED), ["u", "v"], 5)
    found = centroid_table(spark, sorted(fit.centroids), ["u", "v"])
    return found.select("cluster", rd("u", 6).alias("u"), rd("v", 6).alias("v"))


def kmeans_fit_labels(spark, sf):
    """Planted group against fitted cluster: one cluster each, whatever its number."""
    df = derive(spark, sf, PLANTED)
    scaled = Scaler(kind="minmax", cols=["u", "v"]).fit(df).transform(df)
    pairs = crosstab(kmeans_fit(scaled, ["u", "v"], 5).label(scaled), "planted", "cluster")
    return pairs.groupBy("planted").agg(F.count(F.lit(1)).alias("clusters"), F.sum("n").alias("n"))


def kmeans_elbow_planted(spark, sf):
    """Inertia at the two numbers of clusters whose best value is known."""
    df = elbow(derive(spark, sf, PLANTED), ["u", "v"], [1, 5])
    return df.select("k", rd("inertia", 3).alias("inertia"))


def kmeans_elbow(spark, sf):
    """The whole curve. Eleven groups at growing distances make the best clustering known for every k."""
    df = elbow(derive(spark, sf, LINE), ["u", "v"], range(1, 12))
    return df.select("k", F.format_string("%.5e", "inertia").alias("inertia"))


def _scaled_vs_raw(spark, sf):
    df = split(derive(spark, sf, PLANTED), "c_custkey")
    return compare_scaling(df, ["u", "v"], 5, train=df.where("split = 'train'"))


def kmeans_scaled_vs_raw(spark, sf):
    """Both clusterings, fitted on the training rows: cluster means of all rows."""
    means, _ = _scaled_vs_raw(spark, sf)
    return means.withColumn("mean", rd("mean", 6))


def kmeans_scaled_vs_raw_labels(spark, sf):
    """How the labels of the two agree, scaled clusters numbered as the raw ones that they match."""
    return _scaled_vs_raw(spark, sf)[1]


def kmeans_assign_masked(spark, sf):
    return assign(derive(spark, sf, MASKED), CENTRES, COLS).select("c_custkey", "cluster")


def kmeans_inertia_masked(spark, sf):
    return inertia(derive(spark, sf, MASKED), CENTRES, COLS).select(rd("inertia", 1).alias("inertia"))


def customer_clusters(spark, sf):
    """Customers in four known segments, by sex and by level of age, income and spending."""
    df = prepare_customers(derive(spark, sf, SEGMENTS))
    _, _, labelled = cluster_customers(df, k=4)
    return _profiled(profile(labelled, cols=FEATURES))


def _profiled(df):
    return df.select("cluster", *[rd(c, 6).alias(c) for c in FEATURES])


def customer_prepared(spark, sf):
    return prepare_customers(derive(spark, sf, SHOPPERS))


QUERIES = {
    f.__name__: f for f in (
        kmeans_assign, kmeans_inertia, kmeans_profile, kmeans_by_class, kmeans_fit_planted, kmeans_fit_labels,
        kmeans_elbow_planted, kmeans_elbow, kmeans_assign_masked, kmeans_inertia_masked, kmeans_scaled_vs_raw, kmeans_scaled_vs_raw_labels, customer_prepared, customer_clusters,
    )
}

_FAR = [f"(pow(c_acctbal - {a}, 2) + pow(c_nationkey - {b}, 2))" for a, b in CENTRES]
_LABELLED = "SELECT *, CAST(list_position([{0}], least({0})) - 1 AS INTEGER) AS cluster, least({0}) AS far FROM customer".format(", ".join(_FAR))
_PLANTED, _SHOPPERS = plain(PLANTED), plain(SHOPPERS)
_MEANS = f"SELECT planted, count(*) AS n, avg(u) AS u, avg(v) AS v, var_pop(u) + var_pop(v) AS spread FROM ({_PLANTED}) GROUP BY 1"
ORACLE = {
    "kmeans_assign": f"SELECT c_custkey, cluster FROM ({_LABELLED})",
    "kmeans_inertia": f"SELECT {sql_rd('sum(far)', 1)} AS inertia FROM ({_LABELLED})",
    "kmeans_profile": f"SELECT cluster, {', '.join(f'{sql_rd(f'avg({c})', 6)} AS {c}' for c in COLS)} FROM ({_LABELLED}) GROUP BY 1",
    "kmeans_by_class": "SELECT c_mktsegment, " + ", ".join(
        f"count(*) FILTER (cluster = {i}) AS cluster_{i}" for i in range(len(CENTRES))
    ) + f" FROM ({_LABELLED}) GROUP BY 1",
    "kmeans_fit_planted": f"SELECT CAST(row_number() OVER (ORDER BY u, v) - 1 AS INTEGER) AS cluster, {sql_rd('u', 6)} AS u, {sql_rd('v', 6)} AS v FROM ({_MEANS})",
    "kmeans_fit_labels": f"SELECT planted, CAST(1 AS BIGINT) AS clusters, n FROM ({_MEANS})",
    "kmeans_elbow_planted": f"""
SELECT 1 AS k, {sql_rd('count(*) * (var_pop(u) + var_pop(v))', 3)} AS inertia FROM ({_PLANTED})
UNION ALL SELECT 5, {sql_rd('sum(n * spread)', 3)} FROM ({_MEANS})""",
    "kmeans_assign_masked": f"SELECT c_custkey, CASE WHEN c_custkey % 6 <> 0 AND c_custkey % 10 <> 0 THEN cluster END AS cluster FROM ({_LABELLED})",
    "kmeans_inertia_masked": f"SELECT {sql_rd('sum(far)', 1)} AS inertia FROM ({_LABELLED}) WHERE c_custkey % 6 <> 0 AND c_custkey % 10 <> 0",
    # The best k clusters of groups on a line are runs of neighbours: every way of cutting is tried.
    "kmeans_elbow": f"""
WITH g AS (SELECT g, count(*) AS n, avg(u) AS u, avg(v) AS v, count(*) * (var_pop(u) + var_pop(v)) AS within FROM ({plain(LINE)}) GROUP BY g),
w AS (SELECT m, g.*, bit_count(m & ((1 << CAST(g AS INT)) - 1)) AS part FROM g, range(1024) r(m)),
c AS (SELECT m, part, sum(n * u) / sum(n) AS cu, sum(n * v) / sum(n) AS cv FROM w GROUP BY m, part),
s AS (SELECT m, sum(within + n * (pow(u - cu, 2) + pow(v - cv, 2))) AS inertia FROM w JOIN c USING (m, part) GROUP BY m)
SELECT CAST(bit_count(m) + 1 AS INT) AS k, format('{{:.5e}}', min(inertia)) AS inertia FROM s GROUP BY k""",
    "kmeans_scaled_vs_raw": " UNION ALL ".join(
        f"SELECT '{variant}' AS variant, CAST(planted AS INT) AS cluster, '{c}' AS \"column\", {sql_rd(c, 6)} AS mean FROM ({_MEANS})" for variant in ("raw", "scaled") for c in "uv"),
    "kmeans_scaled_vs_raw_labels": f"SELECT CAST(planted AS INT) AS raw, CAST(planted AS INT) AS scaled, n FROM ({_MEANS})",
    "customer_clusters": f"""
WITH r AS (SELECT *, row_number() OVER (ORDER BY md5(CAST(customer_id AS VARCHAR) || '|123'), customer_id) - 1 AS rk, count(*) OVER () AS n FROM ({plain(SEGMENTS)})),
z AS (SELECT *, ceil(0.1e0 * n) AS nt FROM r),
m AS (SELECT avg(age) AS age, avg(annual_income) AS annual_income, avg(spending_score) AS spending_score, avg(CASE WHEN gender = 'Male' THEN 1e0 ELSE 0 END) AS is_male
      FROM z WHERE rk >= nt + ceil(0.2e0 * (n - nt)) GROUP BY customer_id % 4)
SELECT CAST(row_number() OVER (ORDER BY age, annual_income, spending_score, is_male) - 1 AS INT) AS cluster,
       {', '.join(f'{sql_rd(c, 6)} AS {c}' for c in FEATURES)} FROM m""",
    "customer_prepared": f"""
WITH r AS (SELECT *, row_number() OVER (ORDER BY md5(CAST(customer_id AS VARCHAR) || '|123'), customer_id) - 1 AS rk, count(*) OVER () AS n FROM ({_SHOPPERS})),
z AS (SELECT *, ceil(0.1e0 * n) AS nt FROM r)
SELECT CAST(customer_id AS VARCHAR) AS customer_id, age, annual_income, spending_score, CASE WHEN gender = 'Male' THEN 1 ELSE 0 END AS is_male,
       CASE WHEN rk < nt THEN 'test' WHEN rk < nt + ceil(0.2e0 * (n - nt)) THEN 'validate' ELSE 'train' END AS split FROM z""",
}
