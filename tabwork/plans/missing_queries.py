"""Queries: missing-data summaries, sparse removal, imputation, the property plan."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabwork.operators.missing import NullPlan, describe_missing, drop_rows_missing, drop_sparse, missing_per_row
from tabwork.plans.base import DOCS_LABELLED, ORDERS_MASKED, derive, plain, rd, scratch_path, sql_rd
from tabwork.plans.property import (
    CATEGORICAL, COUNTIES, IMPUTATION, LOOKUPS, SINGLE_UNIT_USES, clean_properties, prepare_properties, property_transactions,
)
from tabwork.sources.tables import acquire_cached

PLAN = {"price": "median", "grade": "mean", "status": "mode", "priority": "drop"}
DATES = {"start": "2000-01-01", "end": "2001-12-31"}


def missing_one_column(spark, sf):
    df = derive(spark, sf, DOCS_LABELLED)
    return df.agg(F.count_if(F.col("quality").isNull()).alias("n_missing"))


def describe_missing_docs(spark, sf):
    df = describe_missing(derive(spark, sf, DOCS_LABELLED))
    return df.withColumn("pct_rows_missing", rd("pct_rows_missing", 8))


def describe_missing_orders(spark, sf):
    df = describe_missing(derive(spark, sf, ORDERS_MASKED))
    return df.withColumn("pct_rows_missing", rd("pct_rows_missing", 8))


def missing_per_row_orders(spark, sf):
    df = missing_per_row(derive(spark, sf, ORDERS_MASKED))
    return df.withColumn("pct_col_missing", rd("pct_col_missing", 8))


def drop_sparse_orders(spark, sf):
    return drop_sparse(derive(spark, sf, ORDERS_MASKED).drop("o_orderdate"))


def drop_required_rows(spark, sf):
    return drop_rows_missing(derive(spark, sf, ORDERS_MASKED).drop("o_orderdate"), ["price", "status"])


def impute_plan(spark, sf):
    df = derive(spark, sf, ORDERS_MASKED).drop("o_orderdate")
    return NullPlan(plan=PLAN).fit(df).transform(df).withColumn("grade", rd("grade", 8))


def impute_drop_rows(spark, sf):
    df = derive(spark, sf, DOCS_LABELLED)
    return NullPlan(plan={"quality": "drop row", "toxic": "mode", "source": "drop"}).fit(df).transform(df)


# One property per customer, one transaction per order; codes and gaps by fixed rules.
PROPERTIES = """
SELECT c_custkey + 1000000 AS id, c_custkey AS parcelid,
  CASE WHEN c_custkey % 50 = 0 THEN NULL ELSE 33e0 + c_nationkey END AS latitude,
  CASE WHEN c_custkey % 61 = 0 THEN NULL ELSE -118e0 - c_nationkey END AS longitude,
  CAST(c_custkey % 4 AS DOUBLE) AS bathroomcnt, CAST(c_custkey % 7 AS DOUBLE) AS bedroomcnt,
  CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE CAST(c_custkey % 4 AS DOUBLE) END AS calculatedbathnbr,
  CASE WHEN c_custkey % 31 = 0 THEN NULL ELSE CAST(c_custkey % 3 AS DOUBLE) END AS fullbathcnt,
  CAST(c_custkey % 9 AS DOUBLE) AS roomcnt,
  CASE WHEN c_custkey % 3 = 0 THEN NULL WHEN c_custkey % 8 = 0 THEN 2e0 ELSE 1e0 END AS unitcnt,
  CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE c_acctbal + 1500 END AS calculatedfinishedsquarefeet,
  CASE WHEN c_custkey % 15 = 0 THEN NULL ELSE c_acctbal + 1500 END AS finishedsquarefeet12,
  CASE WHEN c_custkey % 13 = 0 THEN NULL ELSE c_acctbal * 3 + 4000 END AS lotsizesquarefeet,
  CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE CAST(c_custkey % 12 AS DOUBLE) END AS buildingqualitytypeid,
  CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE 1900e0 + c_custkey % 117 END AS yearbuilt,
  2016e0 AS assessmentyear,
  CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE c_acctbal * 50 + 60000 END AS structuretaxvaluedollarcnt,
  CASE WHEN c_custkey % 29 = 0 THEN NULL ELSE c_acctbal * 90 + 100000 END AS taxvaluedollarcnt,
  CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE c_acctbal * 40 + 45000 END AS landtaxvaluedollarcnt,
  CASE WHEN c_custkey % 41 = 0 THEN NULL ELSE c_acctbal + 1200 END AS taxamount,
  CASE c_nationkey % 3 WHEN 0 THEN 6037e0 WHEN 1 THEN 6059e0 ELSE 6111e0 END AS fips,
  CAST(c_custkey % 100 AS DOUBLE) AS regionidcity, CAST(c_nationkey % 3 AS DOUBLE) AS regionidcounty,
  CASE WHEN c_custkey % 43 = 0 THEN NULL ELSE 90000e0 + c_nationkey END AS regionidzip,
  60370000e0 + c_custkey AS rawcensustractandblock,
  CASE WHEN c_custkey % 47 = 0 THEN NULL ELSE 60370000e0 + c_custkey END AS censustractandblock,
  CASE WHEN c_custkey % 10 < 7 THEN NULL ELSE c_mktsegment END AS propertyzoningdesc,
  CASE WHEN c_custkey % 10 < 8 THEN NULL ELSE c_nationkey END AS airconditioningtypeid,
  CASE WHEN c_custkey % 10 < 9 THEN NULL ELSE c_nationkey END AS architecturalstyletypeid,
  CASE WHEN c_custkey % 10 < 9 THEN NULL ELSE c_nationkey END AS buildingclasstypeid,
  CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE CAST(c_nationkey % 4 AS DOUBLE) END AS heatingorsystemtypeid,
  CAST(c_nationkey AS DOUBLE) AS propertylandusetypeid,
  CASE WHEN c_custkey % 10 < 9 THEN NULL ELSE c_nationkey END AS storytypeid,
  CASE WHEN c_custkey % 10 < 9 THEN NULL ELSE c_nationkey END AS typeconstructiontypeid
FROM {customer}"""
PREDICTIONS = """
SELECT o_orderkey AS id, o_custkey AS parcelid, (o_totalprice - 250000) / 1000000 AS logerror,
       CAST(o_orderdate AS DATE) AS transactiondate FROM {orders}"""
LAND_USES = """
SELECT CAST(n_nationkey AS DOUBLE) AS propertylandusetypeid,
  CASE n_nationkey % 8 WHEN 0 THEN 'Single Family Residential' WHEN 1 THEN 'Condominium' WHEN 2 THEN 'Planned Unit Development'
    WHEN 3 THEN 'Mobile Home' WHEN 4 THEN 'Manufactured, Modular, Prefabricated Homes' WHEN 5 THEN 'Residential General'
    WHEN 6 THEN 'Duplex' END AS propertylandusedesc FROM {nation}"""
HEATING = "SELECT CAST(r_regionkey AS DOUBLE) AS heatingorsystemtypeid, r_name AS heatingorsystemdesc FROM {region}"


def _lookup_text(name, key, text):
    if name == "propertylandusetype":
        return LAND_USES
    if name == "heatingorsystemtype":
        return HEATING
    return f"SELECT n_nationkey AS {key}, n_name AS {text} FROM {{nation}}"


def _tables(spark, sf):
    texts = {"properties": PROPERTIES, "predictions": PREDICTIONS, **{n: _lookup_text(n, k, t) for n, k, t in LOOKUPS}}
    return {n: derive(spark, sf, t) for n, t in texts.items()}


def _small_types(df):
    return df.withColumn("transactiondate", F.col("transactiondate").cast("string")).withColumn("logerror", rd("logerror", 8))


def property_join(spark, sf):
    return _small_types(property_transactions(_tables(spark, sf), **DATES)).select(
        "parcelid", "logerror", "transactiondate", *[t for _, _, t in LOOKUPS]
    )


def _stored(spark, sf, ties):
    """The joined table is written once, so that the statistics jobs that follow do not repeat the joins."""
    build = lambda: property_transactions(_tables(spark, sf), ties=ties, **DATES)
    return acquire_cached(spark, build, scratch_path(spark, "properties"))


def property_clean(spark, sf):
    return _small_types(clean_properties(_stored(spark, sf, "keep")))


def property_prepared(spark, sf):
    df = prepare_properties(spark, _tables(spark, sf), scratch_path(spark, "properties"), **DATES)
    return _small_types(df).withColumns({c: rd(c, 6) for c in ("buildingqualitytypeid", "yearbuilt")})


QUERIES = {
    f.__name__: f for f in (
        missing_one_column, describe_missing_docs, describe_missing_orders, missing_per_row_orders, drop_sparse_orders,
        drop_required_rows, impute_plan, impute_drop_rows, property_join, property_clean, property_prepared,
    )
}

_ORDERS, _DOCS = plain(ORDERS_MASKED), plain(DOCS_LABELLED)
_ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderdate", "price", "status", "priority", "grade"]
_DOC_COLUMNS = ["doc_id", "lang", "source", "n_chars", "quality", "toxic"]


def _missing_sql(source, cols):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS attribute, count(*) - count({c}) AS num_rows_missing, "
        f"{sql_rd(f'(count(*) - count({c})) * 100e0 / count(*)', 8)} AS pct_rows_missing FROM ({source})" for c in cols
    )


def _cells_missing(cols):
    return " + ".join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in cols)


def _mode_sql(column, source):
    return f"(SELECT {column} FROM ({source}) WHERE {column} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"


def _property_sql(pick):
    """Joined properties in the SQL check; ``pick`` is the rank expression that marks the newest record."""
    lookups = " ".join(
        f"LEFT JOIN ({plain(_lookup_text(n, k, t))}) AS t{i} ON p.{k} = t{i}.{k}" for i, (n, k, t) in enumerate(LOOKUPS)
    )
    return f"""
SELECT p.*, s.logerror, s.transactiondate, {', '.join(f't{i}.{t}' for i, (_, _, t) in enumerate(LOOKUPS))}
FROM ({plain(PROPERTIES)}) AS p
JOIN (SELECT *, {pick} AS newest FROM ({plain(PREDICTIONS)})) AS s ON p.parcelid = s.parcelid AND s.newest = 1
{lookups}
WHERE latitude IS NOT NULL AND longitude IS NOT NULL
  AND transactiondate BETWEEN DATE '{DATES['start']}' AND DATE '{DATES['end']}'"""


_KEEP_TIES = "rank() OVER (PARTITION BY parcelid ORDER BY transactiondate DESC)"
_ONE_ROW = "row_number() OVER (PARTITION BY parcelid ORDER BY transactiondate DESC, id DESC)"
# Columns of the fixed tables that stay above half full, in table order.
_DENSE = [
    "parcelid", "id", "latitude", "longitude", "bathroomcnt", "bedroomcnt", "calculatedbathnbr", "fullbathcnt", "roomcnt",
    "unitcnt", "calculatedfinishedsquarefeet", "finishedsquarefeet12", "lotsizesquarefeet", "buildingqualitytypeid",
    "yearbuilt", "assessmentyear", "structuretaxvaluedollarcnt", "taxvaluedollarcnt", "landtaxvaluedollarcnt", "taxamount",
    "fips", "regionidcity", "regionidcounty", "regionidzip", "rawcensustractandblock", "censustractandblock",
    "heatingorsystemtypeid", "propertylandusetypeid", "logerror", "transactiondate", "heatingorsystemdesc", "propertylandusedesc",
]
_GONE = {"assessmentyear", "calculatedbathnbr", "finishedsquarefeet12", "regionidcity", "roomcnt", "unitcnt"}
_LEFT = [c for c in _DENSE if c not in _GONE]


def _clean_sql(pick):
    uses = ", ".join(f"'{u}'" for u in SINGLE_UNIT_USES)
    county = "CASE CAST(fips AS BIGINT) " + " ".join(f"WHEN {k} THEN '{v}'" for k, v in COUNTIES.items()) + " END AS fips"
    columns = [
        county if c == "fips" else f"CAST(CAST({c} AS BIGINT) AS VARCHAR) AS {c}" if c in CATEGORICAL else c for c in _LEFT
    ]
    return f"""
SELECT {', '.join(columns)} FROM (SELECT * FROM ({_property_sql(pick)})
  WHERE propertylandusedesc IN ({uses}) AND bedroomcnt > 0 AND (unitcnt > 1) IS NOT TRUE)
WHERE {len(_DENSE)} - ({_cells_missing(_DENSE)}) >= {round(0.75 * len(_DENSE))}
  AND censustractandblock IS NOT NULL AND regionidzip IS NOT NULL"""


def _shown(c):
    if c == "transactiondate":
        return "CAST(transactiondate AS VARCHAR) AS transactiondate"
    return f"{sql_rd('logerror', 8)} AS logerror" if c == "logerror" else c


def _filled(c):
    action = IMPUTATION.get(c)
    if action is None:
        return _shown(c)
    if action == "mode":
        return f"coalesce({c}, {_mode_sql(c, 'SELECT * FROM train')}) AS {c}"
    value = f"(SELECT {'avg' if action == 'mean' else 'median'}({c}) FROM train)"
    filled = f"coalesce({c}, {value})"
    return f"{sql_rd(filled, 6) if action == 'mean' else filled} AS {c}"


_TRAIN = "SELECT * FROM orders_m"
ORACLE = {
    "missing_one_column": f"SELECT count(*) - count(quality) AS n_missing FROM ({_DOCS})",
    "describe_missing_docs": _missing_sql(_DOCS, _DOC_COLUMNS),
    "describe_missing_orders": _missing_sql(_ORDERS, _ORDER_COLUMNS),
    "missing_per_row_orders": f"""
SELECT num_cols_missing, {sql_rd('num_cols_missing / 7e0', 8)} AS pct_col_missing, count(*) AS num_rows
FROM (SELECT {_cells_missing(_ORDER_COLUMNS)} AS num_cols_missing FROM ({_ORDERS})) GROUP BY 1""",
    "drop_sparse_orders": f"""
SELECT o_orderkey, o_custkey, price, status, grade FROM ({_ORDERS})
WHERE 5 - ({_cells_missing(['o_orderkey', 'o_custkey', 'price', 'status', 'grade'])}) >= 4""",
    "drop_required_rows": f"SELECT * EXCLUDE (o_orderdate) FROM ({_ORDERS}) WHERE price IS NOT NULL AND status IS NOT NULL",
    "impute_plan": f"""
WITH orders_m AS ({_ORDERS})
SELECT o_orderkey, o_custkey, coalesce(price, (SELECT median(price) FROM ({_TRAIN}))) AS price,
       coalesce(status, {_mode_sql('status', _TRAIN)}) AS status,
       {sql_rd(f'coalesce(grade, (SELECT avg(grade) FROM ({_TRAIN})))', 8)} AS grade FROM orders_m""",
    "impute_drop_rows": f"""
WITH d AS (SELECT * FROM ({_DOCS}) WHERE quality IS NOT NULL)
SELECT doc_id, lang, n_chars, quality, coalesce(toxic, {_mode_sql('toxic', 'SELECT * FROM d')}) AS toxic FROM d""",
    "property_join": f"""
SELECT parcelid, {sql_rd('logerror', 8)} AS logerror, CAST(transactiondate AS VARCHAR) AS transactiondate,
       {', '.join(t for _, _, t in LOOKUPS)} FROM ({_property_sql(_KEEP_TIES)})""",
    "property_clean": f"SELECT {', '.join(_shown(c) for c in _LEFT)} FROM ({_clean_sql(_KEEP_TIES)})",
    "property_prepared": f"""
WITH clean AS ({_clean_sql(_ONE_ROW)}),
ranked AS (SELECT *, row_number() OVER (ORDER BY md5(parcelid || '|123'), parcelid) - 1 AS rk, count(*) OVER () AS n FROM clean),
sized AS (SELECT *, ceil(0.1e0 * n) AS n_test FROM ranked),
parts AS (SELECT *, CASE WHEN rk < n_test THEN 'test' WHEN rk < n_test + ceil(0.2e0 * (n - n_test)) THEN 'validate' ELSE 'train' END AS split FROM sized),
train AS (SELECT * FROM parts WHERE split = 'train')
SELECT {', '.join(_filled(c) for c in _LEFT)}, split FROM parts""",
}
