"""Property plan: latest transaction per property, single-unit filter, cleaning, split, imputation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabwork.functions.columns import as_categorical, drop_columns, map_codes
from tabwork.functions.missing import normalize_missing, not_true
from tabwork.operators.missing import NullPlan, drop_sparse
from tabwork.operators.relational import enrich, latest_per_key
from tabwork.operators.split import split
from tabwork.sources.tables import acquire_cached

# The land uses counted as single-unit.
SINGLE_UNIT_USES = [
    "Single Family Residential", "Condominium", "Planned Unit Development", "Mobile Home",
    "Manufactured, Modular, Prefabricated Homes", "Residential General",
]
# County codes and names.
COUNTIES = {6037: "Los Angeles", 6059: "Orange", 6111: "Ventura"}
# The lookup tables, each with a <name>id code and a description column.
LOOKUPS = [
    ("airconditioningtype", "airconditioningtypeid", "airconditioningdesc"),
    ("architecturalstyletype", "architecturalstyletypeid", "architecturalstyledesc"),
    ("buildingclasstype", "buildingclasstypeid", "buildingclassdesc"),
    ("heatingorsystemtype", "heatingorsystemtypeid", "heatingorsystemdesc"),
    ("propertylandusetype", "propertylandusetypeid", "propertylandusedesc"),
    ("storytype", "storytypeid", "storydesc"),
    ("typeconstructiontype", "typeconstructiontypeid", "typeconstructiondesc"),
]
# Columns that carry no further information after the filters.
DROPPED = [
    "assessmentyear", "calculatedbathnbr", "finishedsquarefeet12", "propertyzoningdesc", "regionidcity",
    "roomcnt", "unitcnt",
]
# Columns that cannot be imputed, so rows without them go.
REQUIRED = ["censustractandblock", "regionidzip"]
# Numeric codes treated as categories.
CATEGORICAL = [
    "id", "parcelid", "fips", "heatingorsystemtypeid", "propertylandusetypeid", "rawcensustractandblock",
    "regionidcounty", "regionidzip", "censustractandblock",
]
# How each remaining column is filled.
IMPUTATION = {
    "buildingqualitytypeid": "mean",
    "calculatedfinishedsquarefeet": "median",
    "fullbathcnt": "median",
    "heatingorsystemtypeid": "mode",
    "heatingorsystemdesc": "mode",
    "lotsizesquarefeet": "median",
    "yearbuilt": "mean",
    "structuretaxvaluedollarcnt": "median",
    "taxvaluedollarcnt": "median",
    "landtaxvaluedollarcnt": "median",
    "taxamount": "median",
}


def property_transactions(
    tables: Mapping[str, DataFrame], start: str = "2017-01-01", end: str = "2017-12-31", ties: str = "keep"
) -> DataFrame:
    """Properties with a position, their last transaction if it lies in the range, and seven descriptions.

    The range applies after the last transaction is found: a property whose last
    sale is outside it disappears.  ``ties='first'`` gives one row per property.
    """
    newest = latest_per_key(
        tables["predictions"], ["parcelid"], "transactiondate", ties, ["id"] if ties == "first" else ()
    ).where(F.col("transactiondate").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    placed = tables["properties"].where("latitude is not null and longitude is not null")
    joined = placed.join(newest.select("parcelid", "logerror", "transactiondate"), "parcelid")
    return enrich(joined, [(tables[name], key, [text]) for name, key, text in LOOKUPS])


def clean_properties(df: DataFrame) -> DataFrame:
    """Single-unit properties, sparse columns and rows removed, codes as categories, county names.

    Column counts are taken in one job; everything else stays lazy.
    """
    df = normalize_missing(df)
    df = df.where(F.col("propertylandusedesc").isin(SINGLE_UNIT_USES))
    df = df.where(F.col("bedroomcnt") > 0).where(not_true(F.col("unitcnt") > 1))
    df = drop_columns(drop_sparse(df), DROPPED, strict=False).dropna(subset=REQUIRED)
    df = as_categorical(df, CATEGORICAL)
    return df.withColumn("fips", map_codes(F.col("fips"), {str(code): name for code, name in COUNTIES.items()}))


def split_and_impute(
    df: DataFrame, key: str | Sequence[str] = "parcelid", pct: float = 0.10, plan: Mapping[str, str] = IMPUTATION
) -> DataFrame:
    """Add ``split`` and fill missing values in all parts with what the training part teaches."""
    parts = split(df, key, pct)
    return NullPlan(plan=dict(plan)).fit(parts.where("split = 'train'")).transform(parts)


def prepare_properties(
    spark: SparkSession, tables: Mapping[str, DataFrame], cache: str, ties: str = "first", **dates
) -> DataFrame:
    """The whole preparation, from source tables to imputed splits.

    The joined table is stored under ``cache`` (storage every executor sees) when it
    is not there yet; the later counting and statistics jobs read it, not the joins.
    """
    joined = acquire_cached(spark, lambda: property_transactions(tables, ties=ties, **dates), cache)
    return split_and_impute(clean_properties(joined))
