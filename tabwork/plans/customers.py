"""Customer plan: indicator for gender, split, scaling, clustering and comparison of scaled with raw."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tabwork.functions.columns import as_categorical, drop_columns, one_hot
from tabwork.operators.cluster import KMeansFit, kmeans_fit
from tabwork.operators.scale import Scaler, ScalerModel
from tabwork.operators.split import split

FEATURES = ["age", "annual_income", "spending_score", "is_male"]


def prepare_customers(df: DataFrame, key: str = "customer_id") -> DataFrame:
    """``gender`` becomes ``is_male``, the id becomes a category, rows get their split."""
    coded = drop_columns(one_hot(df, "gender", rename={"Male": "is_male"}), ["gender"])
    return split(as_categorical(coded, [key]), key)


def cluster_customers(
    df: DataFrame, k: int = 4, restarts: int = 10, cols: list[str] | None = None
) -> tuple[ScalerModel, KMeansFit, DataFrame]:
    """Min-max scale on train, cluster train, label train; centroids are in scaled units."""
    cols = FEATURES if cols is None else cols
    train = df.where("split = 'train'")
    scaler = Scaler(kind="minmax", cols=cols).fit(train)
    fit = kmeans_fit(scaler.transform(train), cols, k, restarts)
    # Labels need scaled distances; the inverse then gives the values back in original units.
    labelled = scaler.inverse_transform(fit.label(scaler.transform(train)))
    return scaler, fit, labelled
