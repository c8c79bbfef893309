"""Missing-data summaries, sparse-column and sparse-row removal, plan-driven imputation."""

from __future__ import annotations

import math
from functools import reduce
from operator import add

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, FractionalType, IntegralType, StringType

from tabwork.functions.missing import nan_to_null, normalize_missing
from tabwork.operators.quantile import quantile_dict

ACTIONS = ("mean", "median", "mode", "drop", "drop row")


def _present(field):
    return nan_to_null(field.name, field.dataType)


def describe_missing(df: DataFrame) -> DataFrame:
    """``(attribute, num_rows_missing, pct_rows_missing)``; percent is 0-100. One pass for all columns."""
    wide = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(_present(f)).alias(f"c{i}") for i, f in enumerate(df.schema)],
    )
    return wide.select(F.inline(F.array(*[
        F.struct(
            F.lit(f.name).alias("attribute"),
            (F.col("n") - F.col(f"c{i}")).alias("num_rows_missing"),
            F.when(F.col("n") > 0, (F.col("n") - F.col(f"c{i}")) / F.nullif(F.col("n"), F.lit(0)) * 100)
            .alias("pct_rows_missing"),
        )
        for i, f in enumerate(df.schema)
    ])))


def missing_per_row(df: DataFrame) -> DataFrame:
    """``(num_cols_missing, pct_col_missing, num_rows)``; the share is a fraction 0-1."""
    cells = reduce(add, [_present(f).isNull().cast("int") for f in df.schema])
    width = float(len(df.columns))
    return (
        df.select(cells.alias("num_cols_missing")).groupBy("num_cols_missing")
        .agg(F.count(F.lit(1)).alias("num_rows"))
        .select("num_cols_missing", (F.col("num_cols_missing") / F.lit(width)).alias("pct_col_missing"), "num_rows")
    )


def drop_sparse(df: DataFrame, col_prop: float = 0.5, row_prop: float = 0.75) -> DataFrame:
    """Keep columns, then rows, with enough values.

    A column needs ``round(col_prop * rows)`` values, a row ``round(row_prop *
    kept columns)``; halves round to even.  One counting job, then a lazy filter.
    """
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count(_present(f)).alias(f"c{i}") for i, f in enumerate(df.schema)],
    ).first()
    need = round(col_prop * counts["n"])
    kept = [name for i, name in enumerate(df.columns) if counts[f"c{i}"] >= need]
    if not kept:
        return df.select(*kept)
    return df.select(*kept).dropna(thresh=round(row_prop * len(kept)))


def drop_rows_missing(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.dropna(subset=cols)


class NullPlan(Estimator):
    """Fit a plan ``column -> 'mean' | 'median' | 'mode' | 'drop' | 'drop row'``.

    Fit on the training rows only; the model fills any split with the same values.
    Equal modes: the lowest value wins.
    """

    plan = Param(Params._dummy(), "plan", "dict of column name to action")

    @keyword_only
    def __init__(self, *, plan: dict[str, str]):
        super().__init__()
        wrong = {c: a for c, a in plan.items() if a not in ACTIONS}
        if wrong:
            raise ValueError(f"unknown actions: {wrong}")
        self._set(plan=dict(plan))

    def _fit(self, dataset: DataFrame) -> NullPlanModel:
        plan = self.getOrDefault(self.plan)
        having = lambda action: [c for c, a in plan.items() if a == action]
        train = dataset
        for c in plan:
            if c not in dataset.columns:
                raise KeyError(f"column not found: {c}")
        if having("drop row"):
            train = train.dropna(subset=having("drop row"))
        train = normalize_missing(train)
        fills: dict[str, object] = {}
        means = having("mean")
        if means:
            row = train.agg(*[F.avg(f"`{c}`").alias(f"m{i}") for i, c in enumerate(means)]).first()
            fills.update({c: row[i] for i, c in enumerate(means)})
        medians = having("median")
        if medians:
            found = quantile_dict(train, medians, [0.5])
            fills.update({c: found[c][0] if found[c] else None for c in medians})
        fills.update(_modes(train, having("mode")))
        empty = [c for c, v in fills.items() if v is None]
        if empty:
            raise ValueError(f"no value to learn from in {empty}")
        return NullPlanModel(plan=plan, fills=fills)


#: Values that the sketch of a column tracks; no value it leaves out has more than 3.5 / TRACKED of the rows.
TRACKED, CANDIDATES = 10_000, 20
#: Sketches that one task merges at most, in the second of two levels.
SALTS = 64
_SKETCHED = (IntegralType, StringType, BooleanType, DateType, FractionalType)


def _modes(df: DataFrame, cols: list[str]) -> dict[str, object]:
    """Most frequent value per column, the lowest of equals.

    One job sketches the frequent values of all columns, a second counts only the best candidates exactly. Where the
    bound of the sketch doesn't put every other value below them, the column is counted in full.
    """
    result: dict[str, object] = {}
    easy = [c for c in cols if isinstance(df.schema[c].dataType, _SKETCHED)]
    bounds = _candidates(df, easy) if easy else {}
    counted = _candidate_counts(df, {c: values for c, (values, _) in bounds.items() if values})
    for c in cols:
        values, others = bounds.get(c, ([], math.inf))
        counts = counted.get(c, {})
        best = max(counts.values(), default=0)
        if best > others:
            result[c] = min(values[i] for i, n in counts.items() if n == best)
        else:
            result[c] = _mode_by_counting(df, c)
    return result


def _candidates(df, cols):
    """Per column its most frequent values by the sketch, and a bound on the count of any other value."""
    salted = df.select(*[F.col(f"`{c}`").alias(f"v{i}") for i, c in enumerate(cols)], (F.spark_partition_id() % SALTS).alias("salt"))
    low = salted.groupBy("salt").agg(*[a for i in range(len(cols)) for a in (F.expr(f"approx_top_k_accumulate(v{i}, {TRACKED})").alias(f"s{i}"), F.count(f"v{i}").alias(f"n{i}"))])
    top = low.agg(*[a for i in range(len(cols)) for a in (F.expr(f"approx_top_k_combine(s{i}, {TRACKED})").alias(f"s{i}"), F.sum(f"n{i}").alias(f"n{i}"))])
    row = top.select(*[a for i in range(len(cols)) for a in (F.expr(f"approx_top_k_estimate(s{i}, {CANDIDATES + 1})").alias(f"t{i}"), f"n{i}")]).first()
    found = {}
    for i, c in enumerate(cols):
        items = [(r["item"], r["count"]) for r in row[f"t{i}"] or [] if r["item"] is not None]
        beyond = [n for _, n in items[CANDIDATES:]]
        found[c] = ([v for v, _ in items[:CANDIDATES]], max([3.5 / TRACKED * (row[f"n{i}"] or 0), *beyond]))
    return found


def _candidate_counts(df, candidates):
    """Exact counts {column: {place in the list: count}} of the candidate values, in one job."""
    if not candidates:
        return {}
    names = list(candidates)
    places = F.array(*[
        F.struct(F.lit(i).alias("series"), F.array_position(F.array(*[F.lit(v).cast(df.schema[c].dataType) for v in candidates[c]]), F.col(f"`{c}`")).alias("place"))
        for i, c in enumerate(names)
    ])
    rows = df.select(F.inline(places)).where("place > 0").groupBy("series", "place").agg(F.count(F.lit(1)).alias("n")).collect()
    found: dict[str, dict[int, int]] = {}
    for r in rows:
        found.setdefault(names[r["series"]], {})[r["place"] - 1] = r["n"]
    return found


def _mode_by_counting(df, c):
    top = (
        df.select(F.col(f"`{c}`").alias("v")).where("v is not null").groupBy("v").agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc("v")).limit(1).collect()
    )
    return top[0].v if top else None


class NullPlanModel(Model):
    """Learned fill values; ``transform`` is one lazy projection and filter."""

    def __init__(self, plan: dict[str, str], fills: dict[str, object]):
        super().__init__()
        self.plan, self.fills = dict(plan), dict(fills)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        df = normalize_missing(dataset)
        rows = [c for c, a in self.plan.items() if a == "drop row"]
        if rows:
            df = df.dropna(subset=rows)
        filled = {}
        for c, value in self.fills.items():
            # Mean and median may be fractional: widen so that 6.63 is not stored as 6.
            kind = "double" if self.plan[c] in ("mean", "median") else df.schema[c].dataType
            filled[c] = F.coalesce(F.col(f"`{c}`").cast(kind), F.lit(value).cast(kind))
        df = df.withColumns(filled) if filled else df
        return df.drop(*[c for c, a in self.plan.items() if a == "drop"])
