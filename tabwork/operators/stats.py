"""Classical tests from distributed aggregates.

Every test reduces map-side to one row (or one row per group) before its p-value is
taken.  Results carry ``p`` and ``reject`` (p below alpha).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabwork.functions.missing import normalize_missing
from tabwork.functions.pvalues import chi2_tail_array, f_pvalue, t_pvalue

ALPHA = 0.05
#: A constant group whose mean differs from an overall mean by a smaller share of it does not differ.
_ROUNDING = 1e-12
#: Slices in which levels of one side meet those of the other for a whole grid of cells.
_SLICES = 64


def _safe(column):
    return F.nullif(column, F.lit(0.0))


def _ratio(gap, spread, constant):
    """``gap`` over ``spread``; where the values are ``constant``, infinite, or 0 without a gap."""
    return F.when(constant, F.when(gap == 0, F.lit(0.0)).otherwise(F.signum(gap) * F.lit(float("inf")))).otherwise(gap / _safe(spread))


def _with_reject(df, alpha):
    return df.withColumn("reject", F.col("p") < F.lit(float(alpha)))


def ttest_ind(df: DataFrame, x: str, by: str, a, b, alpha: float = ALPHA) -> DataFrame:
    """Two-sample t-test with pooled variance of ``x`` between ``by = a`` and ``by = b``.

    Without variance in either sample t is infinite and p is 0, or both means are equal, t is 0 and p is 1.
    """
    data = normalize_missing(df.select(x, by)).where(F.col(by).isin([a, b]))
    pick = lambda level: F.when(F.col(by) == F.lit(level), F.col(x).cast("double"))
    row = data.agg(
        F.count(pick(a)).alias("n_a"), F.avg(pick(a)).alias("mean_a"), F.var_samp(pick(a)).alias("var_a"),
        F.count(pick(b)).alias("n_b"), F.avg(pick(b)).alias("mean_b"), F.var_samp(pick(b)).alias("var_b"),
        *[f(pick(level)).alias(f"{name}_{side}") for level, side in ((a, "a"), (b, "b")) for f, name in ((F.min, "least"), (F.max, "most"))],
    )
    dof = F.col("n_a") + F.col("n_b") - 2
    pooled = ((F.col("n_a") - 1) * F.coalesce("var_a", F.lit(0.0)) + (F.col("n_b") - 1)
              * F.coalesce("var_b", F.lit(0.0))) / _safe(dof.cast("double"))
    per_n = F.sqrt(F.lit(1.0) / _safe(F.col("n_a").cast("double")) + F.lit(1.0) / _safe(F.col("n_b").cast("double")))
    constant = (F.col("least_a") == F.col("most_a")) & (F.col("least_b") == F.col("most_b")) & (dof > 0)
    gap = F.when(constant, F.col("least_a") - F.col("least_b")).otherwise(F.col("mean_a") - F.col("mean_b"))
    result = row.select("n_a", "n_b", "mean_a", "mean_b", (_ratio(gap, F.sqrt(pooled), constant) / per_n).alias("t"), dof.alias("dof")).withColumn("p", t_pvalue("t", F.col("dof").cast("double")))
    return _with_reject(result, alpha)


def anova(df: DataFrame, x: str, by: str, groups: list | None = None, alpha: float = ALPHA) -> DataFrame:
    """One-way ANOVA over the levels of ``by`` (or the listed ``groups``).

    Values are centred on the grand mean first, so the between-group part keeps its
    digits however many rows there are. Without variance inside any group f is infinite and p is 0,
    or all means are equal, f is 0 and p is 1.
    """
    data = normalize_missing(df.select(F.col(x).cast("double").alias("x"), F.col(by).alias("g"))).dropna()
    if groups is not None:
        data = data.where(F.col("g").isin(list(groups)))
    grand = data.agg(F.avg("x")).first()[0]
    per = data.groupBy("g").agg(
        F.count(F.lit(1)).alias("n"), F.avg(F.col("x") - F.lit(grand).cast("double")).alias("d"), F.var_pop("x").alias("v"),
        F.min("x").alias("least"), F.max("x").alias("most"),
    )
    sums = per.agg(
        F.count(F.lit(1)).alias("k"), F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("d") * F.col("d")).alias("between"), F.sum(F.col("n") * F.col("v")).alias("within"),
        F.bool_and(F.col("least") == F.col("most")).alias("constant"), (F.min("least") == F.max("most")).alias("equal"),
    )
    between_dof, within_dof = F.col("k") - 1, F.col("n") - F.col("k")
    result = sums.select(
        between_dof.alias("dof_between"), within_dof.alias("dof_within"),
        _ratio(
            F.when(F.col("equal"), F.lit(0.0)).otherwise(F.col("between")) / _safe(between_dof.cast("double")),
            F.col("within") / _safe(within_dof.cast("double")), F.col("constant") & (within_dof > 0),
        ).alias("f"),
    ).withColumn("p", f_pvalue("f", F.col("dof_between").cast("double"), F.col("dof_within").cast("double")))
    return _with_reject(result, alpha)


def _pair_counts(df, a, b):
    """Rows (a, b, o) of the pairs that occur, and the totals (a, r) and (b, c)."""
    data = normalize_missing(df.select(F.col(f"`{a}`").alias("a"), F.col(f"`{b}`").alias("b"))).dropna()
    cells = data.groupBy("a", "b").agg(F.count(F.lit(1)).alias("o"))
    return cells, lambda cells: (cells.groupBy("a").agg(F.sum("o").alias("r")), cells.groupBy("b").agg(F.sum("o").alias("c")))


def expected_counts(df: DataFrame, a: str, b: str) -> DataFrame:
    """Observed and expected count of every cell ``(a, b, observed, expected)``, absent pairs with 0.

    The grid has as many rows as there are levels of ``a`` times levels of ``b``: that is the result asked for.
    It is made by matching the levels of ``a``, repeated for ``_SLICES`` slices, with the slice of each level of ``b``.
    """
    cells, totals = _pair_counts(df, a, b)
    rows, cols = totals(cells)
    n = rows.agg(F.sum("r")).first()[0]
    if not n:
        raise ValueError("no complete pairs")
    sliced = cols.withColumn("slice", F.pmod(F.xxhash64("b"), F.lit(_SLICES)).cast("int"))
    grid = rows.withColumn("slice", F.explode(F.sequence(F.lit(0), F.lit(_SLICES - 1)))).join(sliced, "slice")
    expected = F.col("r") * (F.col("c").cast("double") / F.lit(float(n)))
    return grid.join(cells, ["a", "b"], "left").select(
        F.col("a").alias(a), F.col("b").alias(b), F.coalesce("o", F.lit(0).cast("bigint")).alias("observed"), expected.alias("expected"))


def chi2(df: DataFrame, a: str, b: str, correction: bool = True, alpha: float = ALPHA) -> DataFrame:
    """Chi-square test of independence ``(chi2, dof, p, reject)``; 2x2 tables take the Yates correction.

    One scan counts the pairs that occur; the rest works on those counts, whatever the number of levels. A pair that
    doesn't occur adds its expected count, and all expected counts add up to n, so absent pairs are never listed.
    """
    cells, totals = _pair_counts(df, a, b)
    cells = cells.persist()
    try:
        rows, cols = totals(cells)
        r = rows.agg(F.count(F.lit(1)).alias("levels"), F.sum(1.0 / F.col("r")).alias("inverse"), F.sum("r").alias("n")).first()
        c = cols.agg(F.count(F.lit(1)).alias("levels"), F.sum(1.0 / F.col("c")).alias("inverse")).first()
        n, dof = r["n"], (r["levels"] - 1) * (c["levels"] - 1)
        if not n:
            raise ValueError("no complete pairs")
        expected = F.col("r") * (F.col("c").cast("double") / F.lit(float(n)))
        gap = F.abs(F.col("o") - expected)
        part = cells.join(rows, "a").join(cols, "b").agg(
            F.count(F.lit(1)).alias("cells"), F.sum(gap * gap / expected).alias("listed"), F.sum(expected).alias("expected"), F.max(gap).alias("gap")).first()
    finally:
        cells.unpersist()
    value = part["listed"] + (0.0 if part["cells"] == r["levels"] * c["levels"] else n - part["expected"])
    if correction and dof == 1:
        # In a 2x2 table observed and expected differ by the same number in all four cells.
        value = (part["gap"] - min(part["gap"], 0.5)) ** 2 * n * r["inverse"] * c["inverse"]
    value = max(value, 0.0)
    tail = 1.0 if dof == 0 else float(chi2_tail_array(value, dof))
    return df.sparkSession.createDataFrame([(value, dof, tail, tail < alpha)], "chi2 double, dof bigint, p double, reject boolean")


def pearson(df: DataFrame, x: str, y: str, by: str | None = None, alpha: float = ALPHA) -> DataFrame:
    """Pearson correlation, whole table or per group: ``(by, n, r, t, p, reject)``.

    At r = 1 or -1 t is infinite and p is 0; r is NULL where a column is constant, and t and p with it.
    """
    keys = [by] if by else []
    data = normalize_missing(df.select(F.col(x).cast("double").alias("x"), F.col(y).cast("double").alias("y"), *keys)).dropna()
    base = data.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.covar_pop("x", "y").alias("together"),
        *[f.alias(name) for c in "xy" for f, name in ((F.stddev_pop(c), f"sd_{c}"), (F.min(c) == F.max(c), f"flat_{c}"))],
    )
    base = base.withColumn("r", F.col("together") / _safe(F.when(~F.col("flat_x") & ~F.col("flat_y"), F.col("sd_x") * F.col("sd_y"))))
    base = base.withColumn("r", F.when(F.abs("r") > 1 - 1e-15, F.signum("r")).otherwise(F.col("r")))
    r = F.col("r")
    result = base.select(
        *keys, "n", r.alias("r"),
        F.when(F.col("n") > 2, F.sqrt(F.col("n") - 2) * _ratio(r, F.sqrt((F.lit(1.0) - r) * (F.lit(1.0) + r)), F.abs(r) == 1)).alias("t"),
    ).withColumn("p", t_pvalue("t", (F.col("n") - 2).cast("double")))
    return _with_reject(result, alpha)


def ttest_vs_overall(df: DataFrame, x: str, by: str, alpha: float = ALPHA) -> DataFrame:
    """One-sample t-test of each group's mean against the overall mean.

    The overall mean is one number, taken first; the groups need one aggregation.
    """
    data = normalize_missing(df.select(F.col(x).cast("double").alias("x"), by)).dropna()
    overall = data.agg(F.avg("x")).first()[0]
    mu = F.lit(overall).cast("double")
    groups = data.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"), F.avg("x").alias("mean"), F.stddev_samp("x").alias("sd"), (F.min("x") == F.max("x")).alias("constant")
    )
    gap = F.when(F.col("constant") & (F.abs(F.col("mean") - mu) <= F.abs(mu) * _ROUNDING), F.lit(0.0)).otherwise(F.col("mean") - mu)
    result = groups.select(
        by, "n", "mean", mu.alias("overall"),
        F.when(F.col("n") > 1, F.sqrt("n") * _ratio(gap, F.col("sd"), F.col("constant"))).alias("t"),
        (F.col("n") - 1).alias("dof"),
    ).withColumn("p", t_pvalue("t", F.col("dof").cast("double")))
    return _with_reject(result, alpha).withColumn(
        "direction", F.when(F.col("mean") > mu, "higher").when(F.col("mean") < mu, "lower").otherwise("equal")
    )
