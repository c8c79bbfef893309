"""Hand-made tables with written-out answers, and properties that hold for any data."""

import itertools
import math
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabwork.functions.bounded import join_group_rows, rows_if_small
from tabwork.functions.columns import as_categorical, drop_columns, one_hot
from tabwork.functions.missing import differs, excess_over, normalize_missing, not_true
from tabwork.functions.normal import normal_cdf, normal_ppf
from tabwork.functions import pvalues
from tabwork.functions.pvalues import chi2_tail_array, f_tail_array, t_quantile_array, t_two_sided_array
from tabwork.operators.bins import qcut
from tabwork.operators.cluster import _vectors, assign, compare_scaling, elbow, inertia, kmeans_fit, match_clusters
from tabwork.operators import missing as missing_operators
from tabwork.operators import scale as scale_operators
from tabwork.operators import split as split_operators
from tabwork.operators.missing import NullPlan, describe_missing, drop_sparse, missing_per_row
from tabwork.operators.plotdata import histogram, regression_band, scatter_sample, violin, violin_error
from tabwork.operators.quantile import approximate_quantiles, exact_quantiles, quantile_dict
from tabwork.operators.relational import latest_per_key
from tabwork.operators.scale import KINDS, Scaler
from tabwork.operators.split import _allocate, split, split_sizes
from tabwork.operators.stats import anova, chi2, expected_counts, pearson, ttest_ind, ttest_vs_overall
from tabwork.sources.tables import acquire_cached, jdbc_options, run_sql

NAN = float("nan")


@pytest.fixture(scope="module")
def tiny4(spark):
    return spark.createDataFrame([(1.0,), (2.0,), (3.0,), (4.0,)], "x double")


@pytest.fixture(scope="module")
def nan_mix(spark):
    return spark.createDataFrame([(1.0, None), (NAN, 2.0), (None, None), (5.0, 0.5)], "a double, b double")


def column(df, name):
    return [r[name] for r in df.collect()]


def test_unknown_values_in_filters(spark):
    df = spark.createDataFrame([(1, None), (2, 2.0), (3, None), (4, 0.5)], "k int, b double")
    assert sorted(column(df.where(not_true(F.col("b") > 1)), "k")) == [1, 3, 4]
    assert column(df.orderBy("k").select(excess_over(F.col("b"), 1.0).alias("e")), "e") == [None, 1.0, None, 0.0]
    pairs = spark.createDataFrame([(1.0, 1.0), (1.0, None), (None, None), (NAN, NAN)], "a double, b double")
    assert normalize_missing(pairs).where(differs(F.col("a"), F.col("b"))).count() == 3


def test_missing_counts_take_nan_and_null(nan_mix):
    rows = {r.attribute: (r.num_rows_missing, r.pct_rows_missing) for r in describe_missing(nan_mix).collect()}
    assert rows == {"a": (2, 50.0), "b": (2, 50.0)}
    assert {r.num_cols_missing: (r.num_rows, r.pct_col_missing) for r in missing_per_row(nan_mix).collect()} == {
        0: (1, 0.0), 1: (2, 0.5), 2: (1, 1.0)
    }


def test_drop_sparse_takes_columns_before_rows(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, None, None), (3, 3.0, 1.0), (4, NAN, None)], "k int, a double, b double")
    kept = drop_sparse(df)  # b has 1 of 4 values, a has 2: need 2; rows then need round(1.5) = 2 of 2
    assert kept.columns == ["k", "a"]
    assert sorted(column(kept, "k")) == [1, 3]


def test_quantiles_agree_on_both_paths(tiny4, spark):
    assert quantile_dict(tiny4, ["x"], [0.25, 0.5, 0.75]) == {"x": [1.75, 2.5, 3.25]}
    rng = np.random.default_rng(5)
    values = np.concatenate([rng.lognormal(0, 3, 3000), np.zeros(2000), -rng.random(500)])
    df = spark.createDataFrame([(float(v),) for v in values], "x double").repartition(7)
    qs = [0.0, 0.01, 0.33, 0.5, 0.77, 0.999, 1.0]
    for options in ({}, {"max_distinct": 0, "cell_rows": 100}, {"max_distinct": 0, "cell_rows": 10**9}, {"max_distinct": 0, "cell_rows": 10**9, "crowded_rows": 50}):
        assert np.allclose(quantile_dict(df, ["x"], qs, **options)["x"], np.quantile(values, qs), rtol=1e-12, atol=1e-12)
    many = [i / 199 for i in range(200)]
    assert np.allclose(quantile_dict(df, ["x"], many)["x"], np.quantile(values, many), rtol=1e-12, atol=1e-12)


def test_quantile_of_an_empty_column_is_missing(spark):
    df = spark.createDataFrame([(None, 1.0), (NAN, 2.0)], "a double, b double")
    assert quantile_dict(df, ["a", "b"], [0.5]) == {"a": None, "b": [1.5]}


def test_latest_per_key_ties(spark):
    df = spark.createDataFrame([(1, 1, "2020-01-01"), (1, 2, "2020-01-02"), (1, 3, "2020-01-02"), (2, 4, None)], "k int, id int, d string")
    assert sorted(column(latest_per_key(df, ["k"], "d"), "id")) == [2, 3]
    assert column(latest_per_key(df, ["k"], "d", "first", ["id"]), "id") == [3]


def test_latest_per_key_with_a_hot_key(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"), (F.col("id") % 50).alias("d"), "id")
    rows = [r.asDict() for r in df.collect()]
    newest = {}
    for r in rows:
        newest[r["k"]] = max(newest.get(r["k"], -1), r["d"])
    want = sorted(r["id"] for r in rows if r["d"] == newest[r["k"]])
    assert sorted(column(latest_per_key(df, ["k"], "d"), "id")) == want


def test_categories_and_indicators(spark):
    df = spark.createDataFrame([(6037.0, "a"), (None, "b"), (NAN, None)], "f double, s string")
    assert column(as_categorical(df, ["f"]), "f") == ["6037", None, None]
    assert [tuple(r) for r in one_hot(df, "s").select("b").collect()] == [(0,), (1,), (0,)]
    with pytest.raises(KeyError):
        drop_columns(df, ["nope"])
    with pytest.raises(ValueError):
        one_hot(df, "s", max_levels=1)


def test_null_plan_learns_from_train_only(spark):
    train = spark.createDataFrame([(1, 1, "x"), (2, 2, "y"), (4, 4, "y"), (None, None, None)], "mean_c int, med_c int, mode_c string")
    other = spark.createDataFrame([(None, None, None), (100, 100, "z")], "mean_c int, med_c int, mode_c string")
    model = NullPlan(plan={"mean_c": "mean", "med_c": "median", "mode_c": "mode"}).fit(train)
    first = model.transform(other).collect()[0]
    assert (round(first.mean_c, 6), first.med_c, first.mode_c) == (2.333333, 2.0, "y")
    with pytest.raises(ValueError):
        NullPlan(plan={"a": "guess"})


def test_qcut_bins(tiny4, spark):
    assert column(qcut(tiny4, "x", 4, "b").orderBy("x").select("b.bin"), "bin") == [0, 1, 2, 3]
    with pytest.raises(ValueError):
        qcut(spark.createDataFrame([(1.0,)] * 9 + [(2.0,)], "x double"), "x", 4, "b").collect()


@pytest.mark.parametrize("stratify", [None, "s"])
def test_split_is_exact_disjoint_and_repeatable(spark, stratify):
    df = spark.range(1003).select("id", F.when(F.col("id") < 400, "big").when(F.col("id") < 1000, "mid").otherwise("few").alias("s"))
    one = {r.id: r.split for r in split(df, "id", stratify=stratify).collect()}
    two = {r.id: r.split for r in split(df.repartition(9), "id", stratify=stratify).collect()}
    assert one == two and len(one) == 1003
    test, validate = split_sizes(1003, 0.1)
    assert (sum(v == "test" for v in one.values()), sum(v == "validate" for v in one.values())) == (test, validate) == (101, 181)
    if stratify:
        assert sum(one[i] == "test" for i in range(400)) in (40, 41)


def test_stratum_shares():
    assert _allocate(3, {"a": 5, "b": 5, "c": 2}) == {"a": 1, "b": 1, "c": 1}
    assert _allocate(4, {"a": 1, "b": 9}) == {"a": 0, "b": 4}


def test_scalers_on_constants_and_zero_iqr(spark, tiny4):
    const = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    for kind in ("minmax", "standard", "robust"):
        assert column(Scaler(kind=kind).fit(const).transform(const), "x") == [0.0, 0.0]
    flat = spark.createDataFrame([(1.0,)] + [(2.0,)] * 7 + [(9.0,)], "x double")
    assert sorted(column(Scaler(kind="robust").fit(flat).transform(flat), "x")) == [-1.0] + [0.0] * 7 + [7.0]
    assert round(Scaler(kind="standard").fit(tiny4).learned["x"][1], 6) == 1.118034


@pytest.mark.parametrize("kind", KINDS)
def test_scaler_inverse_gives_values_back(spark, kind):
    rng = np.random.default_rng(3)
    rows = [(i, float(v)) for i, v in enumerate(rng.gamma(2.0, 50.0, 300) - 20)] + [(900, None), (901, NAN)]
    df = spark.createDataFrame(rows, "k int, x double")
    model = Scaler(kind=kind, cols=["x"]).fit(df)
    back = {r.k: r.x for r in model.inverse_transform(model.transform(df)).collect()}
    assert back[900] is None and back[901] is None
    assert all(math.isclose(back[k], v, rel_tol=1e-6, abs_tol=1e-6) for k, v in rows[:300])


def test_quantile_transform_against_interpolation(spark):
    rng = np.random.default_rng(8)
    x = np.round(rng.normal(0, 1, 500), 1)  # many ties
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "k int, x double")
    got = [r.x for r in Scaler(kind="uniform", cols=["x"]).fit(df).transform(df).orderBy("k").collect()]
    refs = np.linspace(0, 1, 100)
    knots = np.quantile(x, refs)
    want = 0.5 * (np.interp(x, knots, refs) - np.interp(-x, -knots[::-1], -refs[::-1]))
    want[x == knots[-1]], want[x == knots[0]] = 1.0, 0.0
    assert np.allclose(got, want, atol=1e-12)


def test_yeo_johnson_power_beats_its_neighbours(spark):
    rng = np.random.default_rng(4)
    x = rng.gamma(1.5, 3.0, 400) - 1.0
    lam = Scaler(kind="yeojohnson").fit(spark.createDataFrame([(float(v),) for v in x], "x double")).learned["x"]

    def score(p):
        up = ((np.maximum(x, 0) + 1) ** p - 1) / p
        down = -((1 - np.minimum(x, 0)) ** (2 - p) - 1) / (2 - p)
        return -len(x) / 2 * math.log(np.var(np.where(x >= 0, up, down))) + (p - 1) * np.sum(np.sign(x) * np.log1p(np.abs(x)))

    grid = np.arange(-2.005, 2, 0.0001)
    assert abs(lam - grid[int(np.argmax([score(p) for p in grid]))]) < 2e-4


def test_normal_functions(spark):
    ps = [1e-7, 1e-4, 0.02, 0.3, 0.5, 0.8, 0.999, 1 - 1e-9]
    df = spark.createDataFrame([(p,) for p in ps], "p double").withColumn("z", normal_ppf("p")).withColumn("back", normal_cdf("z"))
    for r in df.collect():
        assert math.isclose(r.z, statistics.NormalDist().inv_cdf(r.p), rel_tol=1e-9, abs_tol=1e-12)
        assert math.isclose(r.back, r.p, rel_tol=1e-9)


def test_tail_probabilities():
    # Published table values, and limits for very many degrees of freedom.
    assert np.allclose(t_two_sided_array([2.228139, 12.706205], [10, 1]), 0.05, atol=1e-6)
    assert np.allclose(f_tail_array([3.238872], [3], [16]), 0.05, atol=1e-6)
    assert np.allclose(chi2_tail_array([3.841459, 18.307038], [1, 10]), 0.05, atol=1e-6)
    normal = math.erfc(3 / math.sqrt(2))
    assert np.allclose(t_two_sided_array([3.0] * 2, [1e12, 4e8]), normal, rtol=1e-6)
    below, above = t_two_sided_array([2.5, 2.5], [0.999e6, 1.001e6])
    assert abs(below - above) / above < 1e-6
    assert 0 < t_two_sided_array([30.0], [200])[0] < 1e-70
    assert np.isnan(t_two_sided_array([1.0], [0]))[0]


def test_t_squared_is_f_and_yates(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 2.0), ("a", 4.0), ("b", 3.0), ("b", 7.0), ("b", 5.0), ("b", None)], "g string, x double")
    t, f = ttest_ind(df, "x", "g", "a", "b").first(), anova(df, "x", "g").first()
    assert math.isclose(t.t ** 2, f.f, rel_tol=1e-12) and math.isclose(t.p, f.p, rel_tol=1e-9)
    cells = [("m", "y")] * 10 + [("m", "n")] * 20 + [("f", "y")] * 30 + [("f", "n")] * 5
    table = spark.createDataFrame(cells, "a string, b string")
    assert round(chi2(table, "a", "b", correction=False).first().chi2, 4) == 18.7262
    assert chi2(table, "a", "b").first().chi2 < 18.7262


def test_histogram_counts_every_value(spark, nan_mix):
    df = spark.range(100).select((F.col("id") % 7).cast("double").alias("x"))
    assert sum(column(histogram(df, "x", 20), "n")) == 100
    assert sum(column(histogram(nan_mix, "a", 4), "n")) == 2
    flat = histogram(df.select(F.lit(3.0).alias("x")), "x", 10).collect()
    assert (min(r.lo for r in flat), max(r.hi for r in flat)) == (2.5, 3.5)


def _lloyd(points, centres):
    for _ in range(200):
        label = np.argmin(((points[:, None] - centres[None]) ** 2).sum(-1), axis=1)
        centres = np.array([points[label == i].mean(0) for i in range(len(centres))])
    return centres, label


def test_kmeans_against_brute_force(spark):
    rng = np.random.default_rng(1)
    points = np.concatenate([rng.normal(c, 0.4, (60, 2)) for c in ((0, 0), (6, 1), (2, 7))])
    df = spark.createDataFrame([(float(a), float(b)) for a, b in points], "x double, y double")
    fit = kmeans_fit(df, ["x", "y"], 3, restarts=3)
    centres, label = _lloyd(points, points[[0, 60, 120]])
    want = ((points - centres[label]) ** 2).sum()
    assert np.allclose(sorted(fit.centroids), sorted(centres.tolist()), atol=1e-6)
    assert math.isclose(fit.inertia, want, rel_tol=1e-9)
    assert math.isclose(inertia(df, fit.centroids, ["x", "y"]).first()[0], want, rel_tol=1e-9)
    curve = {r.k: r.inertia for r in elbow(df, ["x", "y"], [1, 2, 3], restarts=2).collect()}
    assert math.isclose(curve[1], ((points - points.mean(0)) ** 2).sum(), rel_tol=1e-9)
    assert curve[1] > curve[2] > curve[3]


def test_scaling_changes_the_clusters(spark):
    # x parts the rows far apart, y parts them on a small range.
    rows = [(float(1000 * (i % 2) + i), float((i // 2) % 2)) for i in range(200)]
    df = spark.createDataFrame(rows, "x double, y double")
    means, pairs = compare_scaling(df, ["x", "y"], 2, restarts=2)
    raw = sorted(r["mean"] for r in means.where("variant = 'raw' and column = 'x'").collect())
    assert raw[0] < 200 and raw[1] > 1000
    assert sum(r.n for r in pairs.collect()) == 200


def test_cache_is_built_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(5)

    for fmt in ("parquet", "csv"):
        path = str(tmp_path / fmt)
        assert acquire_cached(spark, build, path, fmt).count() == acquire_cached(spark, build, path, fmt).count() == 5
    assert len(calls) == 2


def test_jdbc_options():
    plain = jdbc_options("jdbc:x", query="select 1", fetchsize=10)
    assert plain == {"url": "jdbc:x", "query": "select 1", "fetchsize": "10"}
    parallel = jdbc_options("jdbc:x", table="t", partition_column="id", lower=0, upper=9, partitions=3)
    assert parallel["numPartitions"] == "3" and parallel["dbtable"] == "t"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x")


def _f_tail_by_sums(f, d1, d2):
    """P(F > f) by trapezoids of the density in log f."""
    u = np.linspace(np.log(f), np.log(f) + 60 / np.sqrt(min(d1, d2)), 200_001)
    a, b = d2 / 2, d1 / 2
    density = np.exp(math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + b * (u + np.log(b / a)) - (a + b) * np.log1p(b / a * np.exp(u)))
    return float(np.trapezoid(density, u))


def test_f_tail_of_many_groups():
    for f, d1, d2 in [(1.001, 500_000, 1_500_000), (1.0005, 1_000_000, 5_000_000), (0.999, 100_000, 2_000_000), (1.03, 5_000, 1_100_000), (1.02, 1999, 58_000)]:
        assert abs(f_tail_array([f], [d1], [d2])[0] - _f_tail_by_sums(f, d1, d2)) < 1e-7
    # Both sides of the former limit, and the normal limit of t
    assert np.allclose(f_tail_array([1.01] * 2, [20_000] * 2, [999_990, 1_000_010]), _f_tail_by_sums(1.01, 20_000, 1e6), atol=1e-6)
    assert np.allclose(t_two_sided_array([1.9599639845], [1e12]), 0.05, atol=1e-9)
    assert np.allclose(f_tail_array([9.0], [1], [1e15]), math.erfc(3 / math.sqrt(2)), rtol=1e-9)


def test_p_values_without_convergence_are_missing(monkeypatch):
    monkeypatch.setattr(pvalues, "_MAX_STEPS", 3)
    assert np.isnan(f_tail_array([1.001], [500_000], [1_500_000])).all()
    assert np.isnan(chi2_tail_array([1e5 - 10, 1e5 + 10], [1e5, 1e5])).all()


def test_f_tail_of_a_million_groups():
    for f, d1, d2, p in [(1.001, 1e6, 1.2e6, 0.3008), (1.002, 1e5, 2e6, 0.3309), (1.001, 1e6, 9e6, None)]:
        found = f_tail_array([f], [d1], [d2])[0]
        assert abs(found - _f_tail_by_sums(f, d1, d2)) < 1e-6 and (p is None or abs(found - p) < 1e-4)


def _f_tail_by_integration(f, d1, d2):
    """P(F > f) from the beta density, by Gauss-Legendre rules over pieces that close in on its ends and its peak."""
    a, b = d2 / 2, d1 / 2
    x = d2 / (d2 + d1 * f)
    scale = math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b)
    peak, width = a / (a + b), math.sqrt(a * b / (a + b + 1)) / (a + b)
    near = [peak + k * width for k in np.linspace(-40, 40, 161)]
    ends = [10.0**-k for k in range(1, 17)]
    cuts = sorted({0.0, x, *(c for c in [*near, *ends, *(1 - e for e in ends)] if 0 < c < x)})
    at, weight = np.polynomial.legendre.leggauss(40)
    total = 0.0
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        # substitute away the singularity at 0: u = lo + (hi - lo) s^2
        s = (at + 1) / 2
        u = lo + (hi - lo) * s * s
        with np.errstate(all="ignore"):
            total += float(np.sum(weight * s * (hi - lo) * np.exp(scale + (a - 1) * np.log(u) + (b - 1) * np.log1p(-u))))
    return total


@pytest.mark.parametrize("f", [0.1, 0.5, 0.999, 1.0, 1.001, 2.0, 50.0])
def test_f_tail_on_a_grid(f):
    sizes = [*range(1, 11), 100, 1000, 10**6, 10**9]
    d1, d2 = (np.array(v, float).ravel() for v in np.meshgrid(sizes, sizes))
    got = f_tail_array(np.full(d1.shape, f), d1, d2)
    assert np.isfinite(got).all()
    for p, m, n in zip(got, d1, d2):
        if m == 2:
            want = math.exp(-n / 2 * math.log1p(2 * f / n))
        elif n == 2:
            want = -math.expm1(m / 2 * -math.log1p(2 / (m * f)))
        elif m == 1 and n == 1:
            want = 1 - 2 / math.pi * math.atan(math.sqrt(f))
        elif max(m, n) <= 1000:
            want = _f_tail_by_integration(f, m, n)
        else:  # the tails of a distribution add up
            want = 1.0 - f_tail_array(np.array([1 / f]), np.array([n]), np.array([m]))[0]
        assert p == pytest.approx(want, rel=1e-6, abs=1e-9), (f, m, n)


def test_tests_without_variance(spark):
    line = spark.createDataFrame([(float(i), 2.0 * i, -3.0 * i, 0.1) for i in range(4)], "x double, up double, down double, flat double")
    assert [pearson(line, "x", y).first()["p"] for y in ("up", "down", "flat")] == [0.0, 0.0, None]
    four = pearson(spark.createDataFrame([(1.0, 1.0), (2.0, 3.0), (3.0, 2.0), (4.0, 4.0)], "x double, y double"), "x", "y").first()
    assert four["r"] == pytest.approx(0.8) and four["p"] == pytest.approx(0.2)
    flat = spark.createDataFrame([("a", 0.1, 0.1), ("b", 0.7, 0.1)] * 30, "g string, x double, y double").repartition(7)
    assert ttest_ind(flat, "x", "g", "a", "b").first()["p"] == 0.0 and ttest_ind(flat, "y", "g", "a", "b").first()["p"] == 1.0
    assert anova(flat, "x", "g").first()["p"] == 0.0 and anova(flat, "y", "g").first()["p"] == 1.0
    assert [r["p"] for r in ttest_vs_overall(flat, "x", "g").collect()] == [0.0, 0.0]
    three = ttest_ind(spark.createDataFrame([("a", 1.0), ("a", 2.0), ("b", 2.0), ("b", 4.0)], "g string, x double"), "x", "g", "a", "b").first()
    assert three["dof"] == 2 and three["p"] == pytest.approx(1 - abs(three["t"]) / math.sqrt(2 + three["t"] ** 2))


def test_quantiles_of_a_group_packed_in_one_cell(spark):
    """One group holds 98 % of the rows, packed between two others' values, and half of it is one value."""
    rng = np.random.default_rng(6)
    packed = np.concatenate([0.5 + rng.random(4000) * 1e-6, np.full(4000, 0.5 + 1e-6)])
    groups = {"hot": packed, "few": rng.normal(0, 1e6, 100), None: np.arange(60.0), "one": np.array([7.0])}
    df = spark.createDataFrame([(k, float(v)) for k, values in groups.items() for v in values], "g string, x double").repartition(6)
    qs = [0.0, 0.1, 0.25, 0.4999, 0.5, 0.9, 1.0]
    for options in ({}, {"cell_rows": 50, "crowded_rows": 20}, {"cell_rows": 10, "crowded_rows": 10**9}):
        got = {r["g"]: (r["n"], r["q"]) for r in exact_quantiles(df, ["x"], qs, by=["g"], **options).collect()}
        assert set(got) == set(groups)
        for k, values in groups.items():
            assert got[k][0] == len(values) and np.allclose(got[k][1], np.quantile(values, qs), rtol=1e-12, atol=1e-12)
    whole = np.concatenate(list(groups.values()))
    assert np.allclose(quantile_dict(df, ["x"], qs, max_distinct=0, cell_rows=50, crowded_rows=20)["x"], np.quantile(whole, qs), rtol=1e-12, atol=1e-12)


def test_sketched_quantiles_keep_their_rank_and_merge_in_two_levels(spark):
    rng = np.random.default_rng(7)
    x = np.sort(rng.lognormal(0, 2, 60_000))
    df = spark.createDataFrame([(i % 3, float(v), None) for i, v in enumerate(x)], "g int, x double, nothing double").repartition(9)
    qs = [0.0, 0.01, 0.25, 0.5, 0.75, 0.999, 1.0]
    found = approximate_quantiles(df, ["x", "nothing"], qs)
    assert column(found, "column") == ["x"]
    for q, v in zip(qs, found.first()["q"]):
        assert np.searchsorted(x, v, "left") / len(x) - 0.002 <= q <= np.searchsorted(x, v, "right") / len(x) + 0.002
    assert approximate_quantiles(df, ["x"], qs, by=["g"]).count() == 3
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_salt" in plan and plan.index("kll_merge_agg_double") < plan.index("SinglePartition")
    assert "partial_kll_sketch" not in plan[: plan.index("SinglePartition")]


def test_nothing_wide_is_broadcast(spark):
    assert rows_if_small(spark.range(5), 4) is None and len(rows_if_small(spark.range(5), 5)) == 5
    texts = spark.createDataFrame([("a", 1), (None, 2)], "t string, k int")
    assert sorted(map(str, rows_if_small(texts))) == sorted(map(str, texts.collect()))
    assert rows_if_small(texts.unionByName(spark.createDataFrame([("x" * 300, 3)], texts.schema))) is None


def test_histogram_counts_by_its_edges(spark):
    values = [i / 100 for i in range(0, 1700, 17)] + [17.0, 16.66, 0.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for bins in (50, 7, 100):
        for r in histogram(df, "x", bins).collect():
            assert r["n"] == sum(r["lo"] <= v and (v < r["hi"] or (r["bin"] == bins - 1 and v <= r["hi"])) for v in values)


def test_violin_is_within_its_bound_of_the_direct_sum(spark):
    rng = np.random.default_rng(4)
    groups = {"hot": np.concatenate([rng.normal(0, 1, 3000), rng.normal(40, 0.01, 500), [400.0]]), "few": rng.random(5), "two": np.array([1.0, 5.0])}
    df = spark.createDataFrame([(k, float(v)) for k, values in groups.items() for v in values] + [("none", 1.0), ("none", 1.0), (None, 2.0)], "g string, x double").repartition(5)
    rows = violin(df, "x", "g", grid=60).collect()
    assert len(rows) == 3 * 60
    for r in rows:
        x = groups[r["g"]]
        h = len(x) ** -0.2 * x.std(ddof=1)
        peak = 1 / (h * math.sqrt(2 * math.pi))
        want = peak * np.mean(np.exp(-0.5 * ((r["x"] - x) / h) ** 2))
        assert abs(r["density"] - want) <= peak * (violin_error() + 1e-14)


def test_a_group_of_most_rows_meets_its_statistics_where_it_is(spark):
    many = spark.range(20_000).select(F.when(F.col("id") < 19_600, F.lit(-1)).otherwise(F.col("id")).alias("g"), (F.col("id") % 97).cast("double").alias("x")).repartition(8)
    stats = many.groupBy("g").agg(F.count("*").alias("n"), F.avg("x").alias("m"))
    joined = join_group_rows(many, stats, ["g"], max_rows=10)
    assert joined.count() == 20_000 and joined.where("g = -1 and n <> 19600").isEmpty()
    most = joined.groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert most <= 20_000 / 8 * 1.5
    want = {(r["g"], r["bin"]): r["n"] for r in histogram(many, "x", 5, by="g").collect()}
    assert want[(-1, 0)] == many.where("g = -1 and x < 19.2").count() and len(want) == 401 * 5


def test_scatter_ranks_few_rows(spark):
    df = spark.range(30_000).select("id", F.when(F.col("id") < 29_000, "hot").when(F.col("id") < 29_990, "mid").otherwise("few").alias("g"), F.lit(1).alias("_cut2"))
    got = scatter_sample(df, "id", [], 50, by="g")
    hashed = df.select("g", "id", F.md5(F.concat_ws("|", F.col("id").cast("string"), F.lit("123"))).alias("h")).collect()
    want = {(k, r["id"]) for k in ("hot", "mid", "few") for r in sorted((r for r in hashed if r["g"] == k), key=lambda r: (r["h"], r["id"]))[:50]}
    assert {(r["g"], r["id"]) for r in got.collect()} == want and len(want) == 110
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "_cut" in plan[plan.index("Window"):]  # the filter lies below the ranking


def test_band_of_a_small_sample(spark):
    x, y = np.array([1.0, 2, 4, 7, 9]), np.array([2.0, 1, 5, 6, 12])
    df = spark.createDataFrame([("a", float(u), float(v)) for u, v in zip(x, y)] + [("b", 1.0, 1.0), ("b", 2.0, 3.0), ("c", 1.0, 1.0), ("c", 1.0, 2.0)], "g string, x double, y double")
    rows = [r for r in regression_band(df, "x", "y", by="g", grid=9).collect()]
    assert {r["g"] for r in rows} == {"a", "b"} and all(r["lo"] is None for r in rows if r["g"] == "b")
    slope, intercept = np.polyfit(x, y, 1)
    sigma = math.sqrt(np.sum((y - intercept - slope * x) ** 2) / 3)
    for r in (r for r in rows if r["g"] == "a"):
        half = 3.182446305284263 * sigma * math.sqrt(1 / 5 + (r["x"] - x.mean()) ** 2 / np.sum((x - x.mean()) ** 2))
        assert (r["fit"], r["lo"], r["hi"]) == pytest.approx((intercept + slope * r["x"], intercept + slope * r["x"] - half, intercept + slope * r["x"] + half))


def test_t_quantile_inverts_the_tail():
    q = np.array([1e-10, 1e-3, 0.025, 0.3, 0.5, 0.7, 0.999, 1 - 1e-9])
    for dof in (1, 2, 3, 7, 1e3, 1e7):
        t = t_quantile_array(q, np.full(q.shape, dof))
        assert t_two_sided_array(t, np.full(q.shape, dof)) / 2 == pytest.approx(np.minimum(q, 1 - q), rel=1e-9) and (np.sign(t) == np.sign(q - 0.5)).all()
    assert np.isnan(t_quantile_array([0.5, 1.0, 0.9], [0, 3, np.nan])).all() and t_quantile_array(0.975, 2.0) == pytest.approx(4.302652729749464)


def test_chi2_of_many_levels(spark):
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 5000, 40_000), rng.integers(0, 3, 40_000)
    df = spark.createDataFrame([(int(x), int(y)) for x, y in zip(a, b)] + [(None, 1), (7, None)], "a int, b int").repartition(5)
    table = np.zeros((5000, 3))
    np.add.at(table, (a, b), 1)
    table = table[table.sum(1) > 0]
    expected = table.sum(1, keepdims=True) * table.sum(0) / table.sum()
    row = chi2(df, "a", "b").first()
    assert row["chi2"] == pytest.approx(((table - expected) ** 2 / expected).sum()) and row["dof"] == (len(table) - 1) * 2
    few = spark.createDataFrame([(0, 0)] * 9 + [(1, 1)] * 5, "a int, b int")
    gap = 9 - 81 / 14 - 0.5
    assert chi2(few, "a", "b").first()["chi2"] == pytest.approx(gap**2 * 14 * (1 / 9 + 1 / 5) ** 2)
    cells = {(r["a"], r["b"]): (r["observed"], r["expected"]) for r in expected_counts(few, "a", "b").collect()}
    assert cells[(0, 1)] == (0, pytest.approx(45 / 14)) and len(cells) == 4
    assert chi2(few.where("a = 0"), "a", "b").first()["p"] == 1.0
    with pytest.raises(ValueError):
        chi2(few.limit(0), "a", "b")


def test_modes_with_ties_and_without_frequent_values(spark, monkeypatch):
    rows = [(i % 3 if i < 600 else 5, "b" if i % 2 else "a", float(i), None, i % 7 == 0) for i in range(1000)] + [(None, None, NAN, None, None)] * 2000
    df = normalize_missing(spark.createDataFrame(rows, "i int, s string, x double, nothing string, t boolean").repartition(6))
    assert missing_operators._modes(df, ["i", "s", "x", "t"]) == {"i": 5, "s": "a", "x": 0.0, "t": False}
    assert missing_operators._modes(df, ["nothing"]) == {"nothing": None}
    asked = []
    real = missing_operators._mode_by_counting
    monkeypatch.setattr(missing_operators, "_mode_by_counting", lambda d, c: asked.append(c) or real(d, c))
    missing_operators._modes(df, ["i", "s", "t"])
    assert asked == []  # the sketch tells them from all others
    # With room for few values the bound doesn't separate, and the column is counted in full.
    monkeypatch.setattr(missing_operators, "TRACKED", 32)
    assert missing_operators._modes(df, ["x", "s"]) == {"x": 0.0, "s": "a"} and "x" in asked


def test_power_fit_ends_where_the_likelihood_is_flat(spark, monkeypatch):
    rng = np.random.default_rng(9)
    data = {"log": rng.lognormal(0, 1, 400), "left": -rng.lognormal(0, 1, 400), "both": rng.normal(0, 3, 400), "far": 1e6 + rng.random(400), "tiny": rng.random(400) * 1e-5}
    df = spark.createDataFrame([tuple(map(float, r)) for r in zip(*data.values())], ", ".join(f"{c} double" for c in data))
    calls, real = [], scale_operators._likelihood_slopes
    monkeypatch.setattr(scale_operators, "_likelihood_slopes", lambda *a: calls.append(1) or real(*a))
    narrow = ["log", "left", "both"]
    learned = Scaler(kind="yeojohnson", cols=narrow).fit(df).learned
    assert len(calls) <= 7

    def likelihood(x, lam):
        y = np.where(x >= 0, np.expm1(lam * np.log1p(np.abs(x))) / lam, -np.expm1((2 - lam) * np.log1p(np.abs(x))) / (2 - lam))
        return -len(x) / 2 * math.log(y.var()) + (lam - 1) * np.sum(np.sign(x) * np.log1p(np.abs(x)))

    for c, lam in learned.items():
        at = [likelihood(data[c], lam + d) for d in (-1e-3, 0.0, 1e-3)]
        assert at[1] >= max(at[0], at[2]) and abs(at[2] - at[0]) / 2e-3 < 1e-2 * abs(at[0] - 2 * at[1] + at[2]) / 1e-6
    # A power far outside the usual range is found too, not cut off at a border.
    assert abs(Scaler(kind="yeojohnson", cols=["tiny"]).fit(df).learned["tiny"]) > 64


def test_split_of_very_many_strata(spark):
    sizes = {i: 1 + i * i % 5 for i in range(20_000)}
    df = spark.range(20_000).select(F.col("id").alias("s"), F.explode(F.sequence(F.lit(1), F.expr("1 + id * id % 5"))).alias("i")).select(F.expr("s * 10 + i").alias("k"), F.when(F.col("s") > 0, F.col("s")).alias("s"))
    got = {(r["s"], r["split"]): r["n"] for r in split(df, "k", stratify="s").groupBy("s", "split").agg(F.count("*").alias("n")).collect()}
    usable = {s or None: c for s, c in sizes.items() if c > 1}
    test_n, validate_n = split_sizes(sum(sizes.values()), 0.1)
    test = _allocate(test_n, usable)
    validate = _allocate(validate_n, {s: c - test[s] for s, c in usable.items()})
    for s, c in sizes.items():
        key = s or None
        assert (got.get((key, "test"), 0), got.get((key, "validate"), 0)) == (test.get(key, 0), validate.get(key, 0)), s
    assert sum(got.values()) == sum(sizes.values())


def test_the_nth_value_by_ranges(spark, monkeypatch):
    monkeypatch.setattr(split_operators, "TOP_ROWS", 10)
    df = spark.createDataFrame([(None,)] + [(i * 37 % 501,) for i in range(500)], "s int").repartition(7)
    want = [None, *sorted(i * 37 % 501 for i in range(500))]
    assert [split_operators._nth(df, n) for n in (1, 2, 11, 250, 501)] == [want[n - 1] for n in (1, 2, 11, 250, 501)]


def test_split_refuses_keys_that_do_not_identify(spark):
    with pytest.raises(ValueError, match="without a value"):
        split(spark.createDataFrame([(None, 1)] * 20, "k int, x int"), "k")
    with pytest.raises(ValueError, match="does not identify"):
        split(spark.range(400).select((F.col("id") % 100).alias("k")), "k")


def test_indicators_never_replace_a_column(spark):
    df = spark.createDataFrame([("price", 1.5), ("size", 2.5)], "kind string, Price double")
    with pytest.raises(ValueError, match="price"):
        one_hot(df, "kind", drop_first=False)
    wide = one_hot(df, "kind", drop_first=False, prefix="is_")
    assert wide.columns == ["kind", "Price", "is_price", "is_size"] and column(wide.orderBy("Price"), "Price") == [1.5, 2.5]


def test_rows_with_missing_values_have_no_cluster(spark):
    df = spark.createDataFrame([(0.0, 0.0), (9.0, 9.0), (None, 0.0), (9.0, NAN)], "x double, y double")
    centres = [[0.0, 0.0], [10.0, 10.0]]
    assert column(assign(df, centres, ["x", "y"]), "cluster") == [0, 1, None, None]
    assert inertia(df, centres, ["x", "y"]).first()[0] == 2.0


def test_cluster_matching_against_every_assignment():
    rng = np.random.default_rng(2)
    for k in range(1, 7):
        for _ in range(30):
            table = rng.integers(0, 6, (k, k))
            match = match_clusters([(i, j, int(table[i, j])) for i in range(k) for j in range(k)], k)
            assert sorted(match) == list(range(k))
            assert sum(table[i, j] for i, j in enumerate(match)) == max(sum(table[i, p[i]] for i in range(k)) for p in itertools.permutations(range(k)))


def test_cache_replaces_a_write_that_was_broken_off(spark, tmp_path):
    path = tmp_path / "t"
    path.mkdir()
    (path / "part-0.parquet").write_text("rest of something")
    assert acquire_cached(spark, lambda: spark.range(4), str(path)).count() == 4
    with pytest.raises(ZeroDivisionError):
        acquire_cached(spark, lambda: 1 / 0, str(tmp_path / "u"))
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]


def test_cache_of_two_writers_is_the_first_ones(spark, tmp_path):
    path = str(tmp_path / "t")

    def slow():
        acquire_cached(spark, lambda: spark.range(3), path)  # another writer comes first
        return spark.range(100)

    assert acquire_cached(spark, slow, path).count() == 3
    assert sorted(p.name for p in tmp_path.iterdir()) == ["t"]


def test_sql_text_leaves_no_view(spark):
    assert run_sql(spark, "SELECT max(id) AS m FROM {left_behind}", {"left_behind": spark.range(4)}).first()["m"] == 3
    assert not spark.catalog.tableExists("left_behind")


def test_vectors_of_one_partition_are_dealt_over_the_cores(spark):
    """A table read as one partition was one task in each iteration of k-means."""
    df = spark.range(80_000).selectExpr("CAST(id AS DOUBLE) AS x", "CAST(id % 7 AS DOUBLE) AS y").coalesce(1)
    with _vectors(df, ["x", "y"]) as data:
        sizes = [r["n"] for r in data.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n")).collect()]
    cores = spark.sparkContext.defaultParallelism
    assert sum(sizes) == 80_000 and len(sizes) == cores and max(sizes) <= 2 * 80_000 / cores
