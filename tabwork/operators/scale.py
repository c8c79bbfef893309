"""Scalers fitted on the training rows, with inverses.

The parameters of a fitted scaler are a few numbers per column (at most 1000
knots for the quantile kinds), so transforming is a narrow projection of built-in
expressions with no join and no Python.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import Bucketizer
from pyspark.ml.param import Param, Params
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabwork.functions.columns import numeric_columns
from tabwork.functions.missing import normalize_missing
from tabwork.functions.normal import normal_cdf, normal_ppf
from tabwork.operators.quantile import quantile_dict

KINDS = ("minmax", "standard", "robust", "uniform", "quantile", "normal", "yeojohnson")
QUANTILE_COUNT = {"uniform": 100, "quantile": 1000, "normal": 1000}
ZERO = 10 * 2.220446049250313e-16
# Fixed values of the normal kind: distance to the end knots that counts as the end, and the clip bound it gives.
END_MARGIN = 1e-7
NORMAL_CLIP = 5.199337582605575
#: Newton steps of the power fit: how far one goes while no bracket is known, when they have settled, and how many there may be.
LAMBDA_STRIDE = 2.0
LAMBDA_CLOSE = 1e-7
LAMBDA_STEPS = 60
SERIES_TERMS = 12


class Scaler(Estimator):
    """``Scaler(kind=..., cols=...).fit(train)``; ``cols`` defaults to every numeric column."""

    kind = Param(Params._dummy(), "kind", "one of " + ", ".join(KINDS))
    cols = Param(Params._dummy(), "cols", "columns to scale")

    @keyword_only
    def __init__(self, *, kind: str, cols: Sequence[str] | None = None):
        super().__init__()
        if kind not in KINDS:
            raise ValueError(f"kind must be one of {KINDS}")
        self._set(kind=kind, **({} if cols is None else {"cols": list(cols)}))

    def _fit(self, dataset: DataFrame) -> ScalerModel:
        kind = self.getOrDefault(self.kind)
        cols = self.getOrDefault(self.cols) if self.isSet(self.cols) else numeric_columns(dataset)
        train = normalize_missing(dataset.select(*[F.col(f"`{c}`").cast("double").alias(c) for c in cols]))
        fit = {
            "minmax": _fit_minmax, "standard": _fit_standard, "robust": _fit_robust, "yeojohnson": _fit_lambda,
        }.get(kind)
        params = fit(train, cols) if fit else _fit_knots(train, cols, QUANTILE_COUNT[kind])
        missing = [c for c in cols if params.get(c) is None]
        if missing:
            raise ValueError(f"no value to learn from in {missing}")
        return ScalerModel(kind, cols, params)


class ScalerModel(Model):
    """Fitted scaler. Replaces its columns in place and leaves all others (keys, labels) alone."""

    def __init__(self, kind: str, cols: Sequence[str], params: dict):
        super().__init__()
        self.scaler_kind, self.scaled_cols, self.learned = kind, list(cols), params

    def _transform(self, dataset: DataFrame) -> DataFrame:
        df = self._as_double(dataset)
        kind, params = self.scaler_kind, self.learned
        if kind in ("minmax", "standard", "robust"):
            return df.withColumns({
                c: (F.col(f"`{c}`") - F.lit(params[c][0])) / F.lit(params[c][1]) for c in self.scaled_cols
            })
        if kind == "yeojohnson":
            return df.withColumns({c: yeo_johnson(F.col(f"`{c}`"), params[c]) for c in self.scaled_cols})
        return self._to_ranks(df)

    def inverse_transform(self, dataset: DataFrame) -> DataFrame:
        df = self._as_double(dataset)
        kind, params = self.scaler_kind, self.learned
        if kind in ("minmax", "standard", "robust"):
            return df.withColumns({
                c: F.col(f"`{c}`") * F.lit(params[c][1]) + F.lit(params[c][0]) for c in self.scaled_cols
            })
        if kind == "yeojohnson":
            return df.withColumns({c: yeo_johnson_inverse(F.col(f"`{c}`"), params[c]) for c in self.scaled_cols})
        return self._from_ranks(df)

    def _as_double(self, dataset):
        return normalize_missing(
            dataset.withColumns({c: F.col(f"`{c}`").cast("double") for c in self.scaled_cols}), self.scaled_cols
        )

    def _to_ranks(self, df):
        """Place each value between the distinct knots (binary search in Bucketizer), then interpolate.

        Written as a chain of projections, each naming what the next one uses several
        times: a single nested expression would repeat the knot lookups many times.
        """
        inf, cols = float("inf"), self.scaled_cols
        # The search in Bucketizer tells -0.0 from 0.0; adding zero makes them one.
        tables = [_distinct_knots([v + 0.0 for v in self.learned[c]]) for c in cols]
        df = df.withColumns({c: F.col(f"`{c}`") + F.lit(0.0) for c in cols})
        cells = [f"_cell{i}" for i in range(len(cols))]
        df = Bucketizer(
            splitsArray=[[-inf, *t[0], inf] for t in tables], inputCols=cols, outputCols=cells, handleInvalid="keep",
        ).transform(df)
        looked_up = {}
        for i, (values, first, final) in enumerate(tables):
            at = F.col(cells[i]).cast("int") - 1
            looked_up.update({
                f"_v{i}": F.get(_doubles(values), at), f"_w{i}": F.get(_doubles(values), at + 1),
                f"_a{i}": F.get(_doubles(first), at), f"_b{i}": F.get(_doubles(final), at),
                f"_c{i}": F.get(_doubles(first), at + 1),
            })
        df = df.withColumns(looked_up)
        normal = self.scaler_kind == "normal"
        df = df.withColumns({
            c: _rank_of(F.col(f"`{c}`"), i, tables[i][0][0], tables[i][0][-1], normal) for i, c in enumerate(cols)
        })
        if normal:
            clip = F.lit(NORMAL_CLIP)
            df = df.withColumns({
                c: F.when(F.col(f"`{c}`") <= 0, -clip).when(F.col(f"`{c}`") >= 1, clip).when(
                    F.col(f"`{c}`").isNotNull(), F.greatest(F.least(normal_ppf(c), clip), -clip)
                )
                for c in cols
            })
        return df.drop(*cells, *looked_up)

    def _from_ranks(self, df):
        """Ranks back to values: the knots sit at equal rank steps, so the place is arithmetic."""
        cols, normal = self.scaled_cols, self.scaler_kind == "normal"
        if normal:
            df = df.withColumns({c: normal_cdf(c) for c in cols})
        top = {c: float(len(self.learned[c]) - 1) for c in cols}
        spots = {f"_i{i}": F.floor(F.col(f"`{c}`") * F.lit(top[c])).cast("int") for i, c in enumerate(cols)}
        df = df.withColumns(spots)
        around = {}
        for i, c in enumerate(cols):
            knots = _doubles(self.learned[c])
            around[f"_v{i}"], around[f"_w{i}"] = F.get(knots, F.col(f"_i{i}")), F.get(knots, F.col(f"_i{i}") + 1)
        df = df.withColumns(around)
        margin = END_MARGIN if normal else 0.0
        back = {}
        for i, c in enumerate(cols):
            u, low = F.col(f"`{c}`"), F.col(f"_v{i}")
            inside = low + (u * F.lit(top[c]) - F.col(f"_i{i}")) * (F.col(f"_w{i}") - low)
            back[c] = F.when(u <= margin, F.lit(float(self.learned[c][0]))).when(
                u >= 1.0 - margin, F.lit(float(self.learned[c][-1]))
            ).otherwise(inside)
        return df.withColumns(back).drop(*spots, *around)


# ---- fitting -----------------------------------------------------------------

def _divisor(width: float) -> float:
    return 1.0 if width < ZERO else width


def _fit_minmax(train, cols):
    row = train.agg(*[f(F.col(f"`{c}`")) for c in cols for f in (F.min, F.max)]).first()
    return {
        c: None if row[2 * i] is None else (row[2 * i], _divisor(row[2 * i + 1] - row[2 * i]))
        for i, c in enumerate(cols)
    }


def _fit_standard(train, cols):
    row = train.agg(*[f(F.col(f"`{c}`")) for c in cols for f in (F.avg, F.stddev_pop)]).first()
    return {
        c: None if row[2 * i] is None else (row[2 * i], _divisor(row[2 * i + 1])) for i, c in enumerate(cols)
    }


def _fit_robust(train, cols):
    found = quantile_dict(train, cols, [0.25, 0.5, 0.75])
    return {c: None if q is None else (q[1], _divisor(q[2] - q[0])) for c, q in found.items()}


def _fit_knots(train, cols, count):
    k = max(2, min(count, train.count()))
    return quantile_dict(train, cols, [i / (k - 1) for i in range(k)])


def _fit_lambda(train, cols):
    """Maximum-likelihood power per column, by Newton steps on the slope of the profile likelihood.

    A step is one job for all columns still open: it sums the transformed values and their first two derivatives by
    the power. Powers that showed a slope of either sign make a bracket that steps stay inside; until both are known a step is at most ``LAMBDA_STRIDE``,
    which doubles every time.
    """
    logs = train.select(*[
        (F.signum(F.col(f"`{c}`")) * F.log1p(F.abs(F.col(f"`{c}`")))).alias(c) for c in cols
    ])
    base = logs.agg(*[
        a for i, c in enumerate(cols) for a in (
            F.count(F.col(f"`{c}`")).alias(f"n{i}"), (F.min(F.col(f"`{c}`")) < F.max(F.col(f"`{c}`"))).alias(f"v{i}"), F.avg(F.col(f"`{c}`")).alias(f"s{i}"),
        )
    ]).first()
    mean_log = {c: base[f"s{i}"] for i, c in enumerate(cols)}
    result = {c: None if base[f"n{i}"] == 0 else 1.0 for i, c in enumerate(cols)}
    at = {c: 1.0 for i, c in enumerate(cols) if base[f"v{i}"]}
    bracket = {c: (-math.inf, math.inf) for c in at}
    for attempt in range(LAMBDA_STEPS):
        stride = LAMBDA_STRIDE * 2**attempt
        if not at:
            return result
        following = {}
        for c, (slope, bend) in _likelihood_slopes(logs, at, mean_log).items():
            lam, (low, high) = at[c], bracket[c]
            if slope is None:  # beyond what doubles hold: half the way back
                low, high = (low, lam) if lam > 1 else (lam, high)
            else:
                low, high = (lam, high) if slope > 0 else (low, lam)
            step = -slope / bend if slope is not None and bend < 0 else math.inf
            new = lam + step
            if math.isinf(low) or math.isinf(high):
                new = min(max(new, lam - stride), lam + stride) if math.isfinite(step) else lam + math.copysign(stride, slope)
            elif not low < new < high:
                new = (low + high) / 2
            bracket[c] = (low, high)
            if abs(new - lam) <= LAMBDA_CLOSE * (1 + abs(lam)):
                result[c] = new
            else:
                following[c] = new
        at = following
    raise ValueError(f"the likelihood of {sorted(at)} has no maximum within reach")


def _likelihood_slopes(logs, at, mean_log):
    """First and second derivative by the power of the profile log-likelihood per row, {column: (slope, bend)}; None where values overflow."""
    def parts(c, lam):
        s = F.col(f"`{c}`")
        size = F.abs(s)
        power = F.when(s >= 0, F.lit(lam)).otherwise(F.lit(2.0 - lam))
        value, first, second = _growth(power * size)
        # For negative values the power counts down as lambda grows, and the value itself is negative.
        return F.signum(s) * size * value, size * size * first, F.signum(s) * size * size * size * second

    names = list(at)
    columns = [p.alias(f"{part}{i}") for i, c in enumerate(names) for p, part in zip(parts(c, at[c]), "yde")]
    row = logs.select(*columns).agg(*[
        a for i in range(len(names)) for a in (
            F.var_pop(f"y{i}").alias(f"v{i}"), F.covar_pop(f"y{i}", f"d{i}").alias(f"c{i}"), F.var_pop(f"d{i}").alias(f"w{i}"), F.covar_pop(f"y{i}", f"e{i}").alias(f"b{i}"))
    ]).first()
    found = {}
    for i, c in enumerate(names):
        v, cross, w, b = (row[f"{t}{i}"] for t in "vcwb")
        good = all(x is not None and math.isfinite(x) for x in (v, cross, w, b)) and v > 0
        rise = 2 * cross / v if good else 0.0
        found[c] = (mean_log[c] - rise / 2, -((2 * (w + b)) / v - rise * rise) / 2) if good else (None, 0.0)
    return found


def _growth(z: Column) -> tuple[Column, Column, Column]:
    """(e^z - 1) / z and its first two derivatives; by their series near 0, where the closed forms lose digits."""
    near = F.abs(z) < 0.5
    series = [reduce(lambda total, k: total * z + 1.0 / (math.factorial(k) * (k + d)), range(SERIES_TERMS - 1, -1, -1), F.lit(0.0)) for d in (1, 2, 3)]
    e, safe = F.exp(z), F.when(~near, z)
    closed = [F.expm1(z) / safe, (e * (z - 1) + 1) / (safe * safe), (e * (z * z - 2 * z + 2) - 2) / (safe * safe * safe)]
    return tuple(F.when(near, s).otherwise(c) for s, c in zip(series, closed))


# ---- expressions -------------------------------------------------------------

def yeo_johnson(x: Column, lam: float) -> Column:
    up = F.log1p(x) if abs(lam) < ZERO else (F.pow(x + 1.0, F.lit(lam)) - 1.0) / F.lit(lam)
    mirror = 2.0 - lam
    down = -F.log1p(-x) if abs(mirror) < ZERO else -(F.pow(F.lit(1.0) - x, F.lit(mirror)) - 1.0) / F.lit(mirror)
    return F.when(x >= 0, up).otherwise(down)


def yeo_johnson_inverse(y: Column, lam: float) -> Column:
    up = F.expm1(y) if abs(lam) < ZERO else F.pow(y * lam + 1.0, F.lit(1.0 / lam)) - 1.0
    mirror = 2.0 - lam
    down = -F.expm1(-y) if abs(mirror) < ZERO else F.lit(1.0) - F.pow(F.lit(1.0) - y * mirror, F.lit(1.0 / mirror))
    return F.when(y >= 0, up).otherwise(down)


def _doubles(values):
    """A constant array; written as text, since a thousand separate literals plan slowly."""
    return F.expr("array(" + ", ".join(f"{float(v)!r}D" for v in values) + ")")


def _distinct_knots(knots):
    """Distinct knots with the first and last reference rank of each."""
    top = len(knots) - 1
    values, first, final = [], [], []
    for i, v in enumerate(knots):
        if values and v <= values[-1]:
            final[-1] = i / top
        else:
            values.append(v)
            first.append(i / top)
            final.append(i / top)
    return values, first, final


def _rank_of(x, i, lowest, highest, normal):
    """Reference rank of ``x``: tied knots give the middle rank, the ends clamp to 0 and 1."""
    here, ahead = F.col(f"_v{i}"), F.col(f"_w{i}")
    first, final, following = F.col(f"_a{i}"), F.col(f"_b{i}"), F.col(f"_c{i}")
    between = final + (x - here) / F.nullif(ahead - here, F.lit(0.0)) * (following - final)
    inside = F.when(x == here, (first + final) / 2.0).otherwise(between)
    margin = F.lit(END_MARGIN if normal else 0.0)
    at_low = x - margin < F.lit(lowest) if normal else x <= F.lit(lowest)
    at_high = x + margin > F.lit(highest) if normal else x >= F.lit(highest)
    return F.when(at_low, F.lit(0.0)).when(at_high, F.lit(1.0)).otherwise(inside)


# ---- three-part form ---------------------------------------------------------

def scale_splits(kind: str, train: DataFrame, validate: DataFrame, test: DataFrame, keep: Sequence[str] = ()):
    """Fit on train, apply to all three: ``(model, train, validate, test)``.

    Text columns are dropped, except the key columns named in ``keep``.
    """
    cols = numeric_columns(train, exclude=keep)
    model = Scaler(kind=kind, cols=cols).fit(train)
    return (model, *[model.transform(part.select(*keep, *cols)) for part in (train, validate, test)])


def unscale_splits(model: ScalerModel, train: DataFrame, validate: DataFrame, test: DataFrame):
    return tuple(model.inverse_transform(part) for part in (train, validate, test))
