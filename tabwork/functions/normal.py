"""Standard normal distribution as built-in column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rational approximation AS 241 (Wichura 1988), highest power first.
PPF_CENTRAL_NUM = [
    2.5090809287301226727e3, 3.3430575583588128105e4, 6.7265770927008700853e4, 4.5921953931549871457e4,
    1.3731693765509461125e4, 1.9715909503065514427e3, 1.3314166789178437745e2, 3.3871328727963666080e0,
]
PPF_CENTRAL_DEN = [
    5.2264952788528545610e3, 2.8729085735721942674e4, 3.9307895800092710610e4, 2.1213794301586595867e4,
    5.3941960214247511077e3, 6.8718700749205790830e2, 4.2313330701600911252e1, 1.0,
]
PPF_MIDDLE_NUM = [
    7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1, 1.27045825245236838258e0,
    3.64784832476320460504e0, 5.76949722146069140550e0, 4.63033784615654529590e0, 1.42343711074968357734e0,
]
PPF_MIDDLE_DEN = [
    1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2, 1.48103976427480074590e-1,
    6.89767334985100004550e-1, 1.67638483018380384940e0, 2.05319162663775882187e0, 1.0,
]
PPF_TAIL_NUM = [
    2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3, 2.65321895265761230930e-2,
    2.96560571828504891230e-1, 1.78482653991729133580e0, 5.46378491116411436990e0, 6.65790464350110377720e0,
]
PPF_TAIL_DEN = [
    2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5, 7.86869131145613259100e-4,
    1.48753612908506148525e-2, 1.36929880922735805310e-1, 5.99832206555887937690e-1, 1.0,
]
# Rational approximation of the normal CDF (Hart 1968; West 2005), highest power first.
CDF_NUM = [
    3.52624965998911e-2, 0.700383064443688, 6.37396220353165, 33.912866078383,
    112.079291497871, 221.213596169931, 220.206867912376,
]
CDF_DEN = [
    8.83883476483184e-2, 1.75566716318264, 16.064177579207, 86.7807322029461,
    296.564248779674, 637.333633378831, 793.826512519948, 440.413735824752,
]


def _poly(x: str, coefficients: list[float]) -> str:
    """Horner form as SQL text: one call to the JVM instead of one per operation."""
    return reduce(lambda acc, c: f"({acc} * {x} + {c!r}D)", coefficients[1:], f"{coefficients[0]!r}D")


def normal_ppf(name: str) -> Column:
    """Inverse normal CDF of a column with 0 < p < 1."""
    p = f"`{name}`"
    q = f"({p} - 0.5D)"
    r = f"sqrt(-ln(least({p}, 1.0D - {p})))"
    c, m, t = f"(0.180625D - {q} * {q})", f"({r} - 1.6D)", f"({r} - 5.0D)"
    return F.expr(f"""
        CASE WHEN abs({q}) <= 0.425D THEN {q} * {_poly(c, PPF_CENTRAL_NUM)} / {_poly(c, PPF_CENTRAL_DEN)}
             WHEN {r} <= 5.0D THEN signum({q}) * {_poly(m, PPF_MIDDLE_NUM)} / {_poly(m, PPF_MIDDLE_DEN)}
             ELSE signum({q}) * {_poly(t, PPF_TAIL_NUM)} / {_poly(t, PPF_TAIL_DEN)} END""")


def normal_cdf(name: str) -> Column:
    """Normal CDF for |x| below 7.07; beyond that the tail counts as 0."""
    x = f"`{name}`"
    a = f"abs({x})"
    tail = f"CASE WHEN {a} < 7.07D THEN exp(-{a} * {a} / 2.0D) * {_poly(a, CDF_NUM)} / {_poly(a, CDF_DEN)} WHEN {x} IS NOT NULL THEN 0.0D END"
    return F.expr(f"CASE WHEN {x} > 0 THEN 1.0D - ({tail}) ELSE {tail} END")
