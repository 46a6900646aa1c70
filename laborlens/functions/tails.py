"""Distribution tails as JVM expressions.

Spark ships Apache Commons Math; its static special functions are called
through ``reflect`` so p-values are computed in the JVM next to the data,
with no Python worker involved.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_BETA = "org.apache.commons.math3.special.Beta"
_ERF = "org.apache.commons.math3.special.Erf"


def _d(x) -> Column:
    return (F.col(x) if isinstance(x, str) else x).cast("double")


def regularized_beta(x, a, b) -> Column:
    return F.call_function("reflect", F.lit(_BETA), F.lit("regularizedBeta"), _d(x), _d(a), _d(b)).cast("double")


def t_sf2(t, df) -> Column:
    """Two-sided p-value of Student's t: I_{df/(df+t^2)}(df/2, 1/2)."""
    t, df = _d(t), _d(df)
    x = df / (df + t * t)
    return F.when(t.isNull() | df.isNull() | (df <= 0), F.lit(None).cast("double")).otherwise(
        regularized_beta(x, df / 2, F.lit(0.5)))


def f_sf(f, d1, d2) -> Column:
    """Upper tail of the F distribution: I_{d2/(d2+d1 F)}(d2/2, d1/2)."""
    f, d1, d2 = _d(f), _d(d1), _d(d2)
    x = d2 / (d2 + d1 * f)
    return F.when(f.isNull() | (d1 <= 0) | (d2 <= 0), F.lit(None).cast("double")).otherwise(
        regularized_beta(x, d2 / 2, d1 / 2))


def _poly(x: Column, coefficients) -> Column:
    out = F.lit(float(coefficients[0]))
    for c in coefficients[1:]:
        out = out * x + F.lit(float(c))
    return out


# fixed values: Wichura's rational approximations of the normal quantile
# (algorithm AS 241), numerator and denominator, highest power first
PPF_MIDDLE = ((2.5090809287301226727e+3, 3.3430575583588128105e+4, 6.7265770927008700853e+4, 4.5921953931549871457e+4,
               1.3731693765509461125e+4, 1.9715909503065514427e+3, 1.3314166789178437745e+2, 3.3871328727963666080e+0),
              (5.2264952788528545610e+3, 2.8729085735721942674e+4, 3.9307895800092710610e+4, 2.1213794301586595867e+4,
               5.3941960214247511077e+3, 6.8718700749205790830e+2, 4.2313330701600911252e+1, 1.0))
PPF_TAIL = ((7.74545014278341407640e-4, 2.27238449892691845833e-2, 2.41780725177450611770e-1, 1.27045825245236838258e+0,
             3.64784832476320460504e+0, 5.76949722146069140550e+0, 4.63033784615654529590e+0, 1.42343711074968357734e+0),
            (1.05075007164441684324e-9, 5.47593808499534494600e-4, 1.51986665636164571966e-2, 1.48103976427480074590e-1,
             6.89767334985100004550e-1, 1.67638483018380384940e+0, 2.05319162663775882187e+0, 1.0))
PPF_FAR = ((2.01033439929228813265e-7, 2.71155556874348757815e-5, 1.24266094738807843860e-3, 2.65321895265761230930e-2,
            2.96560571828504891230e-1, 1.78482653991729133580e+0, 5.46378491116411436990e+0, 6.65790464350110377720e+0),
           (2.04426310338993978564e-15, 1.42151175831644588870e-7, 1.84631831751005468180e-5, 7.86869131145613259100e-4,
            1.48753612908506148525e-2, 1.36929880922735805310e-1, 5.99832206555887937690e-1, 1.0))


def norm_ppf(p) -> Column:
    """Standard normal quantile by rational approximations (full double
    precision) in plain column arithmetic, so it is compiled with the rest
    of the row's work.  0 and 1 give the infinities."""
    p = _d(p)
    q = p - 0.5
    low = F.least(p, F.lit(1.0) - p)
    r = F.sqrt(-F.ln(F.when(low > 0, low)))

    def ratio(x: Column, tables) -> Column:
        return _poly(x, tables[0]) / _poly(x, tables[1])

    tail = F.when(r <= 5.0, ratio(r - 1.6, PPF_TAIL)).otherwise(ratio(r - 5.0, PPF_FAR))
    inf = F.lit(float("inf"))
    return (F.when(p <= 0, -inf).when(p >= 1, inf).when(F.abs(q) <= 0.425, q * ratio(F.lit(0.180625) - q * q, PPF_MIDDLE))
            .when(q < 0, -tail).otherwise(tail))


def norm_cdf(z) -> Column:
    """Standard normal distribution function; for summary rows and distinct
    values (it goes through ``reflect``)."""
    z = _d(z)
    erf = F.call_function("reflect", F.lit(_ERF), F.lit("erf"), F.coalesce(z, F.lit(0.0)) / (2.0 ** 0.5)).cast("double")
    return F.when(z.isNotNull(), F.lit(0.5) * (F.lit(1.0) + erf))


def kolmogorov_sf(x, terms: int = 100) -> Column:
    """Upper tail of the Kolmogorov distribution: 2 sum (-1)^(k-1) exp(-2 k^2 x^2)."""
    x = _d(x)
    total = F.lit(0.0)
    for k in range(1, terms + 1):
        total = total + F.lit(2.0 if k % 2 else -2.0) * F.exp(F.lit(-2.0 * k * k) * x * x)
    return F.when(x < 0.2, F.lit(1.0)).otherwise(F.least(F.greatest(total, F.lit(0.0)), F.lit(1.0)))


def chi2_sf_2df(x) -> Column:
    """Upper tail of chi-square with 2 degrees of freedom: exp(-x/2)."""
    return F.exp(-_d(x) / 2)
