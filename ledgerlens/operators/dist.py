"""Distribution tails and quantiles for turning statistics into p-values.

Scalar functions only (applied on the driver to a handful of aggregated
numbers): normal, Student t, F, chi-square and the studentized range.
Implemented from the standard definitions — regularized incomplete beta by
continued fraction, regularized incomplete gamma by series / continued
fraction, the studentized range by numerical integration.
"""

from __future__ import annotations

import math

import numpy as np

_EPS = 1e-15
_TINY = 1e-300
#: Terms after which a series or fraction counts as not converging; near its mean a tail
#: needs about ten times the root of its degrees of freedom.
_TERMS = 20_000_000


class NotConverged(ArithmeticError):
    """A series or fraction that did not settle."""


def _stirling_rest(a: float) -> float:
    """lgamma(a) minus Stirling's (a - 1/2) log a - a + log(2 pi) / 2, without cancellation for large ``a``."""
    if a >= 15.0:
        b = a * a
        return (1 / 12 - (1 / 360 - (1 / 1260 - (1 / 1680 - 1 / (1188 * b)) / b) / b) / b) / a
    return math.lgamma(a) - ((a - 0.5) * math.log(a) - a + 0.5 * math.log(2 * math.pi))


def _log1p_less(x: float) -> float:
    """log(1 + x) - x, without cancellation for small ``x``."""
    if abs(x) > 0.1:
        return math.log1p(x) - x
    total, power, k = 0.0, x, 1
    while True:
        power, k = -power * x, k + 1
        term = power / k
        total += term
        if abs(term) <= abs(total) * 1e-17:
            return total


def _log_gamma_weight(a: float, x: float) -> float:
    """a log x - x - lgamma(a)."""
    return a * _log1p_less((x - a) / a) + 0.5 * math.log(a / (2 * math.pi)) - _stirling_rest(a)


def _log_beta(a: float, b: float) -> float:
    """log B(a, b), without cancellation for large arguments."""
    p, q = min(a, b), max(a, b)
    if q < 15.0:
        return math.lgamma(p) + math.lgamma(q) - math.lgamma(p + q)
    rest = _stirling_rest(q) - _stirling_rest(p + q)
    if p < 15.0:
        return math.lgamma(p) + rest + p - p * math.log(p + q) + (q - 0.5) * math.log1p(-p / (p + q))
    return (0.5 * math.log(2 * math.pi / q) + _stirling_rest(p) + rest + (p - 0.5) * math.log(p / (p + q))
            + q * math.log1p(-p / (p + q)))


def norm_cdf(x: float) -> float:
    return 0.5 * math.erfc(-x / math.sqrt(2.0))


def norm_sf(x: float) -> float:
    return 0.5 * math.erfc(x / math.sqrt(2.0))


def norm_pdf(x: float) -> float:
    return math.exp(-0.5 * x * x) / math.sqrt(2.0 * math.pi)


def norm_ppf(p: float) -> float:
    """Inverse normal CDF: rational start (Acklam) refined by Newton steps."""
    if not 0.0 < p < 1.0:
        if p == 0.0:
            return -math.inf
        if p == 1.0:
            return math.inf
        raise ValueError("p must be in [0, 1]")
    a = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
         1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00]
    b = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
         6.680131188771972e+01, -1.328068155288572e+01]
    c = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
         -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00]
    d = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00, 3.754408661907416e+00]
    lo = 0.02425
    if p < lo:
        q = math.sqrt(-2 * math.log(p))
        x = (((((c[0] * q + c[1]) * q + c[2]) * q + c[3]) * q + c[4]) * q + c[5]) / \
            ((((d[0] * q + d[1]) * q + d[2]) * q + d[3]) * q + 1)
    elif p > 1 - lo:
        q = math.sqrt(-2 * math.log(1 - p))
        x = -(((((c[0] * q + c[1]) * q + c[2]) * q + c[3]) * q + c[4]) * q + c[5]) / \
            ((((d[0] * q + d[1]) * q + d[2]) * q + d[3]) * q + 1)
    else:
        q = p - 0.5
        r = q * q
        x = (((((a[0] * r + a[1]) * r + a[2]) * r + a[3]) * r + a[4]) * r + a[5]) * q / \
            (((((b[0] * r + b[1]) * r + b[2]) * r + b[3]) * r + b[4]) * r + 1)
    for _ in range(3):
        e = norm_cdf(x) - p
        x -= e / max(norm_pdf(x), _TINY)
    return x


def _betacf(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta (modified Lentz)."""
    qab, qap, qam = a + b, a + 1.0, a - 1.0
    c, d = 1.0, 1.0 - qab * x / qap
    d = 1.0 / (d if abs(d) > _TINY else _TINY)
    h = d
    for m in range(1, _TERMS):
        m2 = 2 * m
        aa = m * (b - m) * x / ((qam + m2) * (a + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = 1.0 + aa / c
        c = c if abs(c) > _TINY else _TINY
        h *= d * c
        aa = -(a + m) * (qab + m) * x / ((a + m2) * (qap + m2))
        d = 1.0 + aa * d
        d = 1.0 / (d if abs(d) > _TINY else _TINY)
        c = 1.0 + aa / c
        c = c if abs(c) > _TINY else _TINY
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < _EPS:
            return h
    raise NotConverged(f"incomplete beta of {a}, {b} at {x}")


def betainc(a: float, b: float, x: float, y: float | None = None) -> float:
    """Regularized incomplete beta I_x(a, b); ``y`` is 1 - x where the caller knows it better."""
    y = 1.0 - x if y is None else y
    if x <= 0.0:
        return 0.0
    if y <= 0.0:
        return 1.0
    lbt = ((a * math.log(x) if x < 0.5 else a * math.log1p(-y)) + (b * math.log(y) if y < 0.5 else b * math.log1p(-x))
           - _log_beta(a, b))
    if x < (a + 1.0) / (a + b + 2.0):
        return math.exp(lbt) * _betacf(a, b, x) / a
    return 1.0 - math.exp(lbt) * _betacf(b, a, y) / b


def t_sf(t: float, df: float) -> float:
    """P(T > t) for Student t with ``df`` degrees of freedom."""
    if math.isinf(df):
        return norm_sf(t)
    if df > 1000.0:
        # Hill's normalising series (Algorithm 395): the beta's fraction cancels for many degrees of freedom.
        a = df - 0.5
        b = 48.0 * a * a
        y = a * math.log1p(t * t / df)
        z = (((((-0.4 * y - 3.3) * y - 24.0) * y - 85.5) / (0.8 * y * y + 100.0 + b) + y + 3.0) / b + 1.0) * math.sqrt(y)
        tail = norm_sf(z)
    else:
        tail = 0.5 * betainc(df / 2.0, 0.5, df / (df + t * t), t * t / (df + t * t))
    return tail if t >= 0 else 1.0 - tail


def t_two_sided(t: float, df: float) -> float:
    return min(1.0, 2.0 * t_sf(abs(t), df))


def t_ppf(p: float, df: float) -> float:
    """Quantile of Student t by bisection on the CDF (monotone, robust)."""
    if math.isinf(df):
        return norm_ppf(p)
    if not 0.0 < p < 1.0:
        return norm_ppf(p)
    lo, hi = -1.0, 1.0
    while t_sf(lo, df) < 1.0 - p:
        lo *= 2.0
    while t_sf(hi, df) > 1.0 - p:
        hi *= 2.0
    while hi - lo > 1e-12 * max(1.0, abs(lo)):
        mid = 0.5 * (lo + hi)
        if mid in (lo, hi):
            break
        if t_sf(mid, df) > 1.0 - p:
            lo = mid
        else:
            hi = mid
    return 0.5 * (lo + hi)


def f_sf(f: float, d1: float, d2: float) -> float:
    """P(F > f) for the F distribution."""
    if f <= 0:
        return 1.0
    whole = d2 + d1 * f
    return betainc(d2 / 2.0, d1 / 2.0, d2 / whole, d1 * f / whole)


def gammainc_upper(a: float, x: float) -> float:
    """Regularized upper incomplete gamma Q(a, x)."""
    if x <= 0:
        return 1.0
    if x < a + 1.0:
        term = s = 1.0 / a
        ap = a
        for _ in range(_TERMS):
            ap += 1.0
            term *= x / ap
            s += term
            if abs(term) < abs(s) * _EPS:
                return 1.0 - s * math.exp(_log_gamma_weight(a, x))
        raise NotConverged(f"incomplete gamma of {a} at {x}")
    b = x + 1.0 - a
    c = 1.0 / _TINY
    d = 1.0 / b
    h = d
    for i in range(1, _TERMS):
        an = -i * (i - a)
        b += 2.0
        d = an * d + b
        d = d if abs(d) > _TINY else _TINY
        c = b + an / c
        c = c if abs(c) > _TINY else _TINY
        d = 1.0 / d
        delta = d * c
        h *= delta
        if abs(delta - 1.0) < _EPS:
            return math.exp(_log_gamma_weight(a, x)) * h
    raise NotConverged(f"incomplete gamma of {a} at {x}")


def chi2_sf(x: float, df: float) -> float:
    return gammainc_upper(df / 2.0, x / 2.0)


def ptukey(q: float, k: int, df: float) -> float:
    """CDF of the studentized range of ``k`` means with ``df`` error degrees
    of freedom: the infinite-df range CDF integrated over the distribution
    of the sample standard deviation ratio."""
    if q <= 0:
        return 0.0
    z = np.linspace(-8.5, 8.5, 1201)
    phi = np.exp(-0.5 * z * z) / math.sqrt(2 * math.pi)
    cdf = 0.5 * np.vectorize(math.erfc)(-z / math.sqrt(2.0))

    def range_cdf_inf(qs: np.ndarray) -> np.ndarray:
        shifted = 0.5 * np.vectorize(math.erfc)(-(z[None, :] - qs[:, None]) / math.sqrt(2.0))
        inner = np.clip(cdf[None, :] - shifted, 0.0, 1.0) ** (k - 1)
        return k * np.trapezoid(phi[None, :] * inner, z, axis=1)

    if math.isinf(df):
        return float(range_cdf_inf(np.array([q]))[0])
    # density of s = sqrt(chi2_df / df), over twelve standard deviations around its mean
    width = 12.0 / math.sqrt(df)
    s = np.linspace(max(1e-6, 1.0 - width), 1.0 + width, 801)
    half = df / 2.0
    dens = np.array([math.exp(_log_gamma_weight(half, half * x * x)) * 2.0 / x for x in s])
    vals = range_cdf_inf(q * s)
    return float(min(1.0, np.trapezoid(dens * vals, s)))


def tukey_sf(q: float, k: int, df: float) -> float:
    return max(0.0, 1.0 - ptukey(q, k, df))
