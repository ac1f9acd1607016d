"""Distribution functions as SQL expression text.

Spark SQL has no normal quantile, normal tail or Student-t CDF. The formulas
below are written once as SQL text over an input expression and used on both
sides: ``F.expr(text)`` inside Spark plans (JVM side, codegen) and verbatim in
the SQL oracle. Only functions common to ANSI engines are used (sqrt, ln, exp,
atan, sin, cos, asin, pi).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rational approximation of the standard normal quantile
# (P. J. Acklam, relative error below 1.15e-9).
ACKLAM_A = [-3.969683028665376e+01, 2.209460984245205e+02, -2.759285104469687e+02,
            1.383577518672690e+02, -3.066479806614716e+01, 2.506628277459239e+00]
ACKLAM_B = [-5.447609879822406e+01, 1.615858368580409e+02, -1.556989798598866e+02,
            6.680131188771972e+01, -1.328068155288572e+01]
ACKLAM_C = [-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e+00,
            -2.549732539343734e+00, 4.374664141464968e+00, 2.938163982698783e+00]
ACKLAM_D = [7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e+00,
            3.754408661907416e+00]
ACKLAM_P_LOW = 0.02425

# Levels of the two expansions of the normal tail, enough for double precision on
# either side of ``TAIL_FROM``.
SERIES_LEVELS, FRACTION_LEVELS, TAIL_FROM = 60, 60, 3.0


def _horner(coefs: list[float], x: str) -> str:
    """coefs in descending powers."""
    out = repr(coefs[0])
    for c in coefs[1:]:
        out = f"({out} * {x} + {c!r})"
    return out


def _d(x: str) -> str:
    return f"CAST({x} AS DOUBLE)"


def norm_ppf_sql(p: str) -> str:
    """Standard normal quantile of ``p`` in (0, 1)."""
    p = _d(p)
    ql = f"sqrt(-2.0 * ln({p}))"
    qu = f"sqrt(-2.0 * ln(1.0 - {p}))"
    q = f"({p} - 0.5)"
    r = f"({q} * {q})"
    num_c = lambda v: _horner(ACKLAM_C, v)
    den_d = lambda v: _horner(ACKLAM_D + [1.0], v)
    central = f"({_horner(ACKLAM_A, r)} * {q} / {_horner(ACKLAM_B + [1.0], r)})"
    low = f"({num_c(ql)} / {den_d(ql)})"
    high = f"(-{num_c(qu)} / {den_d(qu)})"
    return (f"(CASE WHEN {p} < {ACKLAM_P_LOW!r} THEN {low} "
            f"WHEN {p} > {1 - ACKLAM_P_LOW!r} THEN {high} ELSE {central} END)")


def norm_sf_sql(z: str) -> str:
    """Upper tail 1 - Phi(z), to double precision.

    Up to ``TAIL_FROM`` the series Phi(z) - 1/2 = phi(z) (z + z^3/3 + z^5/15 + ...), nested;
    beyond it the continued fraction phi(z) / (z + 1/(z + 2/(z + ...))). Both are the
    classical expansions (Abramowitz & Stegun 26.2.11 and 26.2.14)."""
    z = _d(z)
    a = f"abs({z})"
    density = f"(exp(-0.5 * {z} * {z}) / sqrt(2.0 * pi()))"
    series = "1.0"
    for k in range(SERIES_LEVELS, 0, -1):
        series = f"(1.0 + {z} * {z} / {2 * k + 1}.0 * {series})"
    fraction = f"({a} + 0.0)"
    for k in range(FRACTION_LEVELS, 0, -1):
        fraction = f"({a} + {k}.0 / {fraction})"
    tail = f"({density} / {fraction})"
    return (f"(CASE WHEN {a} <= {TAIL_FROM!r} THEN 0.5 - {density} * {z} * {series} "
            f"WHEN {z} > 0.0 THEN {tail} ELSE 1.0 - {tail} END)")


def t_two_sided_p_sql(t: str, nu: int) -> str:
    """P(|T| >= |t|) for Student t with integer ``nu`` degrees of freedom.

    Finite trigonometric series (Abramowitz & Stegun 26.7.3 / 26.7.4) with
    theta = atan(|t| / sqrt(nu)).
    """
    th = f"atan(abs({_d(t)}) / sqrt({float(nu)!r}))"
    c, s = f"cos({th})", f"sin({th})"
    terms, coef = [], 1.0
    if nu % 2 == 1:
        if nu == 1:
            return f"(1.0 - 2.0 * {th} / pi())"
        for j in range((nu - 3) // 2 + 1):
            if j > 0:
                coef *= (2 * j) / (2 * j + 1)
            terms.append(f"{coef!r} * pow({c}, {2 * j + 1})")
        return f"(1.0 - 2.0 / pi() * ({th} + {s} * ({' + '.join(terms)})))"
    for j in range((nu - 2) // 2 + 1):
        if j > 0:
            coef *= (2 * j - 1) / (2 * j)
        terms.append(f"{coef!r} * pow({c}, {2 * j})")
    return f"(1.0 - {s} * ({' + '.join(terms)}))"


def t_two_sided_p(t: Column, nu: Column) -> Column:
    """Same series for a per-row integer ``nu`` (Spark higher-order aggregate)."""
    th = F.atan(F.abs(t.cast("double")) / F.sqrt(nu.cast("double")))
    c, s = F.cos(th), F.sin(th)
    c2 = c * c
    odd = (nu % 2) == 1
    last = F.when(odd, F.floor((nu - 3) / 2)).otherwise(F.floor((nu - 2) / 2)).cast("int")
    seq = F.when(last >= 1, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
    first = F.when(odd, c).otherwise(F.lit(1.0))

    def step(acc, j):
        jd = j.cast("double")
        ratio = F.when(odd, (2 * jd) / (2 * jd + 1)).otherwise((2 * jd - 1) / (2 * jd))
        term = acc["term"] * c2 * ratio
        return F.struct(term.alias("term"), (acc["total"] + term).alias("total"))

    series = F.aggregate(seq, F.struct(first.alias("term"), first.alias("total")), step)["total"]
    inside = F.when(nu == 1, F.lit(2.0) * th / F.pi()) \
              .when(odd, F.lit(2.0) / F.pi() * (th + s * series)) \
              .otherwise(s * series)
    return F.lit(1.0) - inside


def expr(sql_text: str) -> Column:
    return F.expr(sql_text)
