"""Statistics helpers.

Test statistics are built from per-arm sufficient statistics, and both distribution tails
are JVM expressions too: Spark SQL has no ``erf`` or incomplete beta function, so the normal
tail (a series and a continued fraction) and the Student-t tail (Stirling ``lgamma`` and the
incomplete-beta continued fraction) are written with built-in higher-order functions. They
run over the aggregated rows (one per experiment). The tests hold them against numeric integrals of the densities.
"""

from __future__ import annotations

import math
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_STD_NORMAL = NormalDist()


def normal_quantile(p: float) -> float:
    """inverse standard-normal CDF (driver-side constant; alpha is a parameter)."""
    return _STD_NORMAL.inv_cdf(p)


# Above this many degrees of freedom the first-order expansion is used: its error falls as
# 1/df^2 (about 5e-13 at 1e6), while the continued fraction loses digits near t = 2.
LARGE_DF = 1e6


ERF_SERIES_TERMS = 80
ERFC_FRACTION_TERMS = 100


def erfc_sql(x: str) -> str:
    """Complementary error function of ``x >= 0`` as SQL text (one parse instead of one JVM call per operation).

    Below 2: ``1 - erf(x)`` with the positive-term series
    ``erf(x) = 2/sqrt(pi) * exp(-x^2) * sum_n x (2x^2)^n / (1*3*...*(2n+1))``.
    From 2 up: Laplace's continued fraction
    ``erfc(x) = exp(-x^2)/sqrt(pi) / (x + (1/2)/(x + 1/(x + (3/2)/(x + ...))))``,
    evaluated from its tail. Agrees with ``math.erfc`` to about 1e-15 (tests/test_experiment.py).
    """
    x = f"({x})"
    term = f"_e.term * 2.0D * {x} * {x} / (2 * _n + 1)"
    series = (
        f"aggregate(sequence(1, {ERF_SERIES_TERMS}), named_struct('term', {x}, 'total', {x}),"
        f" (_e, _n) -> named_struct('term', {term}, 'total', _e.total + {term})).total"
    )
    fraction = f"aggregate(sequence({ERFC_FRACTION_TERMS}, 1, -1), {x}, (_f, _k) -> {x} + (_k / 2.0D) / _f)"
    return (
        f"CASE WHEN {x} < 2.0D THEN 1.0D - {2.0 / math.sqrt(math.pi)!r}D * exp(-{x} * {x}) * {series}"
        f" ELSE exp(-{x} * {x}) / {math.sqrt(math.pi)!r}D / {fraction} END"
    )


def normal_two_sided_p(z: str) -> Column:
    """two-sided normal tail ``erfc(|z|/sqrt 2)`` of the column ``z``; NULL z gives NULL."""
    return F.expr(erfc_sql(f"abs(`{z}`) / {math.sqrt(2.0)!r}D"))


# at most 4,000 continued-fraction terms, two half-steps each; evaluation stops at convergence, and a fraction that has
# not converged gives NULL, never a doubtful number
CF_HALF_STEPS = 8000

_LGAMMA_SQL = (
    # ln Gamma(z), z > 0: shift to w = z + k >= 20, then Stirling's series (error < 1e-16)
    "(({w} - 0.5D) * ln({w}) - {w} + {half_log_2pi}D + 1.0D / (12.0D * {w}) - 1.0D / (360.0D * pow({w}, 3))"
    " + 1.0D / (1260.0D * pow({w}, 5)) - 1.0D / (1680.0D * pow({w}, 7)) + 1.0D / (1188.0D * pow({w}, 9))"
    " - aggregate(sequence(0, 19), 0.0D, (_lg, _j) -> _lg + IF(_j < {k}, ln({z} + _j), 0.0D)))"
)


def _lgamma_sql(z: str) -> str:
    k = f"greatest(0.0D, 20.0D - floor({z}))"
    return _LGAMMA_SQL.format(w=f"({z} + {k})", k=k, z=z, half_log_2pi=repr(0.5 * math.log(2.0 * math.pi)))


def with_student_t_two_sided_p(df: DataFrame, t: str, dof: str, out: str) -> DataFrame:
    """add ``out`` = two-sided Student-t tail ``P(|T_dof| > |t|)``, JVM-side.

    The regularized incomplete beta ``I_x(dof/2, 1/2)`` at ``x = dof/(dof+t^2)`` (its exact
    complement is used where x is close to 1) by the modified-Lentz
    continued fraction, written as SQL higher-order functions and staged over a few
    projections of the one-row-per-experiment table; above ``LARGE_DF`` the first-order
    expansion around the normal tail. NULL/NaN input or ``dof <= 0`` gives NULL.
    """
    a, x, y = "_tt_a", "_tt_x", "_tt_y"
    # intermediate math runs on sanitized inputs (ANSI arithmetic raises on a zero divisor);
    # the final CASE returns NULL for the invalid rows from the original columns
    sdof = f"IF({dof} IS NULL OR isnan({dof}) OR {dof} <= 0, 1.0D, {dof})"
    st = f"IF({t} IS NULL OR isnan({t}), 0.0D, {t})"
    staged = df.selectExpr(
        "*",
        f"{sdof} / 2.0D AS _tt_a",
        f"{sdof} / ({sdof} + {st} * {st}) AS _tt_x",
        f"{st} * {st} / ({sdof} + {st} * {st}) AS _tt_y",
    ).selectExpr(
        "*",
        f"NOT ({x} < ({a} + 1.0D) / ({a} + 2.5D)) AS _tt_mirror",
        f"{a} * IF({y} < 0.5D, log1p(-{y}), ln({x})) + 0.5D * IF({x} < 0.5D, log1p(-{x}), ln({y}))"
        f" - (IF({a} >= 100.0D,"
        f" {math.lgamma(0.5)!r}D - (0.5D * ln({a}) - 1.0D / (8.0D * {a}) + 1.0D / (192.0D * pow({a}, 3))"
        f" - 1.0D / (640.0D * pow({a}, 5))),"
        f" {_lgamma_sql(a)} + {math.lgamma(0.5)!r}D - {_lgamma_sql(f'({a} + 0.5D)')})) AS _tt_log_front",
    ).selectExpr(
        "*",
        "IF(_tt_mirror, 0.5D, _tt_a) AS _tt_pa",
        "IF(_tt_mirror, _tt_a, 0.5D) AS _tt_pb",
        "IF(_tt_mirror, _tt_y, _tt_x) AS _tt_px",
    )
    guard = "IF(abs({v}) < 1e-300D, 1e-300D, {v})"
    # half-step i: m = (i + 1) div 2; odd i uses the even-term coefficient, even i the odd one
    m = "((_i + 1) div 2)"
    aa = (
        f"IF(_i % 2 = 1,"
        f" {m} * (_tt_pb - {m}) * _tt_px / ((_tt_pa - 1.0D + 2.0D * {m}) * (_tt_pa + 2.0D * {m})),"
        f" -(_tt_pa + {m}) * (_tt_pa + _tt_pb + {m}) * _tt_px / ((_tt_pa + 2.0D * {m}) * (_tt_pa + 1.0D + 2.0D * {m})))"
    )
    d_new = "(1.0D / " + guard.format(v=f"(1.0D + {aa} * _s.d)") + ")"
    c_new = guard.format(v=f"(1.0D + {aa} / _s.c)")
    d0 = "(1.0D / " + guard.format(v="(1.0D - (_tt_pa + _tt_pb) * _tt_px / (_tt_pa + 1.0D))") + ")"
    cf = (
        f"aggregate(sequence(1, {CF_HALF_STEPS}),"
        f" named_struct('c', 1.0D, 'd', {d0}, 'h', {d0}, 'done', false),"
        f" (_s, _i) -> IF(_s.done, _s, named_struct('c', {c_new}, 'd', {d_new},"
        f" 'h', _s.h * {d_new} * {c_new},"
        f" 'done', _i % 2 = 0 AND abs({d_new} * {c_new} - 1.0D) < 1e-15D)))"
    )
    expansion_t = f"abs({t})"
    tail = (
        f"CASE WHEN {t} IS NULL OR {dof} IS NULL OR isnan({t}) OR isnan({dof}) OR {dof} <= 0 THEN CAST(NULL AS DOUBLE)"
        f" WHEN {t} = 0 THEN 1.0D"
        f" WHEN {dof} >= {LARGE_DF!r}D THEN _tt_erfc + 2.0D * exp(-0.5D * {expansion_t} * {expansion_t})"
        f" / {math.sqrt(2.0 * math.pi)!r}D * (pow({expansion_t}, 3) + {expansion_t}) / (4.0D * {dof})"
        f" WHEN NOT _tt_cf.done THEN CAST(NULL AS DOUBLE)"
        f" WHEN _tt_mirror THEN 1.0D - exp(_tt_log_front) * _tt_cf.h / _tt_pa"
        f" ELSE exp(_tt_log_front) * _tt_cf.h / _tt_pa END"
    )
    with_cf = staged.selectExpr("*", f"{cf} AS _tt_cf", f"{erfc_sql(f'abs({t}) / {math.sqrt(2.0)!r}D')} AS _tt_erfc")
    return with_cf.selectExpr("*", f"{tail} AS `{out}`").drop(
        "_tt_a", "_tt_x", "_tt_y", "_tt_mirror", "_tt_log_front", "_tt_pa", "_tt_pb", "_tt_px", "_tt_cf", "_tt_erfc"
    )
