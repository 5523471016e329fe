"""Scalar column functions (X1-X16). All are built-in Spark expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INF = float("inf")

# Fixed values (must equal the reference): health bands of the scoring page,
# drift thresholds, PSI floor share, mean-shift epsilon, range tolerance.
HEALTH_CRITICAL_BELOW = 50
HEALTH_WARNING_BELOW = 100
PSI_DRIFT = 0.7
MEAN_SHIFT_DRIFT = 3.0
MISSING_RATE_DRIFT = 0.2
LIFE_LENGTH_DRIFT = 0.5
PSI_FLOOR = 0.0001
MEAN_SHIFT_EPS = 1e-8
RANGE_TOLERANCE = 0.2


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def cap(x, threshold) -> Column:
    """``min(x, threshold)``."""
    return F.least(_c(x), F.lit(threshold))


def psi_share(share) -> Column:
    """X2 helper: zero share -> 0.0001."""
    return F.when(_c(share) == 0, F.lit(PSI_FLOOR)).otherwise(_c(share))


def psi_term(ref_share, cur_share) -> Column:
    """``(c - r) * ln(c / r)`` on floored shares."""
    r, c = psi_share(ref_share), psi_share(cur_share)
    return (c - r) * F.ln(c / r)


def normalised_diff(a, b, sd) -> Column:
    """``abs(a - b) / (sd + 1e-8)``."""
    return F.abs(_c(a) - _c(b)) / (_c(sd) + F.lit(MEAN_SHIFT_EPS))


def relative_diff(a, b) -> Column:
    """``abs(a - b) / b`` (null when b = 0, ANSI-safe)."""
    return F.try_divide(F.abs(_c(a) - _c(b)), _c(b))


def tolerance_bounds(ref_min, ref_max, tol: float = RANGE_TOLERANCE,
                     relative_to: str = "value") -> tuple[Column, Column]:
    """``(min * (1 - tol), max * (1 + tol))``.

    With a negative bound the band shrinks (reference behaviour, default).
    ``relative_to='width'`` widens by ``tol * (max - min)`` instead.
    """
    lo, hi = _c(ref_min), _c(ref_max)
    if relative_to == "width":
        w = hi - lo
        return lo - w * tol, hi + w * tol
    return lo * (1 - tol), hi * (1 + tol)


def rul_score(err) -> Column:
    """Asymmetric score ``exp(e/10)-1`` for e >= 0 else ``exp(-e/13)-1``."""
    e = _c(err)
    return F.when(e >= 0, F.exp(e / 10.0) - 1).otherwise(F.exp(-e / 13.0) - 1)


def percentage_error(abs_error, truth) -> Column:
    """``abs_error / truth * 100``, +inf when truth is 0 (null stays null)."""
    t = _c(truth)
    return F.when(t == 0, F.lit(INF)).otherwise(_c(abs_error) / t * 100.0)


def accuracy_from_mape(mape) -> Column:
    """``(1 - mape) * 100``, 0 when mape is infinite."""
    m = _c(mape)
    return F.when(m == F.lit(INF), F.lit(0.0)).otherwise((F.lit(1.0) - m) * 100.0)


def finite_or_zero(x) -> Column:
    """+-inf -> null -> 0."""
    v = _c(x)
    return F.coalesce(F.when(F.abs(v) == F.lit(INF), F.lit(None)).otherwise(v), F.lit(0.0))


def round_half_even(x, digits: int = 1) -> Column:
    """Python ``round`` on floats is half-even."""
    return F.bround(_c(x), digits)


def health_status(rul) -> Column:
    """X11: < 50 Critical, < 100 Warning, else Good."""
    r = _c(rul)
    return (F.when(r < HEALTH_CRITICAL_BELOW, F.lit("Critical"))
             .when(r < HEALTH_WARNING_BELOW, F.lit("Warning"))
             .otherwise(F.lit("Good")))


def feature_drift_flag(psi, mean_shift) -> Column:
    """PSI > 0.7 or mean shift > 3. An undefined (NaN) value is no drift, although Spark sorts NaN highest."""
    def above(x: Column, bound: float) -> Column:
        return (x > bound) & ~F.isnan(x)

    return above(_c(psi), PSI_DRIFT) | above(_c(mean_shift), MEAN_SHIFT_DRIFT)


def upper_cap(x, bound: float = 1.0) -> Column:
    """``min(x, 1.0)``."""
    return F.least(_c(x), F.lit(bound))


def lower_floor(x, bound: float = 0.0) -> Column:
    """``max(0, x)``."""
    return F.greatest(_c(x), F.lit(bound))


def elapsed_seconds(start, end) -> Column:
    """Seconds between two timestamps as double."""
    return (F.unix_micros(_c(end)) - F.unix_micros(_c(start))) / 1e6
