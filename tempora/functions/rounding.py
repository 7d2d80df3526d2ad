"""Rounding with the reference's semantics.

``round_half_even`` follows numpy: scale, round half to even on the binary
double (``rint``), unscale.  ``round_half_away`` scales the same way with
half away from zero; it is used to normalise outputs to 6 digits.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c):
    return F.col(c) if isinstance(c, str) else c


def round_half_even(c, digits: int) -> Column:
    """numpy-style ``round``.  The value is first snapped to 9 decimals so
    that aggregation-order noise cannot decide an exact decimal tie."""
    m = float(10 ** digits)
    return F.rint(round_half_away(c, 9) * F.lit(m)) / F.lit(m)


def round_half_away(c, digits: int) -> Column:
    c = _c(c)
    m = float(10 ** digits)
    return F.signum(c) * F.floor(F.abs(c) * F.lit(m) + F.lit(0.5)) / F.lit(m)


def output_round(c, max_digits: int = 6, sig_digits: int = 11) -> Column:
    """Normalise a double for cross-engine comparison: at most
    ``max_digits`` decimals and about ``sig_digits`` significant digits; the
    +0.51 offset moves the decision point off exact decimal ties (values
    with terminating expansions), so last-ulp noise cannot flip them.
    The SQL twin is :func:`output_round_sql`."""
    c = _c(c)
    d = F.least(F.lit(max_digits), F.greatest(F.lit(0), F.lit(sig_digits - 1)
                - F.floor(F.log10(F.abs(c) + F.lit(1e-300)))))
    m = F.pow(F.lit(10.0), d)
    return F.signum(c) * F.floor(F.abs(c) * m + F.lit(0.51)) / m


def output_round_sql(x: str, max_digits: int = 6, sig_digits: int = 11) -> str:
    d = f"least({max_digits}, greatest(0, {sig_digits - 1} - floor(log10(abs({x}) + 1e-300))))"
    return f"(sign({x}) * floor(abs({x}) * pow(10.0, {d}) + 0.51) / pow(10.0, {d}))"
