"""Exact arithmetic on sums and counts, as SQL expression text.

Sums are kept as whole numbers (cents for money). Division then needs no
rounded intermediate: a mean is exact for a group of any size, where a mean of
doubles, or of decimals cut to a few digits, drifts on half cents. A sum beyond
the range of a 64-bit integer (4·10^16 in money) stops the job in ANSI mode.

Text rather than ``Column`` objects: one call builds a whole expression, so a
wide select costs the driver milliseconds.
"""

from __future__ import annotations

from decimal import Decimal


def cents(amount: str) -> str:
    """A decimal with two digits as a whole number of cents."""
    return f"CAST(({amount}) * 100 AS BIGINT)"


def from_units(units: str, digits: int) -> str:
    """A whole number of 10^-digits as a decimal."""
    unit = f"{Decimal(1).scaleb(-digits):f}BD"
    return f"CAST(CAST(({units}) AS DECIMAL(20, 0)) * {unit} AS DECIMAL(22, {digits}))"


def ratio(numerator: str, denominator: str, digits: int, scale: int = 0) -> str:
    """``numerator / denominator`` rounded half away from zero; NULL unless the denominator is positive.

    Both are whole numbers; ``scale`` says how many decimals the numerator
    stands for (2 for cents).
    """
    doubled = f"({numerator}) * {2 * 10 ** (digits - scale)}L"
    half = f"IF(({numerator}) < 0, -({denominator}), {denominator})"
    units = f"({doubled} + {half}) DIV (({denominator}) * 2L)"
    return f"CASE WHEN ({denominator}) > 0 THEN {from_units(units, digits)} END"


def percentage(part: str, whole: str, digits: int) -> str:
    """``100 · part / whole`` as an exact rounded decimal."""
    return ratio(f"({part}) * 100L", whole, digits)
