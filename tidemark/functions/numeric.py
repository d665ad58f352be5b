"""Arithmetic that keeps exact decimals and never divides by zero, as SQL text.

Text, because a plan of many columns is then handed to Spark in one piece: a call per operator
between Python and the JVM costs more than planning the whole query.
"""

from __future__ import annotations


def safe_divide(numerator: str, denominator: str) -> str:
    """NULL where the denominator is zero (ANSI mode would raise)."""
    return f"({numerator}) / nullif({denominator}, 0)"


def ratio_pct(numerator: str, denominator: str, places: int = 2) -> str:
    """A ratio of exact numbers as a percentage, rounded half away from zero.

    Decimal division gives up fraction digits when the operands are declared wide, and a
    quotient that was cut at 6 digits may round wrongly: pass operands of about 20 digits.
    """
    return f"round({safe_divide(numerator, denominator)} * 100, {places})"


def share_pct(part: str, whole: str, places: int = 2) -> str:
    """A count's share of a total count, in percent.

    Both counts become BIGINT: with INT operands the quotient keeps 6 digits only and would be
    rounded twice.
    """
    hundredfold = f"cast({part} AS BIGINT) * 100.0"
    return f"round({safe_divide(hundredfold, f'cast({whole} AS BIGINT)')}, {places})"


def sign_flag(value: str) -> str:
    """-1, 0 or 1 as an integer; NULL stays NULL."""
    return f"cast(signum({value}) AS INT)"
