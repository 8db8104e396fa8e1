"""Numeric expressions: strict parsing, exact rounding, unit conversion."""

from __future__ import annotations

# Fixed value: decimal numbers as text, and the ways infinity may be spelled.
NUMBER_SHAPE = "^([0-9+.eE-]+|[+-]?(?i)inf(inity)?)$"


NUMBER_CHARACTERS = "0-9+.eE-"


def parse_number(c: str, when: str = "false") -> str:
    """Decimal text -> double, anything else -> null.

    A plain ``try_cast`` also takes ``1.0d``, hexadecimal floats and NaN; the shape only lets
    through digits, sign, point and exponent, for the cast to judge, and infinity. ``when`` is a
    condition under which the text is known to consist of those characters.
    """
    return f"if({when} OR {c} RLIKE '{NUMBER_SHAPE}', try_cast({c} AS double), NULL)"


def round_to_long(c: str) -> str:
    """Nearest integer, ties to even."""
    return f"cast(rint({c}) AS bigint)"


def exact(c: str) -> str:
    """A double as a decimal with ten places, so that sums and differences do not depend on their order.

    Values up to 1e18 in size fit; beyond that the cast is an error, not a wrong number.
    """
    return f"cast({c} AS decimal(28,10))"


def ratio(numerator: str, denominator: str, places: int) -> str:
    """``numerator / denominator`` rounded half away from zero, by integer arithmetic.

    Both are integers. Averages and percentages computed this way do not depend on the order of
    summation. Null where the denominator is zero.
    """
    unit = 10**places
    rounded = (
        f"((abs({numerator}) * {2 * unit} + ({denominator}))"
        f" div nullif(cast(2 * ({denominator}) AS bigint), 0L))"
    )
    return f"CASE WHEN ({numerator}) < 0 THEN -{rounded} ELSE {rounded} END / {unit}.0D"


def percent(hits: str, total: str, places: int = 2) -> str:
    """``100 * hits / total``, rounded."""
    return ratio(f"100 * {hits}", total, places)


def celsius(kelvin: str) -> str:
    """Kelvin -> Celsius with two decimals, subtracted as decimal rather than double."""
    return f"cast(round({exact(kelvin)} - 273.15, 2) AS decimal(14,2))"


def power_watts(torque_nm: str, rpm: str) -> str:
    """Mechanical power of a shaft."""
    return f"({torque_nm} * {rpm} * 2 * pi() / 60)"
