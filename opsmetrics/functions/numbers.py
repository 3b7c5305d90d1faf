"""Number parsing, rounding and shares. Every function is Column -> Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

INFINITY = float("inf")

DECIMAL_TEXT = r"\A\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*\z"
INFINITE_TEXT = r"(?i)\A\s*[+-]?inf(inity)?\s*\z"


def missing_if_nan(value: Column) -> Column:
    """NaN -> NULL. Spark orders NaN above every number, so a NaN that reaches
    a threshold would count as exceeding it."""
    return F.nanvl(value, F.lit(None).cast("double"))


def to_number(text: Column) -> Column:
    """Text -> double; anything that is not a decimal number or infinity
    becomes NULL, and so does a number beyond the double range.

    `try_cast` alone would also accept type suffixes (`5d`), hexadecimal
    floats (`0x1p3`) and NaN.
    """
    parsed = text.try_cast("double")
    decimal = text.rlike(DECIMAL_TEXT) & (F.abs(parsed) < INFINITY)
    return F.when(decimal | text.rlike(INFINITE_TEXT), parsed)


def round_half_even(value: Column, digits: int = 2) -> Column:
    """Round as numeric array libraries do: scale, round half to even, scale back."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def round_significant(value: Column, digits: int = 6) -> Column:
    """Round to significant decimal digits, half to even. Whole numbers stay."""
    exponent = F.floor(F.log10(F.abs(value)))
    scale = F.pow(F.lit(10.0), digits - 1 - exponent)
    return F.when(value == F.rint(value), value).otherwise(F.rint(value * scale) / scale)


def used_percent(used: Column, total: Column, infinite: str = "zero") -> Column:
    """Share of `total` in percent, two decimals, never missing.

    Division follows floating-point rules: x/0 is infinite and 0/0 missing.
    infinite="zero" turns an infinite share into 0 (memory), "keep" leaves it
    (disk). A missing share is 0 in both.
    """
    if infinite not in ("zero", "keep"):
        raise ValueError("infinite must be 'zero' or 'keep'")
    used, total = missing_if_nan(used), missing_if_nan(total)
    over_zero = F.lit(0.0) if infinite == "zero" else F.signum(used) * INFINITY
    share = (
        F.when((total == 0) & (used == 0), F.lit(None).cast("double"))
        .when(total == 0, over_zero)
        .otherwise(round_half_even(missing_if_nan(F.try_divide(used, total)) * 100))
    )
    if infinite == "zero":
        share = F.when(F.abs(share) == INFINITY, F.lit(0.0)).otherwise(share)
    return F.coalesce(share, F.lit(0.0))


def bytes_to_tb(byte_count: Column) -> Column:
    """Whole bytes -> TB (2**40 bytes) with two decimals, half to even on the exact
    value of the count as a double. Integer arithmetic, so no tie is misjudged;
    from 2**46 TB on, a double has no second decimal and stays as it is."""
    tb = byte_count.cast("double") / 2.0**40  # exact: a power of two
    small = F.when(F.abs(tb) < 2.0**46, tb)
    whole = F.floor(small)
    scaled = ((small - whole) * 2.0**40).cast("bigint") * 100
    hundredths = F.shiftright(scaled, 40)
    rest = scaled.bitwiseAND(F.lit(2**40 - 1))
    half = F.lit(2**39)
    odd = hundredths.bitwiseAND(F.lit(1)) == 1
    up = F.when((rest > half) | ((rest == half) & odd), F.lit(1)).otherwise(F.lit(0))
    exact = (whole * 100 + hundredths + up).cast("double") / 100.0
    return F.coalesce(exact, tb)
