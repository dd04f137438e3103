"""Decimal text and rounding of the exact binary value of a double, half to even (SF12, SF13, SF15, SF21, AG12, AG14-AG16).

A double times a power of ten is rounded once more, and it is that which makes ties out of what are none. The product's own error is a
double, too, and is found without loss from the halves of the factors; so a tie of the product is told from a true one.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Splits a double of 53 bits into halves of 26.
SPLITTER = float((1 << 27) + 1)
#: Products below this have a unit of at most one half, so that rounding to whole numbers means something.
WHOLE = float(1 << 52)


def _halves(x: float) -> tuple[float, float]:
    high = x * SPLITTER - (x * SPLITTER - x)
    return high, x - high


def _scaled(c: Column, places: int) -> Column:
    """c * 10**places, rounded half to even on the exact product; c is below 2**52 / 10**places."""
    scale = float(10**places)
    b_high, b_low = _halves(scale)
    product, split = c * scale, c * SPLITTER
    high = split - (split - c)
    low = c - high
    error = ((high * b_high - product) + high * b_low + low * b_high) + low * b_low
    near = F.rint(product)
    off = product - near
    seeming = near + F.when((off > 0) & (error > 0), 1.0).when((off < 0) & (error < 0), -1.0).otherwise(0.0)
    return F.when(F.abs(off) < 0.5, near).otherwise(seeming)


def once(c: Column, f) -> Column:
    """f of a column that is computed once, however often f names it."""
    return F.get(F.transform(F.array(c), lambda v: f(v)), F.lit(0))


def fixed_text(c: Column, places: int = 6) -> Column:
    """c with so many places, as correctly rounded formatting gives it. Beyond 2**52 / 10**places it is format_string's text."""
    return once(c.cast("double"), lambda v: number_text(v, places))


def number_text(c: Column, places: int = 6) -> Column:
    """fixed_text of what is named often: a column or the variable of a lambda."""
    one = 10**places
    whole = F.abs(_scaled(c, places)).cast("long")
    sign = F.when((c < 0) | ((c == 0) & (c.cast("string") == "-0.0")), "-").otherwise("")
    text = F.concat(sign, F.floor(whole / one).cast("long").cast("string"), F.lit("."), F.substring((whole % one + one).cast("string"), 2, places))
    if places == 0:
        text = F.concat(sign, whole.cast("string"))
    special = F.when(F.isnan(c), "nan").when(c == float("inf"), "inf").when(c == float("-inf"), "-inf")
    return F.coalesce(special, F.when(F.abs(c) < WHOLE / one, text).when(c.isNotNull(), F.format_string(f"%.{places}f", c)))


def unit_text(c: Column, places: int = 6) -> Column:
    """fixed_text of numbers within 0 and 1, which need neither sign nor other cases."""
    return _units_text(_scaled(c, places), places)


def _units_text(n: Column, places: int) -> Column:
    """Whole units of the last place as text: a decimal of so many places."""
    return (n.cast("long").cast(f"decimal({places + 1},0)") * F.lit(Decimal(1).scaleb(-places))).cast("string")


def rounded(c: Column, places: int) -> Column:
    """c rounded half to even to so many places, on its exact value: what a correctly rounding language gives."""
    return once(c.cast("double"), lambda v: F.when(F.abs(v) < WHOLE / 10**places, _scaled(v, places) / float(10**places)).otherwise(v))
