"""Display formatting for report tables (F20): percent, fixed and thousands formats.

Figures are rounded half to even on the value the double holds, as Python's format does. A missing figure gives a missing
text; :func:`shown` puts a fallback in its place.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NO_VALUE = "n/a"


def fixed(c: Column, decimals: int) -> Column:
    """``{:.Nf}``-style text."""
    return F.call_function("format_number", c.cast("double"), F.lit("0." + "0" * decimals))


def percent(c: Column, decimals: int) -> Column:
    """``{:.N%}``-style text: ``0.1774 -> '17.7%'``."""
    return F.concat(fixed(c * F.lit(100.0), decimals), F.lit("%"))


def thousands(c: Column) -> Column:
    """Integer with thousands separators: ``5000 -> '5,000'``."""
    return F.format_number(c.cast("long"), 0)


def shown(text: Column) -> Column:
    return F.coalesce(text, F.lit(NO_VALUE))
