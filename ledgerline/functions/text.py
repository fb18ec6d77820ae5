"""Reading numbers and times out of source text, and quoting text in messages.

Sources arrive as text written by other programs. A bare cast is both too loose
(``1d``, ``2026-09``) and too strict (``1_000``), so a pattern decides what counts
as a number or a time and the cast only converts what has passed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted spellings.
NUMBER = r"^[+-]?(\d+(_\d+)*(\.(\d+(_\d+)*)?)?|\.\d+(_\d+)*)([eE][+-]?\d+(_\d+)*)?$"
TIME = (
    r"^\d{4}-\d{2}-\d{2}"
    r"(.\d{2}(:\d{2}(:\d{2}([.,]\d+)?)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?$"
)


# The usual spelling, taken first because one short match decides it.
_PLAIN = r"^[+-]?\d+(\.\d+)?$"


def _digits(text: Column) -> Column:
    bare = F.regexp_replace(text, r"^\s+|\s+$", "")
    return F.when(text.rlike(_PLAIN), text).when(bare.rlike(NUMBER), F.translate(bare, "_", ""))


def parse_money(text: Column) -> Column:
    """DECIMAL(12,2), rounded half away from zero; NULL if not a number or too large."""
    digits = _digits(text)
    # The decimal cast refuses a far exponent even of zero.
    tiny = F.when(digits.try_cast("double") == 0, F.lit(0).cast("decimal(12,2)"))
    return F.coalesce(digits.try_cast("decimal(12,2)"), tiny)


def is_below_zero(text: Column) -> Column:
    """Sign of the written number, before rounding to cents hides a small negative."""
    return text.contains("-") & (_digits(text).try_cast("double") < 0)


def parse_time(text: Column) -> Column:
    # Any single character may stand between date and time.
    iso = F.when(F.length(text) > 10, F.overlay(text, F.lit("T"), F.lit(11))).otherwise(text)
    return F.when(text.rlike(TIME), F.translate(iso, ",", ".").try_cast("timestamp"))


def quoted(text: Column) -> Column:
    """Text in quotes with escapes, the way it is shown in a reject reason."""
    escaped = text
    for raw, shown in (("\\", "\\\\"), ("\n", "\\n"), ("\r", "\\r"), ("\t", "\\t")):
        escaped = F.replace(escaped, F.lit(raw), F.lit(shown))
    single, double = text.contains("'"), text.contains('"')
    return (
        F.when(single & ~double, F.concat(F.lit('"'), escaped, F.lit('"')))
        .otherwise(F.concat(F.lit("'"), F.replace(escaped, F.lit("'"), F.lit("\\'")), F.lit("'")))
    )
