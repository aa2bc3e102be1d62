"""Safe casts that give null for unparseable text, whatever the ANSI setting.

The reference ran plain casts with ANSI off: bad text became null and
integer text with a fraction was truncated ('12.7' -> 12).  ``try_cast`` keeps
the null, but rejects '12.7' for integral types, so integral casts first pull
the integer part out of a strict decimal pattern.  Floating casts only try
text that could parse (same results, without the parser's exception cost).  Never routed through
double: that would accept '1e2' and lose digits above 2**53.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: text accepted as an integer; group 1 is the integer part.
# Outer characters up to ASCII 32 are ignored, as numeric casts trim them.
INT_TEXT_PATTERN = r"^[\x00-\x20]*([+-]?[0-9]+)(\.[0-9]*)?[\x00-\x20]*$"

# Fixed value: a superset of the text the floating-point parser accepts
# (decimal and hex literals with optional exponent and d/f suffix, NaN,
# Infinity, Spark's inf), surrounded by control/space characters.
FLOAT_TEXT_PATTERN = (r"(?i)^[\x00-\x20]*[+-]?(nan|infinity|inf|(\d+\.?\d*|\.\d+)(e[+-]?\d+)?[fd]?"
                      r"|0x([0-9a-f]+\.?[0-9a-f]*|\.[0-9a-f]+)p[+-]?\d+[fd]?)[\x00-\x20]*$")

_INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_FLOATING = (T.FloatType, T.DoubleType)


def safe_cast(col: Column, dtype: T.DataType, source: T.DataType | None = None) -> Column:
    """Cast ``col`` to ``dtype``; text that does not parse becomes null.

    ``source`` is the column's current type when known; integral targets get
    the legacy truncating text rule only for string sources.
    """
    if isinstance(dtype, _INTEGRAL) and (source is None or isinstance(source, T.StringType)):
        if source is None:
            text = col.cast("string")
        else:
            text = col
        # plain integer text parses directly; only the rest (a fraction to
        # truncate, or junk) goes through the pattern
        return F.coalesce(text.try_cast(dtype),
                          F.regexp_extract(text, INT_TEXT_PATTERN, 1).try_cast(dtype))
    if isinstance(dtype, _FLOATING) and isinstance(source, T.StringType):
        # The parser reports bad text by throwing, which costs microseconds per
        # value; text outside the pattern can never parse, so skip it.
        return F.when(col.rlike(FLOAT_TEXT_PATTERN), col.try_cast(dtype))
    return col.try_cast(dtype)
