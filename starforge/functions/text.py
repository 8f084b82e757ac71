"""String cleaning expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from starforge.config import NA_TOKENS

# The characters Python's str.strip() removes (Unicode white
# space), so trimming matches the reference exactly. A character-set trim is
# a plain scan, much cheaper than a Unicode regular expression.
WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004"
              "\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000")


def trim_ws(c: Column) -> Column:
    """Strip leading/trailing white space; '' stays '' (not NULL)."""
    return F.trim(c, F.lit(WHITESPACE))


def null_na_tokens(c: Column, tokens=None) -> Column:
    """Whole-field NA markers -> NULL (CSV / spreadsheet semantics)."""
    return F.when(~c.isin(list(tokens if tokens is not None else NA_TOKENS)), c)
