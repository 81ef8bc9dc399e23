"""Casts that give NULL for what they cannot read, whatever the ANSI setting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Wide enough for money sums: sum gives (38, 8), avg gives (32, 12).
AMOUNT_TYPE = "decimal(28,8)"

# A whole or fractional number without exponent, blanks around it allowed.
PLAIN_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)\s*$"


def ref(name: str) -> Column:
    """The column of exactly this name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def _integer_from_text(c: Column) -> Column:
    # A string cast to int accepts no fraction; go through decimal, which
    # drops it towards zero.  Too long for decimal or int gives NULL.
    whole = c.try_cast("decimal(38,10)").try_cast("bigint").try_cast("int")
    return F.when(F.regexp_like(c, F.lit(PLAIN_NUMBER)), whole)


_FROM_TEXT = {
    "double": lambda c: c.try_cast("double"),
    "integer": _integer_from_text,
    "date": lambda c: F.try_to_date(c),
    "timestamp": lambda c: F.try_to_timestamp(c),
    "decimal": lambda c: c.try_cast(AMOUNT_TYPE),
}
_FROM_TYPED = {
    "double": "double",
    "integer": "int",
    "date": "date",
    "timestamp": "timestamp",
    "decimal": AMOUNT_TYPE,
}


def cast_lenient(c: Column, target: str, source: T.DataType) -> Column:
    """``c`` as contract type ``target``; unreadable values become NULL.

    ``string`` leaves the column as it is.
    """
    if target == "string":
        return c
    if isinstance(source, T.StringType):
        return _FROM_TEXT[target](c)
    return c.try_cast(_FROM_TYPED[target])
