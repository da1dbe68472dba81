"""Date formats in strptime notation, as Spark patterns that accept and reject the same texts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from caresieve.functions.predicates import SpecError

#: Strptime directives; %d and %m take one or two digits, so they map to single letters.
DIRECTIVES = {"d": "d", "m": "M", "Y": "yyyy", "y": "yy", "H": "H", "M": "m", "S": "s", "B": "MMMM", "b": "MMM", "j": "D"}


def spark_pattern(strptime: str) -> str:
    """'d/M/yyyy' of '%d/%m/%Y'."""
    out, i = [], 0
    while i < len(strptime):
        c = strptime[i]
        if c == "%":
            i += 1
            if i == len(strptime) or strptime[i] not in DIRECTIVES:
                raise SpecError(f"unknown directive in {strptime!r}")
            out.append(DIRECTIVES[strptime[i]])
        else:
            out.append(f"'{c}'" if c.isalpha() else c)
        i += 1
    return "".join(out)


def parsed(value: Column, strptime: str) -> Column:
    """The timestamp, or null where the text isn't a date of this format."""
    return F.try_to_timestamp(value, F.lit(spark_pattern(strptime)))


def malformed(value: Column, strptime: str, sentinel: str | None = None) -> Column:
    """Whether a present value isn't a date of this format."""
    present = value.isNotNull() if sentinel is None else value.isNotNull() & (value != sentinel)
    return F.coalesce(present & parsed(value, strptime).isNull(), F.lit(False))
