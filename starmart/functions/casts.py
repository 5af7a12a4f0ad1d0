"""Safe casts for untyped (string) raw columns.

Every function returns a ``Column`` built from built-in expressions, so the
casts stay inside whole-stage codegen.  A value that cannot be converted
becomes NULL instead of failing the job (ANSI mode raises on a plain ``cast``).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# A timestamp text must start with a full year-month-day date; Spark would
# otherwise accept a bare year ('2010') or year-month ('2010-01').
_DATE_PREFIX = r"^\s*\d{4}-\d{1,2}-\d{1,2}"
# A date with only trailing blanks after it is rejected by the reference
# engine while Spark would parse it.
_DATE_WITH_TRAILING_BLANK = r"^\s*[0-9-]+\s+$"


def safe_int(col: Column | str) -> Column:
    """Text -> INT, rounding half away from zero; bad text or overflow -> NULL.

    Goes through a wide decimal first so '5.5', '5.0' and '1e3' convert like a
    numeric-aware TRY_CAST would ('2.4999999' stays 2: one rounding only).
    """
    c = F.col(col) if isinstance(col, str) else col
    return F.round(c.try_cast("decimal(38,18)"), 0).try_cast("int")


def safe_timestamp(col: Column | str) -> Column:
    """Text -> TIMESTAMP (no zone); anything without a full date -> NULL."""
    c = F.col(col) if isinstance(col, str) else col
    ok = c.rlike(_DATE_PREFIX) & ~c.rlike(_DATE_WITH_TRAILING_BLANK)
    return F.when(ok, c.try_cast("timestamp_ntz"))


def safe_decimal(col: Column | str, precision: int = 10, scale: int = 2) -> Column:
    """Text -> DECIMAL(p, s) rounding half up; bad text or overflow -> NULL."""
    c = F.col(col) if isinstance(col, str) else col
    return c.try_cast(f"decimal({precision},{scale})")
