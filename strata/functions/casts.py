"""Tolerant casts that behave the same whatever the session's ANSI setting.

Under ANSI mode a bad ``cast`` raises; the cleaning layer must instead turn an
unparsable value into null (and let the quality filters decide). Integers go
through a wide decimal first so ``'12.7'`` becomes 12 (truncation), as the
non-ANSI cast did, instead of null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, StringType, TimestampNTZType, TimestampType

# The simple cast targets a clean spec may name.
SIMPLE_TYPES = ("int", "string", "double", "float", "boolean", "long")
_WIDE_DECIMAL = "decimal(38,10)"


def tolerant_cast(c: Column, target: str | tuple[str, str], source_type: DataType | None = None) -> Column:
    """Cast ``c`` to a spec target; failures give null instead of an error."""
    if isinstance(target, tuple):
        kind, fmt = target
        if kind != "date":
            raise ValueError(f"only ('date', format) tuple casts are supported, got {target!r}")
        if isinstance(source_type, (DateType, TimestampType, TimestampNTZType)):
            return c.cast("date")
        return F.try_to_date(c.cast("string"), fmt)
    if target in ("int", "long"):
        if source_type is None or isinstance(source_type, StringType):
            return c.try_cast(_WIDE_DECIMAL).try_cast(target)
        return c.try_cast(target)
    if target not in SIMPLE_TYPES:
        raise ValueError(f"unknown cast target {target!r}")
    return c.try_cast(target)
