"""String normalisation expressions (JVM-side, codegen-friendly)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The two canonical gender labels and the marker that identifies
# the feminine form whatever its encoding ("Féminin", mis-decoded variants).
GENDER_MALE = "Masculin"
GENDER_FEMALE = "Feminin"
FEMININE_MARKER = "minin"


def gender_expr(c: Column) -> Column:
    """Exact ``Masculin`` stays; anything containing ``minin`` becomes ``Feminin``; else null."""
    return F.when(c == GENDER_MALE, F.lit(GENDER_MALE)).when(c.contains(FEMININE_MARKER), F.lit(GENDER_FEMALE))


def normalize_gender(df: DataFrame, column: str = "GENDER") -> DataFrame:
    if column not in df.columns:
        return df
    return df.withColumn(column, gender_expr(F.col(column)))
