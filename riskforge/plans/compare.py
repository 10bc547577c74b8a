"""Output normalization for cross-engine comparison of query results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

AUDIT_COLUMNS = ("_loaded_at", "_model_run_at")


def comparable(df: DataFrame) -> DataFrame:
    """Drop run-time audit stamps; decimals -> DOUBLE, integers -> BIGINT,
    dates -> ISO text (YYYY-MM-DD), so no engine-specific date conversion
    enters a cross-engine value comparison."""
    cols = []
    for f in df.schema.fields:
        if f.name in AUDIT_COLUMNS:
            continue
        c = F.col(f.name)
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            c = c.cast("bigint")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        cols.append(c.alias(f.name))
    return df.select(*cols)
