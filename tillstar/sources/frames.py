"""Raw invoice lines from any DataFrame (Parquet, a table, JDBC)."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tillstar.schemas import OPTIONAL_COLUMNS, RAW


def as_raw(df):
    """Select and cast the raw columns; not-a-number counts as missing."""
    columns = []
    for field in RAW:
        value = F.col(field.name).cast(field.dataType)
        if isinstance(field.dataType, T.DoubleType):
            value = F.when(~F.isnan(value), value)
        columns.append(value.alias(field.name))
    return df.select(*columns, *[c for c in df.columns if c in OPTIONAL_COLUMNS])
