"""A hash of whole rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType


def _hashable(kind: DataType) -> bool:
    if isinstance(kind, (MapType, VariantType)):
        return False
    if isinstance(kind, ArrayType):
        return _hashable(kind.elementType)
    return not isinstance(kind, StructType) or all(_hashable(f.dataType) for f in kind)


def row_hash(df: DataFrame) -> Column:
    """A hash of the columns that can be hashed, which maps can not.

    Rows that are equal in every column still differ by the partition they came from.
    """
    columns = [df[f.name] for f in df.schema if _hashable(f.dataType)]
    return F.xxhash64(*columns, F.spark_partition_id())
