"""Size check in front of every broadcast."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyloom.functions.keys import named

# Largest side we broadcast on our own account, in bytes as held in memory.
BROADCAST_LIMIT = 64 << 20

# Nodes that neither drop nor add rows, so that the size of the files says enough.
_PLAIN = {"Project", "LogicalRelation", "RelationV2", "DataSourceV2ScanRelation", "SubqueryAlias", "View"}


def surely_larger(df: DataFrame, limit: int) -> bool:
    """True when the optimizer's figures alone show that ``df`` is larger than ``limit``. No job runs.

    Only for columns of stored files, whose size in memory is at least that in the (compressed) files;
    a margin of two covers the share of the columns being an estimate. Of filters, joins and
    aggregates the optimizer knows too little.
    """
    plan = df._jdf.queryExecution().optimizedPlan()
    node = plan
    while True:
        name = node.nodeName().split(" ")[0]
        if name not in _PLAIN and not name.startswith("Relation"):
            return False
        children = node.children()
        if children.isEmpty():
            return int(str(plan.stats().sizeInBytes())) > 2 * limit
        node = children.apply(0)


def _value_bytes(field: T.StructField) -> Column:
    column = named(field.name)
    if isinstance(field.dataType, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 8
    if isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
        return F.coalesce(F.octet_length(F.to_json(F.struct(column))), F.lit(0)) * 2 + 8
    return F.lit(24)  # the widest fixed-size value, a long decimal


def measured_bytes(df: DataFrame) -> int:
    """In-memory size of ``df``: one aggregate job, one number to the driver."""
    row = reduce(lambda a, b: a + b, [_value_bytes(f) for f in df.schema.fields], F.lit(32))
    return df.agg(F.sum(row.cast("bigint")).alias("bytes")).first()["bytes"] or 0


def fits_in_broadcast(df: DataFrame, limit: int = BROADCAST_LIMIT) -> bool:
    """True when the size of ``df`` is within ``limit`` bytes, measured unless its files are far larger."""
    return not surely_larger(df, limit) and measured_bytes(df) <= limit
