"""Size-checked broadcast for tables derived from the data.

Static dimensions (sector lists, code maps, keyword tables) have a fixed size
and are broadcast directly. Tables *derived* from the data (per-ticker counts,
per-date aggregates) are written to the shared folder and broadcast only while
rows times the width of a row stay within a bound in bytes; beyond it the join
stays a shuffle join (AQE may still convert it at run time).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom.session import stored

MAX_BROADCAST_BYTES = 64 << 20
#: Bytes of a value of varying size (text, arrays, maps), as a rough upper bound.
VARYING = 64


def row_bytes(schema: T.StructType) -> int:
    fixed = {"boolean": 8, "byte": 8, "short": 8, "integer": 8, "long": 8, "float": 8, "double": 8, "date": 8,
             "timestamp": 8, "timestamp_ntz": 8}
    return 16 + sum(fixed.get(f.dataType.typeName(), VARYING) for f in schema.fields)


def checked_broadcast(small: DataFrame, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    small = stored(small, "side")
    return F.broadcast(small) if small.count() * row_bytes(small.schema) <= max_bytes else small
