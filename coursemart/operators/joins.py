"""Join helpers: a dimension is broadcast only after its size has been checked."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coursemart.params import Params

_FIXED = {T.ByteType: 1, T.ShortType: 2, T.IntegerType: 4, T.LongType: 8, T.FloatType: 4, T.DoubleType: 8,
          T.DateType: 4, T.TimestampType: 8, T.TimestampNTZType: 8, T.BooleanType: 1}


def row_width(schema: T.StructType) -> int:
    """Estimated bytes per row in a broadcast hash relation (8 bytes slot per field + payload)."""
    w = 8
    for f in schema.fields:
        dt = f.dataType
        if isinstance(dt, T.DecimalType):
            w += 8 if dt.precision <= 18 else 24
        elif isinstance(dt, T.StringType):
            w += 40
        else:
            w += _FIXED.get(type(dt), 32)
        w += 8
    return w


def fits_broadcast(df: DataFrame, p: Params) -> bool:
    """True when ``df`` has at most ``broadcast_max_bytes / row_width`` rows.

    The count is bounded (``limit(n + 1)``), so a large input stops early; for a table written
    by ``session.materialize`` the count observed while writing is used (no extra job).
    """
    from coursemart.session import known_rows

    max_rows = max(1, p.broadcast_max_bytes // row_width(df.schema))
    n = known_rows(df)
    if n is None:
        n = df.limit(max_rows + 1).count()
    return n <= max_rows


class Lookup:
    """Remembers the broadcast decision per dimension, so each is checked once per build."""

    def __init__(self, p: Params):
        self.p = p
        self._ok: dict[int, tuple[DataFrame, bool]] = {}

    def fits(self, dim: DataFrame) -> bool:
        k = id(dim)  # the entry holds the DataFrame, so its id is not used again
        if k not in self._ok:
            self._ok[k] = (dim, fits_broadcast(dim, self.p))
        return self._ok[k][1]

    def side(self, dim: DataFrame) -> DataFrame:
        return F.broadcast(dim) if self.fits(dim) else dim

    def join(self, fact: DataFrame, dim: DataFrame, on, how: str = "left", cols=None) -> DataFrame:
        """Equi-join of a large input with a dimension (projected to ``cols``): broadcast hash
        join when the dimension passed the size check, otherwise a shuffle join (AQE may
        still convert it at run time, and splits skewed partitions)."""
        side = self.side(dim)
        if cols is not None:
            side = side.select(*cols)
        return fact.join(side, on, how)
