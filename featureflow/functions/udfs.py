"""Python UDF forms of B2 and B13 (U1, U2): kept only to prove the native
expressions equal them. They are the slow path -- the library never uses them."""

from __future__ import annotations

import datetime as dt
import pandas as pd
from pyspark.sql.functions import pandas_udf, udf
from pyspark.sql.types import DoubleType, LongType


@pandas_udf(DoubleType())
def flags_udf(*cols: pd.Series) -> pd.Series:
    """Count of "Yes" over any number of columns (Arrow-batched)."""
    out = pd.Series(0.0, index=cols[0].index)
    for s in cols:
        out = out + (s == "Yes").astype("double")
    return out


def _ceil_seconds(ts: dt.datetime | None, minutes: int) -> int | None:
    if ts is None:
        return None
    ts = ts.replace(tzinfo=None)
    step = 60 * minutes
    epoch = dt.datetime(1970, 1, 1)
    d = ts - epoch
    us = (d.days * 86400 + d.seconds) * 1_000_000 + d.microseconds
    return -(-us // (step * 1_000_000)) * step


ceil_udf = udf(_ceil_seconds, LongType())  # U2: row-at-a-time, unix seconds
