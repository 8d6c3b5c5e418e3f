"""Bounded samples that are the same in every run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def bounded_sample(df: DataFrame, key: str, limit: int) -> DataFrame:
    """At most `limit` rows of df, chosen by a hash of the key column.

    A hash threshold thins df first, so that tasks send few rows above the limit to whoever collects them, whatever the
    number of tasks.
    """
    rows = df.count()
    if rows > 2 * limit:
        df = df.filter(F.pmod(F.xxhash64(key), F.lit(1 << 30)) < int((1 << 30) * 1.3 * limit / rows))
    return df.orderBy(F.xxhash64(key), *[c for c in df.columns if df.schema[c].dataType.typeName() != "map"]).limit(limit)
