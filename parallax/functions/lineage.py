"""Cutting lineage through the shared folder, and joins that survive hot keys."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_written: list[tuple[SparkSession, str]] = []
_own: dict[str, str] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir.

    Where it is unset a folder of our own serves in local mode, where driver and executors are one machine; a cluster
    has to name one.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        app = spark.sparkContext.applicationId
        folder = _own.get(app) or _own.setdefault(app, tempfile.mkdtemp(prefix="parallax-"))
    return folder.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, removed when the application ends."""
    path = f"{shared_dir(spark)}/parallax-{name}-{uuid.uuid4().hex[:12]}"
    _written.append((spark, path))
    return path


def cut(df: DataFrame, name: str = "cut") -> DataFrame:
    """Write df to the shared folder and read it back: any executor may be lost afterwards.

    Parquet instead of checkpoint(): compressed, columnar, with sizes the optimiser can use.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table._written_at = path
    return table


def release(*tables: DataFrame) -> None:
    """Delete what cut() wrote for tables that nothing reads any more."""
    for table in tables:
        drop_path(table.sparkSession, table._written_at)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a path written by this module."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _sweep() -> None:
    for spark, path in _written:
        try:
            drop_path(spark, path)
        except Exception:  # the application may be gone already
            return


def spread(df: DataFrame) -> DataFrame:
    """df over at least as many tasks as there are cores, for work that is heavy per row.

    Only an input of fewer splits than cores, which is a small one, is dealt out anew.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def heavy_light_lookup(
    rows: DataFrame, dim: DataFrame, keys: list[str], weight: str, heavy_above: Column | int, keep: list[str], how: str = "inner"
) -> DataFrame:
    """Join rows to dim on keys where one key may hold a third of the rows.

    dim has one row per key with the number of rows it meets in `weight`. Keys met by more than `heavy_above` rows
    are broadcast: there are at most (rows / heavy_above) of them, whatever the input. The others meet in a shuffled
    join whose groups are no larger than heavy_above. Neither the rows nor the matches are dropped.
    """
    heavy = dim.filter(F.col(weight) > heavy_above).select(*keys, *keep)
    light = dim.filter(F.col(weight) <= heavy_above).select(*keys, *keep)
    heavy_keys = F.broadcast(heavy.select(*keys))
    hot = rows.join(F.broadcast(heavy), keys, "inner")
    cold = rows.join(heavy_keys, keys, "left_anti").join(light, keys, how)
    return hot.unionByName(cold)
