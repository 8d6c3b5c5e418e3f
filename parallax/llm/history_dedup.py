"""Deduplicating new batches against all history (problem 5).

Articles are points of a metric space: with an article's identity hashed to a whole number A, and T the second it was
seen, d(x, y) = |Tx - Ty| + R |Ax - Ay| + R [identities differ]. For a reach below R, d <= reach holds just for the same
article seen within reach.

The history is a pivot-distance table: each accepted row is stored with its distances d1, d2 to two fixed pivots,
(T, A) = (0, 0) and (0, A_MAX). By the triangle inequality, |d1x - d1y| > reach or |d2x - d2y| > reach rules a pair out.
A batch and the stored rows near it are cut into ranges of d1 that never part an article, and each range is swept once:
stored distances sorted by d1 are searched for those within reach, pruned by d2, and the true distance is verified. The
table is partitioned by era of T and sorted by d1, so a batch opens only the eras its own rows touch; of these a small
batch takes along only what its own articles have. Accepted rows are appended.

The sweep takes an article's rows in order and holds only its accepted points, which lie more than reach apart. Articles
with more than one in HOT_PARTS rows of a batch send one row per second instead of all, and their rows look the outcome
up in the accepted points of those articles: at most HOT_PARTS of them, with one point per reach of the batch's span.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parallax.functions.addresses import address_host, address_number, address_rest, stamp_seconds, with_publisher
from parallax.functions.lineage import cut, new_path

REACH = 72 * 3600
#: Weight of the identity: above any reach in use, 12 days.
R = 1 << 20
A_MAX = 1 << 41
#: Seconds from year 1 to 1970: T is never negative.
EPOCH = 62_135_596_800
#: Width of the eras by which the history is partitioned.
ERA = 10 * 86_400
#: Rows of a range of d1, about; an article with more than one in so many rows is hot; rows of a batch that is small.
RANGE_ROWS, HOT_PARTS, SMALL = 1_000_000, 1000, 100_000

#: What the table holds of an accepted row.
POINT = "id bigint, key string, t bigint, d1 bigint, d2 bigint, era bigint"


def points(df: DataFrame, publishers: DataFrame, id_col: str = "capture_id", url: str = "url", seen: str = "seen_at") -> DataFrame:
    """(id, key, t): the rows as points; rows without a valid address or instant are no points."""
    base = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{url}`").alias("_url"), stamp_seconds(F.col(f"`{seen}`")).alias("_t"))
    base = base.withColumn("_host", address_host(F.col("_url"))).filter("_t is not null and _host is not null")
    base = with_publisher(base, "_host", publishers, "_publisher")
    name = F.coalesce(F.concat(F.lit("#"), address_number(F.col("_url"))), F.concat(F.lit("/"), address_rest(F.col("_url"))))
    return base.select("id", F.concat(F.col("_publisher"), name).alias("key"), (F.col("_t") + EPOCH).alias("t"))


def _placed(rows: DataFrame) -> DataFrame:
    """(id, key, t, d1, d2): points with their distances to the pivots."""
    a = F.pmod(F.xxhash64("key"), F.lit(A_MAX))
    return rows.select("id", "key", "t", (F.col("t") + R * a + R).alias("d1"), (F.col("t") + R * (A_MAX - a) + R).alias("d2"))


#: The article's place among all, from the first distance: T never reaches so many times R that ranges would mix.
PLACE = f"shiftright(d1 - t - {R}, 20)"


def _sweep(reach: int):
    """The sweep over a range: (id, kept, key, t, d1, d2) of its rows, kept being null for accepted ones.

    Rows come by article, stored ones (kind 0) first, then in order. Of a hot article's rows (kind 2) only accepted ones
    come out.
    """
    names = ["id", "kept", "key", "t", "d1", "d2"]
    types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int64()]

    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, near1, stored = None, [], []  # of one place: first distances in order, and the points in that order
        for batch in batches:
            out: list[tuple] = []
            for place, kind, i, key, t, d1, d2 in zip(*(batch.column(c).to_pylist() for c in ("place", "kind", "id", "key", "t", "d1", "d2"))):
                if place != now:
                    now, near1, stored = place, [], []
                if kind:
                    low, high = bisect_left(near1, d1 - reach), bisect_right(near1, d1 + reach)
                    kept = min((y[0] for y in stored[low:high] if abs(y[3] - d2) <= reach and y[1] == key and abs(y[2] - t) <= reach), default=None)
                    if kept is not None:
                        if kind == 1:
                            out.append((i, kept, None, None, None, None))
                        continue
                    out.append((i, None, key, t, d1, d2))
                at = bisect_right(near1, d1)
                near1.insert(at, d1)
                stored.insert(at, (i, key, t, d2))
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 6, types)], names=names)

    return sweep


class PivotTable:
    """The accepted rows of all batches, in one folder that grows by appending and outlives the session if it is given one."""

    def __init__(self, spark, path: str | None = None, reach: int = REACH):
        assert 0 < reach < R
        self.spark, self.path, self.reach, self.appended = spark, path or new_path(spark, "history"), reach, path is not None

    def read(self, eras: list[int] | None = None) -> DataFrame:
        """The accepted points, of some eras only if they are given."""
        if not self.appended:
            return self.spark.createDataFrame([], POINT)
        table = self.spark.read.schema(POINT).parquet(self.path)
        return table if eras is None else table.filter(F.col("era").isin(eras))

    def append(self, accepted: DataFrame) -> None:
        """Add accepted points (id, key, t, d1, d2), sorted into ranges of the first distance."""
        rows = accepted.withColumn("era", F.expr(f"t div {ERA}"))
        rows.repartitionByRange("era", "d1").sortWithinPartitions("era", "d1").write.mode("append").partitionBy("era").parquet(self.path)
        self.appended = True

    def admit(self, batch: DataFrame) -> DataFrame:
        """Check a batch of points against the history and itself, append what is accepted, return (kept_id, dup_id).

        Ids of a batch must be above all accepted ones. A row near several accepted rows is a duplicate of the first.
        batch is read several times and should be a written table. The cost is that of the batch and of the stored points
        of its eras (of its own articles only, if it is small), however long the history.
        """
        spans = batch.select(F.expr(f"t div {ERA}").alias("e")).groupBy("e").count().collect()  # calendar spans: few
        eras, size = sorted({r["e"] + k for r in spans for k in (-1, 0, 1)}), sum(r["count"] for r in spans)
        placed = _placed(batch.select("id", "key", "t")).withColumn("place", F.expr(PLACE))
        # what may be hot, from a sketch of fixed size over all rows; more rows than one in HOT_PARTS is sure to be told
        top = placed.select(F.expr(f"approx_top_k(place, {2 * HOT_PARTS}, {16 * HOT_PARTS})").alias("top")).first()["top"] or []
        hot = [x["item"] for x in top if x["count"] > max(1, size // HOT_PARTS)]
        fresh = placed.withColumn("kind", F.lit(1))
        if hot:
            hot_ones = F.broadcast(self.spark.createDataFrame([(x,) for x in hot], "place bigint"))
            seconds = placed.join(hot_ones, "place", "left_semi").groupBy("place", "key", "t", "d1", "d2").agg(F.min("id").alias("id")).withColumn("kind", F.lit(2))
            fresh = fresh.join(hot_ones, "place", "left_anti").unionByName(seconds)
        stored = self.read(eras).drop("era").withColumn("place", F.expr(PLACE))
        if self.appended and size <= SMALL:  # counted above
            stored = stored.join(F.broadcast(placed.select("place").distinct()), "place", "left_semi")
        rows = fresh.unionByName(stored.withColumn("kind", F.lit(0))) if self.appended else fresh
        ranges = max(self.spark.sparkContext.defaultParallelism, -(-size // RANGE_ROWS))
        # ranges of equal width of the first distance: hashed places are spread evenly over them
        cutup = rows.repartitionById(ranges, F.expr(f"cast(place * {ranges} div {A_MAX} as int)")).sortWithinPartitions("place", "kind", "id")
        decided = cut(cutup.mapInArrow(_sweep(self.reach), "id bigint, kept bigint, key string, t bigint, d1 bigint, d2 bigint"), "decided")
        accepted = decided.filter("kept is null").drop("kept")
        found = decided.filter("kept is not null").select(F.col("kept").alias("kept_id"), F.col("id").alias("dup_id"))
        if hot:
            points_of = accepted.select("id", "key", "t", F.expr(PLACE).alias("place")).join(hot_ones, "place", "left_semi").unionByName(stored.select("id", "key", "t", "place").join(hot_ones, "place", "left_semi"))
            packed = F.broadcast(points_of.groupBy("key").agg(F.collect_list(F.struct("id", "t")).alias("points")))  # hot articles, a point per reach
            near = F.filter("points", lambda x: (F.abs(x["t"] - F.col("t")) <= self.reach) & (x["id"] < F.col("id")))
            of_hot = placed.join(hot_ones, "place", "left_semi").join(packed, "key").select(F.array_min(F.transform(near, lambda x: x["id"])).alias("kept_id"), F.col("id").alias("dup_id"))
            found = cut(found.unionByName(of_hot.filter("kept_id is not null")), "found")
        self.append(accepted)
        return found


def batch_bounds(df: DataFrame, id_col: str, run: str, batches: int) -> list[int]:
    """First ids of up to `batches` groups of whole runs of about equal size, in order of arrival.

    One row per run is ordered; runs are ingest batches, not data.
    """
    runs = df.groupBy(F.col(f"`{run}`").alias("run")).agg(F.min(f"`{id_col}`").alias("first"), F.count("*").alias("n"))
    order = Window.partitionBy(F.lit(0)).orderBy("first")
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    share = F.floor(before * batches / F.sum("n").over(Window.partitionBy(F.lit(0))))
    firsts = runs.select("first", share.alias("batch")).groupBy("batch").agg(F.min("first").alias("first")).orderBy("first").collect()
    return [r["first"] for r in firsts]


def deduplicate_batches(
    df: DataFrame, publishers: DataFrame, id_col: str = "capture_id", url: str = "url", seen: str = "seen_at", run: str = "run", reach: int = REACH, batches: int = 3
) -> DataFrame:
    """(kept_id, dup_id): rows that repeat an article accepted before, seen within `reach` seconds of it.

    Rows are taken in order of id_col (unique). The rows come in `batches` groups of whole runs, each checked against the
    pivot table of what came before and appended to it; the result doesn't depend on their number. Nulls, addresses
    without host and void stamps make a row no case. A row near several accepted rows is given once, with the first of
    them. Repeated rows are duplicates like any other. Empty tables give an empty result; other columns are ignored.
    """
    spark = df.sparkSession
    table = PivotTable(spark, reach=reach)
    bounds = batch_bounds(df, id_col, run, batches)
    all_points = cut(points(df, publishers, id_col, url, seen), "points")
    found = spark.createDataFrame([], "kept_id bigint, dup_id bigint")
    for i in range(len(bounds)):
        part = F.col("id") >= bounds[i] if i else F.lit(True)
        if i + 1 < len(bounds):
            part = part & (F.col("id") < bounds[i + 1])
        found = found.unionByName(table.admit(all_points.filter(part)))
    return found


def last_batch(df: DataFrame, publishers: DataFrame, id_col: str = "capture_id", url: str = "url", seen: str = "seen_at", run: str = "run", reach: int = REACH) -> DataFrame:
    """(kept_id, dup_id) of the rows of the last run alone, checked against the table of all runs before."""
    table = PivotTable(df.sparkSession, reach=reach)
    first = df.groupBy(F.col(f"`{run}`").alias("run")).agg(F.min(f"`{id_col}`").alias("first")).agg(F.max("first")).first()[0]
    all_points = cut(points(df, publishers, id_col, url, seen), "points")
    if first is None:
        return df.sparkSession.createDataFrame([], "kept_id bigint, dup_id bigint")
    table.admit(all_points.filter(F.col("id") < first))
    return table.admit(all_points.filter(F.col("id") >= first))
