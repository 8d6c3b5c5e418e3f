"""Land as a raster of characters: rings to cells, cells to coastline, coastline to packed dots."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def grid(spark: SparkSession, width: int, height: int, west: float, east: float, north: float, south: float) -> DataFrame:
    """(x, y, lon, lat): the cells of a grid with their centres."""
    x, y = F.col("id") % width, F.expr(f"id div {width}")
    lon = west + (x + 0.5) * (east - west) / width
    lat = north - (y + 0.5) * (north - south) / height
    return spark.range(width * height).select(x.alias("x"), y.alias("y"), lon.alias("lon"), lat.alias("lat"))


def edges(rings: DataFrame) -> DataFrame:
    """(ring, x1, y1, x2, y2) from the vertices (ring, i, lon, lat) of closed rings."""
    w = Window.partitionBy("ring").orderBy("i")
    whole = Window.partitionBy("ring").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    nxt = lambda c: F.coalesce(F.lead(c).over(w), F.first(c).over(whole))
    return rings.select("ring", F.col("lon").alias("x1"), F.col("lat").alias("y1"), nxt("lon").alias("x2"), nxt("lat").alias("y2"))


def land(cells: DataFrame, sides: DataFrame) -> DataFrame:
    """(x, y) of cells whose centre is inside by the even-odd rule over all rings, so that a ring in a ring is a lake.

    Cells and sides meet where a side spans the centre's latitude; the crossings are counted per cell.
    """
    spans = (F.col("y1") > F.col("lat")) != (F.col("y2") > F.col("lat"))
    east = F.col("lon") < (F.col("x2") - F.col("x1")) * (F.col("lat") - F.col("y1")) / (F.col("y2") - F.col("y1")) + F.col("x1")
    near = (F.col("lat") <= F.greatest("y1", "y2")) & (F.col("lat") >= F.least("y1", "y2")) & (F.col("lon") <= F.greatest("x1", "x2"))
    return cells.join(F.broadcast(sides), near & spans & east).groupBy("x", "y").agg(F.count("*").alias("n")).filter("n % 2 = 1").select("x", "y")


def coast(cells: DataFrame) -> DataFrame:
    """Land cells of which one of the four neighbours is no land."""
    around = F.explode(F.array(*[F.struct((F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y")) for dx, dy in ((1, 0), (-1, 0), (0, 1), (0, -1))]))
    beside = cells.select(around.alias("c")).select("c.*").groupBy("x", "y").agg(F.count("*").alias("n"))
    return cells.join(beside, ["x", "y"], "left").filter("coalesce(n, 0) < 4").select("x", "y")


def dots(cells: DataFrame) -> DataFrame:
    """(column, row, bits): cells packed two by four into the bits of a dot character."""
    # fixed values: the bit of each dot, column by column from the top
    bits = F.array(*[F.lit(b) for b in (1, 2, 4, 64, 8, 16, 32, 128)])
    bit = F.element_at(bits, (F.col("x") % 2 * 4 + F.col("y") % 4 + 1).cast("int"))
    return cells.groupBy(F.expr("x div 2").alias("column"), F.expr("y div 4").alias("row")).agg(F.bit_or(bit).alias("bits"))
