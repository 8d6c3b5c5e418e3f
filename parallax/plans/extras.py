"""Further queries with their SQL: the evidence table, lines of division, coverage of stories, and the land raster."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from parallax.operators import raster
from parallax.plans.registry import query
from parallax.plans.runs import _HISTORY, history_of
from parallax.sources.tables import table


@query("evidence_table", "SELECT story_id, evidence_id, row_number() OVER (PARTITION BY story_id ORDER BY polity IS NULL, polity, language NULLS FIRST, domain NULLS FIRST, url, evidence_id) AS position FROM evidence")
def evidence_table(spark, folder):
    """The order in which a story's rows are shown: by polity, those without one last."""
    order = [F.col("polity").isNull(), "polity", F.asc_nulls_first("language"), F.asc_nulls_first("domain"), "url", "evidence_id"]
    rows = table(spark, folder, "evidence")
    return rows.select("story_id", "evidence_id", F.row_number().over(Window.partitionBy("story_id").orderBy(*order)).cast("bigint").alias("position"))


@query("division_line", _HISTORY + ", l AS (SELECT id, count(*) AS points, arg_min(division, run) AS first, arg_max(division, run) AS last FROM history WHERE division IS NOT NULL GROUP BY id HAVING count(*) >= 3) SELECT id, points, round(last - first, 4) AS move, abs(last - first) >= 0.15 AS labelled FROM l")
def division_line(spark, folder):
    """How far each story's division moved, for stories with three points."""
    rows = history_of(spark, folder).filter("division is not null").groupBy("id").agg(F.count("*").alias("points"), F.min_by("division", "run").alias("first"), F.max_by("division", "run").alias("last"))
    move = F.col("last") - F.col("first")
    return rows.filter("points >= 3").select("id", "points", F.round(move, 4).alias("move"), (F.abs(move) >= 0.15).alias("labelled"))


@query("never_reached", "WITH u AS (SELECT DISTINCT url FROM capture WHERE url IS NOT NULL), s AS (SELECT DISTINCT url FROM evidence) SELECT count(*) AS articles, count(*) FILTER (url NOT IN (SELECT url FROM s)) AS never, round(100.0 * count(*) FILTER (url NOT IN (SELECT url FROM s)) / count(*), 1) AS share FROM u")
def never_reached(spark, folder):
    """Articles that no story holds."""
    urls = table(spark, folder, "capture").select("url").filter("url is not null").distinct()
    held = table(spark, folder, "evidence").select("url", F.lit(True).alias("held")).distinct()
    met = urls.join(held, "url", "left")
    return met.agg(F.count("*").alias("articles"), F.count_if(F.col("held").isNull()).alias("never"), F.round(100.0 * F.count_if(F.col("held").isNull()) / F.count("*"), 1).alias("share"))


@query("country_verdicts", "WITH m AS (SELECT polity, unnest(map_values(marks)) AS mark FROM evidence) SELECT polity, count(*) FILTER (mark = 'present') AS present, count(*) FILTER (mark = 'absent') AS absent, count(*) FILTER (mark = 'unresolved') AS unresolved FROM m WHERE polity IS NOT NULL GROUP BY polity")
def country_verdicts(spark, folder):
    """Marks by polity; the third state is counted, never folded into absence."""
    rows = table(spark, folder, "evidence").filter("polity is not null").select("polity", F.explode(F.map_values("marks")).alias("mark"))
    return rows.groupBy("polity").agg(*[F.count_if(F.col("mark") == m).alias(m) for m in ("present", "absent", "unresolved")])


#: An island with a lake, and a second island.
RINGS = [("a", 0, -120.0, 60.0), ("a", 1, 20.0, 70.0), ("a", 2, 35.0, -30.0), ("a", 3, -90.0, -45.0), ("b", 0, -60.0, 30.0), ("b", 1, -20.0, 30.0), ("b", 2, -40.0, -5.0), ("c", 0, 90.0, 40.0), ("c", 1, 150.0, 10.0), ("c", 2, 100.0, -35.0)]
_VERTICES = ", ".join(f"('{r}', {i}, {x}, {y})" for r, i, x, y in RINGS)
_LAND = f"""
WITH v(ring, i, lon, lat) AS (VALUES {_VERTICES}),
s AS (SELECT ring, CAST(lon AS DOUBLE) AS x1, CAST(lat AS DOUBLE) AS y1, CAST(coalesce(lead(lon) OVER w, first_value(lon) OVER w) AS DOUBLE) AS x2, CAST(coalesce(lead(lat) OVER w, first_value(lat) OVER w) AS DOUBLE) AS y2 FROM v WINDOW w AS (PARTITION BY ring ORDER BY i)),
g AS (SELECT i % 76 AS x, i // 76 AS y, -180.0 + (i % 76 + 0.5) * 360.0 / 76 AS lon, 84.0 - (i // 76 + 0.5) * 141.0 / 44 AS lat FROM range(76 * 44) t(i)),
land AS (SELECT x, y FROM g JOIN s ON (y1 > lat) <> (y2 > lat) AND lon < (x2 - x1) * (lat - y1) / (y2 - y1) + x1 GROUP BY x, y HAVING count(*) % 2 = 1)
"""


def _land(spark):
    rings = spark.createDataFrame(RINGS, "ring string, i int, lon double, lat double")
    return raster.land(raster.grid(spark, 76, 44, -180.0, 180.0, 84.0, -57.0), raster.edges(rings))


@query("land_cells", _LAND + "SELECT x, y FROM land")
def land_cells(spark, folder):
    return _land(spark)


@query("coast_cells", _LAND + "SELECT x, y FROM land l WHERE (SELECT count(*) FROM land n WHERE abs(n.x - l.x) + abs(n.y - l.y) = 1) < 4")
def coast_cells(spark, folder):
    return raster.coast(_land(spark))


@query("coast_dots", _LAND + ", c AS (SELECT x, y FROM land l WHERE (SELECT count(*) FROM land n WHERE abs(n.x - l.x) + abs(n.y - l.y) = 1) < 4) SELECT x // 2 AS \"column\", y // 4 AS \"row\", bit_or(([1, 2, 4, 64, 8, 16, 32, 128])[x % 2 * 4 + y % 4 + 1]) AS bits FROM c GROUP BY ALL")
def coast_dots(spark, folder):
    return raster.dots(raster.coast(_land(spark)))
