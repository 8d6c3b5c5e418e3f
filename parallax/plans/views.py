"""Queries of the views that pages are built from, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from parallax.operators import measure, reads
from parallax.plans.measuring import CELLS, FIGURES, FLOORS, MARKS, marks_of
from parallax.plans.registry import query
from parallax.plans.runs import _SERIES, series_of
from parallax.sources.tables import table


@query("actor_leaderboard", FIGURES + "SELECT actor, CAST(sum(named) AS BIGINT) AS named, CAST(sum(evaluable) AS BIGINT) AS evaluable, count(*) AS stories, max(division) AS widest FROM figures WHERE measurable GROUP BY actor ORDER BY named DESC, actor LIMIT 10")
def actor_leaderboard(spark, folder):
    return reads.leaderboard(measure.figures(marks_of(spark, folder), FLOORS))


_WROTE = "WITH w AS (SELECT story_id, language, domain, polity, unnest(map_keys(wrote)) AS actor, unnest(map_values(wrote)) AS spelling FROM evidence WHERE wrote IS NOT NULL), per AS (SELECT story_id, actor, language, lower(trim(spelling)) AS form, count(DISTINCT domain) AS sources, count(DISTINCT polity) AS polities FROM w WHERE spelling IS NOT NULL GROUP BY ALL)"


@query("competing_spellings", _WROTE + " SELECT story_id, actor, language, form, sources, polities FROM (SELECT *, count(*) OVER (PARTITION BY story_id, actor, language) AS forms FROM per WHERE sources >= 2) WHERE forms >= 2")
def competing_spellings(spark, folder):
    rows = table(spark, folder, "evidence").select("story_id", "language", "domain", "polity", F.explode("wrote").alias("actor", "spelling"))
    return reads.competing_spellings(rows, F.lower(F.trim("spelling")))


@query("unanimity_split", MARKS + f", cells AS ({CELLS}) SELECT story_id, actor, coalesce(string_agg(polity, ', ' ORDER BY polity) FILTER (named = evaluable), '') AS all_named, coalesce(string_agg(polity, ', ' ORDER BY polity) FILTER (named = 0), '') AS none_named FROM cells GROUP BY ALL")
def unanimity_split(spark, folder):
    return reads.unanimity(measure.by_polity(marks_of(spark, folder)))


@query("story_languages", "WITH p AS (SELECT story_id, language, count(*) AS n FROM evidence GROUP BY ALL), r AS (SELECT *, row_number() OVER (PARTITION BY story_id ORDER BY n DESC, language ASC NULLS LAST) AS k, greatest(count(*) OVER (PARTITION BY story_id) - 4, 0) AS more FROM p) SELECT story_id, language, n, more FROM r WHERE k <= 4")
def story_languages(spark, folder):
    return reads.story_languages(table(spark, folder, "evidence"))


@query("cadence_gap", "WITH r AS (SELECT DISTINCT run FROM capture) SELECT run, date_diff('minute', lag(strptime(run, '%Y%m%dT%H%M%SZ')) OVER (ORDER BY run), strptime(run, '%Y%m%dT%H%M%SZ')) AS minutes FROM r")
def cadence_gap(spark, folder):
    return reads.cadence(table(spark, folder, "capture").select("run").distinct())


@query("actor_page", _SERIES + " SELECT actor, polity, CAST(sum(evaluable) AS BIGINT) AS weight, count(*) FILTER (evaluable >= 3) AS days, count(*) FILTER (evaluable >= 3) >= 2 AS drawn FROM series GROUP BY ALL")
def actor_page(spark, folder):
    return reads.drawable(series_of(spark, folder), ["actor", "polity"])


@query("country_page", _SERIES + ", u AS (SELECT polity FROM publisher WHERE polity IS NOT NULL UNION SELECT polity FROM series), w AS (SELECT polity, count(DISTINCT actor) AS actors, CAST(sum(evaluable) AS BIGINT) AS weight FROM series GROUP BY polity) SELECT u.polity, coalesce(actors, 0) AS actors, coalesce(weight, 0) AS weight FROM u LEFT JOIN w ON u.polity = w.polity")
def country_page(spark, folder):
    """Every polity that is on the map or in the series, with what the series has of it."""
    rows = series_of(spark, folder)
    universe = table(spark, folder, "publisher").select("polity").filter("polity is not null").union(rows.select("polity")).distinct()
    per = rows.groupBy("polity").agg(F.count_distinct("actor").alias("actors"), F.sum("evaluable").alias("weight"))
    return universe.join(per, "polity", "left").select("polity", F.coalesce("actors", F.lit(0)).alias("actors"), F.coalesce("weight", F.lit(0)).alias("weight"))


@query("rate_line", _SERIES + " SELECT actor, polity, arg_min(round(100.0 * named / evaluable, 1), day) FILTER (evaluable >= 3) AS first_rate, arg_max(round(100.0 * named / evaluable, 1), day) FILTER (evaluable >= 3) AS last_rate, count(*) FILTER (evaluable >= 3) AS points, count(*) FILTER (evaluable < 3) AS thin FROM series GROUP BY ALL")
def rate_line(spark, folder):
    return reads.rate_line(series_of(spark, folder), ["actor", "polity"])


@query("thin_pooling", MARKS + f", cells AS ({CELLS}) SELECT story_id, actor, CASE WHEN NOT thin THEN polity END AS polity, CAST(sum(named) AS BIGINT) AS named, CAST(sum(evaluable) AS BIGINT) AS evaluable FROM cells GROUP BY ALL")
def thin_pooling(spark, folder):
    return reads.pooled(measure.by_polity(marks_of(spark, folder)))


@query("split_bar", FIGURES + "SELECT story_id, actor, round(100.0 * named / evaluable, 1) AS rate, named / evaluable < 0.4 AS sparse, abs(named / evaluable - 0.5) <= 0.05 AS even FROM figures WHERE evaluable > 0")
def split_bar(spark, folder):
    rate = F.col("named") / F.col("evaluable")
    figs = measure.figures(marks_of(spark, folder), FLOORS).filter("evaluable > 0")
    return figs.select("story_id", "actor", F.round(100.0 * F.col("named") / F.col("evaluable"), 1).alias("rate"), (rate < 0.4).alias("sparse"), (F.abs(rate - 0.5) <= 0.05).alias("even"))


@query("evidence_budget", "SELECT evidence_id, CAST(spent AS BIGINT) AS spent FROM (SELECT evidence_id, sum(length(coalesce(title, '')) + length(url)) OVER (PARTITION BY story_id ORDER BY url, evidence_id ROWS UNBOUNDED PRECEDING) AS spent FROM evidence) WHERE spent <= 2000")
def evidence_budget(spark, folder):
    """Rows whose length, as a stand-in for their packed size, fits a story's budget."""
    cost = F.length(F.coalesce("title", F.lit(""))) + F.length("url")
    rows = reads.fit_budget(table(spark, folder, "evidence"), 2000, "story_id", ["url", "evidence_id"], cost)
    return rows.select("evidence_id", F.col("spent").cast("bigint").alias("spent"))


_COORDINATES = "coords AS (SELECT DISTINCT polity, (ascii(polity) - 77) * 6.5 AS lat, (ascii(polity[2:]) - 109) * 13.5 AS lon FROM publisher WHERE polity IS NOT NULL AND polity <> 'Keshtan')"


def coordinates(spark, folder):
    """Invented places of the polities; one of them is off the map."""
    rows = table(spark, folder, "publisher").select("polity").filter("polity is not null and polity <> 'Keshtan'").distinct()
    return rows.select("polity", ((F.ascii("polity") - 77) * F.lit(6.5)).alias("lat"), ((F.ascii(F.substring("polity", 2, 1)) - 109) * F.lit(13.5)).alias("lon"))


_CELL = "CAST(greatest(0, least(floor((lon + 180.0) / 360.0 * 76), 75)) AS BIGINT) AS x, CAST(greatest(0, least(floor((84.0 - lat) / 141.0 * 22), 21)) AS BIGINT) AS y"


@query("map_cells", f"WITH {_COORDINATES} SELECT polity, {_CELL} FROM coords")
def map_cells(spark, folder):
    x, y = reads.map_cell(F.col("lat"), F.col("lon"))
    return coordinates(spark, folder).select("polity", x.alias("x"), y.alias("y"))


@query("map_panel", MARKS + f", cells AS ({CELLS}), {_COORDINATES} SELECT story_id, actor, cells.polity, named, evaluable, CASE WHEN evaluable < 3 THEN 'thin' WHEN named / evaluable > 0.5 THEN 'most' ELSE 'few' END AS state, {_CELL.replace('greatest(0, ', 'CASE WHEN lon IS NULL THEN NULL ELSE greatest(0, ').replace(') AS BIGINT)', ') END AS BIGINT)')} FROM cells LEFT JOIN coords ON cells.polity = coords.polity")
def map_panel(spark, folder):
    return reads.map_panel(measure.by_polity(marks_of(spark, folder)), coordinates(spark, folder))


@query("measurable_actors", FIGURES + "SELECT count(DISTINCT actor) AS actors, count(DISTINCT story_id) AS stories FROM figures WHERE measurable")
def measurable_actors(spark, folder):
    return measure.figures(marks_of(spark, folder), FLOORS).filter("measurable").agg(F.count_distinct("actor").alias("actors"), F.count_distinct("story_id").alias("stories"))


@query("row_counts", FIGURES + ", best AS (SELECT *, max(division) OVER (PARTITION BY story_id) AS best FROM figures WHERE measurable AND division > 0.005) SELECT story_id, actor, named, evaluable, named / evaluable < 0.4 AS miss FROM best WHERE division >= best - 0.005")
def row_counts(spark, folder):
    """Counts of each actor of a story's band, with a flag where most rows miss it."""
    figs = measure.figures(marks_of(spark, folder), FLOORS)
    band = measure.top_band(figs, FLOORS).select("story_id", F.explode(F.split("band", ",")).alias("actor"))
    return figs.join(band, ["story_id", "actor"]).select("story_id", "actor", "named", "evaluable", (F.col("named") / F.col("evaluable") < 0.4).alias("miss"))


@query("slugs", "SELECT DISTINCT polity, trim(regexp_replace(strip_accents(lower(polity)), '[^a-z0-9]+', '-', 'g'), '-') AS slug FROM publisher WHERE polity IS NOT NULL")
def slugs(spark, folder):
    return table(spark, folder, "publisher").filter("polity is not null").select("polity", reads.slug(F.col("polity")).alias("slug")).distinct()
