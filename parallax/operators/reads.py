"""Views that pages are built from."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def leaderboard(figs: DataFrame, limit: int = 10) -> DataFrame:
    """(actor, named, evaluable, stories, widest): actors by how often they are named in measurable stories."""
    per = figs.filter("measurable").groupBy("actor").agg(F.sum("named").alias("named"), F.sum("evaluable").alias("evaluable"), F.count("*").alias("stories"), F.max("division").alias("widest"))
    return per.orderBy(F.desc("named"), "actor").limit(limit)


def competing_spellings(rows: DataFrame, key: Column, least: int = 2) -> DataFrame:
    """(story_id, actor, language, form, sources, polities): spellings used by `least` sources in stories that have two.

    rows: story_id, actor, language, spelling, domain, polity; key folds spellings that count as one form.
    """
    per = rows.filter("spelling is not null").groupBy("story_id", "actor", "language", key.alias("form")).agg(F.count_distinct("domain").alias("sources"), F.count_distinct("polity").alias("polities"))
    forms = F.count("*").over(Window.partitionBy("story_id", "actor", "language"))
    return per.filter(F.col("sources") >= least).withColumn("forms", forms).filter("forms >= 2").drop("forms")


def unanimity(cells: DataFrame) -> DataFrame:
    """(story_id, actor, all_named, none_named): polities where every source names the actor, and where none does."""
    pick = lambda c: F.array_join(F.sort_array(F.collect_list(F.when(c, F.col("polity")))), ", ")
    return cells.groupBy("story_id", "actor").agg(pick(F.col("named") == F.col("evaluable")).alias("all_named"), pick(F.col("named") == 0).alias("none_named"))


def story_languages(rows: DataFrame, limit: int = 4) -> DataFrame:
    """(story_id, language, n, more): the most frequent languages and how many others there are."""
    per = rows.groupBy("story_id", "language").agg(F.count("*").alias("n"))
    w = Window.partitionBy("story_id")
    nth = F.row_number().over(w.orderBy(F.desc("n"), F.asc_nulls_last("language")))
    return per.withColumn("k", nth).withColumn("more", F.greatest(F.count("*").over(w) - limit, F.lit(0))).filter(F.col("k") <= limit).drop("k")


def cadence(runs: DataFrame) -> DataFrame:
    """(run, minutes): minutes since the run before; runs holds one row per run."""
    second = F.unix_seconds(F.to_timestamp(F.regexp_replace("run", "[TZ]", ""), "yyyyMMddHHmmss"))
    w = Window.partitionBy(F.lit(0)).orderBy("run")  # ingest batches, not data
    return runs.select("run", F.floor((second - F.lag(second).over(w)) / 60).alias("minutes"))


def drawable(series: DataFrame, keys: list[str], least: int = 3) -> DataFrame:
    """(keys, weight, days, drawn): a line is drawn with two days of at least `least` sources; the rest is thin."""
    return series.groupBy(*keys).agg(F.sum("evaluable").alias("weight"), F.count_if(F.col("evaluable") >= least).alias("days")).withColumn("drawn", F.col("days") >= 2)


def rate_line(series: DataFrame, keys: list[str], least: int = 3) -> DataFrame:
    """(keys, first_rate, last_rate, points, thin): naming rate at the first and last day with enough sources."""
    enough = F.col("evaluable") >= least
    rate = F.round(100.0 * F.col("named") / F.col("evaluable"), 1)
    return series.groupBy(*keys).agg(
        F.min_by(F.when(enough, rate), F.when(enough, F.col("day"))).alias("first_rate"), F.max_by(F.when(enough, rate), F.when(enough, F.col("day"))).alias("last_rate"),
        F.count_if(enough).alias("points"), F.count_if(~enough).alias("thin"),
    )


def pooled(cells: DataFrame) -> DataFrame:
    """(story_id, actor, polity, named, evaluable): polities with too few sources as one row without a name."""
    name = F.when(~F.col("thin"), F.col("polity"))
    return cells.groupBy("story_id", "actor", name.alias("polity")).agg(F.sum("named").alias("named"), F.sum("evaluable").alias("evaluable"))


def fit_budget(rows: DataFrame, budget: int, group: str, order: list, cost: Column) -> DataFrame:
    """Rows of each group, best first, while their summed cost stays within the budget."""
    spent = F.sum(cost).over(Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("spent", spent).filter(F.col("spent") <= budget)


def map_cell(lat: Column, lon: Column, width: int = 76, height: int = 22, top: float = 84.0, bottom: float = -57.0) -> tuple[Column, Column]:
    """Column and row of a place on an equirectangular grid, kept inside it."""
    x = F.floor((lon + 180.0) / 360.0 * width)
    y = F.floor((top - lat) / (top - bottom) * height)
    inside = lambda v, n: F.when(v.isNotNull(), F.greatest(F.lit(0), F.least(v, F.lit(n - 1))))
    return inside(x, width), inside(y, height)


def map_position(lat: Column, lon: Column, projection: dict) -> tuple[Column, Column]:
    """Column and row of a place as fractions of a raster's cells, in the projection that the raster's file states."""
    left, right, top, bottom = (float(projection[k]) for k in ("lon_left", "lon_right", "lat_top", "lat_bottom"))
    return (lon - left) / (right - left) * projection["width"], (F.lit(top) - lat) / (top - bottom) * projection["height"]


def map_panel(cells: DataFrame, coordinates: DataFrame) -> DataFrame:
    """(story_id, actor, polity, named, evaluable, state, x, y): thin, most or few; x and y are null off the map."""
    state = F.when(F.col("evaluable") < 3, "thin").when(F.col("named") / F.col("evaluable") > 0.5, "most").otherwise("few")
    x, y = map_cell(F.col("lat"), F.col("lon"))
    return cells.join(F.broadcast(coordinates), "polity", "left").select("story_id", "actor", "polity", "named", "evaluable", state.alias("state"), x.alias("x"), y.alias("y"))


def slug(c: Column) -> Column:
    from parallax.functions.text import fold

    return F.regexp_replace(F.regexp_replace(fold(c), "[^a-z0-9]+", "-"), "^-|-$", "")


def display_name(key: Column, label: Column) -> Column:
    """An actor's label, else its key with the words after hyphens capitalised."""
    words = F.transform(F.split(key, "-"), lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30)))
    return F.coalesce(label, F.array_join(words, " "))
