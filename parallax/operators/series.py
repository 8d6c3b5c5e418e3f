"""Runs over time: captures, the index, selection of the day, and the rolling series."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parallax.params import DEFAULT, Params

STAMP = "yyyyMMdd'T'HHmmss'Z'"


def shift(stamp: Column, hours: int) -> Column:
    """A run's stamp some hours later, or earlier if negative."""
    moved = F.try_to_timestamp(F.regexp_replace(stamp, r"^(\d{8})T(\d{6})Z$", "$1$2+00:00"), F.lit("yyyyMMddHHmmssXXX")) + F.expr(f"INTERVAL {hours} HOURS")
    return F.date_format(moved, STAMP)


def heartbeats(spark, newest: str, count: int, lag_minutes: int = 25) -> DataFrame:
    """(k, slot): the quarter hours that can be published by `newest` (a run's stamp), newest first."""
    at = F.unix_seconds(F.to_timestamp(F.lit(newest), STAMP)) - lag_minutes * 60
    slot = F.floor(at / 900) * 900 - F.col("id") * 900
    return spark.range(count).select(F.col("id").alias("k"), F.date_format(F.timestamp_seconds(slot), "yyyyMMddHHmmss").alias("slot"))


def missing_slots(rows: DataFrame, slot: str = "slot") -> DataFrame:
    """(slot): quarter hours between the first and the last slot of rows that no row has."""
    seen = rows.select(F.col(slot).alias("slot")).distinct()
    span = seen.agg(F.min("slot").alias("a"), F.max("slot").alias("b"))
    second = lambda c: F.unix_seconds(F.to_timestamp(F.col(c), "yyyyMMddHHmmss"))
    expected = span.select(F.explode(F.sequence(second("a"), second("b"), F.lit(900))).alias("s")).select(F.date_format(F.timestamp_seconds("s"), "yyyyMMddHHmmss").alias("slot"))
    return expected.join(seen, "slot", "left_anti")


def capture_new(batch: DataFrame, window: DataFrame, url: str = "url") -> DataFrame:
    """Rows of a batch whose address the previous window doesn't have; repeats inside the batch stay."""
    return batch.join(window.select(url).distinct(), url, "left_anti")


def earliest_capture(index: DataFrame, captures: DataFrame) -> DataFrame:
    """(evidence_id, capture_id): for each row of the index the earliest capture of its address, no later than its run.

    The earliest capture of an address is the same for all its rows, so captures shrink to one row per address before the
    join.
    """
    first = captures.filter("url is not null").groupBy("url").agg(F.min(F.struct("run", "capture_id")).alias("first"))
    return index.join(first, "url").filter(F.col("first.run") <= F.col("run")).select("evidence_id", F.col("first.capture_id").alias("capture_id"))


def accumulate(previous: DataFrame, folded: DataFrame, batch: DataFrame, params: Params = DEFAULT) -> tuple[DataFrame, DataFrame]:
    """(series, folded): add a batch of runs to the series, once each, and drop days out of range of the newest.

    previous: actor, polity, day, named, evaluable; folded: run; batch: run and the same counts. Runs folded before are left
    out, so a replay changes nothing.
    """
    fresh = batch.join(folded, "run", "left_anti")
    rows = fresh.select("actor", "polity", F.to_date(F.substring("run", 1, 8), "yyyyMMdd").alias("day"), "named", "evaluable")
    sums = previous.select("actor", "polity", "day", "named", "evaluable").unionByName(rows).groupBy("actor", "polity", "day").agg(F.sum("named").alias("named"), F.sum("evaluable").alias("evaluable"))
    newest = F.broadcast(sums.agg(F.max("day").alias("newest")))  # one row
    kept = sums.join(newest, F.col("day") > F.date_sub("newest", params.series_days)).drop("newest")
    return kept, folded.unionByName(fresh.select("run").distinct()).distinct()


def _recent(history: DataFrame, hours: int) -> DataFrame:
    """Rows no more than some hours before the newest run; all of them without a newest run."""
    newest = F.broadcast(history.agg(F.max("run").alias("_newest")))  # one row
    return history.join(newest, F.col("_newest").isNull() | (F.col("run") >= shift(F.col("_newest"), -hours))).drop("_newest")


def peaks(history: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """(id, peak): the widest division of each story within the span before the newest run."""
    return _recent(history, params.span_hours).filter("division is not null").groupBy("id").agg(F.max("division").alias("peak"))


def verdict_band(p: Column, powered: Column) -> Column:
    """0 shown to follow the polity, 1 not told, 2 refuted."""
    return F.when(p <= 0.05, 0).when(p.isNull() | ~F.coalesce(powered, F.lit(False)), 1).otherwise(2)


def select_featured(live: DataFrame, history: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """(id, band, span_division, position, featured): live stories by verdict band, then by the day's widest division.

    live: id, band, division, story_no (the order among equals).
    """
    ranked = live.join(peaks(history, params), "id", "left")
    ranked = ranked.withColumn("span_division", F.round(F.greatest(F.coalesce("division", F.lit(0.0)), F.coalesce("peak", F.lit(0.0))), 4))
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("band", F.desc("span_division"), "story_no")) - 1  # live stories of one run
    return ranked.select("id", "band", "span_division", place.alias("position")).withColumn("featured", F.col("position") < params.featured)


def gone(live: DataFrame, history: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """(id, peak) of stories of the span that the current run doesn't carry."""
    return peaks(history, params).join(live.select("id"), "id", "left_anti")


def story_series(history: DataFrame, ids: DataFrame, params: Params = DEFAULT) -> DataFrame:
    """(id, run, division): the last points of each story within the series' window; runs without division are no points."""
    rows = _recent(history, params.series_hours).filter("division is not null").join(ids.select("id").distinct(), "id", "left_semi")
    nth = F.row_number().over(Window.partitionBy("id").orderBy(F.desc("run")))
    return rows.withColumn("_n", nth).filter(F.col("_n") <= params.series_points).select("id", "run", "division")


def feed_entries(now: DataFrame, history: DataFrame) -> DataFrame:
    """(id, headline): stories shown now and not in the newest run of the history that shows any, XML-escaped."""
    shown = history.filter("shown")
    newest = F.broadcast(shown.agg(F.max("run").alias("_newest")))  # one row
    before = shown.join(newest, F.col("run") == F.col("_newest")).select("id").distinct()
    text = F.col("headline")
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(a), F.lit(b))
    return now.filter("shown").join(before, "id", "left_anti").select("id", text.alias("headline"))
