"""What a run leaves behind: tables as the truth, and packed documents made from them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def append_run(df: DataFrame, path: str) -> None:
    """Add rows to a table partitioned by run; earlier runs aren't read."""
    df.write.mode("append").partitionBy("run").parquet(path)


def overwrite_state(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").parquet(path)


def packed_series(series: DataFrame) -> DataFrame:
    """(actor, polities): a row per actor, its polities to [day index, named, evaluable] triples, days numbered from 0.

    series: actor, polity, day, named, evaluable. Days are a short dimension.
    """
    days = F.broadcast(series.select("day").distinct().agg(F.sort_array(F.collect_set("day")).alias("index")))  # days of a window
    at = (F.array_position("index", F.col("day")) - 1).cast("bigint")
    rows = series.join(days).groupBy("actor", "polity").agg(F.sort_array(F.collect_list(F.array(at, F.col("named").cast("bigint"), F.col("evaluable").cast("bigint")))).alias("points"))
    return rows.groupBy("actor").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("polity", "points")))).alias("polities"))


def story_documents(stories: DataFrame, figures: DataFrame, evidence: DataFrame | None = None) -> DataFrame:
    """(story_id, document): each story with its figures, and its evidence if given, as one JSON text."""
    parts = figures.groupBy("story_id").agg(F.sort_array(F.collect_list(F.struct(*[c for c in figures.columns if c != "story_id"]))).alias("figures"))
    whole = stories.join(parts, "story_id", "left")
    if evidence is not None:
        order = [F.col("polity").isNull().alias("_unplaced"), "polity", "language", "domain", "url"]
        others = [c for c in evidence.columns if c not in ("story_id", "polity", "language", "domain", "url", "marks", "wrote")]
        shown = evidence.groupBy("story_id").agg(F.sort_array(F.collect_list(F.struct(*order, *others))).alias("evidence"))
        whole = whole.join(shown, "story_id", "left")
    return whole.select("story_id", F.to_json(F.struct(*whole.columns)).alias("document"))


def feed_document(entries: DataFrame, run: str) -> str:
    """A feed of all entries of one run, as text, by the span's division; entries (already escaped) are a run's new stories."""
    rows = entries.orderBy(F.desc_nulls_last("span_division"), "id").toLocalIterator() if "span_division" in entries.columns else entries.orderBy("id").toLocalIterator()
    body = "".join(f"<entry><id>{r['id']}</id><title>{r['headline']}</title><updated>{run}</updated></entry>" for r in rows)
    return f'<?xml version="1.0" encoding="utf-8"?><feed xmlns="http://www.w3.org/2005/Atom"><updated>{run}</updated>{body}</feed>'


def alias_documents(table: DataFrame, missing: DataFrame | None = None) -> DataFrame:
    """(actor, document): each actor's aliases by language, keys in order, and the languages it has none in, as JSON."""
    per = table.groupBy("actor", "language").agg(F.transform(F.sort_array(F.collect_list(F.struct("ord", "alias"))), lambda x: x["alias"]).alias("aliases"))
    packed = per.groupBy("actor").agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("language", "aliases")))).alias("table"))
    if missing is not None:
        packed = packed.join(missing.groupBy("actor").agg(F.sort_array(F.collect_set("language")).alias("missing")), "actor", "left")
    return packed.select("actor", F.to_json(F.struct(*[c for c in packed.columns if c != "actor"])).alias("document"))
