"""Windows of article records in gzipped JSON lines, with a count of what doesn't parse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parallax.operators.dims import authority_domain

RECORD = "url string, title string, lang string, date string, docembed array<float>"


def read_window(spark: SparkSession, paths: list[str], slots: list[str], dim: int = 512) -> DataFrame:
    """One row per line that isn't blank: slot, slot_rank, line_no, ok, and the record's fields where it is sound.

    slots names the paths' stamps in order, newest first; row order is slot order, then line order within a file (a
    gzipped file is read by one task). A record is sound if it has a url and a vector of `dim` numbers.
    """
    order = spark.createDataFrame([(p.rsplit("/", 1)[-1], s, k) for k, (p, s) in enumerate(zip(paths, slots))], "file string, slot string, slot_rank int")
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_name").alias("file"), F.monotonically_increasing_id().alias("line_no")).filter("trim(value) <> ''")
    parsed = lines.withColumn("r", F.from_json("value", RECORD, {"mode": "PERMISSIVE"}))
    ok = F.coalesce(F.col("r.url").isNotNull() & (F.size("r.docembed") == dim) & ~F.exists("r.docembed", lambda x: x.isNull()), F.lit(False))
    title, lang, date = F.coalesce("r.title", F.lit("")), F.coalesce("r.lang", F.lit("unknown")), F.coalesce("r.date", F.lit(""))
    return parsed.join(F.broadcast(order), "file").select(
        "slot", "slot_rank", "line_no", ok.alias("ok"), F.when(ok, F.col("r.url")).alias("url"), title.alias("title"), authority_domain(F.col("r.url")).alias("domain"), lang.alias("language"), date.alias("seen_at"), F.when(ok, F.col("r.docembed")).alias("embedding"),
    )


def articles(window: DataFrame) -> DataFrame:
    """The sound records; of an address that occurs again, all rows stay (grouping uses them all)."""
    return window.filter("ok").drop("ok")


def last_by_url(rows: DataFrame) -> DataFrame:
    """One row per address: the last in row order, as a mapping would keep it."""
    others = [c for c in rows.columns if c != "url"]
    last = rows.groupBy("url").agg(F.max_by(F.struct(*others), F.struct("slot_rank", "line_no")).alias("x"))
    return last.select("url", "x.*")


def report(window: DataFrame, requested: list[str]) -> DataFrame:
    """(slots_requested, slots_missing, lines_seen, lines_unparsed, parse_fidelity): what a window's parse amounted to."""
    seen = window.agg(F.count("*").alias("lines_seen"), F.count_if(~F.col("ok")).alias("lines_unparsed"), F.collect_set("slot").alias("got"))
    asked = F.array(*[F.lit(s) for s in requested]) if requested else F.array().cast("array<string>")
    share = F.when(F.col("lines_seen") > 0, F.round((F.col("lines_seen") - F.col("lines_unparsed")) / F.col("lines_seen"), 6)).otherwise(F.lit(0.0))
    return seen.select(F.lit(len(requested)).alias("slots_requested"), F.array_except(asked, "got").alias("slots_missing"), "lines_seen", "lines_unparsed", share.alias("parse_fidelity"))


def number_rows(rows: DataFrame) -> DataFrame:
    """Add row_idx, dense in row order, by counts per slot and places within a slot."""
    per = rows.groupBy("slot_rank").agg(F.count("*").alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy(F.lit(0)).orderBy("slot_rank").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # one row per slot
    place = F.row_number().over(Window.partitionBy("slot_rank").orderBy("line_no")) - 1
    return rows.withColumn("_p", place).join(F.broadcast(per.select("slot_rank", before.alias("_b"))), "slot_rank").withColumn("row_idx", F.col("_p") + F.col("_b")).drop("_p", "_b")
