"""Mixing sources to target weights (problem 9).

A low-discrepancy source schedule: slot i of the mixture has the point frac(i x golden ratio), which falls into one source's
interval of the cumulative weights. Slots are ranked per source, and the r-th slot of a source takes the r-th of its
blocks of shuffled documents; blocks begin every BLOCK tokens of the source's shuffled token line, so any number of
consecutive blocks holds so many times BLOCK tokens, but for one document. Past the last block the source is repeated.
What the last whole document leaves of a source's part is filled with the largest documents left that fit, of all of them.

Running sums and ranks are taken in two levels (within chunks of bounded size, over the sums of chunks), so a source with
a third of all documents is no single task. Tables per source and per chunk are small; nothing else is broadcast.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parallax.functions.lineage import cut

#: Tokens of a block; rows of a chunk in two-level sums.
BLOCK = 4096
CHUNK = 20_000
GOLDEN = 0.6180339887498949


def _supplies(sizes: DataFrame, targets: DataFrame) -> list[dict]:
    """(source, target_share, max_repeats, docs, tokens, supply) of each target: what a source can give at most."""
    per = sizes.filter("source is not null").groupBy("source").agg(F.count("*").alias("docs"), F.sum("size").alias("tokens"))
    wish = targets.filter("source is not null and target_share > 0").groupBy("source").agg(F.sum("target_share").alias("target_share"), F.min("max_repeats").alias("max_repeats"))
    plan = wish.join(per, "source", "left").withColumn("supply", F.coalesce(F.col("tokens"), F.lit(0)) * F.greatest(F.coalesce("max_repeats", F.lit(1)), F.lit(0)))
    return [r.asDict() for r in plan.orderBy("source").collect()]  # one per target, a parameter table


def corpus_total(sized: DataFrame, targets: DataFrame, source: str = "source", size: str = "n_tokens") -> int:
    """The size of all documents of sources with a target: a mixture as large as what it is drawn from."""
    return sum(r["tokens"] or 0 for r in _supplies(_sizes(sized, None, source, size), targets))


def reachable_total(sized: DataFrame, targets: DataFrame, source: str = "source", size: str = "n_tokens") -> int:
    """The largest total at which every source with documents reaches its share within its max_repeats."""
    able = [r for r in _supplies(_sizes(sized, None, source, size), targets) if r["supply"] > 0]
    whole = sum(r["target_share"] for r in able)
    return int(min((r["supply"] * whole / r["target_share"] for r in able), default=0))


def _sizes(sized: DataFrame, id_col: str | None, source: str, size: str) -> DataFrame:
    ids = [F.col(f"`{id_col}`").alias("id")] if id_col else []
    return sized.select(*ids, F.col(f"`{source}`").alias("source"), F.col(f"`{size}`").cast("long").alias("size")).filter("size > 0 and source is not null")


def _plan(sizes: DataFrame, targets: DataFrame, total: int) -> DataFrame:
    """_supplies with wanted, granted, weight (the share of what is granted) and the source's interval of the cumulative weights."""
    rows = _supplies(sizes, targets)
    able = [r for r in rows if r["supply"] > 0]
    whole = sum(r["target_share"] for r in able)
    for r in rows:
        r["weight"] = r["target_share"] / whole if r["supply"] > 0 else 0.0
        r["wanted"] = int(total * r["weight"])
        r["granted"] = min(r["wanted"], r["supply"] or 0)
    edge, given = 0.0, sum(r["granted"] for r in rows)
    for r in rows:  # the schedule follows what is granted, so that a source that falls short is spread like the others
        r["weight"] = r["granted"] / given if given else 0.0
        r["low"], edge = edge, edge + r["weight"]
        r["high"] = edge
    able = [r for r in rows if r["granted"] > 0]
    if able:
        able[-1]["high"] = 1.0 + 1e-9
    schema = "source string, target_share double, max_repeats int, docs bigint, tokens bigint, supply bigint, weight double, wanted bigint, granted bigint, low double, high double"
    return sizes.sparkSession.createDataFrame([[r[c.split()[0]] for c in schema.split(", ")] for r in rows], schema)


def _running(df: DataFrame, group: str, chunk: str, order: list[str], value: str, out: str) -> DataFrame:
    """Add the sum of `value` over the rows of the group before this one; chunks are numbered in order."""
    sums = cut(df.groupBy(group, chunk).agg(F.sum(value).alias("_sum")), "sums")
    before = F.coalesce(F.sum("_sum").over(Window.partitionBy(group).orderBy(chunk).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sums.select(group, chunk, before.alias("_offset"))
    within = F.coalesce(F.sum(value).over(Window.partitionBy(group, chunk).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return df.withColumn("_within", within).join(offsets.hint("merge"), [group, chunk]).withColumn(out, F.col("_within") + F.col("_offset")).drop("_within", "_offset")


def draw(sized: DataFrame, targets: DataFrame, total: int, id_col: str = "doc_id", source: str = "source", size: str = "n_tokens", block: int = BLOCK, seed: int = 17) -> tuple[DataFrame, DataFrame]:
    """(mixture, shares). mixture: (slot, source, doc_id, repeat, n_tokens), one row per drawing of a document.

    total is the size of the mixture (corpus_total, reachable_total or any other). A source without documents can't be
    drawn: its share stays 0 and the others share its part. A source whose capped supply is below its part gives all of it
    and falls short: its actual share is below its target. No source goes above its part. Documents without source or
    target, and those of size 0 or null, are not drawn. No document is drawn more than max_repeats times (null counts as
    1). id_col must be unique. Empty tables give an empty mixture; other columns are ignored.

    shares: (source, target_share, docs, tokens, max_repeats, wanted, drawn_docs, drawn_tokens, actual_share, most_repeats).
    """
    spark = sized.sparkSession
    docs = cut(_sizes(sized, id_col, source, size), "sizes")
    plan = cut(_plan(docs, targets, total), "plan")
    # shuffled token lines
    chunks = max(1, docs.count() // CHUNK)
    line = docs.join(F.broadcast(plan.filter("granted > 0").select("source")), "source")
    line = line.withColumn("key", F.xxhash64("id", F.lit(seed)))
    # chunk numbers follow the order of the key: its upper bits
    line = line.withColumn("chunk", F.floor(F.shiftrightunsigned("key", 32) * F.lit(chunks) / F.lit(1 << 32)))
    line = line.withColumn("key", F.struct(F.shiftrightunsigned("key", 32), F.col("key"), F.col("id")))
    line = cut(_running(line, "source", "chunk", ["key"], "size", "at").select("source", "id", "size", "at", "key"), "line")
    # slots; each source gets as many as its granted tokens take, in the order of the schedule
    # so many that each source has a slot for each of its blocks, with two to spare for the discrepancy of the points
    needed = plan.filter("granted > 0").agg(F.max((F.ceil(F.col("granted") / block) + 2) / F.col("weight"))).first()[0]
    slots = int(needed or 0) + 1
    schedule = spark.range(slots).select(F.col("id").alias("slot"), F.expr(f"pmod(cast(id + 1 as double) * {GOLDEN}D, 1D)").alias("point"))
    bands = F.broadcast(plan.filter("granted > 0").select("source", "low", "high"))
    schedule = schedule.join(bands, (F.col("point") >= F.col("low")) & (F.col("point") < F.col("high"))).select("slot", "source", F.lit(1).alias("one"), F.floor(F.col("slot") / CHUNK).alias("chunk"))
    ranked = _running(schedule, "source", "chunk", ["slot"], "one", "rank").select("slot", "source", "rank")
    # the granted tokens of a source as whole token lines and a part of one: a document starting at `at` of repeat p
    # starts at p x tokens + at of what is granted
    lines = F.broadcast(plan.filter("granted > 0").select("source", F.col("tokens").alias("whole"), "granted"))
    drawn = line.join(lines, "source").withColumn("repeat", F.explode(F.expr("sequence(0L, (granted - 1) div whole)")))
    drawn = drawn.withColumn("start", F.col("repeat") * F.col("whole") + F.col("at"))
    inside = F.col("start") + F.col("size") <= F.col("granted")
    taken = drawn.filter(inside).select("source", "id", "size", "repeat", F.expr(f"start div {block}").alias("rank"))
    sums_of = taken.groupBy("source").agg(F.sum("size").alias("got"))
    left = cut(plan.filter("granted > 0").join(sums_of, "source", "left").select("source", "granted", (F.col("granted") - F.coalesce("got", F.lit(0))).alias("gap")), "left")  # one row per source
    # what is left of a part is filled from the documents that its last repeat hasn't taken, the largest that fit first
    behind = line.join(lines, "source").withColumn("repeat", F.expr("(granted - 1) div whole")).withColumn("start", F.col("repeat") * F.col("whole") + F.col("at")).filter(~inside)
    behind = behind.drop("granted").join(F.broadcast(left), "source").filter(F.col("size") <= F.col("gap")).select("source", "id", "size", "repeat", "key", "gap", "granted")
    counts = behind.groupBy("source", "size").agg(F.count("*").alias("n"), F.first("gap").alias("gap"))  # one row per source and size

    def fill(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("size", ascending=False)
        gap, times = int(part["gap"].iloc[0]), []
        for n, k in zip(part["size"].tolist(), part["n"].tolist()):
            times.append(min(k, gap // n))
            gap -= n * times[-1]
        return part.assign(times=times)[["source", "size", "times"]]

    chosen = cut(counts.groupBy("source").applyInPandas(fill, "source string, size bigint, times bigint").filter("times > 0"), "chosen")
    nth = F.row_number().over(Window.partitionBy("source", "size").orderBy("key"))
    filled = behind.join(chosen.hint("merge"), ["source", "size"]).withColumn("nth", nth).filter("nth <= times")
    drawn = taken.unionByName(filled.select("source", "id", "size", "repeat", F.expr(f"(granted - 1) div {block}").alias("rank")))
    mixture = drawn.join(ranked.hint("merge"), ["source", "rank"]).select("slot", "source", F.col("id").alias(id_col), (F.col("repeat") + 1).cast("int").alias("repeat"), F.col("size").alias("n_tokens"))
    mixture = cut(mixture, "mixture")
    got = mixture.groupBy("source").agg(F.count("*").alias("drawn_docs"), F.sum("n_tokens").alias("drawn_tokens"), F.max("repeat").alias("most_repeats"))
    shares = plan.join(got, "source", "left").crossJoin(F.broadcast(got.agg(F.sum("drawn_tokens").alias("_all"))))  # one row
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    shares = shares.select(
        "source", "target_share", zero("docs").alias("docs"), zero("tokens").alias("tokens"), "max_repeats", "wanted", zero("drawn_docs").alias("drawn_docs"),
        zero("drawn_tokens").alias("drawn_tokens"), F.coalesce(F.col("drawn_tokens") / F.col("_all"), F.lit(0.0)).alias("actual_share"), zero("most_repeats").cast("int").alias("most_repeats"),
    )
    return mixture, shares
