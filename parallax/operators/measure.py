"""Figures of a story: who names whom, how evenly, and whether the split follows the polity of publication."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parallax.functions.text import normalise_title
from parallax.params import DEFAULT, Params


def collapse(rows: DataFrame, story: str = "story_id", keep_id: str = "evidence_id") -> DataFrame:
    """One row per voice and story: in order of url, a row whose normalised title or domain was already kept is dropped.

    Rows of one story with one title and domain share their fate but for the first, so only the first of them is shuffled
    to the story's task; that streams over them and holds the kept titles and domains of one story at a time.
    """
    title = normalise_title(F.coalesce("title", F.lit("")))
    keyed = rows.select(F.col(story).alias("story"), title.alias("t"), F.coalesce("domain", F.lit("")).alias("d"), F.struct(F.coalesce("url", F.lit("")).alias("url"), F.col(keep_id).alias("id")).alias("at"))
    first = keyed.groupBy("story", "t", "d").agg(F.min("at").alias("at")).select("story", "t", "d", "at.url", "at.id")

    def greedy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        story_now, titles, domains = None, set(), set()
        for batch in batches:
            out = []
            for s, t, d, i in zip(*(batch.column(c).to_pylist() for c in ("story", "t", "d", "id"))):
                if s != story_now:
                    story_now, titles, domains = s, set(), set()
                if t not in titles and d not in domains:
                    titles.add(t)
                    domains.add(d)
                    out.append(i)
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.int64())], names=["id"])

    kept = first.repartition("story").sortWithinPartitions("story", "url", "id").mapInArrow(greedy, "id bigint")
    return rows.join(kept, rows[keep_id] == kept["id"], "left_semi")


def long_marks(rows: DataFrame, marks: str = "marks") -> DataFrame:
    """One row per row and actor: the columns but the map, actor and mark."""
    return rows.select(*[c for c in rows.columns if c not in (marks, "wrote")], F.explode(marks).alias("actor", "mark"))


def entropy(named: Column, evaluable: Column) -> Column:
    """Binary entropy of the naming rate: 0 if unanimous or not evaluable."""
    p = named / F.nullif(evaluable, F.lit(0))
    return F.when((evaluable <= 0) | (named <= 0) | (named >= evaluable), F.lit(0.0)).otherwise(-(p * F.log2(p) + (1 - p) * F.log2(1 - p)))


def figures(marks: DataFrame, params: Params = DEFAULT, story: str = "story_id") -> DataFrame:
    """(story, actor, named, evaluable, unresolved, polities, measurable, division, balanced_rate) from long marks.

    division and balanced_rate (the mean over languages of the naming rate) are given where the evaluable rows and the
    story's polities reach the floors. Counts are summed per language first: one shuffle of small partial sums.
    """
    known = F.col("mark") != "unresolved"
    named = F.col("mark") == "present"
    per = marks.groupBy(story, "actor", "language").agg(F.count_if(named).alias("n"), F.count_if(known).alias("e"), F.count_if(~known).alias("u"))
    rate = F.avg(F.when(F.col("e") > 0, F.col("n") / F.col("e")))
    out = per.groupBy(story, "actor").agg(F.sum("n").alias("named"), F.sum("e").alias("evaluable"), F.sum("u").alias("unresolved"), rate.alias("balanced"))
    placed = marks.groupBy(story).agg(F.count_distinct("polity").alias("polities"))
    measurable = (F.col("evaluable") >= params.min_evaluable) & (F.col("polities") >= params.min_polities)
    out = out.join(placed, story).withColumn("measurable", measurable)
    return out.select(
        story, "actor", "named", "evaluable", "unresolved", "polities", "measurable",
        F.when(F.col("measurable"), F.round(entropy(F.col("named"), F.col("evaluable")), 4)).alias("division"),
        F.when(F.col("measurable"), F.round("balanced", 4)).alias("balanced_rate"),
    )


def by_polity(marks: DataFrame, keys: tuple[str, ...] = ("story_id", "actor"), params: Params = DEFAULT) -> DataFrame:
    """(keys, polity, named, evaluable, thin): counts of evaluable rows with a polity."""
    known = marks.filter((F.col("mark") != "unresolved") & F.col("polity").isNotNull())
    return known.groupBy(*keys, "polity").agg(F.count_if(F.col("mark") == "present").alias("named"), F.count("*").alias("evaluable")).withColumn("thin", F.col("evaluable") < params.thin)


def top_band(figs: DataFrame, params: Params = DEFAULT, story: str = "story_id") -> DataFrame:
    """(story, band, division): the actors within the tolerance of a story's widest division, by name."""
    best = figs.filter("measurable and division > %s" % params.band_tolerance).withColumn("best", F.max("division").over(Window.partitionBy(story)))
    near = best.filter(F.col("division") >= F.col("best") - params.band_tolerance)
    return near.groupBy(story).agg(F.array_join(F.sort_array(F.collect_list("actor")), ",").alias("band"), F.max("best").alias("division"))


def mutual_information(table: DataFrame, keys: tuple[str, ...] = ("story_id", "actor")) -> DataFrame:
    """(keys, information): bits between polity and mark, from the counts of by_polity."""
    w = Window.partitionBy(*keys)
    cells = table.withColumn("n", F.sum("evaluable").over(w)).withColumn("hits", F.sum("named").over(w)).withColumn("misses", F.col("n") - F.col("hits"))
    part = lambda c, m: F.when((c > 0) & (m > 0), c / F.col("n") * F.log2(c * F.col("n") / (F.col("evaluable") * m))).otherwise(F.lit(0.0))
    return cells.groupBy(*keys).agg(F.round(F.greatest(F.lit(0.0), F.sum(part(F.col("named"), F.col("hits")) + part(F.col("evaluable") - F.col("named"), F.col("misses")))), 4).alias("information"))


def _information(counts: np.ndarray, sizes: np.ndarray, named: int) -> np.ndarray:
    """Bits between polity and mark for each row of counts of named sources per polity."""
    n = sizes.sum()
    total = np.zeros(len(counts))
    for part, margin in ((counts, named), (sizes - counts, n - named)):
        with np.errstate(divide="ignore", invalid="ignore"):
            x = part / n * np.log2(part * n / (sizes * margin))
        total += np.where(part > 0, x, 0).sum(1)
    return np.maximum(total, 0)


def structure_test(table: DataFrame, keys: tuple[str, ...] = ("story_id", "actor"), params: Params = DEFAULT, seed: int = 0) -> DataFrame:
    """(keys, sources, polities, p, floor, powered): does the split follow the polity, by permutation of the marks.

    table is that of by_polity. A permutation of marks over fixed polities draws the named counts per polity from the
    multivariate hypergeometric distribution, so a group is as small as its number of polities, however many its rows.
    Groups with fewer than 4 sources or 2 polities, or without variation, can't be asked and are left out.
    """

    def test(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("polity")
        sizes, hits = part["evaluable"].to_numpy(), part["named"].to_numpy()
        n, named = int(sizes.sum()), int(hits.sum())
        head = part.iloc[:1][list(keys)].reset_index(drop=True)
        if n < 4 or len(sizes) < 2 or named in (0, n):
            return head.iloc[:0].assign(sources=0, polities=0, p=0.0, floor=0.0, powered=False)
        observed = _information(hits[None].astype(float), sizes.astype(float), named)[0]
        draws = np.random.default_rng(seed).multivariate_hypergeometric(sizes, named, size=params.rounds, method="marginals")
        beaten = int((_information(draws.astype(float), sizes.astype(float), named) >= observed - 1e-12).sum())
        powered = n >= params.powered_sources and len(sizes) >= params.powered_polities
        return head.assign(sources=n, polities=len(sizes), p=round((beaten + 1) / (params.rounds + 1), 4), floor=round(1 / (params.rounds + 1), 4), powered=powered)

    schema = ", ".join(f"{k} string" for k in keys) + ", sources bigint, polities bigint, p double, floor double, powered boolean"
    # the counts are small and the draws are not: a fixed number of tasks, which the runtime doesn't merge by size
    tasks = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return table.repartition(tasks, *keys).groupBy(*keys).applyInPandas(test, schema)


def representative(rows: DataFrame, story: str = "story_id", keep_id: str = "evidence_id") -> DataFrame:
    """(story, id, headline): the title of which most words are used by other titles too; the longer of equals."""
    words = F.array_distinct(F.regexp_extract_all(F.lower(F.coalesce("title", F.lit(""))), F.lit(r"[\p{L}\p{N}_]+"), F.lit(0)))
    base = rows.select(F.col(story).alias("story_id"), F.col(keep_id).alias("id"), F.coalesce("title", F.lit("")).alias("title"), F.coalesce("url", F.lit("")).alias("url"), words.alias("words"))
    uses = base.select("story_id", F.explode("words").alias("word")).groupBy("story_id", "word").agg(F.count("*").alias("uses"))
    shared = base.select("story_id", "id", F.explode("words").alias("word")).join(uses, ["story_id", "word"]).groupBy("story_id", "id").agg(F.avg(F.when(F.col("uses") > 1, 1.0).otherwise(0.0)).alias("score"))
    best = base.join(shared, ["story_id", "id"], "left").withColumn("rank", F.struct(F.coalesce("score", F.lit(-1.0)).alias("s"), F.length("title").alias("l")))
    # the best first, then the first url: one maximum per story, no sort of its rows
    top = best.groupBy("story_id").agg(F.max("rank").alias("rank"))
    ties = best.join(top, ["story_id", "rank"]).groupBy("story_id").agg(F.min(F.struct("url", "id", "title")).alias("x"))
    return ties.select("story_id", F.col("x.id").alias(keep_id), F.col("x.title").alias("headline"))
