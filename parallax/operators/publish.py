"""What a run publishes: evidence, verdicts, the index and the order of stories, from rows to documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parallax.operators import measure, resolve
from parallax.params import DEFAULT, Params

# Labels of an emotion classifier by bucket, with the bucket's weight in the risk.
EMOTIONS = {
    "fear": (1.2, ("fear", "nervousness", "anxiety", "confusion")),
    "anger": (1.3, ("anger", "annoyance", "disapproval", "disgust", "frustration")),
    "sadness": (1.1, ("sadness", "grief", "remorse", "disappointment", "embarrassment")),
    "surprise": (0.8, ("surprise", "realization", "curiosity", "excitement", "joy", "pride")),
    "positive": (0.5, ("optimism", "relief", "gratitude", "approval", "love", "admiration", "desire", "caring")),
}


def collapse_counts(rows: DataFrame, kept: DataFrame, story: str = "story_id") -> DataFrame:
    """(story, n_rows, kept, dropped): what the collapse left of each story."""
    n = rows.groupBy(story).agg(F.count("*").alias("n_rows"))
    k = kept.groupBy(story).agg(F.count("*").alias("kept"))
    return n.join(k, story, "left").select(story, "n_rows", F.coalesce("kept", F.lit(0)).alias("kept"), (F.col("n_rows") - F.coalesce("kept", F.lit(0))).alias("dropped"))


def marked(rows: DataFrame, aliases: DataFrame, languages: DataFrame, keep_id: str = "evidence_id") -> DataFrame:
    """rows with marks and wrote made anew from their titles: actor to mark, and actor to the spelling found."""
    long = resolve.resolve(rows.select(keep_id, "title", "language"), aliases, languages)
    packed = long.groupBy(keep_id).agg(F.map_from_entries(F.sort_array(F.collect_list(F.struct("actor", "mark")))).alias("marks"), F.map_from_entries(F.sort_array(F.collect_list(F.struct("actor", "spelling")))).alias("wrote"))
    return rows.drop("marks", "wrote").join(packed, keep_id)


def evidence_rows(rows: DataFrame, band: DataFrame | None = None, story: str = "story_id", keep_id: str = "evidence_id") -> DataFrame:
    """One row per voice of each story with its marks and spellings, and its position in the story.

    By polity, then language, then publisher, rows without polity last; of banded stories only if a band is given. rows has
    been collapsed.
    """
    if band is not None:
        rows = rows.join(band.select(story), story, "left_semi")
    order = [F.col("polity").isNull(), "polity", F.asc_nulls_first("language"), F.asc_nulls_first("domain"), "url", keep_id]
    return rows.withColumn("position", F.row_number().over(Window.partitionBy(story).orderBy(*order)).cast("bigint"))


def english_first(rows: DataFrame, story: str = "story_id", keep_id: str = "evidence_id", name: str = "ENGLISH", code: str = "en") -> DataFrame:
    """(story, id, headline): the representative title among a story's English rows, among all where it has none."""
    english = F.lower(F.trim(F.coalesce("language", F.lit("")))).isin(name.lower(), code)
    flagged = rows.withColumn("_english", english)
    any_english = flagged.filter("_english").select(story).distinct().withColumn("_any", F.lit(True))
    chosen = flagged.join(any_english, story, "left").filter(F.col("_any").isNull() | F.col("_english"))
    return measure.representative(chosen.drop("_english", "_any"), story, keep_id)


def lead_figures(figs: DataFrame, band: DataFrame, story: str = "story_id") -> DataFrame:
    """The figure of each banded story's first actor by name."""
    first = band.select(story, F.element_at(F.split("band", ","), 1).alias("actor"))
    return figs.join(first, [story, "actor"], "left_semi")


def display_order(stories: DataFrame) -> DataFrame:
    """(story_id, place): stories with a band and evidence in the order they are shown.

    stories: story_id, featured, position, span_division, division, evidence. If any is featured, these come first, then
    by the selection's position and the span's division; else by the division of the lead figure. Ties go to story_id.
    """
    shown = stories.filter("evidence > 0 and division is not null")
    chosen = F.broadcast(shown.agg(F.coalesce(F.max("featured"), F.lit(False)).alias("_any")))  # one row
    place = Window.partitionBy(F.lit(0)).orderBy("_first", "_second", F.desc("_third"), "story_id")  # stories of one run
    keyed = shown.join(chosen).select(
        "story_id", F.when(F.col("_any"), ~F.coalesce("featured", F.lit(False))).otherwise(False).alias("_first"), F.when(F.col("_any"), F.coalesce("position", F.lit(0))).otherwise(0).alias("_second"),
        F.when(F.col("_any"), F.coalesce("span_division", F.lit(0.0))).otherwise(F.col("division")).alias("_third"),
    )
    return keyed.select("story_id", (F.row_number().over(place)).cast("bigint").alias("place"))


def verdict_label(p: Column, powered: Column) -> Column:
    """found, unknown or none: whether a split follows the polity, can't be told, or doesn't; null without a test."""
    return F.when(p <= 0.05, "found").when(p.isNotNull() & ~F.coalesce(powered, F.lit(False)), "unknown").when(p.isNotNull(), "none")


def country_verdicts(tests: DataFrame, cells: DataFrame, keys: tuple[str, ...] = ("story_id", "actor"), params: Params = DEFAULT) -> DataFrame:
    """(keys, verdict, shown, thin_polities, thin_named, thin_evaluable): the test's verdict beside the pooled thin polities."""
    thin = F.col("evaluable") < params.thin
    pooled = cells.groupBy(*keys).agg(
        F.count_if(~thin).alias("shown"), F.count_if(thin).alias("thin_polities"), F.coalesce(F.sum(F.when(thin, F.col("named"))), F.lit(0)).alias("thin_named"), F.coalesce(F.sum(F.when(thin, F.col("evaluable"))), F.lit(0)).alias("thin_evaluable"),
    )
    return pooled.join(tests.select(*keys, verdict_label(F.col("p"), F.col("powered")).alias("verdict")), list(keys), "left")


def exact_structure(table: DataFrame, keys: tuple[str, ...] = ("story_id", "actor")) -> DataFrame:
    """(keys, p): the exact permutation p value of groups with two polities, where the test draws at random.

    With two polities the named count of the first follows the hypergeometric distribution; p is the share of its
    outcomes with at least the observed bits between polity and mark. Groups that the test leaves out are left out.
    """
    cells = table.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("polity", "named", "evaluable"))).alias("c")).filter(F.size("c") == 2)  # two rows a group
    a, b = F.col("c")[0], F.col("c")[1]
    base = cells.select(*keys, a["evaluable"].alias("x"), b["evaluable"].alias("y"), (a["named"] + b["named"]).alias("k"), a["named"].alias("seen")).filter("x + y >= 4 and k > 0 and k < x + y")
    # logarithms of binomial coefficients as sums: outcomes are at most as many as the smaller polity's sources
    log_c = lambda n, r: f"aggregate(sequence(1L, greatest({r}, 1L)), 0D, (s, i) -> s + CASE WHEN {r} >= 1 THEN ln({n} - {r} + i) - ln(i) ELSE 0D END)"
    outcomes = base.withColumn("o", F.explode(F.expr("sequence(greatest(0L, k - y), least(k, x))")))
    part = lambda c, n, m: f"CASE WHEN {c} > 0 THEN {c} / (x + y) * log2({c} * (x + y) / ({n} * {m})) ELSE 0D END"
    bits = lambda o: " + ".join([part(o, "x", "k"), part(f"(k - {o})", "y", "k"), part(f"(x - {o})", "x", "(x + y - k)"), part(f"(y - k + {o})", "y", "(x + y - k)")])
    weight = F.expr(f"exp({log_c('x', 'o')} + {log_c('y', '(k - o)')} - {log_c('(x + y)', 'k')})")
    return outcomes.groupBy(*keys).agg(F.round(F.sum(F.when(F.expr(f"({bits('o')}) >= ({bits('seen')}) - 1e-12"), weight).otherwise(0.0)), 6).alias("p"))


def emotion(predictions: DataFrame, key: str = "id") -> DataFrame:
    """(key, emotion, bias_risk) from predictions (key, label, score): the bucket of the likeliest label and its weighted score.

    A label outside the buckets is neutral at weight 1; the risk is a whole number of at most 100.
    """
    top = predictions.groupBy(key).agg(F.max(F.struct("score", "label")).alias("x"))
    label = F.lower("x.label")
    bucket, weight = F.lit("neutral"), F.lit(1.0)
    for name, (by, labels) in EMOTIONS.items():
        bucket, weight = F.when(label.isin(*labels), name).otherwise(bucket), F.when(label.isin(*labels), by).otherwise(weight)
    return top.select(key, bucket.alias("emotion"), F.least(F.floor(F.col("x.score") * 100 * weight), F.lit(100)).cast("int").alias("bias_risk"))


def index_rows(rows: DataFrame, figs: DataFrame, band: DataFrame, headlines: DataFrame, tests: DataFrame | None = None, story: str = "story_id") -> DataFrame:
    """One slim row per banded story: headline, band, division of its lead figure, sources, polities, addresses, and the test's scalars."""
    lead = lead_figures(figs, band, story).select(story, "actor", "division")
    per = rows.groupBy(story).agg(F.count("*").alias("sources"), F.count_distinct("polity").alias("polities"), F.sort_array(F.collect_set("url")).alias("urls"))  # one story's voices
    out = band.select(story, "band").join(lead, story).join(per, story).join(headlines.select(story, "headline"), story)
    if tests is not None:
        scalars = tests.select(story, "actor", F.struct("p", "powered", "sources", "polities").alias("structure"))
        out = out.join(scalars, [story, "actor"], "left")
    return out
