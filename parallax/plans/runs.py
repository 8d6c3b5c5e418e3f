"""Queries of sources, captures, the index and series, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from parallax.operators import assemble, measure, mining, series
from parallax.params import Params
from parallax.plans.measuring import FIGURES, FLOORS, MARKS, marks_of
from parallax.plans.registry import query
from parallax.sources import gkg
from parallax.sources.tables import table
from parallax.streaming import daily

SPAN = Params(span_hours=72, series_hours=240, series_points=5, featured=5)


@query("slot_enumeration", "SELECT i AS k, strftime(TIMESTAMP '2026-04-16 11:30:00' - to_minutes(15 * i), '%Y%m%d%H%M%S') AS slot FROM range(64) t(i)")
def slot_enumeration(spark, folder):
    return series.heartbeats(spark, "20260416T120000Z", 64)


@query(
    "missing_slots",
    "WITH s AS (SELECT DISTINCT slot FROM gkg WHERE slot IS NOT NULL), x AS (SELECT unnest(generate_series(strptime(min(slot), '%Y%m%d%H%M%S'), strptime(max(slot), '%Y%m%d%H%M%S'), INTERVAL 15 MINUTE)) AS t FROM s) "
    "SELECT strftime(t, '%Y%m%d%H%M%S') AS slot FROM x WHERE strftime(t, '%Y%m%d%H%M%S') NOT IN (SELECT slot FROM s)",
)
def missing_slots(spark, folder):
    return series.missing_slots(table(spark, folder, "gkg"))


_SPLIT = "WITH f AS (SELECT line_id, slot, feed, string_split(line, chr(9)) AS f FROM gkg_raw WHERE line <> '')"


@query("parse_fidelity", _SPLIT + " SELECT feed, count(*) AS lines_seen, count(*) FILTER (len(f) <> 27) AS wrong_width, count(*) FILTER (len(f) = 27 AND trim(f[5]) = '') AS no_url, round(count(*) FILTER (len(f) = 27 AND trim(f[5]) <> '') / count(*), 6) AS fidelity FROM f GROUP BY feed")
def parse_fidelity(spark, folder):
    return gkg.fidelity(gkg.fields(table(spark, folder, "gkg_raw")))


_DECODED = _SPLIT + """
, d AS (SELECT line_id, slot, feed, trim(f[5]) AS url,
  array_to_string(list_filter(list_transform(list_filter(string_split(f[10], ';'), lambda x: len(string_split(x, '#')) > 1), lambda x: trim(split_part(x, '#', 2))), lambda x: x <> ''), '|') AS locations,
  array_to_string(list_filter(list_transform(string_split(f[24], ';'), lambda x: trim(regexp_replace(x, ',[^,]*$', ''))), lambda x: x <> ''), '|') AS names,
  array_to_string(list_filter(list_transform(string_split(f[12], ';'), lambda x: trim(x)), lambda x: x <> ''), '|') AS persons,
  array_to_string(list_filter(list_transform(string_split(f[14], ';'), lambda x: trim(x)), lambda x: x <> ''), '|') AS organisations
  FROM f WHERE len(f) = 27 AND trim(f[5]) <> '')
"""


@query("gkg_decode", _DECODED + "SELECT line_id, url, locations, names, persons, organisations FROM d")
def gkg_decode(spark, folder):
    rows = gkg.decoded(gkg.fields(table(spark, folder, "gkg_raw")))
    return rows.select("line_id", "url", *[F.array_join(c, "|").alias(c) for c in ("locations", "names", "persons", "organisations")])


@query("gkg_merge", _DECODED + "SELECT url, line_id FROM (SELECT url, line_id, row_number() OVER (PARTITION BY url ORDER BY slot, feed DESC, line_id DESC) AS k FROM d) WHERE k = 1")
def gkg_merge(spark, folder):
    return gkg.merged(gkg.decoded(gkg.fields(table(spark, folder, "gkg_raw")))).select("url", "line_id")


@query("gkg_join_rate", "WITH k AS (SELECT DISTINCT url FROM gkg WHERE url IS NOT NULL), u AS (SELECT url, count(*) AS n FROM capture WHERE url IS NOT NULL GROUP BY url) SELECT CAST(sum(n) AS BIGINT) AS asked, count(*) FILTER (url IN (SELECT url FROM k)) AS matched, round(count(*) FILTER (url IN (SELECT url FROM k)) / sum(n), 4) AS rate FROM u")
def gkg_join_rate(spark, folder):
    return gkg.join_rate(table(spark, folder, "capture"), table(spark, folder, "gkg"))


@query("capture_new", "WITH b AS (SELECT run FROM (SELECT DISTINCT run FROM capture) QUALIFY row_number() OVER (ORDER BY run DESC) <= 60) SELECT capture_id, url FROM capture WHERE run IN (SELECT run FROM b) AND url NOT IN (SELECT url FROM capture WHERE run NOT IN (SELECT run FROM b) AND url IS NOT NULL)")
def capture_new(spark, folder):
    """The last 60 runs as a batch, the runs before as the window."""
    rows = table(spark, folder, "capture").filter("url is not null")
    last = F.broadcast(rows.select("run").distinct().orderBy(F.desc("run")).limit(60))  # ids of runs
    return series.capture_new(rows.join(last, "run", "left_semi"), rows.join(last, "run", "left_anti")).select("capture_id", "url")


@query("earliest_capture", "WITH f AS (SELECT url, min(struct_pack(run := run, capture_id := capture_id)) AS first FROM capture WHERE url IS NOT NULL GROUP BY url) SELECT e.evidence_id, first.capture_id AS capture_id FROM evidence e JOIN f USING (url) WHERE first.run <= e.run")
def earliest_capture(spark, folder):
    return series.earliest_capture(table(spark, folder, "evidence"), table(spark, folder, "capture"))


@query("index_rows", FIGURES + ", best AS (SELECT *, max(division) OVER (PARTITION BY story_id) AS best FROM figures WHERE measurable AND division > 0.005), b AS (SELECT story_id, string_agg(actor, ',' ORDER BY actor) AS band, max(best) AS division FROM best WHERE division >= best - 0.005 GROUP BY story_id), s AS (SELECT run, story_id, count(*) AS sources, count(DISTINCT polity) AS polities, count(DISTINCT url) AS urls FROM evidence GROUP BY ALL) SELECT s.run, s.story_id, band, division, sources, polities, urls FROM s JOIN b USING (story_id)")
def index_rows(spark, folder):
    """The slim append-only record of banded stories."""
    rows = table(spark, folder, "evidence")
    band = measure.top_band(measure.figures(marks_of(spark, folder), FLOORS), FLOORS)
    per = rows.groupBy("run", "story_id").agg(F.count("*").alias("sources"), F.count_distinct("polity").alias("polities"), F.count_distinct("url").alias("urls"))
    return per.join(band, "story_id").select("run", "story_id", "band", "division", "sources", "polities", "urls")


_BATCH = MARKS + ", batch AS (SELECT run, actor, polity, count(*) FILTER (mark = 'present') AS named, count(*) AS evaluable FROM marks WHERE mark <> 'unresolved' AND polity IS NOT NULL GROUP BY ALL)"
_SERIES = _BATCH + ", series AS (SELECT actor, polity, strptime(run[1:8], '%Y%m%d')::DATE AS day, CAST(sum(named) AS BIGINT) AS named, CAST(sum(evaluable) AS BIGINT) AS evaluable FROM batch GROUP BY ALL)"


def batch_of(spark, folder):
    return measure.by_polity(marks_of(spark, folder), ("run", "actor")).drop("thin")


def series_of(spark, folder, params=SPAN):
    """The series after two batches, the second of which repeats runs of the first."""
    batch = batch_of(spark, folder)
    empty = spark.createDataFrame([], "actor string, polity string, day date, named bigint, evaluable bigint")
    halfway = F.col("run") < "20260401T000000Z"
    one, folded = series.accumulate(empty, spark.createDataFrame([], "run string"), batch.filter(halfway), params)
    return series.accumulate(one, folded, batch, params)[0]


@query("series_accumulate", _SERIES + " SELECT * FROM series WHERE day > (SELECT max(day) FROM series) - 90")
def series_accumulate(spark, folder):
    return series_of(spark, folder)


_HISTORY = """
WITH base AS (SELECT strftime(ts, '%Y%m%d') || 'T000000Z' AS run, 'u' || (user_id % 40) AS id, count(*) FILTER (value > 50) AS named, count(*) AS evaluable FROM events GROUP BY ALL),
history AS (SELECT run, id, named, evaluable, CASE WHEN evaluable >= 3 THEN round(CASE WHEN named <= 0 OR named >= evaluable THEN 0.0 ELSE -((named / evaluable) * log2(named / evaluable) + (1 - named / evaluable) * log2(1 - named / evaluable)) END, 4) END AS division FROM base),
past AS (SELECT * FROM history WHERE run < (SELECT max(run) FROM history)), live AS (SELECT * FROM history WHERE run = (SELECT max(run) FROM history) AND evaluable >= 5),
span AS (SELECT * FROM past WHERE run >= strftime(strptime((SELECT max(run) FROM past), '%Y%m%dT%H%M%SZ') - INTERVAL 72 HOURS, '%Y%m%dT%H%M%SZ')),
peaks AS (SELECT id, max(division) AS peak FROM span WHERE division IS NOT NULL GROUP BY id)
"""


def history_of(spark, folder):
    """(run, id, named, evaluable, division): days as runs, groups of users as stories."""
    rows = table(spark, folder, "events").select(F.concat(F.date_format("ts", "yyyyMMdd"), F.lit("T000000Z")).alias("run"), F.concat(F.lit("u"), (F.col("user_id") % 40).cast("string")).alias("id"), "value")
    per = rows.groupBy("run", "id").agg(F.count_if(F.col("value") > 50).alias("named"), F.count("*").alias("evaluable"))
    return per.withColumn("division", F.when(F.col("evaluable") >= 3, F.round(measure.entropy(F.col("named"), F.col("evaluable")), 4)))


def _live_and_past(spark, folder):
    rows = history_of(spark, folder)
    newest = F.broadcast(rows.agg(F.max("run").alias("newest")))  # one row
    both = rows.join(newest)
    live = both.filter("run = newest and evaluable >= 5").withColumn("band", F.when(F.col("evaluable") >= 6, 0).otherwise(1)).withColumn("story_no", F.expr("cast(substring(id, 2) as int)"))
    return live.drop("newest"), both.filter("run < newest").drop("newest")


@query("peak_divisions", _HISTORY + "SELECT * FROM peaks")
def peak_divisions(spark, folder):
    return series.peaks(_live_and_past(spark, folder)[1], SPAN)


@query("feature_selection", _HISTORY + ", r AS (SELECT live.id, CASE WHEN evaluable >= 6 THEN 0 ELSE 1 END AS band, round(greatest(coalesce(division, 0.0), coalesce(peak, 0.0)), 4) AS span_division, CAST(live.id[2:] AS INT) AS story_no FROM live LEFT JOIN peaks USING (id)), p AS (SELECT id, band, span_division, CAST(row_number() OVER (ORDER BY band, span_division DESC, story_no) - 1 AS INT) AS position FROM r) SELECT *, position < 5 AS featured FROM p")
def feature_selection(spark, folder):
    live, past = _live_and_past(spark, folder)
    return series.select_featured(live.select("id", "band", "division", "story_no"), past, SPAN)


@query("gone_stories", _HISTORY + "SELECT id, peak FROM peaks WHERE id NOT IN (SELECT id FROM live)")
def gone_stories(spark, folder):
    live, past = _live_and_past(spark, folder)
    return series.gone(live, past, SPAN)


@query("story_series", _HISTORY + ", s AS (SELECT run, id, division, row_number() OVER (PARTITION BY id ORDER BY run DESC) AS k FROM past WHERE division IS NOT NULL AND id IN (SELECT id FROM live) AND run >= strftime(strptime((SELECT max(run) FROM past), '%Y%m%dT%H%M%SZ') - INTERVAL 240 HOURS, '%Y%m%dT%H%M%SZ')) SELECT id, run, division FROM s WHERE k <= 5")
def story_series(spark, folder):
    live, past = _live_and_past(spark, folder)
    return series.story_series(past, live, SPAN)


@query("feed_entries", _HISTORY + ", shown AS (SELECT * FROM past WHERE division >= 0.98), newest AS (SELECT max(run) AS run FROM shown) SELECT id, id || ' &amp; &lt;' || named || '&gt;' AS headline FROM live WHERE division >= 0.98 AND id NOT IN (SELECT id FROM shown WHERE run = (SELECT run FROM newest))")
def feed_entries(spark, folder):
    live, past = _live_and_past(spark, folder)
    shown = F.coalesce(F.col("division") >= 0.98, F.lit(False))
    head = F.concat("id", F.lit(" & <"), F.col("named").cast("string"), F.lit(">"))
    return series.feed_entries(live.withColumn("shown", shown).withColumn("headline", head), past.withColumn("shown", shown))


@query("verdict_bands", MARKS + ", s AS (SELECT story_id, actor, count(*) AS n, count(DISTINCT polity) AS g, count(*) FILTER (mark = 'present') AS named FROM marks WHERE mark <> 'unresolved' AND polity IS NOT NULL GROUP BY ALL), v AS (SELECT story_id, actor, CASE WHEN named > 0 THEN round(1 - named / n, 4) END AS p, n >= 20 AND g >= 4 AS powered FROM s) SELECT story_id, actor, CASE WHEN p <= 0.05 THEN 0 WHEN p IS NULL OR NOT powered THEN 1 ELSE 2 END AS band FROM v")
def verdict_bands(spark, folder):
    """The bands of a stand-in statistic that SQL has too."""
    known = marks_of(spark, folder).filter((F.col("mark") != "unresolved") & F.col("polity").isNotNull())
    per = known.groupBy("story_id", "actor").agg(F.count("*").alias("n"), F.count_distinct("polity").alias("g"), F.count_if(F.col("mark") == "present").alias("named"))
    p = F.when(F.col("named") > 0, F.round(1 - F.col("named") / F.col("n"), 4))
    return per.select("story_id", "actor", series.verdict_band(p, (F.col("n") >= 20) & (F.col("g") >= 4)).alias("band"))


@query("stamp_shift", "SELECT DISTINCT run, strftime(strptime(run, '%Y%m%dT%H%M%SZ') - INTERVAL 16 HOURS, '%Y%m%dT%H%M%SZ') AS cutoff FROM capture")
def stamp_shift(spark, folder):
    return table(spark, folder, "capture").select("run").distinct().select("run", series.shift(F.col("run"), -16).alias("cutoff"))


_CAP = "regexp_matches(w, '^\\p{Lu}') AND NOT (length(w) > 1 AND w = upper(w))"


@query(
    "candidate_terms",
    f"""WITH t AS (SELECT capture_id, language, domain, regexp_extract_all(coalesce(title, ''), '\\p{{L}}+') AS ws FROM capture),
    x AS (SELECT capture_id, language, domain, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM t WHERE len(ws) >= 3),
    c AS (SELECT *, i - row_number() OVER (PARTITION BY capture_id ORDER BY i) AS island FROM x WHERE i > 1 AND {_CAP}),
    runs AS (SELECT capture_id, any_value(language) AS language, any_value(domain) AS domain, string_agg(w, ' ' ORDER BY i) AS term FROM c GROUP BY capture_id, island),
    per AS (SELECT term, count(DISTINCT language) AS languages, count(DISTINCT domain) AS domains FROM runs GROUP BY term HAVING count(DISTINCT language) >= 4 AND count(DISTINCT domain) >= 10),
    seen AS (SELECT lower(w) AS word, avg(CASE WHEN regexp_matches(w, '^\\p{{Lu}}') THEN 1.0 ELSE 0.0 END) AS capitalised FROM x GROUP BY 1)
    SELECT term, languages, domains, round(capitalised, 4) AS capitalised FROM per JOIN seen ON seen.word = lower(split_part(term, ' ', 1)) WHERE capitalised >= 0.8""",
)
def candidate_terms(spark, folder):
    return mining.candidate_terms(table(spark, folder, "capture"))


@query("ngram_minutes", "WITH s AS (SELECT DISTINCT slot[1:10] AS hour, CAST(slot[11:12] AS INT) AS m FROM gkg_raw WHERE slot IS NOT NULL), n AS (SELECT hour, unnest([m - 1, m, m + 1]) AS m FROM s) SELECT DISTINCT hour || lpad(CAST(m AS VARCHAR), 2, '0') AS minute FROM n WHERE m BETWEEN 0 AND 59")
def ngram_minutes(spark, folder):
    return assemble.minutes(table(spark, folder, "gkg_raw").filter("slot is not null"), "slot")


@query("assembled_titles")
def assembled_titles(spark, folder):
    """The texts of all documents cut into overlapping pieces and put together again; url is the document's id."""
    bodies = assemble.assembled(assemble.fragments_of(table(spark, folder, "documents")))
    characters = F.translate(F.replace("body", F.lit(" "), F.lit("")), assemble.GAP, " ")
    return bodies.select(F.substring("url", 2, 1 << 30).alias("url"), F.when(F.col("url").startswith("c"), characters).otherwise(F.col("body")).alias("body"))


@query("stream_daily_counts", "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY ALL")
def stream_daily_counts(spark, folder):
    """The events as a stream, counted per day to the end."""
    source = table(spark, folder, "events")
    stream = spark.readStream.schema(source.schema).parquet(f"{folder}/events.parquet*")
    return daily.run_to_end(spark, daily.daily_counts(stream), "daily", "complete")


@query("session_counts", "WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) >= INTERVAL 30 MINUTE THEN 1 ELSE 0 END AS cut FROM events), s AS (SELECT user_id, ts, sum(cut) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM g) SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS started, count(*) AS n FROM s GROUP BY user_id, k")
def session_counts(spark, folder):
    return daily.sessions(table(spark, folder, "events"))
