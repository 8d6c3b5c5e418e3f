"""Queries from rows to published stories, chained on one another, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from parallax.functions.lineage import cut
from parallax.functions.text import fold
from parallax.operators import dims, measure, mining, publish, reads, resolve, series
from parallax.plans.measuring import _ALIASES, _H, _RESOLVED, FLOORS, MARKS, folded, lower, marks_of, spaces
from parallax.plans.registry import SQL, query
from parallax.plans.runs import SPAN
from parallax.sources import gkg
from parallax.sources.tables import table

#: The greedy collapse, row by row in order of url within each story.
COLLAPSED = f"""
WITH RECURSIVE ordered AS (SELECT story_id, evidence_id, {spaces(lower("coalesce(title, '')"))} AS t, coalesce(domain, '') AS d, row_number() OVER (PARTITION BY story_id ORDER BY coalesce(url, ''), evidence_id) AS k FROM evidence),
walk AS (SELECT DISTINCT story_id, CAST(0 AS BIGINT) AS k, CAST([] AS VARCHAR[]) AS ts, CAST([] AS VARCHAR[]) AS ds, CAST(NULL AS BIGINT) AS evidence_id FROM ordered
  UNION ALL SELECT o.story_id, o.k, CASE WHEN fresh THEN list_append(ts, t) ELSE ts END, CASE WHEN fresh THEN list_append(ds, d) ELSE ds END, CASE WHEN fresh THEN o.evidence_id END
  FROM (SELECT o.*, ts, ds, NOT list_contains(ts, t) AND NOT list_contains(ds, d) AS fresh FROM walk w JOIN ordered o ON o.story_id = w.story_id AND o.k = w.k + 1) o),
kept AS (SELECT e.* FROM evidence e JOIN walk USING (evidence_id))
"""
_MARKED = COLLAPSED + ", marks AS (SELECT k.* EXCLUDE (marks, wrote), unnest(map_keys(marks)) AS actor, unnest(map_values(marks)) AS mark FROM kept k)\n"
_FIGURES = _MARKED + f"""
, per AS (SELECT story_id, actor, language, count(*) FILTER (mark = 'present') AS n, count(*) FILTER (mark <> 'unresolved') AS e, count(*) FILTER (mark = 'unresolved') AS u FROM marks GROUP BY ALL),
sums AS (SELECT story_id, actor, CAST(sum(n) AS BIGINT) AS named, CAST(sum(e) AS BIGINT) AS evaluable, CAST(sum(u) AS BIGINT) AS unresolved, avg(CASE WHEN e > 0 THEN n / e END) AS balanced FROM per GROUP BY ALL),
placed AS (SELECT story_id, count(DISTINCT polity) AS polities FROM marks GROUP BY ALL),
figures AS (SELECT s.story_id, actor, named, evaluable, unresolved, polities, evaluable >= 8 AND polities >= 2 AS measurable,
  CASE WHEN evaluable >= 8 AND polities >= 2 THEN round({_H}, 4) END AS division, CASE WHEN evaluable >= 8 AND polities >= 2 THEN round(balanced, 4) END AS balanced_rate
  FROM sums s JOIN placed p ON s.story_id = p.story_id),
best AS (SELECT *, max(division) OVER (PARTITION BY story_id) AS best FROM figures WHERE measurable AND division > 0.005),
band AS (SELECT story_id, string_agg(actor, ',' ORDER BY actor) AS band, max(best) AS division FROM best WHERE division >= best - 0.005 GROUP BY story_id)
"""


def collapsed(spark, folder):
    return measure.collapse(table(spark, folder, "evidence"))


def story_parts(spark, folder):
    """(rows, marks, figures, band) of collapsed stories, the rows written once."""
    rows = cut(collapsed(spark, folder), "voices")
    marks = measure.long_marks(rows)
    figs = cut(measure.figures(marks, FLOORS), "figures")
    return rows, marks, figs, measure.top_band(figs, FLOORS)


@query("collapse_counts", COLLAPSED + "SELECT e.story_id, count(*) AS n_rows, count(k.evidence_id) AS kept, count(*) - count(k.evidence_id) AS dropped FROM evidence e LEFT JOIN (SELECT evidence_id FROM kept) k USING (evidence_id) GROUP BY ALL")
def collapse_counts(spark, folder):
    return publish.collapse_counts(table(spark, folder, "evidence"), collapsed(spark, folder))


@query("voices", COLLAPSED + "SELECT story_id, evidence_id FROM kept")
def voices(spark, folder):
    return collapsed(spark, folder).select("story_id", "evidence_id")


@query("voice_figures", _FIGURES + "SELECT * FROM figures")
def voice_figures(spark, folder):
    return measure.figures(measure.long_marks(collapsed(spark, folder)), FLOORS)


_TEXT = "array_to_string(list_transform(list_sort(map_keys({c})), lambda a: a || '=' || coalesce({c}[a], '-')), ',')"


def _packed(c):
    return F.array_join(F.transform(F.sort_array(F.map_keys(c)), lambda a: F.concat(a, F.lit("="), F.coalesce(F.element_at(c, a), F.lit("-")))), ",")


@query(
    "evidence_documents",
    _FIGURES + f"SELECT story_id, evidence_id, row_number() OVER (PARTITION BY story_id ORDER BY polity IS NULL, polity, language NULLS FIRST, domain NULLS FIRST, url, evidence_id) AS position, {_TEXT.replace('{c}', 'marks')} AS marks, {_TEXT.replace('{c}', 'wrote')} AS wrote FROM kept WHERE story_id IN (SELECT story_id FROM band)",
)
def evidence_documents(spark, folder):
    """The evidence of banded stories: one row per voice, with its marks and spellings, in the order shown."""
    rows, _, _, band = story_parts(spark, folder)
    shown = publish.evidence_rows(rows, band)
    return shown.select("story_id", "evidence_id", "position", _packed(F.col("marks")).alias("marks"), _packed(F.col("wrote")).alias("wrote"))


@query("lead_figures", _FIGURES + "SELECT f.story_id, f.actor, f.named, f.evaluable, f.division FROM figures f JOIN band b ON f.story_id = b.story_id AND f.actor = split_part(b.band, ',', 1)")
def lead_figures(spark, folder):
    _, _, figs, band = story_parts(spark, folder)
    return publish.lead_figures(figs, band).select("story_id", "actor", "named", "evaluable", "division")


_HEADLINES = f"""
, pick AS (SELECT *, lower(trim(coalesce(language, ''))) IN ('english', 'en') AS english FROM kept), has AS (SELECT story_id, bool_or(english) AS any_english FROM pick GROUP BY story_id),
b AS (SELECT story_id, evidence_id, coalesce(title, '') AS title, coalesce(url, '') AS url, list_distinct(regexp_extract_all({lower("coalesce(title, '')")}, '[\\p{{L}}\\p{{N}}_]+')) AS words FROM pick JOIN has USING (story_id) WHERE english OR NOT any_english),
x AS (SELECT story_id, evidence_id, unnest(words) AS word FROM b), u AS (SELECT story_id, word, count(*) AS uses FROM x GROUP BY ALL),
s AS (SELECT x.story_id, x.evidence_id, avg(CASE WHEN uses > 1 THEN 1.0 ELSE 0.0 END) AS score FROM x JOIN u ON x.story_id = u.story_id AND x.word = u.word GROUP BY ALL),
heads AS (SELECT story_id, evidence_id, title AS headline FROM (SELECT b.*, row_number() OVER (PARTITION BY b.story_id ORDER BY coalesce(score, -1.0) DESC, length(title) DESC, url, b.evidence_id) AS k FROM b LEFT JOIN s ON b.evidence_id = s.evidence_id AND b.story_id = s.story_id) WHERE k = 1)
"""


@query("english_headlines", COLLAPSED + _HEADLINES + "SELECT * FROM heads")
def english_headlines(spark, folder):
    """The representative title of each story, an English one where it has any."""
    return publish.english_first(cut(collapsed(spark, folder), "voices"))


@query(
    "story_index",
    _FIGURES + _HEADLINES + ", per AS MATERIALIZED (SELECT story_id, count(*) AS sources, count(DISTINCT polity) AS polities, string_agg(DISTINCT url, ' ' ORDER BY url) AS urls FROM kept GROUP BY ALL)".replace(", per AS", ", sized AS")
    + " SELECT b.story_id, headline, b.band, f.division, sources, z.polities, urls FROM band b JOIN figures f ON f.story_id = b.story_id AND f.actor = split_part(b.band, ',', 1) JOIN sized z ON z.story_id = b.story_id JOIN heads h ON h.story_id = b.story_id",
)
def story_index(spark, folder):
    """From rows to the index of banded stories: collapse, figures, band, headline, sources, addresses."""
    rows, _, figs, band = story_parts(spark, folder)
    out = publish.index_rows(rows, figs, band, publish.english_first(rows))
    return out.select("story_id", "headline", "band", "division", "sources", "polities", F.array_join("urls", " ").alias("urls"))


@query("run_documents")
def run_documents(spark, folder):
    """The whole run: articles with addresses, titles and languages to stories with figures, test, selection and order.

    Marks are resolved anew from titles. The test draws at random, so there is no SQL for the whole; each stage has its own.
    """
    rows = cut(collapsed(spark, folder), "voices")
    rows = cut(publish.marked(rows, table(spark, folder, "actor_alias"), table(spark, folder, "language_code")), "marked")
    marks = measure.long_marks(rows)
    figs = cut(measure.figures(marks, FLOORS), "figures")
    band = cut(measure.top_band(figs, FLOORS), "band")
    tests = measure.structure_test(measure.by_polity(marks), params=FLOORS)
    index = cut(publish.index_rows(rows, figs, band, publish.english_first(rows), tests), "index")
    runs = rows.groupBy("story_id").agg(F.max("run").alias("run"))
    lead = index.join(runs, "story_id")
    newest = F.broadcast(lead.agg(F.max("run").alias("_newest")))  # one row
    history = lead.join(newest, F.col("run") < F.col("_newest")).select("run", F.col("story_id").alias("id"), "division")
    live = lead.select(F.col("story_id").alias("id"), series.verdict_band(F.col("structure.p"), F.col("structure.powered")).alias("band"), "division", F.col("story_id").alias("story_no"))
    chosen = series.select_featured(live, history, SPAN).select(F.col("id").alias("story_id"), "featured", "position", "span_division")
    placed = publish.display_order(index.join(chosen, "story_id").withColumn("evidence", F.col("sources")))
    verdict = publish.verdict_label(F.col("structure.p"), F.col("structure.powered"))
    return index.join(chosen, "story_id").join(placed, "story_id").select("story_id", "place", "headline", "band", "division", "span_division", "sources", "polities", verdict.alias("verdict"), "featured")


@query(
    "display_order",
    _FIGURES + "SELECT story_id, row_number() OVER (ORDER BY division DESC, story_id) - 1 + 1 AS place FROM (SELECT b.story_id, f.division FROM band b JOIN figures f ON f.story_id = b.story_id AND f.actor = split_part(b.band, ',', 1))",
)
def display_order(spark, folder):
    """Banded stories without a selection: by the division of their lead figures."""
    rows, _, figs, band = story_parts(spark, folder)
    stories = publish.lead_figures(figs, band).select("story_id", "division").withColumn("featured", F.lit(False)).withColumn("position", F.lit(0)).withColumn("span_division", F.lit(0.0)).withColumn("evidence", F.lit(1))
    return publish.display_order(stories)


_CHOOSE = "exp(lgamma({n} + 1) - lgamma({r} + 1) - lgamma({n} - {r} + 1))"


def _bits(o):
    part = lambda c, n, m: f"CASE WHEN {c} > 0 THEN {c} / (x + y) * log2({c} * (x + y) / ({n} * {m})) ELSE 0.0 END"
    return " + ".join([part(o, "x", "k"), part(f"(k - {o})", "y", "k"), part(f"(x - {o})", "x", "(x + y - k)"), part(f"(y - k + {o})", "y", "(x + y - k)")])


@query(
    "exact_structure",
    MARKS + ", cells AS (SELECT story_id, actor, polity, count(*) FILTER (mark = 'present') AS named, count(*) AS evaluable FROM marks WHERE mark <> 'unresolved' AND polity IS NOT NULL GROUP BY ALL), "
    "g AS (SELECT story_id, actor, arg_min(evaluable, polity) AS x, arg_max(evaluable, polity) AS y, CAST(sum(named) AS BIGINT) AS k, arg_min(named, polity) AS seen FROM cells GROUP BY ALL HAVING count(*) = 2), "
    "o AS (SELECT *, unnest(range(greatest(0, k - y), least(k, x) + 1)) AS o FROM g WHERE x + y >= 4 AND k > 0 AND k < x + y) "
    f"SELECT story_id, actor, round(sum(CASE WHEN ({_bits('o')}) >= ({_bits('seen')}) - 1e-12 THEN {_CHOOSE.format(n='x', r='o')} * {_CHOOSE.format(n='y', r='(k - o)')} / {_CHOOSE.format(n='(x + y)', r='k')} ELSE 0.0 END), 6) AS p FROM o GROUP BY ALL",
)
def exact_structure(spark, folder):
    """The permutation test's exact value where two polities name an actor."""
    return publish.exact_structure(measure.by_polity(marks_of(spark, folder)))


_CELLS = "SELECT story_id, actor, polity, count(*) FILTER (mark = 'present') AS named, count(*) AS evaluable FROM marks WHERE mark <> 'unresolved' AND polity IS NOT NULL GROUP BY ALL"


@query(
    "pooled_verdicts",
    MARKS + f", cells AS ({_CELLS}), g AS (SELECT story_id, actor, count(*) FILTER (evaluable >= 3) AS shown, count(*) FILTER (evaluable < 3) AS thin_polities, CAST(coalesce(sum(named) FILTER (evaluable < 3), 0) AS BIGINT) AS thin_named, CAST(coalesce(sum(evaluable) FILTER (evaluable < 3), 0) AS BIGINT) AS thin_evaluable, "
    "count(*) >= 2 AND sum(evaluable) >= 4 AND sum(named) > 0 AND sum(named) < sum(evaluable) AS asked FROM cells GROUP BY ALL) SELECT story_id, actor, shown, thin_polities, thin_named, thin_evaluable, asked FROM g",
)
def pooled_verdicts(spark, folder):
    """Whether each split can be asked about, and its thin polities pooled; the verdict itself rests on random draws."""
    cells = cut(measure.by_polity(marks_of(spark, folder)), "cells")
    told = publish.country_verdicts(measure.structure_test(cells, params=FLOORS), cells)
    return told.select("story_id", "actor", "shown", "thin_polities", "thin_named", "thin_evaluable", F.col("verdict").isNotNull().alias("asked"))


@query("gkg_heartbeats", "SELECT i AS k, strftime(TIMESTAMP '2026-04-16 11:30:00' - to_minutes(15 * i), '%Y%m%d%H%M%S') AS slot FROM range(96) t(i)")
def gkg_heartbeats(spark, folder):
    """Quarter hours of the feed that is published half an hour late."""
    return series.heartbeats(spark, "20260416T120500Z", 96, lag_minutes=30)


@query(
    "fetch_report",
    "WITH f AS (SELECT slot, string_split(line, chr(9)) AS f FROM gkg_raw WHERE line <> ''), s AS (SELECT DISTINCT slot FROM gkg_raw WHERE slot IS NOT NULL), x AS (SELECT unnest(generate_series(strptime(min(slot), '%Y%m%d%H%M%S'), strptime(max(slot), '%Y%m%d%H%M%S'), INTERVAL 15 MINUTE)) AS t FROM s), "
    "r AS (SELECT count(*) AS slots_requested, count(*) FILTER (strftime(t, '%Y%m%d%H%M%S') NOT IN (SELECT slot FROM s)) AS slots_missing FROM x), p AS (SELECT count(*) AS lines_seen, count(*) FILTER (len(f) <> 27 OR trim(f[5]) = '') AS lines_unparsed FROM f) "
    "SELECT slots_requested, slots_missing, lines_seen, lines_unparsed, round((lines_seen - lines_unparsed) / lines_seen, 6) AS parse_fidelity FROM r, p",
)
def fetch_report(spark, folder):
    """What a window of slots amounted to: slots asked for and missing, lines seen and not parsed."""
    rows = table(spark, folder, "gkg_raw")
    seen = rows.filter("slot is not null").select("slot").distinct()
    span = seen.agg(F.min("slot").alias("a"), F.max("slot").alias("b"))
    second = lambda c: F.unix_seconds(F.to_timestamp(F.col(c), "yyyyMMddHHmmss"))
    asked = span.select((F.floor((second("b") - second("a")) / 900) + 1).alias("slots_requested"))
    gone = series.missing_slots(rows.filter("slot is not null")).agg(F.count("*").alias("slots_missing"))
    parsed = gkg.fidelity(gkg.fields(rows)).agg(F.sum("lines_seen").alias("lines_seen"), (F.sum("wrong_width") + F.sum("no_url")).alias("lines_unparsed"))
    whole = asked.join(F.broadcast(gone)).join(F.broadcast(parsed))  # one row each
    return whole.select("*", F.round((F.col("lines_seen") - F.col("lines_unparsed")) / F.col("lines_seen"), 6).alias("parse_fidelity"))


@query("language_listing", "SELECT 'code' AS kind, code AS value FROM language_code WHERE code IS NOT NULL UNION SELECT 'name', gdelt_name FROM language_code WHERE gdelt_name IS NOT NULL")
def language_listing(spark, folder):
    """All codes and names of languages, each once."""
    t = table(spark, folder, "language_code")
    listed = t.select(F.lit("code").alias("kind"), F.col("code").alias("value")).union(t.select(F.lit("name"), "gdelt_name"))
    return listed.filter("value is not null").distinct()


@query("actor_listing", _ALIASES + "SELECT actor, string_agg(DISTINCT language, ',' ORDER BY language) AS languages, string_agg(DISTINCT script, ',' ORDER BY script) AS scripts, count(*) AS aliases FROM usable GROUP BY actor")
def actor_listing(spark, folder):
    """Each actor of the alias table with the languages and scripts it can be found in."""
    joined = lambda c: F.array_join(F.sort_array(F.collect_set(c)), ",").alias(c + "s")
    return resolve.alias_table(table(spark, folder, "actor_alias")).groupBy("actor").agg(joined("language"), joined("script"), F.count("*").alias("aliases"))


_WIDE = f"translate({{c}}, '{''.join(map(chr, range(0xFF01, 0xFF5F))).replace(chr(0xFF07), '')}', '{''.join(chr(x - 0xFEE0) for x in range(0xFF01, 0xFF5F) if x != 0xFF07)}')"
_WROTE = "WITH w AS (SELECT story_id, language, domain, polity, unnest(map_keys(wrote)) AS actor, unnest(map_values(wrote)) AS spelling FROM evidence WHERE wrote IS NOT NULL)"


@query("folded_spellings", _WROTE + f", per AS (SELECT story_id, actor, language, {folded(_WIDE.replace('{c}', 'spelling'))} AS form, count(DISTINCT domain) AS sources, count(DISTINCT polity) AS polities FROM w WHERE spelling IS NOT NULL GROUP BY ALL) SELECT story_id, actor, language, form, sources, polities FROM (SELECT *, count(*) OVER (PARTITION BY story_id, actor, language) AS forms FROM per WHERE sources >= 2) WHERE forms >= 2")
def folded_spellings(spark, folder):
    """Spellings that compete within a language, folded: accents, case and punctuation make no other form."""
    rows = table(spark, folder, "evidence").select("story_id", "language", "domain", "polity", F.explode("wrote").alias("actor", "spelling"))
    return reads.competing_spellings(rows, fold(F.col("spelling")))


_PLACES = "(SELECT DISTINCT polity, (ascii(polity) - 77) * 6.5 AS lat, (ascii(polity[2:]) - 109) * 13.5 AS lon FROM publisher WHERE polity IS NOT NULL)"


@query("map_positions", f"SELECT polity, round((lon + 180.0) / 360.0 * 76, 6) AS x, round((84.0 - lat) / 141.0 * 22, 6) AS y FROM {_PLACES}")
def map_positions(spark, folder):
    """Places as fractions of the cells of a raster, in the raster's own projection."""
    projection = {"lat_top": 84.0, "lat_bottom": -57.0, "lon_left": -180.0, "lon_right": 180.0, "width": 76, "height": 22}
    rows = table(spark, folder, "publisher").select("polity").filter("polity is not null").distinct()
    x, y = reads.map_position((F.ascii("polity") - 77) * F.lit(6.5), (F.ascii(F.substring("polity", 2, 1)) - 109) * F.lit(13.5), projection)
    return rows.select("polity", F.round(x, 6).alias("x"), F.round(y, 6).alias("y"))


@query("display_names", "SELECT DISTINCT actor, array_to_string(list_transform(string_split(actor, '-'), lambda w: upper(w[1:1]) || w[2:]), ' ') AS name FROM actor_alias")
def display_names(spark, folder):
    """Names of actors made from their keys, where no label says otherwise."""
    t = table(spark, folder, "actor_alias").select("actor").distinct()
    return t.select("actor", reads.display_name(F.col("actor"), F.lit(None).cast("string")).alias("name"))


_CASED = "('ENGLISH', 'SPANISH', 'ITALIAN', 'TURKISH', 'GREEK', 'RUSSIAN', 'FRENCH', 'PORTUGUESE', 'VIETNAMESE', 'DUTCH', 'POLISH', 'ROMANIAN', 'INDONESIAN', 'SWEDISH', 'CZECH', 'CATALAN', 'SERBIAN', 'UKRAINIAN', 'BULGARIAN', 'CROATIAN')"
_CANDIDATES = f"""
WITH t AS (SELECT capture_id, upper(trim(language)) AS language, domain, regexp_extract_all(coalesce(title, ''), '\\p{{L}}+') AS ws FROM capture WHERE upper(trim(language)) IN {_CASED} AND domain IS NOT NULL),
x AS (SELECT capture_id, language, domain, unnest(ws) AS w, generate_subscripts(ws, 1) AS i FROM t WHERE len(ws) >= 3),
f AS (SELECT *, i > 1 AND regexp_matches(w, '^\\p{{Lu}}') AND w <> upper(w) AS cap FROM x),
seen AS (SELECT {lower('w')} AS word, count(*) FILTER (cap) AS ups, count(*) FILTER (NOT cap AND w = lower(w) AND w <> upper(w)) AS downs FROM f GROUP BY 1),
c AS (SELECT *, i - row_number() OVER (PARTITION BY capture_id ORDER BY i) AS island FROM f WHERE cap),
runs AS (SELECT capture_id, any_value(language) AS language, any_value(domain) AS domain, {lower("string_agg(w, ' ' ORDER BY i)")} AS term FROM c GROUP BY capture_id, island),
per AS (SELECT term, count(DISTINCT language) AS languages, count(DISTINCT domain) AS domains FROM runs GROUP BY term HAVING count(DISTINCT language) >= 4 AND count(DISTINCT domain) >= 10),
parts AS (SELECT term, languages, domains, unnest(string_split(term, ' ')) AS word FROM per),
shares AS (SELECT term, languages, domains, sum(ups) / greatest(sum(ups) + sum(downs), 1) AS share FROM parts JOIN seen USING (word) GROUP BY ALL),
terms AS (SELECT term, languages, domains, round(share, 3) AS capitalised FROM shares WHERE share >= 0.8)
"""


@query("cased_candidates", _CANDIDATES + "SELECT * FROM terms")
def cased_candidates(spark, folder):
    """Candidate actors of languages that write names with capitals."""
    return mining.cased_candidates(table(spark, folder, "capture"))


@query(
    "annotated_candidates",
    _CANDIDATES + f", named AS (SELECT {folded('alias')} AS form, min(actor) AS actor FROM actor_alias GROUP BY 1), top AS (SELECT *, row_number() OVER (ORDER BY domains DESC, languages DESC, term) AS place FROM terms) SELECT place, term, actor FROM top LEFT JOIN named ON {folded('term')} = form WHERE place <= 150",
)
def annotated_candidates(spark, folder):
    """The widest candidates with the entity that bears the name, if the table of entities has one."""
    names = table(spark, folder, "actor_alias").groupBy(fold(F.col("alias")).alias("form")).agg(F.min("actor").alias("actor"))
    return mining.annotate(mining.cased_candidates(table(spark, folder, "capture")), names)


_BULK_SQL = "SELECT DISTINCT domain, CASE domain WHEN 'override.test' THEN 'Nowhere' ELSE polity END AS polity FROM (SELECT lower(domain) AS domain, CASE polity WHEN 'Keshtan' THEN 'Keshtania' ELSE polity END AS polity FROM publisher WHERE polity IS NOT NULL AND lower(split_part(domain, '.', -1)) <> 'invalid' UNION SELECT 'override.test', 'Nowhere')"


@query("bulk_lookup", _BULK_SQL)
def bulk_lookup(spark, folder):
    """The bulk table with country names made one and corrections applied."""
    tlds = spark.createDataFrame([("invalid", "Nowhere")], "name string, polity string")
    renamed = spark.createDataFrame([("Keshtan", "Keshtania")], "name string, polity string")
    corrected = spark.createDataFrame([("override.test", "Nowhere")], "domain string, polity string")
    return dims.bulk_lookup(table(spark, folder, "publisher").select("domain", "polity"), tlds, renamed, corrected)


_ENTITIES = [("Q1", True, "politician", None, False), ("Q1", True, "judoka", "public office", False), ("Q2", True, "singer", None, False), ("Q3", True, "lawyer", "special envoy", False), ("Q4", True, "politician", None, True), ("Q5", False, "country", None, False), ("Q6", False, "book", None, False)]
_ENTITY_SQL = ", ".join(f"('{i}', {h}, '{o}', {'NULL' if p is None else repr(p)}, {d})" for i, h, o, p, d in _ENTITIES)


@query("admission", f"WITH e(id, human, kind, office, dead) AS (VALUES {_ENTITY_SQL}) SELECT id, CASE WHEN bool_or(human) THEN (bool_or(kind IN ('politician', 'statesperson', 'diplomat', 'head of state', 'head of government')) OR bool_or(coalesce(office IN ('special envoy', 'civil servant', 'president', 'prime minister', 'minister', 'ambassador', 'head of state', 'head of government', 'public office'), false))) AND NOT bool_or(dead) ELSE bool_or(kind = 'country') END AS admitted FROM e GROUP BY id")
def admission(spark, folder):
    """The rule that admits an entity as an actor, over entities of every kind."""
    rows = spark.createDataFrame(_ENTITIES, "id string, human boolean, kind string, office string, dead boolean")
    per = rows.groupBy("id").agg(F.max("human").alias("human"), F.collect_set("kind").alias("kinds"), F.collect_set("office").alias("offices"), F.max("dead").alias("dead"))
    return per.select("id", mining.admitted(F.col("human"), F.col("kinds"), F.col("offices"), F.col("dead"), ["country"]).alias("admitted"))


@query("emotions", "WITH p AS (SELECT event_id % 997 AS id, CASE event_type WHEN 'click' THEN 'Joy' WHEN 'error' THEN 'anger' WHEN 'purchase' THEN 'relief' WHEN 'signup' THEN 'fear' ELSE 'other' END AS label, value / 100 AS score FROM events), t AS (SELECT id, max(struct_pack(score := score, label := label)) AS x FROM p GROUP BY id) SELECT id, CASE lower(x.label) WHEN 'joy' THEN 'surprise' WHEN 'anger' THEN 'anger' WHEN 'relief' THEN 'positive' WHEN 'fear' THEN 'fear' ELSE 'neutral' END AS emotion, CAST(least(floor(x.score * 100 * CASE lower(x.label) WHEN 'joy' THEN 0.8 WHEN 'anger' THEN 1.3 WHEN 'relief' THEN 0.5 WHEN 'fear' THEN 1.2 ELSE 1.0 END::DOUBLE), 100) AS INT) AS bias_risk FROM t")
def emotions(spark, folder):
    """Buckets of likeliest labels; events stand in for a classifier's answers."""
    names = F.create_map(*[F.lit(x) for pair in (("click", "Joy"), ("error", "anger"), ("purchase", "relief"), ("signup", "fear")) for x in pair])
    rows = table(spark, folder, "events").select((F.col("event_id") % 997).alias("id"), F.coalesce(F.try_element_at(names, F.col("event_type")), F.lit("other")).alias("label"), (F.col("value") / 100).alias("score"))
    return publish.emotion(rows)


@query(
    "series_backfill",
    _RESOLVED.replace("FROM capture c", "FROM (SELECT * FROM capture WHERE capture_id IN (SELECT capture_id FROM first_seen)) c").replace("\nWITH a AS", "\nWITH first_seen AS (SELECT e.evidence_id, e.run, e.polity, first.capture_id AS capture_id FROM evidence e JOIN (SELECT url, min(struct_pack(run := run, capture_id := capture_id)) AS first FROM capture WHERE url IS NOT NULL GROUP BY url) f USING (url) WHERE first.run <= e.run), a AS", 1)
    + ", days AS (SELECT r.actor, f.polity, strptime(f.run[1:8], '%Y%m%d')::DATE AS day, mark FROM first_seen f JOIN resolved r USING (capture_id) WHERE mark <> 'unresolved' AND f.polity IS NOT NULL) "
    "SELECT actor, polity, day, count(*) FILTER (mark = 'present') AS named, count(*) AS evaluable FROM days WHERE day > (SELECT max(day) FROM days) - 90 GROUP BY actor, polity, day",
)
def series_backfill(spark, folder):
    """The series made anew from captures: earliest capture of each address, resolved, by run, then folded in."""
    index = table(spark, folder, "evidence").select("evidence_id", "url", "run", "polity")
    captures = table(spark, folder, "capture")
    first = cut(series.earliest_capture(index, captures), "first")
    titles = captures.join(first.select("capture_id").distinct(), "capture_id", "left_semi").select("capture_id", "title", "language")
    marks = resolve.resolve(titles, table(spark, folder, "actor_alias"), table(spark, folder, "language_code")).select("capture_id", "actor", "mark")
    rows = index.join(first, "evidence_id").join(marks.filter("mark <> 'unresolved'"), "capture_id")
    batch = measure.by_polity(rows, ("run", "actor")).drop("thin")
    empty = spark.createDataFrame([], "actor string, polity string, day date, named bigint, evaluable bigint")
    return series.accumulate(empty, spark.createDataFrame([], "run string"), batch)[0]


# SQL of queries registered elsewhere that rests on the greedy collapse
SQL["syndication_collapse"] = COLLAPSED + "SELECT story_id, evidence_id FROM kept"
SQL["story_figures_collapsed"] = _FIGURES + "SELECT * FROM figures"
