"""Queries of the lookups, the resolver and the figures, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from parallax.functions.text import fold, normalise_title, script_of, usable_alias
from parallax.operators import dims, measure, resolve
from parallax.params import Params
from parallax.plans.registry import query
from parallax.sources.tables import table

#: The floors of the test tables: their stories are smaller than a day's.
FLOORS = Params(min_evaluable=8, powered_sources=20)
# Greek final sigma and the dotted capital I are lowered as Unicode has it.


def lower(c: str) -> str:
    return f"regexp_replace(lower(replace({c}, 'İ', 'i̇')), '(\\p{{L}})σ([^\\p{{L}}]|$)', '\\1ς\\2', 'g')"


def spaces(c: str) -> str:
    return f"trim(regexp_replace({c}, '[^\\p{{L}}\\p{{N}}_]+', ' ', 'g'))"


def folded(c: str) -> str:
    return spaces(f"strip_accents({lower(f"coalesce({c}, '')")})")


def _count(block: str) -> str:
    return "len(regexp_extract_all(coalesce({c}, ''), '" + block + "'))"


_BLOCKS = {
    "cyrillic": _count("[\\x{0400}-\\x{04FF}]"), "greek": _count("[\\x{0370}-\\x{03FF}]"), "arabic": _count("[\\x{0621}-\\x{064A}]"),
    "cjk": _count("[\\x{3040}-\\x{9FFF}\\x{AC00}-\\x{D7AF}]"), "latin": _count("[A-Za-z\\x{AA}\\x{B5}\\x{BA}\\x{C0}-\\x{D6}\\x{D8}-\\x{F6}\\x{F8}-\\x{24F}]"),
}


def _script(c: str) -> str:
    """SQL for the script of most letters; without ties in these tables the first seen never decides."""
    n = {k: v.replace("{c}", c) for k, v in _BLOCKS.items()}
    top = "greatest(" + ", ".join(n.values()) + ")"
    return "CASE WHEN " + top + " = 0 THEN 'other' " + " ".join(f"WHEN {v} = {top} THEN '{k}'" for k, v in n.items()) + " END"


@query("url_domain", "SELECT capture_id, regexp_replace(lower(regexp_extract(url, '^[a-zA-Z]+://([^/?#]*)', 1)), '^www\\.', '') AS domain FROM capture WHERE regexp_matches(url, '^[a-zA-Z]+://[^/?#]+')")
def url_domain(spark, folder):
    t = table(spark, folder, "capture").select("capture_id", dims.authority_domain(F.col("url")).alias("domain"))
    return t.filter("domain is not null")


@query("language_codes", "SELECT c.capture_id, l.code FROM capture c LEFT JOIN language_code l ON lower(trim(c.language)) = lower(trim(l.gdelt_name))")
def language_codes(spark, folder):
    return dims.language_code(table(spark, folder, "capture"), table(spark, folder, "language_code")).select("capture_id", "code")


_POLITY = """
WITH d AS (SELECT DISTINCT domain FROM capture WHERE domain IS NOT NULL),
parts AS (SELECT domain, string_split(domain, '.') AS l FROM d),
up AS (SELECT domain, l, unnest(CASE WHEN len(l) >= 2 THEN range(0, len(l) - 1) ELSE [0] END) AS cut FROM parts),
hits AS (SELECT up.domain, arg_min(p.polity, up.cut) AS polity FROM up JOIN publisher p ON lower(p.domain) = array_to_string(up.l[up.cut + 1:], '.') WHERE p.polity IS NOT NULL GROUP BY up.domain),
placed AS (SELECT parts.domain, CASE WHEN l[-1] = 'invalid' THEN 'Nowhere' ELSE hits.polity END AS polity FROM parts LEFT JOIN hits USING (domain))
"""


def _placed(spark, folder):
    tlds = spark.createDataFrame([("invalid", "Nowhere")], "name string, polity string")
    return dims.polity(table(spark, folder, "capture"), tlds, table(spark, folder, "publisher").select(F.col("domain").alias("name"), "polity"))


@query("polity_chain", _POLITY + "SELECT domain, polity FROM placed")
def polity_chain(spark, folder):
    return _placed(spark, folder)


@query("polity_coverage", _POLITY + "SELECT count(*) AS domains, count(polity) AS placed, round(count(polity) / count(*), 4) AS rate FROM placed")
def polity_coverage(spark, folder):
    return dims.coverage(_placed(spark, folder))


@query("bulk_domains", "SELECT lower(domain) AS domain, polity, dense_rank() OVER (ORDER BY polity) - 1 AS name_index FROM publisher WHERE polity IS NOT NULL AND lower(split_part(domain, '.', -1)) <> 'invalid'")
def bulk_domains(spark, folder):
    """The bulk lookup: rows that their top-level domain decides are left out, names are numbered."""
    t = table(spark, folder, "publisher").filter("polity is not null").select(F.lower("domain").alias("domain"), "polity")
    t = t.filter(F.element_at(F.split("domain", r"\."), -1) != "invalid")
    # names are a short dimension: they are numbered apart from the rows
    names = t.select("polity").distinct()
    numbered = names.selectExpr("polity").join(F.broadcast(names.agg(F.sort_array(F.collect_set("polity")).alias("all")))).select("polity", (F.array_position("all", F.col("polity")) - 1).alias("name_index"))
    return t.join(F.broadcast(numbered), "polity").select("domain", "polity", "name_index")


@query("script_of_title", f"SELECT capture_id, {_script('title')} AS script FROM capture")
def script_of_title(spark, folder):
    return table(spark, folder, "capture").select("capture_id", script_of(F.coalesce("title", F.lit(""))).alias("script"))


@query("fold_title", f"SELECT capture_id, {folded('title')} AS folded FROM capture")
def fold_title(spark, folder):
    return table(spark, folder, "capture").select("capture_id", fold(F.coalesce("title", F.lit(""))).alias("folded"))


@query("normalise_title", f"SELECT capture_id, {spaces(lower('title'))} AS normalised FROM capture")
def normalised(spark, folder):
    return table(spark, folder, "capture").select("capture_id", normalise_title(F.col("title")).alias("normalised"))


_ALIASES = f"""
WITH a AS (SELECT *, {_script('alias')} AS script, {folded('alias')} AS folded FROM actor_alias),
usable AS (SELECT actor, language, ord, alias, script, CASE WHEN script IN ('arabic', 'cjk') THEN lower(alias) ELSE folded END AS needle FROM a
  WHERE length(trim(alias)) > 0 AND length(folded) >= CASE script WHEN 'latin' THEN 4 WHEN 'cyrillic' THEN 4 WHEN 'greek' THEN 4 WHEN 'cjk' THEN 2 ELSE 3 END
    AND NOT regexp_full_match(trim(alias), '[A-Z0-9][A-Z0-9._/-]*'))
"""


@query("alias_table", _ALIASES + "SELECT * FROM usable")
def alias_table(spark, folder):
    return resolve.alias_table(table(spark, folder, "actor_alias"))


@query("aliases_dropped", f"WITH a AS (SELECT *, {_script('alias')} AS script, {folded('alias')} AS folded FROM actor_alias) SELECT actor, language, alias FROM a WHERE length(folded) < CASE script WHEN 'latin' THEN 4 WHEN 'cyrillic' THEN 4 WHEN 'greek' THEN 4 WHEN 'cjk' THEN 2 ELSE 3 END OR regexp_full_match(trim(alias), '[A-Z0-9][A-Z0-9._/-]*')")
def aliases_dropped(spark, folder):
    return table(spark, folder, "actor_alias").filter(~usable_alias(F.col("alias"))).select("actor", "language", "alias")


_RESOLVED = _ALIASES + f"""
, first AS (SELECT actor, script, alias, needle, min(struct_pack(language := language, ord := ord)) AS at FROM usable GROUP BY ALL),
rows AS (SELECT c.capture_id, l.code, {_script('c.title')} AS script, lower(coalesce(c.title, '')) AS low, ' ' || {folded('c.title')} || ' ' AS hay
  FROM capture c LEFT JOIN language_code l ON lower(trim(c.language)) = lower(trim(l.gdelt_name))),
actors AS (SELECT DISTINCT actor FROM usable),
asked AS (SELECT r.capture_id, a.actor, r.script, r.code IS NOT NULL AND EXISTS (SELECT 1 FROM usable u WHERE u.actor = a.actor AND u.language = r.code)
    AND EXISTS (SELECT 1 FROM usable u WHERE u.actor = a.actor AND u.script = r.script) AS known FROM rows r CROSS JOIN actors a),
hits AS (SELECT r.capture_id, f.actor, arg_min(f.alias, f.at) AS spelling FROM rows r JOIN first f ON f.script = r.script
    AND contains(CASE WHEN r.script IN ('arabic', 'cjk') THEN r.low ELSE r.hay END, f.needle) GROUP BY ALL),
resolved AS (SELECT asked.capture_id, asked.actor, asked.script, CASE WHEN NOT known THEN 'unresolved' WHEN hits.spelling IS NOT NULL THEN 'present' ELSE 'absent' END AS mark,
    CASE WHEN known THEN hits.spelling END AS spelling FROM asked LEFT JOIN hits ON hits.capture_id = asked.capture_id AND hits.actor = asked.actor)
"""


def _resolved(spark, folder):
    rows = table(spark, folder, "capture").select("capture_id", "title", "language")
    return resolve.resolve(rows, table(spark, folder, "actor_alias"), table(spark, folder, "language_code"))


@query("resolve_marks", _RESOLVED + "SELECT capture_id, actor, mark, spelling FROM resolved")
def resolve_marks(spark, folder):
    return _resolved(spark, folder).select("capture_id", "actor", "mark", "spelling")


@query("resolver_coverage", _RESOLVED + "SELECT actor, script, count(*) AS n_rows, count(*) FILTER (mark <> 'unresolved') AS answerable, count(*) FILTER (mark = 'present') AS named FROM resolved GROUP BY ALL")
def resolver_coverage(spark, folder):
    return resolve.coverage_by_script(_resolved(spark, folder))


@query("matched_spellings", _RESOLVED + "SELECT actor, spelling, count(*) AS n FROM resolved WHERE spelling IS NOT NULL GROUP BY ALL")
def matched_spellings(spark, folder):
    return _resolved(spark, folder).filter("spelling is not null").groupBy("actor", "spelling").agg(F.count("*").alias("n"))


@query("language_scripts", f"WITH a AS (SELECT language, {_script('alias')} AS script, count(*) AS n FROM actor_alias GROUP BY ALL) SELECT language, arg_max(script, n) AS script FROM a GROUP BY language")
def language_scripts(spark, folder):
    """The script of most aliases of each language."""
    per = table(spark, folder, "actor_alias").groupBy("language", script_of(F.col("alias")).alias("script")).agg(F.count("*").alias("n"))
    return per.groupBy("language").agg(F.max_by("script", F.struct("n", "script")).alias("script"))


MARKS = "WITH marks AS (SELECT e.* EXCLUDE (marks, wrote), unnest(map_keys(marks)) AS actor, unnest(map_values(marks)) AS mark FROM evidence e)\n"
_H = "CASE WHEN named <= 0 OR named >= evaluable THEN 0.0 ELSE -((named / evaluable) * log2(named / evaluable) + (1 - named / evaluable) * log2(1 - named / evaluable)) END"
FIGURES = MARKS + f"""
, per AS (SELECT story_id, actor, language, count(*) FILTER (mark = 'present') AS n, count(*) FILTER (mark <> 'unresolved') AS e, count(*) FILTER (mark = 'unresolved') AS u FROM marks GROUP BY ALL),
sums AS (SELECT story_id, actor, CAST(sum(n) AS BIGINT) AS named, CAST(sum(e) AS BIGINT) AS evaluable, CAST(sum(u) AS BIGINT) AS unresolved, avg(CASE WHEN e > 0 THEN n / e END) AS balanced FROM per GROUP BY ALL),
placed AS (SELECT story_id, count(DISTINCT polity) AS polities FROM marks GROUP BY ALL),
figures AS (SELECT s.story_id, actor, named, evaluable, unresolved, polities, evaluable >= 8 AND polities >= 2 AS measurable,
  CASE WHEN evaluable >= 8 AND polities >= 2 THEN round({_H}, 4) END AS division, CASE WHEN evaluable >= 8 AND polities >= 2 THEN round(balanced, 4) END AS balanced_rate
  FROM sums s JOIN placed p ON s.story_id = p.story_id)
"""
CELLS = "SELECT story_id, actor, polity, count(*) FILTER (mark = 'present') AS named, count(*) AS evaluable, count(*) < 3 AS thin FROM marks WHERE mark <> 'unresolved' AND polity IS NOT NULL GROUP BY ALL"


def marks_of(spark, folder):
    return measure.long_marks(table(spark, folder, "evidence"))


@query("story_figures", FIGURES + "SELECT * FROM figures")
def story_figures(spark, folder):
    return measure.figures(marks_of(spark, folder), FLOORS)


@query("story_figures_collapsed")
def story_figures_collapsed(spark, folder):
    """Figures of one row per voice; the greedy collapse has no plain SQL."""
    return measure.figures(measure.long_marks(measure.collapse(table(spark, folder, "evidence"))), FLOORS)


@query("syndication_collapse")
def syndication_collapse(spark, folder):
    return measure.collapse(table(spark, folder, "evidence")).select("story_id", "evidence_id")


@query("publishable_figures", FIGURES + "SELECT story_id, actor, named, evaluable, division, balanced_rate FROM figures WHERE measurable IS NOT FALSE")
def publishable_figures(spark, folder):
    """Only what is known to be unmeasurable is dropped."""
    figs = measure.figures(marks_of(spark, folder), FLOORS)
    return figs.filter(F.coalesce("measurable", F.lit(True))).select("story_id", "actor", "named", "evaluable", "division", "balanced_rate")


@query("top_band", FIGURES + ", best AS (SELECT *, max(division) OVER (PARTITION BY story_id) AS best FROM figures WHERE measurable AND division > 0.005) SELECT story_id, string_agg(actor, ',' ORDER BY actor) AS band, max(best) AS division FROM best WHERE division >= best - 0.005 GROUP BY story_id")
def top_band(spark, folder):
    return measure.top_band(measure.figures(marks_of(spark, folder), FLOORS), FLOORS)


@query("polity_table", MARKS + CELLS)
def polity_table(spark, folder):
    return measure.by_polity(marks_of(spark, folder))


@query("actor_polity_rollup", MARKS + "SELECT actor, polity, count(*) FILTER (mark = 'present') AS named, count(*) AS evaluable, count(*) < 3 AS thin FROM marks WHERE mark <> 'unresolved' AND polity IS NOT NULL GROUP BY ALL")
def actor_polity_rollup(spark, folder):
    return measure.by_polity(marks_of(spark, folder), ("actor",))


@query(
    "mutual_information",
    MARKS + f", cells AS ({CELLS}), w AS (SELECT *, evaluable - named AS miss, sum(evaluable) OVER p AS n, sum(named) OVER p AS hits FROM cells WINDOW p AS (PARTITION BY story_id, actor)) "
    "SELECT story_id, actor, round(greatest(0.0, sum(CASE WHEN named > 0 THEN named / n * log2(named * n / (evaluable * hits)) ELSE 0.0 END + CASE WHEN miss > 0 THEN miss / n * log2(miss * n / (evaluable * (n - hits))) ELSE 0.0 END)), 4) AS information FROM w GROUP BY ALL",
)
def mutual_information(spark, folder):
    return measure.mutual_information(measure.by_polity(marks_of(spark, folder)))


@query("structure_test")
def structure_test(spark, folder):
    return measure.structure_test(measure.by_polity(marks_of(spark, folder)), params=FLOORS)


_WORDS = "SELECT story_id, evidence_id, coalesce(title, '') AS title, coalesce(url, '') AS url, list_distinct(regexp_extract_all(" + lower("coalesce(title, '')") + ", '[\\p{L}\\p{N}_]+')) AS words FROM evidence"


@query(
    "representative_headline",
    f"WITH b AS ({_WORDS}), x AS (SELECT story_id, evidence_id, unnest(words) AS word FROM b), u AS (SELECT story_id, word, count(*) AS uses FROM x GROUP BY ALL), "
    "s AS (SELECT x.story_id, x.evidence_id, avg(CASE WHEN uses > 1 THEN 1.0 ELSE 0.0 END) AS score FROM x JOIN u ON x.story_id = u.story_id AND x.word = u.word GROUP BY ALL), "
    "r AS (SELECT b.*, row_number() OVER (PARTITION BY b.story_id ORDER BY coalesce(score, -1.0) DESC, length(title) DESC, url, b.evidence_id) AS k FROM b LEFT JOIN s ON b.evidence_id = s.evidence_id AND b.story_id = s.story_id) "
    "SELECT story_id, evidence_id, title AS headline FROM r WHERE k = 1",
)
def representative_headline(spark, folder):
    return measure.representative(table(spark, folder, "evidence"))
