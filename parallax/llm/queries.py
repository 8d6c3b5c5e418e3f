"""Driver queries of the operators for training text, with SQL where SQL can express them on whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parallax.functions.lineage import cut
from parallax.llm import dictionary_dedup, frequency, history_dedup, language_crf, lookalikes, mixing, packing, quality, tokens


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    return frequency.marked_terms(_table(spark, folder, "capture"))


def p1_term_counts(spark: SparkSession, folder: str) -> DataFrame:
    return frequency.term_frequencies(_table(spark, folder, "capture"))


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    t = {c: _table(spark, folder, c) for c in ("evidence", "lang_sample", "language_code", "capture")}
    return language_crf.mislabelled(t["evidence"], t["lang_sample"], t["language_code"], t["capture"])


def p2_segments(spark: SparkSession, folder: str) -> DataFrame:
    t = {c: _table(spark, folder, c) for c in ("evidence", "lang_sample", "language_code", "capture")}
    return language_crf.language_segments(t["evidence"], language_crf.train_on(t["capture"], t["lang_sample"], t["language_code"]), keep=["language"])


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    return history_dedup.deduplicate_batches(_table(spark, folder, "capture"), _table(spark, folder, "publisher"))


def p5_last_run(spark: SparkSession, folder: str) -> DataFrame:
    """The newest run as a batch of its own against the table of all others."""
    return history_dedup.last_batch(_table(spark, folder, "capture"), _table(spark, folder, "publisher"))


def _scripts(spark: SparkSession, folder: str) -> lookalikes.Scripts:
    clean = [_table(spark, folder, "lang_sample").select("title"), _table(spark, folder, "actor_alias").select("alias")]
    evidence = _table(spark, folder, "evidence")
    return lookalikes.train_scripts(clean, evidence.select("title").union(evidence.select(F.explode(F.map_values("wrote")))))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return lookalikes.disguised(_table(spark, folder, "evidence"), _scripts(spark, folder))


def p6_canonical(spark: SparkSession, folder: str) -> DataFrame:
    return lookalikes.canonical_forms(_table(spark, folder, "evidence"), _scripts(spark, folder))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    return dictionary_dedup.copies(_table(spark, folder, "capture"))


def p7_distinct_records(spark: SparkSession, folder: str) -> DataFrame:
    return dictionary_dedup.distinct_records(_table(spark, folder, "capture"))


def p8_containers(spark: SparkSession, folder: str) -> DataFrame:
    return packing.fill_containers(tokens.token_sizes(_table(spark, folder, "documents")), _table(spark, folder, "pack_budget"))


def p8_report(spark: SparkSession, folder: str) -> DataFrame:
    return packing.container_report(p8_containers(spark, folder), _table(spark, folder, "pack_budget"))


def _sized(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.token_sizes(_table(spark, folder, "documents"), keep=("doc_id", "source"))


def _mixed(spark: SparkSession, folder: str, total) -> tuple[DataFrame, DataFrame]:
    sizes, targets = cut(_sized(spark, folder), "sizes"), _table(spark, folder, "mix_target")
    return mixing.draw(sizes, targets, total(sizes, targets))


def p9_mixture(spark: SparkSession, folder: str) -> DataFrame:
    """A mixture as large as the documents: sources with too little fall short."""
    return _mixed(spark, folder, mixing.corpus_total)[0]


def p9_shares(spark: SparkSession, folder: str) -> DataFrame:
    return _mixed(spark, folder, mixing.corpus_total)[1]


def p9_balanced(spark: SparkSession, folder: str) -> DataFrame:
    """The largest mixture in which every source with documents reaches its share."""
    return _mixed(spark, folder, mixing.reachable_total)[0]


def p9_balanced_shares(spark: SparkSession, folder: str) -> DataFrame:
    return _mixed(spark, folder, mixing.reachable_total)[1]


def p10_found(spark: SparkSession, folder: str) -> DataFrame:
    return quality.structural_documents(_table(spark, folder, "documents"))


def p10_statistics(spark: SparkSession, folder: str) -> DataFrame:
    return quality.text_quality(_table(spark, folder, "documents"))


QUERIES = {f.__name__: f for f in (p1_found, p1_term_counts, p2_found, p2_segments, p5_found, p5_last_run, p6_found, p6_canonical, p7_found, p7_distinct_records, p8_containers, p8_report, p9_mixture, p9_shares, p9_balanced, p9_balanced_shares, p10_found, p10_statistics)}

# Greek final sigma and the dotted capital I are lowered as Unicode has it.
_TERMS = """
WITH runs AS (
  SELECT capture_id, 'title' AS field, unnest(regexp_extract_all(title, '[\\p{L}\\p{Nd}]+')) AS w FROM capture
), cells AS (
  SELECT capture_id, field,
         CASE WHEN regexp_matches(w, '\\p{L}\\p{Nd}*Σ$') THEN regexp_replace(lower(replace(w, 'İ', 'i̇')), 'σ$', 'ς')
              ELSE lower(replace(w, 'İ', 'i̇')) END AS term
  FROM runs
  UNION ALL SELECT capture_id, 'language', language FROM capture WHERE language IS NOT NULL
  UNION ALL SELECT capture_id, 'domain', domain FROM capture WHERE domain IS NOT NULL
), counts AS (
  SELECT field, term, count(*) AS occurrences, count(DISTINCT capture_id) AS n_rows FROM cells GROUP BY field, term
), marked AS (
  SELECT *, CASE WHEN n_rows < 3 THEN 'rare' WHEN n_rows > 0.05 * (SELECT count(*) FROM capture) THEN 'common' END AS mark FROM counts
)
"""
_CANON = "regexp_replace(lower(replace(upper(replace(regexp_replace({c}, '[^\\p{{L}}\\p{{N}}]+', '', 'g'), 'ß', 'ss')), 'İ', 'I')), '[^\\p{{L}}\\p{{N}}]+', '', 'g')"
_COPIES = f"""
WITH canon AS (
  SELECT capture_id, replace({_CANON.format(c='title')}, 'ς', 'σ') AS t, replace({_CANON.format(c='domain')}, 'ς', 'σ') AS d FROM capture
), keyed AS (
  SELECT capture_id, least(t, d) AS a, greatest(t, d) AS b FROM canon WHERE t <> '' AND d <> ''
)
"""
SQL = {
    "p1_found": _TERMS + "SELECT field, term, mark FROM marked WHERE mark IS NOT NULL",
    "p1_term_counts": _TERMS + "SELECT field, term, occurrences, n_rows, mark FROM marked",
    "p7_found": _COPIES + "SELECT first_id, capture_id AS copy_id FROM (SELECT *, min(capture_id) OVER (PARTITION BY a, b) AS first_id FROM keyed) WHERE capture_id <> first_id",
    "p7_distinct_records": _COPIES + "SELECT min(capture_id) AS first_id, count(*) AS n_copies FROM keyed GROUP BY a, b",
}
