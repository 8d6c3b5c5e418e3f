"""Candidate actors: capitalised terms that many languages and publishers share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parallax.functions.text import fold

WORD = r"\p{L}+"


def candidate_terms(rows: DataFrame, languages: int = 4, domains: int = 10, share: float = 0.8, least_words: int = 3) -> DataFrame:
    """(term, languages, domains, capitalised): runs of capitalised words inside titles.

    rows: title, language, domain. A run is of adjacent words that start with a capital, are no acronym and not the
    title's first word (gaps and islands over positions, within the row). A term counts if enough languages and domains
    have it and it is capitalised often enough among all occurrences of its words.
    """
    words = F.regexp_extract_all(F.coalesce("title", F.lit("")), F.lit(WORD), F.lit(0))
    base = rows.select("language", "domain", words.alias("words")).filter(F.size("words") >= least_words)
    capital = lambda w: w.rlike(r"^\p{Lu}") & ~((F.length(w) > 1) & (w == F.upper(w)))
    # runs are folded up word by word: ' ' ends one
    marked = F.transform("words", lambda w, i: F.when((i > 0) & capital(w), w).otherwise(F.lit("|")))
    runs = F.filter(F.transform(F.split(F.array_join(marked, " "), r"\|"), lambda x: F.trim(x)), lambda x: x != "")
    terms = base.select("language", "domain", F.explode(runs).alias("term"))
    per = terms.groupBy("term").agg(F.count_distinct("language").alias("languages"), F.count_distinct("domain").alias("domains"), F.count("*").alias("times"))
    # how often the first word of a term is capitalised, over all words of the titles
    seen = base.select(F.explode("words").alias("w")).groupBy(F.lower("w").alias("word")).agg(F.avg(F.when(F.col("w").rlike(r"^\p{Lu}"), 1.0).otherwise(0.0)).alias("capitalised"))
    wide = per.filter((F.col("languages") >= languages) & (F.col("domains") >= domains)).withColumn("word", F.lower(F.element_at(F.split("term", " "), 1)))
    return wide.join(seen, "word").filter(F.col("capitalised") >= share).select("term", "languages", "domains", F.round("capitalised", 4).alias("capitalised"))


# Languages that write names with capitals, and what makes a person a public actor.
CASED = (
    "ENGLISH", "SPANISH", "ITALIAN", "TURKISH", "GREEK", "RUSSIAN", "FRENCH", "PORTUGUESE", "VIETNAMESE", "DUTCH", "POLISH", "ROMANIAN", "INDONESIAN", "SWEDISH", "CZECH", "CATALAN", "SERBIAN", "UKRAINIAN", "BULGARIAN", "CROATIAN",
)
OCCUPATIONS = ("politician", "statesperson", "diplomat", "head of state", "head of government")
OFFICES = ("special envoy", "civil servant", "president", "prime minister", "minister", "ambassador", "head of state", "head of government", "public office")


def cased_candidates(rows: DataFrame, languages: int = 4, domains: int = 10, share: float = 0.8, least_words: int = 3) -> DataFrame:
    """(term, languages, domains, capitalised): lower-case runs of capitalised words in titles of cased languages.

    A word inside a title counts as capitalised if it begins with a capital and isn't all capitals; a word in small letters
    counts against it wherever it stands. A term's share is taken over the sums of all its words.
    """
    base = rows.select(F.upper(F.trim("language")).alias("language"), "domain", F.regexp_extract_all(F.coalesce("title", F.lit("")), F.lit(WORD), F.lit(0)).alias("words"))
    base = base.filter(F.col("language").isin(*CASED) & F.col("domain").isNotNull() & (F.size("words") >= least_words))
    capital = lambda w: w.rlike(r"^\p{Lu}") & (w != F.upper(w))
    marked = F.transform("words", lambda w, i: F.when((i > 0) & capital(w), w).otherwise(F.lit("|")))
    runs = F.filter(F.transform(F.split(F.array_join(marked, " "), r"\|"), lambda x: F.lower(F.trim(x))), lambda x: x != "")
    per = base.select("language", "domain", F.explode(runs).alias("term")).groupBy("term").agg(F.count_distinct("language").alias("languages"), F.count_distinct("domain").alias("domains"))
    placed = base.select(F.posexplode("words").alias("i", "w"))
    up = (F.col("i") > 0) & capital(F.col("w"))
    small = ~up & (F.col("w") == F.lower("w")) & (F.col("w") != F.upper("w"))
    seen = placed.groupBy(F.lower("w").alias("word")).agg(F.count_if(up).alias("ups"), F.count_if(small).alias("downs"))
    wide = per.filter((F.col("languages") >= languages) & (F.col("domains") >= domains))
    sums = wide.select("*", F.explode(F.split("term", " ")).alias("word")).join(seen, "word").groupBy("term", "languages", "domains").agg(F.sum("ups").alias("ups"), F.sum("downs").alias("downs"))
    rate = F.col("ups") / F.greatest(F.col("ups") + F.col("downs"), F.lit(1))
    return sums.filter(rate >= share).select("term", "languages", "domains", F.round(rate, 3).alias("capitalised"))


def annotate(candidates: DataFrame, names: DataFrame, top: int = 150) -> DataFrame:
    """(place, term, actor): the `top` candidates by domains, languages and name, with the entity whose folded name they are.

    names: form (folded), actor.
    """
    first = candidates.orderBy(F.desc("domains"), F.desc("languages"), "term").limit(top)  # a report of the widest ones
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy(F.desc("domains"), F.desc("languages"), "term")).cast("bigint")
    placed = first.select(place.alias("place"), "term", fold(F.col("term")).alias("form"))
    return placed.join(names, "form", "left").select("place", "term", "actor")


def admitted(human: Column, kinds: Column, offices: Column, dead: Column, in_scope: list[str]) -> Column:
    """Whether an entity is an actor: a living human of a political occupation or a public office, or a kind in scope."""
    of = lambda column, values: F.coalesce(F.arrays_overlap(column, F.array(*[F.lit(v) for v in values])), F.lit(False))
    return F.when(human, (of(kinds, OCCUPATIONS) | of(offices, OFFICES)) & ~dead).otherwise(of(kinds, in_scope))
