"""Whether a headline names an actor: present, absent, or unresolved."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parallax.functions.lineage import spread
from parallax.functions.text import RAW_SCRIPTS, fold, script_of, usable_alias
from parallax.operators.dims import language_code, small


def alias_table(aliases: DataFrame) -> DataFrame:
    """(actor, language, ord, alias, script, needle) of usable aliases; aliases has actor, language, ord, alias."""
    script = script_of(F.col("alias"))
    needle = F.when(script.isin(*RAW_SCRIPTS), F.lower("alias")).otherwise(fold(F.col("alias")))
    return aliases.filter(usable_alias(F.col("alias"))).select("actor", "language", "ord", "alias", script.alias("script"), needle.alias("needle"))


def needles_by_script(table: DataFrame) -> DataFrame:
    """(actor, script, needles): arrays of (needle, alias), each alias once, in order of first appearance."""
    first = table.groupBy("actor", "script", "alias", "needle").agg(F.min(F.struct("language", "ord")).alias("at"))
    packed = F.sort_array(F.collect_list(F.struct("at", "needle", "alias")))
    return first.groupBy("actor", "script").agg(F.transform(packed, lambda x: F.struct(x["needle"].alias("needle"), x["alias"].alias("alias"))).alias("needles"))


def resolve(rows: DataFrame, aliases: DataFrame, languages: DataFrame, actors: list[str] | None = None) -> DataFrame:
    """Every row with every actor: rows' columns, actor, mark and spelling. rows has title and language.

    A row is evaluable by its language, and matched against every alias in its title's script. The alias table is a
    dimension: its actors by script are broadcast if few, and each title is folded once.
    """
    table = alias_table(aliases)
    if actors is not None:
        table = table.filter(F.col("actor").isin(actors))
    spoken = table.groupBy("actor").agg(F.collect_set("language").alias("spoken"))
    by_script = needles_by_script(table).groupBy("actor").agg(F.map_from_entries(F.collect_list(F.struct("script", "needles"))).alias("by_script"))
    dim = small(spoken.join(by_script, "actor"))
    title = F.coalesce("title", F.lit(""))
    coded = language_code(spread(rows), languages, "language", "_code").withColumn("_script", script_of(title))
    coded = coded.withColumn("_hay", F.when(F.col("_script").isin(*RAW_SCRIPTS), F.lower(title)).otherwise(F.concat(F.lit(" "), fold(title), F.lit(" "))))
    # every row meets every actor of the table: the cross product with a dimension is the result itself
    met = coded.crossJoin(dim)
    known = F.try_element_at("by_script", F.col("_script"))
    asked = F.col("_code").isNotNull() & F.array_contains("spoken", F.col("_code"))
    hits = F.filter(known, lambda x: F.contains(F.col("_hay"), x["needle"]))
    # null: unresolved; an empty array: absent; else the spellings found, in order
    met = met.withColumn("_hits", F.when(asked, hits)).drop("spoken", "by_script", "_hay", "_code")
    mark = F.when(F.col("_hits").isNull(), "unresolved").when(F.size("_hits") > 0, "present").otherwise("absent")
    return met.withColumn("mark", mark).withColumn("spelling", F.try_element_at("_hits", F.lit(1))["alias"]).drop("_hits").withColumnRenamed("_script", "script")


def coverage_by_script(resolved: DataFrame) -> DataFrame:
    """(actor, script, rows, answerable, named)."""
    return resolved.groupBy("actor", "script").agg(F.count("*").alias("n_rows"), F.count_if(F.col("mark") != "unresolved").alias("answerable"), F.count_if(F.col("mark") == "present").alias("named"))
