"""Alias tables from knowledge-base entities."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parallax.functions.text import script_of, usable_alias

ENTITY = "id string, labels map<string,struct<value:string>>, aliases map<string,array<struct<value:string>>>, descriptions map<string,struct<value:string>>, claims map<string,array<string>>"


def names(entities: DataFrame) -> DataFrame:
    """(id, language, ord, name): labels first, then aliases, as they come."""
    label = entities.select("id", F.explode("labels").alias("language", "x")).select("id", "language", F.lit(-1).alias("ord"), F.col("x.value").alias("name"))
    other = entities.select("id", F.explode("aliases").alias("language", "xs")).select("id", "language", F.posexplode("xs").alias("ord", "x")).select("id", "language", "ord", F.col("x.value").alias("name"))
    return label.unionByName(other)


def language_scripts(entities: DataFrame) -> DataFrame:
    """(language, script): the script of most labels of a language; the language 'mul' has none."""
    per = entities.select(F.explode("labels").alias("language", "x")).filter("language <> 'mul'").groupBy("language", script_of(F.col("x.value")).alias("script")).agg(F.count("*").alias("n"))
    return per.groupBy("language").agg(F.max_by("script", F.struct("n", "script")).alias("script"))


def select_aliases(entities: DataFrame, languages: DataFrame) -> DataFrame:
    """(id, language, ord, alias): usable names per language, each once whatever its case.

    languages: language. Where a language has no label, that of 'mul' stands in if it is in the language's script.
    """
    every = names(entities)
    own = every.join(F.broadcast(languages.select("language").distinct()), "language")
    labelled = own.filter("ord = -1").select("id", "language")
    shared = every.filter("language = 'mul' and ord = -1").select("id", "name").withColumn("script", script_of(F.col("name")))
    stand_in = shared.join(F.broadcast(language_scripts(entities)), "script").join(F.broadcast(languages.select("language").distinct()), "language").join(labelled, ["id", "language"], "left_anti")
    rows = own.unionByName(stand_in.select("id", "language", F.lit(-1).alias("ord"), "name")).filter(usable_alias(F.col("name")))
    first = rows.groupBy("id", "language", F.lower("name").alias("_k")).agg(F.min(F.struct("ord", "name")).alias("x"))
    place = F.row_number().over(Window.partitionBy("id", "language").orderBy("x.ord", "x.name")) - 1
    return first.withColumn("ord", place).select("id", "language", "ord", F.col("x.name").alias("alias"))


def with_surnames(entities: DataFrame, aliases: DataFrame, family_claim: str = "P734") -> DataFrame:
    """aliases and, per language, those of each entity's family-name entities behind its own, each once."""
    family = entities.select("id", F.explode(F.col("claims")[family_claim]).alias("family"))
    more = aliases.withColumnRenamed("id", "family").join(family, "family").select("id", "language", (F.col("ord") + 1000).alias("ord"), "alias")
    every = aliases.unionByName(more).groupBy("id", "language", F.lower("alias").alias("_k")).agg(F.min(F.struct("ord", "alias")).alias("x"))
    place = F.row_number().over(Window.partitionBy("id", "language").orderBy("x.ord", "x.alias")) - 1
    return every.withColumn("ord", place).select("id", "language", "ord", F.col("x.alias").alias("alias"))


def missing(aliases: DataFrame, entities: DataFrame, languages: DataFrame) -> DataFrame:
    """(id, language) pairs without any usable alias."""
    return entities.select("id").distinct().crossJoin(F.broadcast(languages.select("language").distinct())).join(aliases.select("id", "language").distinct(), ["id", "language"], "left_anti")


def described(entities: DataFrame, kind_claim: str = "P31") -> DataFrame:
    """(id, label, description, kinds): what an entity is, for review."""
    return entities.select("id", F.try_element_at("labels", F.lit("en"))["value"].alias("label"), F.try_element_at("descriptions", F.lit("en"))["value"].alias("description"), F.try_element_at("claims", F.lit(kind_claim)).alias("kinds"))


def admitted(kinds: Column, roles: Column, dead: Column, human: str, in_scope: list[str]) -> Column:
    """Whether an entity is an actor: a living human with a public role, or a kind in scope."""
    scope = F.array(*[F.lit(k) for k in in_scope])
    return F.when(F.array_contains(kinds, human), roles & ~dead).otherwise(F.arrays_overlap(kinds, scope))
