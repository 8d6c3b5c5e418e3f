"""Lookups of a publisher's polity and of a language's code."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A dimension of up to this many rows is broadcast.
SMALL = 100_000


def small(df: DataFrame) -> DataFrame:
    """df, broadcast if it has few rows by count."""
    return F.broadcast(df) if df.count() <= SMALL else df


def authority_domain(url: Column) -> Column:
    """Authority of an address in lower case without a leading www.; user info and port stay."""
    return F.regexp_replace(F.lower(F.try_parse_url(url, F.lit("AUTHORITY"))), r"^www\.", "")


def language_code(df: DataFrame, languages: DataFrame, name: str = "language", out: str = "code") -> DataFrame:
    """Add the code of a language's name, null where it can't be mapped; case and outer spaces don't matter."""
    dim = languages.select(F.lower(F.trim("gdelt_name")).alias("_name"), F.col("code").alias(out)).distinct()
    return df.join(small(dim), F.lower(F.trim(F.col(name))) == F.col("_name"), "left").drop("_name")


def polity(domains: DataFrame, tlds: DataFrame, exact: DataFrame, domain: str = "domain") -> DataFrame:
    """(domain, polity) of distinct domains: by top-level domain of two labels, of one, then exactly, then by parents.

    tlds and exact hold (name, polity). The nearest parent wins and a bare top-level domain is no parent.
    """
    names = domains.select(F.col(domain).alias("domain")).filter("domain is not null").distinct()
    labels = F.split("domain", r"\.")
    keyed = names.withColumn("two", F.concat_ws(".", F.slice(labels, -2, 2))).withColumn("one", F.element_at(labels, -1)).withColumn("two", F.when(F.size(labels) >= 2, F.col("two")).otherwise(F.col("domain")))
    by = small(tlds.select(F.lower("name").alias("name"), "polity"))
    keyed = keyed.join(by.select(F.col("name").alias("two"), F.col("polity").alias("p2")), "two", "left").join(by.select(F.col("name").alias("one"), F.col("polity").alias("p1")), "one", "left")
    # exact names and parents in one go: the fewest labels cut off win
    up = F.when(F.size(labels) >= 2, F.sequence(F.lit(0), F.size(labels) - 2)).otherwise(F.array(F.lit(0)))
    parents = names.select("domain", F.explode(F.transform(up, lambda k: F.struct(k.alias("cut"), F.concat_ws(".", F.slice(labels, k + 1, F.size(labels) - k)).alias("name")))).alias("x")).select("domain", "x.*")
    hits = parents.join(small(exact.filter("polity is not null").select(F.lower("name").alias("name"), F.col("polity").alias("p"))), "name").groupBy("domain").agg(F.min_by("p", "cut").alias("p0"))
    return keyed.join(hits, "domain", "left").select("domain", F.coalesce("p2", "p1", "p0").alias("polity"))


def coverage(placed: DataFrame) -> DataFrame:
    """(domains, placed, rate)."""
    return placed.agg(F.count("*").alias("domains"), F.count("polity").alias("placed"), F.round(F.count("polity") / F.count("*"), 4).alias("rate"))


def bulk_lookup(rows: DataFrame, tlds: DataFrame, renamed: DataFrame, corrected: DataFrame) -> DataFrame:
    """(domain, polity): the bulk table of domains, without those that their top-level domain decides.

    rows: domain, polity; tlds and renamed: name, polity; corrected: domain, polity. Country names become one form, then the
    corrections hold, for domains of the table and others.
    """
    labels = F.split("domain", r"\.")
    lower = rows.filter("domain is not null and polity is not null").select(F.lower("domain").alias("domain"), "polity")
    ends = lower.withColumn("_ends", F.array(F.concat_ws(".", F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2)), F.element_at(labels, -1)))
    by = F.broadcast(tlds.agg(F.collect_set(F.lower("name")).alias("_tlds")))  # one row
    open_ = ends.join(by).filter(~F.arrays_overlap("_ends", "_tlds")).select("domain", "polity")
    named = open_.join(small(renamed.select(F.col("name").alias("polity"), F.col("polity").alias("_one"))), "polity", "left").select("domain", F.coalesce("_one", "polity").alias("polity"))
    own = small(corrected.select(F.lower("domain").alias("domain"), "polity"))
    return named.join(own.select("domain"), "domain", "left_anti").unionByName(corrected.select(F.lower("domain").alias("domain"), "polity")).distinct()
