"""Duplicates hidden by formatting differences (problem 7).

Dictionary encoding: each distinct value of the compared columns is canonicalised once and gets an integer; records
become sorted tuples of such integers, and only these compact tuples are grouped.

The integer of a canonical value is the smallest cell (record number x columns + column) that holds it. It needs no
numbering pass, and a task that is run again after a loss gives the same one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parallax.functions.lineage import cut, heavy_light_lookup

#: A value or tuple met by more than one in so many rows is joined by broadcast; there can't be more of them than this.
HEAVY_PARTS = 1000


def canonical(c: Column) -> Column:
    """Letters and digits only, in order, without case: upper then lower folds sharp s, final sigma and dotless i alike.

    The replacement in between also keeps the optimiser from dropping the inner conversion.
    """
    bare = F.regexp_replace(c, r"[^\p{L}\p{N}]+", "")
    return F.regexp_replace(F.lower(F.translate(F.upper(bare), "İ", "I")), r"[^\p{L}\p{N}]+", "")


def encode_records(df: DataFrame, id_col: str, fields: Sequence[str]) -> DataFrame:
    """(id, codes): the sorted integers of the canonical values of a record, for records whose fields all have one.

    id_col must be unique. Fields that are null or have no letter or digit leave their record out.
    """
    k = len(fields)
    cells = df.select(F.posexplode(F.array(*[F.col(f"`{c}`").cast("string") for c in fields])).alias("at", "raw"), F.col(f"`{id_col}`").cast("long").alias("id"))
    cells = cells.filter(F.col("raw").isNotNull()).select((F.col("id") * k + F.col("at")).alias("cell"), "raw")
    # each distinct raw value once; repeated values meet before the shuffle
    distinct = cells.groupBy("raw").agg(F.min("cell").alias("first"), F.count("*").alias("met"))
    words = cut(distinct.select("raw", "first", "met", canonical(F.col("raw")).alias("canon")).filter("canon <> ''"), "words")
    codes = words.groupBy(F.col("canon")).agg(F.min("first").alias("code"), F.count("*").alias("forms"))
    heavy_above = max(1, df.count() * k // HEAVY_PARTS)
    # values with one form only keep their first cell as code; the others look theirs up
    coded = heavy_light_lookup(words, codes, ["canon"], "forms", heavy_above, ["code"])
    entries = cut(coded.select("raw", "met", "code"), "entries")
    found = heavy_light_lookup(cells, entries, ["raw"], "met", heavy_above, ["code"]).select("cell", "code")
    record = F.floor(F.col("cell") / F.lit(k)).cast("long") if k == 1 else F.expr(f"cell div {k} - CASE WHEN cell % {k} < 0 THEN 1 ELSE 0 END")
    return (
        found.groupBy(record.alias("id"))
        .agg(F.sort_array(F.collect_list("code")).alias("codes"))  # at most one code a field
        .filter(F.size("codes") == k)
    )


def formatting_duplicates(df: DataFrame, id_col: str, fields: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(classes, members) of records equal but for white space, case, punctuation or field order.

    classes: (first_id, n_copies), one row per distinct tuple; members: (first_id, id), one row per record. Records with
    a null field, or one without letters and digits, are in neither. Empty tables give empty results; equal rows are
    copies of each other; texts of any length are compared whole; other columns are ignored.
    """
    records = cut(encode_records(df, id_col, fields), "records")
    classes = records.groupBy("codes").agg(F.min("id").alias("first_id"), F.count("*").alias("n_copies"))
    heavy_above = max(1, records.count() // HEAVY_PARTS)
    repeated = cut(classes.filter("n_copies > 1"), "classes")
    members = heavy_light_lookup(records, repeated, ["codes"], "n_copies", heavy_above, ["first_id"])
    return classes.select("first_id", "n_copies"), members.select("first_id", "id")


def copies(df: DataFrame, id_col: str = "capture_id", fields: Sequence[str] = ("title", "domain")) -> DataFrame:
    """(first_id, copy_id): one row for each member of a set of copies but its first."""
    _, members = formatting_duplicates(df, id_col, fields)
    return members.filter("id <> first_id").select("first_id", F.col("id").alias("copy_id"))


def distinct_records(df: DataFrame, id_col: str = "capture_id", fields: Sequence[str] = ("title", "domain")) -> DataFrame:
    """(first_id, n_copies): one row per distinct record with the number of rows that carry it."""
    classes, _ = formatting_duplicates(df, id_col, fields)
    return classes
