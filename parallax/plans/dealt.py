"""Queries of the general data-processing problems (3 and 4)."""

from __future__ import annotations

from parallax.operators import packed_values
from parallax.plans.registry import query
from parallax.sources import rejects
from parallax.sources.tables import table


@query("p3_found")
def p3_found(spark, folder):
    return rejects.read_feed(table(spark, folder, "gkg_raw"))[1].select("line_id", "reason")


@query("p3_sound")
def p3_sound(spark, folder):
    return rejects.read_feed(table(spark, folder, "gkg_raw"))[0]


@query("p4_found")
def p4_found(spark, folder):
    return packed_values.packed_fields(table(spark, folder, "gkg"))


@query("p4_values")
def p4_values(spark, folder):
    return packed_values.split_values(table(spark, folder, "gkg"))


@query("p4_guided")
def p4_guided(spark, folder):
    """Values where a comma may belong to one: known whole values decide."""
    return packed_values.split_values(table(spark, folder, "gkg"), comma_always=False)
