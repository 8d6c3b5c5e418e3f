"""Frequency of every distinct value or term (problem 1).

Heavy-light aggregation: a frequent-items sketch over all rows detects the heavy terms; they are broadcast and counted
in exact local arrays, one slot per heavy term, so that a task sends each of them once however often it occurs. Only the
other terms are shuffled as they come (pre-summed per batch). Both tables are united and summed once more.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A term is a maximal run of letters and decimal digits of any script.
TERM = r"[\p{L}\p{Nd}]+"
#: Slots of the local arrays: at most so many terms, of at most so many characters, are broadcast per field.
HEAVY_SLOTS = 1000
HEAVY_LENGTH = 64
SKETCH_ITEMS = 16384


def term_lists(df: DataFrame, text_fields: Sequence[str], value_fields: Sequence[str]) -> DataFrame:
    """One array of terms per field and row: lower-cased runs of text fields, the whole value of the others."""
    runs = [F.transform(F.regexp_extract_all(F.col(f"`{c}`"), F.lit(TERM), F.lit(0)), lambda x: F.lower(x)).alias(c) for c in text_fields]
    values = [F.when(F.col(f"`{c}`").isNotNull(), F.array(F.col(f"`{c}`"))).alias(c) for c in value_fields]
    return df.select(*runs, *values)


def heavy_terms(lists: DataFrame, fields: Sequence[str], slots: int = HEAVY_SLOTS) -> dict[str, list[str]]:
    """The likely most frequent terms of each field, from a sketch per field over all rows, in one pass.

    The sketches only decide which terms get a slot; their counts are exact. Their size is fixed, as is that of the answer:
    `slots` terms of HEAVY_LENGTH characters a field.
    """
    named = [F.transform(F.coalesce(F.col(f"`{c}`"), F.array().cast("array<string>")), lambda x, c=c: F.struct(F.lit(c).alias("field"), x.alias("term"))) for c in fields]
    terms = lists.select(F.explode(F.concat(*named)).alias("x")).select("x.*").filter(F.length("term") <= HEAVY_LENGTH)
    rows = terms.groupBy("field").agg(F.expr(f"approx_top_k(term, {slots}, {SKETCH_ITEMS})").alias("top")).collect()  # one row a field
    found = {r["field"]: sorted(x["item"] for x in r["top"] or [] if x["count"] > 1) for r in rows}
    return {c: found.get(c, []) for c in fields}


def _counter(fields: Sequence[str], heavy: dict[str, list[str]]):
    """The counting kernel: (field, term, occurrences, n_rows, heavy) for each partition."""
    schema = pa.schema([("field", pa.string()), ("term", pa.string()), ("occurrences", pa.int64()), ("n_rows", pa.int64()), ("heavy", pa.bool_())])

    def emit(field: str, term: pa.Array, occurrences, rows, is_heavy: bool) -> pa.RecordBatch:
        n = len(term)
        return pa.RecordBatch.from_arrays(
            [pa.array([field] * n, pa.string()), term.cast(pa.string()), pa.array(occurrences, pa.int64()), pa.array(rows, pa.int64()), pa.array([is_heavy] * n, pa.bool_())],
            schema=schema,
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slots = {c: pa.array(heavy[c], pa.string()) for c in fields}
        local = {c: np.zeros((2, len(heavy[c])), np.int64) for c in fields}
        for batch in batches:
            for c in fields:
                lists = batch.column(batch.schema.get_field_index(c))
                terms, parents = lists.flatten(), np.asarray(pc.list_parent_indices(lists), np.int64)
                if not len(terms):
                    continue
                coded = terms.dictionary_encode()
                words, codes = coded.dictionary, np.asarray(coded.indices, np.int64)
                occurrences = np.bincount(codes, minlength=len(words))
                # a term counts once a row: distinct (row, term) pairs of the batch
                pairs = np.unique(parents * len(words) + codes)
                rows = np.bincount(pairs % len(words), minlength=len(words))
                slot = np.asarray(pc.fill_null(pc.index_in(words, slots[c]), -1), np.int64)
                hit = slot >= 0
                local[c][0][slot[hit]] += occurrences[hit]
                local[c][1][slot[hit]] += rows[hit]
                if not hit.all():
                    rest = np.flatnonzero(~hit)
                    yield emit(c, words.take(pa.array(rest)), occurrences[rest], rows[rest], False)
        for c in fields:
            seen = np.flatnonzero(local[c][0])
            if len(seen):
                yield emit(c, slots[c].take(pa.array(seen)), local[c][0][seen], local[c][1][seen], True)

    return count


def term_frequencies(
    df: DataFrame,
    text_fields: Sequence[str] = ("title",),
    value_fields: Sequence[str] = ("language", "domain"),
    rare_below: int = 3,
    common_above: float = 0.05,
    slots: int = HEAVY_SLOTS,
) -> DataFrame:
    """(field, term, occurrences, n_rows, mark): every distinct term of every field over all rows.

    mark is 'rare' if the term is in fewer than rare_below rows, 'common' if it is in more than common_above of all rows
    of df (rows without the field count), else null; rare goes first where both hold. Nulls give no term, nor does text
    without letters or digits; an empty value of a value field is a value. A term repeated in a row adds to occurrences
    and once to n_rows; repeated rows count each. Texts may be of any length. An empty table gives an empty result.
    Other columns are ignored, whatever their names.
    """
    fields = [*text_fields, *value_fields]
    lists = term_lists(df, text_fields, value_fields)
    total = df.count()
    heavy = heavy_terms(lists, fields, slots)
    counted = lists.mapInArrow(_counter(fields, heavy), "field string, term string, occurrences bigint, n_rows bigint, heavy boolean")
    sums = counted.groupBy("field", "term", "heavy").agg(F.sum("occurrences").alias("occurrences"), F.sum("n_rows").alias("n_rows"))
    mark = F.when(F.col("n_rows") < rare_below, "rare").when(F.col("n_rows") > common_above * total, "common")
    return sums.select("field", "term", "occurrences", "n_rows", mark.alias("mark"))


def marked_terms(df: DataFrame, **options) -> DataFrame:
    """(field, term, mark) of the terms too rare or too common to be useful."""
    return term_frequencies(df, **options).filter(F.col("mark").isNotNull()).select("field", "term", "mark")
