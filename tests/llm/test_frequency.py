import collections
import re

import pytest

from parallax.llm.frequency import marked_terms, term_frequencies


def brute(rows):
    occurrences, held = collections.Counter(), collections.Counter()
    for title, language, domain in rows:
        cells = [("title", m.lower()) for m in re.findall(r"[^\W_]+", title or "")]
        cells += [("language", language)] if language is not None else []
        cells += [("domain", domain)] if domain is not None else []
        occurrences.update(cells)
        held.update(set(cells))
    mark = lambda n: "rare" if n < 3 else "common" if n > 0.05 * len(rows) else None
    return {(f, t, occurrences[f, t], n, mark(n)) for (f, t), n in held.items()}


@pytest.mark.parametrize("slots", [1, 5, 1000])
def test_counts(spark, slots):
    rows = [(f"The {i % 7} quay-{i % 3} the ΛΟΓΟΣ İzmir Straße 在港 word{i}", "EN" if i % 5 else None, "big.test" if i % 3 else f"d{i}.test") for i in range(300)]
    rows += [(None, None, None), ("", "", ""), ("!!! --", " ", "x"), ("long " * 30_000 + "tail", "EN", "y")] + rows[:10]
    df = spark.createDataFrame(rows, "title string, language string, domain string").selectExpr("*", "1 as term", "2 as n_rows", "3 as field").repartition(5)
    got = {tuple(r) for r in term_frequencies(df, slots=slots).collect()}
    assert got == brute(rows)
    assert {tuple(r) for r in marked_terms(df, slots=slots).collect()} == {(f, t, m) for f, t, _, _, m in brute(rows) if m}


def test_empty(spark):
    assert term_frequencies(spark.createDataFrame([], "title string, language string, domain string")).count() == 0
