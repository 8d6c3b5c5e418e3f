"""The distributed ways of graphs that one task may not hold, against the ways of small ones."""

import random

from parallax.operators import grouping
from parallax.params import Params


def edges(seed, nodes=80, share=0.04):
    rng = random.Random(seed)
    return [(a, b, round(rng.random(), 3)) for a in range(nodes) for b in range(a + 1, nodes) if rng.random() < share]


def test_components_and_threshold(spark):
    df = spark.createDataFrame(edges(1), grouping.EDGE).repartition(3)
    forest = grouping.spanning_forest(df)
    small = {tuple(r) for r in grouping.components(forest, 0.3).collect()}
    assert {tuple(r) for r in grouping.components(forest, 0.3, most=5).collect()} == small
    want = grouping.threshold(forest, 80, 0.2, 0.3, 0.9, 0.2).first()[0]
    assert grouping.threshold(forest, 80, 0.2, 0.3, 0.9, 0.2, most=5).first()[0] == want


def test_a_hub_and_a_chain(spark):
    rows = [(0, i, 0.9) for i in range(1, 200)] + [(i, i + 1, 0.9) for i in range(300, 320)]
    got = dict(tuple(r) for r in grouping.contracted(spark.createDataFrame(rows, grouping.EDGE)).collect())
    assert got == {**{i: 0 for i in range(200)}, **{i: 300 for i in range(300, 321)}}


def test_two_stages(spark):
    rng = random.Random(4)
    rows = []
    for theme in range(3):
        for part in range(2):
            ids = [100 * theme + 10 * part + k for k in range(8)]
            rows += [(a, b, 0.8 + rng.random() / 10) for a in ids for b in ids if a < b]
        rows.append((100 * theme, 100 * theme + 10, 0.6))
    rows += [(900 + a, 900 + b, 0.905) for a in range(9) for b in range(a + 1, 9)]
    forest = grouping.spanning_forest(spark.createDataFrame(rows, grouping.EDGE))
    params = Params(theme_share=0.4, story_share=0.6)
    small = {tuple(r) for r in grouping.two_stage(forest, 57, params).collect()}
    assert {s for _, _, s in small} == {0, 10, 100, 110, 200, 210} and len(small) == 48
    told = grouping.two_stage_report(forest, 57, params).first().asDict()
    assert (told["themes"], told["unsplit_themes"], told["stories"], told["articles_in_stories"]) == (4, 1, 6, 48)


def test_growth_is_looked_up():
    import numpy as np

    scores, largest = grouping.growth(np.array([0, 2, 1]), np.array([1, 3, 2]), np.array([0.9, 0.8, 0.7], np.float32))
    assert largest.tolist() == [1, 2, 2, 4] and len(scores) == 3
    assert grouping.search(np.array([0]), np.array([1]), np.array([0.99], np.float32), 2, 0.5, 0.5, 0.95, 0.01) is None
