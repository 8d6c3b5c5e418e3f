import numpy as np

from parallax.operators import grouping
from parallax.plans import graph


def _rows(spark, labels, apart):
    rng = np.random.default_rng(7)
    centre = {k: rng.normal(size=8) * apart for k in range(labels)}
    rows = [(10 * k + i, k, (centre[k] + rng.normal(size=8)).tolist()) for k in range(labels) for i in range(10)]
    return spark.createDataFrame(rows, "id bigint, label bigint, v array<double>")


def test_all_groups_are_projected(spark):
    got = grouping.project(_rows(spark, 5, 0.01), least_agreement=0.0).toPandas()
    assert set(got["label"]) == set(range(5)) and len(got) == 50
    assert got["agreement"].max() < 0.75


def test_refusal(spark):
    assert grouping.project(_rows(spark, 5, 0.01)).count() == 0
    assert grouping.project(_rows(spark, 3, 50.0)).count() == 30


def test_query_hands_every_label_and_the_production_floor_over(spark, data, monkeypatch):
    seen = {}

    def project(rows, **options):
        seen.update(options, labels={r[0] for r in rows.select("label").distinct().collect()})
        return rows.selectExpr("id", "label", "0L as x", "0L as y")

    monkeypatch.setattr(grouping, "project", project)
    graph.projection(spark, data)
    assert seen.pop("labels") == {r[0] for r in spark.read.parquet(f"{data}/embeddings.parquet").select("label").distinct().collect()}
    assert seen == {}
