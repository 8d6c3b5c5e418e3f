"""What a run publishes, on small fixtures."""

import json

from pyspark.sql import functions as F

from parallax.operators import dims, publish, reads
from parallax.sources import sinks


def test_exact_value_of_two_polities(spark):
    from math import comb

    cells = spark.createDataFrame([("s", "a", "P", 4, 4), ("s", "a", "Q", 0, 4), ("t", "a", "P", 2, 4), ("t", "a", "Q", 2, 4), ("u", "a", "P", 1, 1), ("u", "a", "Q", 1, 1), ("v", "a", "P", 9, 9)], "story_id string, actor string, polity string, named long, evaluable long")
    got = {r["story_id"]: r["p"] for r in publish.exact_structure(cells).collect()}
    assert got == {"s": round(2 / comb(8, 4), 6), "t": 1.0}


def test_english_is_preferred(spark):
    rows = [(1, "s", "u1", "grain price rises again today", "en"), (2, "s", "u2", "el precio sube", "es"), (3, "s", "u3", "el precio sube otra vez", "es"), (4, "t", "u4", "uno dos", "SPANISH"), (5, "t", "u5", "uno dos tres", None)]
    df = spark.createDataFrame(rows, "evidence_id long, story_id string, url string, title string, language string")
    assert {r["story_id"]: r["evidence_id"] for r in publish.english_first(df).collect()} == {"s": 1, "t": 4}


def test_order_of_stories(spark):
    schema = "story_id string, featured boolean, position int, span_division double, division double, evidence int"
    rows = [("a", False, 9, 0.2, 0.2, 1), ("b", True, 1, 0.5, 0.5, 1), ("c", True, 0, 0.1, 0.1, 1), ("d", False, 9, 0.9, 0.9, 0), ("e", False, 9, 0.4, 0.4, 2)]
    order = lambda rs: [r["story_id"] for r in publish.display_order(spark.createDataFrame(rs, schema)).orderBy("place").collect()]
    assert order(rows) == ["c", "b", "e", "a"]
    assert order([(i, False, p, s, d, e) for i, _, p, s, d, e in rows]) == ["b", "e", "a", "c"]
    assert order([]) == []


def test_verdicts_and_emotions(spark):
    df = spark.createDataFrame([(0.01, False), (0.4, False), (0.4, True), (None, None)], "p double, powered boolean")
    assert [r[0] for r in df.select(publish.verdict_label(F.col("p"), F.col("powered"))).collect()] == ["found", "unknown", "none", None]
    said = spark.createDataFrame([(1, "Fear", 0.5), (1, "joy", 0.4), (2, "rage", 0.999), (3, "anger", 0.9)], "id long, label string, score double")
    assert {tuple(r) for r in publish.emotion(said).collect()} == {(1, "fear", 60), (2, "neutral", 99), (3, "anger", 100)}


def test_documents(spark):
    aliases = spark.createDataFrame([("x", "en", 1, "B"), ("x", "en", 0, "A"), ("x", "de", 0, "C")], "actor string, language string, ord int, alias string")
    missing = spark.createDataFrame([("x", "ru"), ("x", "fr")], "actor string, language string")
    assert json.loads(sinks.alias_documents(aliases, missing).first()["document"]) == {"table": {"de": ["C"], "en": ["A", "B"]}, "missing": ["fr", "ru"]}
    entries = spark.createDataFrame([(str(i), f"h{i}", i / 100) for i in range(70)], "id string, headline string, span_division double")
    text = sinks.feed_document(entries, "r")
    assert text.count("<entry>") == 70 and text.index("<id>69<") < text.index("<id>3<")


def test_lookups(spark):
    rows = spark.createDataFrame([("A.test", "Old"), ("b.zz", "X"), ("c.co.zz", "Y"), ("d.test", "Z"), (None, "Q")], "domain string, polity string")
    tlds = spark.createDataFrame([("zz", "Zed")], "name string, polity string")
    renamed, corrected = spark.createDataFrame([("Old", "New")], "name string, polity string"), spark.createDataFrame([("d.test", "W"), ("e.test", "V")], "domain string, polity string")
    assert {tuple(r) for r in dims.bulk_lookup(rows, tlds, renamed, corrected).collect()} == {("a.test", "New"), ("d.test", "W"), ("e.test", "V")}
    named = spark.createDataFrame([("north-sea", None), ("x", "The X")], "k string, label string")
    assert [r[0] for r in named.select(reads.display_name(F.col("k"), F.col("label"))).collect()] == ["North Sea", "The X"]
