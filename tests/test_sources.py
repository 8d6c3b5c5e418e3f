"""Sources, sinks, entities and text assembly on small fixtures."""

import gzip
import json
import random
import zipfile

from pyspark.sql import functions as F

from parallax.functions.text import fold, script_of
from parallax.operators import assemble, entities, grouping, identity, measure
from parallax.sources import gkg, sinks, windows


def test_window_of_json_lines(spark, tmp_path):
    record = lambda u, n=4: json.dumps({"url": u, "title": "t", "lang": "eng", "date": "d", "docembed": [0.5] * n})
    (tmp_path / "new.json.gz").write_bytes(gzip.compress("\n".join([record("https://www.A.test/1"), "", "not json", record("https://b.test/2", 3), '{"title": "x"}']).encode()))
    (tmp_path / "old.json.gz").write_bytes(gzip.compress("\n".join([record("https://c.test/3"), record("https://www.A.test/1")]).encode()))
    rows = windows.read_window(spark, [str(tmp_path / "new.json.gz"), str(tmp_path / "old.json.gz")], ["20260301121500", "20260301120000"], dim=4)
    told = windows.report(rows, ["20260301121500", "20260301120000", "20260301114500"]).first()
    assert (told["lines_seen"], told["lines_unparsed"], told["slots_missing"], told["parse_fidelity"]) == (6, 3, ["20260301114500"], 0.5)
    sound = windows.number_rows(windows.articles(rows)).orderBy("row_idx").collect()
    assert [(r["row_idx"], r["url"], r["domain"]) for r in sound] == [(0, "https://www.A.test/1", "a.test"), (1, "https://c.test/3", "c.test"), (2, "https://www.A.test/1", "a.test")]
    assert {(r["url"], r["slot"]) for r in windows.last_by_url(windows.articles(rows)).collect()} == {("https://www.A.test/1", "20260301120000"), ("https://c.test/3", "20260301120000")}


def test_zip_archives(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "a.zip", "w") as z:
        z.writestr("a.csv", b"one\ttwo\r\nthree\xff\n")
    assert sorted(r["line"] for r in gkg.read_zips(spark, str(tmp_path)).collect()) == ["one\ttwo", "three�"]


def test_fold_and_script(spark):
    rows = [("Él-Ñandú  x", "el nandu x", "latin"), ("Ёлка, й", "елка и", "cyrillic"), ("Ｆｕｌｌ ﬁn", "full fin", "other"), ("2026 --", "2026", "other"), ("在港 a", "在港 a", "cjk"), ("إيران", "ايران", "arabic"), ("ΛΌΓΟΣ", "λογος", "greek"), ("aб", "aб", "latin"), ("бa", "бa", "cyrillic"), ("", "", "other")]
    df = spark.createDataFrame(rows, "t string, f string, s string")
    assert [tuple(r) for r in df.select(fold(F.col("t")), script_of(F.col("t"))).collect()] == [(f, s) for _, f, s in rows]


def test_collapse_is_greedy(spark):
    rows = [(1, "s", "u1", "d1", "T one", None), (2, "s", "u2", "d2", "t ONE!", None), (3, "s", "u3", "d2", "other", None), (4, "s", "u4", "d1", "third", None), (5, "r", "u1", "d1", "T one", None)]
    df = spark.createDataFrame(rows, "evidence_id long, story_id string, url string, domain string, title string, polity string")
    assert sorted(r["evidence_id"] for r in measure.collapse(df).collect()) == [1, 3, 5]


def test_structure_finds_a_split(spark):
    cell = lambda s, p, n, e: (s, "a", p, n, e)
    rows = [cell("split", p, 4 if p < "D" else 0, 4) for p in "ABCDEF"] + [cell("even", p, 2, 4) for p in "ABCDEF"] + [cell("all", p, 4, 4) for p in "AB"] + [cell("one", "A", 2, 4)]
    got = {r["story_id"]: r for r in measure.structure_test(spark.createDataFrame(rows, "story_id string, actor string, polity string, named long, evaluable long")).collect()}
    assert set(got) == {"split", "even"} and got["split"]["p"] <= 0.01 and got["even"]["p"] > 0.2
    assert got["split"]["floor"] == round(1 / 2001, 4) and not got["split"]["powered"]


def test_forest_has_the_components_of_all_edges(spark):
    rng = random.Random(4)
    edges = [(a, b, round(rng.random(), 3)) for a in range(60) for b in range(a + 1, 60) if rng.random() < 0.1]
    df = spark.createDataFrame(edges, grouping.EDGE).repartition(6)
    forest = grouping.spanning_forest(df, width=2)
    assert forest.count() <= 59
    for at in (0.2, 0.5, 0.8):
        want = {}
        for _ in range(60):
            for a, b, w in edges:
                if w >= at:
                    low = min(want.get(a, a), want.get(b, b))
                    want[a] = want[b] = low
        assert {r["id"]: r["component"] for r in grouping.components(forest, at).collect()} == want


def test_threshold_stops_before_the_bridge(spark):
    edges = [(0, 1, 0.9), (1, 2, 0.9), (0, 2, 0.9), (3, 4, 0.9), (4, 5, 0.9), (3, 5, 0.9), (2, 3, 0.62)]
    forest = grouping.spanning_forest(spark.createDataFrame(edges, grouping.EDGE))
    at = grouping.threshold(forest, 6, 0.55, 0.55).first()["threshold"]
    assert at > 0.62
    assert sorted({r["component"] for r in grouping.components(forest, at).collect()}) == [0, 3]
    assert grouping.threshold(forest.limit(0), 6, 0.5, 0.55).first()["threshold"] == 0.95


def test_identity_walk(spark):
    known = spark.createDataFrame([("a", u, 0) for u in "pqrs"] + [("b", u, 1) for u in "tu"] + [("c", "z", 2)], "id string, url string, prior_rank long")
    clusters = spark.createDataFrame([(0, u) for u in "pqtu"] + [(1, u) for u in "rs"] + [(2, "new")], "cluster long, url string")
    got = [(r["type"], r["cluster"], r["sources"]) for r in identity.reconcile(clusters, known).orderBy("seq").collect()]
    assert got == [("merged", 0, ["b"]), ("split", 1, ["a"]), ("created", 2, []), ("dormant", None, [])]


def test_assembly(spark):
    words = [f"w{i}" for i in range(40)]
    pieces = [("u", i // 4, " ".join(words[i : i + 6])) for i in range(0, 36, 3)]
    random.Random(1).shuffle(pieces)
    df = spark.createDataFrame(pieces + [("v", 0, "alone")], "url string, pos int, text string")
    assert {tuple(r) for r in assemble.assembled(df).collect()} == {("u", " ".join(words[:39])), ("v", "alone")}
    stamps = spark.createDataFrame([("20260301105900",), ("2026-03-01T10:00:00",)], "stamp string")
    assert sorted(r["minute"] for r in assemble.minutes(stamps).collect()) == ["202603011000", "202603011001", "202603011058", "202603011059"]


def test_entities(spark):
    v = lambda x: {"value": x}
    rows = [("Q1", {"en": v("Iran"), "mul": v("Iran")}, {"en": [v("Persia"), v("IRAN"), v("IR")]}, {"en": v("country")}, {"P734": ["Q2"]}), ("Q2", {"en": v("Farsi"), "ru": v("Иран")}, {}, {}, {})]
    df = spark.createDataFrame(rows, entities.ENTITY)
    languages = spark.createDataFrame([("en",), ("ru",), ("de",)], "language string")
    own = entities.select_aliases(df, languages)
    assert sorted((r["id"], r["language"], r["ord"], r["alias"]) for r in own.collect()) == [("Q1", "en", 0, "Iran"), ("Q1", "en", 1, "Persia"), ("Q2", "en", 0, "Farsi"), ("Q2", "ru", 0, "Иран")]
    merged = {(r["id"], r["language"], r["alias"]) for r in entities.with_surnames(df, own).collect()}
    assert ("Q1", "ru", "Иран") in merged and ("Q1", "en", "Farsi") in merged
    assert ("Q1", "de") in {tuple(r) for r in entities.missing(own, df, languages).collect()}
    assert entities.described(df).filter("id = 'Q1'").first()["description"] == "country"


def test_packed_series(spark, tmp_path):
    df = spark.sql("select 'p' as actor, x.polity, date(x.day) as day, x.n as named, x.e as evaluable from values ('I', '2026-03-02', 1, 2), ('I', '2026-03-01', 3, 5), ('S', '2026-03-02', 0, 1) as x(polity, day, n, e)")
    assert sinks.packed_series(df).first()["polities"] == {"I": [[0, 3, 5], [1, 1, 2]], "S": [[1, 0, 1]]}
    doc = sinks.story_documents(spark.sql("select 's' as story_id, 'h' as headline"), spark.sql("select 's' as story_id, 'a' as actor, 1 as named")).first()["document"]
    assert json.loads(doc) == {"story_id": "s", "headline": "h", "figures": [{"actor": "a", "named": 1}]}
    assert "<entry>" in sinks.feed_document(spark.sql("select 's' as id, 'h &amp; i' as headline"), "r")
