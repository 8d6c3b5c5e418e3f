from parallax.plans import graph


def test_whole_runs_are_reconciled(spark, tmp_path):
    """Every row counts: no side is chosen by id, and stories are those of story_id."""
    old = [(i, "20260301T000000Z", "a", f"u{i}") for i in range(10)] + [(10, "20260301T010000Z", "b", "v")]
    new = [(20 + i, "20260302T000000Z", "c", f"u{i}") for i in range(10)] + [(30, "20260302T010000Z", "d", "w")]
    spark.createDataFrame(old + new, "evidence_id long, run string, story_id string, url string").write.parquet(f"{tmp_path}/evidence.parquet")
    got = graph.run_containment(spark, str(tmp_path)).collect()
    assert [tuple(r) for r in got] == [("a", 10, 10, 1.0)]
    events = sorted((r["type"], r["id"]) for r in graph.reconcile_events(spark, str(tmp_path)).collect())
    assert [e[0] for e in events] == ["created", "dormant", "kept"] and events[1:] == [("dormant", "b"), ("kept", "a")]


def test_every_url_is_on_a_side(spark, data):
    now, known = graph._runs(spark, data)
    urls = spark.read.parquet(f"{data}/evidence.parquet").select("url").distinct()
    assert now.select("url").union(known.select("url")).distinct().count() == urls.count()
    assert now.select("cluster").distinct().count() > 1 and known.select("id").distinct().count() > 1
