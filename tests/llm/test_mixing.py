import random

from parallax.llm.mixing import corpus_total, draw, reachable_total


def test_shares_and_caps(spark):
    rng = random.Random(2)
    docs = [(i, rng.choice(["a"] * 5 + ["b", "c"]), rng.randrange(1, 400)) for i in range(6000)]
    docs += [(90_000, None, 50), (90_001, "other", 50), (90_002, "a", 0), (90_003, "a", None)]
    df = spark.createDataFrame(docs, "doc_id long, source string, n_tokens int").selectExpr("*", "1 as slot", "2 as repeat", "3 as size", "4 as id", "5 as rank", "6 as at").repartition(4)
    targets = spark.createDataFrame([("a", 0.2, 2), ("b", 0.5, 3), ("c", 0.2, None), ("empty", 0.1, 4), (None, 0.0, 1)], "source string, target_share double, max_repeats int")
    mixture, shares = draw(df, targets, reachable_total(df, targets), block=256)
    rows = mixture.collect()
    size = {i: n for i, _, n in docs}
    home = {i: s for i, s, _ in docs}
    times = {}
    for r in rows:
        assert r["source"] == home[r["doc_id"]] and r["n_tokens"] == size[r["doc_id"]]
        times.setdefault(r["doc_id"], []).append(r["repeat"])
    for i, repeats in times.items():
        assert sorted(repeats) == list(range(1, len(repeats) + 1))
        assert len(repeats) <= {"a": 2, "b": 3, "c": 1}[home[i]]
    told = {r["source"]: r for r in shares.collect()}
    whole = sum(r["n_tokens"] for r in rows)
    for name, share in (("a", 0.2 / 0.9), ("b", 0.5 / 0.9), ("c", 0.2 / 0.9)):
        assert abs(told[name]["actual_share"] - share) < 0.005
        assert told[name]["drawn_tokens"] == sum(r["n_tokens"] for r in rows if r["source"] == name)
    assert told["empty"]["actual_share"] == 0 and abs(sum(r["actual_share"] for r in told.values()) - 1) < 1e-9
    # the schedule mixes: every stretch of slots holds each source about as often
    slots = sorted({(r["slot"], r["source"]) for r in rows})
    half = len(slots) // 2
    for name in "abc":
        assert abs(sum(s == name for _, s in slots[:half]) - sum(s == name for _, s in slots[half:])) <= 0.1 * half
    assert whole > 0


def test_total_beyond_supply_and_empty(spark):
    df = spark.createDataFrame([(i, "a" if i % 2 else "b", 10) for i in range(200)], "doc_id long, source string, n_tokens int")
    targets = spark.createDataFrame([("a", 0.9, 1), ("b", 0.1, 1)], "source string, target_share double, max_repeats int")
    _, shares = draw(df, targets, total=5000, block=64)
    got = {r["source"]: r["drawn_tokens"] for r in shares.collect()}
    assert got["a"] == 1000 and abs(got["b"] - 500) <= 10
    mixture, shares = draw(df.limit(0), targets, reachable_total(df.limit(0), targets))
    assert mixture.count() == 0 and {r["actual_share"] for r in shares.collect()} == {0.0}


def test_short_sources_fall_short(spark):
    """The total is that of the documents: scarce sources give all they may, none goes beyond its part, gaps are filled."""
    rng = random.Random(5)
    docs = [(i, "big", rng.choice([3, 50, 900, 5000])) for i in range(900)] + [(1000 + i, "small", 40) for i in range(20)]
    df = spark.createDataFrame(docs, "doc_id long, source string, n_tokens int").repartition(3)
    targets = spark.createDataFrame([("big", 0.6, 1), ("small", 0.4, 2)], "source string, target_share double, max_repeats int")
    total = corpus_total(df, targets)
    assert total == sum(n for _, _, n in docs)
    mixture, shares = draw(df, targets, total, block=128)
    told = {r["source"]: r for r in shares.collect()}
    assert told["small"]["drawn_tokens"] == 1600 and told["small"]["actual_share"] < 0.01 and told["small"]["most_repeats"] == 2
    rows = mixture.collect()
    big = [r for r in rows if r["source"] == "big"]
    left = told["big"]["wanted"] - told["big"]["drawn_tokens"]
    assert 0 <= left < 3 or {r["doc_id"] for r in big} >= {i for i, s, n in docs if s == "big" and n <= left}
    assert len(rows) == len({(r["doc_id"], r["repeat"]) for r in rows})
    # the scarce source is spread over the whole schedule
    last = max(r["slot"] for r in rows)
    assert sum(r["slot"] > last / 2 for r in rows if r["source"] == "small") >= 10
