import random

import pytest
from pyspark.sql import functions as F

from parallax.functions.addresses import address_host, address_number, stamp_seconds
from parallax.llm.history_dedup import REACH, PivotTable, deduplicate_batches, points


def test_addresses(spark):
    cases = [
        ("https://WWW.A.Test:443//article?id=100005#main", "www.a.test", "100005"), ("http://u@a.test/world/story.php?sec=x&sid=100037", "a.test", "100037"), ("https://a.test/news/100003/x-2026/?ref=1", "a.test", "100003"),
        ("https://a.test/2026/03/03/school%2Drail-2026-100046?_ts=99608", "a.test", "100046"), ("https://a.test/a/100009/#p3", "a.test", "100009"), ("http://a.test/x-y-100006.html", "a.test", "100006"), ("ftp://a.test/100006", None, "100006"), ("https://a.test/about", "a.test", None),
    ]
    df = spark.createDataFrame(cases, "u string, h string, n string")
    assert df.select(address_host(F.col("u")).alias("a"), "h", address_number(F.col("u")).alias("b"), "n").filter("not (a <=> h and b <=> n)").count() == 0


def test_stamps(spark):
    cases = [("20260302020843", 1772417323), ("2026-03-02T02:08:43Z", 1772417323), ("20260302T020843Z", 1772417323), ("2026-03-02 04:08:43+02:00", 1772417323), ("2026-03-01 21:08:43-0500", 1772417323), ("", None), ("00000000000000", None), ("20261302020843", None), (None, None), ("yesterday", None)]
    df = spark.createDataFrame(cases, "s string, t long")
    assert df.filter(~stamp_seconds(F.col("s")).eqNullSafe(F.col("t"))).count() == 0


def make(rng, n):
    rows = []
    for i in range(n):
        pub, num = rng.choice(["a.test", "b.test", "sub.b.test"]), 100000 + (0 if rng.random() < 0.3 else rng.randrange(20))
        hour = rng.randrange(24 * 25)
        stamp = f"202603{1 + hour // 24:02d}{hour % 24:02d}{rng.choice(['0000', '3000'])}"
        url = rng.choice([f"https://{pub}/a/{num}", f"http://WWW.{pub}:80/a/{num}/?x=1", f"https://m.{pub}/article?id={num}"])
        rows.append((i, f"run{i // 100:04d}", url, rng.choice([stamp] * 9 + ["", None])))
    return rows


def brute(spark, df, publishers):
    kept, out = {}, set()
    for r in sorted(points(df, publishers).collect(), key=lambda r: r["id"]):
        near = [i for i, t in kept.setdefault(r["key"], []) if abs(t - r["t"]) <= REACH]
        if near:
            out.add((near[0], r["id"]))
        else:
            kept[r["key"]].append((r["id"], r["t"]))
    return out


@pytest.mark.parametrize("seed,batches", [(1, 1), (2, 3), (3, 7)])
def test_against_brute_force(spark, seed, batches):
    rows = make(random.Random(seed), 700) + [(9000, "run9", None, "20260302020843"), (9001, "run9", "not a url", "20260302020843"), (9002, "run9", "https://" + "x" * 50_000 + ".test/about", "20260302020843")]
    df = spark.createDataFrame(rows, "capture_id long, run string, url string, seen_at string").selectExpr("*", "1 as id", "2 as key", "3 as t", "4 as cell", "5 as publisher").repartition(3)
    publishers = spark.createDataFrame([("a.test",), ("b.test",), ("sub.b.test",), (None,)], "domain string")
    assert {tuple(r) for r in deduplicate_batches(df, publishers, batches=batches).collect()} == brute(spark, df, publishers)


def test_history_grows_by_batches(spark):
    table = PivotTable(spark)
    point = lambda *rows: spark.createDataFrame(list(rows), "id long, key string, t long")
    assert table.admit(point((1, "x", 1000), (2, "y", 1000))).count() == 0
    assert [tuple(r) for r in table.admit(point((3, "x", 1000 + REACH), (4, "x", 1001 + REACH), (5, "x", 5000 + REACH))).collect()] == [(1, 3), (4, 5)]
    assert sorted(r["id"] for r in table.read().collect()) == [1, 2, 4]
    again = PivotTable(spark, table.path)
    assert [tuple(r) for r in again.admit(point((9, "y", 900))).collect()] == [(2, 9)]


def test_empty(spark):
    df = spark.createDataFrame([], "capture_id long, run string, url string, seen_at string")
    assert deduplicate_batches(df, spark.createDataFrame([], "domain string")).count() == 0
