import random

from parallax.llm.dictionary_dedup import copies, distinct_records, formatting_duplicates


def canon(x):
    fold = "".join(c for c in x if c.isalnum()).upper().lower()
    return "".join(c for c in fold if c.isalnum()).replace("ς", "σ")


def brute(rows):
    sets = {}
    for i, a, b in rows:
        if a and b and canon(a) and canon(b):
            sets.setdefault(tuple(sorted((canon(a), canon(b)))), []).append(i)
    return sets


def test_against_brute_force(spark):
    rng = random.Random(3)
    rows = []
    for i in range(3000):
        a, b = rng.choice([("Straße nach Rom", "a.test"), (f"title {rng.randrange(200)}", f"d{rng.randrange(9)}.test")])
        a = rng.choice([a, a.upper(), f"  {a}!", a.replace(" ", "\t"), a.title()])
        b = rng.choice([b, b.upper(), b.replace(".", ":")])
        rows.append((i * 7 - 500, *rng.sample((a, b), 2)))
    rows += [(90001, None, "x"), (90002, "x", None), (90003, "...", "x"), (90004, "x", "x"), (90005, "X!", "x"), (90006, "ab", "c"), (90007, "a", "bc"), (90008, "y" * 200_000, "z"), (90009, "Y" * 200_000, "z.")]
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "capture_id long, title string, domain string").selectExpr("*", "1 as code", "2 as raw", "3 as first", "4 as id", "5 as cell").repartition(4)
    want = brute(rows)
    assert {tuple(r) for r in copies(df).collect()} == {(min(x), i) for x in want.values() for i in x if i != min(x)}
    assert {tuple(r) for r in distinct_records(df).collect()} == {(min(x), len(x)) for x in want.values()}


def test_hot_class_and_empty(spark):
    df = spark.range(20_000).selectExpr("id as capture_id", "if(id % 3 = 0, 'Same  Title', concat('t', id)) as title", "if(id % 3 = 0, 'same.test', 'd') as domain")
    _, members = formatting_duplicates(df, "capture_id", ["title", "domain"])
    assert members.filter("first_id = 0").count() == 6667
    none = spark.createDataFrame([], "capture_id long, title string, domain string")
    assert copies(none).count() == distinct_records(none).count() == 0
