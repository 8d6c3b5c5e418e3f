import random

from parallax.operators.assemble import assemble, pieces_of
from parallax.plans import runs


def test_all_documents_come_back(spark, tmp_path):
    rng = random.Random(2)
    words = lambda n: " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))
    chinese = "".join(chr(rng.randrange(0x4E00, 0x9F00)) for _ in range(900))
    texts = {1: words(700), 2: "two  words", 3: chinese, 4: "港口", 5: "", 6: f"{chinese[:300]} AP\n{chinese[300:]}", 7: words(17), 8: None, 9: words(24)}
    spark.createDataFrame(list(texts.items()), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["url"]: r["body"] for r in runs.assembled_titles(spark, str(tmp_path)).collect()}
    assert got == {str(k): " ".join(t.split()) for k, t in texts.items() if t is not None}


def test_pieces():
    text = " ".join(map(str, range(50)))
    pieces = pieces_of(text)
    assert [at for at, _ in pieces] == list(range(8)) and assemble([(*p, 1) for p in pieces]) == text
    assert pieces_of("one two three") == [(0, "one two three")]
