import itertools
import random
import unicodedata

import pytest

from parallax.llm.lookalikes import LATTICE, Scripts, canonical_forms, compatible, disguised, script_of, train_scripts

CLEAN = ["Port workers pay the old bridge", "two judges keep the harbour closed", "say no more", "Veldória calls for calm", "рабочие порта не хотят платить", "у моста в городе", "судьи и врачи", "Οι λιμενεργάτες στην πόλη", "για τους αγρότες", "в порту"]


@pytest.fixture(scope="module")
def scripts():
    return Scripts(CLEAN)


@pytest.mark.parametrize("text", [*CLEAN, "", "two, judges – “keep” «порту» 'calm' -", "Ψηφιδωτό beside a title", "two judges «Журнал»", "在港口 「港口」", "两名法官, calm"])
def test_genuine_text_stays(scripts, text):
    assert scripts.canonical(text) == text


@pytest.mark.parametrize(
    "text,form",
    [
        ("Ｐｏｒｔ workers", "Port workers"), ("Po​rt﻿", "Port"), ("Port workers", "Port workers"), ("Veldória", "Veldória"), ("oﬃce", "office"), ("soft­hyphen", "softhyphen"), (" x　y", " x y"),
        ("Pоrt workers", "Port workers"), ("wоrkеrs рау", "workers pay"), ("ѕау no more", "say no more"), ("cyдьи и врачи", "судьи и врачи"), ("πόλη στην Οι λιμενεργάτεs για τoυς", None),
    ],
)
def test_disguises(scripts, text, form):
    got = scripts.canonical(text)
    assert got != text
    if form:
        assert got == form
    assert scripts.canonical(got) == got


def test_words_wholly_in_another_script():
    """Text in one script is searched too: what is known in no letters but another script's is written in those."""
    own = Scripts([*CLEAN, "the scope of space", "рост"])
    for disguise in ("ѕсоре", "ѕсоре оf"[:5], "Ѕсоре", "ѕрасе ѕсоре"):
        assert own.canonical(disguise).isascii()
    assert own.canonical("рост") == "рост" and own.canonical("рот") == "рот"  # known, and unknown anywhere
    assert own.canonical("the ѕсоре of ѕрасе") == "the scope of space"
    assert own.canonical("the раураl of workers") == "the paypal of workers" and own.canonical("раураl") == "paypal"
    assert own.canonical("wօrkers pay") == "workers pay"  # an Armenian letter


def test_random_swaps_come_back(scripts):
    rng = random.Random(5)
    texts = [t for t in CLEAN if len(t) > 12]
    good = n = 0
    for _ in range(300):
        text = rng.choice(texts)
        at = [i for i, c in enumerate(text) if any((c, s) in LATTICE for s in "lcg")]
        if not at:
            continue
        i = rng.choice(at)
        s = rng.choice([s for s in "lcg" if (text[i], s) in LATTICE])
        other = text[:i] + rng.choice(LATTICE[text[i], s]) + text[i + 1 :]
        n += 1
        good += scripts.canonical(other) == text
    assert good >= 0.95 * n


def test_compatible_is_idempotent():
    rng = random.Random(1)
    for _ in range(500):
        text = "".join(chr(rng.choice([rng.randrange(32, 0x500), rng.randrange(0x2000, 0x2100), rng.randrange(0xFE00, 0xFFF0)])) for _ in range(12))
        once = compatible(text)
        assert compatible(once) == once and unicodedata.is_normalized("NFKC", once)


def test_rows(spark, scripts):
    rows = [(1, "Pоrt", {"a": "x", "b": None}), (2, "Port", {"a": "Pоrt workers"}), (2, "Port", {"a": "Pоrt workers"}), (3, None, None), (4, "", {}), (5, "calm " * 20_000 + "рау", {"k": ""})]
    df = spark.createDataFrame(rows, "evidence_id long, title string, wrote map<string,string>").selectExpr("*", "1 as field", "2 as canonical", "3 as key", "4 as text")
    assert {tuple(r) for r in disguised(df, scripts).collect()} == {(1, "title"), (2, "wrote"), (5, "title")}
    assert canonical_forms(df, scripts).count() == 5 + 4
    assert canonical_forms(df.limit(0), scripts).count() == 0
    assert script_of("1") == script_of("在") == ""


def test_all_texts_of_a_large_corpus_count(spark):
    words = ["".join(w) for w in itertools.product("асеор", repeat=4)][:600]
    texts = [f"{w} жук" for w in words for _ in range(3)] + [f"сам{w} жук" for w in words[:9]] + [f"filler {i}" for i in range(10_000)]
    corpus = spark.createDataFrame([(t,) for t in [*texts, None, ""]], "title string")
    scripts = train_scripts([corpus.limit(0)], corpus)
    assert set(words) <= scripts.known and not any(w.startswith("сам") for w in scripts.known)
    whole = Scripts(texts, least=3)
    assert scripts.grams == whole.grams and scripts.known <= whole.known


def test_repeated_disguise_is_not_known(spark):
    corpus = spark.createDataFrame([("The judges will not рау",)] * 40 + [("The judges will not pay",)] * 99 + [("рабочие порта не рады",)] * 9, "title string")
    scripts = train_scripts([corpus.limit(0)], corpus)
    assert "pay" in scripts.known and "рау" not in scripts.known
    assert scripts.canonical("The judges will not рау") == "The judges will not pay"


def test_only_unsure_words_need_be_known(spark):
    rng = random.Random(3)
    rows = spark.createDataFrame([(t,) for t in CLEAN], "text string")
    whole, bounded = Scripts(CLEAN), train_scripts([rows])
    assert bounded.grams == whole.grams and bounded.known < whole.known
    for _ in range(500):
        text = " ".join(rng.sample(CLEAN, 2))
        text = "".join(rng.choice(LATTICE.get((c, rng.choice("lcg")), c)) if rng.random() < 0.3 else c for c in text)
        text = text.upper() if rng.random() < 0.2 else text
        assert bounded.canonical(text) == whole.canonical(text)
