import numpy as np
import pytest

from parallax.llm import language_crf as crf

# clean sentences of a few languages, built from parts so that training and test share no sentence
PARTS = {
    "en": (["the farmers", "two judges", "many nurses", "the bus drivers", "young engineers"], ["reject the new offer", "want a longer pause", "wait for another month", "hope for lower prices"], ["in the old harbour", "before the winter", "near the bridge"]),
    "de": (["die Landwirte", "zwei Richterinnen", "viele Pflegekräfte", "die Busfahrer", "junge Ingenieure"], ["lehnen das neue Angebot ab", "wollen eine längere Pause", "warten noch einen Monat", "hoffen auf niedrigere Preise"], ["im alten Hafen", "vor dem Winter", "bei der Brücke"]),
    "es": (["los agricultores", "dos juezas", "muchas enfermeras", "los conductores", "los ingenieros"], ["rechazan la nueva oferta", "quieren una pausa más larga", "esperan otro mes", "piden precios más bajos"], ["en el viejo puerto", "antes del invierno", "cerca del puente"]),
    "ru": (["фермеры", "двое судей", "многие врачи", "водители", "инженеры"], ["отвергли новое предложение", "хотят долгого перерыва", "ждут ещё один месяц", "требуют снизить цены"], ["в старом порту", "до зимы", "у моста"]),
    "uk": (["фермери", "двоє суддів", "чимало лікарів", "водії", "інженери"], ["відкинули нову пропозицію", "хочуть довшої перерви", "чекають іще один місяць", "вимагають знизити ціни"], ["у старому порту", "до зими", "біля мосту"]),
    "zh": (["农民", "两名法官", "许多护士", "公交司机", "工程师"], ["拒绝新的工资方案", "希望谈判暂停更长时间", "还要再等一个月", "要求降低价格"], ["在老港口", "在冬天之前", "在桥附近"]),
}


def sentences():
    for code, (a, b, c) in PARTS.items():
        gap = "" if code == "zh" else " "
        for k, text in enumerate(gap.join((x, y, z)) for x in a for y in b for z in c):
            yield k, code, text


@pytest.fixture(scope="module")
def field():
    train = [(t, c) for k, c, t in sentences() if k % 3]
    return crf.train([t for t, _ in train], [c for _, c in train], steps=60)


def pieces(field, text):
    x = crf.plain(text)
    spans = crf.words_of(x)
    return field.segments(x, spans, field.posteriors([[x[a:b] for a, b in spans]])[0])


def test_held_out_sentences(field):
    held = [(t, c) for k, c, t in sentences() if k % 3 == 0]
    right = sum([p[2] for p in pieces(field, t)] == [c] for t, c in held)
    assert right >= 0.97 * len(held)


def test_joined_sentences(field):
    held = [(t, c) for k, c, t in sentences() if k % 3 == 0]
    rng = np.random.default_rng(0)
    good = n = 0
    for i, j in rng.integers(0, len(held), (200, 2)):
        if held[i][1] == held[j][1]:
            continue
        got = pieces(field, held[i][0] + rng.choice([" - ", " | ", ": "]) + held[j][0])
        n += 1
        good += [p[2] for p in got] == [held[i][1], held[j][1]] and all(p[3] > 0.5 for p in got)
    assert good >= 0.95 * n


def test_long_texts_are_one_chain(field, monkeypatch):
    """A text held in stretches has the probabilities of the whole, at the seams too."""
    held = [t for k, c, t in sentences() if k % 3 == 0 and c != "zh"]
    words = [w for t in held for w in t.split()][:300]
    whole = field.posteriors([words])[0]
    for stretch in (1, 7, 100):
        monkeypatch.setattr(crf, "STRETCH", stretch)
        assert np.abs(field.posteriors([words])[0] - whole).max() < 1e-9


def test_words_are_read_to_their_ends():
    """No prefix, no first n-grams and no first characters only: words that differ late have other features."""
    long = "ab" * 300
    assert set(crf.features(long + "xyq", frozenset())) != set(crf.features(long + "zwv", frozenset()))
    many = "".join(chr(0x430 + i % 32) + chr(0x3B1 + i % 24) for i in range(60))
    assert set(crf.features(many + "é", frozenset())) - set(crf.features(many, frozenset()))


def test_fitted_once(spark):
    rows = [(t, c) for k, c, t in sentences() if k % 3][:120]
    calls = []

    def make():
        calls.append(1)
        return crf.train([t for t, _ in rows], [c for _, c in rows], steps=10)

    one = crf.saved_field(spark, *zip(*rows), make)
    two = crf.saved_field(spark, *zip(*rows), make)
    assert len(calls) == 1 and one.codes == two.codes and one.lexicon == two.lexicon and np.array_equal(one.weights, two.weights)
    crf.saved_field(spark, *zip(*rows[1:]), make)
    assert len(calls) == 2


def test_single_foreign_word_is_no_language(field):
    assert [p[2] for p in pieces(field, "two judges want a longer pause near the bridge «Журнал»")] == ["en"]
    assert [p[2] for p in pieces(field, "two judges want a longer pause near the bridge 「港口」")] == ["en"]


def test_forward_backward_by_enumeration():
    rng = np.random.default_rng(1)
    scores, moves, start = rng.normal(size=(2, 4, 3)), rng.normal(size=(3, 3)), rng.normal(size=3)
    lengths = np.array([4, 2])
    post, pairs = crf.forward_backward(scores, lengths, moves, start, expected=True)
    total = np.zeros((3, 3))
    for s in range(2):
        weights = {}
        for path in np.ndindex(*[3] * lengths[s]):
            w = start[path[0]] + sum(scores[s, i, k] for i, k in enumerate(path)) + sum(moves[a, b] for a, b in zip(path, path[1:]))
            weights[path] = np.exp(w)
        z = sum(weights.values())
        for i in range(lengths[s]):
            for k in range(3):
                assert post[s, i, k] == pytest.approx(sum(w for p, w in weights.items() if p[i] == k) / z)
        for p, w in weights.items():
            for a, b in zip(p, p[1:]):
                total[a, b] += w / z
    assert pairs == pytest.approx(total)


def test_rows(spark, field):
    en, ru = "two judges want a longer pause near the bridge", "инженеры требуют снизить цены в старом порту"
    rows = [(1, en, "English "), (2, en, None), (3, en, "de"), (4, f"{en} | {ru}", "eng"), (5, None, None), (6, "", None), (7, "123 --", None), (8, (en + " ") * 3000, "EN"), (9, "tw​o jud­ges want a longer pause near the bridge", "en"), (10, en, "n/a"), (10, en, "n/a")]
    df = spark.createDataFrame(rows, "evidence_id long, title string, language string").selectExpr("*", "1 as code", "2 as label", "3 as piece", "4 as segment").repartition(3)
    codes = spark.createDataFrame([("ENGLISH", "en", "eng"), ("GERMAN", "de", "deu"), ("RUSSIAN", "ru", "rus")], "gdelt_name string, code string, code3 string")
    samples = spark.createDataFrame([(t, c) for _, c, t in sentences()], "title string, code string")
    got = {tuple(r) for r in crf.mislabelled(df, samples, codes).collect()}
    assert got == {(2, "en"), (3, "en"), (4, "en"), (4, "ru"), (10, "en")}
    assert crf.language_segments(df.limit(0), field).count() == 0
    long = crf.language_segments(df.filter("evidence_id = 8"), field).collect()
    assert [(r["code"], r["words"]) for r in long] == [("en", 27_000)]
