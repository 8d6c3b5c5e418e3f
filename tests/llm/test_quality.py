import numpy as np
import pytest

from parallax.llm import quality
from parallax.llm.quality_holdout import marked

PROSE = "The council said that the bridge will be closed for a week. Nobody had expected it, and the shops on both sides are not happy about it."


def number(text, name):
    return quality.statistics(text, quality._classes())[quality.STATISTICS.index(name)]


def test_statistics():
    assert number("one two three", "n_words") == 3 and number("one two three", "mean_word_length") == pytest.approx(11 / 3)
    assert number("a!\nb\nc.", "punctuated_line_share") == pytest.approx(2 / 3) and number("a\na\nb", "repeated_line_share") == pytest.approx(1 / 3)
    assert number("ab!?", "symbol_ratio") == 0.5 and number("", "n_words") == 0 and number("12ab", "digit_ratio") == 0.5
    assert number("- a\n- b\n- c", "item_line_share") == 1 and number("- a\nb", "item_line_share") == 0
    assert number("a\tb\tc\nd", "cell_line_share") == 0.5 and number("Town 3\nTown 4.", "ragged_line_share") == 0.5
    assert number(PROSE, "long_stretch_share") == 1 and number("one two; three four.", "stretch_words") == 2
    assert number("the xx yy zz the", "common_word_gap") == pytest.approx((1 + 16 + 1) / 6)
    assert number("Ã© ok", "damage_ratio") == pytest.approx(1 / 5)
    assert number("x" * 500_000, "n_chars") == 500_000 and number("\ud800", "n_chars") == 1


def test_trees_learn_a_step():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 4))
    y = ((x[:, 1] > 0.37) ^ (x[:, 2] > 0.8)).astype(float)
    model = quality.BoostedTrees().fit(x[:1000], y[:1000])
    assert ((model.score(x[1000:]) > 0) == (y[1000:] > 0)).mean() > 0.97


def test_sources_disagree_and_abstain():
    x, truth = quality.marked_statistics("base")
    votes, labels = quality.weak_votes(x), quality.weak_label(x)
    assert ((votes > 0).any(1) & (votes < 0).any(1)).sum() > 5 and (votes == 0).any()
    assert (labels < 0).any() and (labels[labels >= 0] == truth[labels >= 0]).mean() > 0.97


def test_trees_on_documents_they_never_saw():
    """Trained on weak labels of the base documents alone: the worst case, a table without documents."""
    model, a, b = quality.train(np.zeros((0, len(quality.STATISTICS))))
    x, truth = quality.marked_statistics("test")
    found = a * model.score(x) + b > 0
    assert (found & (truth == 1)).sum() >= 0.93 * truth.sum() and (found & (truth == 1)).sum() >= 0.93 * found.sum()


def test_trees_learn_more_than_a_threshold(data):
    import pyarrow.parquet as pq

    table = quality._classes()
    texts = [t for t in pq.read_table(f"{data}/documents.parquet", columns=["text"]).column(0).to_pylist() if t]
    x = np.array([quality.statistics(t, table) for t in texts], np.float64)
    model, a, b = quality.train(x)
    used = {f for tree in model.nodes for f, *_ in tree if f >= 0}
    assert len(used) >= 6 and sum(len(tree) > 3 for tree in model.nodes) > len(model.nodes) / 3
    held, truth = quality.marked_statistics("test")
    found = a * model.score(held) + b > 0
    assert (found == (truth == 1)).mean() >= 0.97
    every = np.concatenate([x, held])
    said = a * model.score(every) + b > 0
    for i in range(x.shape[1]):
        cuts = np.unique(every[:, i])
        differs = min(min(((every[:, i] > c) != said).sum(), ((every[:, i] <= c) != said).sum()) for c in cuts)
        assert differs > 0, quality.STATISTICS[i]


def test_rows(spark):
    table = "\n".join(f"Town {i}\t{i * 7}\t{i}%" for i in range(40))
    rows = [(i, f"{PROSE} It is the {i}. time. " * 3) for i in range(60)] + [(100 + i, f"{table}\n{i}") for i in range(60)]
    rows += [(500, None), (501, ""), (502, "."), (503, f"{PROSE}\n{PROSE}\n- nails\n- rope"), (504, f"{PROSE[:60]}.\n{table}"), (505, "z" * 200_000), (7, rows[7][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n_words", "2 as junk_probability", "3 as _text").repartition(3)
    got = {r["doc_id"] for r in quality.structural_documents(df).collect()}
    assert {*range(100, 160), 502, 504, 505} <= got and not got & {*range(60), 500, 501, 503}
    assert quality.text_quality(df).count() == len(rows) - 1
    assert quality.text_quality(df.limit(0)).count() == 0


def test_parts_are_apart():
    parts = [set(marked(p)[0]) for p in ("base", "calibration", "test")]
    assert all(len(p) >= 60 for p in parts) and not parts[0] & parts[2] and not parts[1] & parts[2]
