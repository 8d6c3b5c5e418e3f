import numpy as np
import pytest

from parallax.llm.packing import container_report, difference, exchange, fill_containers, pack


def test_differencing_by_hand():
    sizes = np.array([8, 7, 6, 5, 4])
    parts = difference(sizes, 2)
    assert sorted(i for p in parts for i in p) == list(range(5))
    assert sorted(sizes[p].sum() for p in parts) == [14, 16]  # what differencing gives; 15 and 15 is the optimum
    assert len(difference(sizes, 9)) == 5
    assert difference(sizes, 1) == [[0, 1, 2, 3, 4]]


@pytest.mark.parametrize("capacity", [512, 2048, 8192])
def test_near_the_bound(capacity):
    rng = np.random.default_rng(0)
    sizes = np.minimum(np.exp(rng.normal(5.8, 0.9, 4000)).astype(int) + 1, capacity)
    window, made = pack(sizes, capacity)
    assert made.all()
    sums = np.bincount(window, weights=sizes)
    assert sums.max() <= capacity and sums.min() > 0
    least = max(-(-sizes.sum() // capacity), (2 * sizes > capacity).sum())
    assert len(sums) <= 1.03 * least + 1


def test_ties_and_edges():
    assert len(pack(np.array([], np.int64), 10)[0]) == 0
    for sizes, windows in ((np.full(10, 5), 5), (np.full(7, 10), 7), (np.full(9, 6), 9)):
        assert len(set(pack(sizes, 10)[0])) == windows


def test_small_items_fill_large_containers(spark):
    """Blocks are sized by containers as well as by items."""
    sized = spark.range(70_000).selectExpr("id as doc_id", "cast(20 + pmod(xxhash64(id), 61) as int) as n_tokens")
    budgets = spark.createDataFrame([("wide", 16_384)], "budget string, capacity int")
    report = container_report(fill_containers(sized, budgets), budgets).first()
    assert report["fill"] > 0.99 and report["differencing"] == report["containers"]


@pytest.mark.parametrize("seed", range(20))
def test_exchange_only_helps(seed):
    rng = np.random.default_rng(seed)
    sizes = np.sort(rng.integers(1, 60, 80))
    window = rng.integers(0, 20, 80)
    before = np.bincount(window, sizes, minlength=20)
    sums = exchange(sizes, window, 20, 130)
    assert (np.bincount(window, sizes, minlength=20) == sums).all() and sums.sum() == sizes.sum()
    assert (np.maximum(sums - 130, 0) ** 2).sum() <= (np.maximum(before - 130, 0) ** 2).sum()


def test_best_fit_where_differencing_is_poor():
    """Windows of one large and one small item: differencing alone would need more of them."""
    sizes = np.array([90] * 40 + [80] * 40 + [10] * 40 + [20] * 40 + [34, 33, 33] * 20)
    window, made = pack(sizes, 100)
    assert np.bincount(window, sizes).max() <= 100 and len(set(window)) <= 101
    assert made.all() or not made.any()


def test_rows(spark):
    sizes = [(1, 5), (2, 10), (3, 25), (4, 0), (5, None), (6, 3), (7, 3), (8, 9), (9, 1)]
    df = spark.createDataFrame(sizes, "doc_id long, n_tokens int").selectExpr("*", "'x' as budget", "2 as capacity", "3 as n", "4 as id", "5 as start", "6 as block")
    budgets = spark.createDataFrame([("short", 10), ("long", 100), ("none", 0)], "budget string, capacity int")
    rows = fill_containers(df, budgets, block=3).collect()
    for name, capacity in (("short", 10), ("long", 100)):
        own = [r for r in rows if r["budget"] == name]
        fill = {}
        for r in own:
            fill[r["container"]] = fill.get(r["container"], 0) + r["n_tokens"]
        assert max(fill.values()) <= capacity
        for i, n in sizes:
            parts = sorted((r["start"], r["n_tokens"]) for r in own if r["doc_id"] == i)
            assert sum(x for _, x in parts) == (n or 0)
            assert len(parts) == -(-(n or 0) // capacity)  # only what exceeds the capacity is cut
            assert [s for s, _ in parts] == [k * capacity for k in range(len(parts))]
    assert not [r for r in rows if r["budget"] == "none"]
    report = {r["budget"]: r for r in container_report(fill_containers(df, budgets), budgets).collect()}
    assert report["short"]["containers"] == 6 and report["short"]["tokens"] == 56
    assert fill_containers(df.limit(0), budgets).count() == 0
