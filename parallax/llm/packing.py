"""Filling fixed-capacity containers with items (problem 8).

Karmarkar-Karp multiway differencing: partial partitions into K windows are merged two at a time, those of the largest
spread first, the fullest window of one with the emptiest of the other. The result is K near-equal windows, K being the
least that the sizes allow. Windows above the capacity are then relieved by exchanges with windows of opposite imbalance;
what stays above it is differenced again with the window count raised, until nothing is.

Near-equal windows are a poor aim where each holds one or two items, so each block is packed by best fit too, whose windows
are taken where they are fewer by more than SPARE. The report says how many windows are whose.

Items meet in blocks by a hash of their id, of about BLOCK items and WINDOWS containers at least whatever the input, so
that a block is one small task, no item is ever compared with all others, and a block's last window is a small part of it.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parallax.functions.lineage import cut

#: Items of a block, and containers that its items fill, at least.
BLOCK, WINDOWS = 3000, 128
#: Share of windows that differencing may need more than best fit.
SPARE = 0.01


def difference(sizes: np.ndarray, windows: int) -> list[list[int]]:
    """Karmarkar-Karp: positions of the items of each of `windows` near-equal windows.

    A partial partition keeps its used windows only, sums ascending; the others are empty and come before them. Windows
    are linked lists over the items, so that merging two partitions is a few array operations.
    """
    n = len(sizes)
    if windows <= 1:
        return [list(range(n))]
    follow = np.full(n, -1, np.int64)
    order = np.argsort(sizes, kind="stable")
    # (-spread, tie, sums above the least window, heads, tails); sums are relative
    heap = [(-int(sizes[i]), int(k), np.array([sizes[i]], np.int64), np.array([i]), np.array([i])) for k, i in enumerate(order)]
    heapq.heapify(heap)
    tie = n
    while len(heap) > 1:
        _, _, s1, h1, t1 = heapq.heappop(heap)
        _, _, s2, h2, t2 = heapq.heappop(heap)
        p, q = len(s1), len(s2)
        over = p + q - windows
        if over <= 0:  # empty windows take all of the other partition
            sums, heads, tails = np.concatenate([s1, s2]), np.concatenate([h1, h2]), np.concatenate([t1, t2])
        else:  # the emptiest `over` used windows of each meet, crosswise
            a, b = np.arange(over), np.arange(over)[::-1]
            follow[t1[a]] = h2[b]
            sums = np.concatenate([s1[a] + s2[b], s1[over:], s2[over:]])
            heads = np.concatenate([h1[a], h1[over:], h2[over:]])
            tails = np.concatenate([t2[b], t1[over:], t2[over:]])
        by = np.argsort(sums, kind="stable")
        sums, heads, tails = sums[by], heads[by], tails[by]
        least = sums[0] if len(sums) == windows else 0
        sums = sums - least
        heapq.heappush(heap, (-int(sums[-1]), tie, sums, heads, tails))
        tie += 1
    out = []
    for x in heap[0][3] if heap else ():
        items = []
        while x >= 0:
            items.append(int(x))
            x = follow[x]
        out.append(items)
    return out


def best_fit(sizes: np.ndarray, items: list[int], capacity: int) -> list[list[int]]:
    """Windows filled largest item first, each item where it leaves least room."""
    windows: list[list[int]] = []
    room: list[tuple[int, int]] = []
    for i in sorted(items, key=lambda i: (-sizes[i], i)):
        size = int(sizes[i])
        at = bisect_left(room, (size, -1))
        if at == len(room):
            left, k = capacity, len(windows)
            windows.append([])
        else:
            left, k = room.pop(at)
        windows[k].append(i)
        insort(room, (left - size, k))
    return windows


def exchange(sizes: np.ndarray, window: np.ndarray, windows: int, capacity: int) -> np.ndarray:
    """The sums of windows after exchanges that bring those above the capacity down; window is changed in place.

    sizes ascend. The fullest window gives an item to another window, or swaps it for one there, whichever lessens the sum of
    squared excess most; it may fill the other beyond the capacity, which then goes on. It ends when no exchange helps. One
    of more than the excess and the largest room never does, so only items of such sizes are looked at.
    """
    over = np.bincount(window, sizes, minlength=windows).astype(np.int64) - capacity
    members: list[list[int]] = [[] for _ in range(windows)]
    for i, k in enumerate(window.tolist()):
        members[k].append(i)
    held = over[window]  # of the window that holds the item
    heap = [(-int(over[k]), int(k)) for k in np.flatnonzero(over > 0)]
    heapq.heapify(heap)
    while heap:
        excess, k = heapq.heappop(heap)
        excess = -excess
        if over[k] != excess:
            continue
        reach, above = excess - int(over.min()), int(over.max()) - excess
        best, give, take, to = 0, -1, -1, -1
        for x in members[k]:
            size = int(sizes[x])
            low, high = np.searchsorted(sizes, (size - reach, size + above))
            if low < high:
                d = size - sizes[low:high]
                before, after = np.maximum(held[low:high], 0), np.maximum(held[low:high] + d, 0)
                left = np.maximum(excess - d, 0)
                gain = before * before - after * after - left * left
                gain[held[low:high] == excess] = -(1 << 60)  # its own items, and windows just as full
                y = int(gain.argmax())
                if gain[y] + excess * excess > best:
                    best, give, take, to = int(gain[y]) + excess * excess, x, low + y, int(window[low + y])
            if size < reach:
                before, after = np.maximum(over, 0), np.maximum(over + size, 0)
                gain = before * before - after * after
                gain[k] = -(1 << 60)
                v = int(gain.argmax())
                now = int(gain[v]) + excess * excess - max(excess - size, 0) ** 2
                if now > best:
                    best, give, take, to = now, x, -1, v
        if give < 0:
            continue
        members[k].remove(give)
        members[to].append(give)
        window[give] = to
        d = int(sizes[give])
        if take >= 0:
            members[to].remove(take)
            members[k].append(take)
            window[take] = k
            d -= int(sizes[take])
        for v, by in ((k, -d), (to, d)):
            over[v] += by
            held[members[v]] = over[v]
            if over[v] > 0:
                heapq.heappush(heap, (-int(over[v]), v))
    return over + capacity


def pack(sizes: np.ndarray, capacity: int, spare: float = SPARE) -> tuple[np.ndarray, np.ndarray]:
    """(window of each item, whether differencing made it); no window is above capacity (all sizes must be in 0..capacity), numbered from 0.

    Differencing runs at the least window count the sizes allow, then exchanges even out. Windows within the capacity stay;
    items of the others are differenced again, with at least one window more than they came from, until none is above it. If
    that needs more than `spare` more windows than best fit, best fit's windows are taken.
    """
    sizes = np.asarray(sizes, np.int64)
    order = np.argsort(sizes, kind="stable")
    sizes = sizes[order]
    plain = best_fit(sizes, list(range(len(sizes))), capacity)
    window, made = np.zeros(len(sizes), np.int64), np.ones(len(sizes), bool)
    rest, done = np.arange(len(sizes)), 0
    while len(rest):
        part = sizes[rest]
        count = max(1, -(-int(part.sum()) // capacity))
        if done + count > len(plain) * (1 + spare):
            break
        at = np.zeros(len(rest), np.int64)
        for k, items in enumerate(difference(part, count)):
            at[items] = k
        within = exchange(part, at, count, capacity) <= capacity
        stays = within[at]
        window[rest[stays]] = (np.cumsum(within) - 1 + done)[at[stays]]
        done += int(within.sum())
        rest = rest[~stays]
    if len(rest):
        made[:] = False
        for k, items in enumerate(plain):
            window[items] = k
    out, whose = np.zeros_like(window), np.zeros_like(made)
    out[order], whose[order] = window, made
    return out, whose


def pieces(sized: DataFrame, budgets: DataFrame, id_col: str = "doc_id", size: str = "n_tokens") -> DataFrame:
    """(budget, capacity, id, start, n): every item once per budget, cut only where it exceeds the capacity.

    budgets is a short parameter table; each item meets each budget.
    """
    plan = sized.select(F.col(id_col).alias("id"), F.col(size).cast("long").alias("size")).filter("size > 0")
    plan = plan.join(F.broadcast(budgets.select("budget", F.col("capacity").cast("long").alias("capacity")).filter("capacity > 0")))
    starts = F.expr("transform(sequence(0, (size - 1) div capacity), k -> k * capacity)")
    cutup = plan.select("budget", "capacity", "id", "size", F.explode(starts).alias("start"))
    return cutup.select("budget", "capacity", "id", "start", F.least("capacity", F.col("size") - F.col("start")).alias("n"))


def fill_containers(sized: DataFrame, budgets: DataFrame, id_col: str = "doc_id", size: str = "n_tokens", block: int = BLOCK, windows: int = WINDOWS) -> DataFrame:
    """(budget, container, doc_id, start, n_tokens, method): each piece of each item in one container of each budget.

    Pieces of full capacity fill a container alone (method 'full'). container is unique within a budget: 'block-number', or
    'id/start' for a full piece. Items of size 0 or null take no room and are left out, as are budgets without positive
    capacity. id_col must be unique; equal sizes are settled by id, so a run that is repeated gives the same containers.
    Empty tables give an empty result. Other columns are ignored.
    """
    assert id_col
    parts = pieces(sized, budgets, id_col, size)
    full = parts.filter("n = capacity").select("budget", F.concat_ws("/", "id", "start").alias("container"), "id", "start", "n", F.lit("full").alias("method"))
    loose = cut(parts.filter("n < capacity"), "loose")
    # blocks of a budget: as many as leave each `block` items and room for `windows` containers
    least = F.least(F.floor(F.count("*") / block), F.floor(F.sum("n") / (F.first("capacity") * windows)))
    counts = loose.groupBy("budget").agg(F.greatest(least, F.lit(1)).cast("bigint").alias("blocks"))  # one row per budget
    spot = loose.join(F.broadcast(counts), "budget").withColumn("block", F.pmod(F.xxhash64("id", "start"), "blocks")).drop("blocks")

    def fill(items: pd.DataFrame) -> pd.DataFrame:
        items = items.sort_values(["id", "start"])
        at, made = pack(items["n"].to_numpy(), int(items["capacity"].iloc[0]))
        name = f"{items['block'].iloc[0]}-"
        return pd.DataFrame({"budget": items["budget"], "container": [name + str(k) for k in at], "id": items["id"], "start": items["start"], "n": items["n"], "method": np.where(made, "differencing", "best fit")})

    packed = spot.groupBy("budget", "block").applyInPandas(fill, "budget string, container string, id bigint, start bigint, n bigint, method string")
    return full.unionByName(packed).select("budget", "container", F.col("id").alias(id_col), "start", F.col("n").alias("n_tokens"), "method")


def container_report(filled: DataFrame, budgets: DataFrame) -> DataFrame:
    """(budget, capacity, containers, tokens, least_containers, fill, differencing, best_fit, full): how full the containers of each budget are, and whose they are."""
    per = filled.groupBy("budget", "container").agg(F.sum("n_tokens").alias("tokens"), F.first("method").alias("method")).groupBy("budget")
    whose = [F.count_if(F.col("method") == m).alias(m.replace(" ", "_")) for m in ("differencing", "best fit", "full")]
    sums = per.agg(F.count("*").alias("containers"), F.sum("tokens").alias("tokens"), *whose)
    plan = F.broadcast(budgets.select("budget", F.col("capacity").cast("long").alias("capacity")))
    fill = F.col("tokens") / (F.col("containers") * F.col("capacity"))
    return sums.join(plan, "budget").select("budget", "capacity", "containers", "tokens", F.ceil(F.col("tokens") / F.col("capacity")).alias("least_containers"), fill.alias("fill"), "differencing", "best_fit", "full")
