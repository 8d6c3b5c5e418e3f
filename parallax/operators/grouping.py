"""Stories as components of a similarity graph, at a threshold found by percolation.

For every threshold the components of all edges above it are those of a maximum spanning forest's edges above it, and a
forest of forests is the forest of the union. So the similarity join keeps a local forest per pair of blocks, forests are
merged in a tree of tasks, and the threshold search runs on at most rows - 1 edges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parallax.functions.lineage import cut, heavy_light_lookup, release
from parallax.params import DEFAULT, Params

#: Vectors of a block in the similarity join; edges of one merge task, about.
BLOCK, MERGE = 4096, 2_000_000
#: Vectors of a block at least, where there are so many.
LEAST_BLOCK = 256
#: Neighbours above which a node is met by broadcast; of E edges at most 2 E / HUB are such.
HUB = 100_000
EDGE = "a bigint, b bigint, score float"


def normalised(df: DataFrame, id_col: str, vector: str, dim: int) -> DataFrame:
    """(id, v): unit vectors of those of the right length; row / (norm + 1e-9) in single precision."""
    rows = df.select(F.col(id_col).alias("id"), F.col(vector).alias("v")).filter(F.size("v") == dim)
    schema = rows.schema

    def unit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = np.asarray(batch.column(1).flatten(), np.float32).reshape(-1, dim)
            v = (v / (np.linalg.norm(v, axis=1, keepdims=True) + 1e-9)).astype(np.float32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1) * dim, pa.int32()), pa.array(v.ravel()))], names=["id", "v"])

    return rows.mapInArrow(unit, schema)


def _blocks(vectors: DataFrame, block: int) -> tuple[DataFrame, int]:
    """(block, ids, data): packed blocks of at most about `block` vectors by a hash of the id, and their number.

    Few vectors make smaller blocks, so that their pairs occupy all cores.
    """
    n, cores = vectors.count(), vectors.sparkSession.sparkContext.defaultParallelism
    count = max(1, -(-n // block), min(n // LEAST_BLOCK, int(np.ceil(np.sqrt(2 * cores)))))
    keyed = vectors.withColumn("block", F.pmod(F.xxhash64("id"), F.lit(count)).cast("int"))

    def pack(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("id")
        data = np.stack(part["v"].to_numpy()).astype(np.float32)
        return pd.DataFrame({"block": [int(part["block"].iloc[0])], "ids": [part["id"].to_numpy().tolist()], "data": [data.tobytes()]})

    return keyed.groupBy("block").applyInPandas(pack, "block int, ids array<bigint>, data binary"), count


def _pairs(blocks: DataFrame, count: int) -> DataFrame:
    """Each block with each block not before it: every pair of vectors meets in one task of bounded size.

    Both sides carry the whole pair as key, so each key has one row a side and no block's copies gather in one task.
    """
    kept = cut(blocks, "blocks")
    left = kept.select(F.col("block").alias("i"), F.col("ids").alias("ids_i"), F.col("data").alias("data_i")).withColumn("j", F.explode(F.sequence("i", F.lit(count - 1))))
    right = kept.select(F.col("block").alias("j"), F.col("ids").alias("ids_j"), F.col("data").alias("data_j")).withColumn("i", F.explode(F.sequence(F.lit(0), "j")))
    tasks = min(count * (count + 1) // 2, 20_000)
    return left.repartition(tasks, "i", "j").join(right.repartition(tasks, "i", "j").hint("shuffle_hash"), ["i", "j"]).select("i", "j", "ids_i", "data_i", "ids_j", "data_j")


def _hits(row: tuple, dim: int, floor: float):
    i, j, ids_i, data_i, ids_j, data_j = row
    x, y = np.frombuffer(data_i, np.float32).reshape(-1, dim), np.frombuffer(data_j, np.float32).reshape(-1, dim)
    ids_i, ids_j = np.asarray(ids_i), np.asarray(ids_j)
    for s in range(0, len(x), 512):
        scores = x[s : s + 512] @ y.T
        r, c = np.nonzero(scores >= np.float32(floor))
        a, b, w = ids_i[s + r], ids_j[c], scores[r, c]
        own = a < b if i == j else a != b
        a, b, w = a[own], b[own], w[own]
        yield np.minimum(a, b), np.maximum(a, b), w


def _forest(a: np.ndarray, b: np.ndarray, w: np.ndarray) -> np.ndarray:
    """Positions of the edges of a maximum spanning forest, best first; equals by ids."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    parent = list(range(len(nodes)))
    kept = []
    for e in np.lexsort((b, a, -w)).tolist():
        u, v = int(x[e]), int(y[e])
        while parent[u] != u:
            parent[u] = u = parent[parent[u]]
        while parent[v] != v:
            parent[v] = v = parent[parent[v]]
        if u != v:
            parent[max(u, v)] = min(u, v)
            kept.append(e)
    return np.array(kept, np.int64)


def _edge_batches(blocks: DataFrame, count: int, dim: int, floor: float, forest: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = tuple(batch.column(c)[k].as_py() for c in ("i", "j", "ids_i", "data_i", "ids_j", "data_j"))
                kept: list = []
                for a, b, w in _hits(row, dim, floor):
                    if not forest:
                        yield _batch(a, b, w)
                        continue
                    kept.append((a, b, w))
                    if sum(len(x[0]) for x in kept) > MERGE:
                        kept = [_reduce(kept)]
                if forest and kept:
                    yield _batch(*_reduce(kept))

    return _pairs(blocks, count).mapInArrow(run, EDGE)


def _reduce(parts: list) -> tuple:
    a, b, w = (np.concatenate([p[i] for p in parts]) for i in range(3))
    e = _forest(a, b, w)
    return a[e], b[e], w[e]


def _batch(a, b, w) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(w, pa.float32())], names=["a", "b", "score"])


def cosine_edges(vectors: DataFrame, dim: int, floor: float, block: int = BLOCK) -> DataFrame:
    """(a, b, score): all pairs a < b of unit vectors with a cosine of at least floor, by blocked matrix products."""
    return _edge_batches(*_blocks(vectors, block), dim, floor, forest=False)


def spanning_forest(edges: DataFrame, width: int = 16, most: int = MERGE) -> DataFrame:
    """The maximum spanning forest of edges (a, b, score), merged in rounds of tasks until one holds it.

    A round's tasks keep at most nodes - 1 edges each, so the rows shrink towards one forest. Where that has more than
    `most` edges the rounds end with several tasks' forests, which have the same components at every threshold.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list = []
        for batch in batches:
            kept.append(tuple(np.asarray(batch.column(c)) for c in ("a", "b", "score")))
            if sum(len(x[0]) for x in kept) > MERGE:
                kept = [_reduce(kept)]
        if kept:
            yield _batch(*_reduce(kept))

    left, parts = edges.count(), max(1, edges.rdd.getNumPartitions())
    while parts > 1 and left:
        # a task holds so many edges as it merges at a time, so there may be more tasks than one at the end
        parts = max(1, parts // width, -(-left // most) if left > most else 1)
        edges = cut(edges.repartition(parts, "a").mapInArrow(merge, EDGE) if parts > 1 else edges.repartition(1).mapInArrow(merge, EDGE), "forest")
        before, left = left, edges.count()
        if left > most and left > 0.9 * before:
            break
    return edges


def vector_forest(vectors: DataFrame, dim: int, floor: float, block: int = BLOCK) -> DataFrame:
    """The maximum spanning forest of cosine_edges without writing the edges: a forest per pair of blocks, then merged."""
    return spanning_forest(cut(_edge_batches(*_blocks(vectors, block), dim, floor, forest=True), "local"))


def growth(a: np.ndarray, b: np.ndarray, score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(scores, largest) of edges, best first: the largest component after each of them; one row is the largest before."""
    order = np.argsort(-score, kind="stable")
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    ends = flat.reshape(2, -1)[:, order].T.tolist()
    group = {i: [i] for i in range(len(nodes))}  # the smaller member list always moves, so a node moves log2(nodes) times
    home = list(range(len(nodes)))
    largest = [1]
    for u, v in ends:
        x, y = group[home[u]], group[home[v]]
        if x is not y:
            if len(x) < len(y):
                x, y = y, x
            group.pop(home[y[0]])
            for node in y:
                home[node] = home[x[0]]
            x += y
        largest.append(max(largest[-1], len(group[home[u]])))
    return score[order].astype(np.float64), np.array(largest)


def search(a: np.ndarray, b: np.ndarray, score: np.ndarray, n: int, share: float, floor: float, hi: float, step: float) -> float | None:
    """The lowest threshold before the largest component exceeds share x n, of those from hi down to floor by step.

    hi with one row or no edges; None if even hi percolates. Every candidate is looked up in the growth of the largest
    component at once; candidates are compared in double precision.
    """
    if n <= 1 or not len(score):
        return hi
    scores, largest = growth(a, b, score)
    candidates = hi - step * np.arange(int(round((hi - floor) / step)) + 1)
    sizes = largest[np.searchsorted(-scores, -candidates, side="right")]
    below = int((sizes <= share * n).sum())  # sizes never fall
    return round(float(candidates[below - 1]), 4) if below else None


def label(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, its component's smallest node) of the nodes that the edges touch."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    parent = list(range(len(nodes)))
    for u, v in zip(x.tolist(), y.tolist()):
        while parent[u] != u:
            parent[u] = u = parent[parent[u]]
        while parent[v] != v:
            parent[v] = v = parent[parent[v]]
        parent[max(u, v)] = min(u, v)
    for i in range(len(parent)):
        parent[i] = parent[parent[i]]
    return nodes, nodes[np.array(parent, np.int64)] if len(nodes) else nodes


def _columns(batches: Iterator[pa.RecordBatch]) -> list[np.ndarray]:
    """The three columns of edges, whole: at most MERGE edges are handed to one task."""
    held = list(batches)
    return [np.concatenate([np.zeros(0, kind), *[np.asarray(x.column(c)) for x in held]]) for c, kind in (("a", np.int64), ("b", np.int64), ("score", np.float32))]


def threshold(forest: DataFrame, n: int, share: float, floor: float, hi: float = DEFAULT.threshold_hi, step: float = DEFAULT.threshold_step, most: int = MERGE) -> DataFrame:
    """(threshold): the percolation threshold from a spanning forest.

    Up to `most` edges are searched in one task; of more, the candidates are halved, with the components of each taken
    by distributed contraction.
    """
    spark, edges = forest.sparkSession, forest.count()
    if n <= 1 or not edges:
        return spark.createDataFrame([(float(hi),)], "threshold double")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array([search(*_columns(batches), n, share, floor, hi, step)], pa.float64())], names=["threshold"])

    if edges <= most:
        return forest.repartition(1).mapInArrow(find, "threshold double")
    low, high = 0, int(round((hi - floor) / step)) + 1  # candidates before low fit, from high on they don't
    while low < high:
        middle = (low + high) // 2
        kept = forest.filter(F.col("score").cast("double") >= hi - step * middle).withColumn("score", F.lit(1.0).cast("float"))
        largest = components(kept, 0.0, most).groupBy("component").count().agg(F.max("count")).first()[0] or 1
        low, high = (middle + 1, high) if largest <= share * n else (low, middle)
    return spark.createDataFrame([(round(hi - step * (low - 1), 4) if low else None,)], "threshold double")


def contracted(edges: DataFrame) -> DataFrame:
    """(id, component) by alternating stars: every node comes to hang on its component's smallest one.

    A round joins each node's neighbours to the smallest of them; nodes with many neighbours are met by broadcast, of which
    there are few. Rounds end when nothing changes, after about the logarithm of the longest path.
    """
    now = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).filter("u <> v").distinct(), "stars")
    mark = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.min("u")).alias("m"), F.count("*").alias("n"))
        large = heavy_light_lookup(both.filter("v > u"), least, ["u"], "n", HUB, ["m"]).select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        large = cut(large, "stars")
        least = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = heavy_light_lookup(large, least, ["u"], "n", HUB, ["m"]).select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).filter("u <> v").distinct()
        after = cut(small, "stars")
        seen = after.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        release(now, large)
        now = after
        if seen == mark:
            break
        mark = seen
    return now.select(F.col("u").alias("id"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct())


def components(forest: DataFrame, at: float, most: int = MERGE) -> DataFrame:
    """(id, component) of the rows that edges of at least `at` (in single precision) touch; component is the smallest id.

    Up to `most` edges are labelled in one task, more of them by distributed contraction.
    """
    kept = forest.filter(F.col("score") >= F.lit(at).cast("float"))
    if kept.count() > most:
        return contracted(kept)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b, _ = _columns(batches)
        nodes, first = label(a, b)
        yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(first, pa.int64())], names=["id", "component"])

    return kept.repartition(1).mapInArrow(run, "id bigint, component bigint")


def _stories(forest: DataFrame, n: int, params: Params, most: int) -> tuple[DataFrame, float | None]:
    """((theme, kind, threshold, id, story), theme threshold): members of stories, and a row without id for each theme.

    kind is split, whole (too small for the second share to bind) or dropped (it doesn't split).
    """
    spark = forest.sparkSession
    schema = "theme bigint, kind string, threshold double, id bigint, story bigint"
    at = threshold(forest, n, params.theme_share, params.edge_floor, params.threshold_hi, params.threshold_step, most).first()["threshold"]
    if at is None:
        return spark.createDataFrame([], schema), None
    member = components(forest, at, most)
    themes = member.groupBy("component").agg(F.count("*").alias("size")).filter(F.col("size") >= params.min_theme)
    member = cut(member.join(themes, "component").select("id", F.col("component").alias("theme"), "size"), "member")
    inside = cut(forest.filter(F.col("score") >= F.lit(at).cast("float")).join(member.withColumnRenamed("id", "a"), "a"), "inside")

    def outcome(size: int, stories: int) -> str:
        return "split" if stories else "whole" if params.min_story <= size < params.min_story / params.story_share else "dropped"

    def split(part: pd.DataFrame) -> pd.DataFrame:
        a, b, w = part["a"].to_numpy(), part["b"].to_numpy(), part["score"].to_numpy(np.float32)
        size, theme = int(part["size"].iloc[0]), int(part["theme"].iloc[0])
        second = search(a, b, w, size, params.story_share, at, params.threshold_hi, params.threshold_step)
        nodes, first = np.zeros(0, np.int64), np.zeros(0, np.int64)
        if second is not None:
            kept = w >= np.float32(second)
            nodes, first = label(a[kept], b[kept])
            starts, counts = np.unique(first, return_counts=True)
            good = np.isin(first, starts[counts >= params.min_story])
            nodes, first = nodes[good], first[good]
        kind = outcome(size, len(nodes))
        if kind == "whole":
            nodes = np.unique(np.concatenate([a, b]))
            first = np.full(len(nodes), theme)
        ids = pd.array([None, *nodes.tolist()], dtype="Int64")
        return pd.DataFrame({"theme": theme, "kind": kind, "threshold": second, "id": ids, "story": pd.array([None, *first.tolist()], dtype="Int64")})

    rows = inside.filter(F.col("size") <= most).groupBy("theme").applyInPandas(split, schema)
    # themes above what a task may hold: of n rows at most n / most are such
    for theme, size in member.filter(F.col("size") > most).select("theme", "size").distinct().collect():
        own = inside.filter(F.col("theme") == theme).select("a", "b", "score")
        second = threshold(own, size, params.story_share, at, params.threshold_hi, params.threshold_step, most).first()["threshold"]
        found = spark.createDataFrame([], "id bigint, component bigint") if second is None else components(own, second, most)
        sizes = found.groupBy("component").agg(F.count("*").alias("k")).filter(F.col("k") >= params.min_story)
        found = cut(found.join(sizes, "component").select("id", F.col("component").alias("story")), "big")
        kind = outcome(size, found.count())
        if kind == "whole":
            found = member.filter(F.col("theme") == theme).select("id", F.lit(theme).alias("story"))
        head = spark.createDataFrame([(theme, kind, second, None, None)], schema)
        rows = rows.unionByName(head).unionByName(found.select(F.lit(theme).alias("theme"), F.lit(kind).alias("kind"), F.lit(second).cast("double").alias("threshold"), "id", "story"))
    return rows, at


def two_stage(forest: DataFrame, n: int, params: Params = DEFAULT, most: int = MERGE) -> DataFrame:
    """(id, theme, story): themes at the percolation threshold, then stories by a second search within each theme.

    A theme that doesn't split is a story if it is too small for the second share to bind (min_story / story_share rows),
    and dropped if larger. The second stage runs per theme on the forest's own edges.
    """
    return _stories(forest, n, params, most)[0].filter("id is not null").select("id", "theme", "story")


def two_stage_report(forest: DataFrame, n: int, params: Params = DEFAULT, most: int = MERGE) -> DataFrame:
    """(articles, theme_threshold, themes, unsplit_themes, indivisible_themes, story_thresholds, stories, articles_in_stories)."""
    rows, at = _stories(forest, n, params, most)
    head = F.col("id").isNull()
    return rows.agg(
        F.lit(n).cast("bigint").alias("articles"), F.lit(at).cast("double").alias("theme_threshold"), F.count_if(head).alias("themes"), F.count_if(head & (F.col("kind") == "dropped")).alias("unsplit_themes"),
        F.count_if(head & (F.col("kind") == "whole")).alias("indivisible_themes"), F.count_if(head & F.col("threshold").isNotNull()).alias("story_thresholds"),
        F.count_distinct("story").alias("stories"), F.count("id").alias("articles_in_stories"),
    )


def project(rows: DataFrame, per_group: int = 120, least_agreement: float = 0.75, grid: int = 1000) -> DataFrame:
    """(id, label, x, y, retained, agreement): the first two principal components of a bounded sample of each group.

    rows has id, label, v. Groups are sampled evenly, `per_group` rows at most, and the sample is projected in one task;
    fewer than two groups, or neighbours that agree on the label less often than least_agreement, give nothing.
    """
    from pyspark.sql import Window

    w = Window.partitionBy("label")
    place = F.row_number().over(w.orderBy("id")) - 1
    n = F.count("*").over(w)
    # row k of n is taken if it is the rounded place of one of the sample's points
    point = F.rint(place * (per_group - 1) / F.nullif(n - 1, F.lit(0)))
    taken = rows.withColumn("_k", place).withColumn("_n", n).withColumn("_p", point)
    taken = taken.filter((F.col("_n") <= per_group) | (F.rint(F.col("_p") * (F.col("_n") - 1) / (per_group - 1)) == F.col("_k")))

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["label", "id"])
        empty = pd.DataFrame({"id": [], "label": [], "x": [], "y": [], "retained": [], "agreement": []})
        part = part.groupby("label").filter(lambda g: len(g) >= 2)
        if part["label"].nunique() < 2:
            return empty
        v = np.stack(part["v"].to_numpy()).astype(np.float64)
        v -= v.mean(0)
        u, s, axes = np.linalg.svd(v, full_matrices=False)
        flip = np.sign(axes[np.arange(2), np.abs(axes[:2]).argmax(1)])  # the largest loading is positive
        xy = u[:, :2] * s[:2] * flip
        apart = ((xy[:, None] - xy[None]) ** 2).sum(2)
        np.fill_diagonal(apart, np.inf)
        labels = part["label"].to_numpy()
        agreement = float((labels[apart.argmin(1)] == labels).mean())
        if agreement < least_agreement:
            return empty
        span = np.where(np.ptp(xy, axis=0) > 0, np.ptp(xy, axis=0), 1)
        cell = np.rint((xy - xy.min(0)) / span * grid).astype(int)
        return pd.DataFrame({"id": part["id"], "label": part["label"], "x": cell[:, 0], "y": cell[:, 1], "retained": float((s[:2] ** 2).sum() / (s**2).sum()), "agreement": agreement})

    return taken.select("id", "label", "v").withColumn("_one", F.lit(1)).groupBy("_one").applyInPandas(lambda p: run(p.drop(columns="_one")), "id bigint, label bigint, x bigint, y bigint, retained double, agreement double")
