"""Queries of the similarity graph and of story identity, with their SQL."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from parallax.operators import grouping, identity
from parallax.params import Params
from parallax.plans.registry import query
from parallax.sources.tables import table

DIM = 64
#: The test vectors are far apart: lower floors than a day's.
LOW = Params(edge_floor=0.20, threshold_hi=0.60, theme_share=0.05, min_theme=8, min_story=3)
_PAIRS = "WITH v AS (SELECT vec_id AS id, embedding AS v FROM embeddings), e AS (SELECT x.id AS a, y.id AS b, list_dot_product(x.v, y.v) AS score FROM v x JOIN v y ON x.id < y.id)"


def vectors(spark, folder):
    return grouping.normalised(table(spark, folder, "embeddings"), "vec_id", "embedding", DIM)


def forest_of(spark, folder):
    return grouping.vector_forest(vectors(spark, folder), DIM, LOW.edge_floor)


@query("unit_vectors", "SELECT vec_id AS id, round(embedding[1] / sqrt(list_dot_product(embedding, embedding)), 3) + 0.0 AS x, round(sqrt(list_dot_product(embedding, embedding)), 3) AS norm FROM embeddings WHERE len(embedding) = 64")
def unit_vectors(spark, folder):
    raw = table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, x: s + x.cast("double") * x)).alias("n"))
    return vectors(spark, folder).join(raw, "id").select("id", (F.round(F.element_at("v", 1).cast("double"), 3) + F.lit(0.0)).alias("x"), F.round("n", 3).alias("norm"))


@query("cosine_edges", _PAIRS + " SELECT a, b FROM e WHERE score >= 0.3")
def cosine_edges(spark, folder):
    return grouping.cosine_edges(vectors(spark, folder), DIM, 0.3).select("a", "b")


@query("spanning_forest", None)
def spanning_forest(spark, folder):
    return forest_of(spark, folder).select("a", "b", F.round(F.col("score").cast("double"), 4).alias("score"))


#: Components at every candidate threshold at once: k counts the steps down from the highest.
_LEVELS = """
WITH RECURSIVE v AS (SELECT vec_id AS id, embedding AS v FROM embeddings WHERE len(embedding) = 64), e AS (SELECT x.id AS a, y.id AS b, list_dot_product(x.v, y.v) AS score FROM v x JOIN v y ON x.id <> y.id AND list_dot_product(x.v, y.v) >= 0.20),
c AS (SELECT k, 0.60::DOUBLE - k * 0.01::DOUBLE AS t FROM range(41) r(k)), step AS (SELECT k, a, b FROM c JOIN e ON e.score >= c.t),
cc(k, id, low) USING KEY (k, id) AS (SELECT DISTINCT k, a, a FROM step UNION (SELECT DISTINCT ON (u.k, u.id) u.k, u.id, w.low FROM recurring.cc u JOIN step s ON s.k = u.k AND s.a = u.id JOIN cc w ON w.k = s.k AND w.id = s.b WHERE w.low < u.low ORDER BY u.k, u.id, w.low)),
labels AS MATERIALIZED (SELECT k, id, low FROM cc), sizes AS (SELECT k, low, count(*) AS n FROM labels GROUP BY ALL),
largest AS (SELECT c.k, coalesce(max(n), 1) AS n FROM c LEFT JOIN sizes s ON s.k = c.k GROUP BY c.k), top AS (SELECT max(k) AS k FROM largest WHERE n <= 0.05 * (SELECT count(*) FROM v))
"""
_STAGES = _LEVELS + """
, themes AS (SELECT low AS theme, n AS size FROM sizes JOIN top USING (k) WHERE n >= 8), member AS (SELECT id, theme, size FROM labels JOIN top USING (k) JOIN themes ON low = theme),
inside AS (SELECT l.k, l.id, l.low, theme, size FROM labels l JOIN member m ON m.id = l.id WHERE l.k <= (SELECT k FROM top)), per AS (SELECT theme, size, k, low, count(*) AS n FROM inside GROUP BY ALL),
fit AS (SELECT t.theme, t.size, c.k, coalesce(max(per.n), 1) AS n FROM themes t JOIN c ON c.k <= (SELECT k FROM top) LEFT JOIN per ON per.theme = t.theme AND per.k = c.k GROUP BY ALL),
second AS (SELECT theme, max(k) AS k FROM fit WHERE n <= 0.35 * size GROUP BY theme),
split AS (SELECT i.id, i.theme, i.low AS story FROM inside i JOIN second s ON s.theme = i.theme AND s.k = i.k JOIN per p ON p.theme = i.theme AND p.k = i.k AND p.low = i.low WHERE p.n >= 3),
kinds AS (SELECT theme, CASE WHEN theme IN (SELECT theme FROM split) THEN 'split' WHEN size >= 3 AND size < 3 / 0.35 THEN 'whole' ELSE 'dropped' END AS kind FROM themes),
stories AS (SELECT * FROM split UNION ALL SELECT id, m.theme, m.theme FROM member m JOIN kinds k ON k.theme = m.theme AND kind = 'whole')
"""


@query("percolation_threshold", _LEVELS + "SELECT round(0.60 - k * 0.01, 4)::DOUBLE AS threshold FROM top")
def percolation_threshold(spark, folder):
    n = table(spark, folder, "embeddings").count()
    return grouping.threshold(forest_of(spark, folder), n, LOW.theme_share, LOW.edge_floor, LOW.threshold_hi)


@query(
    "components_at",
    "WITH RECURSIVE v AS (SELECT vec_id AS id, embedding AS v FROM embeddings), e AS (SELECT x.id AS a, y.id AS b FROM v x JOIN v y ON x.id <> y.id AND list_dot_product(x.v, y.v) >= 0.36), "
    "r AS (SELECT DISTINCT a AS id, a AS low FROM e UNION SELECT e.b, r.low FROM r JOIN e ON e.a = r.id) SELECT id, min(low) AS component FROM r GROUP BY id",
)
def components_at(spark, folder):
    return grouping.components(forest_of(spark, folder), 0.36)


@query("two_stage_stories", _STAGES + "SELECT id, theme, story FROM stories")
def two_stage_stories(spark, folder):
    return grouping.two_stage(forest_of(spark, folder), table(spark, folder, "embeddings").count(), LOW)


@query(
    "two_stage_report",
    _STAGES + "SELECT (SELECT count(*) FROM v) AS articles, (SELECT round(0.60 - k * 0.01, 4)::DOUBLE FROM top) AS theme_threshold, (SELECT count(*) FROM themes) AS themes, (SELECT count(*) FROM kinds WHERE kind = 'dropped') AS unsplit_themes, (SELECT count(*) FROM kinds WHERE kind = 'whole') AS indivisible_themes, "
    "(SELECT count(*) FROM second) AS story_thresholds, (SELECT count(DISTINCT story) FROM stories) AS stories, (SELECT count(*) FROM stories) AS articles_in_stories",
)
def two_stage_report(spark, folder):
    """How many themes and stories a grouping gave, and how many articles reached one."""
    return grouping.two_stage_report(forest_of(spark, folder), table(spark, folder, "embeddings").count(), LOW)


@query("projection", None)
def projection(spark, folder):
    """All groups of the vectors; nothing where neighbours in the plane agree on the group too seldom."""
    rows = vectors(spark, folder).join(table(spark, folder, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").cast("bigint").alias("label")), "id")
    return grouping.project(rows).select("id", "label", "x", "y")


@query("label_centroids", "SELECT label, round(avg(embedding[1]), 6) AS x, round(avg(embedding[2]), 6) AS y, count(*) AS n FROM embeddings GROUP BY label")
def label_centroids(spark, folder):
    part = lambda k: F.round(F.avg(F.element_at("embedding", k).cast("double")), 6)
    return table(spark, folder, "embeddings").groupBy("label").agg(part(1).alias("x"), part(2).alias("y"), F.count("*").alias("n"))


@query("seeded_story_ids", "SELECT DISTINCT url, 's-' || sha1(url)[1:12] AS id FROM capture WHERE url IS NOT NULL")
def seeded_story_ids(spark, folder):
    return table(spark, folder, "capture").filter("url is not null").select("url", identity.seeded_id(F.col("url")).alias("id")).distinct()


def _halves(spark, folder):
    """Two overlapping parts of the rows, as the SQL of url_containment has them: stories of addresses by publisher, with a share of them in both."""
    rows = table(spark, folder, "capture").filter("url is not null and domain is not null")
    known = rows.filter("capture_id % 10 < 7").groupBy("url").agg(F.min("domain").alias("d")).select(F.concat(F.lit("k-"), "d").alias("id"), "url", F.crc32("d").alias("prior_rank"))
    now = rows.filter("capture_id % 10 >= 3").groupBy("url").agg(F.min("domain").alias("d")).select(F.crc32(F.substring("d", 1, 6)).alias("cluster"), "url")
    return now, known


@query(
    "url_containment",
    "WITH r AS (SELECT * FROM capture WHERE url IS NOT NULL AND domain IS NOT NULL), k AS (SELECT url, min(domain) AS d FROM r WHERE capture_id % 10 < 7 GROUP BY url), c AS (SELECT url, min(domain)[1:6] AS c FROM r WHERE capture_id % 10 >= 3 GROUP BY url), "
    "s AS (SELECT c, d, count(*) AS shared FROM c JOIN k USING (url) GROUP BY ALL), nc AS (SELECT c, count(*) AS nc FROM c GROUP BY c), nk AS (SELECT d, count(*) AS nk FROM k GROUP BY d) "
    "SELECT 'k-' || d AS id, shared, nk, round(shared / least(nc, nk), 6) AS containment FROM s JOIN nc USING (c) JOIN nk USING (d)",
)
def url_containment(spark, folder):
    return identity.containment(*_halves(spark, folder)).select("id", "shared", "nk", F.round("containment", 6).alias("containment"))


def _runs(spark, folder):
    """(cluster, url) of the stories of the later half of the runs, (id, url, prior_rank) of all runs before, over all rows of evidence.

    Stories are taken in order of their names.
    """
    rows = table(spark, folder, "evidence").filter("run is not null and story_id is not null and url is not null")
    runs = rows.select("run").distinct()
    place = F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("run"))  # ingest batches, not data
    halfway = F.broadcast(runs.withColumn("k", place).withColumn("n", F.count("*").over(Window.partitionBy(F.lit(0)))).filter("k = ceil(n / 2)").select(F.col("run").alias("_half")))  # one row
    rows = rows.join(halfway).select("story_id", "url", (F.col("run") <= F.col("_half")).alias("before"))
    return rows.filter("not before").select(F.col("story_id").alias("cluster"), "url").distinct(), rows.filter("before").select(F.col("story_id").alias("id"), "url", F.col("story_id").alias("prior_rank")).distinct()


@query(
    "run_containment",
    "WITH r AS (SELECT * FROM evidence WHERE run IS NOT NULL AND story_id IS NOT NULL AND url IS NOT NULL), m AS (SELECT quantile_disc(run, 0.5) AS m FROM (SELECT DISTINCT run FROM r)), k AS (SELECT DISTINCT story_id, url FROM r, m WHERE run <= m), c AS (SELECT DISTINCT story_id, url FROM r, m WHERE run > m), "
    "s AS (SELECT c.story_id AS c, k.story_id AS id, count(*) AS shared FROM c JOIN k USING (url) GROUP BY ALL), nc AS (SELECT story_id AS c, count(*) AS nc FROM c GROUP BY ALL), nk AS (SELECT story_id AS id, count(*) AS nk FROM k GROUP BY ALL) "
    "SELECT id, shared, nk, round(shared / least(nc, nk), 6) AS containment FROM s JOIN nc USING (c) JOIN nk USING (id)",
)
def run_containment(spark, folder):
    return identity.containment(*_runs(spark, folder)).select("id", "shared", "nk", F.round("containment", 6).alias("containment"))


_RECONCILED = """
WITH RECURSIVE r AS (SELECT * FROM evidence WHERE run IS NOT NULL AND story_id IS NOT NULL AND url IS NOT NULL), m AS (SELECT quantile_disc(run, 0.5) AS m FROM (SELECT DISTINCT run FROM r)),
k AS (SELECT DISTINCT story_id AS id, url FROM r, m WHERE run <= m), c AS (SELECT DISTINCT story_id AS cluster, url FROM r, m WHERE run > m),
nk AS (SELECT id, count(*) AS nk FROM k GROUP BY ALL), nc AS (SELECT cluster, count(*) AS nc FROM c GROUP BY ALL), s AS (SELECT cluster, id, count(*) AS shared FROM c JOIN k USING (url) GROUP BY ALL),
w AS (SELECT cluster, list(id ORDER BY nk DESC, id) AS wishes FROM s JOIN nk USING (id) JOIN nc USING (cluster) WHERE shared / least(nc, nk) >= 0.5 GROUP BY cluster),
u AS (SELECT cluster, list('s-' || sha1(url)[1:12] ORDER BY url) AS seeds, 's-' || sha1(string_agg(url, '|' ORDER BY url))[1:12] AS whole FROM c GROUP BY cluster),
q AS (SELECT row_number() OVER (ORDER BY cluster) AS i, cluster, coalesce(wishes, []) AS wishes, seeds, whole FROM u LEFT JOIN w USING (cluster)),
known AS (SELECT list(id) AS ids FROM nk),
walk AS (
  SELECT 0::BIGINT AS i, NULL::VARCHAR AS cluster, []::VARCHAR[] AS free, []::VARCHAR[] AS wishes, NULL::VARCHAR AS fresh, []::VARCHAR[] AS used, []::VARCHAR[] AS made
  UNION ALL
  SELECT i, cluster, free, wishes, CASE WHEN len(free) = 0 THEN fresh END, list_concat(used, free), CASE WHEN len(free) = 0 THEN list_append(made, fresh) ELSE made END FROM (
    SELECT q.i, q.cluster, list_filter(q.wishes, lambda x: NOT list_contains(walk.used, x)) AS free, q.wishes, walk.used, walk.made,
      coalesce(list_filter(q.seeds, lambda x: NOT list_contains(walk.made, x) AND NOT list_contains(known.ids, x))[1], q.whole) AS fresh
    FROM walk JOIN q ON q.i = walk.i + 1 CROSS JOIN known)
), got AS (SELECT * FROM walk WHERE i > 0)
SELECT CASE WHEN len(free) > 1 THEN 'merged' WHEN len(free) = 1 THEN 'kept' WHEN len(wishes) > 0 THEN 'split' ELSE 'created' END AS type, coalesce(free[1], fresh) AS id, cluster,
  array_to_string(list_sort(CASE WHEN len(free) > 0 THEN free[2:] ELSE wishes END), ',') AS sources FROM got
UNION ALL SELECT 'dormant', id, NULL, '' FROM nk WHERE id NOT IN (SELECT unnest(free) FROM got)
"""


@query("reconcile_events", _RECONCILED)
def reconcile_events(spark, folder):
    return identity.reconcile(*_runs(spark, folder)).select("type", "id", "cluster", F.array_join("sources", ",").alias("sources"))
