"""Story identity from run to run, by shared addresses."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parallax.functions.lineage import cut
from parallax.params import DEFAULT


def seeded_id(url: Column) -> Column:
    return F.concat(F.lit("s-"), F.substring(F.sha1(url.cast("binary")), 1, 12))


def containment(clusters: DataFrame, known: DataFrame) -> DataFrame:
    """(cluster, id, shared, nk, prior_rank, containment): shared addresses over the smaller set, for pairs that share one.

    clusters holds (cluster, url), known (id, url, prior_rank). Only pairs with a common url are formed.
    """
    c, k = clusters.select("cluster", "url").distinct(), known.select("id", "url", "prior_rank").distinct()
    sizes_c, sizes_k = c.groupBy("cluster").agg(F.count("*").alias("nc")), k.groupBy("id").agg(F.count("*").alias("nk"), F.min("prior_rank").alias("prior_rank"))
    shared = c.join(k.select("id", "url"), "url").groupBy("cluster", "id").agg(F.count("*").alias("shared"))
    met = shared.join(sizes_c, "cluster").join(sizes_k, "id")
    return met.select("cluster", "id", "shared", "nk", "prior_rank", (F.col("shared") / F.least("nc", "nk")).alias("containment"))


def _first_come(rows: DataFrame, wishes: str, all_of_them: bool) -> DataFrame:
    """(cluster, got): clusters in order take those of their wishes that none before took; all of them, or the first only.

    Only clusters that share a wish with another are walked in order, in one task that holds the wishes taken; the others
    get what they ask for where they are. rows: cluster, the array of wishes.
    """
    asked = rows.select("cluster", F.explode(wishes).alias("w"))
    shared = asked.groupBy("w").agg(F.count("*").alias("n")).filter("n > 1").select("w")
    met = cut(asked.join(shared, "w").select("cluster").distinct(), "contested")
    schema = T.StructType([rows.schema["cluster"], T.StructField("got", T.ArrayType(T.StringType()))])

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        taken: set[str] = set()
        for batch in batches:
            got = []
            for wish in batch.column(1).to_pylist():
                free = [w for w in wish if w not in taken]
                free = free if all_of_them else free[:1]
                taken.update(free)
                got.append(free)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(got, pa.list_(pa.string()))], names=["cluster", "got"])

    contested = rows.join(met, "cluster", "left_semi").select("cluster", F.col(wishes).alias("w")).repartition(1).sortWithinPartitions("cluster").mapInArrow(walk, schema)
    own = F.col(wishes) if all_of_them else F.slice(wishes, 1, 1)
    return rows.join(met, "cluster", "left_anti").select("cluster", own.alias("got")).unionByName(contested)


def fresh_ids(clusters: DataFrame, taken: DataFrame) -> DataFrame:
    """(cluster, id): for each cluster in order the id seeded by its first address whose id is free, else by all of them.

    clusters: cluster, url; taken: id. Ids in use are dropped by a join, what remains is first come, first served.
    """
    urls = clusters.select("cluster", "url").distinct().withColumn("seed", seeded_id(F.col("url")))
    free = urls.join(taken.select(F.col("id").alias("seed")).distinct(), "seed", "left_anti")
    wishes = free.groupBy("cluster").agg(F.transform(F.sort_array(F.collect_list(F.struct("url", "seed"))), lambda x: x["seed"]).alias("wishes"))
    every = urls.groupBy("cluster").agg(seeded_id(F.array_join(F.sort_array(F.collect_list("url")), "|")).alias("whole"))
    rows = cut(every.join(wishes, "cluster", "left").select("cluster", "whole", F.coalesce("wishes", F.array().cast("array<string>")).alias("wishes")), "wishes")
    got = _first_come(rows.select("cluster", "wishes"), "wishes", False)
    return rows.join(got, "cluster", "left").select("cluster", F.coalesce(F.try_element_at("got", F.lit(1)), "whole").alias("id"))


def reconcile(clusters: DataFrame, known: DataFrame, least: float = DEFAULT.containment) -> DataFrame:
    """What became of each cluster and each known story: (seq, type, id, cluster, sources).

    Clusters are taken in order; each takes the largest free known story that it contains enough of (the earlier of
    equals) and absorbs the other free ones: 'merged' with the absorbed as sources, 'kept' without. A cluster whose
    candidates are all taken is a 'split' with these as sources, one without candidates is 'created'; both get a fresh id.
    Known stories that no cluster took or absorbed are 'dormant', without cluster. sources are sorted by id; seq orders
    the rows as they happen: clusters first, then dormant stories in prior order.
    """
    candidates = containment(clusters, known).filter(F.col("containment") >= least)
    order = F.sort_array(F.collect_list(F.struct((-F.col("nk")).alias("size"), "prior_rank", "id")))
    packed = cut(candidates.groupBy("cluster").agg(F.transform(order, lambda x: x["id"]).alias("wishes")), "candidates")
    names = clusters.select("cluster").distinct()
    settled = cut(names.join(packed, "cluster", "left").join(_first_come(packed, "wishes", True), "cluster", "left"), "settled")
    ids = known.groupBy("id").agg(F.min("prior_rank").alias("prior_rank"))
    fresh = fresh_ids(clusters.join(settled.filter("coalesce(size(got), 0) <= 0").select("cluster"), "cluster", "left_semi"), ids)
    got = F.coalesce("got", F.array().cast("array<string>"))
    kind = F.when(F.size(got) > 1, "merged").when(F.size(got) == 1, "kept").when(F.col("wishes").isNotNull(), "split").otherwise("created")
    others = F.when(F.size(got) > 0, F.slice(got, 2, 1 << 30)).otherwise(F.coalesce("wishes", F.array().cast("array<string>")))
    taken = settled.join(fresh, "cluster", "left").select(F.lit(0).alias("last"), F.col("cluster").alias("place"), kind.alias("type"), F.coalesce(F.try_element_at(got, F.lit(1)), "id").alias("id"), "cluster", F.sort_array(others).alias("sources"))
    held = settled.select(F.explode("got").alias("id"))
    quiet = ids.join(held, "id", "left_anti").select(F.lit(1).alias("last"), F.col("prior_rank").cast(taken.schema["place"].dataType).alias("place"), F.lit("dormant").alias("type"), "id", F.lit(None).cast(taken.schema["cluster"].dataType).alias("cluster"), F.array().cast("array<string>").alias("sources"))
    return taken.unionByName(quiet).select(F.struct("last", "place", "id").alias("seq"), "type", "id", "cluster", "sources")
