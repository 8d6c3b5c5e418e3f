"""The knowledge-graph feed without quoting, as its publisher's own decoders read it."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WIDTH = 27


def read_zips(spark: SparkSession, path: str) -> DataFrame:
    """(path, line) of all files in zip archives; bytes that are no UTF-8 are replaced. An archive is one task's work."""

    def unzip(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                with zipfile.ZipFile(io.BytesIO(content)) as archive:
                    for member in archive.namelist():
                        with archive.open(member) as raw:
                            lines = io.TextIOWrapper(raw, encoding="utf-8", errors="replace", newline="\n")
                            held: list[str] = []
                            for line in lines:
                                held.append(line.rstrip("\r\n"))
                                if len(held) == 5000:
                                    yield pa.RecordBatch.from_arrays([pa.array([name] * len(held)), pa.array(held)], names=["path", "line"])
                                    held = []
                            if held:
                                yield pa.RecordBatch.from_arrays([pa.array([name] * len(held)), pa.array(held)], names=["path", "line"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInArrow(unzip, "path string, line string")


def fields(lines: DataFrame, line: str = "line") -> DataFrame:
    """Lines with their fields; empty lines are no lines."""
    return lines.filter(F.col(line) != "").withColumn("f", F.split(line, "\t", -1))


def _url() -> Column:
    return F.trim(F.try_element_at("f", F.lit(5)))


def fidelity(rows: DataFrame, by: str = "feed") -> DataFrame:
    """(by, lines_seen, wrong_width, no_url, fidelity): how many lines of each feed parse."""
    wide = F.size("f") == WIDTH
    named = wide & (_url() != "")
    return rows.groupBy(by).agg(F.count("*").alias("lines_seen"), F.count_if(~wide).alias("wrong_width"), F.count_if(wide & (_url() == "")).alias("no_url"), F.round(F.count_if(named) / F.count("*"), 6).alias("fidelity"))


def _list(field: int, value, keep=None) -> Column:
    parts = F.split(F.element_at("f", field), ";")
    if keep is not None:
        parts = F.filter(parts, keep)
    return F.filter(F.transform(parts, lambda x: F.trim(value(x))), lambda x: x != "")


def decoded(rows: DataFrame) -> DataFrame:
    """Sound lines with url, locations, names, persons and organisations as lists."""
    sound = rows.filter((F.size("f") == WIDTH) & (_url() != ""))
    return sound.select(
        *[c for c in rows.columns if c not in ("f", "line")], _url().alias("url"),
        _list(10, lambda x: F.try_element_at(F.split(x, "#"), F.lit(2)), lambda x: F.contains(x, F.lit("#"))).alias("locations"),
        _list(24, lambda x: F.regexp_replace(x, ",[^,]*$", "")).alias("names"), _list(12, lambda x: x).alias("persons"), _list(14, lambda x: x).alias("organisations"),
    )


def merged(rows: DataFrame, order: tuple[str, ...] = ("slot", "feed", "line_id")) -> DataFrame:
    """One row per url: of the oldest slot, of the feed read last in it, the last line."""
    slot, feed, line = order
    oldest = rows.groupBy("url").agg(F.min(slot).alias(slot))
    last = rows.join(oldest, ["url", slot]).groupBy("url").agg(F.max(F.struct(feed, line, *[c for c in rows.columns if c not in ("url", feed, line)])).alias("x"))
    return last.select("url", "x.*")


def join_rate(asked: DataFrame, rows: DataFrame) -> DataFrame:
    """(asked, matched, rate): urls, as they are, that the feed has; a url asked twice is matched once."""
    urls = asked.filter("url is not null").groupBy("url").agg(F.count("*").alias("n"))
    known = rows.filter("url is not null").select("url", F.lit(True).alias("hit")).distinct()
    met = urls.join(known, "url", "left")
    return met.agg(F.sum("n").alias("asked"), F.count("hit").alias("matched"), F.round(F.count("hit") / F.sum("n"), 4).alias("rate"))
