"""Publisher, article number and instant from addresses and stamps written in many ways."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A publisher list up to this many rows is broadcast; a longer one is joined by shuffle.
SMALL_DIM_ROWS = 100_000


def address_host(url: Column) -> Column:
    """Host in lower case without user info, port and trailing dot; null unless the scheme is http or https."""
    host = F.lower(F.regexp_extract(F.trim(url), r"(?i)^https?://(?:[^/?#@]*@)?([^/?#:@\s]+)", 1))
    return F.nullif(F.regexp_replace(host, r"\.+$", ""), F.lit(""))


def address_number(url: Column) -> Column:
    """The article's number: an id or sid parameter, else a whole path segment, else the end of the last segment.

    Dates in the path have 4 and 2 digits and years in slugs 4; a number has 5 at least.
    """
    bare = F.regexp_replace(F.regexp_replace(F.trim(url), r"#.*$", ""), "%2[dD]", "-")
    path, query = F.regexp_replace(bare, r"\?.*$", ""), F.regexp_extract(bare, r"\?(.*)$", 1)
    by_query = F.regexp_extract(query, r"(?i)(?:^|&)s?id=0*(\d+)(?:&|$)", 1)
    by_segment = F.regexp_extract(path, r"/0*(\d{5,})(?:/|$)", 1)
    by_ending = F.regexp_extract(path, r"[-_/]0*(\d{5,})(?:\.[A-Za-z]+)?/*$", 1)
    empty = F.lit("")
    return F.coalesce(F.nullif(by_query, empty), F.nullif(by_segment, empty), F.nullif(by_ending, empty))


def address_rest(url: Column) -> Column:
    """What tells addresses without a number apart: the decoded path without fragment, query and outer slashes."""
    bare = F.regexp_replace(F.lower(F.trim(url)), r"[?#].*$", "")
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(bare, r"^https?://[^/]*", ""), "%2d", "-"), r"^/+|/+$", "")


def stamp_seconds(stamp: Column) -> Column:
    """Seconds since 1970 of a stamp in basic or extended notation, UTC unless it says otherwise; null if not valid."""
    pattern = r"^\s*(\d{4})-?(\d{2})-?(\d{2})[Tt ]?(\d{2}):?(\d{2}):?(\d{2})(?:\.\d+)?\s*([Zz]|[+-]\d{2}:?\d{2})?\s*$"
    digits = F.regexp_replace(stamp, pattern, "$1$2$3$4$5$6")
    zone = F.regexp_extract(stamp, pattern, 7)
    offset = F.when(zone.rlike("^[+-]"), F.concat(F.substring(zone, 1, 3), F.lit(":"), F.substring(zone, -2, 2))).otherwise("+00:00")
    whole = F.when(stamp.rlike(pattern), F.concat(digits, offset))
    return F.unix_seconds(F.try_to_timestamp(whole, F.lit("yyyyMMddHHmmssXXX")))


def with_publisher(df: DataFrame, host: str, publishers: DataFrame, out: str = "publisher", depth: int = 3) -> DataFrame:
    """Add the publisher of a host: the longest of the host and its parents (up to `depth` labels less) in publishers.

    Hosts of no known publisher stand for themselves, without a leading www. publishers is a dimension; it is
    broadcast only if its counted rows are few.
    """
    known = publishers.select(F.lower(F.col("domain")).alias("_known")).filter("_known is not null").distinct()
    small = known.count() <= SMALL_DIM_ROWS
    tries = []
    for cut in range(depth + 1):
        at = f"_host{cut}"
        df = df.withColumn(at, F.regexp_replace(F.col(host), rf"^(?:[^.]+\.){{{cut}}}", "") if cut else F.col(host))
        dim = known.select(F.col("_known").alias(f"_found{cut}"))
        df = df.join(F.broadcast(dim) if small else dim, F.col(at) == F.col(f"_found{cut}"), "left")
        tries.append(F.col(f"_found{cut}"))
    found = F.coalesce(*tries, F.regexp_replace(F.col(host), r"^www\.", ""))
    return df.withColumn(out, found).drop(*[f"_host{i}" for i in range(depth + 1)], *[f"_found{i}" for i in range(depth + 1)])
