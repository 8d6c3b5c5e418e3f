"""Rows that fail to parse (problem 3): the knowledge-graph feed read with reject tables on the workers.

Each batch of lines becomes scratch files of its task, which DuckDB reads as CSV with a reject table per file: one of the
lines in which some field begins with a quote, one of the others. A quote that never closes would swallow the lines after
its own and blame the wrong one; so in the first file a guard line behind each line ends such a quote. Lines whose fate is
told nowhere all the same (two faults in one) are read again, all in one call, each as a file of its own. The line-level
errors are joined to the raw lines, and the typed values of the lines that parse are checked in the same query.
"""

from __future__ import annotations

import os
import shutil
import tempfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parallax.functions.lineage import spread

WIDTH = 27
#: Field numbers of the feed that are kept.
FIELDS = {"url": 4, "locations": 9, "persons": 11, "organisations": 13, "names": 23}
#: Characters that a line may hold and a CSV line may not.
HELD = "\n\r\0"
#: A line of the right width that ends a quote left open before it, with an error of the line that opened it.
GUARD = 'x"x' + "\t" * (WIDTH + 1) + "."
#: Lines of a batch, and of a call that reads them apart.
BATCH, APART = 5000, 1000

URL = r"(?i)https?://(?:[^\s\p{Z}/?#@]*@)?[^\s\p{Z}/?#:@]+(?::\d*)?(?:[/?#][^\s\p{Z}]*)?"
PLACE = r"[1-5]#[^#]*[^#\s][^#]*#[^#]*#[^#]*#(-?\d+(?:\.\d+)?)?#(-?\d+(?:\.\d+)?)?#[^#]*"
NAME = r".*\S.*,\d+"

_BAD_PLACE = f"""x <> '' AND (NOT regexp_full_match(x, '{PLACE}') OR
  CASE WHEN split_part(x, '#', 5) = '' OR split_part(x, '#', 6) = '' THEN split_part(x, '#', 5) <> split_part(x, '#', 6)
       ELSE abs(coalesce(TRY_CAST(split_part(x, '#', 5) AS DOUBLE), 999)) > 90 OR abs(coalesce(TRY_CAST(split_part(x, '#', 6) AS DOUBLE), 999)) > 180 END)"""
_CHECK = f"""
SELECT w.n, CASE WHEN e.quote THEN 'quote' WHEN e.n IS NOT NULL THEN 'width'
    WHEN NOT regexp_full_match(p.url, '{URL}') OR len(list_filter(string_split(p.locations, ';'), lambda x: {_BAD_PLACE})) > 0
      OR len(list_filter(string_split(p.names, ';'), lambda x: x <> '' AND NOT regexp_full_match(x, '(?s){NAME}'))) > 0 THEN 'value' END AS reason,
  p.url, p.locations, p.persons, p.organisations, p.names
FROM wanted w
LEFT JOIN (SELECT TRY_CAST(n AS BIGINT) AS n, {", ".join(f"coalesce(f{i}, '') AS {c}" for c, i in FIELDS.items())} FROM parsed WHERE last = '.') p ON w.n = p.n
LEFT JOIN (SELECT n, bool_or(quote) AS quote FROM errors GROUP BY n) e ON w.n = e.n
WHERE p.n IS NOT NULL OR e.n IS NOT NULL
"""


def _write(path: str, lines: list[str]) -> None:
    with open(path, "w", encoding="utf-8", newline="") as out:
        out.write("\n".join(lines) + "\n")


def _read(connection, folder: str, lines: list[str], at: list[int], guarded: bool, apart: bool = False) -> pa.Table:
    """Reason and values of the lines that came through: (n, reason, url, locations, persons, organisations, names).

    The lines are read from one file, or each from a file of its own, with a guard behind each or not.
    """
    numbered = [f"{n}\t{line}\t." for n, line in zip(at, lines)]  # the last field is never empty: an empty one too many is ignored
    sizes = [len(x.encode()) for x in numbered]
    room = max(65_536, 2 * max(sizes))
    buffer = max(4 * room, 0 if apart else 2 * (sum(sizes) + len(at) * len(GUARD)))  # a file is one buffer: errors at a buffer's end may be lost
    paths = [f"{folder}/{n}" for n in at] if apart else [f"{folder}/lines"]
    written = [[x, GUARD] if guarded else [x] for x in numbered]
    for path, own in zip(paths, written) if apart else [(paths[0], [x for own in written for x in own])]:
        _write(path, own)
    columns = ", ".join(["'n': 'VARCHAR'", *[f"'f{i}': 'VARCHAR'" for i in range(WIDTH)], "'last': 'VARCHAR'"])
    connection.execute("DROP TABLE IF EXISTS reject_errors; DROP TABLE IF EXISTS reject_scans")
    connection.execute(
        f"CREATE OR REPLACE TEMP TABLE parsed AS SELECT * FROM read_csv({paths!r}, delim='\t', quote='\"', escape='\"', header=false, auto_detect=false, "
        f"strict_mode=true, null_padding=false, new_line='\\n', comment='', store_rejects=true, rejects_limit=0, max_line_size={room}, buffer_size={buffer}, columns={{{columns}}})"
    )
    # a line break inside a record means that its own line left a quote open; of a file of its own only the first line counts
    number, where = "split_part(csv_line, '\t', 1)", "true"
    if apart:
        number, where = "split_part(file_path, '/', -1)", "line = 1"
    every = ", ".join(f"f{i}" for i in range(WIDTH))
    connection.execute(
        f"CREATE OR REPLACE TEMP TABLE errors AS SELECT TRY_CAST({number} AS BIGINT) AS n, error_type = 'UNQUOTED VALUE' OR contains(rtrim(csv_line, chr(10)), chr(10)) AS quote "
        f"FROM reject_errors JOIN reject_scans USING (scan_id, file_id) WHERE {where} UNION ALL SELECT TRY_CAST(n AS BIGINT), true FROM parsed WHERE contains(concat_ws(' ', {every}), chr(10))"
    )
    connection.register("wanted", pa.table({"n": pa.array(at, pa.int64())}))
    found = connection.sql(_CHECK).to_arrow_table()
    connection.unregister("wanted")
    for path in paths:
        os.remove(path)
    return found


def _read_all(connection, folder: str, known: list[str], plain: list[int], quoted: list[int]) -> list[pa.Table]:
    """_read of all lines; those whose fate is not told are read apart."""
    parts, left = [], []
    for at, guarded in ((plain, False), (quoted, True)):
        if at:
            parts.append(_read(connection, folder, [known[i] for i in at], at, guarded))
            over = set(parts[-1].column("n").to_pylist())
            left += [i for i in at if i not in over]
    return parts + [_read(connection, folder, [known[i] for i in left[k : k + APART]], left[k : k + APART], True, True) for k in range(0, len(left), APART)]


def _stand_ins(lines: list[str]) -> dict[str, str]:
    """For each of HELD that occurs a character of the private areas that no line has."""
    held = [c for c in HELD if any(c in x for x in lines)]
    if not held:
        return {}
    used = set().union(*lines)
    free = (c for c in map(chr, (*range(0xE000, 0xF900), *range(0xF0000, 0x110000))) if c not in used)
    return {c: next(free) for c in held}


def _parser(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    import duckdb

    scratch = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None
    folder = tempfile.mkdtemp(prefix="rejects-", dir=scratch)  # of this task only, in the executor's scratch space
    connection = duckdb.connect(config={"threads": 1, "memory_limit": "400MB", "temp_directory": folder})
    try:
        for whole in batches:
            for start in range(0, whole.num_rows, BATCH):
                batch = whole.slice(start, BATCH)
                lines = batch.column(batch.num_columns - 1).to_pylist()
                known = [x or "" for x in lines]
                stands = _stand_ins(known)
                for a, b in stands.items():
                    known = [x.replace(a, b) if a in x else x for x in known]
                kinds = [x[:1] == '"' or '\t"' in x for x in known]
                parts = _read_all(connection, folder, known, [i for i, k in enumerate(kinds) if not k], [i for i, k in enumerate(kinds) if k])
                found = pa.concat_tables(parts).sort_by("n")
                columns = [batch.column(i) for i in range(batch.num_columns)]
                for c in ("reason", *FIELDS):
                    values = found.column(c).to_pylist()
                    if c != "reason":
                        for a, b in stands.items():
                            values = [x.replace(b, a) if x and b in x else x for x in values]
                    columns.append(pa.array(values, pa.string()))
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, "reason", *FIELDS])
    finally:
        connection.close()
        shutil.rmtree(folder, ignore_errors=True)


def parsed_lines(df: DataFrame, id_col: str = "line_id", line: str = "line", keep: tuple[str, ...] = ("slot", "feed")) -> DataFrame:
    """Every line once: id, kept columns, line, reason (null for sound lines) and the values of lines that parse."""
    rows = df.select(id_col, *keep, F.col(f"`{line}`").alias("line"))
    schema = T.StructType([*rows.schema, *[T.StructField(c, T.StringType()) for c in ("reason", *FIELDS)]])
    return spread(rows).mapInArrow(_parser, schema)


def read_feed(df: DataFrame, id_col: str = "line_id", line: str = "line", keep: tuple[str, ...] = ("slot", "feed")) -> tuple[DataFrame, DataFrame]:
    """(sound, rejected). sound: id, kept columns and url, locations, persons, organisations, names; rejected: id, kept columns, reason, line.

    reason is the first that applies: 'quote' (a quoted field doesn't close before a TAB or the end of the line), 'width'
    (not 27 fields; a null or empty line has none), 'value' (url, locations or names not valid). Lines are taken one by
    one: none affects another, repeated lines are each given, and lines may be of any length and hold line breaks. Empty
    fields come out as empty strings. An empty table gives two empty ones; other columns are ignored.
    """
    lines = parsed_lines(df, id_col, line, keep)
    sound = lines.filter("reason is null").select(id_col, *keep, *FIELDS)
    rejected = lines.filter("reason is not null").select(id_col, *keep, "reason", "line")
    return sound, rejected

