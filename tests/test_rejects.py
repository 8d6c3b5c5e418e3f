"""Lines that fail against a plain reading of the rules."""

import random
import re

import pytest

from parallax.sources.rejects import read_feed


def fields(line):
    out, i, n = [], 0, len(line)
    while True:
        if line[i : i + 1] == '"':
            j, value = i + 1, ""
            while True:
                if j >= n:
                    return None
                if line[j] == '"':
                    if line[j + 1 : j + 2] == '"':
                        value += '"'
                        j += 2
                        continue
                    break
                value += line[j]
                j += 1
            if j + 1 < n and line[j + 1] != "\t":
                return None
            out.append(value)
            i = j + 1
        else:
            j = line.find("\t", i)
            j = n if j < 0 else j
            out.append(line[i:j])
            i = j
        if i >= n:
            return out
        i += 1


NUMBER = re.compile(r"-?\d+(\.\d+)?")


def reason(line):
    f = fields(line or "")
    if f is None:
        return "quote"
    if len(f) != 27:
        return "width"
    if not re.fullmatch(r"(?i)https?://[^\s/?#:@]+(:\d*)?([/?#]\S*)?", f[4]):
        return "value"
    for entry in filter(None, f[9].split(";")):
        p = entry.split("#")
        if len(p) != 7 or p[0] not in tuple("12345") or not p[1].strip():
            return "value"
        if p[4] == p[5] == "":
            continue
        if not (NUMBER.fullmatch(p[4]) and NUMBER.fullmatch(p[5]) and abs(float(p[4])) <= 90 and abs(float(p[5])) <= 180):
            return "value"
    for entry in filter(None, f[23].split(";")):
        if not re.fullmatch(r"(?s).*\S.*,\d+", entry):
            return "value"
    return None


def line(rng):
    f = ["x"] * 27
    f[4] = rng.choice(["https://a.test/x", "http://b.test", "HTTPS://c.test?q", "https:///x", "ftp://a.test", "a.test/x", "", "https://a.test/a b"])
    f[4] = "https://a.test/x" if rng.random() < 0.7 else f[4]
    f[9] = rng.choice(["", ";", "1#P#A#B#1.5#-2#7", "1#P#A#B###7;", "6#P#A#B#1#2#3", "1##A#B#1#2#3", "1#P#A#B#91#2#3", "1#P#A#B#1##3", "1#P#A#B#1e1#2#3", "1#P#A#B#1#2"])
    f[9] = "" if rng.random() < 0.6 else f[9]
    f[23] = rng.choice(["", "N,1;", "N, M,22", "N", "N,", ",3", "N,-1", "N,1.5", " "])
    f[23] = "" if rng.random() < 0.6 else f[23]
    for _ in range(rng.choice([0, 0, 1, 2])):
        f[rng.randrange(27)] = rng.choice(['"q"', '"a\tb"', '"a""b"', '"open', '"', '"a"b', 'mid "q"', '""', 'end"', '"""q"""', '"t""', "a\nb", "\r"])
    if rng.random() < 0.1:
        f = f[: rng.randrange(1, 27)]
    if rng.random() < 0.1:
        f.append(rng.choice(["", "y", '""']))
    return "\t".join(f)


@pytest.mark.parametrize("seed", range(4))
def test_like_plain_reading(spark, seed):
    rng = random.Random(seed)
    lines = [line(rng) for _ in range(1500)] + [None, "", "\t" * 26, "\t" * 27, '"' * 5, "z" * 300_000]
    lines += lines[:20]
    rng.shuffle(lines)
    df = spark.createDataFrame(list(enumerate(lines)), "line_id long, line string").selectExpr("*", "'s' as slot", "'f' as feed", "1 as reason", "2 as url").repartition(3)
    sound, rejected = read_feed(df)
    got = {r["line_id"]: r["reason"] for r in rejected.collect()}
    want = {i: reason(x) for i, x in enumerate(lines)}
    assert got == {i: r for i, r in want.items() if r}
    values = {r["line_id"]: r for r in sound.collect()}
    assert set(values) == {i for i, r in want.items() if not r}
    for i, r in values.items():
        f = fields(lines[i])
        assert (r["url"], r["locations"], r["persons"], r["organisations"], r["names"]) == (f[4], f[9], f[11], f[13], f[23])


def test_characters_that_stand_for_others(spark):
    """Private-use characters of a line come out as they went in, beside lines with line breaks, returns and NULs."""
    odd = ["\ue000", "\ue001", "\ue00a\ue00d", "\n", "\r", "\0", '"q\n\ue000"', "\U000f0000"]
    lines = []
    for value in odd:
        f = ["x"] * 27
        f[4], f[9], f[23], f[11] = "https://a.test/x", "", "", value
        lines.append("\t".join(f))
    df = spark.createDataFrame(list(enumerate(lines)), "line_id long, line string").selectExpr("*", "'s' as slot", "'f' as feed").coalesce(1)
    sound, rejected = read_feed(df)
    assert rejected.count() == 0
    assert {r["line_id"]: r["persons"] for r in sound.collect()} == {i: v.strip('"') for i, v in enumerate(odd)}


def test_open_quotes_do_not_reach_other_lines(spark):
    f = ["x"] * 27
    f[4], f[9], f[23] = "https://a.test/x", "", ""
    sound = "\t".join(f)
    quoted = sound.replace("x\tx\tx\tx", '"a\tb"\tx\tx\tx', 1)
    opened = sound.replace("x\tx", '"x\tx', 1)
    last = sound[:-1] + '"x'
    lines = [opened, quoted, last, last, quoted, opened, opened, sound, quoted, last] * 30
    df = spark.createDataFrame(list(enumerate(lines)), "line_id long, line string").selectExpr("*", "'s' as slot", "'f' as feed").coalesce(1)
    got = {r["line_id"]: r["reason"] for r in read_feed(df)[1].collect()}
    assert got == {i: "quote" for i, x in enumerate(lines) if x in (opened, last)}


def test_empty(spark):
    df = spark.createDataFrame([], "line_id long, line string, slot string, feed string")
    sound, rejected = read_feed(df)
    assert sound.count() == rejected.count() == 0
