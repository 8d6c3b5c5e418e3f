"""Folding, scripts and words of headlines, as JVM expressions."""

from __future__ import annotations

import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# The shortest alias, in folded characters, that is specific enough per script.
ALIAS_FLOOR = {"latin": 4, "cyrillic": 4, "greek": 4, "arabic": 3, "cjk": 2, "other": 3}
#: Scripts whose words are matched as raw lower-case substrings.
RAW_SCRIPTS = ("arabic", "cjk")
# The blocks that count as each script, for letters only.
_SCRIPTS = {
    "cyrillic": r"[\x{0400}-\x{04FF}]+",
    "greek": r"[\x{0370}-\x{03FF}]+",
    "arabic": r"[\x{0600}-\x{06FF}]+",
    "cjk": r"[\x{3040}-\x{9FFF}\x{AC00}-\x{D7AF}]+",
    "latin": r"[\x{0000}-\x{024F}]+",
    "other": r"[^\x{0000}-\x{024F}\x{0370}-\x{04FF}\x{0600}-\x{06FF}\x{3040}-\x{9FFF}\x{AC00}-\x{D7AF}]+",
}


@cache
def _unaccent() -> tuple[str, str, dict[str, str]]:
    """From Unicode's data: characters that decompose to one base character, and to several."""
    single, several = {}, {}
    for i in range(0x80, 0xFFFE):
        c = chr(i)
        if 0xD800 <= i < 0xE000 or 0xAC00 <= i < 0xD7B0:  # surrogates; Korean syllables stay whole
            continue
        base = "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))
        if base != c and len(base) == 1:
            single[c] = base
        elif len(base) > 1 and unicodedata.category(c).startswith("L") and i < 0xFB50:
            several[c] = base
    return "".join(single), "".join(single.values()), several


def squeeze(c: Column) -> Column:
    """Words and digits of any script in lower case as they are, everything else as single spaces, none outside."""
    return F.trim(F.regexp_replace(F.regexp_replace(c, r"[^\p{L}\p{N}_]+", " "), " +", " "))


def normalise_title(c: Column) -> Column:
    """Lower case, punctuation to single spaces."""
    return squeeze(F.lower(c))


def fold(c: Column) -> Column:
    """Lower case without accents, compatibility forms resolved, punctuation to single spaces.

    Ligatures are resolved only where a text has one; Korean syllables are kept whole.
    """
    source, target, several = _unaccent()
    low = F.lower(c)
    ligatures = low
    for a, b in (("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ŉ", "ʼn"), ("ĳ", "ij"), ("…", " ")):
        ligatures = F.replace(ligatures, F.lit(a), F.lit(several.get(a, b)))
    low = F.when(low.rlike("[ﬀ-ﬄŉĳ…]"), ligatures).otherwise(low)
    return squeeze(F.regexp_replace(F.translate(low, source, target), r"\p{M}+", ""))


def script_of(c: Column) -> Column:
    """The script of most letters; of equals the one seen first; 'other' without letters.

    Text without characters past the Latin blocks is told at once; of others the letters are taken out once.
    """

    def count(letters: Column) -> Column:
        seen = []
        for name, p in _SCRIPTS.items():
            n = F.length(letters) - F.length(F.regexp_replace(letters, p, ""))
            seen.append(F.struct(n.alias("n"), (-F.regexp_instr(letters, F.lit(p))).alias("at"), F.lit(name).alias("name")))
        best = F.array_max(F.array(*seen))
        return F.when(best["n"] > 0, best["name"]).otherwise("other")

    mixed = F.element_at(F.transform(F.array(F.regexp_replace(c, r"\P{L}+", "")), count), 1)
    return F.when(~c.rlike(r"[^\x{0000}-\x{024F}]"), F.when(c.rlike(r"\p{L}"), "latin").otherwise("other")).otherwise(mixed)


def usable_alias(alias: Column) -> Column:
    """Whether an alias is specific enough: long enough when folded, and no ASCII code."""
    script = script_of(alias)
    floor = F.lit(3)
    for name, n in ALIAS_FLOOR.items():
        floor = F.when(script == name, n).otherwise(floor)
    code = F.trim(alias).rlike(r"^[A-Z0-9][A-Z0-9._/-]*$")
    return (F.length(F.trim(alias)) > 0) & (F.length(fold(F.trim(alias))) >= floor) & ~code
