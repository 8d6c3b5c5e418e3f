"""Visually identical text with different characters (problem 6).

Text is brought to one form by deletion of ignorable characters and compatibility composition; then, where letters of
several look-alike scripts meet, a search over the look-alike lattice gives each word the letters of its own script. Viterbi
runs twice: over the characters of a word, with n-gram scores of the script that the word would be in, and over the words
of the text, which rarely change script from one to the next.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache, reduce
from math import log

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Letters that look alike, Latin first, then Cyrillic, Greek and Armenian.
ALIKE = (
    "aаα bЬ cсϲ dԁ eеε gɡց hһհ iіι jјϳ kкκ lӏ mм nпηո oоοօ pрρ qԛզ rг sѕ tтτ uυս vνѵ wԝω xхχ yуγ "
    "AАΑ BВΒ CС EЕΕ HНΗ IІΙ JЈ KКΚ MМΜ NΝ OОΟ PРΡ QԚ SЅ TТΤ VѴ WԜ XХΧ YУΥ ZΖ "
    "áά éέ íί óό úύ ëё ïї ÁΆ ÉΈ ÍΊ ÓΌ ËЁ ÏЇ"
)
#: Letters of scripts other than Latin that words of today hardly have; they are replaced, never put in.
RARE = "ӏԛԝԁѵɡϲϳ"
SCRIPTS = "lcga"
#: Costs of a replaced letter, of a change of script between words, and of a word that isn't known.
SWAP, CHANGE, UNKNOWN = 2.0, 3.0, 4.0
IGNORABLE = re.compile("[\u00ad\u034f\u061c\u115f\u1160\u17b4\u17b5\u180b-\u180f\u200b-\u200f\u202a-\u202e\u2060-\u206f\u3164\ufe00-\ufe0f\ufeff\uffa0\U000e0000-\U000e0fff]")
WORD = re.compile(r"[^\W\d_]+")


@lru_cache(1 << 17)
def script_of(c: str) -> str:
    """l, c, g or a for the scripts that look alike, else empty."""
    o = ord(c)
    if 0x530 <= o < 0x590:
        return "a" if c.isalpha() else ""
    if o < 0x250:
        return "l" if c.isalpha() else ""
    if 0x370 <= o < 0x400 or 0x1F00 <= o < 0x2000:
        return "g"
    if 0x400 <= o < 0x530:
        return "c"
    return "l" if 0x1E00 <= o < 0x1F00 or o in (0x261, 0x3F2, 0x3F3) else ""


def _lattice() -> dict[tuple[str, str], str]:
    """(letter, script) to the letters of that script that look like it."""
    out: dict[tuple[str, str], str] = {}
    for group in ALIKE.split():
        for a in group:
            for b in group:
                if a != b and b not in RARE and script_of(a) != script_of(b):
                    out[a, script_of(b)] = out.get((a, script_of(b)), "") + b
    return out


LATTICE = _lattice()


def _unsure() -> dict[str, frozenset[str]]:
    """Pairs of scripts to the letters of the first, in lower case, that a word may write with letters of the second."""
    out: dict[str, set[str]] = {}
    for c in {a for a, _ in LATTICE}:
        for t in SCRIPTS:
            if t != script_of(c) and ((c, t) in LATTICE or any((d, t) in LATTICE for u in SCRIPTS for d in LATTICE.get((c, u), ""))):
                out.setdefault(script_of(c) + t, set()).add(c.lower())
    return {k: frozenset(v) for k, v in out.items()}


UNSURE = _unsure()


@lru_cache(1 << 16)
def unsure(word: str) -> bool:
    """Whether a word in lower case may look like one of another script: only then does it matter if it is known."""
    return any(k[0] == script_of(word[0]) and letters.issuperset(word) for k, letters in UNSURE.items())


def compatible(text: str) -> str:
    """Compatibility composition without ignorable characters."""
    if text.isascii():
        return text
    return unicodedata.normalize("NFKC", IGNORABLE.sub("", unicodedata.normalize("NFKC", IGNORABLE.sub("", text))))


def words_of(text: str) -> list[str]:
    """The words that are in one of the look-alike scripts."""
    return _words_of(compatible(text))[0]


def _words_of(text: str) -> tuple[list[str], bool]:
    """The words of a compatible text that are in one look-alike script, and whether all its letters are in one and the same."""
    words = WORD.findall(text)
    if text.isascii():
        return words, bool(words)
    scripts = {script_of(c) for c in set(text) if c.isalpha()}
    if len(scripts) == 1 and "" not in scripts:
        return words, True
    return [w for w in words if len({script_of(c) for c in set(w)}) == 1 and script_of(w[0])], len(scripts - {""}) == 1


def evidence_of(text: str) -> list[str]:
    """The words whose script a text vouches for.

    A word that may be a disguise counts where the whole text is in its script and another word is surely in it: else a
    disguise that a large corpus repeats would become a known word.
    """
    words, one = _words_of(compatible(text))
    sure = [w for w in words if not unsure(w.lower())]
    return words if sure and one else sure


def grams_of(word: str) -> Iterator[str]:
    """The n-grams of a word in lower case, and those that they are a share of."""
    marked = f"^{word}$"
    for i in range(1, len(marked)):
        for k in (1, 2):
            gram = marked[max(0, i - k) : i + 1]
            yield gram
            yield gram[:-1] + "*"


class Scripts:
    """Character n-grams and known words of each script."""

    def __init__(self, texts: Iterable[str], least: int = 1):
        counts: dict[str, int] = {}
        for text in texts:
            for w in words_of(text):
                counts[w] = counts.get(w, 0) + 1
        self.grams: dict[str, float] = {}
        self.known: set[str] = set()
        self.alphabet: dict[str, int] = {}
        for w, n in counts.items():
            if n < least:
                continue
            self.known.add(w.lower())
            for gram in grams_of(w.lower()):
                self.grams[gram] = self.grams.get(gram, 0) + 1
        self._cost: dict[tuple[str, str], tuple[float, str]] = {}

    def step(self, before: str, c: str) -> float:
        """Cost of a character after the two before it, in lower case."""
        two = (self.grams.get(before + c, 0) + 0.05) / (self.grams.get(before + "*", 0) + 2.5)
        one = (self.grams.get(before[-1] + c, 0) + 0.05) / (self.grams.get(before[-1] + "*", 0) + 2.5)
        return -log(0.6 * two + 0.4 * one)

    def spell(self, word: str, script: str) -> tuple[float, str] | None:
        """The cheapest spelling of a word in one script, or None if a letter has no likeness there."""
        found = self._cost.get((word, script))
        if found is None and (word, script) not in self._cost:
            found = self._spell(word, script)
            if len(self._cost) > 50_000:
                self._cost.clear()
            self._cost[word, script] = found
        return found

    def _spell(self, word: str, script: str) -> tuple[float, str] | None:
        paths: dict[str, tuple[float, str]] = {"^": (0.0, "")}
        for c in word:
            own = script_of(c)
            options = c if own in (script, "") else LATTICE.get((c, script), "")
            nxt: dict[str, tuple[float, str]] = {}
            for before, (cost, spelt) in paths.items():
                for o in options:
                    low = o.lower()[:1]
                    total = cost + self.step(before, low) + (SWAP if o != c else 0)
                    key = (before + low)[-2:]
                    if key not in nxt or total < nxt[key][0]:
                        nxt[key] = (total, spelt + o)
            paths = nxt
            if not paths:
                return None
        cost, spelt = min((cost + self.step(before, "$"), spelt) for before, (cost, spelt) in paths.items())
        return cost + (0 if spelt.lower() in self.known else UNKNOWN), spelt

    def canonical(self, text: str) -> str:
        """The form in which text that looks the same is the same."""
        text = compatible(text)
        if text.isascii():
            return text
        words = list(WORD.finditer(text))
        scripts = {script_of(c) for c in set(text) if c.isalpha()} - {""}
        if len(scripts) < 2:
            return self._disguised(text, words, scripts)
        # over the words: the state is the script of the last word that is in one of these scripts
        cost: dict[str, float] = {"": 0.0}
        steps: list[dict[str, tuple[str, str]]] = []  # state to the state before and the word's form
        for m in words:
            w = m[0]
            own = {script_of(c) for c in set(w)} - {""}
            spelt = {s: f for s in SCRIPTS if s in scripts and (f := self.spell(w, s))} if own else {}
            if not spelt:  # another script, or no likeness: as it is
                steps.append({s: (s, w) for s in cost})
                continue
            nxt: dict[str, float] = {}
            via: dict[str, tuple[str, str]] = {}
            for s, (own_cost, form) in spelt.items():
                for before, so_far in cost.items():
                    total = so_far + own_cost + (CHANGE if before and before != s else 0)
                    if s not in nxt or total < nxt[s]:
                        nxt[s], via[s] = total, (before, form)
            cost = nxt
            steps.append(via)
        state = min(cost, key=cost.__getitem__)
        forms = []
        for via in reversed(steps):
            state, form = via[state]
            forms.append(form)
        forms.reverse()
        out, at = [], 0
        for m, form in zip(words, forms):
            out += [text[at : m.start()], form]
            at = m.end()
        return unicodedata.normalize("NFC", "".join([*out, text[at:]]))


    def _disguised(self, text: str, words: list[re.Match], scripts: set[str]) -> str:
        """A text of one script in the letters of another, if that is what all of its words are.

        No word may be known as it stands, or have a letter that looks like none of the other script; in the other script
        each has to be a known word.
        """
        low = {w[0].lower() for w in words}
        if not scripts or any(w in self.known or not unsure(w) for w in low):
            return text
        for t in SCRIPTS:
            if t not in scripts:
                forms = [f[1] if (f := self.spell(w[0], t)) else "" for w in words]
                if all(f.lower() in self.known for f in forms):
                    out, at = [], 0
                    for m, form in zip(words, forms):
                        out += [text[at : m.start()], form]
                        at = m.end()
                    return unicodedata.normalize("NFC", "".join([*out, text[at:]]))
        return text


def word_counts(texts: DataFrame, of: Callable[[str], list[str]] = words_of) -> DataFrame:
    """(word, n): how often each word that `of` gives of a text occurs in all rows of the first column."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = Counter(w for text in batch.column(0).to_pylist() if text for w in of(text))
            yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])

    return texts.select(F.col(f"`{texts.columns[0]}`").alias("text")).mapInArrow(count, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def script_facts(words: DataFrame) -> DataFrame:
    """(known, item, n) of words: their n-grams with the number of words that have them, and the unsure words themselves."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts: Counter[tuple[bool, str]] = Counter()
            for w in batch.column(0).to_pylist():
                counts.update((False, gram) for gram in grams_of(w.lower()))
                if unsure(w.lower()):
                    counts[True, w.lower()] += 1
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in counts], pa.bool_()), pa.array([x for _, x in counts], pa.string()), pa.array(list(counts.values()), pa.int64())], names=["known", "item", "n"])

    return words.select("word").mapInArrow(count, "known boolean, item string, n bigint").groupBy("known", "item").agg(F.sum("n").alias("n"))


def train_scripts(samples: Sequence[DataFrame], corpus: DataFrame | None = None, least: int = 3) -> Scripts:
    """Count n-grams and known words on clean samples and on all texts of a corpus (one text column each).

    Of the corpus only words that it has at least `least` times, and whose script the texts vouch for, count. Both are
    counted where the texts are. The driver gets the n-grams, bounded by the alphabets, and the words whose letters all look like those of
    another script; whether other words are known changes no spelling.
    """
    scripts = Scripts(())
    clean = [word_counts(df) for df in samples]
    counted = [reduce(DataFrame.unionByName, clean).select("word").distinct()] if clean else []
    if corpus is not None:
        counted.append(word_counts(corpus, evidence_of).filter(F.col("n") >= least))
    for words in counted:
        for known, item, n in script_facts(words).collect():
            if known:
                scripts.known.add(item)
            else:
                scripts.grams[item] = scripts.grams.get(item, 0) + n
    return scripts


def canonical_forms(df: DataFrame, scripts: Scripts, id_col: str = "evidence_id", text: str = "title", spellings: str | None = "wrote") -> DataFrame:
    """(id_col, field, key, text, canonical): each text and each spelling with its one form.

    field is the column; key is the key of a spelling in its map, null for a text. Null texts, null maps and null
    spellings give no row; empty texts stay empty. Texts may be of any length; repeated rows are each given. An empty table
    gives an empty result. Other columns are ignored.
    """
    own = df.select(F.col(f"`{id_col}`").alias(id_col), F.lit(text).alias("field"), F.lit(None).cast("string").alias("key"), F.col(f"`{text}`").alias("text"))
    if spellings:
        own = own.unionByName(df.select(F.col(f"`{id_col}`").alias(id_col), F.lit(spellings).alias("field"), F.explode(F.col(f"`{spellings}`")).alias("key", "text")))
    own = own.filter(F.col("text").isNotNull())
    schema = T.StructType([*own.schema, T.StructField("canonical", T.StringType())])

    def canonise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms = [scripts.canonical(x) for x in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(forms, pa.string())], names=[*batch.schema.names, "canonical"])

    return own.mapInArrow(canonise, schema)


def disguised(df: DataFrame, scripts: Scripts, id_col: str = "evidence_id", text: str = "title", spellings: str | None = "wrote") -> DataFrame:
    """(id_col, field) of the texts, and of the maps with a spelling, whose one form differs from what is written."""
    return canonical_forms(df, scripts, id_col, text, spellings).filter("text <> canonical").select(id_col, "field").distinct()
