"""Per-document text quality statistics (problem 10).

Statistics of every document come from one pass over its whole text. Gradient-boosted trees on these statistics tell running
prose from lists, tables and junk. They are trained on documents that several weak sources label (page structure, function
words, the rhythm of sentences, marks and digits, repeats, damaged characters), each of which may abstain; where they
disagree, a document has no label. The training set is a bounded sample of SAMPLE documents; scores are calibrated on
hand-checked documents (quality_holdout), which the trees never see.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parallax.functions.lineage import cut, spread
from parallax.functions.sampling import bounded_sample
from parallax.llm.quality_holdout import marked

#: Documents that the trees are trained on, at most; the sample is the same in every run.
SAMPLE = 4000
#: Frequent function words by language; for Chinese, characters.
COMMON = frozenset(
    """
    the of and to a in is that it for on was with as at by be this are from or not have has but they were will their said who
    der die das und zu in den von mit ist nicht für auf ein eine im dem des sich auch als wegen während bei am vor nach zum
    le la les des et de du un une en dans pour que qui sur ne pas au aux plus avec est par ont ce près
    el los las y del que por con se una para su al como no más es lo han cerca tras este
    il i gli e di che per con non è un una nel del della dei alla sono hanno le vicino
    o os as e do da dos das em no na que por com não uma ao mais são pelo perto
    de het een en van voor op met dat te niet is zijn aan om bij in der ook na over
    w i na z do nie się że o od za po przy przed przez jak oraz są jest dla
    ve bir bu için ile da de daha çok gibi olarak sonra kadar ama en yeni
    и в не на что с по за из к о от для это как у до при же его
    і й у в не на що з за до та про від для це як після під
    και το η ο της του την των να για με σε στο στη από που δεν θα τα οι
    في من على إلى أن لا ما هذا التي الذي مع عن بعد قبل خلال كان بعض
    的 了 在 是 不 和 与 为 对 这 就 被 将 还 要 已 从 把 说 因 但 并 有 到 认
    """.split()
)
WORD = re.compile(r"[^\W\d_㐀-鿿]+|[㐀-鿿]")
#: The end of a sentence, with closing quotes.
END = re.compile(r"[.!?…؟]+[\"'»”’)\]]*(?=\s|$)|[。！？]+[\"'」』”’）]*")
#: Where a stretch of text ends, whatever kind of text it is.
STOPS = str.maketrans({c: "\n" for c in ".!?…؟。！？;；"})
#: A list item's marker; what stands between the cells of a table's line; characters that a wrong decoding leaves; ideographs.
ITEM = re.compile(r"\(?\w{1,3}[).:]\s|[-–—•*·>]\s")
CELL = re.compile(r"[\t|;；]|</?t[dr]>|,(?=\S)| {3,}|\S=\S")
DAMAGE = re.compile("[ÃÂ][\x80-\xbf]|ï¿½|â[‚€]|\ufffd")
SIGN = re.compile("[㐀-鿿]")
CLOSERS, ENDS = "\"'»”’)]」』）", ".!?…؟。！？"
STATISTICS = (
    "n_chars", "n_words", "mean_word_length", "max_word_length", "letter_ratio", "digit_ratio", "symbol_ratio", "space_ratio", "upper_ratio", "n_lines", "mean_line_length",
    "short_line_share", "punctuated_line_share", "repeated_line_share", "item_line_share", "cell_line_share", "ragged_line_share", "common_word_share", "distinct_word_share",
    "ideograph_share", "sentence_end_rate", "common_word_gap", "stretch_words", "long_stretch_share", "damage_ratio",
)


def _classes() -> np.ndarray:
    """Kind of each code point of the first plane: 0 other, 1 letter, 2 upper-case letter, 3 digit, 4 space, 5 symbol."""
    table = np.zeros(65536, np.uint8)
    for i in range(65536):
        c = chr(i)
        table[i] = 2 if c.isupper() else 1 if c.isalpha() else 3 if c.isdigit() else 4 if c.isspace() else 0 if 0xD800 <= i < 0xE000 else 5
    return table


def statistics(text: str, table: np.ndarray) -> list[float]:
    """The numbers of STATISTICS for a text.

    item lines begin with a list marker (two at least), cell lines hold two separators of cells, ragged lines are short
    and don't end like a sentence. A stretch lies between stops of any kind; stretch_words is the length of the one that
    a word is in, on average, and common_word_gap the like distance between common words. Two ideographs count as a word
    of a stretch.
    """
    n = len(text)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    kinds = np.bincount(table[np.minimum(points, 65535)], minlength=6) / max(1, n)
    lines = [x for x in map(str.strip, text.split("\n")) if x]
    short = punctuated = items = cells = ragged = chars = 0
    for x in lines:
        chars += len(x)
        tail = x.rstrip(CLOSERS)[-1:]
        ends = tail != "" and tail in ENDS
        brief = len(x) < 45 and (len(x) < 18 or tail < "㐀")
        short += brief
        punctuated += ends
        ragged += brief and not ends
        items += ITEM.match(x) is not None
        cells += len(CELL.findall(x)) >= 2
    words = WORD.findall(text.lower())
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    common = np.flatnonzero(np.fromiter(map(COMMON.__contains__, words), bool, len(words)))
    gaps = np.diff(common, prepend=-1, append=len(words)).astype(float)
    stretches = np.array([x.count(" ") + 1 if x[-1] < "㐀" else len(x) // 2 for x in map(str.strip, text.translate(STOPS).split("\n")) if x], float)
    plain = text.isascii()
    k, w, s = max(1, len(lines)), max(1, len(words)), max(1.0, stretches.sum())
    return [
        n, len(words), lengths.sum() / w, lengths.max(initial=0), kinds[1] + kinds[2], kinds[3], kinds[5], kinds[4], kinds[2], len(lines), chars / k,
        short / k, punctuated / k, 1 - len(set(lines)) / k if lines else 0.0, (items if items > 1 else 0) / k, cells / k, ragged / k, len(common) / w, len(set(words)) / w,
        0.0 if plain else len(SIGN.findall(text)) / w, len(END.findall(text)) / w, (gaps**2).sum() / max(1.0, gaps.sum()), (stretches**2).sum() / s, stretches[stretches >= 7].sum() / s,
        0.0 if plain else len(DAMAGE.findall(text)) / max(1, n),
    ]


def text_statistics(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, and a double per name of STATISTICS) for every document with a text; whole texts are read.

    A null text gives no row; an empty one gives zeros. Repeated rows give repeated rows. Texts may be of any length;
    a text is held by one task at a time.
    """
    rows = df.filter(F.col(f"`{text}`").isNotNull()).select(F.col(f"`{id_col}`").alias(id_col), F.col(f"`{text}`").alias("_text"))
    schema = T.StructType([rows.schema[0], *[T.StructField(c, T.DoubleType()) for c in STATISTICS]])

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _classes()
        for batch in batches:
            found = np.array([statistics(x, table) for x in batch.column(1).to_pylist()], np.float64).reshape(-1, len(STATISTICS))
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(found[:, i]) for i in range(len(STATISTICS))]], names=[id_col, *STATISTICS])

    return spread(rows).mapInArrow(measure, schema)


class BoostedTrees:
    """Gradient-boosted regression trees for a yes-no label under logistic loss, on binned features."""

    def __init__(self, trees: int = 60, depth: int = 3, rate: float = 0.2, bins: int = 64, least: int = 8, ridge: float = 1.0):
        self.trees, self.depth, self.rate, self.bins, self.least, self.ridge = trees, depth, rate, bins, least, ridge
        self.base, self.nodes = 0.0, []

    def fit(self, x: np.ndarray, y: np.ndarray) -> BoostedTrees:
        cuts = []
        for f in x.T:
            values = np.unique(f)
            middle = (values[1:] + values[:-1]) / 2
            half = self.bins // 2
            even = np.linspace(f.min(), f.max(), half + 2)[1:-1]  # quantiles alone leave gaps between two modes
            cuts.append(middle if len(middle) <= self.bins else np.union1d(np.quantile(middle, np.linspace(0, 1, half)), even))
        codes = np.stack([np.searchsorted(c, f, side="left") for c, f in zip(cuts, x.T)], 1)
        share = np.clip(y.mean(), 0.01, 0.99)
        self.base = float(np.log(share / (1 - share)))
        score = np.full(len(y), self.base)
        for _ in range(self.trees):
            p = 1 / (1 + np.exp(-np.clip(score, -30, 30)))
            tree: list[tuple] = []
            at = np.zeros(len(y), np.int64)
            self._grow(codes, cuts, y - p, p * (1 - p), np.arange(len(y)), self.depth, tree, at)
            score += np.array([n[3] for n in tree])[at]
            self.nodes.append(tree)
        return self

    def _grow(self, codes, cuts, g, h, rows, depth, tree, at) -> int:
        here = len(tree)
        tree.append((-1, 0.0, (0, 0), self.rate * g[rows].sum() / (h[rows].sum() + self.ridge)))
        at[rows] = here
        if depth == 0 or len(rows) < 2 * self.least:
            return here
        total_g, total_h = g[rows].sum(), h[rows].sum()
        best, chosen = 1e-6, None
        for f, c in enumerate(cuts):
            if not len(c):
                continue
            size = len(c) + 1
            code = codes[rows, f]
            left_g, left_h, left_n = (np.cumsum(np.bincount(code, w, size))[:-1] for w in (g[rows], h[rows], None))
            gain = left_g**2 / (left_h + self.ridge) + (total_g - left_g) ** 2 / (total_h - left_h + self.ridge) - total_g**2 / (total_h + self.ridge)
            gain[(left_n < self.least) | (len(rows) - left_n < self.least)] = 0
            k = int(gain.argmax())
            if gain[k] > best:
                best, chosen = gain[k], (f, k)
        if chosen:
            f, k = chosen
            go = codes[rows, f] <= k
            low = self._grow(codes, cuts, g, h, rows[go], depth - 1, tree, at)
            high = self._grow(codes, cuts, g, h, rows[~go], depth - 1, tree, at)
            tree[here] = (f, float(cuts[f][k]), (low, high), tree[here][3])
        return here

    def score(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base)
        for tree in self.nodes:
            stack = [(0, np.arange(len(x)))]
            while stack:
                node, rows = stack.pop()
                f, value, (low, high), leaf = tree[node]
                if f < 0:
                    out[rows] += leaf
                else:
                    go = x[rows, f] <= value
                    stack += [(low, rows[go]), (high, rows[~go])]
        return out


def weak_votes(x: np.ndarray) -> np.ndarray:
    """What each weak source says of each document: 1 junk, -1 prose, 0 nothing. Sources know nothing of each other."""
    col = {c: x[:, i] for i, c in enumerate(STATISTICS)}
    signs = col["ideograph_share"] > 0.5
    structure = np.maximum(np.maximum(col["item_line_share"], col["cell_line_share"]), col["ragged_line_share"])
    common, rhythm, marks = col["common_word_share"], col["sentence_end_rate"], col["digit_ratio"] + col["symbol_ratio"]
    never = np.zeros(len(x), bool)
    told = [
        (structure > 0.5, structure < 0.15),
        (common < np.where(signs, 0.07, 0.13), common > np.where(signs, 0.12, 0.24)),
        (rhythm < np.where(signs, 0.008, 0.012), (rhythm > np.where(signs, 0.018, 0.025)) & (rhythm < np.where(signs, 0.1, 0.16))),
        (marks > 0.12, marks < 0.06),
        (col["long_stretch_share"] < 0.4, (col["long_stretch_share"] > 0.8) & (col["stretch_words"] < 45)),
        (col["repeated_line_share"] > 0.4, never),
        (col["n_words"] < 5, never),
    ]
    return np.stack([*[np.where(junk, 1, np.where(prose, -1, 0)) for junk, prose in told], np.where(col["damage_ratio"] > 0.01, 3, 0)], 1)


def weak_label(x: np.ndarray) -> np.ndarray:
    """1 for structural junk, 0 for prose, -1 where the sources don't agree by two votes."""
    votes = weak_votes(x).sum(1)
    return np.where(votes >= 2, 1, np.where(votes <= -2, 0, -1))


def marked_statistics(part: str) -> tuple[np.ndarray, np.ndarray]:
    """(statistics, marks) of the hand-checked documents of a part."""
    table = _classes()
    texts, marks = marked(part)
    return np.array([statistics(t, table) for t in texts], np.float64), np.array(marks)


def train(x: np.ndarray) -> tuple[BoostedTrees, float, float]:
    """Trees from weakly labelled statistics, and the slope and offset that calibrate them on hand-checked documents.

    The base documents join whatever is given, so that both classes occur however few the documents are.
    """
    x = np.concatenate([marked_statistics("base")[0], x])
    y = weak_label(x)
    model = BoostedTrees().fit(x[y >= 0], y[y >= 0].astype(float))
    held, truth = marked_statistics("calibration")
    score = model.score(held)
    # Platt scaling with its softened targets
    goal = np.where(truth == 1, (truth.sum() + 1) / (truth.sum() + 2), 1 / (len(truth) - truth.sum() + 2))
    at = np.array([1.0, 0.0])
    design = np.stack([score, np.ones(len(score))], 1)

    def loss(w: np.ndarray) -> float:  # with a prior of slope 1 and offset 0, which keeps separable scores finite
        z = design @ w
        return float((np.logaddexp(0, z) - goal * z).sum() + ((w - [1, 0]) ** 2).sum() / 2)

    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ at, -30, 30)))
        gradient = design.T @ (p - goal) + at - [1, 0]
        step = np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + np.eye(2), gradient)
        while loss(at - step) > loss(at) and np.abs(step).max() > 1e-9:
            step = step / 2
        at = at - step
    a, b = at
    return model, float(a), float(b)


def text_quality(df: DataFrame, id_col: str = "doc_id", text: str = "text", sample: int = SAMPLE) -> DataFrame:
    """text_statistics with junk_probability: how likely most of the text is a list, a table or junk.

    The trees see the statistics of at most `sample` documents, chosen by a hash of the id, and of the base documents; every
    document is scored. Empty tables give an empty result.
    """
    stats = cut(text_statistics(df, id_col, text), "statistics")
    drawn = bounded_sample(stats, id_col, sample).select(*STATISTICS).toPandas()
    model, a, b = train(drawn.to_numpy(np.float64).reshape(-1, len(STATISTICS)))

    @F.pandas_udf("double")
    def probability(x: pd.DataFrame) -> pd.Series:
        return pd.Series(1 / (1 + np.exp(-np.clip(a * model.score(x.to_numpy(np.float64)) + b, -500, 500))))

    return stats.withColumn("junk_probability", probability(F.struct(*STATISTICS)))


def structural_documents(df: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id) of the documents that are for their larger part no running prose; an empty text is none of either."""
    return text_quality(df, id_col, text).filter("junk_probability > 0.5 and n_chars > 0").select(id_col)
