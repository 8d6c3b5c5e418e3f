"""Missing or wrong document language labels (problem 2).

A linear-chain conditional random field labels each word of a text with its language: hashed features of affixes, character
n-grams, script and a lexicon, with learned transitions. Forward-backward gives each word a probability per language, so
that mixed texts come apart into segments with a confidence each. It is trained here, from clean texts with their
languages and texts joined from two of them.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parallax.functions.lineage import shared_dir, spread
from parallax.functions.sampling import bounded_sample

#: Hash buckets of the features; training texts used at most; steps of training; words of a long text held at a time.
BUCKETS = 1 << 15
TRAINING_TEXTS = 2500
STEPS = 180
#: Goes up when the fitting changes: saved fields of another version are not used.
VERSION = 3
#: Words of a training sequence.
TRAINING_STRETCH = 60
STRETCH = 400
#: Words (or ideographs) a run needs to make a language of its own: fewer are a name or a borrowed word.
LEAST_WORDS, LEAST_SIGNS = 4, 6
#: Mean probability below which a run beside another is no language of its own.
SURE = 0.7
#: Mean probability that a label needs in the first field.
MOST = 0.6
WORD = re.compile("[\u3400-\u9fff\uf900-\ufaff]|(?:(?![\u3400-\u9fff\uf900-\ufaff])[^\\W\\d_][\u0300-\u036f\u064b-\u0655]*)+")
_IGNORED = re.compile("[\u00ad\u034f\u061c\u200b-\u200f\u202a-\u202e\u2060-\u2064\ufe00-\ufe0f\ufeff]")


def plain(text: str) -> str:
    """Compatibility-composed text of the same reading, without invisible characters."""
    return unicodedata.normalize("NFKC", _IGNORED.sub("", text))


def words_of(text: str) -> list[tuple[int, int]]:
    """Where the words of a plain text begin and end; each ideograph is a word."""
    return [m.span() for m in WORD.finditer(text)]


def _script(c: str) -> str:
    o = ord(c)
    return "g" if 0x370 <= o < 0x400 or 0x1F00 <= o < 0x2000 else "c" if 0x400 <= o < 0x530 else "a" if 0x600 <= o < 0x780 else "h" if o >= 0x2E80 else "l"


def features(word: str, lexicon: frozenset[str]) -> np.ndarray:
    """Buckets of a word's features."""
    w = word.lower()
    marked = f"^{w}$"
    names = ["b", "s" + _script(w[0]), "w" + w, "k1" if w in lexicon else "k0"]
    if word[:1].isupper():
        names.append("U" + _script(w[0]))
    for k in (1, 2, 3):
        names.append(f"p{w[:k]}")
    for k in (1, 2, 3, 4):
        names.append(f"e{w[-k:]}")
    for k in (2, 3):
        names += [f"n{marked[i : i + k]}" for i in range(len(marked) - k + 1)]
    names += [f"c{c}" for c in set(w) if ord(c) > 127]
    if w in lexicon:
        names.append("x" + w)
    return np.array(sorted({zlib.crc32(n.encode()) % BUCKETS for n in names}), np.int32)


def forward_backward(scores: np.ndarray, lengths: np.ndarray, moves: np.ndarray, start: np.ndarray, expected: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Probabilities per word, and the expected moves if asked for. scores: sequences x words x labels.

    Messages are scaled to sum to one at each word. Words past a sequence's length leave them as they are.
    """
    n, t, k = scores.shape
    emit = np.exp(scores - scores.max(2, keepdims=True)).astype(np.float64) + 1e-200
    step = np.exp(moves.astype(np.float64))
    ahead, back = np.empty((n, t, k)), np.ones((n, t, k)) / k
    ahead[:, 0] = emit[:, 0] * np.exp(start)
    ahead[:, 0] /= ahead[:, 0].sum(1, keepdims=True)
    for i in range(1, t):
        x = (ahead[:, i - 1] @ step) * emit[:, i]
        ahead[:, i] = np.where((i < lengths)[:, None], x / x.sum(1, keepdims=True), ahead[:, i - 1])
    pairs = np.zeros((k, k))
    for i in range(t - 2, -1, -1):
        on = (i + 1 < lengths)[:, None]
        heard = emit[:, i + 1] * back[:, i + 1]
        x = heard @ step.T
        back[:, i] = np.where(on, x / x.sum(1, keepdims=True), back[:, i])
        if expected:
            whole = (ahead[:, i] * x).sum(1, keepdims=True)
            pairs += step * (ahead[:, i].T @ np.where(on, heard / whole, 0))
    post = ahead * back
    return post / post.sum(2, keepdims=True), pairs


class LanguageField:
    """The trained field: weights per feature bucket, moves between languages, and the lexicon."""

    def __init__(self, codes: Sequence[str], weights: np.ndarray, moves: np.ndarray, start: np.ndarray, lexicon: frozenset[str]):
        self.codes, self.weights, self.moves, self.start, self.lexicon = list(codes), weights, moves, start, lexicon
        self._known: dict[str, np.ndarray] = {}

    def emission(self, word: str) -> np.ndarray:
        found = self._known.get(word)
        if found is None:
            found = self.weights[features(word, self.lexicon)].sum(0)
            if len(word) <= 64:  # longer ones hardly come again
                if len(self._known) > 100_000:
                    self._known.clear()
                self._known[word] = found
        return found

    def posteriors(self, texts: list[list[str]]) -> list[np.ndarray]:
        """Words x languages probabilities of each text; texts of like length are scored together, long ones alone."""
        done: dict[int, np.ndarray] = {i: self._long(words) for i, words in enumerate(texts) if len(words) > STRETCH}
        order = sorted((i for i, words in enumerate(texts) if 0 < len(words) <= STRETCH), key=lambda i: len(texts[i]))
        at = 0
        while at < len(order):
            t = len(texts[order[at]])
            group = [i for i in order[at : at + 512] if len(texts[i]) <= max(t + 4, t * 5 // 4)]
            scores = np.zeros((len(group), len(texts[group[-1]]), len(self.codes)), np.float64)
            for r, i in enumerate(group):
                scores[r, : len(texts[i])] = [self.emission(w) for w in texts[i]]
            lengths = np.array([len(texts[i]) for i in group])
            post, _ = forward_backward(scores, lengths, self.moves, self.start)
            for r, i in enumerate(group):
                done[i] = post[r, : lengths[r]]
            at += len(group)
        return [done.get(i, np.zeros((0, len(self.codes)))) for i in range(len(texts))]

    def _long(self, words: list[str]) -> np.ndarray:
        """Probabilities of one long text, a stretch at a time; the messages go on across the seams, so nothing depends on them.

        The forward messages at the seams are kept, the stretches are then taken backwards.
        """
        parts = [words[s : s + STRETCH] for s in range(0, len(words), STRETCH)]
        step = np.exp(self.moves.astype(np.float64))

        def ahead(part: list[str], message: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
            scores = np.array([self.emission(w) for w in part], np.float64)
            emit = np.exp(scores - scores.max(1, keepdims=True)) + 1e-200
            out = np.empty_like(emit)
            for i, e in enumerate(emit):
                x = e * (np.exp(self.start) if message is None else message @ step)
                message = out[i] = x / x.sum()
            return out, emit

        seams: list[np.ndarray | None] = [None]
        for part in parts:
            seams.append(ahead(part, seams[-1])[0][-1])
        back = np.ones(len(self.codes)) / len(self.codes)
        done = []
        for part, message in zip(reversed(parts), reversed(seams[:-1])):
            forward, emit = ahead(part, message)
            post = np.empty_like(forward)
            for i in range(len(part) - 1, -1, -1):
                post[i] = forward[i] * back
                back = (emit[i] * back) @ step.T
                back /= back.sum()
            done.append(post / post.sum(1, keepdims=True))
        return np.concatenate(done[::-1])

    def segments(self, text: str, spans: list[tuple[int, int]], post: np.ndarray) -> list[tuple[int, int, str, float]]:
        """(start, end, code, confidence) of the pieces of a plain text; runs too short for a language join a neighbour."""
        if not len(post):
            return []
        label = post.argmax(1)
        edges = [0, *(np.flatnonzero(np.diff(label)) + 1).tolist(), len(label)]
        runs = [[a, b, int(label[a])] for a, b in zip(edges, edges[1:])]

        def weak(run) -> bool:
            signs = sum(text[spans[i][0]] >= "㐀" for i in range(run[0], run[1]))
            return run[1] - run[0] - signs < LEAST_WORDS and signs < LEAST_SIGNS or post[run[0] : run[1], run[2]].mean() < SURE

        while len(runs) > 1 and any(map(weak, runs)):
            k = min((r for r in range(len(runs)) if weak(runs[r])), key=lambda r: (post[runs[r][0] : runs[r][1], runs[r][2]].sum(), r))
            a, b, _ = runs.pop(k)
            # to the neighbour that finds its words likelier
            sides = [s for s in (k - 1, k) if 0 <= s < len(runs)]
            to = max(sides, key=lambda s: (post[a:b, runs[s][2]].sum(), runs[s][1] - runs[s][0]))
            runs[to][0], runs[to][1] = min(runs[to][0], a), max(runs[to][1], b)
            merged = [runs[0]]
            for run in runs[1:]:
                if run[2] == merged[-1][2]:
                    merged[-1][1] = run[1]
                else:
                    merged.append(run)
            runs = merged
        return [(spans[a][0], spans[b - 1][1], self.codes[k], float(post[a:b, k].mean())) for a, b, k in runs]


def train(texts: Sequence[str], codes: Sequence[str], steps: int = STEPS, seed: int = 5, before: LanguageField | None = None) -> LanguageField:
    """Fit the field by adaptive gradients on the likelihood of clean texts and of texts joined from two languages.

    A field of the same languages may be given to go on from.
    """
    labels = sorted(set(codes))
    number = {c: i for i, c in enumerate(labels)}
    rng = np.random.default_rng(seed)
    rows = []
    for text, code in zip(texts, codes):
        clean = plain(text)
        words = [clean[a:b] for a, b in words_of(clean)]
        for at in range(0, len(words), TRAINING_STRETCH):  # long texts make several sequences
            part = words[at : at + TRAINING_STRETCH]
            rows.append((part, [number[code]] * len(part)))
    if len(rows) > 4 * TRAINING_TEXTS:
        rows = [rows[i] for i in sorted(rng.choice(len(rows), 4 * TRAINING_TEXTS, replace=False))]
    counts: dict[str, int] = {}
    for words, _ in rows:
        for w in {x.lower() for x in words}:
            counts[w] = counts.get(w, 0) + 1
    lexicon = frozenset(w for w, n in counts.items() if n > 1)
    joined = []
    for i in rng.integers(0, len(rows), (len(rows), 2)):
        (a, la), (b, lb) = rows[i[0]], rows[i[1]]
        joined.append((a + b, la + lb))
    rows = rows + joined
    vocabulary = sorted({w for words, _ in rows for w in words})
    place = {w: i for i, w in enumerate(vocabulary)}
    feats = [features(w, lexicon) for w in vocabulary]
    owner = np.repeat(np.arange(len(feats)), [len(f) for f in feats])
    bucket = np.concatenate(feats)
    k, t, n = len(labels), max(len(w) for w, _ in rows), len(rows)
    index = np.zeros((n, t), np.int64)
    gold = np.zeros((n, t), np.int64)
    lengths = np.array([len(w) for w, _ in rows])
    for r, (words, marks) in enumerate(rows):
        index[r, : len(words)] = [place[w] for w in words]
        gold[r, : len(words)] = marks
    on = np.arange(t)[None] < lengths[:, None]
    params = [np.zeros((BUCKETS, k), np.float32), np.zeros((k, k), np.float32), np.zeros(k, np.float32)]
    if before is not None and before.codes == labels:
        params = [before.weights.copy(), before.moves.copy(), before.start.copy()]
    state = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    used = np.unique(bucket)
    compact = np.searchsorted(used, bucket)
    first_of = np.searchsorted(owner, np.arange(len(feats) + 1))
    weights, squares = params[0][used], np.full((len(used), k), 1e-3, np.float32)
    # a step looks at a part of the sequences, each part in turn; what a part needs is laid out once
    parts = []
    for part in np.array_split(rng.permutation(n), max(1, n // 400)):
        longest = int(lengths[part].max())
        live = on[part, :longest]
        own_words, places = np.unique(index[part, :longest], return_inverse=True)
        rows_of = np.concatenate([np.arange(first_of[w], first_of[w + 1]) for w in own_words])
        sizes = first_of[own_words + 1] - first_of[own_words]
        touched, local = np.unique(compact[rows_of], return_inverse=True)
        order = np.argsort(local, kind="stable")
        marks = gold[part, :longest]
        moved = np.zeros((k, k))
        np.add.at(moved, (marks[:, :-1][live[:, 1:]], marks[:, 1:][live[:, 1:]]), 1)
        parts.append((part, live, marks, places.reshape(live.shape), touched, local, np.cumsum(sizes) - sizes, np.repeat(np.arange(len(own_words)), sizes)[order], np.searchsorted(local[order], np.arange(len(touched))), len(own_words), moved))
    for step in range(steps):
        part, live, marks, places, touched, local, starts, owners, cuts, count, moved = parts[step % len(parts)]
        own_weights = weights[touched]
        scores = np.add.reduceat(own_weights[local], starts, 0)[places]
        post, pairs = forward_backward(scores, lengths[part], params[1], params[2], expected=True)
        delta = post.copy()
        np.put_along_axis(delta, marks[:, :, None], np.take_along_axis(delta, marks[:, :, None], 2) - 1, 2)
        per_word = np.zeros((count, k))
        np.add.at(per_word, places[live], delta[live])
        grad = (np.add.reduceat(per_word[owners], cuts, 0) + 0.01 * own_weights).astype(np.float32)
        squares[touched] += grad * grad
        weights[touched] = own_weights - 0.25 * grad / np.sqrt(squares[touched])
        grad_m = pairs - moved + 0.02 * params[1]
        grad_s = post[:, 0].sum(0) - np.bincount(marks[:, 0], minlength=k) + 0.02 * params[2]
        for value, g, (m, v) in ((params[1], grad_m, state[1]), (params[2], grad_s, state[2])):
            m *= 0.9
            m += 0.1 * g
            v *= 0.99
            v += 0.01 * g * g
            value -= 0.05 * (m / (1 - 0.9 ** (step + 1))) / (np.sqrt(v / (1 - 0.99 ** (step + 1))) + 1e-6)
    params[0][used] = weights
    return LanguageField(labels, params[0].astype(np.float32), params[1], params[2], lexicon)


def _sample(df: DataFrame, text: str, code: str, limit: int) -> tuple[list[str], list[str]]:
    rows = df.select(F.col(f"`{text}`").alias("t"), F.col(f"`{code}`").alias("c")).filter("t is not null and c is not null")
    rows = bounded_sample(rows, "t", limit).collect()
    return [r["t"] for r in rows], [r["c"] for r in rows]


def saved_field(spark, texts: Sequence[str], codes: Sequence[str], make) -> LanguageField:
    """The field that `make` fits to labelled texts, from the shared folder if it was fitted to the same ones before.

    The name under which it is kept is a digest of the texts, their languages and what the fitting depends on, so another
    session with the same shared folder trains no more.
    """
    told = repr((BUCKETS, TRAINING_TEXTS, TRAINING_STRETCH, STEPS, MOST, VERSION, list(zip(texts, codes))))
    path = f"{shared_dir(spark)}/parallax-field-{hashlib.sha256(told.encode('utf-8', 'surrogatepass')).hexdigest()[:24]}"
    jvm = spark.sparkContext._jvm
    done = jvm.org.apache.hadoop.fs.Path(path + "/_SUCCESS")
    if done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
        r = spark.read.parquet(path).first()
        k = len(r["codes"])
        arrays = [np.frombuffer(r[c], np.float32).reshape(shape) for c, shape in (("weights", (BUCKETS, k)), ("moves", (k, k)), ("start", (k,)))]
        return LanguageField(r["codes"], *arrays, frozenset(r["lexicon"]))
    field = make()
    row = (field.codes, *[bytearray(x.astype(np.float32).tobytes()) for x in (field.weights, field.moves, field.start)], sorted(field.lexicon))
    spark.createDataFrame([row], "codes array<string>, weights binary, moves binary, start binary, lexicon array<string>").coalesce(1).write.mode("overwrite").parquet(path)
    return field


def train_from(samples: DataFrame, labelled: DataFrame | None = None, limit: int = TRAINING_TEXTS) -> LanguageField:
    """Train on clean samples (title, code), then on labelled texts (text, code) too, at most `limit` of each.

    The second training goes on from the first and takes those labelled texts only of which the first field gives their
    label's language most of the words: labels may be wrong, and texts in several languages. Texts are chosen by a hash of the
    text. Without such texts there is no second training. The field is kept in the shared folder.
    """
    texts, codes = _sample(samples, "title", "code", limit)
    extra, marks = _sample(labelled, "text", "code", limit) if labelled is not None else ([], [])

    def fit() -> LanguageField:
        field = train(texts, codes, STEPS // 3 if extra else STEPS)
        clean = [plain(x) for x in extra]
        spans = [words_of(x) for x in clean]
        posts = field.posteriors([[x[a:b] for a, b in s] for x, s in zip(clean, spans)])
        more, theirs = [], []
        for raw, p, mark in zip(extra, posts, marks):
            if mark not in field.codes or not len(p):
                continue
            # the label holds if the first field gives it most of the words: less than that is a text of two languages,
            # while a part that the clean samples know from another language only is to be learnt
            if p[:, field.codes.index(mark)].mean() >= MOST:
                more.append(raw)
                theirs.append(mark)
        return train([*texts, *more], [*codes, *theirs], STEPS * 2 // 3, before=field) if more else field

    return saved_field(samples.sparkSession, [*texts, *extra], [*codes, *marks], fit)


def language_segments(df: DataFrame, field: LanguageField, id_col: str = "evidence_id", text: str = "title", keep: Sequence[str] = ()) -> DataFrame:
    """(id_col, kept columns, segment, code, confidence, words, piece): the pieces of each text with their languages.

    segment counts from 1; confidence is the mean probability of the language over the piece's words. Runs of fewer than
    LEAST_WORDS words or LEAST_SIGNS ideographs join a neighbour. Null texts and texts without letters give no row; very
    long texts are labelled whole. Repeated rows are each given. An empty table gives an empty
    result.
    """
    rows = df.select(F.col(f"`{id_col}`").alias(id_col), *[F.col(f"`{c}`") for c in keep], F.col(f"`{text}`").alias("_text")).filter("_text is not null")
    added = [("segment", T.IntegerType()), ("code", T.StringType()), ("confidence", T.DoubleType()), ("words", T.IntegerType()), ("piece", T.StringType())]
    schema = T.StructType([*rows.drop("_text").schema, *[T.StructField(*x) for x in added]])

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for begin in range(0, whole.num_rows, 2000):
                batch = whole.slice(begin, 2000)
                texts = [plain(x) for x in batch.column(batch.num_columns - 1).to_pylist()]
                spans = [words_of(x) for x in texts]
                posts = field.posteriors([[x[a:b] for a, b in s] for x, s in zip(texts, spans)])
                at, number, codes, sure, sizes, pieces = [], [], [], [], [], []
                for r, (x, s, p) in enumerate(zip(texts, spans, posts)):
                    for k, (a, b, code, confidence) in enumerate(field.segments(x, s, p)):
                        at.append(r)
                        number.append(k + 1)
                        codes.append(code)
                        sure.append(confidence)
                        sizes.append(sum(a <= i and j <= b for i, j in s))
                        pieces.append(x[a:b])
                take = pa.array(at, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i).take(take) for i in range(batch.num_columns - 1)], pa.array(number, pa.int32()), pa.array(codes, pa.string()), pa.array(sure, pa.float64()), pa.array(sizes, pa.int32()), pa.array(pieces, pa.string())],
                    names=schema.fieldNames(),
                )

    return spread(rows).mapInArrow(label, schema)


def label_codes(codes: DataFrame) -> DataFrame:
    """(_known, _label_code): every way to write a language in the table of languages, lower-case."""
    ways = F.explode(F.array("gdelt_name", "code", "code3")).alias("label")
    return codes.select(ways, F.col("code").alias("_label_code")).filter("label is not null").select(F.lower(F.trim("label")).alias("_known"), "_label_code").distinct()


def train_on(df: DataFrame, samples: DataFrame, codes: DataFrame, text: str = "title", label: str = "language") -> LanguageField:
    """train_from on clean samples and on the texts of df whose label is known."""
    own = df.select(F.lower(F.trim(F.col(f"`{label}`"))).alias("_label"), F.col(f"`{text}`").alias("text"))
    return train_from(samples, own.join(F.broadcast(label_codes(codes)), F.col("_label") == F.col("_known")).select("text", F.col("_label_code").alias("code")))


def mislabelled(df: DataFrame, samples: DataFrame, codes: DataFrame, trusted: DataFrame | None = None, id_col: str = "evidence_id", text: str = "title", label: str = "language") -> DataFrame:
    """(id_col, code): rows whose label is missing or unknown, names a language their text isn't in, or whose text is in several.

    One row for each language of the text. codes is a short dimension. trusted holds texts and labels (in the same two
    columns) that are right more often than those of df, which serve where it is None. A repeated id is one document.
    """
    known = F.broadcast(label_codes(codes))
    own = df.withColumn("_label", F.lower(F.trim(F.col(f"`{label}`"))))
    field = train_on(df if trusted is None else trusted, samples, codes, text, label)
    rows = language_segments(own, field, id_col, text, ["_label"]).join(known, F.col("_label") == F.col("_known"), "left")
    per = rows.groupBy(id_col).agg(F.collect_set("code").alias("codes"), F.max("_label_code").alias("label_code"))  # as many as there are languages, at most
    wrong = F.col("label_code").isNull() | (F.size("codes") > 1) | ~F.array_contains("codes", F.col("label_code"))
    return per.filter(wrong).select(id_col, F.explode("codes").alias("code"))
