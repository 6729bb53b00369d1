"""Toxicity scores by a string-kernel support vector machine.

The kernel of two words counts their common subsequences of three to five letters
with at most one letter skipped (three: none), a skip costing ``SKIP``; a word's
start and end count as letters, and a subsequence counts the less the more words
of other texts hold it. Words are split at white space only, after signs
inside them are dropped and digits that stand for letters are read as such, and
runs of single letters are joined, so that ``i.d.i-o_t`` and ``i d i o t`` meet
``idiot``, and a letter put in or left out costs only the subsequences it touches.

Fitting, on a bounded sample of ``SAMPLE_ROWS`` labelled texts (all, if fewer):
Spark counts in how many toxic and other texts each word stands; the words with
the strongest and most frequent ties to toxic texts, and the commonest words,
become Nyström landmarks; a linear support vector machine with squared hinge loss
is fitted on the landmark features of all words of the sample, row block by row block, and of
spellings of the landmarks with one letter put in. A text's score is a logistic
function of its largest word margins, fitted on margins from models of the other
half of the sample. The machines of the two halves and of the whole are fitted by a task
each, from the counted words; only their weights come to the driver.

Scoring: landmarks, Nyström map and support vector machine are all linear in the
subsequence counts, so they fold into one weight per subsequence (hashed to
``2**BITS`` places). A whole text is scored by array lookups, letter by letter.

Cases: a null or empty text, or one without letters, has no margins and gets the
score of none; repeated labels of one id count once, the higher one; without
labelled texts of both kinds every score is the share of toxic texts (0 if none).
"""

from __future__ import annotations

import gc
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Labelled texts that the model is fitted on, at most (in expectation: ids are drawn by hash).
SAMPLE_ROWS = 3_000
#: Text bytes whose letters are laid out in arrays at once (some eighty bytes a letter).
SLICE_BYTES = 1 << 19
LANDMARKS = 192
COMMON_LANDMARKS = 48
SKIP = 0.7
BITS = 20
COST = 0.5
#: Weight of a landmark's spellings with one letter put in, as a share of the landmark's.
PUT_IN = 0.1
FEATURES = 3
#: How fast a subsequence loses weight with the number of words that hold it.
COMMONNESS = 0.25
#: Normalisation stops growing at words of this many letters.
NORM_LETTERS = 24

# Digits that stand for letters.
_DIGITS = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t"}

_SPACE, _DROPPED = 0, 1


def _symbol_table() -> np.ndarray:
    """Symbol of each code point: white space 0, dropped signs 1, letters their own code."""
    table = np.full(65536, _DROPPED, np.uint32)
    for code in range(65535):
        c = chr(code)
        if c.isspace():
            table[code] = _SPACE
        elif c.isalpha():
            table[code] = code
        elif c in _DIGITS:
            table[code] = ord(_DIGITS[c])
    table[65535] = 65535  # every letter beyond the basic plane
    return table


_TABLE = _symbol_table()
#: Offsets of the letters of a subsequence from its first one.
_SHAPES = [
    (1, 2),
    (1, 2, 3), (1, 2, 4), (1, 3, 4), (2, 3, 4),
    (1, 2, 3, 4), (1, 2, 3, 5), (1, 2, 4, 5), (1, 3, 4, 5), (2, 3, 4, 5),
]
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F, 0x165667B1], np.uint32)


@dataclass
class Words:
    """Words of some texts: symbols with one space around each word."""

    symbols: np.ndarray
    starts: np.ndarray  # of the space before each word
    text: np.ndarray  # index of each word's text


def words_of(texts: list[str]) -> Words:
    low = [t.lower() for t in texts]
    codes = np.frombuffer(" ".join(low).encode("utf-32-le", "surrogatepass"), np.uint32)
    owner = np.repeat(np.arange(len(low)), np.array([len(t) + 1 for t in low], np.int64))[: len(codes)]
    symbols = _TABLE[np.minimum(codes, 65535)]
    keep = symbols != _DROPPED
    symbols, owner = symbols[keep], owner[keep]
    letter = symbols != _SPACE
    if not letter.any():
        return Words(np.zeros(1, np.uint32), np.zeros(0, np.int64), np.zeros(0, np.int64))
    # one space before each word; none between single letters of one text
    first = letter & np.concatenate(([True], ~letter[:-1]))
    place = np.flatnonzero(letter)
    begins = first[place]
    at = np.flatnonzero(begins)
    sizes = np.diff(np.concatenate((at, [len(place)])))
    word_text = owner[place[at]]
    glued = np.zeros(len(at), bool)
    glued[1:] = (sizes[1:] == 1) & (sizes[:-1] == 1) & (word_text[1:] == word_text[:-1])
    begins[at[glued]] = False
    at, word_text = np.flatnonzero(begins), word_text[~glued]
    starts = at + np.arange(len(at))
    out = np.zeros(len(place) + len(at) + 1, np.uint32)
    shift = np.cumsum(begins)
    out[np.arange(len(place)) + shift] = symbols[place]
    return Words(out, starts, word_text)


def _shape_features(symbols: np.ndarray):
    """For each shape: the places, hashed subsequences and weight."""
    n = len(symbols)
    padded = np.concatenate((symbols, np.zeros(6, np.uint32)))
    inner = padded != _SPACE
    two = inner[1 : n + 1]
    three = two & inner[2 : n + 2]
    four = three & inner[3 : n + 3]
    valid = {2: two, 3: three, 4: four, 5: four & inner[4 : n + 4]}
    parts = [symbols * _FACTORS[0]]
    for shape in _SHAPES:
        where = np.flatnonzero(valid[shape[-1]])
        h = parts[0][where] + np.uint32(len(shape) * 0x165667B1 & 0xFFFFFFFF)
        for k, off in enumerate(shape):
            h += padded[where + off] * _FACTORS[k + 1]
        h ^= h >> np.uint32(15)
        h *= np.uint32(0x2C1B3C6D)
        yield where, h >> np.uint32(32 - BITS), SKIP ** (shape[-1] - len(shape))


def _norms(words: Words) -> np.ndarray:
    """Norm of each word's subsequence counts, all taken as different."""
    ends = np.concatenate((words.starts[1:], [len(words.symbols) - 1])) if len(words.starts) else words.starts
    letters = np.minimum(ends - words.starts - 1, NORM_LETTERS)
    total = np.zeros(len(letters))
    for shape in _SHAPES:
        total += np.maximum(letters + 2 - shape[-1], 0) * SKIP ** (2 * (shape[-1] - len(shape)))
    return np.sqrt(np.maximum(total, 1))


def margins(words: Words, weights: np.ndarray, bias: float) -> np.ndarray:
    """The machine's margin of each word."""
    if not len(words.starts):
        return np.zeros(0)
    value = np.zeros(len(words.symbols), np.float32)
    for where, h, weight in _shape_features(words.symbols):
        value[where] += np.float32(weight) * weights[h]
    return np.add.reduceat(value, words.starts, dtype=np.float64) / _norms(words) + bias


def pooled(words: Words, margin: np.ndarray, n_texts: int) -> np.ndarray:
    """Per text: largest margin, second largest, log of one and the sum above 0; margins end at 1."""
    margin = np.clip(margin, -1, 1)
    out = np.zeros((n_texts, FEATURES))
    out[:, :2] = -1
    if len(margin):
        order = np.lexsort((-margin, words.text))
        text, m = words.text[order], margin[order]
        head = np.concatenate(([True], text[1:] != text[:-1]))
        out[text[head], 0] = m[head]
        second = np.concatenate(([False], head[:-1])) & ~head
        out[text[second], 1] = m[second]
        out[:, 2] = np.log1p(np.bincount(words.text, np.maximum(margin, 0), n_texts))
    return out


# --- fitting ------------------------------------------------------------------------------


def _sparse(words: Words, scale: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, subsequence, weight) of every occurrence."""
    owner = np.zeros(len(words.symbols), np.int64)
    owner[words.starts] = 1
    owner = np.cumsum(owner) - 1
    parts = [(owner[w], h.astype(np.int64), np.full(len(w), v)) for w, h, v in _shape_features(words.symbols)]
    owner, h, value = (np.concatenate([p[k] for p in parts]) for k in range(3))
    return owner, h, value * scale[h]


def _block(words: Words, start: int, end: int) -> Words:
    """Some of the words."""
    stop = words.starts[end] if end < len(words.starts) else len(words.symbols) - 1
    first = words.starts[start]
    return Words(words.symbols[first : stop + 1], words.starts[start:end] - first, words.text[start:end])


def kernel(a: Words, b: Words, scale: np.ndarray) -> np.ndarray:
    """Normalised kernel of every word of ``a`` with every word of the small ``b``."""
    wb, hb, vb = _sparse(b, scale)
    features, col = np.unique(hb, return_inverse=True)
    table = np.zeros((len(features), len(b.starts)), np.float32)
    np.add.at(table, (col, wb), vb)
    table /= _norms(b)
    out = np.zeros((len(a.starts), len(b.starts)), np.float32)
    step = max(50, 60_000 // max(len(b.starts), 1))  # the rows that meet are laid out for so many words at once
    for start in range(0, len(out), step):
        end = min(start + step, len(out))
        wa, ha, va = _sparse(_block(a, start, end), scale)
        at = np.minimum(np.searchsorted(features, ha), len(features) - 1)
        hit = np.flatnonzero(features[at] == ha)
        hit = hit[np.argsort(wa[hit], kind="stable")]
        w = wa[hit]
        head = np.flatnonzero(np.concatenate(([True], w[1:] != w[:-1]))) if len(w) else []
        if len(w):
            out[start + w[head]] = np.add.reduceat(table[at[hit]] * va[hit, None].astype(np.float32), head)
    return out / _norms(a)[:, None].astype(np.float32)


def _newton(x: np.ndarray, y: np.ndarray, weight: np.ndarray, hinge: bool, ridge: float) -> np.ndarray:
    """Weights (last: bias) of least ridge plus squared hinge or logistic loss.

    Row blocks keep the memory at that of ``x``.
    """
    n = x.shape[1] + 1
    v, penalty = np.zeros(n), np.full(n, ridge)
    penalty[-1] = 1e-6
    blocks = [slice(s, s + 4096) for s in range(0, len(x), 4096)]
    exact = np.float32 if x.dtype == np.float16 else np.float64

    def margin(u: np.ndarray) -> np.ndarray:
        return y * np.concatenate([x[b].astype(exact) @ u[:-1].astype(exact) for b in blocks] + [np.zeros(0)]) + y * u[-1]

    def loss(z: np.ndarray, u: np.ndarray) -> float:
        each = np.maximum(0, 1 - z) ** 2 if hinge else np.logaddexp(0, -z)
        return float(weight @ each + 0.5 * penalty @ (u * u))

    z = margin(v)
    for _ in range(40):
        if hinge:
            slope, curve = -2 * np.maximum(0, 1 - z), 2.0 * (z < 1)
        else:
            p = 1 / (1 + np.exp(np.clip(z, -50, 50)))
            slope, curve = -p, p * (1 - p)
        gradient, hessian = penalty * v, np.diag(penalty + 1e-9)
        for b in blocks:
            part = np.hstack([x[b].astype(exact), np.ones((len(x[b]), 1), exact)])
            gradient += part.T @ (weight * y * slope)[b].astype(exact)
            hessian += (part * (weight * curve)[b, None].astype(exact)).T @ part
        step = np.linalg.solve(hessian, gradient)
        rate, now = 1.0, loss(z, v)
        while rate > 1e-4 and loss(margin(v - rate * step), v - rate * step) > now:
            rate /= 2
        v -= rate * step
        z = margin(v)
        if rate * np.abs(step).max() < 1e-6:
            break
    return v


def _landmarks(names: list[str], toxic, other, n_toxic: float, n_other: float, scale: np.ndarray) -> list[str]:
    tie = np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((other + 0.5) / (n_other + 1))
    strength = np.where((toxic >= 2) & (tie > 0.7), np.sqrt(toxic) * tie, -1)
    best = [i for i in np.argsort(-strength, kind="stable")[: 4 * LANDMARKS].tolist() if strength[i] > 0]
    chosen: list[int] = []
    if best:
        w = words_of([names[i] for i in best])
        near = kernel(w, w, scale)
        size = np.sqrt(np.diag(near))
        near /= size[:, None] * size
        picked: list[int] = []
        for k in range(len(best)):
            if len(picked) < LANDMARKS and (not picked or near[k, picked].max() < 0.95):
                picked.append(k)
        chosen = [best[k] for k in picked]
    chosen += np.argsort(-other, kind="stable")[:COMMON_LANDMARKS].tolist()
    return [names[i] for i in dict.fromkeys(chosen)]


def _put_in(chosen: list[str], names: list[str], toxic: np.ndarray, other: np.ndarray) -> tuple[list[str], np.ndarray]:
    """Landmarks of toxic texts only, each inner place with another letter put in, and their weights."""
    at = {n: i for i, n in enumerate(names)}
    spelled, share = [], []
    for word in chosen:
        i = at[word]
        if len(word) >= 4 and other[i] == 0 and toxic[i] > 0:
            for k in range(1, len(word)):
                spelled.append(word[:k] + chosen[(k * 7 + len(word)) % len(chosen)][0] + word[k:])
                share.append(PUT_IN * toxic[i])
    return spelled, np.array(share)


def _held(every: Words, counts: np.ndarray) -> np.ndarray:
    """How many of the words, each as often as it counts, hold each subsequence."""
    out = np.zeros(1 << BITS)
    for start in range(0, len(every.starts), 2000):
        owner, h, _ = _sparse(_block(every, start, min(start + 2000, len(every.starts))), np.ones(1 << BITS, np.float32))
        out += np.bincount(h, counts[start + owner], 1 << BITS)
    return out


@dataclass
class Machine:
    """Support vector machine on the landmarks' kernel: a word's margin is its kernel row times ``per_mark``, and ``bias``."""

    marks: Words
    scale: np.ndarray
    per_mark: np.ndarray
    bias: float

    def margins(self, words: Words) -> np.ndarray:
        return kernel(words, self.marks, self.scale) @ self.per_mark + self.bias

    def folded(self) -> np.ndarray:
        """One weight per subsequence: what is linear in the counts, multiplied out."""
        weights = np.zeros(1 << BITS, np.float32)
        w, h, value = _sparse(self.marks, self.scale)
        per_word = self.per_mark / _norms(self.marks)
        np.add.at(weights, h, (per_word[w] * value * self.scale[h]).astype(np.float32))
        return weights


def fit_words(names: list[str], toxic: np.ndarray, other: np.ndarray, n_toxic: float, n_other: float) -> Machine:
    """The machine of these words: in how many toxic and other texts each stands, of how many."""
    every = words_of(names)
    scale = ((1 + _held(every, other)) ** -COMMONNESS).astype(np.float32)
    chosen = _landmarks(names, toxic, other, n_toxic, n_other, scale)
    marks = words_of(chosen)
    inner = kernel(marks, marks, scale)
    values, vectors = np.linalg.eigh((inner + inner.T) / 2)
    ok = values > 1e-8 * values.max()
    root = (vectors[:, ok] / np.sqrt(values[ok])).astype(np.float32)  # Nyström map of kernel rows
    spelled, share = _put_in(chosen, names, toxic, other)
    both = np.flatnonzero((toxic > 0) & (other > 0))
    rows = len(names) + len(both) + len(spelled)
    x = np.zeros((rows, root.shape[1]), np.float16)
    for start in range(0, len(names), 4096):
        end = min(start + 4096, len(names))
        x[start:end] = kernel(_block(every, start, end), marks, scale) @ root
    # a word of both kinds of texts stands for either
    x[len(names) : len(names) + len(both)] = x[both]
    y = np.concatenate([np.where(toxic > 0, 1.0, -1.0), np.full(len(both), -1.0), np.ones(len(spelled))])
    weight = np.concatenate([np.where(toxic > 0, toxic, other), other[both], share])
    if spelled:
        x[len(names) + len(both) :] = kernel(words_of(spelled), marks, scale) @ root
    v = _newton(x, y, COST * weight, hinge=True, ridge=1.0)
    return Machine(marks, scale, root.astype(float) @ v[:-1], float(v[-1]))


# --- with Spark ---------------------------------------------------------------------------


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    logistic: np.ndarray


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``text, toxic, fold`` of the labelled texts to fit on. Its labels are few by the bound."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    total = known.count()
    known = known.groupBy(F.col("doc_id").alias("labelled_id")).agg(F.max("toxic").alias("toxic"))
    if total > SAMPLE_ROWS:
        known = known.where(F.pmod(F.xxhash64(F.col("labelled_id").cast("long"), F.lit(10)), F.lit(1_000_000)) < int(1e6 * SAMPLE_ROWS / total))
    few = F.broadcast(known)
    joined = docs.select(F.col("doc_id").alias("labelled_id"), "text").join(few, "labelled_id")
    fold = F.pmod(F.xxhash64("labelled_id", F.lit(11)), F.lit(2)).cast("int")
    return joined.select("text", F.col("toxic").cast("int").alias("toxic"), fold.alias("fold"))


def _spelled(w: Words) -> list[str]:
    s = w.symbols.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass").split("\x00")
    return s[1:-1]


def _word_rows(batches):
    """(word, fold, toxic) once per text and word."""
    for batch in batches:
        for part in common.slices(batch, "text", SLICE_BYTES):
            w = words_of(common.texts_of(part, "text"))
            fold, toxic = (np.asarray(part.column(k).to_pylist(), np.int32) for k in (2, 1))
            seen = sorted(set(zip(_spelled(w), w.text.tolist(), strict=True)))
            text = np.array([t for _, t in seen], np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in seen], pa.string()), pa.array(fold[text], pa.int32()), pa.array(toxic[text], pa.int32())],
                names=["word", "fold", "toxic"],
            )


#: Which fold's counts each machine is fitted on: those that judge fold 0 and fold 1, and the model itself.
_FITS = ((1,), (0,), (0, 1))


def _fitted(sizes: dict[tuple[int, int], int]):
    """Machines from counted words (fit, word, toxic, other), the rows of a fit one after the other."""

    def done(fit: int, names: list[str], toxic: np.ndarray, other: np.ndarray) -> pa.RecordBatch:
        n_toxic, n_other = (sum(n for (f, t), n in sizes.items() if f in _FITS[fit] and (t == 1) == kind) for kind in (True, False))
        machine = fit_words(names, toxic, other, n_toxic, n_other)
        values = [[fit], [machine.folded().astype("<f4").tobytes()], [machine.bias]]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, (pa.int32(), pa.binary(), pa.float64()), strict=True)], names=["fit", "weights", "bias"])

    def run(batches):
        fit, names, counts = None, [], []
        for batch in batches:
            own = batch.column(0).to_numpy()
            cuts = [0, *(np.flatnonzero(np.diff(own)) + 1).tolist(), len(own)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if b == a:
                    continue
                if fit is not None and own[a] != fit:
                    yield done(fit, names, *np.concatenate(counts, 1))
                    names, counts = [], []
                fit = int(own[a])
                names += batch.column(1)[a:b].to_pylist()
                counts.append(np.array([batch.column(k)[a:b].to_numpy() for k in (2, 3)], float))
        if fit is not None:
            yield done(fit, names, *np.concatenate(counts, 1))
        names, counts = [], []
        gc.collect()
        common.release_memory()

    return run


def _machines(stats: DataFrame, sizes: dict[tuple[int, int], int]) -> list[tuple[np.ndarray, float]]:
    """Weights and bias of each fit. A fit's words, bounded by the sample, are one task's."""
    def counted(kind: str, folds: tuple[int, ...]) -> Column:
        total = F.col(f"{kind}{folds[0]}")
        for f in folds[1:]:
            total = total + F.col(f"{kind}{f}")
        return total

    copies = F.array(*[F.struct(F.lit(k).alias("fit"), counted("t", f).alias("toxic"), counted("o", f).alias("other")) for k, f in enumerate(_FITS)])
    rows = stats.select("word", F.explode(copies).alias("c")).select("c.fit", "word", "c.toxic", "c.other").where("toxic + other > 0")
    placed = rows.repartitionByRange(len(_FITS), "fit").sortWithinPartitions("fit", "word")
    found = common.arrow(placed, _fitted(sizes), "fit int, weights binary, bias double").collect()
    return [(np.frombuffer(r["weights"], "<f4"), r["bias"]) for r in sorted(found, key=lambda r: r["fit"])]


def _pooled_rows(models):
    def run(batches):
        for batch in batches:
            for part in common.slices(batch, "text", SLICE_BYTES):
                w = words_of(common.texts_of(part, "text"))
                fold = np.asarray(part.column(2).to_pylist(), np.int64)
                both = np.stack([pooled(w, margins(w, *m), part.num_rows) for m in models.value])
                own = both[fold, np.arange(len(fold))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(1).cast(pa.int32()), *[pa.array(own[:, k]) for k in range(FEATURES)]], names=["toxic", *"abc"]
                )

    return run


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Fits on the labelled texts outside the held-out third."""
    spark = docs.sparkSession
    sample = common.shared_table(_sample(docs, labels), "toxicity-sample")
    sizes = {(r["fold"], r["toxic"]): r["n"] for r in sample.groupBy("fold", "toxic").agg(F.count("*").alias("n")).collect()}
    toxic_n = [sizes.get((f, 1), 0) for f in (0, 1)]
    other_n = [sum(n for (g, t), n in sizes.items() if g == f and t != 1) for f in (0, 1)]
    if min(toxic_n) == 0 or min(other_n) == 0:
        share = sum(toxic_n) / max(1, sum(toxic_n) + sum(other_n))
        odds = np.log(max(share, 1e-9) / max(1 - share, 1e-9))
        return Model(np.zeros(1 << BITS, np.float32), 0.0, np.array([0, 0, 0, odds]))
    rows = common.arrow(sample, _word_rows, "word string, fold int, toxic int")
    count = lambda fold, toxic: F.sum(((F.col("fold") == fold) & ((F.col("toxic") == 1) == F.lit(toxic))).cast("long"))
    stats = rows.groupBy("word").agg(
        count(0, True).alias("t0"), count(1, True).alias("t1"), count(0, False).alias("o0"), count(1, False).alias("o1")
    )
    stats = common.shared_table(stats, "toxicity-words")
    *other_half, (weights, bias) = _machines(stats, sizes)
    sent = spark.sparkContext.broadcast(other_half)
    features = common.arrow(sample, _pooled_rows(sent), "toxic int, a double, b double, c double").toPandas()
    y = np.where(features["toxic"].to_numpy() == 1, 1.0, -1.0)
    logistic = _newton(features[list("abc")].to_numpy(), y, np.ones(len(y)), hinge=False, ridge=0.05)
    return Model(weights, bias, logistic)


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """Appends the score of each whole text, 0 to 1."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = sent.value

        def compute(part: pa.RecordBatch) -> list[pa.Array]:
            w = words_of(common.texts_of(part, text_col))
            x = pooled(w, margins(w, m.weights, m.bias), part.num_rows)
            z = x @ m.logistic[:-1] + m.logistic[-1]
            return [pa.array(1 / (1 + np.exp(-np.clip(z, -50, 50))))]

        return compute

    return common.with_arrow_columns(docs, text_col, [T.StructField(score_col, T.DoubleType())], make, SLICE_BYTES)
