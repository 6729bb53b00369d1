"""Secret scans: fixed patterns, and guess costs of values in credential contexts.

Base spans, leftmost and not overlapping within a kind (offsets in code points,
end exclusive): ``assign`` a credential name, ``:`` or ``=`` and a value of 8 or
more characters; ``access`` an access-key id of 16 or more characters; ``hex`` a
run of 32 or more lower-case hexadecimal digits. A match that is too short is
dropped after it has been matched.

The method adds ``guess`` spans: a value after a credential word (a wider list,
and words such as "is" allowed between) whose *guess cost* is high. The cost is
the number of guesses of the cheapest way to cut the value into dictionary words,
dates, repeats, sequences, keyboard walks and brute-force stretches, found by
dynamic programming over the value's positions; each further part multiplies
the guesses, and orders of parts multiply them too. A guess span that lies
inside a base span is not listed again.

*Repeats* are those of one character and of blocks of any length. Blocks are found as
maximal runs; any stretch of a run that holds two blocks or more is a part, and costs the
block's own cheapest cut, its start in the block and its length.

*Long stretches.* Every piece of a repeat, walk, sequence or run may be a part, and in a
stretch of ``L`` characters these are of the order of ``L`` squared. Their costs grow with the length more and
more slowly, so among the starts of pieces an earlier one that is cheaper at some end
stays cheaper at all later ends: the least sums of all ends are found by halving, in
``L`` times the square of its logarithm, with the same result as trying all pieces.

The dictionary is the list of common passwords below, then the whole words of the
word tokenizer's vocabulary by rank, so that a plain word or two ("required",
"see-documentation") cost few guesses and letters in no order cost many.

Cases: null and empty texts have no spans. Values of any length are scored whole, with
all their parts.
"""

from __future__ import annotations

import json
import math
import re
from functools import cache, lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common
from .runs import squares

KINDS = ("assign", "access", "hex", "guess")

_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{32,}")
_CREDENTIAL = re.compile(
    r"""(?:passphrase|password|passwd|passcode|pass|pwd|secret|token|credentials?|auth|api[_-]?key|access[_-]?key|private[_-]?key|pin)"""
    r"""(?![a-z])["']?(?:\x20+(?:is|was|equals)\x20+|\x20*(?::=|=>|->|[:=])\x20*)["']?([^\s"'<>,;]+)""",
    re.A | re.I,
)
_MAY_HOLD = re.compile(r"pass|pwd|secret|token|credential|auth|key|pin|AKIA|[0-9a-f]{32}", re.A | re.I)

#: log10 of the guesses from which a value counts as a secret.
LEAST_LOG10 = 8.0
#: Parts of a cut, at most: the orders of more would pass LEAST_LOG10 by themselves.
MOST_PARTS = 12
#: Stretches up to so long have their pieces listed; those of longer ones are found by halving.
LISTED = 40

# Frequent words of guessed passwords, most frequent first; the rank is the guess cost.
COMMON_WORDS = """
password love admin welcome monkey dragon master letmein login princess sunshine shadow football baseball
superman batman iloveyou hello freedom whatever trustno secret summer winter spring autumn flower cookie
pepper ginger cheese chocolate coffee summer soccer hockey tennis golf cowboy tiger lion eagle falcon wolf
horse jaguar ferrari porsche mercedes mustang corvette harley yankees rangers cowboys lakers chelsea arsenal
liverpool barcelona michael jordan daniel thomas robert william charlie george andrew joshua matthew anthony
jennifer jessica michelle ashley nicole amanda hannah maggie buster killer hunter ranger thunder silver
golden orange purple yellow green black white blue red computer internet server system manager oracle root
user guest test demo example sample default changeme public private access token key pass word the and for
you not with this that from have your
""".split()

# Rows of a keyboard.
KEY_ROWS = ("`1234567890-=", "qwertyuiop[]\\", "asdfghjkl;'", "zxcvbnm,./")

#: Characters that join words, as one of so many choices.
JOINTS = "-_./:+~ "

_PLAIN = str.maketrans("013457@$!", "oieastasi")
_PLACE = {c: (r, k + 0.5 * r) for r, row in enumerate(KEY_ROWS) for k, c in enumerate(row)}
_DATE = re.compile(r"(?:19|20)\d\d(?:([-/._]?)(?:0[1-9]|1[0-2])\1(?:0[1-9]|[12]\d|3[01]))?|(?:0?[1-9]|[12]\d|3[01])([-/._])(?:0?[1-9]|1[0-2])\2(?:19|20)?\d\d")


@cache
def _ranks() -> tuple[dict[str, int], int]:
    """Rank of each dictionary word, and the longest word's length."""
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json"), encoding="utf-8") as f:
        vocabulary = json.load(f)["model"]["vocab"]
    whole = (t[:-4] for t in sorted(vocabulary, key=vocabulary.get) if t.endswith("</w>"))
    words = dict.fromkeys([*COMMON_WORDS, *(w for w in whole if len(w) >= 3 and w.isascii() and w.isalpha())])
    return {w: i + 1 for i, w in enumerate(words)}, max(map(len, words))


def _near(a: str, b: str) -> bool:
    """Are the keys neighbours (or the same)?"""
    p, q = _PLACE.get(a), _PLACE.get(b)
    return p is not None and q is not None and abs(p[0] - q[0]) <= 1 and abs(p[1] - q[1]) <= 1


def _case_cost(part: str) -> float:
    upper = sum(c.isupper() for c in part)
    if not upper:
        return 0.0
    if part.isupper() or (upper == 1 and part[0].isupper()):
        return math.log10(2)
    return math.log10(sum(math.comb(len(part), k) for k in range(1, min(upper, len(part) - upper) + 1)) or 2)


def _alphabet(part: str) -> int:
    return (26 * any(c.islower() for c in part) + 26 * any(c.isupper() for c in part) + 10 * any(c.isdigit() for c in part)
            + 33 * any(c.isascii() and not c.isalnum() for c in part) + 100 * (not part.isascii())) or 1


def _stretches(n: int, follows) -> list[tuple[int, int]]:
    """The longest stretches in which each character follows the one before."""
    cuts = [0, *[j for j in range(1, n) if not follows(j)], n]
    return list(zip(cuts, cuts[1:], strict=False))


class Pieces:
    """Pieces of a stretch that may be parts: from ``places[x]`` to ``places[y]``, ``y - x >= least``, at
    ``start[x] + growth[y - x]`` (log10 of guesses; ``growth`` concave)."""

    def __init__(self, places: np.ndarray, least: int, start: np.ndarray, growth: np.ndarray, kind: str):
        self.places, self.least, self.start, self.growth, self.kind = places, least, start, growth, kind

    def listed(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """All pieces: from, to, cost."""
        x, y = np.triu_indices(len(self.places), self.least)
        return self.places[x], self.places[y], self.start[x] + self.growth[y - x]

    def least_sums(self, before: np.ndarray) -> np.ndarray:
        """For the places from the ``least``-th on, the least of ``before`` a piece and its cost."""
        base = (before[self.places] + self.start)[: -self.least]
        growth, out = self.growth[self.least :], np.full(len(base), np.inf)

        def all_of(rows: slice, columns: slice) -> None:
            y, x = np.arange(rows.start, rows.stop)[:, None], np.arange(columns.start, columns.stop)[None, :]
            sums = np.where(y >= x, base[x] + growth[np.maximum(y - x, 0)], np.inf)
            out[rows] = np.minimum(out[rows], sums.min(1))

        def block(rows: slice, columns: slice) -> None:
            """Columns all before the rows: the least column moves back as rows go on."""
            high, wide = rows.stop - rows.start, columns.stop - columns.start
            if high <= 0 or wide <= 0:
                return
            if high * wide <= 4096:
                return all_of(rows, columns)
            y = (rows.start + rows.stop) // 2
            sums = base[columns] + growth[y - np.arange(columns.start, columns.stop)]
            x = int(sums.argmin())
            out[y] = min(out[y], sums[x])
            x += columns.start
            block(slice(rows.start, y), slice(x, columns.stop))
            block(slice(y + 1, rows.stop), slice(columns.start, x + 1))

        def halves(a: int, b: int) -> None:
            if b - a <= 64:
                return all_of(slice(a, b), slice(a, b))
            mid = (a + b) // 2
            halves(a, mid)
            halves(mid, b)
            block(slice(mid, b), slice(a, mid))

        halves(0, len(base))
        return out


def _lower(value: str) -> str:
    low = value.lower()
    if len(low) != len(value):  # a character whose small letter is two
        low = "".join(c.lower() if len(c.lower()) == 1 else c for c in value)
    return low


def _words_and_dates(value: str, low: str):
    """(from, to, log10 of guesses, kind) of dictionary words and dates."""
    n, plain, joint = len(value), low.translate(_PLAIN), math.log10(len(JOINTS))
    ranks, longest = _ranks()
    for i in range(n):
        for j in range(i + 3, min(n, i + longest) + 1):
            for text, extra in ((low[i:j], 0.0), (plain[i:j], math.log10(2))):
                rank = ranks.get(text) or (ranks.get(text[::-1], 0) * 2)
                if rank:
                    swaps = extra if text != low[i:j] or not extra else 0.0
                    cost = math.log10(rank) + swaps + _case_cost(value[i:j])
                    yield i, j, cost, "word"
                    if i and value[i - 1] in JOINTS:  # with the sign that joins it to the part before
                        yield i - 1, j, cost + joint, "word"
        if value[i].isdigit() and (m := _DATE.match(value, i)):
            yield i, m.end(), math.log10(365 * 120 if len(m[0]) > 4 else 120), "date"


def _stretch_pieces(low: str):
    """Repeats of a character, keyboard walks, sequences (three characters or more), and repeats of a block."""
    n = len(low)

    def pieces(a: int, b: int, start, growth, kind: str) -> Pieces:
        length = np.arange(1, b - a + 1)
        return Pieces(np.arange(a, b + 1), 3, np.append(start, 0.0), np.concatenate(([0.0], growth(length))), kind)

    for a, b in _stretches(n, lambda j: low[j] == low[j - 1]):
        if b - a >= 3:
            yield pieces(a, b, np.zeros(b - a), lambda m, a=a: np.log10(_alphabet(low[a]) * m), "repeat")
    for a, b in _stretches(n, lambda j: _near(low[j - 1], low[j])):
        if b - a >= 3:
            yield pieces(a, b, np.zeros(b - a), lambda m: np.log10(47 * m) + 0.3 * (m - 1), "walk")
    for step in (1, -1):
        for a, b in _stretches(n, lambda j, step=step: ord(low[j]) - ord(low[j - 1]) == step):
            if b - a >= 3:
                start = np.log10([4 if c in "a1z9" else 26 for c in low[a:b]])
                yield pieces(a, b, start, lambda m, step=step: np.log10(m * (1 if step > 0 else 2)), "sequence")
    if n < 4:
        return
    for (a, size), last in squares([ord(c) for c in low]).items():
        if size == 1:
            continue
        places, block = np.arange(a, last + 2), log10_guesses(low[a : a + size])
        start = block + np.where(places == a, 0.0, math.log10(size))
        yield Pieces(places, 2 * size, start, np.log10(np.maximum(np.arange(len(places)), 1)), "repeat")
        for r in range(min(size, len(places) - 2 * size)):  # whole blocks: their number instead of the length
            own = slice(r, None, size)
            count = np.arange(len(places[own]))
            yield Pieces(places[own], 2, start[own], np.log10(np.maximum(count, 1)), "repeat")


_ORDERS = np.array([math.log10(math.factorial(k)) for k in range(MOST_PARTS + 1)])


class Cuts:
    """Least sums of log guesses of the first ``j`` characters in ``k`` parts, the last one found or brute force."""

    def __init__(self, value: str):
        low, n = _lower(value), len(value)
        self.each, self.n = math.log10(max(10, _alphabet(value))), n
        words, stretches = list(_words_and_dates(value, low)), list(_stretch_pieces(low))
        self.long = [p for p in stretches if len(p.places) > LISTED]
        lists = [p.listed() for p in stretches if len(p.places) <= LISTED]
        self.kinds = [w[3] for w in words] + [p.kind for p, (i, _, _) in zip((p for p in stretches if len(p.places) <= LISTED), lists, strict=True) for _ in i]
        columns = list(zip(*[w[:3] for w in words], strict=True)) if words else [(), (), ()]
        self.i, self.j, self.c = (np.concatenate([np.array(columns[k], float if k == 2 else int), *[x[k] for x in lists]]) for k in range(3))
        order = np.argsort(self.j, kind="stable")
        ends = self.j[order]
        cuts = np.flatnonzero(np.concatenate(([True], ends[1:] != ends[:-1]))) if len(ends) else np.zeros(0, int)
        place, steps = np.arange(n + 1), self.each * np.arange(n + 1)
        self.found, self.brute = [np.where(place == 0, 0.0, np.inf)], [np.full(n + 1, np.inf)]
        for _ in range(MOST_PARTS):
            before = np.minimum(self.found[-1], self.brute[-1])
            found = np.full(n + 1, np.inf)
            if len(ends):
                found[ends[cuts]] = np.minimum.reduceat((before[self.i] + self.c)[order], cuts)
            for p in self.long:
                at = p.places[p.least :]
                found[at] = np.minimum(found[at], p.least_sums(before))
            brute = np.full(n + 1, np.inf)
            brute[1:] = (np.minimum.accumulate(self.found[-1] - steps) + steps + self.each)[:-1]
            self.found.append(found)
            self.brute.append(brute)
        totals = np.array([min(f[n], b[n]) for f, b in zip(self.found, self.brute, strict=True)]) + _ORDERS
        self.parts = int(totals.argmin())
        self.cost = float(totals[self.parts])

    def last_part(self, j: int, k: int) -> tuple[int, str]:
        """Start and kind of the last of the ``k`` parts that end at ``j``."""
        if self.brute[k][j] < self.found[k][j]:
            i = j - 1
            while self.found[k - 1][i] + self.each * (j - i) > self.brute[k][j] + 1e-9:
                i -= 1
            return i, "brute"
        before = np.minimum(self.found[k - 1], self.brute[k - 1])
        options = [(before[self.i[x]] + self.c[x], self.i[x], self.kinds[x]) for x in np.flatnonzero(self.j == j)]
        for p in self.long:
            for y in np.flatnonzero(p.places == j).tolist():
                options += [(before[p.places[x]] + p.start[x] + p.growth[y - x], p.places[x], p.kind) for x in range(y - p.least + 1)]
        _, i, kind = min(options)
        return int(i), kind


def segmentation(value: str) -> tuple[float, list[tuple[int, int, str]]]:
    """log10 of the guesses of the cheapest cut, and its parts.

    ``k`` parts come in ``k!`` orders. Brute-force stretches cost ten guesses a
    character at least (the digits), by the alphabet of the whole value.
    """
    if not value:
        return 0.0, []
    cuts = Cuts(value)
    parts, j = [], len(value)
    for k in range(cuts.parts, 0, -1):
        i, kind = cuts.last_part(j, k)
        parts.append((i, j, kind))
        j = i
    return cuts.cost, parts[::-1]


@lru_cache(maxsize=20_000)
def log10_guesses(value: str) -> float:
    return Cuts(value).cost if value else 0.0


def spans_of(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all secrets, by start, then kind as listed."""
    if not _MAY_HOLD.search(text):
        return []
    found = [(m.start(), m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), m.end(), "access") for m in _ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), m.end(), "hex") for m in _HEX.finditer(text)]
    base = list(found)
    for m in _CREDENTIAL.finditer(text):
        value = m[1].rstrip(".:!?)]}")
        start, end = m.start(1), m.start(1) + len(value)
        if len(value) >= 6 and not any(s <= start and end <= e for s, e, _ in base) and log10_guesses(value) >= LEAST_LOG10:
            found.append((start, end, "guess"))
    return sorted(found, key=lambda x: (x[0], KINDS.index(x[2])))


_SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())]))
_ARROW_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))


def _listed(texts: list[str | None]) -> list[list[dict]]:
    return [[{"kind": k, "start": s, "end": e} for s, e, k in spans_of(t or "")] for t in texts]


def _redacted(texts: list[str | None], spans: list[list[dict] | None]) -> pa.Array:
    out = []
    for text, own in zip(texts, spans, strict=True):
        if text and own:
            kept, pos = [], 0
            for x in own:
                if x["start"] >= pos:
                    kept += [text[pos : x["start"]], f"[{x['kind']}]"]
                pos = max(pos, x["end"])
            text = "".join([*kept, text[pos:]])
        out.append(text)
    return pa.array(out, pa.string())


def _column(part: pa.RecordBatch, name: str) -> list:
    return part.column(part.schema.get_field_index(name)).to_pylist()


def scan(docs: DataFrame, text_col: str = "text", spans_col: str = "secrets") -> DataFrame:
    """Appends the spans as ``array<struct<kind, start, end>>``."""
    make = lambda: lambda part: [pa.array(_listed(_column(part, text_col)), _ARROW_SPANS)]
    return common.with_arrow_columns(docs, text_col, [T.StructField(spans_col, _SPANS)], make)


def redact(scanned: DataFrame, text_col: str = "text", spans_col: str = "secrets") -> DataFrame:
    """Puts ``[kind]`` in place of each secret; overlapping spans become one, of the first kind."""
    make = lambda: lambda part: [_redacted(_column(part, text_col), _column(part, spans_col))]
    return common.with_arrow_columns(scanned, text_col, [T.StructField(text_col, T.StringType())], make).select(scanned.columns)


def scan_and_redact(docs: DataFrame, text_col: str = "text", spans_col: str = "secrets") -> DataFrame:
    """``scan`` and ``redact`` in one pass: one Python worker a task instead of two."""

    def make():
        def compute(part: pa.RecordBatch) -> list[pa.Array]:
            texts = _column(part, text_col)
            spans = _listed(texts)
            return [pa.array(spans, _ARROW_SPANS), _redacted(texts, spans)]

        return compute

    fields = [T.StructField(spans_col, _SPANS), T.StructField(text_col, T.StringType())]
    made = common.with_arrow_columns(docs, text_col, fields, make)
    return made.select(*docs.columns, *[spans_col for _ in range(spans_col not in docs.columns)])


def spelled(spans: Column, base_only: bool) -> Column:
    """``kind:start:end`` of the spans, comma-joined."""
    kept = F.filter(spans, lambda x: x["kind"] != "guess") if base_only else spans
    return F.array_join(F.transform(kept, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
