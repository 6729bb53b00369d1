"""Periodic runs of words: suffix automaton with link-cut access.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q``
apart are identical), at least ``max(12, 2 q)`` words long, that no neighbouring
word extends keeping the period.

*Automaton.* The suffix automaton of the words gives a tree of suffix links; the
path from a prefix's state up to the root holds all suffixes of that prefix. Each
state is coloured with the last place where its words ended.

*Access.* Prefix by prefix, the path to the root is recoloured. The path falls
into segments of one colour, kept as the preferred paths of a link-cut tree
(splay trees), so an access meets an amortised logarithmic number of them. A
segment of colour ``j`` whose deepest state has length ``n`` says that the last
``n`` words also ended at ``j``; with ``d = i - j <= n`` the two occurrences touch or
overlap, a square of period ``d``, and ``n + d`` words up to ``i`` have that period.
``n`` is the longest common suffix of the two ends, so the stretch cannot grow to
the left, and as ``j`` is the *last* occurrence ``d`` is its smallest period. The
largest ``i`` of equal (start, ``d``) ends the run.

*Where to look.* In a run some six words occur again ``q`` words later at every
place but for a gap of at most five, so only stretches of words that repeat a
six-word sequence of their text go through the automaton. Sequences are told apart
by a 64-bit hash: a chance collision only lengthens a stretch.

*Collapsing.* A word goes if any run contains it after the run's first ``q`` words.

Words are ``[^\\x20\\x09-\\x0D]+``, numbered from 0. Null and empty texts have no words
and no runs; repeated rows give repeated rows; rows of any length are handled whole,
in memory proportional to the longest row of a task. Map-only: no shuffle, a lost
task is run again alone.
"""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401 - pa.compute
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Words of the shortest run, and of the sequence that any such run repeats.
SHORTEST, SEED = 12, 6

_ODD = np.uint64(0x9E3779B97F4A7C15)


def automaton(word_ids: list[int]) -> tuple[list[int], list[int], list[int]]:
    """Suffix link and length of each state (0: the root), and the state of each prefix."""
    step: list[dict[int, int]] = [{}]
    link, length, prefix = [-1], [0], []
    last = 0
    for w in word_ids:
        new = len(link)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and w not in step[p]:
            step[p][w] = new
            p = link[p]
        if p != -1:
            q = step[p][w]
            if length[q] == length[p] + 1:
                link[new] = q
            else:
                clone = len(link)
                step.append(step[q].copy())
                link.append(link[q])
                length.append(length[p] + 1)
                link[q] = link[new] = clone
                while p != -1 and step[p].get(w) == q:
                    step[p][w] = clone
                    p = link[p]
        prefix.append(new)
        last = new
    return link, length, prefix


class LastOccurrences:
    """Link-cut tree over the suffix links: each preferred path has one colour.

    ``access(v, i)`` recolours the path from ``v`` to the root and yields the segments
    that it crossed, as (colour, deepest state). The root itself is left out: the
    empty sequence ends everywhere.
    """

    def __init__(self, link: list[int]):
        n = len(link)
        self.up = [p if p > 0 else 0 for p in link]  # splay parent, or the state above the path
        self.left, self.right = [0] * n, [0] * n  # shallower and deeper states of the path
        self.colour = [-1] * n  # kept at the top of each splay tree

    def _splay(self, x: int) -> None:
        """Makes ``x`` the top of its splay tree."""
        up, left, right = self.up, self.left, self.right
        top = x
        while True:
            p = up[x]
            if not p or (left[p] != x and right[p] != x):
                break
            g = up[p]
            if g and (left[g] == p or right[g] == p):
                self._rotate(p if (left[g] == p) == (left[p] == x) else x)
                top = g
            else:
                top = p
            self._rotate(x)
        self.colour[x] = self.colour[top]

    def _rotate(self, x: int) -> None:
        up, left, right = self.up, self.left, self.right
        p = up[x]
        g = up[p]
        if left[p] == x:
            child = left[p] = right[x]
            right[x] = p
        else:
            child = right[p] = left[x]
            left[x] = p
        if child:
            up[child] = p
        up[p], up[x] = x, g
        if g:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x

    def access(self, v: int, i: int) -> list[tuple[int, int]]:
        up, right, colour = self.up, self.right, self.colour
        crossed = []
        below, x = 0, v
        while x:
            self._splay(x)
            crossed.append((colour[x], x))
            if right[x]:
                colour[right[x]] = colour[x]
            right[x] = below
            below, x = x, up[x]
        self._splay(v)
        colour[v] = i
        return crossed


def squares(word_ids: list[int]) -> dict[tuple[int, int], int]:
    """Last word of each maximal repetition, by (start, period); at least two periods long."""
    link, length, prefix = automaton(word_ids)
    tree = LastOccurrences(link)
    found: dict[tuple[int, int], int] = {}
    for i, v in enumerate(prefix):
        for j, x in tree.access(v, i):
            if j >= 0 and i - j <= length[x]:
                found[i - length[x] - (i - j) + 1, i - j] = i
    return found


def _stretches(repeated: np.ndarray) -> Iterable[tuple[int, int]]:
    """First word and end of the stretches whose six-word sequences repeat, gaps up to five closed."""
    at = np.flatnonzero(repeated)
    if len(at):
        cut = np.flatnonzero(np.diff(at) > SEED)
        for a, b in zip(np.concatenate(([0], cut + 1)), np.concatenate((cut, [len(at) - 1])), strict=True):
            yield int(at[a]), int(at[b]) + SEED


def repeated_seeds(hashes: np.ndarray) -> np.ndarray:
    """Does the six-word sequence at each place occur twice or more in the text?"""
    n = len(hashes) - SEED + 1
    if n < 2:
        return np.zeros(max(n, 0), bool)
    seeds = np.zeros(n, np.uint64)
    for k in range(SEED):
        seeds = seeds * _ODD + hashes[k : k + n]
    order = np.argsort(seeds)
    ranked = seeds[order]
    twin = ranked[1:] == ranked[:-1]
    out = np.zeros(n, bool)
    out[order[1:][twin]] = True
    out[order[:-1][twin]] = True
    return out


def find_runs(words: list) -> list[tuple[int, int, int]]:
    """(start, length, period) of each run, by start, then period."""
    if len(words) < SHORTEST:
        return []
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    out = []
    for a, e in _stretches(repeated_seeds(hashes)):
        if e - a < SHORTEST:
            continue
        ids: dict = {}
        own = [ids.setdefault(w, len(ids)) for w in words[a:e]]
        out += [(a + s, i - s + 1, q) for (s, q), i in squares(own).items() if i - s + 1 >= SHORTEST]
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(words: list, runs: list[tuple[int, int, int]]) -> list:
    """The words outside of all runs' repetitions."""
    if not runs:
        return words
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, period in runs:
        gone[start + period] += 1
        gone[start + length] -= 1
    return [words[i] for i in np.flatnonzero(np.cumsum(gone[:-1]) == 0)]


_RUN = T.StructType([T.StructField(k, T.LongType()) for k in ("start", "length", "period")])
_ARROW_RUNS = pa.list_(pa.struct([(k, pa.int64()) for k in ("start", "length", "period")]))


def detect(docs: DataFrame, text_col: str = "text", runs_col: str = "runs", collapsed_col: str = "collapsed") -> DataFrame:
    """Appends the runs (by start, then period) and the collapsed text (kept words, one space apart)."""
    fields = [T.StructField(runs_col, T.ArrayType(_RUN)), T.StructField(collapsed_col, T.StringType())]

    def make():
        def compute(part: pa.RecordBatch) -> list[pa.Array]:
            runs, texts = [], []
            for text in part.column(part.schema.get_field_index(text_col)).cast(pa.binary()):
                words = (text.as_py() or b"").split()  # bytes split at just the six blanks
                found = find_runs(words)
                runs.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in found])
                texts.append(b" ".join(collapse(words, found)))
            return [pa.array(runs, _ARROW_RUNS), pa.array(texts, pa.binary()).cast(pa.string())]

        return compute

    return common.with_arrow_columns(docs, text_col, fields, make)


def summarise(found: DataFrame, runs_col: str = "runs", collapsed_col: str = "collapsed") -> DataFrame:
    """Appends the number of runs, the longest run (ties: smallest start, then period; no run:
    nulls) and digests of all runs and of the collapsed text."""
    all_runs = F.col(runs_col)
    ranked = F.array_min(F.transform(all_runs, lambda r: F.struct((-r["length"]).alias("l"), r["start"].alias("s"), r["period"].alias("p"))))
    text = lambda k, r: r[k].cast("string")
    lines = F.transform(all_runs, lambda r: F.concat(text("start", r), F.lit(","), text("length", r), F.lit(","), text("period", r), F.lit("\n")))
    first = "_longest"
    return found.withColumn(first, ranked).withColumns({
        "n_runs": F.size(all_runs).cast("long"),
        "start": F.col(f"{first}.s"),
        "length": -F.col(f"{first}.l"),
        "period": F.col(f"{first}.p"),
        "exponent_milli": F.expr(f"-1000 * {first}.l div {first}.p"),
        "runs_sha256": F.sha2(F.array_join(lines, "").cast("binary"), 256),
        "collapsed_sha256": F.sha2(F.col(collapsed_col).cast("binary"), 256),
    }).drop(first)
