"""Benchmark decontamination with a generalised suffix automaton.

The words of all benchmark items go into one suffix automaton. A document's
words stream through it; at each word the automaton gives the longest run of
words ending there that stands in some item. Where the run reaches a window
(``window`` consecutive item words; a whole item if it has fewer) the window's
words are hit and its items are noted. Words that no item holds, and word pairs
that no item holds side by side, are sorted out beforehand with numpy, so that
only stretches long enough for a window are streamed.

Items are taken in blocks of about ``BLOCK_WORDS`` words, by a hash: a block is
small enough to be sent to every task, and each block is one pass over the
documents. A very long item is cut into segments that overlap by a window less
one word, which loses no window.

Cases: a null or empty text has no words and no hits; an item without words has
no window; repeated items and item ids count once; an item with a null id makes
hits but is not listed; without items nothing is hit.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common, words

WINDOW = 13
#: Item words sent to the tasks at once.
BLOCK_WORDS = 100_000
#: Words of one segment of an item.
SEGMENT_WORDS = 20_000


class Automaton:
    """Suffix automaton of several word sequences; root 0, ``link[0]`` is -1."""

    def __init__(self, sequences: list[list[bytes]]) -> None:
        self.vocab: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        pairs: set[tuple[int, int]] = set()
        self.sequences = []
        for sequence in sequences:
            ids = [self.vocab.setdefault(w, len(self.vocab)) for w in sequence]
            pairs.update(zip(ids, ids[1:], strict=False))
            last = 0
            for c in ids:
                last = self._extend(last, c)
            self.sequences.append(ids)
        self.pairs = np.unique(np.array([a * len(self.vocab) + b for a, b in pairs], np.int64))

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.length.append(length)
        self.link.append(link)
        self.next.append(following)
        return len(self.length) - 1

    def _extend(self, last: int, c: int) -> int:
        """Appends a word to the sequence that ends in state ``last``."""
        if c in self.next[last]:  # another sequence has been here
            q = self.next[last][c]
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, c)
        new, p = self._state(self.length[last] + 1, 0, {}), last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, c)
        return new

    def _split(self, p: int, q: int, c: int) -> int:
        """Takes the shorter sequences of state ``q``, those through ``p``, out of it."""
        clone = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = clone
            p = self.link[p]
        return clone

    def step(self, state: int, length: int, c: int) -> tuple[int, int]:
        """The longest suffix of the match so far and ``c`` that some sequence holds."""
        while state and c not in self.next[state]:
            state = self.link[state]
            length = self.length[state]
        found = self.next[state].get(c)
        return (0, 0) if found is None else (found, length + 1)

    def of_length(self, state: int, length: int) -> int:
        """The state of the match's last ``length`` words."""
        while self.length[self.link[state]] >= length:
            state = self.link[state]
        return state


class Matcher:
    """Windows of items by (automaton state, length), and the scan of a document."""

    def __init__(self, segments: list[tuple[str | None, str, bool]], window: int) -> None:
        """``segments``: item id, its words joined by blanks, whether it is a whole item."""
        split = [(i, s.encode("utf-8", "surrogatepass").split(b" "), whole) for i, s, whole in segments]
        self.automaton = a = Automaton([w for _, w, _ in split])
        found: dict[tuple[int, int], set[str]] = {}
        for (item, _, whole), ids in zip(split, a.sequences, strict=True):
            size = min(window, len(ids)) if whole else window
            state = length = 0
            for c in ids:
                state, length = a.step(state, length, c)
                if length >= size:
                    found.setdefault((a.of_length(state, size), size), set()).add(item)
        self.windows = {k: sorted(i for i in v if i is not None) for k, v in found.items()}
        self.sizes = sorted({k for _, k in found})

    def stretches(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Where consecutive words may hold a window."""
        least = self.sizes[0]
        fits = ids >= 0
        if least == 1:
            edges = np.flatnonzero(np.diff(np.concatenate(([0], fits.view(np.int8), [0]))))
            return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
        pairs = self.automaton.pairs
        keys = ids[:-1] * len(self.automaton.vocab) + ids[1:]
        near = np.flatnonzero(fits[:-1] & fits[1:])
        at = np.minimum(np.searchsorted(pairs, keys[near]), len(pairs) - 1)
        side = np.zeros(len(keys), np.int8)
        side[near[pairs[at] == keys[near]]] = 1
        edges = np.flatnonzero(np.diff(np.concatenate(([0], side, [0]))))
        return [(s, e + 1) for s, e in zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True) if e + 1 - s >= least]

    def scan(self, ids: np.ndarray) -> tuple[list[tuple[int, int]], set[str]]:
        """Hit spans of the words, joined and in order, and the items found."""
        spans: list[tuple[int, int]] = []
        items: set[str] = set()
        a = self.automaton
        for start, end in self.stretches(ids):
            state = length = 0
            for i in range(start, end):
                state, length = a.step(state, length, int(ids[i]))
                for size in self.sizes:
                    if size > length:
                        break
                    window = self.windows.get((a.of_length(state, size), size))
                    if window is not None:
                        items.update(window)
                        spans.append((i + 1 - size, i + 1))
        return joined(spans), items


def joined(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The union of spans, as spans in order that do not touch."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _segments(items: DataFrame, window: int) -> DataFrame:
    """``item_id, words, whole``: the words of each item, long ones in overlapping segments."""

    def run(batches):
        for batch in batches:
            rows = []
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                split = words.split(text or "")
                step = SEGMENT_WORDS - window + 1
                for start in range(0, max(len(split) - window + 1, 1) if split else 0, step):
                    part = split[start : start + SEGMENT_WORDS]
                    rows.append((item, b" ".join(part).decode("utf-8", "surrogatepass"), len(part) == len(split)))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.string(), pa.string(), pa.bool_()))],
                names=["item_id", "words", "whole"],
            )

    return items.select(F.col("item_id").cast("string"), "text").mapInArrow(run, "item_id string, words string, whole boolean")


#: The matcher that a worker built last, by the name of its block.
_MATCHERS: dict[str, Matcher] = {}


def _scan_block(docs: DataFrame, segments, window: int, text_col: str, first: bool) -> DataFrame:
    span = T.StructType([T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType())])
    fields = [
        T.StructField("n_words", T.LongType()),
        T.StructField("hits", T.ArrayType(span)),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
    name = uuid.uuid4().hex

    def make():
        if name not in _MATCHERS:
            _MATCHERS.clear()
            _MATCHERS[name] = Matcher(segments.value, window)
        matcher = _MATCHERS[name]
        get = matcher.automaton.vocab.get

        def compute(part: pa.RecordBatch) -> list[pa.Array]:
            counts, hits, items = [], [], []
            before = None if first else part.select(["hits", "items"]).to_pylist()
            for k, text in enumerate(common.texts_of(part, text_col)):
                split = words.split(text)
                counts.append(len(split))
                spans, found = [], set()
                if split and matcher.sizes:
                    spans, found = matcher.scan(np.array([get(w, -1) for w in split], np.int64))
                if before:
                    spans = joined(spans + [(x["start"], x["end"]) for x in before[k]["hits"]])
                    found |= set(before[k]["items"])
                hits.append([{"start": s, "end": e} for s, e in spans])
                items.append(sorted(found))
            kinds = [pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.list_(pa.string())]
            return [pa.array(x, t) for x, t in zip((counts, hits, items), kinds, strict=True)]

        return compute

    return common.with_arrow_columns(docs, text_col, fields, make)


def find_hits(docs: DataFrame, items: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """Appends ``n_words``, ``hits`` (word spans, end exclusive) and ``items`` (ids as strings)."""
    spark = docs.sparkSession
    segments = _segments(items, window).distinct()
    total = segments.agg(F.sum(F.size(F.split("words", " ")))).first()[0] or 0
    blocks = max(1, -(-total // BLOCK_WORDS))
    for block in range(blocks):
        own = segments if blocks == 1 else segments.where(F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks)) == block)
        sent = spark.sparkContext.broadcast([tuple(r) for r in own.collect()])
        docs = _scan_block(docs, sent, window, text_col, block == 0)
        if block + 1 < blocks:
            docs = common.shared_table(docs, "decontam")
    return docs


def n_hit() -> Column:
    return F.aggregate("hits", F.lit(0).cast("long"), lambda s, x: s + (x["end"] - x["start"]))


def contaminated(least_percent: int = 5) -> Column:
    """Is at least this share of the words hit?"""
    return (n_hit() > 0) & (F.lit(100) * n_hit() >= F.lit(least_percent) * F.col("n_words"))


def remove_spans(scanned: DataFrame, text_col: str = "text", longest: int = WINDOW, coverage: float = 0.5) -> DataFrame:
    """Cuts out the hit spans of at least ``longest`` words; a text whose hits cover
    more than ``coverage`` of its words becomes empty."""

    def make():
        def compute(part: pa.RecordBatch) -> list[pa.Array]:
            out = []
            texts = part.column(part.schema.get_field_index(text_col)).to_pylist()
            rows = part.select(["hits", "n_words"]).to_pylist()
            for text, row in zip(texts, rows, strict=True):
                spans = [(x["start"], x["end"]) for x in row["hits"]]
                if text and spans:
                    if sum(e - s for s, e in spans) > coverage * row["n_words"]:
                        text = ""
                    else:
                        raw, at, kept, pos = text.encode("utf-8", "surrogatepass"), words.byte_spans(text), [], 0
                        for s, e in spans:
                            if e - s >= longest:
                                kept.append(raw[pos : at[s][0]])
                                pos = at[e - 1][1]
                        text = b"".join([*kept, raw[pos:]]).decode("utf-8", "surrogatepass")
                out.append(text)
            return [pa.array(out, pa.string())]

        return compute

    return common.with_arrow_columns(scanned, text_col, [T.StructField(text_col, T.StringType())], make).select(scanned.columns)
