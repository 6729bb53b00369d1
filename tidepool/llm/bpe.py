"""Byte-pair encoding and decoding by speculation and verification.

A word's tokens are first *proposed* by greedy longest match. The proposal is
the true encoding exactly when every token encodes to itself and every adjacent
pair of tokens is compatible, that is, encoding the two texts joined gives the
two tokens back. Pairs are checked for a whole batch at once with numpy (walks
down the merge trees of both sides, all pairs in step); only words with a failing
pair are merged exactly, merge by merge.

Supported model: the ``BPE`` model of a tokenizers JSON file with byte-level
symbols, an optional end-of-word suffix, the NFC / white space / lower case
normalisers, and a split pattern whose pieces hold no white space. ``load``
refuses other files. Special tokens in a text become their ids, as the library
does.

Cases: null or empty text gives no tokens; ids outside the vocabulary and nulls
in an id list decode to nothing; a null id list decodes to the empty text.
"""

from __future__ import annotations

import heapq
import json
import re
import struct
import unicodedata
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from . import common

#: Entries of a worker's caches before they are emptied (about 200 bytes each): encoded
#: words, stretches between white space, and checked pairs of tokens.
WORD_ENTRIES, STRETCH_ENTRIES, PAIR_ENTRIES = 650_000, 325_000, 250_000
_INF = np.int64(1) << 40
_NEVER = 1 << 40


def byte_symbols() -> list[str]:
    """The printable symbol of each byte in byte-level vocabularies."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    out = {b: chr(b) for b in plain}
    for b in range(256):
        if b not in out:
            out[b] = chr(256 + len(out) - len(plain))
    return [out[b] for b in range(256)]


@dataclass
class Model:
    """Vocabulary, merge ranks and the two children of every merged token."""

    vocab: dict[str, int]
    suffix: str
    pattern: regex.Pattern
    specials: dict[str, int]
    names: dict[int, str]
    rank: np.ndarray
    left: np.ndarray
    right: np.ndarray
    pair_keys: np.ndarray
    pair_ranks: np.ndarray
    merges: dict[tuple[int, int], tuple[int, int]]
    longest: int
    reach: dict[str, int]  # length of the longest token that begins with two symbols
    words: dict[str, bytes] = field(default_factory=dict)
    chunks: dict[str, bytes] = field(default_factory=dict)
    checked: dict[int, bool] = field(default_factory=dict)
    itself: dict[int, bool] = field(default_factory=dict)
    counts: dict[str, int] = field(default_factory=lambda: {"words": 0, "failing": 0})


_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]


def load(path: str) -> Model:
    with open(path, encoding="utf-8") as f:
        t = json.load(f)
    m, pre = t["model"], (t["pre_tokenizer"] or {}).get("pretokenizers", [])
    supported = (
        m["type"] == "BPE" and m["unk_token"] is None and not m["ignore_merges"] and not m["continuing_subword_prefix"]
        and (t["normalizer"] or {}).get("normalizers") == _NORMALIZER and [p["type"] for p in pre] == ["Split", "ByteLevel"]
        and pre[0]["behavior"] == "Removed" and pre[0]["invert"] and not pre[1]["use_regex"] and not pre[1]["add_prefix_space"]
        and t["post_processor"] is None and t["decoder"] is None
    )
    if not supported:
        raise ValueError(f"{path}: not a lower-casing byte-level BPE file with word ends")
    vocab, suffix = m["vocab"], m["end_of_word_suffix"] or ""
    merges: dict[tuple[int, int], tuple[int, int]] = {}
    size = max(vocab.values()) + 1
    rank = np.full(size, -1, np.int64)
    left, right = np.arange(size), np.arange(size)
    for r, (a, b) in enumerate(m["merges"]):
        x, y, z = vocab[a], vocab[b], vocab[a + b]
        merges[x, y] = (r, z)
        if rank[z] < 0:
            rank[z], left[z], right[z] = r, x, y
    keys = np.array([x * size + y for x, y in merges], np.int64)
    ranks = np.array([r for r, _ in merges.values()], np.int64)
    order = np.argsort(keys)
    reach: dict[str, int] = {}
    for token in vocab:
        if not (suffix and token.endswith(suffix)):
            reach[token[:2]] = max(len(token), reach.get(token[:2], 0))
    specials = {x["content"]: x["id"] for x in t["added_tokens"]}
    return Model(
        vocab=vocab, suffix=suffix, pattern=regex.compile(pre[0]["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}")),
        specials=specials, names={i: s for s, i in {**vocab, **specials}.items()}, rank=rank, left=left, right=right,
        pair_keys=keys[order], pair_ranks=ranks[order], merges=merges, longest=max(map(len, vocab)), reach=reach,
    )


# --- proposing, checking, exact merging -------------------------------------------------


def propose(model: Model, word: str) -> list[int]:
    """Greedy longest match over the symbols of one word."""
    get, reach, closed, out, i, n = model.vocab.get, model.reach, word + model.suffix, [], 0, len(word)
    while i < n:
        last = get(closed[i:]) if n - i <= model.longest else None
        if last is not None:
            out.append(last)
            return out
        for j in range(min(n - 1, i + reach.get(word[i : i + 2], 1)), i, -1):
            t = get(word[i:j])
            if t is not None:
                out.append(t)
                i = j
                break
        else:
            return exact(model, word)
    return out


def exact(model: Model, word: str, suffix: str | None = None) -> list[int]:
    """Merge by merge: the lowest rank first, the leftmost of equals."""
    vocab, merges = model.vocab, model.merges
    ids = [vocab[s] for s in word[:-1] if s in vocab]
    last = vocab.get(word[-1] + (model.suffix if suffix is None else suffix))
    if last is not None:
        ids.append(last)
    if len(ids) > 40:
        return _exact_long(model, ids)
    get, none = merges.get, (_NEVER, 0)
    found = [get(p, none) for p in zip(ids, ids[1:], strict=False)]
    while found:
        best = min(found)
        if best is none:
            break
        i = found.index(best)
        t = ids[i] = best[1]
        del ids[i + 1], found[i]
        if i:
            found[i - 1] = get((ids[i - 1], t), none)
        if i < len(found):
            found[i] = get((t, ids[i + 1]), none)
    return ids


def _exact_long(model: Model, ids: list[int]) -> list[int]:
    """The same by a linked list and a heap: n log n for very long words."""
    n, merges = len(ids), model.merges
    after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
    heap = [(merges[p][0], i, p) for i in range(n - 1) if (p := (ids[i], ids[i + 1])) in merges]
    heapq.heapify(heap)
    while heap:
        _, i, pair = heapq.heappop(heap)
        j = after[i] if alive[i] else n
        if j >= n or (ids[i], ids[j]) != pair:
            continue
        ids[i], alive[j], after[i] = merges[pair][1], False, after[j]
        if after[i] < n:
            before[after[i]] = i
        for k in (before[i], i):
            if k >= 0 and after[k] < n and (p := (ids[k], ids[after[k]])) in merges:
                heapq.heappush(heap, (merges[p][0], k, p))
    return [t for t, a in zip(ids, alive, strict=True) if a]


def compatible(model: Model, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """For each pair of tokens: does no merge ever cross their border?

    Going back in merge time, the border lies between a token on the right edge
    of ``first`` and one on the left edge of ``second``. Such a state lasts until
    the earlier of the two merges that make their parents; if the merge of the
    two has a lower rank than that, it comes first and the pair is not
    compatible. At equal rank the leftmost goes first: the parent of ``first``
    before the border, the border before the parent of ``second``.
    """
    size = len(model.rank)
    a, b = first.astype(np.int64).copy(), second.astype(np.int64).copy()
    until_a, until_b = np.full(len(a), _INF), np.full(len(a), _INF)
    good, open_ = np.ones(len(a), bool), np.arange(len(a))
    while len(open_):
        x, y = a[open_], b[open_]
        keys = x * size + y
        at = np.minimum(np.searchsorted(model.pair_keys, keys), len(model.pair_keys) - 1)
        merge = np.where(model.pair_keys[at] == keys, model.pair_ranks[at], _INF)
        crossed = (merge < until_a[open_]) & (merge <= until_b[open_]) & (merge < _INF)
        good[open_[crossed]] = False
        rx, ry = model.rank[x], model.rank[y]
        done = crossed | ((rx < 0) & (ry < 0))
        back_a = ~done & (rx > ry)  # of equal ranks the later in the text was made last
        back_b = ~done & ~back_a
        i = open_[back_a]
        until_a[i], a[i] = rx[back_a], model.right[x[back_a]]
        i = open_[back_b]
        until_b[i], b[i] = ry[back_b], model.left[y[back_b]]
        open_ = open_[~done]
    return good


def _pack(ids: list[int]) -> bytes:
    """Ids as little-endian 32-bit integers."""
    return struct.pack(f"<{len(ids)}i", *ids)


def _encode_words(model: Model, words: list[str]) -> None:
    """Adds the words to the cache: all proposals at once, failing ones exactly."""
    proposals = [propose(model, w) for w in words]
    counts = np.fromiter(map(len, proposals), np.int64, len(words))
    flat = np.fromiter(chain.from_iterable(proposals), np.int64, int(counts.sum()))
    owner = np.repeat(np.arange(len(words)), counts)
    bad = np.zeros(len(words), bool)
    for t in np.unique(flat).tolist():  # tokens that do not encode to themselves
        if t not in model.itself:
            name = model.names[t]
            ends = bool(model.suffix) and name.endswith(model.suffix)
            symbols = name.removesuffix(model.suffix) if ends else name
            model.itself[t] = exact(model, symbols, model.suffix if ends else "") == [t]
    odd = np.array([t for t in np.unique(flat).tolist() if not model.itself[t]], np.int64)
    if len(odd):
        bad[owner[np.isin(flat, odd)]] = True
    inside = owner[:-1] == owner[1:]
    keys = (flat[:-1] * len(model.rank) + flat[1:])[inside]
    pairs, back = np.unique(keys, return_inverse=True)
    known = np.array([model.checked.get(k, -1) for k in pairs.tolist()], np.int8)
    new = known < 0
    if new.any():
        fresh = pairs[new]
        known[new] = compatible(model, fresh // len(model.rank), fresh % len(model.rank))
        if len(model.checked) > PAIR_ENTRIES:
            model.checked.clear()
        model.checked.update(zip(fresh.tolist(), known[new].astype(bool).tolist(), strict=True))
    if len(pairs):
        bad[owner[:-1][inside][known[back] == 0]] = True
    model.counts["words"] += len(words)
    model.counts["failing"] += int(bad.sum())
    for w, p, fails in zip(words, proposals, bad.tolist(), strict=True):
        model.words[w] = _pack(exact(model, w) if fails else p)


# --- whole texts ------------------------------------------------------------------------


_SYMBOLS = byte_symbols()
_PYTHON_ONLY_SPACES = re.compile("[\x1c-\x1f]")
_SPACES = regex.compile(r"\p{White_Space}+")


def normalize(text: str) -> str:
    # lower case goes character by character: a final capital sigma is an ordinary one
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


def pieces_of(model: Model, chunk: str) -> list[str | int]:
    """Symbols of the words of a text without white space; special tokens as ids."""
    if chunk.isascii():
        low = chunk.lower()
        if low.isalpha():
            return [low]
    out: list[str | int] = []
    parts = regex.split("(" + "|".join(map(regex.escape, model.specials)) + ")", chunk) if "<|" in chunk else [chunk]
    for part in parts:
        if part in model.specials:
            out.append(model.specials[part])
        else:
            found = model.pattern.findall(normalize(part))
            out += [w if w.isascii() and w.isprintable() else "".join([_SYMBOLS[b] for b in w.encode()]) for w in found]
    return out


def encode_texts(model: Model, texts: list[str]) -> list[bytes]:
    """Ids of each text as little-endian 32-bit integers."""
    split = [_SPACES.split(t) if _PYTHON_ONLY_SPACES.search(t) else t.split() for t in texts]
    if len(model.chunks) > STRETCH_ENTRIES:
        model.chunks.clear()
    if len(model.words) > WORD_ENTRIES:
        model.words.clear()
    chunks = model.chunks
    missing = set().union(*split).difference(chunks)
    if missing:
        pieces = {c: pieces_of(model, c) for c in missing}
        words = {w for p in pieces.values() for w in p if isinstance(w, str)}.difference(model.words)
        if words:
            _encode_words(model, list(words))
        for c, p in pieces.items():
            chunks[c] = b"".join(model.words[w] if isinstance(w, str) else _pack([w]) for w in p)
    return [b"".join([chunks[c] for c in s]) for s in split]


_MODELS: dict[str, Model] = {}


def model_of(path: str) -> Model:
    """The model of a file, loaded once per Python worker."""
    if path not in _MODELS:
        _MODELS[path] = load(path)
    return _MODELS[path]


def _encoder(path: str, text_col: str):
    """From a slice of rows to the token ids of their texts."""
    model = model_of(path)

    def compute(part: pa.RecordBatch) -> pa.ListArray:
        ids = encode_texts(model, common.texts_of(part, text_col))
        offsets = np.zeros(len(ids) + 1, np.int32)
        np.cumsum([len(x) // 4 for x in ids], out=offsets[1:])
        values = pa.array(np.frombuffer(b"".join(ids), "<i4"))
        return pa.ListArray.from_arrays(pa.array(offsets), values)

    return compute


def _decoder(path: str):
    """From lists of token ids to their texts."""
    model = model_of(path)
    names = np.empty(max(model.names) + 2, object)
    for i, s in model.names.items():
        names[i] = s

    def compute(column: pa.Array) -> pa.Array:
        out = []
        for k in range(len(column)):
            ids = column[k].values
            ids = np.zeros(0, np.int64) if ids is None else ids.drop_null().to_numpy(zero_copy_only=False)
            found = names[np.where((ids >= 0) & (ids < len(names) - 1), ids, len(names) - 1)].tolist()
            out.append(" ".join(found if None not in found else [s for s in found if s is not None]))
        return pa.array(out, pa.string())

    return compute


_IDS = T.ArrayType(T.IntegerType())


def encode(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """Appends the token ids of whole texts as ``array<int>``."""

    def make():
        own = _encoder(path, text_col)
        return lambda part: [own(part)]

    return common.with_arrow_columns(df, text_col, [T.StructField(ids_col, _IDS)], make)


def decode(df: DataFrame, path: str, ids_col: str = "ids", text_col: str = "decoded") -> DataFrame:
    """Appends the text of the ids, special tokens kept: the files that ``load``
    takes name no decoder, so the library joins the token names by one space."""

    def make():
        own = _decoder(path)
        return lambda part: [own(part.column(part.schema.get_field_index(ids_col)))]

    return common.with_arrow_columns(df, ids_col, [T.StructField(text_col, T.StringType())], make)


def round_trip(df: DataFrame, path: str, text_col: str = "text", ids_col: str = "ids", decoded_col: str = "decoded") -> DataFrame:
    """``encode`` and ``decode`` in one pass: one Python worker a task instead of two, and one model."""

    def make():
        forth, back = _encoder(path, text_col), _decoder(path)

        def compute(part: pa.RecordBatch) -> list[pa.Array]:
            ids = forth(part)
            return [ids, back(ids)]

        return compute

    fields = [T.StructField(ids_col, _IDS), T.StructField(decoded_col, T.StringType())]
    return common.with_arrow_columns(df, text_col, fields, make)
