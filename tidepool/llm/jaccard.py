"""N-gram Jaccard join by parity sketches, and its connected components.

Each text becomes the set of its distinct five-word shingles (A-Z lower-cased,
words between blanks and control spaces; fewer words: the whole sequence as one
shingle; no words: the empty set). Two texts link when their sets' Jaccard
similarity reaches the threshold, 0.8 by default.

*Sketch.* Every shingle flips one bit of a wide bit sketch, so the exclusive or of
two sketches is the sketch of the sets' symmetric difference, and their Hamming
distance is a lower bound of its size. Sets of ``n <= m`` shingles that link differ
in ``d = floor((n + m) / 9)`` shingles at most, and ``m <= 1.25 n``.

*Pigeonhole.* Sizes fall into bands (each four times the last), and the band
gives the number of blocks that the sketch is cut into, more than ``d`` for each of
its sizes. A block whose bits differ takes at least one differing shingle, so two
linked sketches differ in ``d`` blocks at most. With the blocks of a sketch in an
order that both sides share (more set bits first, as those are rarest), the
first ``d + 1`` blocks of one side and of the other have one in common. These are
the join keys; a set near the end of its band also gives keys for the next.

*Verification.* Pairs that share a key and whose sketches, folded to a bit a shingle
(512 at least), differ in no more than ``d`` bits, are verified on the exact sets
(64-bit hashes).

*Groups.* Equal sets are one node. To find components without all pairs of a
group, each key first pairs its smallest node with the others. Then, in ``ROUNDS``
rounds, only nodes of one key that are still in different components are compared,
sketch by sketch inside tasks, in blocks of at most ``BLOCK`` nodes; each node gives its nearest
one alone, at most one pair a row, and the pairs are verified and joined. What the sketches
still allow between different components after that is verified whole. Every
linked pair is thus either verified or within one component.

Cases: null and empty texts have no shingles, link with nothing and are their own
component; repeated rows come back repeated; rows with the same id and different
texts are compared like any two texts. A null id never names a component unless
all its ids are null.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

WORDS = 5
#: Bits of the smallest folded sketch, as so many 64-bit words.
FOLD = 8
#: Nodes of one key compared at once.
BLOCK = 512
#: Rounds in which each node's nearest one is verified.
ROUNDS = 1
#: Pairs that a task remembers to have given already.
GIVEN = 50_000
#: Ids (8 bytes each) that may be sent to all tasks instead of shuffling texts.
SENT_IDS = 1_000_000
#: Nodes whose keys a task remembers to have given already.
REMEMBERED = 200_000
#: Bands: sizes from FIRST * 4**k; blocks for each size at the band's start.
FIRST, BAND, BLOCKS = 4, 4, 1.15

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_SPACE = np.array([b == 32 or 9 <= b <= 13 for b in range(256)])
_ODD = np.array([0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    """Spreads 64 bits over 64 bits, one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * _ODD[1]
    x = x ^ (x >> np.uint64(27))
    x = x * _ODD[2]
    return x ^ (x >> np.uint64(31))


def _words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word and the number of words of each text."""
    raw = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = np.frombuffer((b"\n".join(raw) + b"\n").translate(_LOWER), np.uint8)
    space = _SPACE[data]
    inside = np.flatnonzero(~space)
    if not len(inside):
        return np.zeros(0, np.uint64), np.zeros(len(texts), np.int64)
    first = np.concatenate(([True], np.diff(inside) > 1))
    starts = np.flatnonzero(first)
    sizes = np.diff(np.concatenate((starts, [len(inside)])))
    place = np.arange(len(inside)) - np.repeat(starts, sizes)
    power = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(int(sizes.max()), _ODD[0], np.uint64))))
    hashed = np.add.reduceat((data[inside].astype(np.uint64) + np.uint64(1)) * power[place], starts)
    ends = np.cumsum([len(r) + 1 for r in raw])
    counts = np.diff(np.concatenate(([0], np.searchsorted(inside[starts], ends))))
    return _mix(hashed + sizes.astype(np.uint64) * _ODD[3]), counts


def shingle_sets(texts: list[str]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each text."""
    words, counts = _words(texts)
    runs = np.zeros(max(len(words) - WORDS + 1, 0), np.uint64)
    for k in range(WORDS):
        runs += _mix(words[k : k + len(runs)] + np.uint64(k + 1)) * _ODD[k % len(_ODD)]
    runs = _mix(runs)
    out, at = [], 0
    for n in counts.tolist():
        if n >= WORDS:
            out.append(np.unique(runs[at : at + n - WORDS + 1]))
        elif n:
            whole = sum((int(w) * (2 * k + 3) for k, w in enumerate(words[at : at + n])), 7 * n) & (2**64 - 1)
            out.append(_mix(np.array([whole], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def band_of(n: int) -> int:
    """The band of a set size (from FIRST)."""
    k = 0
    while n >= FIRST * BAND ** (k + 1):
        k += 1
    return k


def keys_of(shingles: np.ndarray, threshold: float) -> np.ndarray:
    """The join keys of a set: its first ``d + 1`` sketch blocks in each band it meets."""
    n = len(shingles)
    most = difference(n, int(n / threshold + 1e-9), threshold)
    if n == 0 or most == 0:  # linked with equal sets only
        return np.zeros(0, np.uint64)
    out = []
    for band in sorted({band_of(max(n, FIRST)), band_of(max(int(n / threshold + 1e-9), FIRST))}):
        # blocks exceed the largest difference of the band: (1 - t) / (1 + t) * (1 + 1 / t) * size
        share = (1 - threshold) / threshold
        blocks = int(BLOCKS * FIRST * BAND ** (band + 1) * share) + 3
        block = ((shingles >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)
        starts = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
        held = block[starts]
        bits = np.diff(np.concatenate((starts, [n])))
        parity = np.bitwise_xor.reduceat(_mix(shingles), starts)
        if most + 1 > len(held):  # blocks without a set bit come last
            empty = np.setdiff1d(np.arange(blocks, dtype=np.uint64), held, assume_unique=True)
            held = np.concatenate((held, empty))
            bits = np.concatenate((bits, np.zeros(len(empty), bits.dtype)))
            parity = np.concatenate((parity, np.zeros(len(empty), np.uint64)))
        key = _mix(parity ^ _mix(held * _ODD[4] + np.uint64(band + 1)))
        out.append(key[np.lexsort((key, -bits))[: most + 1]])
    return np.concatenate(out)


def difference(n: int, m: int, threshold: float) -> int:
    """The largest symmetric difference of linked sets of these sizes."""
    return int((1 - threshold) / (1 + threshold) * (n + m) + 1e-9)


def folded(shingles: np.ndarray) -> np.ndarray:
    """The sketch folded to the next power of two over the set's size: bit counts modulo 2."""
    bits = max(64 * FOLD, 1 << max(len(shingles) - 1, 0).bit_length())
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.uint64)


def halved(sketches: np.ndarray) -> np.ndarray:
    """The sketches folded once more (one a row)."""
    half = sketches.shape[1] // 2
    return sketches[:, :half] ^ sketches[:, half:]


def _node(shingles: np.ndarray) -> int:
    """A 64-bit name of a set: equal sets, equal names."""
    total = (int(_mix(shingles).sum(dtype=np.uint64)) + len(shingles) * int(_ODD[3])) & (2**64 - 1)
    return int(_mix(np.array([total], np.uint64) ^ np.bitwise_xor.reduce(shingles))[0].view(np.int64))


def _longs(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.zeros(len(arrays) + 1, np.int32)
    np.cumsum([len(a) for a in arrays], out=offsets[1:])
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


_LONG, _LONGS = T.LongType(), T.ArrayType(T.LongType())


def sketched(docs: DataFrame, text_col: str, threshold: float) -> DataFrame:
    """Appends ``n_shingles``, ``node``, and once per node and task ``keys`` and ``sketch``."""
    fields = [T.StructField("n_shingles", _LONG), T.StructField("node", _LONG), T.StructField("keys", _LONGS), T.StructField("sketch", _LONGS)]

    def make():
        given: set[int] = set()
        none = np.zeros(0, np.uint64)

        def compute(part: pa.RecordBatch) -> list[pa.Array]:
            sets = shingle_sets(common.texts_of(part, text_col))
            nodes = [_node(s) if len(s) else None for s in sets]
            keys, sketches = [], []
            if len(given) > REMEMBERED:
                given.clear()
            for node, s in zip(nodes, sets, strict=True):
                new = node is not None and node not in given
                given.add(node)
                keys.append(keys_of(s, threshold) if new else none)
                sketches.append(folded(s) if len(keys[-1]) else none)
            return [pa.array([len(s) for s in sets], pa.int64()), pa.array(nodes, pa.int64()), _longs(keys), _longs(sketches)]

        return compute

    return common.with_arrow_columns(docs, text_col, fields, make)


def _may_link(threshold: float) -> Column:
    """Do sizes and folded sketches of the sides ``a`` and ``b`` allow a link?

    Sizes that do differ by a factor below two, so their sketches by one fold at most."""
    n, m = F.col("a.n"), F.col("b.n")
    width = F.least(F.size("a.sketch"), F.size("b.sketch"))

    def folded_to(c: str) -> Column:
        halves = F.zip_with(F.slice(c, F.lit(1), width), F.slice(c, width + 1, width), lambda x, y: x.bitwiseXOR(y))
        return F.when(F.size(c) == width, F.col(c)).otherwise(halves)

    differing = F.zip_with(folded_to("a.sketch"), folded_to("b.sketch"), lambda x, y: F.bit_count(x.bitwiseXOR(y)))
    apart = F.aggregate(differing, F.lit(0), lambda total, x: total + x)
    share = (1 - threshold) / (1 + threshold)
    return (F.least(n, m) >= F.greatest(n, m) * threshold - 1e-9) & (apart <= (n + m) * share + 1e-9)


def _filtered(pairs: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    both = pairs.join(nodes.select(F.col("node").alias("left"), F.struct("n", "sketch").alias("a")), "left")
    both = both.join(nodes.select(F.col("node").alias("right"), F.struct("n", "sketch").alias("b")), "right")
    return both.where(_may_link(threshold)).select("left", "right")


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose exact sets reach the similarity: 100 i >= percent * union."""
    right = sets.select(F.col("node").alias("right"), F.col("shingles").alias("b"))
    left = sets.select(F.col("node").alias("left"), F.col("shingles").alias("a"))
    common_ = F.size(F.array_intersect("a", "b"))
    union = F.size("a") + F.size("b") - common_
    return pairs.join(right, "right").join(left, "left").where(100 * common_ >= percent * union).select("left", "right")


def _sets(docs: DataFrame, reps: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``node, shingles`` of the nodes in ``reps`` (node, rep: an id that holds it)."""
    ids = reps.select(F.col("rep").alias("_rep")).distinct()
    if ids.count() <= SENT_IDS:
        ids = F.broadcast(ids)
    own = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    own = own.join(ids, F.col("_id").eqNullSafe(F.col("_rep")), "left_semi").select("_text")
    fields = [T.StructField("node", _LONG), T.StructField("shingles", _LONGS)]

    def make():
        def compute(part: pa.RecordBatch) -> list[pa.Array]:
            sets = shingle_sets(common.texts_of(part, "_text"))
            return [pa.array([_node(s) if len(s) else None for s in sets], pa.int64()), _longs(sets)]

        return compute

    found = common.with_arrow_columns(own, "_text", fields, make).drop("_text")
    return found.join(reps.select("node"), "node", "left_semi").dropDuplicates(["node"])


def components(links: DataFrame) -> DataFrame:
    """``node, root`` of the nodes in ``links`` (left, right), root the smallest node.

    Large-star and small-star steps in turn, each one aggregation and join, until
    every edge leads to a root.
    """
    edges = links.select(F.greatest("left", "right").alias("u"), F.least("left", "right").alias("v")).where("u <> v").distinct()
    before = None
    while True:
        edges = common.shared_table(edges, "edges")
        state = edges.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if before == (state["n"], state["s"]):
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = (state["n"], state["s"])
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = small.union(least.select("u", F.col("m").alias("v"))).distinct()


class _Group:
    """Nodes of one key and block: sizes, roots, names, and sketches by width."""

    def __init__(self, n: np.ndarray, root: np.ndarray, node: np.ndarray, sketches: list[np.ndarray], threshold: float):
        self.n, self.root, self.node, self.threshold = n, root, node, threshold
        self.share = (1 - threshold) / (1 + threshold)
        width = np.array([len(s) for s in sketches])
        self.by_width = {w: (at := np.flatnonzero(width == w), np.stack([sketches[k] for k in at])) for w in np.unique(width).tolist()}

    def close(self):
        """Places and distances, in shares of the two sizes, of the pairs that may link and lie in different components."""
        for w, (at, bits) in self.by_width.items():
            yield from self._between(at, bits, at, bits, True)
            if 2 * w in self.by_width:
                other, wide = self.by_width[2 * w]
                yield from self._between(at, bits, other, halved(wide), False)

    def _between(self, at, bits, other, other_bits, same: bool):
        n, root, t = self.n, self.root, self.threshold
        for start in range(0, len(at), 64):
            part, later = at[start : start + 64], other[start:] if same else other
            x, y = part[:, None], later[None, :]
            fits = (root[x] != root[y]) & (np.minimum(n[x], n[y]) >= np.maximum(n[x], n[y]) * t - 1e-9)
            if same:
                fits &= x < y
            i, j = np.nonzero(fits)
            for k in range(0, len(i), 4096):  # sketches of few pairs at once
                a, b = i[k : k + 4096], j[k : k + 4096]
                apart = np.bitwise_count(bits[start + a] ^ other_bits[(start if same else 0) + b]).sum(1)
                a, b = part[a], later[b]
                close = apart <= (n[a] + n[b]) * self.share + 1e-9
                yield a[close], b[close], apart[close] / (n[a] + n[b])[close]

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        found = [(self.node[a], self.node[b]) for a, b, _ in self.close()]
        return tuple(np.concatenate([f[k] for f in found] + [np.zeros(0, np.int64)]) for k in (0, 1))

    def nearest(self) -> tuple[np.ndarray, np.ndarray]:
        """For each node with any such pair, the one of least distance."""
        least, partner = np.full(len(self.n), np.inf), np.full(len(self.n), -1)
        for a, b, apart in self.close():
            for x, y in ((a, b), (b, a)):
                order = np.lexsort((y, -apart))  # the least distance is written last
                order = order[apart[order] < least[x[order]]]
                least[x[order]], partner[x[order]] = apart[order], y[order]
        own = np.flatnonzero(partner >= 0)
        return self.node[own], self.node[partner[own]]


def _across(rows: DataFrame, threshold: float, nearest: bool) -> DataFrame:
    """Pairs of nodes that share a key, lie in different components and may link; of each
    node only that with the ``nearest`` one, if wanted.

    ``rows``: key, node, root, n, sketch and ``size``, the number of nodes of the key. A
    large key's nodes are dealt to blocks, and each pair of blocks is one group.
    """
    parts = F.ceil(F.col("size") / F.lit(BLOCK)).cast("int")
    own = F.pmod(F.xxhash64("node"), parts).cast("int")
    dealt = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    dealt = dealt.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))

    def run(batches):
        # groups follow each other in sorted rows; the last of a batch may go on in the next
        given: set[tuple[int, int]] = set()
        held, sketches = None, []

        def found(start: int, end: int) -> list[tuple[int, int]]:
            if end - start < 2:
                return []
            group = _Group(*[c[start:end] for c in held[3:]], sketches[start:end], threshold)
            x, y = group.nearest() if nearest else group.pairs()
            pairs = set(zip(np.minimum(x, y).tolist(), np.maximum(x, y).tolist(), strict=True)) - given
            if len(given) > GIVEN:
                given.clear()
            given.update(pairs)
            return list(pairs)

        for batch in batches:
            own = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(6)]
            lists = batch.column(6)
            flat, ends = np.asarray(lists.flatten()).view(np.uint64), np.cumsum(np.asarray(lists.value_lengths()))
            new = np.split(flat, ends[:-1]) if len(ends) else []
            held = own if held is None else [np.concatenate(pair) for pair in zip(held, own, strict=True)]
            sketches = sketches + new
            key = held[:3]
            starts = np.flatnonzero(np.concatenate(([True], np.any([k[1:] != k[:-1] for k in key], axis=0)))) if len(key[0]) else [0]
            yield named([p for s, e in zip(starts[:-1], starts[1:], strict=True) for p in found(s, e)])
            held, sketches = [c[starts[-1] :] for c in held], sketches[starts[-1] :]
        if held is not None:
            yield named(found(0, len(held[0])))

    def named(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
        columns = [pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)]
        return pa.RecordBatch.from_arrays(columns, names=["left", "right"])

    grouped = dealt.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").select("key", "i", "j", "n", "root", "node", "sketch")
    return common.arrow(grouped, run, "left long, right long").distinct()


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 80) -> DataFrame:
    """One row per input row: id, ``text_key`` (hash of the text), ``n_shingles``, ``node`` (equal
    sets, equal nodes), ``root``, the component's name (its smallest node; null without shingles), and
    ``component_id``, the smallest id of the component: no name, as ids may be null or repeat."""
    threshold = percent / 100
    source = docs.select(F.col(id_col), F.col(text_col).alias("_text"), F.xxhash64(text_col).alias("text_key"))
    rows = common.shared_table(sketched(source, "_text", threshold).drop("_text"), "sketches")
    keyed = rows.where(F.size("keys") > 0).select("node", F.explode("keys").alias("key"))
    ends = keyed.groupBy("key").agg(F.min("node").alias("first"), F.max("node").alias("last")).where("first <> last")
    shared = keyed.join(ends.select("key", "first"), "key").distinct()
    shared = common.shared_table(shared, "shared-keys")
    members = shared.select("node").distinct()
    nodes = rows.where(F.size("sketch") > 0).join(members, "node", "left_semi").groupBy("node").agg(
        F.min("n_shingles").alias("n"), F.min("sketch").alias("sketch"), F.min(id_col).alias("rep"))
    nodes = common.shared_table(nodes, "nodes")

    sets = None

    def verified(pairs: DataFrame) -> DataFrame:
        """The pairs' links; the sets of their nodes are read once for all rounds."""
        nonlocal sets
        ends_ = pairs.select(F.col("left").alias("node")).union(pairs.select(F.col("right").alias("node"))).distinct()
        missing = nodes.join(ends_, "node", "left_semi")
        if sets is not None:
            missing = missing.join(sets.select("node"), "node", "left_anti")
        new = common.shared_table(_sets(docs, missing.select("node", "rep"), id_col, text_col), "sets")
        sets = new if sets is None else sets.union(new)
        return common.shared_table(_verified(pairs, sets, percent), "links")

    stars = shared.where("node <> first").select(F.col("first").alias("left"), F.col("node").alias("right")).distinct()
    tested = common.shared_table(_filtered(stars, nodes, threshold), "pairs")
    roots = components(verified(tested))
    for nearest in [True] * ROUNDS + [False]:
        placed = shared.join(roots, "node", "left").select("key", "node", F.coalesce("root", "node").alias("root"))
        open_ = placed.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count("*").alias("size")).where("low <> high and size > 2")
        rest = placed.join(open_.select("key", "size"), "key").join(nodes.select("node", "n", "sketch"), "node")
        # written before the anti join: a pair of many keys counts once
        pairs = common.shared_table(_across(rest, threshold, nearest), "pairs")
        pairs = common.shared_table(pairs.join(tested, ["left", "right"], "left_anti"), "pairs")
        links = verified(pairs)
        if not links.isEmpty():
            roots = components(roots.select(F.col("node").alias("left"), F.col("root").alias("right")).union(links))
        tested = tested.union(pairs)

    named = rows.select(id_col, "text_key", "n_shingles", "node").join(roots, "node", "left")
    named = named.withColumn("root", F.coalesce("root", "node"))
    least = named.where(F.col("root").isNotNull()).groupBy("root").agg(F.min(id_col).alias("component_id"))
    named = named.join(least, "root", "left")
    alone = F.when(F.col("node").isNull(), F.col(id_col)).otherwise(F.col("component_id"))
    return named.select(id_col, "text_key", "n_shingles", "node", "root", alone.alias("component_id"))
