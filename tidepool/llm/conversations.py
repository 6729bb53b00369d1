"""Conversation structure repair: the cheapest edits by bidirectional Dijkstra.

The rows of a conversation, by turn (null turns first; equal turns by role, then by the
text's hash), become one whose role initials read ``(s?(ua)+)?``. Each row's first fault counts:
blank (no character but blanks), duplicate (its role and text came earlier in the conversation),
truncated (its last character that is no blank is none of ``.!?``). Edits: Keep costs 0, Rerole to
user or assistant 3, Delete 4 (the only edit of blank and duplicate rows), Insert of an empty
user or assistant row 3; a truncated row that is not deleted costs 3 more. The audit is the
edits' initials in order; of equally cheap audits the one that is ASCII-least is taken. It
fixes the repair: an odd number of rows left starts with a kept system row, and then
user and assistant take turns.

*Lattice.* Its nodes are (rows passed, state of the pattern), its arcs the edits. A forward
and a reverse heap meet: when their least costs exceed the best meeting together, every
cheapest path has an arc from a node settled forward to one settled in reverse. Least
prefixes and suffixes are then read off along tight arcs, and the least concatenation over
all such crossings is the audit. Taking the least at each node is right: two audits of equal
cost between the same two nodes cannot be one the other's beginning, since they would
differ by inserts only, which cost.

*Long conversations.* Rows without their texts are range-partitioned by conversation and
turn, so a conversation of any length is spread over tasks. Each task cuts its rows into
blocks of at most ``BLOCK`` rows and solves each for the states that it may begin and end in
(conversations that lie within a task: one search from start to end). Blocks chain: for
each state the cheapest, least audit so far. Equal rows of a turn are counted before
the shuffle; all but the first are deleted in one arc. The texts then stream past the audit
in order, one conversation in a task at a time (its digest has to be taken in order), with
nothing held but the audit.

Cases: null roles and texts count as one space; a null conversation is one of its own; a
role without an initial cannot be kept; repeated rows are duplicates; conversations without
rows have zeros and an empty audit; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import heapq
import os.path
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Rows of a block of the lattice.
BLOCK = 256
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

# States of (s?(ua)+)?: nothing yet, after the system row, after user, after assistant.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES, ENDS = (START, SYSTEM, USER, ASSISTANT), (START, ASSISTANT)
STEP = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER}
LEGAL = {("s", "u"), ("u", "a"), ("a", "u")}
_INFINITE = float("inf")


class Lattice:
    """Nodes (rows passed, state) of some rows: (role initial, must go, truncated, times)."""

    def __init__(self, rows: list[tuple[str, bool, bool, int]]):
        self.n = len(rows)
        moves = [(q, r) for (q, initial), r in STEP.items() if initial in "ua"]
        self.inserts = {q: [r for p, r in moves if p == q] for q in STATES}
        self.inserts_to = {r: [q for q, x in moves if x == r] for r in STATES}
        self.arcs, self.arcs_to = [], []
        for initial, gone, cut, times in rows:
            arcs = [(q, q, DELETE * times, "D" * times) for q in STATES]
            if not gone:
                more = TRUNCATED if cut else 0
                arcs += [(q, r, more, "K") for q in STATES if (r := STEP.get((q, initial))) is not None]
                arcs += [(q, r, REROLE + more, "R") for q, r in moves]
            self.arcs.append({q: [a[1:] for a in arcs if a[0] == q] for q in STATES})
            self.arcs_to.append({r: [(a[0], *a[2:]) for a in arcs if a[1] == r] for r in STATES})

    def after(self, node) -> Iterator[tuple[tuple[int, int], int, str]]:
        i, q = node
        for r in self.inserts[q]:
            yield (i, r), INSERT, "I"
        if i < self.n:
            for r, cost, edit in self.arcs[i][q]:
                yield (i + 1, r), cost, edit

    def before(self, node) -> Iterator[tuple[tuple[int, int], int, str]]:
        i, r = node
        for q in self.inserts_to[r]:
            yield (i, q), INSERT, "I"
        if i:
            for q, cost, edit in self.arcs_to[i - 1][r]:
                yield (i - 1, q), cost, edit


def cheapest(lattice: Lattice, entry: int, exits: tuple[int, ...]) -> tuple[int, str, int] | None:
    """Cost, audit and last state of the cheapest, then ASCII-least, way to one of the exits."""
    source, targets = (0, entry), [(lattice.n, q) for q in exits]
    cost = [{source: 0}, dict.fromkeys(targets, 0)]
    heaps = [[(0, source)], [(0, t) for t in targets]]
    arcs = [lattice.after, lattice.before]
    best = 0 if source in targets else _INFINITE
    while heaps[0] and heaps[1] and heaps[0][0][0] + heaps[1][0][0] <= best:
        side = 0 if heaps[0][0][0] <= heaps[1][0][0] else 1
        own, other, heap = cost[side], cost[1 - side], heaps[side]
        d, v = heapq.heappop(heap)
        if d > own[v]:
            continue
        for w, c, _ in arcs[side](v):
            if d + c < own.get(w, _INFINITE):
                own[w] = d + c
                heapq.heappush(heap, (d + c, w))
            if w in other:
                best = min(best, d + c + other[w])
    if best == _INFINITE:
        return None
    # nodes below the last heap tops are settled, and so are all nodes on their cheapest paths
    settled = [{v: d for v, d in cost[k].items() if d < (heaps[k][0][0] if heaps[k] else _INFINITE)} for k in (0, 1)]
    prefix: dict[tuple[int, int], str] = {}
    for v in sorted(settled[0], key=lambda v: (v[0], settled[0][v])):
        ways = [prefix[u] + e for u, c, e in lattice.before(v) if u in prefix and settled[0][u] + c == settled[0][v]]
        prefix[v] = min(ways, default="")
    suffix: dict[tuple[int, int], tuple[str, int]] = {}
    for v in sorted(settled[1], key=lambda v: (-v[0], settled[1][v])):
        ways = [(e + suffix[w][0], suffix[w][1]) for w, c, e in lattice.after(v) if w in suffix and settled[1][w] + c == settled[1][v]]
        suffix[v] = min(ways, default=("", v[1]))
    found = [(prefix[t], t[1]) for t in targets if settled[0].get(t) == best]
    if settled[1].get(source) == best:
        found.append(suffix[source])
    for v, p in prefix.items():
        for w, c, e in lattice.after(v):
            if w in suffix and settled[0][v] + c + settled[1][w] == best:
                found.append((p + e + suffix[w][0], suffix[w][1]))
    audit, last = min(found)
    return best, audit, last


def solve(rows: list[tuple[str, bool, bool, int]], starts: bool, ends: bool) -> list[dict]:
    """The ways through a block: entry, exit, cost, audit. ``starts``/``ends``: it holds the
    conversation's first/last row."""
    lattice, out = Lattice(rows), []
    for entry in (START,) if starts else STATES:
        for exits in [ENDS] if ends else [(q,) for q in STATES]:
            way = cheapest(lattice, entry, exits)
            if way:
                out.append({"entry": entry, "exit": way[2], "cost": way[0], "audit": way[1]})
    return out


class Chain:
    """The cheapest, then least, audit to each state after the blocks so far."""

    def __init__(self):
        self.done: list[str] = []  # what all audits begin with
        self.held = {START: (0, "")}

    def add(self, ways: list[dict]) -> None:
        reached: dict[int, tuple[int, str]] = {}
        for w in ways:
            if w["entry"] in self.held:
                cost, audit = self.held[w["entry"]]
                new = (cost + w["cost"], audit + w["audit"])
                reached[w["exit"]] = min(new, reached.get(w["exit"], new))
        shared = os.path.commonprefix([a for _, a in reached.values()])
        self.done.append(shared)
        self.held = {q: (c, a[len(shared) :]) for q, (c, a) in reached.items()}

    def result(self) -> tuple[int, str]:
        cost, audit = min(x for q, x in self.held.items() if q in ENDS)
        return cost, "".join(self.done) + audit


def replay(audit: str, rows: Iterator[tuple[str, str, int]]) -> Iterator[tuple[str, str]]:
    """Role and text of the repaired rows, from the rows (role, text, times) in order."""
    odd = (len(audit) - audit.count("D")) % 2
    at = out = 0

    def due() -> str:
        return "assistant" if (out - odd) % 2 else "user"

    def inserted() -> Iterator[tuple[str, str]]:
        nonlocal at, out
        while at < len(audit) and audit[at] == "I":
            yield due(), ""
            at, out = at + 1, out + 1

    for role, text, times in rows:
        for _ in range(times):
            yield from inserted()
            if audit[at] != "D":
                yield (role if audit[at] == "K" else due()), text
                out += 1
            at += 1
    yield from inserted()


# Spark


def _light(rows: DataFrame) -> DataFrame:
    """Rows without texts: equal rows of a turn once, with their number and faults."""
    text = F.col("text")
    return rows.select(
        "conv_id",
        "turn",
        "role",
        F.unhex(F.sha2(text.cast("binary"), 256)).alias("text_key"),
        (~text.rlike(r"[^\x20\x09-\x0D]")).alias("blank"),
        (~text.rlike(r"[.!?][\x20\x09-\x0D]*\z")).alias("cut"),
    ).groupBy("conv_id", "turn", "role", "text_key", "blank", "cut").agg(F.count("*").alias("times"))


def _with_seen(light: DataFrame) -> DataFrame:
    """Appends ``seen``: did role and text stand at an earlier turn? Null turns come first."""
    keys = ["conv_id", "role", "text_key"]
    several = light.groupBy(*keys).agg(F.count("*").alias("n"), F.count("turn").alias("n_set"), F.min("turn").alias("least")).where("n > 1")
    several = several.select(*[F.col(k).alias(f"_{k}") for k in keys], (F.col("n") > F.col("n_set")).alias("with_null"), "least")
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    seen = F.col("turn").isNotNull() & (F.col("with_null") | (F.col("turn") > F.col("least")))
    return light.join(several, same, "left").select(*light.columns, F.coalesce(seen, F.lit(False)).alias("seen"))


_BLOCK_SCHEMA = (
    "conv_id {}, turn {}, role string, text_key binary, block struct<ways: array<struct<entry: int, exit: int, cost: bigint, audit: string>>, "
    "blank: bigint, duplicate: bigint, truncated: bigint, illegal: bigint, first: string, last: string, low: bigint, high: bigint, turns: bigint>"
)


def _measure(rows: list[tuple]) -> dict:
    """Counts of a block's rows: (turn, role, blank, cut, times, seen)."""
    out = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
    out |= {"first": rows[0][1][:1], "last": rows[-1][1][:1], "low": None, "high": None}
    before = None
    for turn, role, blank, cut, times, seen in rows:
        if blank:
            out["blank"] += times
        else:
            out["duplicate"] += times - (not seen)
            out["truncated"] += cut and not seen
        initial = role[:1]
        out["illegal"] += times - 1 + (before is not None and (before, initial) not in LEGAL)
        before = initial
        if turn is not None:
            out["turns"] += turn != out["high"]
            out["low"], out["high"] = (turn if out["low"] is None else out["low"]), turn
    return out


def _edits(rows: list[tuple]) -> list[tuple[str, bool, bool, int]]:
    """The lattice's rows: of equal rows only the first may stay."""
    out = []
    for _, role, blank, cut, times, seen in rows:
        gone = times if blank or seen else times - 1
        if gone < times:
            out.append((role[:1], False, cut, 1))
        if gone:
            out.append((role[:1], True, cut, gone))
    return out


def _blocks(light: DataFrame) -> DataFrame:
    """One row a block: the place of its first row, its ways and counts."""
    order = ["conv_id", "turn", "role", "text_key"]
    kinds = dict(light.dtypes)
    schema = _BLOCK_SCHEMA.format(kinds["conv_id"], kinds["turn"])
    block_schema = _arrow_schema(light, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []  # rows of the block at hand
        conv, begins, known = None, None, False  # its conversation, first place, whether its first row is the conversation's
        out: list[dict] = []

        def close(ends: bool) -> None:
            ways = solve(_edits(held), known, ends)
            out.append({"conv_id": conv, **begins, "block": {"ways": ways, **_measure(held)}})

        some = False
        for batch in batches:
            for r in batch.to_pylist():
                if held and (r["conv_id"] != conv or len(held) >= BLOCK):
                    close(r["conv_id"] != conv)
                    held = []
                if not held:
                    known = some and r["conv_id"] != conv
                    conv, begins = r["conv_id"], {k: r[k] for k in order[1:]}
                some = True
                held.append((r["turn"], r["role"], r["blank"], r["cut"], r["times"], r["seen"]))
            if out:
                yield pa.RecordBatch.from_pylist(out, block_schema)
                out = []
        if held:
            close(False)
            yield pa.RecordBatch.from_pylist(out, block_schema)

    placed = light.repartitionByRange(*order).sortWithinPartitions(*order)
    return common.arrow(placed.select(*order, "blank", "cut", "times", "seen"), run, schema)


def _arrow_schema(df: DataFrame, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.sparkSession.createDataFrame([], schema).schema)


def _streamed(rows: DataFrame, schema: str, finish: Callable, conversations: DataFrame | None) -> DataFrame:
    """Conversation by conversation: ``finish(conv, counts, cost, audit, rows)`` yields output rows."""
    own = rows.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"))
    light = common.shared_table(_light(own), "conversation-rows")
    blocks = _blocks(_with_seen(light))
    ids = (own if conversations is None else conversations).select("conv_id").distinct()
    key = F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("text_key")
    texts = own.groupBy("conv_id", "turn", "role", key).agg(F.first("text").alias("text"), F.count("*").alias("times"))
    parts = [ids.withColumn("kind", F.lit(0)), blocks.withColumn("kind", F.lit(1)), texts.withColumn("kind", F.lit(2))]
    union = parts[0].unionByName(parts[1], True).unionByName(parts[2], True)
    order = ["conv_id", "kind", "turn", "role", "text_key"]
    union = union.repartition("conv_id").sortWithinPartitions(*order).select(*order, "block", "text", "times")
    out_schema = _arrow_schema(rows, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = (r for batch in batches for part in common.slices(batch, "text") for r in part.to_pylist())
        ahead = next(stream, None)

        def take(conv, kind: int) -> Iterator[dict]:
            nonlocal ahead
            while ahead is not None and ahead["conv_id"] == conv and ahead["kind"] == kind:
                row, ahead = ahead, next(stream, None)
                yield row

        out, size = [], 0
        while ahead is not None:
            conv = ahead["conv_id"]
            listed = sum(1 for _ in take(conv, 0))
            counts, (cost, audit) = _chained(r["block"] for r in take(conv, 1))
            texts = ((r["role"], r["text"], r["times"]) for r in take(conv, 2))
            for made in finish(conv, counts, cost, audit, replay(audit, texts)):
                if listed:
                    out.append(made)
                    size += sum(len(x) for x in made.values() if isinstance(x, str)) + 100
                if size >= common.SLICE_BYTES:
                    yield pa.RecordBatch.from_pylist(out, out_schema)
                    out, size = [], 0
            for _ in take(conv, 2):
                pass
        yield pa.RecordBatch.from_pylist(out, out_schema)
        common.release_memory()

    return common.arrow(union, run, schema)


def _chained(blocks: Iterator[dict]) -> tuple[dict, tuple[int, str]]:
    """Counts of a conversation, and its cost and audit."""
    total = dict.fromkeys(("blank", "duplicate", "truncated", "illegal", "turns"), 0)
    chain, last, low, high = Chain(), None, None, None
    for b in blocks:
        chain.add(b["ways"])
        for k in total:
            total[k] += b[k]
        total["illegal"] += last is not None and (last, b["first"]) not in LEGAL
        last = b["last"]
        if b["low"] is not None:
            total["turns"] -= b["low"] == high
            low, high = (b["low"] if low is None else low), b["high"]
    turns = total.pop("turns")
    return total | {"gaps": 0 if low is None else high - low + 1 - turns}, chain.result()


def report(rows: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """One row a conversation (of ``conversations``, else of ``rows``): gaps between turns, rows by
    fault, illegal neighbours, cost, audit, and the digest of the repaired ``role:text`` lines."""
    kind = dict(rows.dtypes)["conv_id"]
    schema = f"conv_id {kind}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"

    def finish(conv, counts, cost, audit, repaired):
        digest, glue = hashlib.sha256(), b""
        for role, text in repaired:
            digest.update(glue + f"{role}:{text}".encode())
            glue = b"\n"
        yield {"conv_id": conv, **counts, "cost": cost, "audit": audit, "repaired_sha256": digest.hexdigest()}

    return _streamed(rows, schema, finish, conversations)


def repair(rows: DataFrame) -> DataFrame:
    """The repaired conversations: ``conv_id, turn`` (from 0), ``role, text``."""
    kind = dict(rows.dtypes)["conv_id"]

    def finish(conv, counts, cost, audit, repaired):
        for i, (role, text) in enumerate(repaired):
            yield {"conv_id": conv, "turn": i, "role": role, "text": text}

    return _streamed(rows, f"conv_id {kind}, turn bigint, role string, text string", finish, None)
