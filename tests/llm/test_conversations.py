"""Repairs equal those of a row-by-row search over all edits."""

import hashlib
import random
import re
import zlib

import pytest

from tidepool.llm import conversations as C
from tidepool.llm.queries import QUERIES

STEP = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}


def _least(rows):
    """Cheapest, then least, (cost, audit) by walking the rows with every state's best."""

    def grown(best):
        for _ in range(3):
            for q, (c, a) in list(best.items()):
                for i, r in STEP[q].items():
                    if i != "s":
                        best[r] = min(best.get(r, (c + 3, a + "I")), (c + 3, a + "I"))
        return best

    best = grown({"": (0, "")})
    for initial, gone, cut in rows:
        new = {}
        for q, (c, a) in best.items():
            ways = [(q, c + 4, "D")]
            if not gone:
                ways += [(r, c + 3 * cut, "K") for i, r in STEP[q].items() if i == initial]
                ways += [(r, c + 3 + 3 * cut, "R") for i, r in STEP[q].items() if i != "s"]
            for r, cost, edit in ways:
                new[r] = min(new.get(r, (cost, a + edit)), (cost, a + edit))
        best = grown(new)
    return min(best[q] for q in ("", "a") if q in best)


def _expected(conv, rows):
    """The report of one conversation, from its rows (turn, role, text) in order."""
    faults, seen = [], set()
    for _, role, text in rows:
        last = re.sub(r"[\x20\x09-\x0D]", "", text)[-1:]
        fault = "b" if not last else "d" if (role, text) in seen else "t" if last not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
    cost, audit = _least([(r[:1], f in ("b", "d"), f == "t") for (_, r, _), f in zip(rows, faults, strict=True)])
    size = sum(e != "D" for e in audit)
    wanted = ("system:" if size % 2 else "").split(":")[:-1] + ["user", "assistant"] * (size // 2)
    out, left = [], iter(rows)
    for e in audit:
        row = next(left) if e != "I" else None
        if e != "D":
            role = wanted[len(out)]
            out.append(f"{row[1] if e == 'K' else role}:{row[2] if row else ''}")
    turns = {t for t, *_ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    counts = [sum(f == k for f in faults) for k in "bdt"]
    return (conv, gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(out).encode()).hexdigest())


def _order(row):
    turn, role, text = row
    return (turn is not None, turn or 0, role, hashlib.sha256(text.encode()).digest())


def _all_expected(rows, ids):
    by = {c: [] for c in ids}
    for conv, turn, role, text in rows:
        by[conv].append((turn, " " if role is None else role, " " if text is None else text))
    return sorted((_expected(c, sorted(own, key=_order)) for c, own in by.items()), key=str)


def _rows(rnd, convs, longest):
    texts = ["Yes.", "No", "Why? ", " \t", "", "a.\n", "b!c", "é…", "long " * 9 + "."]
    out = []
    for c in convs:
        for turn in range(rnd.randrange(longest)):
            role = rnd.choice(["user", "assistant", "user", "assistant", "system", "tool", ""])
            out += [(c, turn if rnd.random() < 0.95 else None, role, rnd.choice(texts))] * rnd.choice([1, 1, 1, 2, 3])
    return out


SCHEMA = "conv_id long, turn long, role string, text string"


@pytest.mark.parametrize("seed", range(4))
def test_lattice_against_walking(seed):
    rnd = random.Random(seed)
    for _ in range(400):
        rows = [(rnd.choice("suauaux"), rnd.random() < 0.2, rnd.random() < 0.3) for _ in range(rnd.randrange(14))]
        arcs = [(*r, 1) for r in rows]
        assert C.cheapest(C.Lattice(arcs), C.START, C.ENDS)[:2] == _least(rows)
        chain, k = C.Chain(), rnd.randrange(1, 5)
        cuts = [arcs[i : i + k] for i in range(0, len(arcs), k)]
        for j, block in enumerate(cuts):  # whatever a block knows of its ends
            chain.add(C.solve(block, j == 0 and rnd.random() < 0.5, j == len(cuts) - 1 and rnd.random() < 0.5))
        assert chain.result() == _least(rows)


def test_runs_of_rows_that_must_go_are_one_arc():
    cost, audit, _ = C.cheapest(C.Lattice([("u", False, False, 1), ("u", True, False, 5000)]), C.START, C.ENDS)
    assert (cost, audit) == (4 * 5000 + 3, "K" + "D" * 5000 + "I")


@pytest.mark.parametrize("block", [3, 256])
def test_report_against_walking(spark, monkeypatch, block):
    monkeypatch.setattr(C, "BLOCK", block)
    rnd = random.Random(block)
    rows = _rows(rnd, range(60), 12) + _rows(rnd, [100], 300)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = sorted((tuple(r) for r in C.report(df).collect()), key=str)
    assert got == _all_expected(rows, {r[0] for r in rows})


def test_one_long_conversation_is_cut_by_partitions(spark):
    rnd = random.Random(8)
    rows = _rows(rnd, [7], 3000)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "9")
        spark.conf.set("spark.sql.adaptive.enabled", "false")  # else small partitions become one
        light = C._with_seen(C._light(spark.createDataFrame(rows, SCHEMA)))
        assert C._blocks(light).rdd.glom().map(len).filter(lambda n: n > 0).count() > 4
        got = [tuple(r) for r in C.report(spark.createDataFrame(rows, SCHEMA)).collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    assert got == _all_expected(rows, [7])


def test_nulls_and_conversations_without_rows(spark):
    rows = [(None, 1, "user", "a."), (None, 2, "assistant", "b."), (1, None, None, None), (2, 5, "user", None), (3, None, "system", "Be kind.")]
    ids = spark.createDataFrame([(x,) for x in (None, 1, 2, 3, 9)], "conv_id long")
    got = sorted((tuple(r) for r in C.report(spark.createDataFrame(rows, SCHEMA), ids).collect()), key=str)
    assert got == _all_expected(rows, [None, 1, 2, 3, 9])
    assert (9, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in got
    assert (None, 0, 0, 0, 0, 0, 0, "KK", hashlib.sha256(b"user:a.\nassistant:b.").hexdigest()) in got


def test_empty_table_and_extra_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert C.report(empty).count() == 0 and C.repair(empty).count() == 0
    extra = spark.createDataFrame([(1, 0, "user", "Hi.", 5, "x")], SCHEMA + ", kind int, audit string")
    assert [r.audit for r in C.report(extra).collect()] == ["KI"]


def test_repaired_rows(spark):
    rows = [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi"), (1, 2, "user", "Hello?"), (1, 3, "assistant", "")]
    got = [tuple(r) for r in C.repair(spark.createDataFrame(rows, SCHEMA)).orderBy("turn").collect()]
    assert got == [(1, 0, "system", "Be kind."), (1, 1, "user", "Hi"), (1, 2, "assistant", "Hello?")]  # KKRD, 10


def _damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(key.encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def test_query(spark, tmp):
    rnd = random.Random(5)
    rows = [r for r in _rows(rnd, [*range(150), None], 9)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp / "conversations.parquet"))
    got = sorted((tuple(r) for r in QUERIES["op11_conversation_repair"](spark, str(tmp)).collect()), key=str)
    assert got == _all_expected(_damaged(rows), {r[0] for r in rows})
