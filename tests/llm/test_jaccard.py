"""Components and set sizes equal those of comparing all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepool.llm import jaccard as J


def _set(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        low = low.replace(space, " ")
    ws = [w for w in low.split(" ") if w]
    if not ws:
        return frozenset()
    return frozenset(tuple(ws[i : i + 5]) for i in range(max(1, len(ws) - 4)))


def _brute(rows, percent=80):
    sets = [_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            common = len(sets[i] & sets[j])
            if sets[i] and 100 * common >= percent * (len(sets[i]) + len(sets[j]) - common):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)] = min(doc, least.get(find(i), doc))
    return sorted((str(doc), len(sets[i]), str(least.get(find(i)))) for i, (doc, _) in enumerate(rows))


def _found(spark, rows, **kw):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = J.join(df, **kw).collect()
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got)


def _edited(rng, words, vocabulary, edits):
    words = list(words)
    for _ in range(edits):
        k = rng.randrange(len(words))
        words[k : k + rng.choice([0, 1])] = [rng.choice(vocabulary)] * rng.choice([0, 1, 2])
    return words or ["x"]


def _corpus(seed, n=220):
    """Copies, near copies around the threshold, shared passages, odd texts."""
    rng = random.Random(seed)
    vocabulary = [f"v{k}" for k in range(400)] + ["Ä", "ä", "z-z"]
    passage = [rng.choice(vocabulary) for _ in range(60)]
    bases = [[rng.choice(vocabulary) for _ in range(rng.choice([1, 3, 4, 5, 6, 7, 8, 9, 12, 18, 30, 70, 130, 300]))] for _ in range(25)]
    rows = []
    for i in range(n):
        base = rng.choice(bases)
        kind = rng.random()
        if kind < 0.15:
            ws = base
        elif kind < 0.75:
            ws = _edited(rng, base, vocabulary, rng.randint(1, max(1, len(base) // 30 + 1)))
        elif kind < 0.9:
            ws = passage + [rng.choice(vocabulary) for _ in range(rng.choice([0, 2, 5, 12, 40]))]
        else:
            ws = [rng.choice(vocabulary) for _ in range(rng.choice([1, 5, 6, 40, 100]))]
        rows.append((i, rng.choice([" ", "  ", "\n"]).join(ws).upper() if rng.random() < 0.2 else " ".join(ws)))
    return rows


@pytest.mark.parametrize("seed", range(3))
def test_against_all_pairs(spark, seed):
    rows = _corpus(seed)
    assert _found(spark, rows) == _brute(rows)


def test_other_threshold_and_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(J, "BLOCK", 3)
    monkeypatch.setattr(J, "SENT_IDS", 0)
    rows = _corpus(7)
    assert _found(spark, rows, percent=60) == _brute(rows, 60)


def test_nulls_empties_and_repeats(spark):
    text = " ".join(f"w{k}" for k in range(30))
    rows = [(5, None), (4, ""), (3, " \n\t"), (2, text), (2, text), (1, text + " more"), (None, text), (None, None), (2, "other words of id two here"), (9, "a b"), (8, "A\x0bB")]
    assert _found(spark, rows) == _brute(rows)


def test_empty_table(spark):
    assert _found(spark, []) == []


def test_pigeonhole_on_random_pairs():
    """Linked sets of any sizes share a key."""
    rng = np.random.default_rng(3)
    for size in [*range(1, 40), 63, 64, 65, 80, 100, 255, 256, 257, 300, 1023, 1024, 1300, 5000]:
        for _ in range(6):
            whole = rng.integers(0, 2**64, int(size * 1.3) + 2, dtype=np.uint64)
            a = np.unique(whole[:size])
            for m in {size, int(size * 1.25), max(1, int(size * 0.8)), size + 1}:
                for lost in range(0, size // 5 + 1, max(1, size // 20)):
                    b = np.unique(whole[lost : lost + m])
                    common = len(np.intersect1d(a, b))
                    if 100 * common >= 80 * (len(a) + len(b) - common) and not np.array_equal(a, b):
                        assert set(J.keys_of(a, 0.8).tolist()) & set(J.keys_of(b, 0.8).tolist()), (len(a), len(b), common)


def test_folded_sketch_bounds_the_difference():
    rng = np.random.default_rng(4)
    for _ in range(50):
        a = np.unique(rng.integers(0, 2**64, 200, dtype=np.uint64))
        b = np.unique(np.concatenate((a[rng.random(len(a)) < 0.9], rng.integers(0, 2**64, 15, dtype=np.uint64))))
        apart = int(np.bitwise_count(J.folded(a) ^ J.folded(b)).sum())
        assert apart <= len(np.setxor1d(a, b))


def test_one_large_group_of_near_copies(spark):
    rng = random.Random(8)
    base = [f"b{k}" for k in range(150)]
    rows = [(i, " ".join(_edited(rng, base, ["q", "r", "s"], 2))) for i in range(400)]
    assert _found(spark, rows) == _brute(rows)


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 6), (6, 5), (20, 21), (3, 3)] + [(100 + k, 101 + k) for k in range(40)]
    df = spark.createDataFrame(links, "left long, right long")
    roots = dict(J.components(df).collect())
    assert {n: roots.get(n, n) for n in (1, 2, 3, 5, 9, 21, 100, 140)} == {1: 1, 2: 1, 3: 1, 5: 5, 9: 5, 21: 20, 100: 100, 140: 100}
    assert J.components(df.where("left > 1000")).count() == 0


def test_extra_columns_are_ignored(spark):
    df = spark.createDataFrame([(1, "a b c", 5), (2, "a b c", 6)], "doc_id long, text string, node int")
    assert [r["component_id"] for r in J.join(df).collect()] == [1, 1]


def test_query_has_a_row_per_document(spark):
    from tidepool.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    got = QUERIES["op4_jaccard_join"](spark, sf)
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    found = sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"])) for r in got.select("doc_id", F.col("n_shingles"), "component_id").collect())
    assert found == _brute(rows)


def _pairs_given(spark, sets, nearest):
    rows = [(7, k, k, len(s), J.folded(s).view(np.int64).tolist(), len(sets)) for k, s in enumerate(sets)]
    df = spark.createDataFrame(rows, "key long, node long, root long, n int, sketch array<long>, size long")
    return sorted(tuple(r) for r in J._across(df, 0.8, nearest).collect())


@pytest.mark.parametrize("block", [3, 512])
def test_across_gives_the_nearest_or_all_that_may_link(spark, monkeypatch, block):
    monkeypatch.setattr(J, "BLOCK", block)
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**64, 700, dtype=np.uint64)
    sets = []
    for size in [90, 100, 110, 480, 512, 520, 640, 700]:  # 512 is where sketches double
        for _ in range(4):
            kept = base[:size][rng.random(size) > 0.05]
            sets.append(np.unique(np.concatenate((kept, rng.integers(0, 2**64, 3, dtype=np.uint64)))))
    linked = {(a, b) for b, y in enumerate(sets) for a, x in enumerate(sets[:b]) if 100 * (c := len(np.intersect1d(x, y))) >= 80 * (len(x) + len(y) - c)}
    assert linked and linked <= set(_pairs_given(spark, sets, False))
    nearest = _pairs_given(spark, sets, True)
    assert {k for p in linked for k in p} <= {k for p in nearest for k in p}


def test_pairs_of_a_large_key_grow_with_its_nodes(spark):
    """5,000 near copies that share one key, none joined yet: each gives one pair at most in a block."""
    rng = np.random.default_rng(6)
    base = rng.integers(0, 2**64, 150, dtype=np.uint64)
    sets = [np.unique(np.concatenate((base[rng.random(150) > 0.03], rng.integers(0, 2**64, 4, dtype=np.uint64)))) for _ in range(5_000)]
    parts = -(-5_000 // J.BLOCK)
    assert 2_500 <= len(_pairs_given(spark, sets, True)) <= 5_000 * parts


def test_pairs_to_verify_after_the_first_star(spark, monkeypatch):
    """A large group of near copies around the threshold: few pairs are left for the last pass."""
    given = []
    across = J._across

    def counted(rows, threshold, nearest):
        out = J.common.shared_table(across(rows, threshold, nearest), "counted")
        given.append((nearest, out.count()))
        return out

    monkeypatch.setattr(J, "_across", counted)
    rng = random.Random(12)
    base = [f"b{k}" for k in range(160)]
    rows = [(i, " ".join(_edited(rng, base, ["q", "r", "s"], 3))) for i in range(500)]
    assert _found(spark, rows) == _brute(rows)
    assert [n for n, _ in given] == [True] * J.ROUNDS + [False]
    assert given[0][1] <= 4 * len(rows) and given[-1][1] <= len(rows)


def test_halved_sketch_is_that_of_half_the_bits():
    rng = np.random.default_rng(9)
    a = np.unique(rng.integers(0, 2**64, 900, dtype=np.uint64))
    wide, odd = J.folded(a), np.bincount((a & np.uint64(511)).astype(np.int64), minlength=512) & 1
    assert len(wide) == 16 and (J.halved(wide[None])[0] == np.packbits(odd.astype(np.uint8)).view(np.uint64)).all()
