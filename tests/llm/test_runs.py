"""Runs equal those of comparing words at every distance."""

import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from tidepool.llm import runs as R
from tidepool.llm.queries import QUERIES, with_planted_period


def _brute(w):
    """Stretches of equal words at each distance, less those with a smaller period."""
    out = []
    for q in range(1, len(w) // 2 + 1):
        k = 0
        while k + q < len(w):
            start = k
            while k + q < len(w) and w[k] == w[k + q]:
                k += 1
            length = k - start + q
            x = w[start : start + length]
            if length >= max(12, 2 * q) and not any(all(a == b for a, b in zip(x, x[r:])) for r in range(1, q)):
                out.append((start, length, q))
            k += 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def _words(rnd):
    n, letters = rnd.randrange(90), rnd.choice([1, 2, 2, 3, 5])
    w = [b"abcde"[rnd.randrange(letters) :][:1] for _ in range(n)]
    if rnd.random() < 0.6 and n > 4:
        a = rnd.randrange(n)
        p = 1 + rnd.randrange(max(1, (n - a) // 2))
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


@pytest.mark.parametrize("seed", range(5))
def test_against_comparing_all_distances(seed):
    rnd = random.Random(seed)
    for _ in range(300):
        w = _words(rnd)
        assert R.find_runs(w) == _brute(w)


def test_whole_text_without_the_seed_filter():
    rnd = random.Random(9)
    for _ in range(100):
        w = _words(rnd)
        ids = [x[0] for x in w]
        found = sorted(((s, i - s + 1, q) for (s, q), i in R.squares(ids).items() if i - s + 1 >= 12), key=lambda r: (r[0], r[2]))
        assert found == _brute(w)


def test_a_square_of_exactly_two_periods_between_other_words():
    left, block = [b"x%d" % i for i in range(9)], [b"y%d" % i for i in range(40)]
    assert R.find_runs(left + block + block + left[::-1]) == [(9, 80, 40)]
    assert R.find_runs(block + block[:-1]) == []


def test_long_periodic_texts_take_linear_memory_and_time():
    assert R.find_runs([b"a"] * 60_000) == [(0, 60_000, 1)]
    w = [b"%d" % (i % 9_000) for i in range(60_000)]
    assert R.find_runs(w) == [(0, 60_000, 9_000)]


def test_collapse_keeps_first_periods():
    w = list("zzabababababababczz")
    assert R.find_runs(w) == [(2, 14, 2)]
    assert R.collapse(w, R.find_runs(w)) == list("zzabczz")


def test_nulls_empties_blanks_and_repeated_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "a " * 12), (4, "a " * 12), (None, "b b " * 13), (5, "a " * 11)]
    df = spark.createDataFrame([(*r, "r", "l") for r in rows], "doc_id long, text string, runs string, longest string").repartition(3)
    got = sorted((r.doc_id or 0, len(r.runs), r.collapsed, r.longest) for r in R.detect(df).collect())
    assert got == [(0, 1, "b b", "l"), (1, 0, "", "l"), (2, 0, "", "l"), (3, 0, "", "l"), (4, 1, "a", "l"), (4, 1, "a", "l"), (5, 0, " ".join("a" * 11), "l")]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert R.summarise(R.detect(df)).count() == 0


def _expected(doc_id, text):
    w = (text or "").encode().split()
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = _brute(w)
    top = min(((-m, s, q) for s, m, q in found), default=None)
    gone = {i for s, m, q in found for i in range(s + q, s + m)}
    kept = b" ".join(x for i, x in enumerate(w) if i not in gone)
    lines = "".join(f"{s},{m},{q}\n" for s, m, q in found)
    longest = (None,) * 4 if top is None else (top[1], -top[0], top[2], 1000 * -top[0] // top[2])
    return (doc_id, len(found), *longest, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def test_query(spark, tmp):
    rnd = random.Random(4)
    rows = [(i, " ".join(rnd.choice(["a", "b", "cé"]) for _ in range(rnd.randrange(60)))) for i in range(300)]
    rows += [(300 + i, " ".join(f"w{rnd.randrange(900)}" for _ in range(rnd.randrange(1, 120)))) for i in range(200)] + [(501, None), (502, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp / "documents.parquet"))
    got = sorted(tuple(r) for r in QUERIES["op13_periodic_runs"](spark, str(tmp)).collect())
    assert got == [_expected(*r) for r in rows]


def test_planting_keeps_other_texts_as_they_are(spark):
    df = spark.createDataFrame([(1, "a  b"), (None, "c  d")], "doc_id long, text string")
    assert sorted(r.text for r in with_planted_period(df).collect()) == ["a  b", "c  d"]
    assert with_planted_period(df.withColumn("text", F.lit(None).cast("string"))).where("text IS NOT NULL").count() == 0
