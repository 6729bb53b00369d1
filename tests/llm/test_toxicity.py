"""Kernel against a direct count; held-out accuracy; odd inputs."""

from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidepool.llm import toxicity as X

SF = "/root/testdata/sf0.1"


def _subsequences(word):
    """Weighted subsequences of a word, start and end counted as letters, by letters."""
    s = "\0" + word + "\0"
    out = {}
    for size in (3, 4, 5):
        for i in range(len(s)):
            for rest in combinations(range(i + 1, min(len(s), i + size + 1)), size - 1):
                at = (i, *rest)
                skipped = at[-1] - i + 1 - size
                if skipped > (size > 3) or "\0" in s[i + 1 : at[-1]]:
                    continue
                key = "".join(s[k] for k in at)
                out[key] = out.get(key, 0) + X.SKIP**skipped
    return out


@pytest.mark.parametrize(("a", "b"), [("idiot", "idiot"), ("idiot", "idxiot"), ("scum", "scums"), ("trash", "moron"), ("ab", "abc"), ("a", "a")])
def test_kernel_is_the_weighted_count_of_common_subsequences(a, b):
    one = np.ones(1 << X.BITS, np.float32)
    fa, fb = _subsequences(a), _subsequences(b)
    expected = sum(v * fb.get(k, 0) for k, v in fa.items())
    wa, wb = X.words_of([a]), X.words_of([b])
    got = X.kernel(wa, wb, one)[0, 0] * X._norms(wa)[0] * X._norms(wb)[0]
    assert got == pytest.approx(expected, rel=1e-4)


def test_words():
    w = X.words_of(["Hello, w.o-r%l d", "", "a b c  id1ot!! i d", "...", "É  漢字"])
    assert X._spelled(w) == ["hello", "worl", "d", "abc", "idiot", "id", "é", "漢字"]
    assert w.text.tolist() == [0, 0, 0, 2, 2, 2, 4, 4]


def test_blocks_of_words_are_the_same_words():
    w = X.words_of(["one two three", "four five"])
    assert X._spelled(X._block(w, 1, 4)) == ["two", "three", "four"]
    assert X._spelled(X._block(w, 3, 5)) == ["four", "five"]


def test_margins_do_not_depend_on_neighbours():
    rng = np.random.default_rng(0)
    weights = rng.normal(size=1 << X.BITS).astype(np.float32)
    names = ["idiot", "a", "scum", "worthless" * 9, "é"]
    alone = [X.margins(X.words_of([n]), weights, 0.1)[0] for n in names]
    assert X.margins(X.words_of([" ".join(names[:3]), " ".join(names[3:])]), weights, 0.1) == pytest.approx(alone, rel=1e-5)


@pytest.fixture(scope="module")
def model(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    return X.fit(docs, labels)


def test_held_out_accuracy(spark, model):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    own = docs.join(labels, "doc_id").where(X.held_out(F.col("doc_id"))).select("doc_id", "text", "toxic")
    rows = X.score(own, model).select("toxic", "score").toPandas()
    toxic, clean = rows[rows.toxic == 1].score, rows[rows.toxic == 0].score
    rank = rows.score.rank()
    area = (rank[rows.toxic == 1].sum() - len(toxic) * (len(toxic) + 1) / 2) / (len(toxic) * len(clean))
    assert area > 0.93 and (toxic >= 0.7).mean() >= 0.9 and (clean >= 0.7).sum() <= 3


def test_gapped_and_inserted_letters(spark, model):
    texts = ["you are an i.d.i.o.t and such m-o-r-o-n s c u m", "you are kind and on time", "mooron scuum trashh moxron"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    spaced, kind, typed = [r["score"] for r in X.score(df, model).orderBy("doc_id").collect()]
    assert spaced > 0.7 > 0.1 > kind and typed > kind
    w = X.words_of(["mooron scuum kind time"])
    put_in, plain = X.margins(w, model.weights, model.bias).reshape(2, 2)
    assert put_in.min() > plain.max()


def test_scores_of_odd_texts(spark, model):
    rows = [(1, None, "s"), (2, "", "s"), (3, "...", "s"), (4, "scum " * 100_000, "s"), (4, "scum " * 100_000, "s")]
    df = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = [r["score"] for r in X.score(df, model).orderBy("doc_id").collect()]
    assert got[0] == got[1] == got[2] < 0.5 and got[3] == got[4] and all(0 <= s <= 1 for s in got)


def test_nothing_to_learn_from(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    for labels in ([], [(1, 1), (1, 0), (2, None), (None, 1)]):
        model = X.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
        assert len({r["score"] for r in X.score(docs, model).collect()}) == 1


def test_empty_documents(spark, model):
    assert X.score(spark.createDataFrame([], "doc_id long, text string"), model).count() == 0


def test_held_out_rule(spark):
    import zlib

    df = spark.createDataFrame([(i,) for i in [*range(200), None]], "doc_id long").select("doc_id", X.held_out(F.col("doc_id")).alias("h"))
    for r in df.collect():
        assert r["h"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)


def test_sample_bound(spark, monkeypatch):
    monkeypatch.setattr(X, "SAMPLE_ROWS", 300)
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    n = X._sample(docs, labels).count()
    assert 200 < n < 420


def test_query(spark):
    from tidepool.llm.queries import QUERIES

    rows = QUERIES["op10_toxicity"](spark, "/root/testdata/sf0.001").collect()
    assert len(rows) == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in rows)


def _counted(seed=1, n=400):
    rng = np.random.default_rng(seed)
    bad = ["idiot", "moron", "scum", "trash", "worthless"]
    names = bad + [b[:k] + "x" + b[k:] for b in bad for k in (1, 2)] + ["".join(rng.choice(list("abcdeiost"), rng.integers(2, 9))) for _ in range(n)]
    names = list(dict.fromkeys(names))
    toxic = np.array([float(rng.integers(3, 20)) if k < 15 else float(rng.random() < 0.03) for k in range(len(names))])
    other = np.array([0.0 if k < 13 else float(rng.integers(1, 9)) for k in range(len(names))])
    return names, toxic, other


def test_folded_weights_give_the_machines_margins():
    names, toxic, other = _counted()
    machine = X.fit_words(names, toxic, other, 40, 200)
    words = X.words_of([" ".join(names), "idioot mor0n w.o.r.t.h.l.e.s.s fine unseen"])
    assert X.margins(words, machine.folded(), machine.bias) == pytest.approx(machine.margins(words), abs=2e-4)


def test_machine_is_the_least_loss_over_all_words():
    """Against gradient steps from the fitted point: no direction lowers the loss of all words."""
    names, toxic, other = _counted(2)
    machine = X.fit_words(names, toxic, other, 40, 200)
    scale = ((1 + X._held(X.words_of(names), other)) ** -X.COMMONNESS).astype(np.float32)
    assert np.allclose(scale, machine.scale)
    marks = X._spelled(machine.marks)
    inner = X.kernel(machine.marks, machine.marks, scale).astype(float)
    spelled, share = X._put_in(marks, names, toxic, other)
    rows = [(w, 1.0, c) for w, c in zip(names, toxic) if c] + [(w, -1.0, c) for w, c in zip(names, other) if c] + [(w, 1.0, c) for w, c in zip(spelled, share)]
    k = X.kernel(X.words_of([w for w, _, _ in rows]), machine.marks, scale).astype(float)
    y, weight = np.array([r[1] for r in rows]), X.COST * np.array([r[2] for r in rows])

    def loss(per_mark, bias):
        return weight @ np.maximum(0, 1 - y * (k @ per_mark + bias)) ** 2 + 0.5 * per_mark @ inner @ per_mark + 0.5e-6 * bias**2

    at = loss(machine.per_mark, machine.bias)
    rng = np.random.default_rng(0)
    values, vectors = np.linalg.eigh(inner)
    for _ in range(40):
        step = vectors @ (rng.normal(size=len(marks)) * 1e-3 / np.sqrt(np.maximum(values, 1e-6)))
        assert loss(machine.per_mark + step, machine.bias) > at - 1e-3 * at and loss(machine.per_mark, machine.bias + rng.normal() * 1e-2) > at - 1e-6 * at


def test_every_fit_sees_all_its_words(spark):
    """Three machines from counted words by Spark are those of fitting directly."""
    names, toxic, other = _counted(3, 150)
    rng = np.random.default_rng(4)
    t0, o0 = (np.floor(c * rng.random(len(names))) for c in (toxic, other))
    stats = spark.createDataFrame([(w, int(a), int(b - a), int(c), int(d - c)) for w, a, b, c, d in zip(names, t0, toxic, o0, other)], "word string, t0 long, t1 long, o0 long, o1 long").repartition(5)
    sizes = {(0, 1): 20, (1, 1): 25, (0, 0): 90, (1, 0): 110}
    for folds, (weights, bias) in zip(X._FITS, X._machines(stats, sizes), strict=True):
        t, o = (sum((first if f == 0 else whole - first) for f in folds) for first, whole in ((t0, toxic), (o0, other)))
        own = sorted(k for k in range(len(names)) if t[k] + o[k])
        own.sort(key=lambda k: names[k])
        machine = X.fit_words([names[k] for k in own], t[own], o[own], sum(sizes[f, 1] for f in folds), sum(sizes[f, 0] for f in folds))
        assert np.allclose(machine.folded(), weights, atol=1e-5) and machine.bias == pytest.approx(bias)


def test_held_counts_words_by_subsequence():
    w = X.words_of(["idiot idiom", "scum"])
    held = X._held(w, np.array([2.0, 3.0, 5.0]))
    assert held.sum() == pytest.approx(sum(c * sum(_subsequences_unweighted(x)) for x, c in (("idiot", 2), ("idiom", 3), ("scum", 5))))


def _subsequences_unweighted(word):
    s = "\0" + word + "\0"
    for size in (3, 4, 5):
        for i in range(len(s)):
            for rest in combinations(range(i + 1, min(len(s), i + size + 1)), size - 1):
                skipped = rest[-1] - i + 1 - size
                if skipped <= (size > 3) and "\0" not in s[i + 1 : rest[-1]]:
                    yield 1
