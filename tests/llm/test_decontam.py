"""Hits equal those of a direct search for every window."""

import random
import re

import pytest
from pyspark.sql import functions as F

from tidepool.llm import decontam, words


def _words(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def _brute(docs, items, window=13):
    grams = {}
    for item, text in items:
        ws = _words(text)
        size = min(window, len(ws))
        for i in range(len(ws) - size + 1 if size else 0):
            grams.setdefault(tuple(ws[i : i + size]), set()).add(item)
    out = {}
    for doc, text in docs:
        ws, hit, found = _words(text), set(), set()
        for size in {len(g) for g in grams}:
            for i in range(len(ws) - size + 1):
                g = tuple(ws[i : i + size])
                if g in grams:
                    hit.update(range(i, i + size))
                    found |= {x for x in grams[g] if x is not None}
        out[doc] = (len(ws), len(hit), sorted(map(str, found)))
    return out


def _found(spark, docs, items, **kw):
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame(items, "item_id long, text string")
    rows = decontam.find_hits(d, b, **kw).withColumn("n_hit", decontam.n_hit()).collect()
    assert len(rows) == len(docs)
    return {r["doc_id"]: (r["n_words"], r["n_hit"], r["items"]) for r in rows}


def _case(seed, n_docs=60):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(12)] + ["Été", "É"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.choice([1, 3, 7, 13, 20, 40]))) for i in range(2, 14)] + [(90, None), (91, ""), (92, "...")]
    items += [(93, items[3][1]), (None, text(15)), (2, items[0][1])]
    items = [x for x in items if x[1] is None or len(x[1].split()) != 1]
    docs = [(i, text(rng.randint(0, 60)) + " " + (rng.choice(items)[1] or "") + ", " + text(rng.randint(0, 30))) for i in range(n_docs)]
    return docs + [(900, None), (901, ""), (902, "?!")], items


@pytest.mark.parametrize("seed", range(3))
def test_against_direct_search(spark, seed):
    docs, items = _case(seed)
    assert _found(spark, docs, items) == _brute(docs, items)


def test_one_word_items(spark):
    docs, items = _case(9)
    items.append((200, "w3"))
    assert _found(spark, docs, items) == _brute(docs, items)


def test_blocks_and_segments_lose_nothing(spark, monkeypatch):
    docs, items = _case(4)
    monkeypatch.setattr(decontam, "BLOCK_WORDS", 60)
    monkeypatch.setattr(decontam, "SEGMENT_WORDS", 16)
    assert _found(spark, docs, items) == _brute(docs, items)


def test_empty_tables(spark):
    docs, items = _case(1, n_docs=3)
    assert _found(spark, docs, []) == _brute(docs, [])
    assert _found(spark, [], items) == {}


def test_extra_columns_pass_and_clashes_are_replaced(spark):
    d = spark.createDataFrame([(1, "a b", "mine", 7)], "doc_id long, text string, lang string, hits int")
    b = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    row = decontam.find_hits(d, b).first()
    assert (row["lang"], [tuple(x) for x in row["hits"]]) == ("mine", [(0, 2)])


def test_long_text_with_one_item(spark):
    item = " ".join(f"q{k}" for k in range(13))
    rows = _found(spark, [(1, "x " * 200_000 + item + " y" * 200_000)], [(1, item)])
    assert rows == {1: (400_013, 13, ["1"])}


def test_remove_spans(spark):
    item = " ".join(f"q{k}" for k in range(13))
    docs = [(1, f"Before it: {item.upper()}! And much more after it, so that the rest is the larger part of the text by far."), (2, item), (3, "clean"), (4, None)]
    d = spark.createDataFrame(docs, "doc_id long, text string")
    b = spark.createDataFrame([(1, item)], "item_id long, text string")
    out = {r["doc_id"]: r["text"] for r in decontam.remove_spans(decontam.find_hits(d, b)).collect()}
    assert out[1].startswith("Before it: ! And much") and out[2] == "" and out[3] == "clean" and out[4] is None


def test_contaminated_limit(spark):
    df = spark.createDataFrame([(20, 1), (21, 1), (0, 0), (13, 13)], "n_words long, n int")
    df = df.withColumn("hits", F.when(F.col("n") > 0, F.array(F.struct(F.lit(0).alias("start"), F.col("n").alias("end")))).otherwise(F.array()))
    assert [r[0] for r in df.select(decontam.contaminated()).collect()] == [True, False, False, True]


def test_words_are_those_of_the_pattern():
    for text in ("Ab-c ÉÀ 1_2\x7f~x", "", "漢字 k", "\x00a"):
        assert [w.decode() for w in words.split(text)] == _words(text)
