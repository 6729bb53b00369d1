"""Encoding equals the tokenizers library on whole texts; decoding is its decode."""

import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidepool.llm import bpe

PATH = public_tokenizers.path("word_bpe_49k.json")

TEXTS = [
    None, "", "   ", "plain words", "<|endoftext|>", "a<|startoftext|>b <|endoftext|", "ΑΣ ΣΑΣ İstanbul ẞ",
    "x\x1cy\x1d z\x85q w e", "don't we'll I'd they've 'S 'LL", "12345 ½ ² Ⅳ", "é ́a", "🙂👍🏽 日本語 한국어",
    "\x00\u0000​ a‍b", "aaaa" * 3000, "supercalifragilisticexpialidocious", "...???---___###", "﻿abc", "plain words",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_random_texts(library):
    rng = random.Random(5)
    signs = "abcdefghijklmnopqrstuvwxyz'.!0éß漢Σ \n"
    names = [w.removesuffix("</w>") for w in library.get_vocab()]
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(1, 60))) for _ in range(2000)]
    texts += ["".join(rng.choice(names) for _ in range(3)) for _ in range(4000)]
    model = bpe.load(PATH)
    got = [np.frombuffer(x, "<i4").tolist() for x in bpe.encode_texts(model, texts)]
    assert got == [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]
    assert 0 < model.counts["failing"] < model.counts["words"]


def test_compatible_pairs_are_those_that_encode_to_themselves():
    model = bpe.load(PATH)
    rng = random.Random(6)
    ids = [i for i, s in model.names.items() if i in model.vocab.values() and not s.endswith(model.suffix)]
    first = [t for t in (rng.choice(ids) for _ in range(3000)) if bpe.exact(model, model.names[t], "") == [t]]
    second = [t for t in (rng.choice(ids) for _ in range(len(first) * 2)) if bpe.exact(model, model.names[t], "") == [t]][: len(first)]
    first = first[: len(second)]
    good = bpe.compatible(model, np.array(first), np.array(second))
    for a, b, ok in zip(first, second, good.tolist(), strict=True):
        assert ok == (bpe.exact(model, model.names[a] + model.names[b], "") == [a, b])


def test_long_words_merge_like_short_ones():
    model = bpe.load(PATH)
    for word in ("the" * 13, "aaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaaa", "abcdefghijklmnopqrstuvwxyzabcdefgh"):
        ids = [model.vocab[c] for c in word[:-1]] + [model.vocab[word[-1] + model.suffix]]
        assert bpe._exact_long(model, ids) == bpe.exact(model, word)


def test_columns(spark, library):
    df = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(TEXTS)], "doc_id long, text string, ids string")
    rows = bpe.decode(bpe.encode(df, PATH), PATH).orderBy("doc_id").collect()
    assert len(rows) == len(TEXTS)
    for row, text in zip(rows, TEXTS, strict=True):
        found = library.encode(text or "", add_special_tokens=False).ids
        assert row["ids"] == found
        assert row["decoded"] == library.decode(found, skip_special_tokens=False)


def test_decode_of_odd_ids(spark):
    df = spark.createDataFrame([([0, None, -3, 10**6, 49407],), (None,), ([],)], "ids array<int>")
    assert [r["decoded"] for r in bpe.decode(df, PATH).collect()] == ["! <|endoftext|>", "", ""]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.decode(bpe.encode(df, PATH), PATH).count() == 0


def test_other_files_are_refused():
    with pytest.raises(ValueError):
        bpe.load(public_tokenizers.path("byte_bpe_50k.json"))


def test_query(spark, library):
    import hashlib

    from tidepool.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    texts = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()}
    rows = QUERIES["op1_bpe"](spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded_sha256"] == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
