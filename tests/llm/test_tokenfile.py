"""Ids equal the tokenizers library; files give back what was written."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tidepool.llm import tokenfile as X

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = [
    None, "", "a  b", "a \nb", "a\n b", " a", "a ", "  ", "<|endoftext|> x<|endoftext|>", " \n \n x", "x  y 　z", "é 🙂 日本 語",
    "don't  'll I'd", "\x1c a\x1d b", "a\t b \t c", "aaaa" * 5000, "\x00\x7f͸", "a ",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def _library_ids(library, texts):
    return [x.ids for x in library.encode_batch(texts, add_special_tokens=False)]


def test_random_texts(library):
    rng = random.Random(2)
    texts = [t or "" for t in TEXTS]
    texts += ["".join(rng.choice("ab1é' \n\t .!") for _ in range(rng.randint(1, 40))) for _ in range(8000)]
    assert [x.tolist() for x in X.Encoder(PATH).encode(texts)] == _library_ids(library, texts)


def test_every_character_splits_alike(library):
    codes = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{chr(c)}b 1{chr(c)} {chr(c)}{chr(c)}." for c in codes[s : s + 400]) for s in range(0, 0x30000, 400)]
    assert [x.tolist() for x in X.Encoder(PATH).encode(texts)] == _library_ids(library, texts)


@pytest.mark.parametrize("width", [1, 5, 16, 17, 31, 32])
def test_segments_give_back_documents_and_runs(width):
    rng = np.random.default_rng(width)
    ids = rng.integers(0, 2**width, 2 * X.BLOCK_IDS + 77, dtype=np.uint64).astype(np.uint32)
    documents = np.split(ids, [0, 5, 5, 70_000, X.BLOCK_IDS * 2])
    payload = X.pack(documents, width)
    segment = X.Segment(payload)
    assert all((segment.document(k) == d).all() for k, d in enumerate(documents))
    for start, end in ((0, 0), (0, 1), (65_530, 131_080), (len(ids) - 3, len(ids)), (0, len(ids))):
        assert (segment.ids(start, end) == ids[start:end]).all()
    blocks = -(-len(ids) // X.BLOCK_IDS)
    data = sum(-(-min(X.BLOCK_IDS, len(ids) - k * X.BLOCK_IDS) * width // 8) for k in range(blocks))
    assert len(payload) == X._HEADER.size + 8 * (blocks + 1) + 8 * len(documents) + data


def test_ids_beyond_the_width_are_refused():
    with pytest.raises(ValueError):
        X.pack([np.array([8], np.uint32)], 3)
    assert (X.width_of(1), X.width_of(2), X.width_of(65536), X.width_of(65537)) == (1, 1, 16, 17)


def _round_trip(spark, tmp_path, rows, target):
    df = spark.createDataFrame(rows, "doc_id long, text string, start string")
    folder = str(tmp_path / f"files-{target}")
    X.write(X.encode(df, PATH, end_id=2), folder, X.encoder_of(PATH).vocabulary, target=target)
    return X.read(spark, folder).orderBy("start").collect()


@pytest.mark.parametrize("target", [1, 50, 1 << 20])
def test_files(spark, tmp_path, library, target):
    rows = [(7 * i % 19, t, "x") for i, t in enumerate(TEXTS)] + [(3, "again", "x"), (3, "again", "x"), (None, "no id", "x")]
    got = _round_trip(spark, tmp_path, rows, target)
    assert len(got) == len(rows)
    at = 0
    for r in got:
        assert r["start"] == at
        at += r["n_tokens"]
    assert [r["doc_id"] for r in got][0] is None
    ids = [r["doc_id"] for r in got][1:]
    assert ids == sorted(ids)
    expected = sorted((i if i is not None else -1, np.array(x + [2], "<u4").tobytes()) for (i, _, _), x in zip(rows, _library_ids(library, [t or "" for _, t, _ in rows]), strict=True))
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, bytes(r["ids"])) for r in got) == expected


def test_empty_table(spark, tmp_path):
    assert _round_trip(spark, tmp_path, [], 5) == []


def test_query(spark, library):
    from tidepool.llm.queries import QUERIES

    sf = "/root/testdata/sf0.001"
    texts = dict(spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.coalesce("text", F.lit(""))).collect())
    rows = {r["doc_id"]: r for r in QUERIES["op5_token_file"](spark, sf).collect()}
    at = 0
    for i in sorted(texts):
        ids = library.encode(texts[i], add_special_tokens=False).ids + [2]
        r = rows[i]
        assert (r["start"], r["n_tokens"], r["ids_crc32"]) == (at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += len(ids)
    assert len(rows) == len(texts)


def test_many_null_ids_are_spread_and_come_first(spark, tmp):
    rng = np.random.default_rng(3)
    rows = [(None if k % 3 else k, rng.integers(0, 1000, rng.integers(0, 9)).tolist()) for k in range(900)]
    packed = [(i, bytearray(np.array(x, X.item_type(1000)).tobytes())) for i, x in rows]
    df = spark.createDataFrame(packed, "doc_id long, ids binary").repartition(7)
    X.write(df, str(tmp / "t"), vocabulary=1000)
    parts = spark.read.parquet(str(tmp / "t")).where("part < 0").select("part").distinct().count()
    assert parts > 4
    got = sorted(X.read(spark, str(tmp / "t")).collect(), key=lambda r: (r["start"], r["n_tokens"]))
    assert [r["doc_id"] for r in got if r["n_tokens"]][-1] == max(i for i, x in rows if i is not None and x)
    assert all(r["doc_id"] is None for r in got if r["start"] < sum(len(x) for i, x in rows if i is None) and r["n_tokens"])
    at = 0
    for r in got:
        assert r["start"] == at and len(r["ids"]) == 4 * r["n_tokens"]
        at += r["n_tokens"]
    key = lambda i, ids: (i is not None, i or 0, ids)
    read = sorted(key(r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist()) for r in got)
    assert read == sorted(key(i, ids) for i, ids in rows)
