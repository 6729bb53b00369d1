"""Each stage against a direct reading of what it should keep or change."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from tests.llm.test_decontam import _brute as brute_hits
from tests.llm.test_jaccard import _brute as brute_components
from tidepool.llm import secrets, toxicity

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score string, hits int, spans string"


def _docs(spark, rows):
    full = [(i, t, "en", "s", None if t is None else len(t), "own", 3, "mine") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def test_stages():
    assert [name for name, _ in C.STAGES] == ["toxicity", "jaccard_join", "decontamination", "secret_scans", "bpe"]


def test_toxicity_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = C.drop_toxic(spark, docs, SF)
    assert kept.columns == docs.columns
    model = toxicity.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    scores = dict(toxicity.score(docs, model).select("doc_id", "score").collect())
    ids = {r["doc_id"] for r in kept.select("doc_id").collect()}
    assert ids == {i for i, s in scores.items() if s < C.TOXIC} and 0 < len(ids) < len(scores)


def test_near_copies_stage(spark):
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(5, text), (3, text + " x"), (3, text + " x"), (3, text), (9, None), (9, None), (8, ""), (4, "other text"), (6, "Other  text"), (7, "on its own")]
    kept = C.drop_near_copies(spark, _docs(spark, rows), SF)
    got = sorted((r["doc_id"], r["text"] or "") for r in kept.collect())
    assert [i for i, _ in got] == [3, 4, 7, 8, 9, 9]
    assert all(r["hits"] == 3 and r["score"] == "own" for r in kept.collect())
    many = spark.read.parquet(f"{SF}/documents.parquet").limit(400)
    pairs = [(r["doc_id"], r["text"]) for r in many.select("doc_id", "text").collect()]
    many = _docs(spark, pairs)
    expected = {int(i) for i, _, least in brute_components(pairs) if i == least}
    assert {r["doc_id"] for r in C.drop_near_copies(spark, many, SF).collect()} == expected


def test_unrelated_texts_under_null_and_repeated_ids_stay(spark):
    far = [" ".join(f"{name}{k}" for k in range(40)) for name in "abcdef"]
    rows = [(None, far[0]), (None, far[1]), (None, far[1] + " x"), (None, far[1]), (7, far[2]), (7, far[3]), (7, far[3]), (None, far[4]), (8, far[4]), (None, None)]
    got = [(r["doc_id"], r["text"]) for r in C.drop_near_copies(spark, _docs(spark, rows), SF).collect()]
    copies = [x for x in got if x[1] and x[1].startswith(far[1])]
    assert len(copies) == 1 and copies[0][0] is None
    rest = [x for x in got if x not in copies]
    assert sorted(rest, key=str) == sorted([(None, far[0]), (7, far[2]), (7, far[3]), (8, far[4]), (None, None)], key=str)


def test_decontamination_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = C.drop_contaminated(spark, docs, SF)
    assert kept.columns == docs.columns
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    hits = brute_hits(rows, items)
    expected = {i for i, (n, hit, _) in hits.items() if not (hit > 0 and 20 * hit >= n)}
    assert {r["doc_id"] for r in kept.select("doc_id").collect()} == expected and len(expected) < len(rows)
    odd = C.drop_contaminated(spark, _docs(spark, [(1, None), (2, ""), (2, "")]), SF)
    assert odd.count() == 3 and odd.first()["hits"] == 3


def test_secrets_stage(spark):
    rows = [(1, 'x token = "2abc3ff2ca8fb1e4c565a0eb63815530a948bdde" y'), (2, "clean"), (3, None), (4, "")]
    out = {r["doc_id"]: r for r in C.redact_secrets(spark, _docs(spark, rows), SF).collect()}
    assert out[1]["text"] == 'x [assign]" y' and out[1]["n_chars"] == len(out[1]["text"]) and out[1]["spans"] == "mine"
    assert (out[2]["text"], out[2]["n_chars"]) == ("clean", 5) and out[3]["text"] is None and out[4]["text"] == ""
    assert not any(secrets.spans_of(r["text"] or "") for r in out.values())


@pytest.mark.parametrize("stage", [s for _, s in C.STAGES])
def test_empty_table(spark, stage):
    assert stage(spark, _docs(spark, []), SF).count() == 0


def test_run(spark):
    sf = "/root/testdata/sf0.001"
    rows = C.run(spark, sf).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.col("text")).collect()}
    assert 0 < len(rows) <= len(docs) and len({r["doc_id"] for r in rows}) == len(rows)
    assert all(r["n_tokens"] == len(r["ids"]) for r in rows)
