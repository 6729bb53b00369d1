"""Corpus pipeline: the stages, one after the other, over ``documents``.

Each stage takes all that its predecessor kept and, but for the last, returns
documents with the same columns; other columns than ``doc_id`` and ``text`` are
passed through. Stages that change a text keep ``n_chars`` right where it exists.
Null texts count as empty; empty texts are clean and pass.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidepool.llm import bpe, common, decontam, jaccard, secrets, toxicity
from tidepool.llm.queries import tokenizer

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

#: Score from which a document is rejected as toxic.
TOXIC = 0.7


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the machine, fitted on the labelled ones, does not reject."""
    model = toxicity.fit(docs, common.read_table(spark, sf_dir, "labels"))
    (score,) = common.fresh(docs, "score")
    return toxicity.score(docs, model, score_col=score).where(F.col(score) < TOXIC).select(docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of exact and near copies: the smallest id, once; a null id last.

    Texts without words are no copies of each other and all stay.
    """
    blank = ~F.coalesce(F.col("text"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    worded = docs.where(~blank)
    found = jaccard.join(worded.select("doc_id", "text"))
    # the root names a component; ids do not, as they may be null or repeat in unrelated texts
    first = F.min(F.struct(F.col("doc_id").isNull().alias("null"), "doc_id", "node", "text_key")).alias("first")
    copies = found.groupBy("root").agg(first).select("first.doc_id", "first.text_key")
    null, name, key, row = common.fresh(docs, "null", "name", "key", "row")

    def keyed(df: DataFrame, text_key) -> DataFrame:
        plain = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
        return df.withColumns({null: F.col("doc_id").isNull(), name: plain, key: text_key})

    chosen = keyed(copies, F.col("text_key")).select(null, name, key)
    kept = keyed(worded, F.xxhash64("text")).join(chosen, [null, name, key])
    # of rows that repeat id and text one stays; they are reduced before the shuffle, however many
    own = F.struct(*docs.columns)
    again = kept.groupBy(null, name, key).agg(F.min_by(own, F.xxhash64(*docs.columns)).alias(row))
    return again.select(f"{row}.*").unionByName(docs.where(blank))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of whose words less than a twentieth stand in benchmark passages."""
    own = docs.select(F.struct(*docs.columns).alias("_row"), F.col("text").alias("_text"))
    found = decontam.find_hits(own, common.read_table(spark, sf_dir, "benchmark"), text_col="_text")
    return found.where(~decontam.contaminated()).select("_row.*")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets replaced by their kind in brackets."""
    (spans,) = common.fresh(docs, "spans")
    clean = secrets.scan_and_redact(docs, spans_col=spans)
    if "n_chars" in docs.columns:
        length = F.length("text").cast(docs.schema["n_chars"].dataType)
        clean = clean.withColumn("n_chars", F.when(F.size(spans) > 0, length).otherwise(F.col("n_chars")))
    return clean.select(docs.columns)


def encode_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each kept text and the text that they decode to."""
    path = tokenizer("word_bpe_49k.json")
    coded = bpe.round_trip(docs.select("doc_id", "text"), path).drop("text")
    return coded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", drop_toxic),
    ("jaccard_join", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("secret_scans", redact_secrets),
    ("bpe", encode_documents),
]

#: The toxicity stage is a trained model and the secret scan a dynamic programme; SQL expresses neither.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Applies the stages; each but the last is written to the shared folder and reread."""
    docs = common.read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.shared_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
