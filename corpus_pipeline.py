"""From documents to token ids: five stages over all rows, each written and read again.

``STAGES`` lists them; every function takes ``(spark, docs, sf_dir)``. All but the last return the
columns of ``docs``, whatever they are. SQL can't state near-duplicate classes, so there
is no SQL for the whole; the stages are tested against brute force.

1. quality: documents that the standard rule policy rejects go.
2. near_dedup: of each near-duplicate class the row with the smallest id stays (of rows that share
   this id, the smallest text). Rows without an id are named by their text first, above all ids.
3. passage_dedup: text that repeats 50 bytes of a document with a smaller id is cut out and
   ``n_chars``, where there is one, counted anew; a document left without a word goes.
4. mixing: documents are drawn by the raked shares within a budget of as many tokens as there are. Those
   of scarce cells come several times, in rows of their own, so that all targets are met.
5. encoding: texts become SentencePiece ids, with a flag that they decode to the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelhouse.llm.prefix_free import repeated_passages
from parcelhouse.llm.probminhash import near_duplicates
from parcelhouse.llm.raking import MOST_ROUNDS, TOLERANCE, mixed
from parcelhouse.llm.rule_ledger import kept_documents
from parcelhouse.llm.scratch_tables import written
from parcelhouse.llm.sentencepiece_text import encoded

ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return kept_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    named = F.coalesce(
        F.col("doc_id").cast("bigint"),
        F.lit(1 << 62) + F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(1 << 61)))
    rows = docs.select(named.alias("_id"), F.struct("*").alias("row"))
    classes = near_duplicates(rows.select(F.col("_id").alias("doc_id"), F.col("row.text").alias("text")))
    stays = classes.where("doc_id = class_id").select(F.col("doc_id").alias("_id")).distinct()
    others = [c for c in docs.columns if c != "text"]
    first = F.min(F.struct("row.text", F.struct(*(F.col(f"row.{c}") for c in others)).alias("rest")))
    kept = rows.join(stays, "_id", "left_semi").groupBy("_id").agg(first.alias("one"))
    return kept.select("one.text", "one.rest.*").select(*docs.columns)


def passage_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    cut = repeated_passages(
        docs.select("doc_id", "text", F.struct("*").dropFields("text").alias("row")),
        carry=("row",), keep_text=True)
    out = cut.select("doc_id", F.decode("kept", "UTF-8").alias("text"), *(f"row.{c}" for c in rest))
    if "n_chars" in rest:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out.where(F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    rows = docs.select("doc_id", "source", "lang", "text", F.struct("*").alias("row"))
    drawn = mixed(rows, repeat=True, rounds=MOST_ROUNDS, tolerance=TOLERANCE).where("kept")
    times = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies")))
    return drawn.select("row", times.alias("_")).select("row.*")


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encoded(docs, public_tokenizers.path("piece_bpe_32k.model"), merges=True)


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("passage_dedup", passage_dedup),
    ("mixing", mixing),
    ("encoding", encoding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each works on what the one before wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = written(docs, name)
    return docs
