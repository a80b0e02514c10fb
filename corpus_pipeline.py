"""The corpus pipeline: five stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which `run` writes as Parquet to
the shared folder and reads back, so every stage works on all its predecessor kept and a lost
executor costs part of one stage. All but the last return the columns of documents. Stages that
only drop rows send texts to Python and get flags or ids back.

Defined results: null texts and those without a letter go in the first stage, so the others see
them only in tests, where they stay as they are; rows that repeat an id and a text are judged
alike and stay or go together; a null id groups with nothing; of ties the smallest id stays; an
empty table passes through all stages empty. Other columns are passed through, whatever their
names, up to the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txscore.llm.circulant import near_duplicates
from txscore.llm.decontaminate import drop_contaminated
from txscore.llm.langid import accept, held_out, learn, least_scores
from txscore.llm.pieces import decode, encode
from txscore.llm.queries import piece_model
from txscore.llm.secrets import learn_formats, mask_secrets
from txscore.llm.tasks import written_table


#: Ids that are sent to every task; more meet the documents in a shuffled join.
BROADCAST_IDS = 1_000_000


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the languages that their labels teach; the others go."""
    teachers = docs.filter(~F.coalesce(held_out(F.col("doc_id")), F.lit(False)))
    profiles = learn(teachers)
    return accept(docs, profiles, least_scores(teachers, profiles))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near duplicates.

    A stage on word shingles takes five words; documents with a null id stay. The ids that go are
    counted: up to `BROADCAST_IDS` of them reach every task, so texts are not shuffled."""
    gone = written_table(near_duplicates(docs, shingle=5).filter("not kept and doc_id is not null")
                         .select("doc_id").distinct(), "gone")
    if gone.count() <= BROADCAST_IDS:
        gone = F.broadcast(gone)
    return docs.join(gone, "doc_id", "left_anti").select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which benchmark windows cover less than a twentieth of the words."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets masked and n_chars that of the new text."""
    masked = mask_secrets(docs, learn_formats(docs))
    if "n_chars" in docs.columns:
        masked = masked.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return masked.select(docs.columns)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, lossless): ids with merge-dropout, decoded again and compared.

    The ids are written in between, so that a task has one Python worker at a time."""
    path, raw = piece_model(), F.col("text").cast("binary")
    return decode(written_table(encode(docs, path), "encoded"), path).select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids",
        ((F.crc32(raw) == F.col("text_crc32")) & (F.length(raw) == F.col("n_bytes"))).alias("lossless"))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("sentencepiece", sentencepiece),
]

#: No stage but decontamination can be said in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written_table(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
