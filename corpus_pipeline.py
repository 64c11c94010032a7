"""The corpus pipeline: quality, near duplicates, contamination, secrets,
packing. Each stage reads what the one before it kept.

Every stage but the last returns the columns of documents. Rows without
doc_id are not grouped as near duplicates; every other case is as the
operators' docstrings say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.llm import op02_ngram_jaccard as op2
from pluvio.llm import op03_secret_scans as op3
from pluvio.llm import op05_packing as op5
from pluvio.llm import op06_decontamination as op6
from pluvio.llm import op10_quality_classifier as op10
from pluvio.llm.common import free_name, table, text_key
from pluvio.llm.queries import tokenizer_file
from pluvio.session import scratch_path


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go. It learns from the labelled
    rows of this stage's input."""
    space, out = op10.train(docs, table(spark, sf_dir, "labels")), free_name(docs, "_score")
    return op10.score(docs, space, out=out).where(F.col(out) >= 0.5).select(*docs.columns)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays: the least doc_id, and
    one row of it. Texts without words are no duplicates of each other.
    Rows are looked up by doc_id and text, so rows that repeat a doc_id with
    texts of other classes stay."""
    key = free_name(docs, "_text_key")
    found = op2.members_of_classes(docs).where("doc_id = class_id").withColumnRenamed("text_key", key)
    keep = found.where("root IS NOT NULL").groupBy("root").agg(F.min(F.struct("doc_id", key)).alias("r")).select("r.*")
    wordless = found.where("root IS NULL").select("doc_id", key).distinct()
    keyed = docs.withColumn(key, text_key(F.col("text")))
    named = keyed.join(keep, ["doc_id", key], "left_semi").dropDuplicates(["doc_id", key])
    named = named.unionByName(keyed.join(wordless, ["doc_id", key], "left_semi"))
    return named.select(*docs.columns).unionByName(docs.where("doc_id IS NULL"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go, each row by its own text."""
    bad, bad_text = free_name(docs, "_bad"), free_name(docs, "_bad_text")
    found = op6.judged(docs, table(spark, sf_dir, "benchmark")).where("contaminated")
    found = found.select(F.col("doc_id").alias(bad), F.col("text_key").alias(bad_text))
    same = F.col("doc_id").eqNullSafe(F.col(bad)) & (text_key(F.col("text")) == F.col(bad_text))
    return docs.join(found, same, "left_anti")


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret span becomes a mark; n_chars follows the text."""
    blob, spans, own = (free_name(docs, n) for n in ("_blob", "_spans", "_own"))
    ledger = op3.BlobLedger(spark, scratch_path(spark, "blob-ledger"))
    hits = ledger.scan_unseen(op3.addressed(docs)).where(F.size("spans") > 0)
    hits = hits.select(F.col("blob").alias(blob), F.col("spans").alias(spans))
    clean = docs.withColumn(own, text_key(F.col("text"))).join(hits, F.col(own) == F.col(blob), "left")
    text = F.when(F.col(spans).isNull(), F.col("text")).otherwise(op3.redacted(F.col("text"), F.col(spans)))
    clean = clean.withColumn("text", text)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.when(F.col(spans).isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast("long")))
    return clean.select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of all documents in sequences of at most 4096, as op5 packs
    them: null texts are empty ones, repeated rows and rows without doc_id are
    packed like others, an empty table gives no rows, other columns go."""
    return op5.pack(docs, tokenizer_file(op5.Packing.tokenizer))


STAGES = [
    ("quality classifier", classify),
    ("n-gram Jaccard join", deduplicate),
    ("benchmark decontamination", decontaminate),
    ("secret scans", redact),
    ("packing", pack),
]

# The classifier's vectors and the tokenizer are not expressible in SQL; the
# tests hold run() against a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet in the shared
    folder and read again by the next."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage-{i}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
