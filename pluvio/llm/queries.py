"""The named queries ``opN_...`` and their DuckDB twins."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.llm import op01_quality_rules as op1
from pluvio.llm import op02_ngram_jaccard as op2
from pluvio.llm import op03_secret_scans as op3
from pluvio.llm import op04_license_scans as op4
from pluvio.llm import op05_packing as op5
from pluvio.llm import op06_decontamination as op6
from pluvio.llm import op07_token_counts as op7
from pluvio.llm import op08_sharding as op8
from pluvio.llm import op09_chat_format as op9
from pluvio.llm import op10_quality_classifier as op10
from pluvio.llm import op11_fill_in_middle as op11
from pluvio.llm import op12_pii as op12
from pluvio.llm import op13_embedding_whitening as op13
from pluvio.llm.common import table
from pluvio.llm.oracle import ORACLE
from pluvio.session import scratch_path


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = op1.build_ledger(table(spark, sf_dir, "documents"))
    judged = op1.apply_policy(op1.apply_policy(ledger, op1.FULL), op1.BASE, "base_kept")
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         (~F.col("base_kept")).alias("base_failed"), "kept", "fail_bits")


def rule_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ablation tables of all policies from one ledger: what each rule rejects,
    what it alone rejects, and what the policy would keep without it."""
    ledger = op1.build_ledger(table(spark, sf_dir, "documents"))
    tables = [op1.ablations(ledger, p) for p in (op1.BASE, op1.FULL_1, op1.FULL, op1.PROSE)]
    return reduce(DataFrame.unionByName, tables)


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2.join(table(spark, sf_dir, "documents"))


def op3_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents come in two deliveries, by source, over one ledger."""
    ledger = op3.BlobLedger(spark, scratch_path(spark, "blob-ledger"))
    later = F.pmod(F.xxhash64("source"), F.lit(2)) == 1
    return op3.report(table(spark, sf_dir, "documents"), ledger, (~later, later))


def op4_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4.scan(table(spark, sf_dir, "documents"))


def tokenizer_file(name: str) -> str:
    """Place of a vocabulary file; the package is installed on every node."""
    import public_tokenizers
    return str(public_tokenizers.path(name))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5.pack(table(spark, sf_dir, "documents"), tokenizer_file(op5.Packing.tokenizer))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return op7.token_counts(docs, tokenizer_file("piece_bpe_32k.model")).drop("text")


def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = op8.shard(table(spark, sf_dir, "documents"), n_shards=16)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), F.col("shard").cast("int").alias("shard"),
                       F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    text = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], "conv_id long, turn long, role string, text string")
    return op9.digests(op9.format_conversations(conv.unionByName(own)))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11.report(table(spark, sf_dir, "documents"))


def op12_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op12.report(table(spark, sf_dir, "documents"))


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13.whiten(table(spark, sf_dir, "embeddings"))


QUERIES = {f.__name__: f for f in (op1_quality_rules, rule_ablations, op2_ngram_jaccard, op3_secret_scans, op4_license_scans, op5_packing, op6_decontamination,
                                 op7_token_counts, op8_sharding, op9_chat_format, op10_quality_classifier, op11_fill_in_middle, op12_pii,
                                 op13_embedding_whitening)}

__all__ = ["ORACLE", "QUERIES"]
