"""A corpus from raw documents to token files: toxicity, near duplicates, decontamination, mixing, token ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quarry.llm.common import small_batches, table, written
from quarry.llm.decontam import decontaminate
from quarry.llm.minhash import near_duplicates
from quarry.llm.mixing import mixed
from quarry.llm.queries import byte_bpe
from quarry.llm.token_ids import encode_and_read
from quarry.llm.toxicity import fit, keep_clean

#: Near duplicates of the pipeline: shingles of five words, a similarity of 0.8.
WORDS, PERCENT = 5, 80


def remove_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject by their language's threshold.

    Null and empty texts are scored as texts without words; rows without a doc_id are scored but train nothing; equal
    rows fare alike. Where there are no labels, or labels of one kind only, all documents stay. An empty table stays empty.
    """
    with small_batches(spark):
        return written(keep_clean(docs, fit(docs, table(spark, sf_dir, "labels"))), "clean")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest doc_id.

    Rows that repeat a doc_id and its text go too; null doc_ids stay, and so do texts without words. An empty table stays empty.
    """
    kept = near_duplicates(docs, WORDS, PERCENT).where("kept and doc_id is not null").select("doc_id").distinct()
    once = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("doc_id")
    mark = "_" * (1 + max(map(len, docs.columns)))  # no other column's name
    found = docs.join(written(kept, "kept"), "doc_id", "left_semi").withColumn(mark, F.row_number().over(once)).where(F.col(mark) == 1).drop(mark)
    return found.union(docs.where("doc_id is null"))


def remove_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of the benchmark. Null and empty texts hold none; without items all documents stay."""
    with small_batches(spark):
        return written(decontaminate(docs, table(spark, sf_dir, "benchmark")), "decontaminated")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """As many copies of each document as the mix takes; none of documents without words. Rows that share a doc_id, or have none, are documents of their own."""
    return mixed(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: doc_id, start, n_tokens, ids_crc32. Each copy of a document has its row; an empty table gives none."""
    return encode_and_read(docs, byte_bpe())


STAGES = [
    ("toxicity", remove_toxic),
    ("minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", remove_benchmark),
    ("source_mixing", mix),
    ("token_output", write_tokens),
]

#: The stages train a classifier, verify similarities and encode tokens: not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
