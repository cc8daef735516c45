"""The corpus pipeline: documents to packed training sequences.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written as Parquet
and read again as the next one's ``docs``.  All but the last return the columns of documents.
Every stage has the defined results of its operator for nulls, empty texts, repeats and empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estatelake.llm.decontaminate import clean_documents
from estatelake.llm.language_bloom import known_language
from estatelake.llm.queries import packed
from estatelake.llm.simhash_bktree import one_of_each
from estatelake.llm.suffix_dedup import remove_repeats
from estatelake.session import scratch_path

BATCH_ROWS = 2000  # rows of an Arrow batch: documents are long, and Spark's default of 10,000 is for short rows
LEAST_SCORE = 0.3  # share of a text's n-grams that its language must know


def long_rows(spark: SparkSession) -> None:
    """Set the session's Arrow batches for documents; a smaller setting of its own stays."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting)) <= BATCH_ROWS:
        spark.conf.set(setting, str(BATCH_ROWS))


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of a known language; those without letters or of no learned language go."""
    long_rows(spark)
    return known_language(docs, LEAST_SCORE)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked SimHash fingerprints."""
    long_rows(spark)
    return one_of_each(docs)


def suffix_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the strings of 100 bytes that start earlier; what loses all its words goes.

    A character that loses some of its bytes goes whole; ``n_chars`` follows the text.
    """
    long_rows(spark)
    cut = remove_repeats(docs, whole_characters=True)
    text = F.col("kept").cast("string")
    left = cut.where((F.col("n_removed") == 0) | (F.trim(text) != ""))
    size = F.when(F.col("n_removed") == 0, F.col("row.n_chars")).otherwise(F.length(text).cast("long"))
    fresh = {"text": text, "n_chars": size}
    return left.select(*[fresh[c].alias(c) if c in fresh else F.col(f"row.`{c}`") for c in docs.columns])


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any window of a benchmark item."""
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens."""
    long_rows(spark)
    return packed(docs)


STAGES = [
    ("language_id", language_stage),
    ("simhash_near_dedup", near_dedup_stage),
    ("suffix_array_dedup", suffix_dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("best_fit_packing", packing_stage),
]

# Training a filter, hashing and tokenizing are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``; each stage's input is deleted when its result is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        if before is not None:
            folder = spark._jvm.org.apache.hadoop.fs.Path(before)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
        before = path
    return docs
