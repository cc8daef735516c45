"""The registered queries of the operators: each applies one to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estatelake.llm.decontaminate import decontaminate
from estatelake.llm.language_bloom import identify
from estatelake.llm.lattice_neardup import near_vectors
from estatelake.llm.license_diagonals import scan_licenses
from estatelake.llm.lookup_sharding import place
from estatelake.llm.merkle_manifest import fold, leaf, manifest, siblings
from estatelake.llm.prefix_trie import branched, trie, turn_lists
from estatelake.llm.shared import lower_ascii
from estatelake.llm.simhash_bktree import near_duplicates
from estatelake.llm.slack_packing import pack
from estatelake.llm.suffix_dedup import remove_repeats
from estatelake.llm.superkmer_dedup import remove_windows
from estatelake.llm.url_filter import filter_urls
from estatelake.llm.wrapper_extract import main_texts


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without the strings of 100 bytes that also start earlier."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs).select(
        F.col("row.doc_id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2(F.coalesce("kept", F.lit(b"")), 256).alias("kept_sha256")
    )


def op2_language_bloom(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of each document, learned from the documents that are not held out."""
    out = identify(read(spark, sf_dir, "documents"))
    return out.select(F.col("id").alias("doc_id"), "held_out", F.col("lang").alias("lang_pred"), "score")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document that stand inside benchmark windows."""
    out = decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return out.select(
        F.col("doc").alias("doc_id"),
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op4_lattice_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links of each vector and the component it is in."""
    out, _ = near_vectors(read(spark, sf_dir, "embeddings"))
    return out.select(
        F.col("id").alias("vec_id"),
        "n_links",
        F.col("component").alias("component_id"),
        F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"),
    )


def op5_simhash_bktree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash of each document and its component of linked fingerprints."""
    out = near_duplicates(read(spark, sf_dir, "documents"))
    return out.select(
        F.col("doc").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def packed(docs: DataFrame) -> DataFrame:
    return pack(docs).select(
        F.col("doc").alias("doc_id"),
        "piece",
        "start",
        "length",
        F.col("crc").alias("ids_crc32"),
        F.col("sequence").alias("sequence_id"),
        "offset",
    )


def op6_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents packed into sequences of at most 2048 tokens."""
    return packed(read(spark, sf_dir, "documents"))


def op7_lookup_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The shard of each document."""
    return place(read(spark, sf_dir, "documents"), "doc_id").withColumnRenamed("key", "doc_id")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and lines of each document."""
    return scan_licenses(read(spark, sf_dir, "documents")).withColumnRenamed("doc", "doc_id")


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on each page's URL."""
    return filter_urls(read(spark, sf_dir, "pages")).withColumnRenamed("id", "page_id")


def op10_wrapper_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of each page."""
    out = main_texts(read(spark, sf_dir, "pages"))
    return out.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("long").alias("n_chars"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nodes of the trie of rebuilt conversations."""
    nodes = trie(branched(turn_lists(read(spark, sf_dir, "conversations"))))
    return nodes.select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent").alias("parent_conv_id"),
        F.col("members").alias("n_convs"),
        F.col("children").alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
    )


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of each document, and the root that its own or a tampered leaf folds to."""
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    forged = leaf([lower_ascii(F.col("text")) if c == "text" else F.col(c) for c in columns])
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    out = manifest(read(spark, sf_dir, "documents"), "doc_id", "source", columns, {"forged": F.when(chosen, forged)})
    folded = out.withColumn("folded_root", fold(F.coalesce("more.forged", "leaf"), F.col("path")))
    return folded.select(
        F.col("key").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        F.sha2(siblings(F.col("path")), 256).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_superkmer_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without the windows of 13 words that also start in an earlier document."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_windows(docs).select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_removed", F.sha2(F.coalesce("kept", F.lit(b"")), 256).alias("kept_sha256")
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_suffix_dedup,
        op2_language_bloom,
        op3_decontaminate,
        op4_lattice_neardup,
        op5_simhash_bktree,
        op6_slack_packing,
        op7_lookup_sharding,
        op8_license_scan,
        op9_url_filter,
        op10_wrapper_extract,
        op11_prefix_trie,
        op12_merkle_manifest,
        op13_superkmer_dedup,
    )
}
