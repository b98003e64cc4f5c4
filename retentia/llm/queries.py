"""The registered queries of this package, each over its whole table with production settings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retentia.llm import bpe, centroids, fingerprints, language, licenses, linededup, mixing, neardup, repeats, resampling, sharding, topk, wordwindows
from retentia.llm.common import documents

SHARDS = tuple(f"shard-{i:02d}" for i in range(64))
SLOTS = 8191  # a prime, 128 slots per shard
# The base phrases that the query's contract fixes, with the operator's notices.
LICENSES = (
    licenses.Template("mit", "under the mit license", True),
    licenses.Template("apache-2", "apache license version 2", True),
    licenses.Template("cc-by-nc", "cc by nc", True),
    *[t for t in licenses.TEMPLATES if not t.phrase],
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


@query
def op1_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """The shard of every document, by doc_id."""
    return sharding.assign_shards(documents(spark, folder).select("doc_id"), "doc_id", SHARDS, SLOTS)


@query
def op2_mixing(spark: SparkSession, folder: str) -> DataFrame:
    """Words that the mix takes from every document."""
    mixed = mixing.mix_counts(documents(spark, folder))
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query
def op8_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Predicted language of every document, fitted on the rows that are not held out."""
    return language.with_language(documents(spark, folder)).select("doc_id", "held_out", "lang_pred", "score")


@query
def op10_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The five highest integer inner products of every query vector."""
    table = spark.read.parquet(f"{folder.rstrip('/')}/embeddings.parquet")
    vectors = topk.whole_vectors(table, "vec_id", "embedding", 256)
    return topk.top_k(vectors, vectors.where(F.col("vec_id") % 50 == 0), k=5)


@query
def op4_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Near-duplicate component of every document."""
    return neardup.near_duplicates(documents(spark, folder))


@query
def op5_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of every document's token ids and of what they decode to."""
    import public_tokenizers  # no other query needs the vocabulary files

    content = bpe.load(public_tokenizers.path("word_bpe_49k.json"))
    docs = documents(spark, folder).select("doc_id", "text")
    done = bpe.decode(bpe.encode(docs, content, keep=["doc_id"]), content)
    text = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return done.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(text.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    """License phrases and notices in every document."""
    return licenses.scan_licenses(documents(spark, folder), templates=LICENSES)


@query
def op7_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return fingerprints.edited_fingerprints(documents(spark, folder))


@query
def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Lines deleted from every document, and what is left."""
    done = linededup.dedup_lines(documents(spark, folder).select("doc_id", "text"))
    return done.select("row.doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("kept", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


@query
def op9_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes of every document that belong to a repeated string of 400 bytes, and what is left: ``kept`` is its text, null where it is none."""
    done = repeats.remove_repeats(documents(spark, folder).select("doc_id", "text"))
    size = F.coalesce(F.octet_length("row.text"), F.lit(0)).cast("bigint")
    left, text = (size - F.col("n_removed")).alias("n_kept"), F.col("kept").cast("string")
    text = F.when(F.is_valid_utf8(text), text).alias("kept")  # a cut may part the bytes of a character
    return done.select("row.doc_id", size.alias("n_bytes"), "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"), left, text)


@query
def op11_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every document that a window of 50 words covers which stands in an earlier document, and what is left."""
    done = wordwindows.remove_repeated_windows(documents(spark, folder).select("doc_id", "text"))
    left = (F.col("n_words") - F.col("n_removed")).alias("n_kept")
    return done.select("row.doc_id", "n_words", "n_removed", "kept_sha256", left, F.col("kept").cast("string").alias("kept"))


@query
def op12_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """Weight and score of every document towards the benchmark's texts, and the rank of those that are drawn."""
    target = spark.read.parquet(f"{folder.rstrip('/')}/benchmark.parquet")
    done = resampling.resample(documents(spark, folder), target, keep=["doc_id"])
    return done.select("row.doc_id", "n_features", "weight", "score", "rank")


@query
def op13_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    """Cluster of every embedding that counts, with its squared distance and its cluster's digest."""
    done = centroids.cluster_vectors(spark.read.parquet(f"{folder.rstrip('/')}/embeddings.parquet"))
    return done.select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
