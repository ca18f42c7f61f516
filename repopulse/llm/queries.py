"""One query per operator, over its whole table, with the settings meant for production."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from repopulse.llm import (
    chaining,
    chat_grammar,
    edit_counts,
    heap_clusters,
    hilbert,
    importance,
    jaccard_tiles,
    piece_lattice,
    posting_lists,
    radix_draw,
    retrieval_packing,
    url_models,
    winnowing,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "documents")


URL_RULES = [
    url_models.Rule("allow", "org/"),
    url_models.Rule("block", "example.org/es/"),
    url_models.Rule("block", "example.org/en/1"),
    url_models.Rule("allow", "com/fr/"),
    url_models.Rule("block", "com/de/"),
]


def url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on the address of every page."""
    return url_models.judged(_table(spark, sf_dir, "pages"), URL_RULES)


def sentencepiece_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's piece ids, their number and checksum, and whether they decode to its text."""
    model = public_tokenizers.path("piece_bpe_32k.model")
    docs = _documents(spark, sf_dir)
    return piece_lattice.round_trip(docs, model)


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every document before and after three edits made from its own text.

    A quarter in, five characters go; half way, twelve give way to the text's first eight; the first
    twenty are added at the end.
    """
    n = F.length("text")

    def edit(start, stop, text):
        return F.struct(
            start.cast("bigint").alias("start"), stop.cast("bigint").alias("stop"), text.alias("text")
        )

    edits = F.array(
        edit(F.floor(n / 4), F.floor(n / 4) + 5, F.lit("")),
        edit(F.floor(n / 2), F.floor(n / 2) + 12, F.substring("text", 1, 8)),
        edit(n, n, F.substring("text", 1, 20)),
    )
    return edit_counts.counted_edits(
        _documents(spark, sf_dir),
        edits,
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
    ).drop("edited_text")


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that importance resampling draws, with their weights and keys."""
    judged = importance.judged(_documents(spark, sf_dir), _table(spark, sf_dir, "labels"))
    return judged.where("kept").drop("kept")


def nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest other vectors of every vector whose id is divisible by 20."""
    vectors = _table(spark, sf_dir, "embeddings")
    return posting_lists.nearest(vectors, vectors.where("vec_id % 20 = 0"))


def document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Winnowed fingerprints of every document and of its edited text."""
    return winnowing.compared_with_next(_documents(spark, sf_dir))


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of at least 50 words that an earlier document has too."""
    return chaining.passages(_documents(spark, sf_dir))


def sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 16 shards along a Hilbert curve over language, source, length and id."""
    return hilbert.sharded(_documents(spark, sf_dir), ["lang", "source", "n_chars", "doc_id"])


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 2048 tokens."""
    return retrieval_packing.packed(
        _documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json")
    )


def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that share 85 per cent of their 4-word shingles."""
    return jaccard_tiles.jaccard_groups(_documents(spark, sf_dir), size=4, percent=85)


def centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight clusters of the vectors after ten rounds, with distances, inertia and centroid digests."""
    found = heap_clusters.clustered(_table(spark, sf_dir, "embeddings"))
    digest = F.lit(None).cast("string")
    for number, centroid in enumerate(found.centroids):
        listing = F.lit(",".join(map(str, centroid)))
        digest = F.when(F.col("cluster") == number, F.sha2(listing, 256)).otherwise(digest)
    return heap_clusters.with_inertia(found).withColumn("centroid_sha256", digest)


def importance_draw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights and scores of all documents towards the benchmark texts, and the ranks of those drawn."""
    return radix_draw.resampled(_documents(spark, sf_dir), _table(spark, sf_dir, "benchmark"))


def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, and one that imitates the markup, formatted, read back and digested."""
    text = "\\### Assistant: </turn> ok"
    columns = ["conv_id", "turn", "role", "text"]
    more = spark.createDataFrame(
        [(-7, 0, "user", text), (-7, 1, "assistant", text)],
        "conv_id bigint, turn bigint, role string, text string",
    )
    turns = _table(spark, sf_dir, "conversations").select(columns).unionByName(more)
    return chat_grammar.digests(chat_grammar.formatted(turns))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": url_filter,
    "op2_sentencepiece": sentencepiece_round_trip,
    "op3_token_counts": token_counts,
    "op4_quality_classifier": quality_classifier,
    "op5_nearest_neighbours": nearest_neighbours,
    "op6_document_fingerprints": document_fingerprints,
    "op7_substring_dedup": substring_dedup,
    "op8_sharding": sharding,
    "op9_packing": packing,
    "op10_ngram_jaccard_join": ngram_jaccard_join,
    "op11_centroid_clustering": centroid_clustering,
    "op12_importance_draw": importance_draw,
    "op13_chat_formatting": chat_formatting,
}
