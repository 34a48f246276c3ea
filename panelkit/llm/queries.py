"""Registered queries of the training-data operators (SQL: ``oracles``)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelkit.llm import (digest_tree, forced_bpe, lang_viterbi, license_templates, line_mph, link_trust, offset_pieces,
                          pareto_mix, phrase_index, quality_ftrl, signature_tree, sliced_index, threshold_topk)
from panelkit.llm._tables import table
from panelkit.llm.oracles import ORACLES

__all__ = ["ORACLES", "QUERIES", "vocabulary_path"]


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_threshold_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best other vectors of every vector whose id is divisible by 50."""
    return threshold_topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0, k=5)


def op2_quality_ftrl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every whole text, learned outside the held-out fold."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    fold = F.crc32(F.col("doc_id").cast("string")) % 4
    weights = quality_ftrl.learn(docs, labels, fold != 2)
    return quality_ftrl.score_quality(docs, weights).select(
        F.col("id").alias("doc_id"), F.coalesce(F.crc32(F.col("id").cast("string")) % 4 == 2, F.lit(False)).alias("held_out"),
        "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op3_license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and accepted templates of every whole text. The score is
    1 where a template accepts, 0.5 where only a phrase stands, else 0."""
    found = license_templates.scan_licenses(table(spark, sf_dir, "documents"))
    base = F.filter("matches", lambda m: m["kind"] == "phrase")

    def joined(matches):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")
    return found.select(
        F.col("id").alias("doc_id"), "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(F.transform(base, lambda m: m["first"])).alias("first_word"),
        F.array_max(F.transform(base, lambda m: m["first"])).alias("last_word"),
        joined(base).alias("base_labels"), joined(F.col("matches")).alias("labels"),
        F.when(F.exists("matches", lambda m: m["kind"] == "template"), 1.0).when(F.size("matches") > 0, 0.5)
        .otherwise(0.0).alias("score"))


def op4_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed to the weights 1, 2, 3 of their sources."""
    mixed = pareto_mix.mix(table(spark, sf_dir, "documents"))
    return mixed.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op5_forced_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BPE ids of every whole text and their decoding, as digests."""
    vocabulary = forced_bpe.read_vocabulary(vocabulary_path())
    coded = forced_bpe.round_trip(table(spark, sf_dir, "documents"), vocabulary)
    return coded.select(F.col("id").alias("doc_id"), (F.length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_link_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every url judged by the rules, else by its host's trust and distrust."""
    judged = link_trust.judge(table(spark, sf_dir, "pages"))
    return judged.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict")


def op7_signature_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose 3-word shingles link at a Jaccard of 0.9."""
    found = signature_tree.jaccard_components(table(spark, sf_dir, "documents"), shingle=3, percent=90)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def op8_line_mph(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts without the long lines that stand in five documents or more."""
    kept = line_mph.drop_frequent_lines(table(spark, sf_dir, "documents"))
    return kept.select(F.col("id").alias("doc_id"), "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op9_lang_viterbi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every whole text, learned outside the held-out fold."""
    docs = table(spark, sf_dir, "documents")
    held_out = lang_viterbi.held_out("doc_id")
    model = lang_viterbi.learn(docs, ~held_out)
    return lang_viterbi.label_languages(docs, model).select(
        F.col("id").alias("doc_id"), lang_viterbi.held_out("id").alias("held_out"), "lang_pred", "score")


def op10_digest_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact dedup of all documents; the largest doc_id of equal texts stays."""
    found = digest_tree.tree_dedup(table(spark, sf_dir, "documents"), keep="max")
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
                        F.lower(F.hex("digest")).alias("text_sha256"))


def op11_offset_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces, source spans and decoding of every whole text, as digests."""
    model = offset_pieces.read_model(vocabulary_path("piece_bpe_32k.model"))
    coded = offset_pieces.round_trip(table(spark, sf_dir, "documents"), model)
    return coded.select(F.col("id").alias("doc_id"), (F.length("ids") / 4).cast("long").alias("n_tokens"),
                        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
                        F.sha2("spans", 256).alias("spans_sha256"))


def op12_sliced_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents with their near words, forms and roots."""
    return sliced_index.variants(table(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


def op13_phrase_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 collocations of every language."""
    return phrase_index.collocations(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (op1_threshold_topk, op2_quality_ftrl, op3_license_templates, op4_pareto_mix,
                                      op5_forced_bpe, op6_link_trust, op7_signature_tree, op8_line_mph, op9_lang_viterbi, op10_digest_tree,
                                      op11_offset_pieces, op12_sliced_variants, op13_phrase_index)}
