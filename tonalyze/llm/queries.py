"""The registered queries of this package: each applies one operator, with
production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonalyze.llm import decontam, filter_audit, fim, langid, licenses, line_dedup, minhash_forest, packing, quality_cnn, quality_rules, sharding, suffix_dedup, toxicity
from tonalyze.llm.common import held_out, table

QueryFn = Callable[[SparkSession, str], DataFrame]


def op1_byte_cnn_quality(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    params = quality_cnn.QualityParams()
    net = quality_cnn.train(docs, table(spark, sf_dir, "labels"), params)
    return quality_cnn.classify(docs, net).select(
        "doc_id", held_out("doc_id", params.modulus, params.held_out), "score", "predicted")


def op2_license_inheritance(spark, sf_dir):
    """Documents as files: a path of source, language and shelves of 100 ids."""
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 100).cast("string"),
                       F.concat(F.col("doc_id").cast("string"), F.lit(".txt")))
    return licenses.scan(docs.select("doc_id", path.alias("path"), "text"))


def op3_lsh_forest(spark, sf_dir):
    return minhash_forest.near_duplicates(table(spark, sf_dir, "documents"))


def op4_line_dedup(spark, sf_dir):
    return line_dedup.repeats(table(spark, sf_dir, "documents")).drop("crc", "cut")


def op5_quality_rules(spark, sf_dir):
    done = quality_rules.apply_rules(table(spark, sf_dir, "documents"))
    return done.select("doc_id", *quality_rules.ADDED, "base_failed", "kept")


def op6_weak_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    params = toxicity.ToxicParams()
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), params)
    return toxicity.classify(docs, model).select(
        "doc_id", held_out("doc_id", params.modulus, params.held_out), "score", "predicted")


def op7_residual_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


def op8_segmentation_langid(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    params = langid.LangParams()
    found = langid.identify(docs, langid.train(docs, params))
    return found.select("doc_id", held_out("doc_id", params.modulus, params.held_out), "lang_pred", "score")


def op9_fm_decontamination(spark, sf_dir):
    found = decontam.decontaminate(table(spark, sf_dir, "documents"),
                                   table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op10_histogram_shards(spark, sf_dir):
    placed = sharding.shard(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", F.crc32(F.coalesce("text", F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit(sharding.LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op11_suffix_dedup(spark, sf_dir):
    done = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))
    return done.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op12_filter_audit(spark, sf_dir):
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_fill_in_middle(spark, sf_dir):
    return fim.digests(fim.transform(table(spark, sf_dir, "documents")))


QUERIES: dict[str, QueryFn] = {
    "op1_byte_cnn_quality": op1_byte_cnn_quality,
    "op2_license_inheritance": op2_license_inheritance,
    "op3_lsh_forest": op3_lsh_forest,
    "op4_line_dedup": op4_line_dedup,
    "op5_quality_rules": op5_quality_rules,
    "op6_weak_toxicity": op6_weak_toxicity,
    "op7_residual_packing": op7_residual_packing,
    "op8_segmentation_langid": op8_segmentation_langid,
    "op9_fm_decontamination": op9_fm_decontamination,
    "op10_histogram_shards": op10_histogram_shards,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_filter_audit": op12_filter_audit,
    "op13_fill_in_middle": op13_fill_in_middle,
}
