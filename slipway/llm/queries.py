"""One registered query per operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from slipway.llm import (bestfit, html_density, langmix, license_rules, neighbour_graph, periodic_runs, pivotal, repetition,
                         resampling, shingle_join, substring_dedup, token_alignment, token_store)
from slipway.llm.stored import workers_import
from slipway.session import scratch_path


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    workers_import(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_repetition(spark, sf_dir):
    return repetition.repetition_rules(table(spark, sf_dir, "documents"))


def op2_text_density(spark, sf_dir):
    return html_density.extract(table(spark, sf_dir, "pages"))


def op3_best_fit_packing(spark, sf_dir):
    return bestfit.pack_documents(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json")) \
        .select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op4_nn_descent(spark, sf_dir):
    return neighbour_graph.nearest(table(spark, sf_dir, "embeddings"), query_step=20, top=20)


def op5_licence_rules(spark, sf_dir):
    return license_rules.scan(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def op6_token_store(spark, sf_dir):
    return token_store.stored_documents(table(spark, sf_dir, "documents"), scratch_path(spark, "tokens"),
                                        tokenizer("byte_bpe_50k.json"))


def op7_shingle_join(spark, sf_dir):
    return shingle_join.near_duplicates(table(spark, sf_dir, "documents"), words=4, percent=85)


def op8_language_mixture(spark, sf_dir):
    return langmix.identify(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score", "langs")


def op9_pivotal_mix(spark, sf_dir):
    return pivotal.mix_sources(table(spark, sf_dir, "documents")) \
        .select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


def good():
    """Labelled rows that the target model learns from."""
    return (F.col("quality") == 1) & (F.col("toxic") == 0)


def op10_importance_resampling(spark, sf_dir):
    scored, _ = resampling.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), good())
    return scored


def op11_substring_dedup(spark, sf_dir):
    return substring_dedup.dedup(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark, sf_dir):
    return periodic_runs.periodic_runs(periodic_runs.with_planted_periods(table(spark, sf_dir, "documents")))


def op13_token_alignment(spark, sf_dir):
    return token_alignment.align(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"),
                                 tokenizer("piece_bpe_32k.model"))


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable]:
    found = [op1_suffix_repetition, op2_text_density, op3_best_fit_packing, op4_nn_descent, op5_licence_rules,
             op6_token_store, op7_shingle_join, op8_language_mixture, op9_pivotal_mix, op10_importance_resampling,
             op11_substring_dedup, op12_periodic_runs, op13_token_alignment, pipeline]
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    """The others are held against brute force in tests/llm."""
    return {"op5_licence_rules": license_rules.scan_sql()}
