"""Registered queries of the operators, each over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from gaugeflow.llm import (
    html_text,
    line_crf,
    merkle,
    mixing,
    nbsvm,
    packing,
    periodic_runs,
    personal_data,
    pseudo_likelihood,
    simhash,
    url_cascade,
    vectors,
    windows,
)
from gaugeflow.llm.common import table

TOKENIZER = "byte_bpe_50k.json"


def tokenizer_path() -> str:
    return str(public_tokenizers.path(TOKENIZER))


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nbsvm.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op5_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return windows.repeated_passages(table(spark, sf_dir, "documents"))


def op6_line_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_crf.judge_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_cascade.judge(table(spark, sf_dir, "pages"), url_cascade.rules_frame(spark))


def op8_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihood.score(table(spark, sf_dir, "documents"))


def op9_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data.span_digests(personal_data.find_spans(table(spark, sf_dir, "documents")))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(merkle.manifest(table(spark, sf_dir, "documents")))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = periodic_runs.with_cycles(table(spark, sf_dir, "documents"))
    return periodic_runs.run_digests(periodic_runs.periodic_runs(docs))


def registered() -> dict:
    import corpus_pipeline

    own = (
        op1_mixing, op2_html_text, op3_quality, op4_packing, op5_passages, op6_line_labels, op7_url_rules,
        op8_pseudo_likelihood, op9_near_vectors, op10_simhash, op11_personal_data,
        op12_manifest, op13_periodic_runs,
    )
    return {f.__name__: f for f in own} | {"pipeline": corpus_pipeline.run}
