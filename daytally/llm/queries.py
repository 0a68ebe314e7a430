"""The registered queries of this subpackage; each derives its digest columns from an operator's own output."""

from __future__ import annotations

import os
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from daytally.llm import (
    bpe,
    chat,
    decontaminate,
    html_text,
    katz,
    language_id,
    line_quality,
    quality_classifier,
    simhash,
    structure_repair,
    suffix_dedup,
    token_alignment,
    toxicity,
)
from daytally.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "word_bpe_49k.json"
BYTE_LEVEL, PIECES = "byte_bpe_50k.json", "piece_bpe_32k.model"


def tokenizer_path(name: str = TOKENIZER) -> str:
    """Where a public vocabulary file is on the driver; ``TOKENIZER_DIR`` names another folder."""
    folder = os.environ.get("TOKENIZER_DIR")
    return os.path.join(folder, name) if folder else str(public_tokenizers.path(name))


def op1_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz.score(table(spark, sf_dir, "documents"), order=3)


def op2_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality.line_quality(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.digests(table(spark, sf_dir, "documents"))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(table(spark, sf_dir, "documents"))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_classifier.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.repair(table(spark, sf_dir, "conversations"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.digests(table(spark, sf_dir, "documents"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = token_alignment.Vocabularies.read(tokenizer_path(BYTE_LEVEL), tokenizer_path(PIECES))
    return token_alignment.digests(table(spark, sf_dir, "documents"), files)


def op13_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return structure_repair.digests(table(spark, sf_dir, "conversations"))


QUERIES: dict[str, Query] = {
    "op1_katz": op1_katz,
    "op2_line_quality": op2_line_quality,
    "op3_simhash": op3_simhash,
    "op4_language_id": op4_language_id,
    "op5_toxicity": op5_toxicity,
    "op6_html_text": op6_html_text,
    "op7_quality": op7_quality,
    "op8_chat": op8_chat,
    "op9_bpe": op9_bpe,
    "op10_decontamination": op10_decontamination,
    "op11_suffix_dedup": op11_suffix_dedup,
    "op12_token_alignment": op12_token_alignment,
    "op13_structure_repair": op13_structure_repair,
}

ORACLES: dict[str, str] = {
    "op2_line_quality": line_quality.ORACLE,
    "op10_decontamination": decontaminate.ORACLE,
}
