"""A corpus pipeline over the table of documents. Each stage takes (spark, docs, sf_dir), works on all rows that its
predecessor kept and returns the columns of documents; the last returns a row of digests for each document.

quality rules: documents that they reject go. line dedup: common blocks go from the later document's text. near-dedup:
one document of each class stays. decontamination: documents that hold a test item go. BPE: ids and decoded text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyloom.llm.bpe_chunks import encode_decode
from tallyloom.llm.common import drop_stage, materialize, table, texts
from tallyloom.llm.decontaminate import drop_contaminated
from tallyloom.llm.line_dedup import dedup_lines
from tallyloom.llm.near_dedup import keep_first
from tallyloom.llm.quality_rules import keep_good


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    out = dedup_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in docs.columns else out


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return encode_decode(texts(docs), public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality_rules", quality_rules), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("bpe", bpe)]

#: Expectation-maximisation, alignment, signatures and BPE are beyond SQL; tests hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
        if before is not None:
            drop_stage(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
