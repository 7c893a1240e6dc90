"""The corpus pipeline: toxicity, exact duplicates, near duplicates, benchmark items, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
A stage drops rows of documents or none: rejected as toxic, copies of a text (the largest doc_id stays), near
duplicates (the smallest doc_id of a class stays), holders of a benchmark item. The last returns packed pieces.

In every stage a null text counts as an empty one, other columns may have any names and go through as they are, and an
empty table stays empty. A very long text is judged as a whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from formloom.llm import decontaminate, exact_dedup, near_dedup, packing, toxicity
from formloom.llm.queries import read, tokenizer_path
from formloom.llm.shared import Scratch


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model trained on the labels doesn't reject. Repeated rows go or stay together; without labels of both kinds none goes unless most labels are toxic."""
    return toxicity.drop_toxic(docs, read(spark, sf_dir, "labels"))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each text: that of the largest doc_id, null ids last; of rows alike in both any one."""
    return exact_dedup.keep_distinct(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate class: that of the smallest doc_id, of several texts under it the least hash. Rows with a null id or without a word all stay."""
    return near_dedup.keep_one(docs)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item; all of them without a benchmark. Repeated rows go or stay together."""
    return decontaminate.drop_contaminated(docs, read(spark, sf_dir, "benchmark"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences; repeated rows are packed each, a null id is kept."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", toxicity_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("decontamination", benchmark_stage),
    ("packing", packing_stage),
]
ORACLE_SQL = None  # trained scores, signatures and token ids are beyond SQL: tests hold it against brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on documents; a stage's table goes when the next one's is written."""
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        scratch = Scratch(spark)
        docs = scratch.written(stage(spark, docs, sf_dir), name.replace(" ", "_"))
        if before is not None:
            before.drop()
        before = scratch
    return docs
