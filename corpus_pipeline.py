"""A training-data pipeline over ``documents``: five stages, each written and read again.

Language ID drops documents whose language can't be told; near duplicates are
reduced to one document a class; passages of 50 words or more that an earlier
document has are cut out; sources are mixed to target weights; the rest is
encoded to SentencePiece ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strutwise.llm.forest import near_duplicate_stage
from strutwise.llm.langid import language_stage
from strutwise.llm.mixing import mix_stage
from strutwise.llm.pieces import encode_stage
from strutwise.llm.substrings import passage_stage
from strutwise.sources.storage import alone, written

STAGES = [
    ("language", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("passages", passage_stage),
    ("mix", mix_stage),
    ("encode", encode_stage),
]

#: Trained classifiers and hashed draws have no SQL form; the stages are tested one by one.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the rows of the last.

    Each stage's result takes the place of what it and the stage before it
    wrote. Nulls, empty tables and columns of other names are as the stages say.
    """
    docs, since = spark.read.parquet(f"{sf_dir}/documents.parquet"), written()
    for name, stage in STAGES:
        docs = alone(stage(spark, docs, sf_dir), f"stage-{name}", since)
    return docs
