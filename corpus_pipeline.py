"""Corpus pipeline over ``documents``: five filters and encoders, each written and read again.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; all but the last return the
columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from hourglass.llm.common import shared_dir
from hourglass.llm.decontaminate import remove_benchmark
from hourglass.llm.jaccard_join import keep_one
from hourglass.llm.langid import keep_identified
from hourglass.llm.sentencepiece_codec import tokenize
from hourglass.llm.toxicity import drop_toxic

STAGES = [
    ("language_id", keep_identified),
    ("toxicity", drop_toxic),
    ("ngram_jaccard", keep_one),
    ("decontamination", remove_benchmark),
    ("sentencepiece", tokenize),
]

#: SQL cannot express the stages; tests hold each against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order; what each keeps is written below the shared folder and read by the next."""
    folder = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
