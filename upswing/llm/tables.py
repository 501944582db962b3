"""Where the registered queries and the pipeline find their tables and the tokenizer file."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession


BATCH_ROWS = 1000  # texts are long: this many rows at a time go to a Python worker


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")
