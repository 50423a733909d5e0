"""Session settings that the operators' tasks need."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

BATCH_ROWS = 1000
ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ready(spark: SparkSession) -> None:
    """Let Python workers import this package wherever the driver was started,
    and hand them rows in batches of a few megabytes of text."""
    batch = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(batch)) <= BATCH_ROWS:
        spark.conf.set(batch, str(BATCH_ROWS))
    env = spark.sparkContext.environment
    if ROOT not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(filter(None, [ROOT, env.get("PYTHONPATH", "")]))


def tokenizer_path() -> str:
    """The packing tokenizer's public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
