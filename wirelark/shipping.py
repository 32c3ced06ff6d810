"""Readies a session: Python workers import this package where it is not installed, and Arrow batches are bounded."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)
#: A batch for a Python worker ends at so many rows or bytes, so that its memory does not grow with the texts.
BATCHES = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}


def ship(spark: SparkSession) -> SparkSession:
    """Puts the folder of the package on the workers' path, and sets the bounds of a batch that the session leaves unset.

    On a cluster, install the package or use --py-files.
    """
    env = spark.sparkContext.environment
    have = env.get("PYTHONPATH", "")
    if ROOT not in have.split(":"):
        env["PYTHONPATH"] = f"{ROOT}:{have}" if have else ROOT
    chosen = spark.conf.getAll
    for key, value in BATCHES.items():
        if key not in chosen:
            spark.conf.set(key, value)
    return spark
