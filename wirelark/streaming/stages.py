"""The programs P1 and P3 to P5 over a stream of files: rows become rows, so the same stages run on batches and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import citations, tags
from ..operators import joins
from ..plans import jobs
from ..sources.files import decoded


def text_stream(spark: SparkSession, path: str, files_per_trigger: int = 1000) -> DataFrame:
    """(file, text) of files as they arrive."""
    schema = "path string, modificationTime timestamp, length long, content binary"
    read = spark.readStream.format("binaryFile").schema(schema).option("pathGlobFilter", "*.{txt,tel}").option("maxFilesPerTrigger", files_per_trigger).load(path)
    return decoded(read.selectExpr("path AS file", "content"))


def run(rows: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Appends a stream's rows as Parquet until the input that is there is done."""
    return rows.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def stages(records: DataFrame, stations: citations.Stations, dictionary: tags.TagDictionary) -> dict[str, DataFrame]:
    """P3, P4 and P5 of extracted records with their file, by name."""
    return {
        "dates": jobs.normalized_dates(records, stations),
        "citations": citations.normalized(joins.flattened(records, "file"), stations, "file"),
        "tags": jobs.tagged(records, stations, dictionary, ["file"]),
    }


def run_all(records: DataFrame, stations: citations.Stations, dictionary: tags.TagDictionary, path: str, checkpoint: str) -> StreamingQuery:
    """Writes a stream's records and what P3 to P5 make of them, each below ``path``, until the input that is there is done.

    A batch has a folder of its own in each table (column ``batch``), which it replaces: a batch that is run again after a
    failure, with some of its tables written, leaves each row once. Records are written first and the others made of
    them, so each text is read once.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark, place = batch.sparkSession, f"batch={number}"
        batch.write.mode("overwrite").parquet(f"{path}/records/{place}")
        own = spark.read.schema(batch.schema).parquet(f"{path}/records/{place}")
        for name, rows in stages(own, stations, dictionary).items():
            rows.write.mode("overwrite").parquet(f"{path}/{name}/{place}")

    return records.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def errors(records: DataFrame) -> DataFrame:
    """S9 over a stream: (file, error) of texts whose extraction failed."""
    return records.where(F.col("error").isNotNull()).select("file", "error")
