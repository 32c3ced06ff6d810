"""Reading whole text files and line-delimited records, samples, and writing."""

from __future__ import annotations

import warnings

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType


def existing(spark: SparkSession, paths: list[str]) -> list[str]:
    """The paths that are there, patterns too; a missing one gives a warning."""
    found = []
    for path in paths:
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        if not _there(spark, place):
            warnings.warn(f"{path} is missing and is skipped", stacklevel=2)
        else:
            found.append(path)
    return found


def _there(spark: SparkSession, place) -> bool:
    matched = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place)
    return matched is not None and len(matched) > 0


def text_files(spark: SparkSession, paths: list[str], pattern: str = "*.{txt,tel}") -> DataFrame:
    """(file, text) of all files below the paths; bad UTF-8 becomes U+FFFD and line ends become ``\\n``.

    Missing paths are skipped with a warning; if none is there, no row.
    """
    there = existing(spark, paths)
    if not there:
        return spark.createDataFrame([], "file string, text string")
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(there)
    return decoded(read.select(F.col("path").alias("file"), "content"))


def decoded(rows: DataFrame) -> DataFrame:
    """Column ``content`` as ``text``."""
    text = F.regexp_replace(F.make_valid_utf8(F.col("content").cast("string")), "\r\n?", "\n")
    return rows.withColumn("text", text).drop("content")


def sample(rows: DataFrame, key: str, n: int, seed: int = 0) -> DataFrame:
    """S3: n rows, always the same, by a hash of their key; all rows if there are no more."""
    return rows.orderBy(F.xxhash64(F.lit(seed), key), key).limit(n)


def first(rows: DataFrame, key: str, n: int) -> DataFrame:
    """The first n rows by key."""
    return rows.orderBy(key).limit(n)


def records(spark: SparkSession, paths: list[str], schema: StructType) -> DataFrame:
    """One record a line; blank and undecodable lines are skipped."""
    kept = StructType([*schema.fields, StructField("_corrupt_record", StringType())])
    rows = spark.read.schema(kept).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_corrupt_record").json(paths)
    # a filter on the corrupt column alone would make Spark read that column alone
    return rows.where(F.col("_corrupt_record").isNull()).select(*[f.name for f in schema.fields])


def numbered_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, line, value) of the lines of text files, lines counted from 1, blank ones too.

    Lines are counted within the blocks that Spark reads, and the blocks of a file, few of them, are summed up: no file is
    read by one task alone.
    """
    lines = spark.read.text(paths).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")).withColumn("n", F.monotonically_increasing_id())
    blocks = lines.groupBy("file", "block").agg(F.min("n").alias("first"), F.count(F.lit(1)).alias("lines"))
    before = F.coalesce(F.sum("lines").over(W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    return lines.join(blocks.withColumn("before", before), ["file", "block"]).select("file", (F.col("before") + F.col("n") - F.col("first") + 1).alias("line"), "value")


def records_strict(spark: SparkSession, paths: list[str], schema: StructType) -> DataFrame:
    """One record a line with its file and line; blank lines are skipped, the first undecodable line fails the job and names itself."""
    rows = numbered_lines(spark, paths).where(F.trim("value") != "")
    kept = StructType([*schema.fields, StructField("_corrupt_record", StringType())])
    rows = rows.withColumn("r", F.from_json("value", kept, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}))
    bad = F.raise_error(F.concat(F.lit("not a record: "), "file", F.lit(":"), F.col("line").cast("string"))).cast(schema)
    record = F.when(F.col("r")["_corrupt_record"].isNull(), F.struct(*[F.col("r")[f.name].alias(f.name) for f in schema.fields])).otherwise(bad)
    return rows.select(record.alias("r"), "file", "line").select("r.*", "file", "line")


def write_records(rows: DataFrame, path: str, mode: str = "error") -> None:
    """One object a line, nulls written out."""
    rows.write.mode(mode).option("ignoreNullFields", "false").json(path)


def split_errors(rows: DataFrame, error: str = "error") -> tuple[DataFrame, DataFrame]:
    """(good rows, rows whose extraction failed): a failed document never ends the job."""
    return rows.where(F.col(error).isNull()).drop(error), rows.where(F.col(error).isNotNull())
