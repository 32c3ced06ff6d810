"""Files in and out, and the stages over a stream."""

import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from wirelark.plans.extract import extracted
from wirelark.shipping import ship
from wirelark.sources import files
from wirelark.streaming import stages

from .test_telegram import telegram


def test_text_files(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "a.txt").write_bytes(b"x\r\ny\xffz\r")
    (tmp_path / "deep/b.tel").write_text("t")
    (tmp_path / "c.csv").write_text("no")
    got = {r.file.rpartition("/")[2]: r.text for r in files.text_files(spark, [str(tmp_path)]).collect()}
    assert got == {"a.txt": "x\ny�z\n", "b.tel": "t"}


def test_records(spark, tmp_path):
    (tmp_path / "r.json").write_text('{"a": 1, "b": null}\n\nnot json\n{"a": 2}\n')
    schema = StructType.fromDDL("a int, b string")
    assert sorted(r.a for r in files.records(spark, [str(tmp_path)], schema).collect()) == [1, 2]
    files.write_records(spark.createDataFrame([(1, None)], "a int, b string").coalesce(1), str(tmp_path / "out"))
    assert '"b":null' in next((tmp_path / "out").glob("part-*")).read_text()


def test_sample_is_stable(spark):
    rows = spark.range(100).select(F.col("id").cast("string").alias("k"))
    a, b = ([r.k for r in files.sample(rows.repartition(n), "k", 10).collect()] for n in (1, 7))
    assert a == b and files.sample(rows, "k", 1000).count() == 100


def test_a_failed_text_is_a_row(spark, monkeypatch):
    rows = spark.createDataFrame([("good", telegram()), ("null", None)], "file string, text string")
    good, bad = files.split_errors(extracted(rows))
    assert {r.file for r in good.collect()} == {"good", "null"} and bad.count() == 0


def test_stream(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/a.txt").write_text(telegram())
    q = stages.run(extracted(stages.text_stream(spark, str(tmp_path / "in"))), str(tmp_path / "out"), str(tmp_path / "check"))
    q.awaitTermination(120)
    assert spark.read.parquet(str(tmp_path / "out")).first()["from"] == "AMEMBASSY PARIS"


def test_batches_are_bounded_by_bytes_and_rows(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_pydict({"rows": [b.num_rows], "bytes": [b.nbytes]})

    session = ship(spark.newSession())
    long = session.range(60, numPartitions=1).select(F.repeat(F.lit("x"), 1 << 20).alias("text"))
    seen = long.mapInArrow(sizes, "rows long, bytes long").collect()
    assert sum(r.rows for r in seen) == 60 and max(r.bytes for r in seen) <= 10 << 20
    short = session.range(5000, numPartitions=1).mapInArrow(sizes, "rows long, bytes long").collect()
    assert sum(r.rows for r in short) == 5000 and max(r.rows for r in short) == 2000


def test_a_chosen_batch_size_stays(spark):
    session = spark.newSession()
    session.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "777")
    assert ship(session).conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "777"
