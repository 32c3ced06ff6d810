"""A stream of files against a batch of the same files, stopped, started and failed in between."""

import pytest
from pyspark.errors import StreamingQueryException

from wirelark.functions.citations import Stations
from wirelark.functions.tags import TagDictionary
from wirelark.plans.extract import extracted
from wirelark.sources import files
from wirelark.streaming import stages

from .test_telegram import ATTRS, BODY, telegram

STATIONS = Stations({"PARIS": [], "STATE": []})
TAGS = TagDictionary(permanent={"PFOR": "Foreign"}, temporary={}, organizations={}, geographic=[{"FR": "France"}])


def put(folder, numbers):
    for k in numbers:
        body = BODY.replace("A. STATE 105386", f"A. STATE {k}; B. 75 PARIS {k + 1}").replace("TAGS: PFOR, FR", f"TAGS: PFOR, X{k}" if k % 2 else "TAGS: PFOR, FR")
        (folder / f"{k:03}.txt").write_text(telegram(body, ATTRS.replace("1973PARIS00123", f"1973PARIS{k:05}") + "Draft Date: 04 JUL 1973\n") if k % 5 else "no body")


def rows(frame):
    return sorted(str({k: v for k, v in r.asDict(recursive=True).items() if k != "batch"}) for r in frame.collect())


def batch(spark, folder):
    records = extracted(files.text_files(spark, [str(folder)]))
    return {"records": rows(records)} | {n: rows(f) for n, f in stages.stages(records, STATIONS, TAGS).items()}


def streamed(spark, folder, out, check, **how):
    query = stages.run_all(extracted(stages.text_stream(spark, str(folder), **how)), STATIONS, TAGS, str(out), str(check))
    query.awaitTermination(200)
    return query


def written(spark, out):
    return {n: rows(spark.read.parquet(f"{out}/{n}")) for n in ("records", "dates", "citations", "tags")}


def test_a_stream_that_starts_again_gives_what_a_batch_gives(spark, tmp_path, monkeypatch):
    folder, out, check = tmp_path / "in", tmp_path / "out", tmp_path / "check"
    folder.mkdir()
    put(folder, range(1, 7))
    streamed(spark, folder, out, check, files_per_trigger=4)
    assert written(spark, out) == batch(spark, folder)
    put(folder, range(7, 12))
    # the next batch fails when its records and dates are written and its citations are not
    real = stages.stages

    def failing(records, *dictionaries):
        made = real(records, *dictionaries)
        made["citations"] = made["citations"].selectExpr("*", "raise_error('stop') AS stop")
        return made

    monkeypatch.setattr(stages, "stages", failing)
    with pytest.raises(StreamingQueryException):
        streamed(spark, folder, out, check)
    assert len(rows(spark.read.parquet(f"{out}/records"))) == 11 and len(rows(spark.read.parquet(f"{out}/tags"))) == 6
    monkeypatch.setattr(stages, "stages", real)
    streamed(spark, folder, out, check)
    assert written(spark, out) == batch(spark, folder)
    streamed(spark, folder, out, check)  # nothing new
    assert written(spark, out) == batch(spark, folder)


@pytest.mark.parametrize("name", ["dates", "citations", "tags"])
def test_each_stage_is_a_stream_of_its_own(spark, tmp_path, name):
    (tmp_path / "in").mkdir()
    put(tmp_path / "in", range(4))
    stream = stages.stages(extracted(stages.text_stream(spark, str(tmp_path / "in"))), STATIONS, TAGS)[name]
    stages.run(stream, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination(120)
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == batch(spark, tmp_path / "in")[name]
