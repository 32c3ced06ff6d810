"""Shards of text files, written and read, cut by bytes and broken."""

import io
import tarfile
import zipfile

import pytest

from wirelark.sources import files, shards


def tarred(path, contents, compress=""):
    with tarfile.open(path, f"w{compress}") as f:
        for name, content in contents.items():
            info = tarfile.TarInfo(name)
            info.size = len(content)
            f.addfile(info, io.BytesIO(content))


def texts(n, size=700):
    return {f"d{i % 3}/{i}.txt": (f"{i} " * size).encode() for i in range(n)}


def test_pieces_are_planned_by_bytes():
    got = shards.planned([("a.txt", 10), ("b.txt", 10), ("c.tar", 95), ("d.txt", 25), ("e.tgz", 400), ("f.zip", 5)], 30)
    assert [tuple((p.path, p.start, p.end) for p in part) for part in got] == [
        (("c.tar", 0, 23),), (("c.tar", 23, 47),), (("c.tar", 47, 71),), (("c.tar", 71, 95),), (("a.txt", 0, 10), ("b.txt", 0, 10)), (("d.txt", 0, 25),), (("e.tgz", 0, 400),), (("f.zip", 0, 5),),
    ]
    assert shards.planned([], 5) == []


@pytest.mark.parametrize("kind", ["tar", "zip", "tgz", "files"])
@pytest.mark.parametrize("most", [1000, 1 << 20])
def test_every_member_is_read_once(spark, tmp_path, kind, most):
    want = texts(40)
    if kind == "zip":
        with zipfile.ZipFile(tmp_path / "s.zip", "w", zipfile.ZIP_DEFLATED) as f:
            for name, content in want.items():
                f.writestr(name, content)
            f.writestr("no.csv", "x")
    elif kind == "files":
        for name, content in want.items():
            (tmp_path / name).parent.mkdir(exist_ok=True)
            (tmp_path / name).write_bytes(content)
    else:
        tarred(tmp_path / f"s.{kind}", want | {"no.csv": b"x"}, "" if kind == "tar" else ":gz")
    got = shards.read(spark, [str(tmp_path), str(tmp_path / "missing")], partitionBytes=most)
    rows = got.collect()
    assert sorted((r.file.partition("!")[2] or r.file.removeprefix(f"{tmp_path}/"), bytes(r.content), r.error) for r in rows) == sorted((n, c, None) for n, c in want.items())
    if most == 1000 and kind in ("tar", "zip"):
        assert got.rdd.getNumPartitions() >= 5


def test_written_shards_are_read_again(spark, tmp_path):
    rows = [(f"{i}.txt", None if i == 3 else f"é{i}".encode() * i) for i in range(50)] + [("n" * 150 + "/long.tel", b"x")]
    frame = spark.createDataFrame(rows, "file string, content binary").repartition(3)
    shards.write(frame, str(tmp_path / "out"), shardBytes=4096)
    assert len(list((tmp_path / "out").glob("part-*.tar"))) > 3 and not list((tmp_path / "out").glob(".*.tmp"))
    got = {r.file.partition("!")[2]: bytes(r.content) for r in shards.read(spark, [str(tmp_path / "out")]).collect()}
    assert got == {n: c or b"" for n, c in rows}
    shards.write(frame.limit(1), str(tmp_path / "out"), mode="overwrite")
    assert shards.read(spark, [str(tmp_path / "out")]).count() == 1
    assert files.decoded(shards.read(spark, [str(tmp_path / "out")])).columns == ["file", "error", "text"]


def test_a_failed_job_leaves_no_shard(spark, tmp_path):
    bad = spark.range(10, numPartitions=2).selectExpr("cast(id AS string) AS file", "CASE WHEN id = 9 THEN cast(raise_error('stop') AS binary) ELSE cast('x' AS binary) END AS content")
    with pytest.raises(Exception, match="stop"):
        shards.write(bad, str(tmp_path / "out"))
    assert not list((tmp_path / "out").glob("part-*"))


@pytest.mark.parametrize("most", [3000, 1 << 20])
def test_broken_shards_are_error_rows(spark, tmp_path, most):
    want = texts(10)
    tarred(tmp_path / "cut.tar", want)
    whole = (tmp_path / "cut.tar").read_bytes()
    (tmp_path / "cut.tar").write_bytes(whole[: whole.index(b"7 7 7") + 100])  # in the middle of a member
    with zipfile.ZipFile(tmp_path / "bad.zip", "w") as f:
        for name, content in want.items():
            f.writestr(name, content)
    raw = bytearray((tmp_path / "bad.zip").read_bytes())
    raw[raw.index(b"5 5 5")] ^= 1
    (tmp_path / "bad.zip").write_bytes(raw)
    (tmp_path / "no.zip").write_bytes(b"not a zip" * 1000)
    (tmp_path / "no.tar").write_bytes(b"not a tar" * 1000)
    tarred(tmp_path / "header.tar", want)
    raw = bytearray((tmp_path / "header.tar").read_bytes())
    at = raw.index(b"d0/6.txt")
    raw[at : at + 200] = b"\xff" * 200
    (tmp_path / "header.tar").write_bytes(raw)
    rows = shards.read(spark, [str(tmp_path)], partitionBytes=most).collect()
    bad = sorted((r.file.removeprefix(f"{tmp_path}/"), r.content) for r in rows if r.error)
    assert bad == [("bad.zip!d2/5.txt", None), ("cut.tar!d1/7.txt", None), ("header.tar", None), ("no.tar", None), ("no.zip", None)]
    good = {r.file.removeprefix(f"{tmp_path}/"): bytes(r.content) for r in rows if not r.error}
    names = list(want)
    assert good == {f"bad.zip!{n}": c for n, c in want.items() if n != "d2/5.txt"} | {f"cut.tar!{n}": want[n] for n in names[:7]} | {f"header.tar!{n}": want[n] for n in names[:6]}


def test_nothing_there(spark, tmp_path):
    assert shards.read(spark, [str(tmp_path / "missing")]).collect() == [] and shards.read(spark, [str(tmp_path)]).collect() == []
