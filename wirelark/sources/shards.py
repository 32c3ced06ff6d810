"""S1, S2, S9 as a data source: folders of text files, and tar or zip shards of them, in partitions planned by bytes.

    shards.register(spark)
    rows = spark.read.format("text_shards").option("partitionBytes", 64 << 20).load("/data/telegrams")  # file, content, error
    rows.write.format("text_shards").mode("append").save("/data/shards")                                # file, content

A folder of millions of small files costs a listing and an open for each; the same files in shards cost one of each for
a shard. A shard larger than ``partitionBytes`` is cut: each task goes from header to header of a tar (or through the
directory of a zip) without reading contents, and reads the members that begin in its own range. Small files and shards
are put together. Compressed tars cannot be cut and are one partition each.

Members other than ``*.txt`` and ``*.tel`` (option ``pattern``, endings by comma) are skipped; missing paths are skipped
with a warning. A member that cannot be read is one row with its error and no content, and so is a shard without a
readable directory, or the rest of a tar behind a broken header; nothing fails the job. Rows come in no order; the name of
a member is ``shard!member``. Paths may be on any store that pyarrow opens.

Written shards hold about ``shardBytes`` (128 MB) each; they get their names when all tasks have ended, so a task may run
twice and a failed job leaves none.
"""

from __future__ import annotations

import io
import sys
import tarfile
import uuid
import warnings
import zipfile
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

PACKED = (".tar", ".zip", ".tar.gz", ".tgz")
_SCHEMA = "file string, content binary, error string"
#: A batch of rows ends at so many rows or bytes.
_ROWS, _BYTES = 1000, 8 << 20

# planning happens in a process of its own, which need not have this package on its path
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def filesystem(path: str):
    """The store and the path in it."""
    from pyarrow import fs

    if "://" in path:
        return fs.FileSystem.from_uri(path)
    return fs.LocalFileSystem(), path.removeprefix("file:")


@dataclass(frozen=True)
class Piece:
    """A file, or the members of a shard that begin from ``start`` on, before ``end``."""

    path: str
    start: int
    end: int

    @property
    def packed(self) -> bool:
        return self.path.lower().endswith(PACKED)


@dataclass
class Pieces(InputPartition):
    pieces: tuple[Piece, ...]

    def __init__(self, pieces: tuple[Piece, ...]):
        super().__init__(None)
        self.pieces = pieces


def planned(files: list[tuple[str, int]], most: int) -> list[tuple[Piece, ...]]:
    """Files (path, size) as partitions of about ``most`` bytes: large shards cut, small files together in their order."""
    out, held, size = [], [], 0
    for path, n in sorted(files):
        piece = Piece(path, 0, n)
        cuts = -(-n // most) if piece.packed and path.lower().endswith((".tar", ".zip")) else 1
        if cuts > 1:
            out += [(Piece(path, n * k // cuts, n * (k + 1) // cuts),) for k in range(cuts)]
            continue
        if held and size + n > most:
            out.append(tuple(held))
            held, size = [], 0
        held.append(piece)
        size += max(n, 1)
    return [*out, tuple(held)] if held else out


def members(store, piece: Piece, wanted: tuple[str, ...]) -> Iterator[tuple[str, bytes | None, str | None]]:
    """(name, content, error) of a piece."""
    told = lambda e: f"{type(e).__name__}: {e}"[:500]
    if not piece.packed:
        try:
            with store.open_input_stream(piece.path) as f:
                yield piece.path, f.read(), None
        except Exception as e:  # noqa: BLE001 - reported in the row
            yield piece.path, None, told(e)
        return
    read = _zipped if piece.path.lower().endswith(".zip") else _tarred
    try:
        raw = store.open_input_file(piece.path)
    except Exception as e:  # noqa: BLE001 - reported in the row
        yield piece.path, None, told(e)
        return
    with raw:
        for name, get, error in read(raw, piece):
            if name is None:
                yield piece.path, None, told(error)
            elif name.lower().endswith(wanted):
                try:
                    yield f"{piece.path}!{name}", get(), None
                except Exception as e:  # noqa: BLE001 - reported in the row
                    yield f"{piece.path}!{name}", None, told(e)


def _zipped(raw, piece: Piece) -> Iterator[tuple]:
    try:
        shard = zipfile.ZipFile(raw)
    except Exception as e:  # noqa: BLE001 - reported in the row
        if not piece.start:
            yield None, None, e
        return
    for info in shard.infolist():
        if piece.start <= info.header_offset < piece.end and not info.is_dir():
            yield info.filename, lambda info=info: shard.read(info), None


def _tarred(raw, piece: Piece) -> Iterator[tuple]:
    whole = not piece.path.lower().endswith(".tar")
    shard = None
    try:
        shard = tarfile.open(fileobj=io.BufferedReader(raw, 1 << 16) if not whole else raw, mode="r:gz" if whole else "r:")
        while (info := shard.next()) is not None:
            shard.members = []  # of a long shard, only the place is kept
            if not whole and info.offset >= piece.end:
                return
            if info.isfile() and (whole or info.offset >= piece.start):
                yield info.name, lambda info=info: _content(shard, info), None
        shard.fileobj.seek(shard.offset)
        if shard.fileobj.read(tarfile.BLOCKSIZE).strip(b"\0"):  # the library takes a broken header for the end
            raise tarfile.ReadError(f"no header at {shard.offset}")
    except Exception as e:  # noqa: BLE001 - reported in the row
        if whole or piece.start <= (shard.offset if shard else 0) < piece.end:  # once, by the piece that holds the place
            yield None, None, e


def _content(shard: tarfile.TarFile, info: tarfile.TarInfo) -> bytes:
    content = shard.extractfile(info).read()
    if len(content) != info.size:
        raise tarfile.ReadError(f"{len(content)} of {info.size} bytes")
    return content


class ShardReader(DataSourceReader):
    def __init__(self, options):
        self.paths = [p for p in (options.get("paths") or options.get("path") or "").split("\n") if p]
        self.most = int(options.get("partitionBytes", 64 << 20))
        self.wanted = tuple(f".{e.strip().lower().lstrip('.')}" for e in options.get("pattern", "txt,tel").split(","))

    def partitions(self):
        from pyarrow import fs

        files, base = [], {}
        for path in self.paths:
            store, place = filesystem(path)
            info = store.get_file_info(place)
            if info.type == fs.FileType.NotFound:
                warnings.warn(f"{path} is missing and is skipped", stacklevel=2)
                continue
            found = [info] if info.type == fs.FileType.File else store.get_file_info(fs.FileSelector(place, recursive=True))
            for f in found:
                hidden = any(part.startswith((".", "_")) for part in f.path[len(place) :].split("/"))
                if f.type == fs.FileType.File and not hidden and f.path.lower().endswith((*self.wanted, *PACKED)):
                    files.append((f.path, f.size))
                    base[f.path] = path.partition("://")[0] + "://" if "://" in path else ""
        files = [(base[p] + p if base[p] not in ("", "file://") else p, n) for p, n in dict(files).items()]
        return [Pieces(p) for p in planned(files, self.most)] or [Pieces(())]

    def read(self, partition: Pieces) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("file", pa.string()), ("content", pa.binary()), ("error", pa.string())])
        rows, size = [], 0
        for piece in partition.pieces:
            store, place = filesystem(piece.path)
            for name, content, error in members(store, Piece(place, piece.start, piece.end), self.wanted):
                rows.append((name, content, error))
                size += len(content or b"")
                if len(rows) >= _ROWS or size >= _BYTES:
                    yield _batch(rows, schema)
                    rows, size = [], 0
        if rows:
            yield _batch(rows, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


@dataclass
class Written(WriterCommitMessage):
    """Temporary and final paths of a task's shards."""

    shards: tuple[tuple[str, str], ...]


class ShardWriter(DataSourceArrowWriter):
    def __init__(self, options, overwrite: bool):
        self.path, self.overwrite = options["path"].rstrip("/"), overwrite
        self.most = int(options.get("shardBytes", 128 << 20))

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        store, place = filesystem(self.path)
        store.create_dir(place, recursive=True)
        done, out, shard = [], None, None
        for batch in iterator:
            names, contents = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("file", "content"))
            for name, content in zip(names, contents, strict=True):
                if shard is not None and shard.offset >= self.most:
                    shard.close()
                    out.close()
                    shard = None
                if shard is None:
                    final = f"{place}/part-{uuid.uuid4().hex}.tar"
                    temp = f"{place}/.{final.rpartition('/')[2]}.tmp"
                    done.append((temp, final))
                    out = store.open_output_stream(temp)
                    shard = tarfile.open(fileobj=out, mode="w|", format=tarfile.PAX_FORMAT)
                info = tarfile.TarInfo(name)
                info.size = len(content or b"")
                shard.addfile(info, io.BytesIO(content or b""))
        if shard is not None:
            shard.close()
            out.close()
        return Written(tuple(done))

    def commit(self, messages: list[Written | None]) -> None:
        from pyarrow import fs

        store, place = filesystem(self.path)
        if self.overwrite:
            for f in store.get_file_info(fs.FileSelector(place, allow_not_found=True)):
                if f.base_name.startswith("part-") and f.path.lower().endswith(PACKED):
                    store.delete_file(f.path)
        for temp, final in (s for m in messages if m for s in m.shards):
            store.move(temp, final)

    def abort(self, messages: list[Written | None]) -> None:
        store, _ = filesystem(self.path)
        for temp, _ in (s for m in messages if m for s in m.shards):
            store.delete_file(temp)


class TextShards(DataSource):
    """(file, content, error) of text files and shards of them."""

    @classmethod
    def name(cls) -> str:
        return "text_shards"

    def schema(self) -> str:
        return _SCHEMA

    def reader(self, schema) -> ShardReader:
        return ShardReader(self.options)

    def writer(self, schema, overwrite: bool) -> ShardWriter:
        return ShardWriter(self.options, overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(TextShards)


def read(spark: SparkSession, paths: list[str], **options: object) -> DataFrame:
    """(file, content, error) of all files and members below the paths."""
    register(spark)
    return spark.read.format("text_shards").options(**options).option("paths", "\n".join(paths)).load()


def write(rows: DataFrame, path: str, mode: str = "append", **options: object) -> None:
    """Columns ``file`` and ``content`` as tar shards below a path."""
    register(rows.sparkSession)
    rows.select("file", "content").write.format("text_shards").mode(mode).options(**options).save(path)
