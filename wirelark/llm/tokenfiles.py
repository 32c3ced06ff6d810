"""Operator 7: token ids in files of independent zstandard frames with a trailing seek table.

A file holds one frame for each document (with zstandard's own checksum), a skippable frame with the width of an id and
the documents' ids, and the public seekable format's seek table: sizes and a checksum for each frame. A reader needs
the tail of the file and the frames asked for, nothing else.

Documents are dealt to files by ranges of doc_id. The bounds come from a bounded sample of ids with the sizes of their
texts, so that files hold about as many bytes each, ``file_bytes`` at most; file n is written by partition n alone. An id
of very many rows is dealt to several neighbouring files. Files are written under a temporary name and renamed, so a task
can run twice. Empty and null texts have the end id alone; rows that repeat a doc_id are neighbours, in the order of their
frames; null ids come first; an empty table gives no file and no row.
"""

from __future__ import annotations

import math
import struct
import uuid
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import texts, work_dir
from .tokens import default_tokenizer, library_bpe

#: Fixed values of the public formats: skippable frames, seek table and its footer, with checksums.
DIRECTORY_MAGIC, SEEK_MAGIC, FOOTER_MAGIC, CHECKSUMS = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1, 0x80


def filesystem(uri: str):
    """A file system and a path in it, for a path or a URI of any store that pyarrow knows."""
    from pyarrow import fs

    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


def frame_of(ids: np.ndarray, level: int = 3) -> bytes:
    return zstandard.ZstdCompressor(level=level, write_checksum=True, write_content_size=True).compress(ids.tobytes())


#: Stands for a null id in a file's directory.
_FIRST = -(1 << 63)


class TokenWriter:
    """Writes frames in order, then the directory and the seek table; the file appears when it is whole."""

    def __init__(self, uri: str, width: int):
        self.fs, self.path = filesystem(uri)
        self.temp, self.width = f"{self.path}.{uuid.uuid4().hex}.tmp", width
        self.fs.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.out = self.fs.open_output_stream(self.temp)
        self.doc_ids, self.table, self.tokens = [], [], 0

    def add(self, doc_id: int | None, frame: bytes, n_tokens: int, checksum: int) -> None:
        self.out.write(frame)
        self.doc_ids.append(_FIRST if doc_id is None else doc_id)
        self.table.append((len(frame), n_tokens * self.width, checksum))
        self.tokens += n_tokens

    def close(self) -> None:
        ids = struct.pack("<I", self.width) + np.array(self.doc_ids, "<i8").tobytes()
        self.out.write(struct.pack("<II", DIRECTORY_MAGIC, len(ids)) + ids)
        table = np.array(self.table, "<u4").reshape(-1, 3)
        self.out.write(struct.pack("<II", SEEK_MAGIC, table.nbytes + 9) + table.tobytes() + struct.pack("<IBI", len(table), CHECKSUMS, FOOTER_MAGIC))
        self.out.close()
        self.fs.move(self.temp, self.path)


class TokenReader:
    """Reads the tail of a file, then any document's frame by its place in the file."""

    def __init__(self, uri: str):
        self.fs, path = filesystem(uri)
        self.file = self.fs.open_input_file(path)
        size = self.file.size()
        n, flags, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != FOOTER_MAGIC or flags != CHECKSUMS:
            raise ValueError(f"{uri} has no seek table with checksums")
        begin = size - 9 - 12 * n - 8
        self.table = np.frombuffer(self._at(begin + 8, 12 * n), "<u4").reshape(n, 3)
        self.places = np.concatenate([[0], np.cumsum(self.table[:, 0], dtype=np.int64)])
        head = self._at(int(self.places[-1]), begin - int(self.places[-1]))
        if struct.unpack("<I", head[:4])[0] != DIRECTORY_MAGIC:
            raise ValueError(f"{uri} has no directory")
        (self.width,) = struct.unpack("<I", head[8:12])
        self.doc_ids = np.frombuffer(head[12:], "<i8")

    def _at(self, place: int, size: int) -> bytes:
        self.file.seek(place)
        return self.file.read(size)

    def __len__(self) -> int:
        return len(self.table)

    def read(self, place: int) -> np.ndarray:
        """Ids of one document; its frame alone is read and checked."""
        compressed, plain, checksum = (int(x) for x in self.table[place])
        data = zstandard.ZstdDecompressor().decompress(self._at(int(self.places[place]), compressed), max_output_size=plain)
        if len(data) != plain or xxhash.xxh64_intdigest(data) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {place} is damaged")
        return np.frombuffer(data, f"<u{self.width}").astype(np.uint32)

    def close(self) -> None:
        self.file.close()


def bounds_of(source: DataFrame, file_bytes: int, least_bytes: int, most_sampled: int) -> np.ndarray:
    """Ids at which files begin, with repeats where one id fills several; the sample has about ``most_sampled`` ids.

    Four files for each core, if that leaves ``least_bytes`` of text to each.
    """
    count = source.count()
    share = min(1.0, most_sampled / max(1, count))
    draw = F.pmod(F.xxhash64("doc_id", F.octet_length(F.coalesce("text", F.lit(""))), F.lit("files")), F.lit(1 << 30)) / float(1 << 30)
    sampled = source.where(draw < share) if share < 1 else source
    size = F.octet_length(F.coalesce("text", F.lit(""))).cast("long") + F.lit(16).cast("long")
    rows = sampled.select(F.coalesce("doc_id", F.lit(_FIRST)).alias("doc_id"), size.alias("n")).limit(2 * most_sampled).toArrow()
    ids, sizes = rows.column("doc_id").to_numpy(), rows.column("n").to_numpy()
    total = sizes.sum() / share
    files = max(math.ceil(total / file_bytes), min(4 * source.sparkSession.sparkContext.defaultParallelism, math.ceil(total / least_bytes)), 1)
    order = np.argsort(ids, kind="stable")
    ids, upto = ids[order], np.cumsum(sizes[order])
    at = np.searchsorted(upto, upto[-1] * np.arange(1, files) / files) if len(ids) else []
    return ids[np.minimum(at, len(ids) - 1)] if len(ids) and files > 1 else np.empty(0, np.int64)


def write(docs: DataFrame, folder: str, path: str | None = None, *, end_id: int = 1, file_bytes: int = 256 << 20, least_bytes: int = 1 << 20, most_sampled: int = 200_000) -> list[dict]:
    """Writes the files and returns, in order, one dict a file: uri, base (ids of all files before it), docs, tokens."""
    path = path or default_tokenizer()
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    bounds = bounds_of(source, file_bytes, least_bytes, most_sampled)

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end = library_bpe(path), np.array([end_id], np.uint32)
        kind = np.dtype("<u2") if max(*bpe.tokens, end_id) < 1 << 16 else np.dtype("<u4")
        for part, rows in texts(batches):
            ids = [np.concatenate([np.frombuffer(bpe.encode(t), "<u4"), end]).astype(kind) for t in rows]
            keys = np.array([_FIRST if d is None else d for d in part.column(0).to_pylist()], np.int64)
            checksums = np.array([xxhash.xxh64_intdigest(x.tobytes()) & 0xFFFFFFFF for x in ids], np.int64)
            low, high = np.searchsorted(bounds, keys, side="left"), np.searchsorted(bounds, keys, side="right")
            # an id that is a bound may lie on either side of it; one of several bounds is dealt to all files between
            file = np.where(high - low > 1, low + checksums % np.maximum(1, high - low + 1), high)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(file.astype(np.int32)), part.column(0), pa.array([len(x) for x in ids], pa.int64()),
                    pa.array(checksums), pa.array([x.itemsize for x in ids], pa.int32()), pa.array([frame_of(x) for x in ids], pa.binary()),
                ],
                names=["file", "doc_id", "n", "checksum", "width", "frame"],
            )

    def put(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        writer, now, done = None, None, []

        def close() -> None:
            writer.close()
            done.append((now, len(writer.doc_ids), writer.tokens))

        for batch in batches:
            for file, doc_id, n, checksum, width, frame in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if file != now:
                    if writer:
                        close()
                    writer, now = TokenWriter(f"{folder}/tokens-{file:06d}.zst", width), file
                writer.add(doc_id, frame, n, checksum)
        if writer:
            close()
        if done:
            f, d, t = zip(*done, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(f, pa.int32()), pa.array(d, pa.int64()), pa.array(t, pa.int64())], names=["file", "docs", "tokens"])

    frames = source.mapInArrow(encode, "file int, doc_id long, n long, checksum long, width int, frame binary")
    dealt = frames.repartitionById(len(bounds) + 1, "file").sortWithinPartitions("file", F.col("doc_id").asc_nulls_first(), "frame")
    out, base = [], 0
    for row in sorted(dealt.mapInArrow(put, "file int, docs long, tokens long").collect()):  # one row a file
        out.append({"uri": f"{folder}/tokens-{row.file:06d}.zst", "base": base, "docs": row.docs, "tokens": row.tokens})
        base += row.tokens
    return out


def read(spark: SparkSession, files: list[dict]) -> DataFrame:
    """Every document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""
    names = ["doc_id", "start", "n_tokens", "ids_crc32"]

    def get(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, at in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                reader, rows = TokenReader(uri), []
                for i, doc_id in enumerate(reader.doc_ids.tolist()):
                    ids = reader.read(i)
                    rows.append((None if doc_id == _FIRST else doc_id, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                    at += len(ids)
                reader.close()
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)

    listed = spark.createDataFrame([(n, f["uri"], f["base"]) for n, f in enumerate(files)], "n int, uri string, base long")
    return listed.repartitionById(max(1, len(files)), "n").select("uri", "base").mapInArrow(get, ", ".join(f"`{c}` long" for c in names))


def written(docs: DataFrame, path: str | None = None, **how) -> DataFrame:
    """Writes ``docs`` to a new folder in the shared folder and returns what the files say of each document."""
    spark = docs.sparkSession
    return read(spark, write(docs, f"{work_dir(spark)}/tokens-{uuid.uuid4().hex}", path, **how))
