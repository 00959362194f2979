"""Members of tar and zip archives as rows: one pass reads the headers, another the members by ranges of bytes, so a large archive is many tasks.

A gzipped tar can only be read from its begin, so it is one task, which streams. Archives are opened by pyarrow's file systems (local or mounted paths, file:, hdfs:, s3:, gs:).
"""

from __future__ import annotations

import re
import tarfile
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.staging import staged

#: Content that a task holds before it passes it on.
BATCH_BYTES = 16 << 20
_GZIPPED = r"(?i)\.(tgz|tar\.gz)$"
_INDEX = pa.schema([("path", pa.string()), ("member", pa.string()), ("zipped", pa.bool_()), ("method", pa.int32()), ("offset", pa.int64()), ("packed", pa.int64()), ("size", pa.int64()), ("crc", pa.int64()), ("error", pa.string())])
_ROWS = pa.schema([("path", pa.string()), ("member", pa.string()), ("size", pa.int64()), ("content", pa.binary()), ("error", pa.string())])
ROWS = "path string, member string, size long, content binary, error string"


def _opened(path: str):
    fs, name = pa.fs.FileSystem.from_uri(re.sub("^file:/+", "/", path))
    return fs, name


def _name(member: str) -> str:
    return member.encode("utf-8", "surrogateescape").decode("utf-8", "replace")


def _batches(rows: Iterator[tuple], schema: pa.Schema, weight=lambda r: 200) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += weight(row)
        if size >= BATCH_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def _tar_members(f) -> Iterator[tarfile.TarInfo]:
    """Regular members; an error at the end where the archive does not end as it should."""
    tar = tarfile.open(fileobj=f, mode="r:")
    while (m := tar.next()) is not None:
        tar.members.clear()
        if m.isreg():
            yield m
    f.seek(tar.offset)
    block = f.read(tarfile.BLOCKSIZE)
    if len(block) < tarfile.BLOCKSIZE:
        raise tarfile.ReadError("no end of archive")
    if block.strip(b"\0"):
        raise tarfile.ReadError(f"damaged header at byte {tar.offset}")


def _indexed(path: str) -> Iterator[tuple]:
    zipped = None
    try:
        fs, name = _opened(path)
        with fs.open_input_file(name) as f:
            zipped = f.read(4) in (b"PK\3\4", b"PK\5\6", b"PK\7\x08")
            f.seek(0)
            if zipped:
                with zipfile.ZipFile(f) as z:
                    for m in z.infolist():
                        if not m.is_dir():
                            yield path, _name(m.filename), True, m.compress_type, m.header_offset, m.compress_size, m.file_size, m.CRC, "encrypted" if m.flag_bits & 1 else None
            else:
                for m in _tar_members(f):
                    yield path, _name(m.name), False, 0, m.offset_data, m.size, m.size, None, "sparse" if m.issparse() else None
    except Exception as error:
        yield path, None, zipped, None, None, None, None, None, f"{type(error).__name__}: {error}"


def _content(f, r: dict) -> bytes:
    at = r["offset"]
    if r["zipped"]:
        f.seek(at)
        head = f.read(30)
        if len(head) < 30 or head[:4] != b"PK\3\4":
            raise ValueError("damaged local header")
        at += 30 + int.from_bytes(head[26:28], "little") + int.from_bytes(head[28:30], "little")
    f.seek(at)
    data = f.read(r["packed"])
    if len(data) < r["packed"]:
        raise ValueError("truncated")
    if r["method"] == zipfile.ZIP_DEFLATED:
        data = zlib.decompressobj(-15).decompress(data, r["size"] + 1)
    elif r["method"] != zipfile.ZIP_STORED:
        raise ValueError(f"compression {r['method']}")
    if len(data) != r["size"] or r["zipped"] and zlib.crc32(data) != r["crc"]:
        raise ValueError("wrong length" if len(data) != r["size"] else "wrong checksum")
    return data


def _members(batches: Iterator[pa.RecordBatch], largest: int) -> Iterator[tuple]:
    path = f = None
    try:
        for batch in batches:
            for r in batch.to_pylist():
                content = None
                error = r["error"] or (f"larger than {largest} bytes" if r["size"] > largest else None)
                if not error:
                    try:
                        if r["path"] != path:
                            if f:
                                f.close()
                            path = f = None
                            fs, name = _opened(r["path"])
                            f, path = fs.open_input_file(name), r["path"]
                        content = _content(f, r)
                    except Exception as failed:
                        error = f"{type(failed).__name__}: {failed}"
                yield r["path"], r["member"], r["size"], content, error
    finally:
        if f:
            f.close()


def _streamed(path: str, largest: int) -> Iterator[tuple]:
    try:
        fs, name = _opened(path)
        with fs.open_input_stream(name, compression="gzip") as f:
            tar = tarfile.open(fileobj=f, mode="r|")
            for m in iter(tar.next, None):
                tar.members.clear()
                if m.isreg():
                    big = m.size > largest
                    yield path, _name(m.name), m.size, None if big else tar.extractfile(m).read(), f"larger than {largest} bytes" if big else None
    except Exception as error:
        yield path, None, None, None, f"{type(error).__name__}: {error}"


def read_archives(paths: DataFrame, path: str = "path", range_bytes: int = 64 << 20, largest: int = 1 << 30) -> DataFrame:
    """path, member, size, content, error of every regular member of tar, zip and gzipped tar archives, which a column of paths names; null paths are left out.

    A member that is damaged, encrypted, sparse, packed by other means than deflation or larger than `largest` bytes (a row holds less than 2 GB) has its error and no content;
    an archive that can't be read on has a row without a member, besides its members up to there. Members that begin in one range of `range_bytes` of an archive are read by one task, in order.
    The headers of an archive are read by one task; for a zip archive its directory has to fit in memory.
    """
    every = paths.select(F.col(path).cast("string").alias("path")).where("path IS NOT NULL")

    def index(batches):
        yield from _batches((r for b in batches for p in b.column(0).to_pylist() for r in _indexed(p)), _INDEX)

    def members(batches):
        yield from _batches(_members(batches, largest), _ROWS, lambda r: 200 + len(r[3] or b""))

    def streamed(batches):
        yield from _batches((r for b in batches for p in b.column(0).to_pylist() for r in _streamed(p, largest)), _ROWS, lambda r: 200 + len(r[3] or b""))

    gzipped = F.col("path").rlike(_GZIPPED)
    spread = lambda df: df.repartition(max(1, min(df.count(), 10_000)), "path")
    found = spread(every.where(~gzipped)).mapInArrow(index, "path string, member string, zipped boolean, method int, offset long, packed long, size long, crc long, error string")
    found = staged(found.withColumn("range", F.floor(F.col("offset") / range_bytes)), "members")
    n = found.select("path", "range").distinct().count()
    placed = found.where("member IS NOT NULL").repartition(max(1, min(n, 100_000)), "path", "range").sortWithinPartitions("path", "offset").drop("range")
    failed = found.where("member IS NULL").select("path", "member", "size", F.lit(None).cast("binary").alias("content"), "error")
    return placed.mapInArrow(members, ROWS).union(failed).union(spread(every.where(gzipped)).mapInArrow(streamed, ROWS))


def write_archives(df: DataFrame, member: str, content: str, folder: str, kind: str = "tar") -> DataFrame:
    """An archive (tar, tgz or zip) of each partition's rows in a folder that all machines share: path, members. Null content is an empty member; rows without a name are left out.

    The frame is written as it is returned: archives of tasks that were lost and run again lie beside, so only the paths returned count.
    """

    def write(batches):
        rows = ((n, c or b"") for b in batches for n, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if n is not None)
        first = next(rows, None)
        if first is None:
            return
        fs, at = _opened(f"{folder}/{uuid.uuid4().hex}.{kind}")
        fs.create_dir(at.rpartition("/")[0], recursive=True)
        done = 0
        with fs.open_output_stream(at, compression="gzip" if kind == "tgz" else None) as out:
            archive = zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) if kind == "zip" else tarfile.open(fileobj=out, mode="w|")
            with archive:
                for name, data in (row for group in ([first], rows) for row in group):
                    if kind == "zip":
                        archive.writestr(zipfile.ZipInfo(name), data, zipfile.ZIP_DEFLATED)
                    else:
                        info = tarfile.TarInfo(name)
                        info.size = len(data)
                        archive.addfile(info, pa.BufferReader(data))
                        archive.members.clear()
                    done += 1
        yield pa.RecordBatch.from_arrays([pa.array([f"{folder}/{at.rpartition('/')[2]}"]), pa.array([done], pa.int64())], ["path", "members"])

    return staged(df.select(F.col(member).cast("string"), F.col(content).cast("binary")).mapInArrow(write, "path string, members long"), "archives")
