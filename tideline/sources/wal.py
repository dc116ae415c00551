"""The write-ahead log: segment files of checksummed records, read as a batch data source, written by tasks.

A record is a 56-byte little-endian header and its payload. Reading is split by segment file; a segment that ends
inside a record (the writer died there) ends at the last whole one unless ``strict``. Positions are pushed down:
a segment whose successor starts at or before ``from`` isn't opened.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from ..functions.numbers import crc32c_many, crc32c_ranges
from . import files

# Fixed values of the format: fields are magic, header length, version, type, flags, reserved, epoch, seq, filenum, offset, payload length, payload and header checksums, and two reserved words.
LAYOUT = struct.Struct("<4sHBBHHIQIQIIIII")
MAGIC, HEADER, VERSION, BINLOG, SNAPSHOT = b"PWAL", 56, 1, 1, 2
NAME = r"wal-(\d{8})-(\d{20})-(\d{8})\.log$"
SCHEMA = "type int, epoch long, seq decimal(20,0), filenum long, offset decimal(20,0), payload binary, path string"


def encode(epoch: int, seq: int, filenum: int, offset: int, payload: bytes, kind: int = BINLOG) -> bytes:
    return encode_many([(epoch, seq, filenum, offset, payload)], kind)[0]


def encode_many(rows: list[tuple], kind: int = BINLOG) -> list[bytes]:
    """Records of (epoch, seq, filenum, offset, payload) rows; checksums are made for all at once."""
    bodies = crc32c_many([r[4] for r in rows]).tolist()
    fields = [(MAGIC, HEADER, VERSION, kind, 0, 0, *r[:4], len(r[4]), c) for r, c in zip(rows, bodies)]
    heads = crc32c_many([LAYOUT.pack(*f, 0, 0, 0).ljust(HEADER, b"\0") for f in fields]).tolist()
    return [LAYOUT.pack(*f, c, 0, 0).ljust(HEADER, b"\0") + r[4] for f, c, r in zip(fields, heads, rows)]


def decode(data: bytes, strict: bool = False) -> Iterator[tuple]:
    """(type, epoch, seq, filenum, offset, payload) of each record; ValueError for a damaged one. Checksums are tested for all at once."""
    at, found, wrong = 0, [], None
    while at < len(data):
        head = data[at : at + HEADER]
        if len(head) < HEADER:
            wrong = (at, "the segment ends inside a header") if strict else None
            break
        fields = LAYOUT.unpack(head[: LAYOUT.size])
        if (fields[0], fields[1], fields[2]) != (MAGIC, HEADER, VERSION):
            wrong = (at, "no record")
            break
        found.append((at, fields))
        at += HEADER + fields[10]
    flat = np.frombuffer(data, dtype=np.uint8)
    places, sizes = np.array([p for p, _ in found], dtype=np.int64), np.array([f[10] for _, f in found], dtype=np.int64)
    heads = flat[places[:, None] + np.arange(HEADER)] if found else np.empty((0, HEADER), dtype=np.uint8)
    heads[:, 44:48] = 0
    sums = crc32c_ranges(heads.ravel(), np.arange(len(found)) * HEADER, np.full(len(found), HEADER))
    bad = [(int(places[k]), "damaged header") for k in np.flatnonzero(sums != np.array([f[12] for _, f in found], dtype=np.uint32))[:1]]
    whole = int((places + HEADER + sizes <= len(data)).sum())  # all but the last, where it is cut off
    if whole < len(found) and strict:
        bad.append((int(places[whole]), "the segment ends inside a record"))
    sums = crc32c_ranges(flat, places[:whole] + HEADER, sizes[:whole])
    bad += [(int(places[k]), "damaged payload") for k in np.flatnonzero(sums != np.array([f[11] for _, f in found[:whole]], dtype=np.uint32))[:1]]
    if wrong:
        bad.append(wrong)
    if bad:
        place, what = min(bad, key=lambda b: b[0])
        raise ValueError(f"{what} at byte {place}")
    for place, f in found[:whole]:
        yield f[3], f[6], f[7], f[8], f[9], data[place + HEADER : place + HEADER + f[10]]


def segment_name(filenum: int, offset: int, segment: int) -> str:
    return f"wal-{filenum:08d}-{offset:020d}-{segment:08d}.log"


def segment_fields(path: Column) -> Column:
    """start_filenum, start_offset and segment of a file name; null for other files."""
    part = lambda k, kind: F.regexp_extract(path, NAME, k).try_cast(kind)
    made = F.struct(part(1, "long").alias("start_filenum"), part(2, "decimal(20,0)").alias("start_offset"), part(3, "long").alias("segment"))
    return F.when(path.rlike(NAME), made)


def read_files(spark: SparkSession, folder: str) -> DataFrame:
    """All records of a folder through Spark's own file source, on any filesystem that Spark reads."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "wal-*.log").load(folder).select("path", "content")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                yield _batch(list(decode(content)), path)

    return files.mapInArrow(run, SCHEMA)


def _batch(rows: list[tuple], path: str) -> pa.RecordBatch:
    import decimal

    kind, epoch, seq, filenum, offset, body = zip(*rows) if rows else [()] * 6
    big = pa.decimal128(20, 0)
    arrays = [
        pa.array(kind, pa.int32()), pa.array(epoch, pa.int64()), pa.array([decimal.Decimal(x) for x in seq], big), pa.array(filenum, pa.int64()),
        pa.array([decimal.Decimal(x) for x in offset], big), pa.array(body, pa.binary()), pa.array([path] * len(rows), pa.string()),
    ]
    return pa.RecordBatch.from_arrays(arrays, names=["type", "epoch", "seq", "filenum", "offset", "payload", "path"])


class WalSegment(InputPartition):
    """A segment, and the positions of it that count: after the first, up to the second; all when None."""

    def __init__(self, path: str, after: tuple | None = None, upto: tuple | None = None):
        super().__init__(path)
        self.path, self.after, self.upto = path, after, upto


def _segments(folder: str) -> list[tuple[tuple[int, int], str]]:
    """(start position, path) of the segments of a folder, in order."""
    import re

    names = ((m, n) for n in files.names(folder) if (m := re.search(NAME, n)))
    found = sorted((int(m[1]), int(m[2]), int(m[3]), f"{folder.rstrip('/')}/{n}") for m, n in names)
    return [((f, o), path) for f, o, _, path in found]


def last_position(path: str, at: int = 0) -> tuple[tuple[int, int] | None, int]:
    """The position of the last whole record from a byte on, and where that record ends, by headers alone."""
    last, size = None, files.size(path)
    with files.open_random(path) as data:
        while at + HEADER <= size:
            fields = LAYOUT.unpack(data.read_at(LAYOUT.size, at))
            if fields[:3] != (MAGIC, HEADER, VERSION) or at + HEADER + fields[10] > size:
                break
            last, at = (fields[8], fields[9]), at + HEADER + fields[10]
    return last, at


class WalReader(DataSourceReader):
    def __init__(self, options: dict):
        self.folder, self.strict = options["path"], options.get("strict", "false").lower() == "true"
        self.start = tuple(int(x) for x in options.get("from", "0:0").split(":"))

    def partitions(self):
        found = _segments(self.folder)
        return [WalSegment(path) for k, (_, path) in enumerate(found) if k + 1 == len(found) or found[k + 1][0] > self.start or found[k + 1][0] == (0, 0)]

    def read(self, partition):
        rows = [r for r in decode(files.read(partition.path), self.strict) if (r[3], r[4]) >= self.start]
        yield _batch(rows, partition.path)


class WalStreamReader(DataSourceStreamReader):
    """The folder as a stream. An offset is the position of the last record taken; ``startingOffsets`` is earliest, latest or filenum:offset.

    A batch opens only the segments that can hold positions in its range, and takes at most ``maxSegmentsPerTrigger`` new ones
    (which needs ``ackPath``, to go on from after a restart). commit() records what has been processed in ``ackPath``, for whoever sends acknowledgements upstream or removes old segments.
    """

    def __init__(self, options: dict):
        self.folder, self.ack = options["path"], options.get("ackPath")
        self.starting, self.most = options.get("startingOffsets", "earliest"), int(options.get("maxSegmentsPerTrigger", 0)) if options.get("ackPath") else 0
        self.known: dict[str, tuple] = {}
        self.taken: tuple | None = None

    def initialOffset(self):
        if self.starting == "latest":
            return self._offset(_segments(self.folder))
        at = (0, -1) if self.starting == "earliest" else tuple(int(x) for x in self.starting.split(":"))
        return {"filenum": at[0], "offset": at[1]}

    def _offset(self, found):
        """The last position of the segments, by headers from the last known place on."""
        for _, path in reversed(found):
            before, at = self.known.get(path, (None, 0))
            last, at = last_position(path, at)
            self.known = {path: (last or before, at)}
            if last or before:
                return dict(zip(("filenum", "offset"), last or before))
        return {"filenum": 0, "offset": -1}

    def latestOffset(self):
        found = _segments(self.folder)
        if self.most:
            taken = self.taken or tuple((json.loads(files.read(self.ack)) if files.exists(self.ack) else self.initialOffset()).values())
            ahead = [k for k, (at, _) in enumerate(found) if at > taken]
            found = found[: ahead[self.most]] if len(ahead) > self.most else found
        out = self._offset(found)
        self.taken = (out["filenum"], out["offset"])
        return out

    def partitions(self, start, end):
        after, upto = (start["filenum"], start["offset"]), (end["filenum"], end["offset"])
        found = _segments(self.folder)
        ends = [at for at, _ in found[1:]] + [None]
        return [WalSegment(path, after, upto) for (at, path), stop in zip(found, ends) if at <= upto and (stop is None or stop > after or stop == (0, 0))]

    def read(self, partition):
        yield _batch([r for r in decode(files.read(partition.path)) if partition.after < (r[3], r[4]) <= partition.upto], partition.path)

    def commit(self, end):
        if self.ack:
            files.replace(self.ack, json.dumps(end).encode())


class WalDataSource(DataSource):
    """``spark.read.format("wal").load(folder)`` after ``spark.dataSource.register(WalDataSource)``; options: from (filenum:offset), strict."""

    @classmethod
    def name(cls):
        return "wal"

    def schema(self):
        return SCHEMA

    def reader(self, schema):
        return WalReader(self.options)

    def streamReader(self, schema):
        return WalStreamReader(self.options)


def write(df: DataFrame, folder: str, segment_bytes: int = 256 << 20) -> DataFrame:
    """Write rows of epoch, seq, filenum, offset, payload as segments, each task its own, in the order of its rows; path and n of what was written.

    Rows should come range-partitioned and sorted by position, as range_by_position() leaves them. Records are written as they come,
    and a segment gets its name when it is whole; the names of a task are the same in every attempt, so one that runs again replaces its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        files.make(folder)
        out = path = None
        size = n = number = 0

        def close():
            out.close()
            files.move(path + ".tmp", path)
            return pa.RecordBatch.from_pydict({"path": [path], "n": [n]})

        for batch in batches:
            rows = [(int(r["epoch"]), int(r["seq"]), int(r["filenum"]), int(r["offset"]), r["payload"] or b"") for r in batch.to_pylist()]
            for row, made in zip(rows, encode_many(rows)):
                if out is not None and size + len(made) > segment_bytes:
                    yield close()
                    out = None
                if out is None:
                    segment = (TaskContext.get().partitionId() * 10_000 + number) % 10**8
                    path, size, n, number = f"{folder.rstrip('/')}/{segment_name(row[2], row[3], segment)}", 0, 0, number + 1
                    out = files.open_write(path + ".tmp")
                out.write(made)
                size, n = size + len(made), n + 1
        if out is not None:
            yield close()

    return df.select("epoch", "seq", "filenum", "offset", "payload").mapInArrow(run, "path string, n long")


def range_by_position(df: DataFrame, partitions: int) -> DataFrame:
    return df.repartitionByRange(partitions, "filenum", "offset").sortWithinPartitions("filenum", "offset")
