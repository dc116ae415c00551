"""WARC archives: writing with revisits, normalising whole-file gzip, and reading through a sidecar index.

Tasks write their rows as archives that are one gzip stream each (what many exporters leave: no record can be
reached without inflating all before it). The normaliser inflates such a stream once, a block at a time, rewrites every
record as its own gzip member, and writes a sidecar index of offsets beside the archive. Reading seeks by that index.

Files go to the shared folder through its filesystem. A name holds the task attempt, and only names that a finished
task returned are read on, so a lost executor leaves nothing but an unread file. A record is held in memory, never an archive.

Null html is an empty payload. Equal payloads of at least ``min_revisit`` bytes are stored once, under the largest id;
rows that repeat that id with that payload are all responses. A null id is written as an empty one and read back as null; a null url
leaves out the target. Empty tables write no archive. Only id, url and html are read.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shared_dir, small, stored

#: Uncompressed bytes after which a new archive begins, and bytes read at a time.
ARCHIVE_BYTES, BLOCK = 32 << 20, 1 << 18
# Fixed values of the format.
VERSION, REVISIT_PROFILE = "WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_PREFIX = "urn:x-page:"


def open_fs(uri: str):
    from pyarrow.fs import FileSystem

    return FileSystem.from_uri(uri)


def record(page_id, url: str | None, payload: bytes, refers_to, date: str) -> bytes:
    """One record: a response with its payload, or a revisit of another page's."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to is not None else http + payload
    kind = "response" if refers_to is None else "revisit"
    fields = [("WARC-Type", kind), ("WARC-Record-ID", f"<{ID_PREFIX}{'' if page_id is None else page_id}>"), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if refers_to is not None:
        fields += [("WARC-Refers-To", f"<{ID_PREFIX}{refers_to}>"), ("WARC-Profile", REVISIT_PROFILE)]
    fields += [("WARC-Payload-Digest", "sha1:" + base64.b32encode(hashlib.sha1(payload).digest()).decode()), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = VERSION + "\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def inflate(stream) -> Iterator[bytes]:
    """The plain bytes of a gzip stream, a block at a time; members that follow one another are one stream. ValueError when the last one isn't whole."""
    unzip, inside = zlib.decompressobj(31), False
    while data := stream.read(BLOCK):
        while data:
            inside = True
            if out := unzip.decompress(data, 4 * BLOCK):
                yield out
            data = unzip.unconsumed_tail
            if unzip.eof:
                data, unzip, inside = unzip.unused_data, zlib.decompressobj(31), False
    if inside:
        yield unzip.flush()
        if not unzip.eof:
            raise ValueError("the archive ends inside a gzip member")


def parse_head(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def records(blocks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and raw bytes of each record of a plain stream."""
    held = bytearray()

    def fill(n: int) -> bool:
        while len(held) < n:
            more = next(blocks, None)
            if more is None:
                return False
            held.extend(more)
        return True

    while fill(4):
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not fill(len(held) + 1):
                raise ValueError("the archive ends inside a record's header")
        fields = parse_head(bytes(held[:end]))
        size = end + 4 + int(fields["content-length"]) + 4
        if not fill(size):
            raise ValueError("the archive ends inside a record")
        yield fields, bytes(held[:size])
        del held[:size]
    if held:
        raise ValueError(f"{len(held)} bytes after the last record")


def page_of(value: str | None) -> str | None:
    return (value or "").removeprefix(f"<{ID_PREFIX}").removesuffix(">") or None


def revisits(pages: DataFrame, min_revisit: int, key: str, html: str) -> DataFrame:
    """page, digest, refers_to of the rows whose payload a larger id has too. Payloads themselves aren't shuffled."""
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    sized = pages.select(F.col(key).alias("page"), F.octet_length(payload).alias("n"), F.sha1(payload).alias("digest")).where(F.col("n") >= min_revisit).select("page", "digest")
    sized = stored(sized, "digests")
    groups = sized.groupBy("digest").agg(F.max("page").alias("refers_to"), F.min("page").alias("least")).where("least < refers_to").select("digest", "refers_to")
    # stored, so that a payload that is everywhere meets in a join whose sides are both shuffled, and can be split
    groups = stored(groups, "equal-payloads")
    return sized.join(small(groups), "digest").where("page < refers_to").select("page", "digest", "refers_to").distinct()


def write_archives(pages: DataFrame, folder: str, min_revisit: int = 1000, date: str = "2024-01-01T00:00:00Z", key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write whole-file gzip archives under folder; a stored table of path, n_records."""
    again = small(stored(revisits(pages, min_revisit, key, html), "revisits"))
    # by payload as well, since rows that repeat an id may have others
    digest = F.sha1(F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")).alias("digest")
    rows = pages.select(F.col(key).alias("page"), F.col(url).alias("url"), F.col(html).alias("html"), digest).join(again, ["page", "digest"], "left").select("page", "url", "html", "refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(folder)
        fs.create_dir(root, recursive=True)
        out = path = zipped = None
        size = n = 0

        def close():
            out.write(zipped.flush())
            out.close()
            return pa.RecordBatch.from_pydict({"path": [path], "n_records": [n]})

        for batch in batches:
            for page, target, text, refers_to in zip(*(batch.column(k) for k in range(4))):
                if out is None:
                    path, size, n = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                    out, zipped = fs.open_output_stream(path, compression=None), zlib.compressobj(1, zlib.DEFLATED, 31)
                made = record(page.as_py(), target.as_py(), (text.as_py() or "").encode("utf-8", "surrogatepass"), refers_to.as_py(), date)
                out.write(zipped.compress(made))
                size, n = size + len(made), n + 1
                if size >= ARCHIVE_BYTES:
                    yield close()
                    out = None
        if out is not None:
            yield close()

    return stored(rows.mapInArrow(run, "path string, n_records long"), "archives")


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Rewrite archives record by record with sidecar indexes; a stored table of path, index, n_records."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_fs(folder)
        fs.create_dir(root, recursive=True)
        for batch in batches:
            for source in batch.column("path").to_pylist():
                path, at, n = f"{root}/{uuid.uuid4().hex}.warc.gz", 0, 0
                index = path.removesuffix(".warc.gz") + ".idx.jsonl"
                with fs.open_input_stream(source, compression=None) as raw, fs.open_output_stream(path, compression=None) as out, fs.open_output_stream(index, compression=None) as side:
                    for fields, data in records(inflate(raw)):
                        zipped = zlib.compressobj(6, zlib.DEFLATED, 31)
                        member = zipped.compress(data) + zipped.flush()
                        out.write(member)
                        entry = {"offset": at, "length": len(member), "id": fields.get("warc-record-id"), "type": fields.get("warc-type"), "uri": fields.get("warc-target-uri")}
                        side.write(json.dumps(entry).encode() + b"\n")
                        at, n = at + len(member), n + 1
                yield pa.RecordBatch.from_pydict({"path": [path], "index": [index], "n_records": [n]})

    spread = archives.select("path").repartition(max(1, min(4096, archives.count())), "path")
    return stored(spread.mapInArrow(run, "path string, index string, n_records long"), "normalised")


def read_archives(normalised: DataFrame, folder: str) -> DataFrame:
    """page, record_type, refers_to (as text), payload_bytes and payload_digest of every record, reached by the index alone.

    A revisit's digest is its header's; it has no payload, hence null payload_bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, _ = open_fs(folder)
        for batch in batches:
            for path, index in zip(batch.column("path").to_pylist(), batch.column("index").to_pylist()):
                rows = []
                with fs.open_input_file(path) as data, fs.open_input_stream(index, compression=None) as side:
                    entries = side.read().splitlines()
                    for entry in map(json.loads, entries):
                        data.seek(entry["offset"])
                        ((fields, raw),) = records(iter([zlib.decompress(data.read(entry["length"]), 31)]))
                        start = raw.index(b"\r\n\r\n") + 4
                        payload = raw[raw.index(b"\r\n\r\n", start) + 4 : -4]
                        claimed = base64.b32decode(fields["warc-payload-digest"].removeprefix("sha1:")).hex()
                        whole = fields["warc-type"] == "response"
                        if whole and hashlib.sha1(payload).hexdigest() != claimed:
                            raise ValueError(f"the payload of {fields['warc-record-id']} doesn't match its digest")
                        rows.append((page_of(fields["warc-record-id"]), fields["warc-type"], page_of(fields.get("warc-refers-to")), len(payload) if whole else None, claimed))
                kinds = [pa.string(), pa.string(), pa.string(), pa.int64(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else [pa.array([], k) for k in kinds], names=["page", "record_type", "refers_to", "payload_bytes", "payload_digest"])

    spread = normalised.select("path", "index").repartition(max(1, min(4096, normalised.count())), "path")
    return spread.mapInArrow(run, "page string, record_type string, refers_to string, payload_bytes long, payload_digest string")


def archive_round_trip(pages: DataFrame, min_revisit: int = 1000, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write, normalise and read back: a row a page, with the full payload's size and digest for revisits too."""
    folder = f"{shared_dir(pages.sparkSession)}/warc-{uuid.uuid4().hex}"
    raw = write_archives(pages, f"{folder}/raw", min_revisit, key=key, url=url, html=html)
    read = stored(read_archives(normalise(raw, f"{folder}/normalised"), folder), "records")
    kind = pages.schema[key].dataType
    read = read.select(F.col("page").cast(kind).alias(key), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))
    sizes = read.where("record_type = 'response'").select(F.col("payload_digest").alias("d"), F.col("payload_bytes").alias("full"), F.col(key).alias("target"))
    wanted = read.where("record_type = 'revisit'").select(F.col("refers_to").alias("target"), F.col("payload_digest").alias("d")).distinct()
    full = stored(wanted.join(sizes, ["target", "d"]).distinct(), "full-sizes")
    joined = read.join(small(full), (F.col("refers_to") == F.col("target")) & (F.col("payload_digest") == F.col("d")), "left")
    return joined.select(key, F.coalesce("payload_bytes", "full").alias("payload_bytes"), "payload_digest", "record_type", "refers_to")
