"""The progress document: positions acknowledged and durable, log and snapshot state, as one JSON object."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import files

VERSION = 1
_POSITION = "struct<seq:decimal(20,0),filenum:bigint,offset:decimal(20,0),logic_id:decimal(20,0),server_id:bigint,term_id:bigint,ts_ms:decimal(20,0),wal_segment:bigint,wal_offset:decimal(20,0)>"
SCHEMA = (
    f"version int, source_id string, epoch bigint, ack_cp {_POSITION}, durable_cp {_POSITION}, wal struct<segment:bigint,offset:decimal(20,0)>, "
    "snapshot struct<state:string,bgsave_end_file_num:bigint,bgsave_end_offset:decimal(20,0),progress_file:string,progress_offset:decimal(20,0),snapshot_seq:decimal(20,0)>"
)


def decode(text: Column, source_id: str | None = None) -> Column:
    """A struct of the document and error."""
    doc = F.from_json(text, SCHEMA)
    error = F.when(doc.isNull() | doc["version"].isNull(), F.lit("not a checkpoint")).when(doc["version"] != VERSION, F.lit("unsupported version")).when(F.coalesce(doc["source_id"], F.lit("")) == "", F.lit("no source_id"))
    if source_id is not None:
        error = error.when(doc["source_id"] != source_id, F.lit("another source"))
    return F.struct(doc.alias("checkpoint"), error.alias("error"))


def check(doc: dict, source_id: str | None = None) -> dict:
    if doc.get("version") != VERSION:
        raise ValueError(f"unsupported version {doc.get('version')}")
    if not doc.get("source_id") or source_id not in (None, doc["source_id"]):
        raise ValueError(f"source_id {doc.get('source_id')!r} isn't {source_id!r}")
    return doc


def load(path: str, source_id: str | None = None) -> dict | None:
    """The stored document, or None when there is none yet."""
    return check(json.loads(files.read(path)), source_id) if files.exists(path) else None


def save(path: str, doc: dict) -> None:
    """Replace the document as a whole; readers see the old one or the new one."""
    files.replace(path, json.dumps(check(doc), separators=(",", ":")).encode())


def documents(progress: DataFrame) -> DataFrame:
    """source_id and the document's JSON, from rows of source_id, epoch, ack_seq, ack_filenum, ack_offset, durable_seq, durable_filenum, durable_offset."""
    at = lambda p: F.struct(F.col(f"{p}_seq").alias("seq"), F.col(f"{p}_filenum").alias("filenum"), F.col(f"{p}_offset").alias("offset"))
    return progress.select("source_id", F.to_json(F.struct(F.lit(VERSION).alias("version"), "source_id", "epoch", at("ack").alias("ack_cp"), at("durable").alias("durable_cp"))).alias("document"))
