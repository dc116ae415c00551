"""Commands: data type, expiry rewrite, keys, topics and payload encodings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import resp

# Which data type each command writes; all others are unknown.
COMMANDS = {
    "string": ["set", "setex", "psetex", "setnx", "append", "incr", "decr", "mset", "msetnx", "incrby", "decrby", "getset"],
    "hash": ["hset", "hmset", "hdel", "hincrby", "hincrbyfloat"],
    "list": ["lpush", "rpush", "lpop", "rpop", "ltrim", "lset", "linsert", "rpoplpush"],
    "set": ["sadd", "srem", "spop", "sinterstore", "sunionstore", "sdiffstore"],
    "zset": ["zadd", "zrem", "zincrby", "zremrangebyrank", "zremrangebyscore"],
}
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def data_type(command: Column) -> Column:
    name = F.lower(command)
    out = F
    for kind, names in COMMANDS.items():
        out = out.when(name.isin(names), F.lit(kind))
    return out.otherwise(F.lit("unknown"))


def ascii_lower(text: Column) -> Column:
    """A-Z only; other letters, and bytes that aren't UTF-8, stay."""
    folded = F.translate(text, UPPER, LOWER)
    safe = text
    for a, b in zip(UPPER, LOWER):
        safe = F.replace(safe, F.lit(a), F.lit(b))
    return F.when(F.is_valid_utf8(text), folded).otherwise(safe)


def rewrite_expiry(argv: Column, raw: Column, now: Column) -> Column:
    """An absolute expiry (``pksetexat key time value``) as a relative one; anything else as it was."""
    when = F.get(argv, 2)
    fits = (F.get(argv, 0) == "pksetexat") & (F.size(argv) >= 4) & when.rlike("^[+-]?[0-9]+$") & when.try_cast("bigint").isNotNull()
    ttl = (when.try_cast("bigint") - now).cast("string")
    return F.when(fits, resp.serialize(F.array(F.lit("setex"), F.get(argv, 1), ttl, F.get(argv, 3)))).otherwise(raw)


def partition_key(db: Column, kind: Column, key: Column) -> Column:
    head = F.concat(db, F.lit(":"), kind)
    return F.when(F.octet_length(F.coalesce(key, F.lit(""))) == 0, head).otherwise(F.concat(head, F.lit(":"), key))


def topic(event_type: Column, mode: str, snapshot: str, binlog: str, single: str) -> Column:
    if mode == "single":
        return F.lit(single)
    return F.when(event_type == "snapshot", F.lit(snapshot)).otherwise(F.lit(binlog))


def encode_payload(data: Column, encoding: str) -> Column:
    """base64 without line breaks, whatever the session's setting; or the bytes as they are."""
    return F.replace(F.base64(data.cast("binary")), F.lit("\r\n"), F.lit("")) if encoding == "base64" else data.cast("string")


def json_escape(text: Column) -> Column:
    """Escape what JSON must, byte-safely: other bytes, valid UTF-8 or not, stay as they are."""
    named = {"\\": "\\\\", '"': '\\"', "\b": "\\b", "\f": "\\f", "\n": "\\n", "\r": "\\r", "\t": "\\t"}
    out = text
    for raw, escaped in {**named, **{chr(c): f"\\u{c:04x}" for c in range(32) if chr(c) not in named}}.items():
        out = F.replace(out, F.lit(raw), F.lit(escaped))
    return F.when(text.rlike(r'[\x00-\x1f"\\]'), out).otherwise(text)


def score_text(score: Column) -> Column:
    return F.format_string("%.6f", score)
