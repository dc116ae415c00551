"""Snapshot expansion: keyspace rows become bounded write commands, then one expiry command.

Every function takes key, its contents and ttl, and returns data_type, key, ord and argv. Commands of a key are
ordered by ord; expiry comes last. Collections are cut by position; sets and hashes are sorted first, since their
storage order means nothing. Empty collections give no rows, expiry included.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.commands import score_text

#: Order of types in a whole snapshot, and the place of expiry after any chunk.
TYPE_ORDER = ["string", "list", "hash", "set", "zset"]
LAST = 2**31 - 1


def _shape(df: DataFrame, kind: str, order: Column, argv: Column) -> DataFrame:
    return df.select(F.lit(kind).alias("data_type"), "key", order.alias("ord"), argv.alias("argv"))


def strings(df: DataFrame) -> DataFrame:
    """key, value, ttl: one SET, with the ttl inline when positive."""
    base = F.array(F.lit("SET"), F.col("key"), F.col("value"))
    timed = F.concat(base, F.array(F.lit("EX"), F.col("ttl").cast("string")))
    return _shape(df, "string", F.lit(0), F.when(F.col("ttl") > 0, timed).otherwise(base))


def _chunked(df: DataFrame, kind: str, command: str, items: Column, batch: int, flat) -> DataFrame:
    """items cut into chunks of batch; flat turns a chunk into arguments."""
    held = df.select("key", "ttl", items.alias("items")).where(F.size("items") > 0)
    cuts = F.transform(F.sequence(F.lit(0), F.ceil(F.size("items") / batch).cast("int") - 1), lambda i: F.slice("items", i * batch + 1, batch))
    chunks = held.select("key", F.posexplode(cuts).alias("ord", "chunk"))
    writes = _shape(chunks, kind, F.col("ord"), F.concat(F.array(F.lit(command), F.col("key")), flat(F.col("chunk"))))
    return writes.unionByName(expiry(held, kind))


def expiry(df: DataFrame, kind: str) -> DataFrame:
    return _shape(df.where("ttl > 0"), kind, F.lit(LAST), F.array(F.lit("EXPIRE"), F.col("key"), F.col("ttl").cast("string")))


def lists(df: DataFrame, batch: int = 512, tail: int = 0) -> DataFrame:
    """key, items, ttl: RPUSH of each chunk; only the last ``tail`` items when positive."""
    items = F.slice("items", F.greatest(F.size("items") - tail, F.lit(0)) + 1, tail) if tail > 0 else F.col("items")
    return _chunked(df, "list", "RPUSH", items, batch, lambda c: c)


def hashes(df: DataFrame, batch: int = 512) -> DataFrame:
    """key, items (field, value), ttl: HMSET of each chunk of pairs."""
    return _chunked(df, "hash", "HMSET", F.sort_array("items"), batch, lambda c: F.flatten(F.transform(c, lambda p: F.array(p["field"], p["value"]))))


def sets(df: DataFrame, batch: int = 512) -> DataFrame:
    """key, items, ttl: SADD of each chunk."""
    return _chunked(df, "set", "SADD", F.sort_array("items"), batch, lambda c: c)


def zsets(df: DataFrame, batch: int = 512) -> DataFrame:
    """key, items (score, member), ttl: ZADD of each chunk by rank, scores with six decimals."""
    return _chunked(df, "zset", "ZADD", F.sort_array("items"), batch, lambda c: F.flatten(F.transform(c, lambda p: F.array(score_text(p["score"]), p["member"]))))


def snapshot(string: DataFrame, list_: DataFrame, hash_: DataFrame, set_: DataFrame, zset: DataFrame, batch: int = 512, tail: int = 0) -> DataFrame:
    """All types together; order by (position of the type, key, ord) where a consumer needs it."""
    out = strings(string)
    for part in (lists(list_, batch, tail), hashes(hash_, batch), sets(set_, batch), zsets(zset, batch)):
        out = out.unionByName(part)
    return out


def handoff(snapshot_rows: DataFrame, log: DataFrame, end_filenum: int, end_offset: int) -> DataFrame:
    """The snapshot, then the log from its end position on; columns of both by name."""
    place = lambda filenum, offset: F.struct(filenum.cast("long").alias("filenum"), offset.cast("decimal(20,0)").alias("offset"))  # noqa: E731  unsigned, 64 bits
    after = place(F.col("filenum"), F.col("offset")) >= place(F.lit(end_filenum), F.lit(str(end_offset)))
    return snapshot_rows.unionByName(log.where(after), allowMissingColumns=True)
