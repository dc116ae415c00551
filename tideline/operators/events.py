"""Change events: the JSON document, its topic and its partition key, as one projection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import commands as C
from ..sources.options import Options


def _member(name: str, value: Column, quoted: bool = True) -> Column:
    return F.concat(F.lit(f'"{name}":"' if quoted else f'"{name}":'), value if quoted else value.cast("string"), F.lit('"' if quoted else ""))


def _object(*members: Column) -> Column:
    """Members that are null are left out; at least the first is there."""
    return F.concat(F.lit("{"), F.concat_ws(",", *members), F.lit("}"))


def args_json(argv: Column, encoding: str) -> Column:
    escape = C.json_escape if encoding == "none" else (lambda c: c)
    return F.concat(F.lit("["), F.array_join(F.transform(argv, lambda a: F.concat(F.lit('"'), escape(C.encode_payload(a, encoding)), F.lit('"'))), ","), F.lit("]"))


def source_object(source_id: str) -> str:
    """host and port split at the first colon; the whole id is the host when the port isn't a number."""
    import json

    host, colon, port = source_id.partition(":")
    return json.dumps({"host": host, "port": int(port)} if colon and port.isdigit() else {"host": source_id}, separators=(",", ":"), ensure_ascii=False)


def _common(kind: str, op: Column, data_type: Column, key: Column, argv: Column, raw: Column | None, ts_ms: Column, event_id: Column, binlog: Column | None, o: Options) -> Column:
    text = lambda c: C.json_escape(c.cast("string"))
    members = [
        _member("event_type", F.lit(kind)), F.when(F.size(argv) > 0, _member("op", text(op))), _member("data_type", text(data_type)),
        _member("db", text(F.lit(o.db_name))), _member("slot", F.lit(0), False), _member("key", text(F.coalesce(key, F.lit("")))),
        _member("args", args_json(argv, o.args_encoding), False), _member("args_encoding", F.lit(o.args_encoding)),
    ]
    if o.include_raw_resp and raw is not None:
        encoded = C.encode_payload(raw, o.raw_resp_encoding)
        members += [_member("raw_resp", C.json_escape(encoded) if o.raw_resp_encoding == "none" else encoded), _member("raw_resp_encoding", F.lit(o.raw_resp_encoding))]
    members += [_member("ts_ms", ts_ms, False), _member("event_id", text(event_id)), _member("source_id", text(F.lit(o.source_id)))]
    if binlog is not None:
        members.append(_member("binlog", binlog, False))
    return _object(*members, _member("source", F.lit(source_object(o.source_id)), False))


def binlog_events(df: DataFrame, o: Options) -> DataFrame:
    """df with topic, key and value added. Reads argv, raw_resp, exec_time, term_id, logic_id, filenum and offset; keys go by the first argument only."""
    op, key = C.ascii_lower(F.get("argv", 0).cast("string")), F.get("argv", 1)
    kind = C.data_type(F.get("argv", 0).cast("string"))
    number = lambda c: F.col(c).cast("string")
    event_id = F.concat_ws(":", number("term_id"), number("filenum"), number("offset"), number("logic_id"))
    position = _object(*[_member(n, F.lit(0) if n == "server_id" else number(n), False) for n in ("filenum", "offset", "logic_id", "server_id", "term_id")])
    value = _common("binlog", op, kind, key, F.col("argv"), F.col("raw_resp"), F.col("exec_time").cast("long") * 1000, event_id, position, o)
    return _routed(df, "binlog", kind, key, value, o)


def snapshot_events(df: DataFrame, o: Options, now_ms: int) -> DataFrame:
    """df with topic, key and value added. Reads data_type, key, argv and raw_resp; the time is a parameter. Event ids aren't unique: all chunks of a key share one."""
    op = F.lower(F.get("argv", 0).cast("string"))
    key = F.col("key").cast("string")
    event_id = F.concat(F.lit(f"snapshot:{o.db_name}:"), F.col("data_type"), F.lit(":"), key)
    value = _common("snapshot", op, F.col("data_type"), key, F.col("argv"), F.col("raw_resp"), F.lit(now_ms), event_id, None, o)
    return _routed(df, "snapshot", F.col("data_type"), key, value, o)


def _routed(df: DataFrame, kind: str, data_type: Column, key: Column, value: Column, o: Options) -> DataFrame:
    topic = C.topic(F.lit(kind), o.kafka_stream_mode, o.kafka_topic_snapshot, o.kafka_topic_binlog, o.kafka_topic_single)
    made = F.struct(topic.alias("topic"), C.partition_key(F.lit(o.db_name), data_type, key.cast("string")).alias("event_key"), value.alias("value"))
    return df.withColumn("event", made)


def records(df: DataFrame) -> DataFrame:
    """topic, key, value: what a sink takes."""
    return df.select("event.topic", F.col("event.event_key").alias("key"), "event.value")


def in_key_order(df: DataFrame, partitions: int, order: str = "seq") -> DataFrame:
    """Rows of a partition key together and in order, for sinks that promise order by key. Nothing is ordered across keys."""
    return df.repartition(partitions, F.col("event.event_key")).sortWithinPartitions(F.col("event.event_key"), order)
