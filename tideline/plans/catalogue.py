"""The registered queries over the change feed, with their SQL.

Each query runs on whole tables. Results hold scalar columns only, arrays joined with |, so that values compare alike
in both engines. SQL that several queries share is in the fragments at the top.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import commands, frames, header, numbers, resp
from ..operators import events, filters, planner, progress, snapshot, status
from ..sources import checkpoint, wal
from ..sources.options import Options
from ..streaming import feed
from . import adapters
from .adapters import load

SOURCE = "10.0.0.1:9221"
OPTIONS = Options(source_id=SOURCE)
NOW, NOW_MS = 1_700_000_000, 1_700_000_000_000
BATCH, SET_BATCH, TAIL = 4, 64, 3

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under q_<its name>."""

    def put(f):
        QUERIES[f"q_{f.__name__}"] = f
        if sql:
            ORACLE[f"q_{f.__name__}"] = sql
        return f

    return put


# ---- SQL fragments -------------------------------------------------------------------------------------------

_LOG = """cmd AS (
    SELECT *, (seq - 1) // 1000 AS filenum, ((seq - 1) % 1000) * 100 AS "offset",
        CASE event_type WHEN 'signup' THEN ['SET', k, event_type] WHEN 'view' THEN ['LPUSH', k, id] WHEN 'click' THEN ['hset', k, 'last', id]
            WHEN 'purchase' THEN ['ZADD', k, printf('%.6f', coalesce(value, 0)), id] WHEN 'error' THEN ['del', k] END AS argv
    FROM (SELECT row_number() OVER (ORDER BY ts, event_id) AS seq, event_id, event_type, value, 'user:' || user_id AS k,
            CAST(event_id AS VARCHAR) AS id, CAST(floor(epoch(ts)) AS BIGINT) AS exec_time FROM events))"""
_TYPE = "CASE lower(argv[1]) " + " ".join(f"WHEN '{n}' THEN '{k}'" for k, names in commands.COMMANDS.items() for n in names) + " ELSE 'unknown' END"
_CRLF = "chr(13) || chr(10)"


def _resp_sql(argv: str) -> str:
    return f"'*' || len({argv}) || {_CRLF} || array_to_string(list_transform({argv}, lambda x: '$' || strlen(x) || {_CRLF} || x || {_CRLF}), '')"


def _log_sql(select: str, where: str = "TRUE") -> str:
    return f"WITH {_LOG}, c AS (SELECT *, argv[2] AS key, {_TYPE} AS data_type, {_resp_sql('argv')} AS raw_resp FROM cmd) SELECT {select} FROM c WHERE {where}"


_B64 = lambda x: f"to_base64(encode({x}))"
_LOG_VALUE = (
    """'{"event_type":"binlog","op":"' || lower(argv[1]) || '","data_type":"' || data_type || '","db":"db0","slot":0,"key":"' || key || '","args":['"""
    f""" || array_to_string(list_transform(argv, lambda x: '"' || {_B64('x')} || '"'), ',') || '],"args_encoding":"base64","raw_resp":"' || {_B64('raw_resp')}"""
    """ || '","raw_resp_encoding":"base64","ts_ms":' || exec_time * 1000 || ',"event_id":"1:' || filenum || ':' || "offset" || ':' || seq"""
    f""" || '","source_id":"{SOURCE}","binlog":{{"filenum":' || filenum || ',"offset":' || "offset" || ',"logic_id":' || seq"""
    """ || ',"server_id":0,"term_id":1},"source":{"host":"10.0.0.1","port":9221}}'"""
)


def _chunk_sql(kind: str, command: str, items: str, batch: int, ttl_key: str, prefix: str) -> str:
    """items: a query of id, item, rn (from 1)."""
    return f"""
    WITH items AS ({items}),
    w AS (SELECT id, (rn - 1) // {batch} AS ord, '{command}|{prefix}' || id || '|' || string_agg(item, '|' ORDER BY rn) AS args FROM items GROUP BY id, (rn - 1) // {batch})
    SELECT '{kind}' AS data_type, '{prefix}' || id AS key, CAST(ord AS BIGINT) AS ord, args FROM w
    UNION ALL SELECT '{kind}', '{prefix}' || id, {snapshot.LAST}, 'EXPIRE|{prefix}' || id || '|60' FROM (SELECT DISTINCT id FROM items) WHERE id % 7 = 0"""


_LIST_ITEMS = "SELECT l_orderkey AS id, CAST(l_partkey AS VARCHAR) AS item, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem"
_TAIL_ITEMS = f"SELECT id, item, rn - greatest(n - {TAIL}, 0) AS rn FROM (SELECT *, count(*) OVER (PARTITION BY id) AS n FROM ({_LIST_ITEMS})) WHERE rn > n - {TAIL}"
_HASH_ITEMS = """SELECT o_orderkey AS id, f || '|' || v AS item, row_number() OVER (PARTITION BY o_orderkey ORDER BY f) AS rn FROM (
    SELECT o_orderkey, 'cust' AS f, CAST(o_custkey AS VARCHAR) AS v FROM orders UNION ALL SELECT o_orderkey, 'priority', o_orderpriority FROM orders
    UNION ALL SELECT o_orderkey, 'status', o_orderstatus FROM orders)"""
_SET_ITEMS = "SELECT l_suppkey AS id, p AS item, row_number() OVER (PARTITION BY l_suppkey ORDER BY p) AS rn FROM (SELECT DISTINCT l_suppkey, CAST(l_partkey AS VARCHAR) AS p FROM lineitem)"
_ZSET_ITEMS = "SELECT o_custkey AS id, printf('%.6f', o_totalprice) || '|' || o_orderkey AS item, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice, CAST(o_orderkey AS VARCHAR)) AS rn FROM orders"
_STRING_SQL = """SELECT 'string' AS data_type, 'cust:' || c_custkey AS key, CAST(0 AS BIGINT) AS ord,
    'SET|cust:' || c_custkey || '|' || c_name || CASE WHEN c_custkey % 10 = 0 THEN '|EX|3600' ELSE '' END AS args FROM customer"""


# ---- scalar functions ----------------------------------------------------------------------------------------


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    command = F.get("argv", 0)
    return adapters.log(spark, sf_dir).withColumns({"key": F.get("argv", 1), "data_type": commands.data_type(command), "command": command})


@query(_log_sql("seq, argv[1] AS command, data_type"))
def command_type(spark, sf_dir):
    return _log(spark, sf_dir).select("seq", "command", "data_type")


@query(_log_sql("seq, raw_resp, strlen(raw_resp) AS n_bytes"))
def resp_serialize(spark, sf_dir):
    return _log(spark, sf_dir).select("seq", "raw_resp", F.octet_length("raw_resp").cast("long").alias("n_bytes"))


@query(f"SELECT doc_id, strlen(r) AS n_bytes, md5(r) AS digest FROM (SELECT doc_id, {_resp_sql('a')} AS r FROM (SELECT doc_id, ['SET', 'doc:' || doc_id, text] AS a FROM documents))")
def resp_documents(spark, sf_dir):
    """Long texts in several languages: lengths count bytes."""
    argv = F.array(F.lit("SET"), F.concat(F.lit("doc:"), F.col("doc_id").cast("string")), F.col("text"))
    made = load(spark, sf_dir, "documents").select("doc_id", resp.serialize(argv).alias("r"))
    return made.select("doc_id", F.octet_length("r").cast("long").alias("n_bytes"), F.md5("r").alias("digest"))


@query(_log_sql("seq, array_to_string(argv, '|') AS args, CAST(NULL AS VARCHAR) AS error"))
def resp_roundtrip(spark, sf_dir):
    rows = _log(spark, sf_dir).select("seq", resp.parse(F.col("raw_resp").cast("binary")).alias("p"))
    return rows.select("seq", F.array_join(F.transform("p.argv", lambda a: a.cast("string")), "|").alias("args"), "p.error")


@query(_log_sql("""seq, 1 AS type, exec_time, CAST(1 AS BIGINT) AS term_id, seq AS logic_id, filenum, "offset", raw_resp AS content, CAST(NULL AS VARCHAR) AS error"""))
def header_roundtrip(spark, sf_dir):
    raw = header.encode(F.col("exec_time"), F.col("term_id"), F.col("logic_id"), F.col("filenum"), F.col("offset"), F.col("raw_resp").cast("binary"))
    h = _log(spark, sf_dir).select("seq", header.decode(raw).alias("h"))
    long = lambda c: F.col(f"h.{c}").cast("long").alias(c)
    return h.select("seq", "h.type", "h.exec_time", "h.term_id", long("logic_id"), "h.filenum", long("offset"), F.col("h.content").cast("string").alias("content"), "h.error")


@query(_log_sql("seq, CAST(2 AS INT) AS n_frames, raw_resp AS first, key AS second, CAST(3 AS INT) AS rest"))
def frame_split(spark, sf_dir):
    """Two frames and the beginning of a third."""
    sent = F.concat(frames.frame(F.col("raw_resp").cast("binary")), frames.frame(F.col("key").cast("binary")), F.lit(b"\0\0\1"))
    rows = _log(spark, sf_dir).select("seq", frames.split(sent).alias("f"))
    at = lambda k: F.get("f.frames", k).cast("string")
    return rows.select("seq", F.size("f.frames").alias("n_frames"), at(0).alias("first"), at(1).alias("second"), F.octet_length("f.rest").alias("rest"))


@query(_log_sql("seq, 'db0:' || data_type || CASE WHEN key = '' THEN '' ELSE ':' || key END AS event_key, 'db0:' || data_type AS keyless"))
def partition_key(spark, sf_dir):
    made = lambda key: commands.partition_key(F.lit("db0"), F.col("data_type"), key)
    return _log(spark, sf_dir).select("seq", made(F.col("key")).alias("event_key"), made(F.lit("")).alias("keyless"))


@query(_log_sql("seq, CASE WHEN seq % 2 = 0 THEN 'feed.snapshot' ELSE 'feed.binlog' END AS dual, 'feed.single' AS single"))
def topic_route(spark, sf_dir):
    kind = F.when(F.col("seq") % 2 == 0, F.lit("snapshot")).otherwise(F.lit("binlog"))
    o = OPTIONS
    made = lambda mode: commands.topic(kind, mode, o.kafka_topic_snapshot, o.kafka_topic_binlog, o.kafka_topic_single)
    return _log(spark, sf_dir).select("seq", made("dual").alias("dual"), made("single").alias("single"))


@query("SELECT doc_id, md5(to_base64(encode(text))) AS base64_digest, md5(text) AS plain_digest FROM documents WHERE text IS NOT NULL")
def payload_encoding(spark, sf_dir):
    docs = load(spark, sf_dir, "documents").where("text IS NOT NULL")
    return docs.select("doc_id", F.md5(commands.encode_payload(F.col("text"), "base64")).alias("base64_digest"), F.md5(commands.encode_payload(F.col("text"), "none")).alias("plain_digest"))


@query("SELECT doc_id, md5(replace(replace(replace(replace(text, chr(92), chr(92) || chr(92)), '\"', chr(92) || '\"'), chr(10), chr(92) || 'n'), chr(9), chr(92) || 't')) AS digest FROM documents WHERE text IS NOT NULL")
def json_escape(spark, sf_dir):
    return load(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", F.md5(commands.json_escape(F.col("text"))).alias("digest"))


@query("SELECT doc_id, md5(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) AS digest FROM documents WHERE text IS NOT NULL")
def ascii_lower(spark, sf_dir):
    return load(spark, sf_dir, "documents").where("text IS NOT NULL").select("doc_id", F.md5(commands.ascii_lower(F.col("text"))).alias("digest"))


@query("SELECT o_orderkey, printf('%.6f', o_totalprice) AS score FROM orders")
def score_render(spark, sf_dir):
    return load(spark, sf_dir, "orders").select("o_orderkey", commands.score_text(F.col("o_totalprice")).alias("score"))


@query(
    f"""WITH {_LOG}, p AS (SELECT seq, CASE seq % 4 WHEN 0 THEN ['pksetexat', k, CAST({NOW} + seq AS VARCHAR), 'v'] WHEN 1 THEN ['PKSETEXAT', k, '1', 'v']
        WHEN 2 THEN ['pksetexat', k, ' 5 ', 'v'] ELSE ['pksetexat', k, CAST({NOW} - seq AS VARCHAR), 'v', 'more'] END AS a, k FROM cmd)
    SELECT seq, CASE WHEN seq % 4 IN (0, 3) THEN {_resp_sql(f"['setex', k, CAST(CAST(a[3] AS BIGINT) - {NOW} AS VARCHAR), 'v']")} ELSE {_resp_sql('a')} END AS raw_resp FROM p"""
)
def pksetexat(spark, sf_dir):
    k, seq = F.col("key"), F.col("seq")
    at = lambda c: c.cast("string")
    argv = (
        F.when(seq % 4 == 0, F.array(F.lit("pksetexat"), k, at(F.lit(NOW) + seq), F.lit("v")))
        .when(seq % 4 == 1, F.array(F.lit("PKSETEXAT"), k, F.lit("1"), F.lit("v")))
        .when(seq % 4 == 2, F.array(F.lit("pksetexat"), k, F.lit(" 5 "), F.lit("v")))
        .otherwise(F.array(F.lit("pksetexat"), k, at(F.lit(NOW) - seq), F.lit("v"), F.lit("more")))
    )
    rows = _log(spark, sf_dir).select("seq", argv.alias("a"))
    return rows.select("seq", commands.rewrite_expiry(F.col("a"), resp.serialize(F.col("a")), F.lit(NOW)).alias("raw_resp"))


# ---- events ---------------------------------------------------------------------------------------------------


@query(_log_sql(f"'feed.binlog' AS topic, 'db0:' || data_type || ':' || key AS key, {_LOG_VALUE} AS value"))
def binlog_event_json(spark, sf_dir):
    return events.records(events.binlog_events(adapters.log(spark, sf_dir), OPTIONS))


_SNAPSHOT_VALUE = (
    """'{"event_type":"snapshot","op":"set","data_type":"string","db":"db0","slot":0,"key":"' || key || '","args":['"""
    """ || array_to_string(list_transform(argv, lambda x: '"' || x || '"'), ',') || '],"args_encoding":"none","ts_ms":"""
    f"""{NOW_MS},"event_id":"snapshot:db0:string:' || key || '","source_id":"{SOURCE}","source":{{"host":"10.0.0.1","port":9221}}}}'"""
)


@query(
    f"""WITH s AS (SELECT 'cust:' || c_custkey AS key, list_concat(['SET', 'cust:' || c_custkey, c_name], CASE WHEN c_custkey % 10 = 0 THEN ['EX', '3600'] ELSE [] END) AS argv FROM customer)
    SELECT 'feed.single' AS topic, 'db0:string:' || key AS key, {_SNAPSHOT_VALUE} AS value FROM s"""
)
def snapshot_event_json(spark, sf_dir):
    rows = snapshot.strings(adapters.strings(spark, sf_dir)).withColumn("raw_resp", resp.serialize(F.col("argv")))
    o = Options(source_id=SOURCE, kafka_stream_mode="single", args_encoding="none", include_raw_resp=False)
    return events.records(events.snapshot_events(rows, o, NOW_MS))


@query("""SELECT s_suppkey, '{"host":"10.0.0.1","port":9221}' AS plain, '{"host":"::1"}' AS odd, '{"host":"primary"}' AS bare FROM supplier""")
def source_object(spark, sf_dir):
    made = lambda s: F.lit(events.source_object(s))
    return load(spark, sf_dir, "supplier").select("s_suppkey", made(SOURCE).alias("plain"), made("::1").alias("odd"), made("primary").alias("bare"))


@query(_log_sql("seq, 'db0:' || data_type || ':' || key AS event_key, row_number() OVER (PARTITION BY data_type, key ORDER BY seq) AS place"))
def key_order(spark, sf_dir):
    """Place of each event in its partition key's order, as in_key_order() leaves it."""
    rows = events.in_key_order(events.binlog_events(adapters.log(spark, sf_dir), OPTIONS), 8)
    key = F.col("event.event_key")
    return rows.select("seq", key.alias("event_key"), F.row_number().over(Window.partitionBy(key).orderBy("seq")).cast("long").alias("place"))


# ---- filters --------------------------------------------------------------------------------------------------


def _filtered(groups: list[str], excludes: list[str] = ()):
    def run(spark, sf_dir):
        f, _ = filters.build(list(groups), list(excludes))
        keep = planner.pruned_predicate(f, F.col("key"), F.col("data_type"), F.col("command"), snapshot=False)
        return _log(spark, sf_dir).where(keep).select("seq", "key", "data_type", "command")

    return run


_FILTERS = {
    "exact": (["key=user:7,user:11"], [], "key IN ('user:7', 'user:11')"),
    "prefix": (["key=user:1*"], [], "starts_with(key, 'user:1')"),
    "regex": (["key=user:[0-9]*5$"], [], "regexp_matches(key, 'user:[0-9]*5$')"),
    "exclude": ([], ["user:1*,user:2.$"], "NOT (starts_with(key, 'user:1') OR regexp_matches(key, 'user:2.$'))"),
    "groups": (["key=user:1*;type=list;action=lpush", "key=user:2*;type=zset"], ["user:22"], "((starts_with(key, 'user:1') AND data_type IN ('list', 'unknown') AND lower(argv[1]) = 'lpush') OR (starts_with(key, 'user:2') AND data_type IN ('zset', 'unknown'))) AND key <> 'user:22'"),
    "unknown": (["type=string"], [], "data_type IN ('string', 'unknown')"),
    "action": (["action=LPUSH,del"], [], "lower(argv[1]) IN ('lpush', 'del')"),
    "fail_open": (["key=a**;type=list", "foo=bar"], [], "data_type IN ('list', 'unknown')"),
    "invalid": (["foo=bar"], [], "TRUE"),
    "match_all": (["key=*"], [], "TRUE"),
}
for _name, (_groups, _excludes, _sql) in _FILTERS.items():
    QUERIES[f"q_filter_{_name}"] = _filtered(_groups, _excludes)
    ORACLE[f"q_filter_{_name}"] = _log_sql("seq, key, data_type, argv[1] AS command", _sql)


@query("SELECT key, data_type FROM (SELECT 'cust:' || c_custkey AS key, 'string' AS data_type FROM customer UNION ALL SELECT 'spend:' || o_custkey, 'zset' FROM (SELECT DISTINCT o_custkey FROM orders)) WHERE starts_with(key, 'cust:1') OR starts_with(key, 'cust:2')")
def reader_plan(spark, sf_dir):
    """Keys that the planned readers scan: overlapping patterns give a key once."""
    f, _ = filters.build(["key=cust:1*,cust:2*,cust:12*;type=string"], [])
    specs, _ = planner.reader_specs(f, "type", prefixes=["cust:1", "cust:2", "cust:12"])
    keys = adapters.strings(spark, sf_dir).select("key", F.lit("string").alias("data_type"))
    keys = keys.unionByName(load(spark, sf_dir, "orders").select(F.concat(F.lit("spend:"), F.col("o_custkey").cast("string")).alias("key"), F.lit("zset").alias("data_type")).distinct())
    return keys.where(planner.scan_predicate(specs, F.col("key"), F.col("data_type")))


@query("SELECT 'cust:' || c_custkey AS key FROM customer WHERE c_custkey % 5 <> 0")
def internal_keys(spark, sf_dir):
    k = F.when(F.expr("c_custkey % 5 = 0"), F.lit(planner.INTERNAL_PREFIX)).otherwise(F.lit(""))
    keys = load(spark, sf_dir, "customer").select(F.concat(k, F.lit("cust:"), F.col("c_custkey").cast("string")).alias("key"), F.lit("string").alias("data_type"))
    specs, _ = planner.reader_specs(None)
    return keys.where(planner.scan_predicate(specs, F.col("key"), F.col("data_type"))).select("key")


# ---- snapshots ------------------------------------------------------------------------------------------------


def _args(rows: DataFrame) -> DataFrame:
    return rows.select("data_type", "key", F.col("ord").cast("long").alias("ord"), F.array_join("argv", "|").alias("args"))


@query(_STRING_SQL)
def snapshot_string(spark, sf_dir):
    return _args(snapshot.strings(adapters.strings(spark, sf_dir)))


@query(_chunk_sql("list", "RPUSH", _LIST_ITEMS, BATCH, "", "lines:"))
def snapshot_list(spark, sf_dir):
    return _args(snapshot.lists(adapters.lists(spark, sf_dir), BATCH))


@query(_chunk_sql("list", "RPUSH", _TAIL_ITEMS, BATCH, "", "lines:"))
def list_tail(spark, sf_dir):
    return _args(snapshot.lists(adapters.lists(spark, sf_dir), BATCH, TAIL))


@query(_chunk_sql("hash", "HMSET", _HASH_ITEMS, 2, "", "order:"))
def snapshot_hash(spark, sf_dir):
    return _args(snapshot.hashes(adapters.hashes(spark, sf_dir), 2))


@query(_chunk_sql("set", "SADD", _SET_ITEMS, SET_BATCH, "", "supp:"))
def snapshot_set(spark, sf_dir):
    return _args(snapshot.sets(adapters.sets(spark, sf_dir), SET_BATCH))


@query(_chunk_sql("zset", "ZADD", _ZSET_ITEMS, BATCH, "", "spend:"))
def snapshot_zset(spark, sf_dir):
    return _args(snapshot.zsets(adapters.zsets(spark, sf_dir), BATCH))


@query("SELECT 'zset' AS data_type, 'spend:' || o_custkey AS key, CAST(60 AS BIGINT) AS ttl FROM (SELECT DISTINCT o_custkey FROM orders) WHERE o_custkey % 7 = 0")
def expire_rows(spark, sf_dir):
    rows = snapshot.expiry(adapters.zsets(spark, sf_dir), "zset")
    return rows.select("data_type", "key", F.get("argv", 2).cast("long").alias("ttl"))


_KEYSPACE = [("string", "customer", "1"), ("list", _LIST_ITEMS, BATCH), ("hash", _HASH_ITEMS, BATCH), ("set", _SET_ITEMS, BATCH), ("zset", _ZSET_ITEMS, BATCH)]


@query(
    f"""WITH n AS (SELECT 'string' AS data_type, c_custkey AS id, 1 AS chunks, 0 AS expiries FROM customer
    {' '.join(f"UNION ALL SELECT '{k}', id, CAST(ceil(count(*) / {b}.0) AS BIGINT), CASE WHEN id % 7 = 0 THEN 1 ELSE 0 END FROM ({q}) GROUP BY id" for k, q, b in _KEYSPACE[1:])})
    SELECT data_type, count(*) AS keys, CAST(sum(chunks) AS BIGINT) AS writes, CAST(sum(expiries) AS BIGINT) AS expiries FROM n GROUP BY data_type"""
)
def snapshot_all(spark, sf_dir):
    """The whole keyspace in one union."""
    rows = snapshot.snapshot(*[f(spark, sf_dir) for f in (adapters.strings, adapters.lists, adapters.hashes, adapters.sets, adapters.zsets)], batch=BATCH)
    last = F.col("ord") == snapshot.LAST
    return rows.groupBy("data_type").agg(F.countDistinct("key").alias("keys"), F.count_if(~last).alias("writes"), F.count_if(last).alias("expiries"))


@query(
    f"""WITH {_LOG} SELECT 'snapshot' AS origin, 'cust:' || c_custkey AS key FROM customer
    UNION ALL SELECT 'binlog', k FROM cmd WHERE filenum > 2 OR (filenum = 2 AND "offset" >= 50000)"""
)
def handoff(spark, sf_dir):
    first = adapters.strings(spark, sf_dir).select(F.lit("snapshot").alias("origin"), "key")
    rest = _log(spark, sf_dir).select(F.lit("binlog").alias("origin"), "key", "filenum", "offset")
    return snapshot.handoff(first, rest, 2, 50_000).select("origin", "key")


# ---- progress -------------------------------------------------------------------------------------------------


@query(f"WITH {_LOG}, d AS (SELECT seq FROM cmd WHERE seq % 97 <> 0) SELECT min(seq) AS ack_seq FROM d WHERE seq + 1 NOT IN (SELECT seq FROM d)")
def ack_prefix(spark, sf_dir):
    return progress.contiguous_prefix(_log(spark, sf_dir).where("seq % 97 <> 0"))


_EPOCHS = f"WITH {_LOG}, d AS (SELECT event_id % 3 AS source, CASE WHEN seq > 500 THEN 2 ELSE 1 END AS epoch, CASE WHEN seq > 500 THEN seq - 500 ELSE seq END AS n FROM cmd), e AS (SELECT DISTINCT source, (n - 1) // 3 + 1 AS m FROM d WHERE epoch = 2)"


@query(_EPOCHS + " SELECT source, coalesce(min(m) FILTER (WHERE NOT EXISTS (SELECT 1 FROM e f WHERE f.source = e.source AND f.m = e.m + 1)), 0) * CAST(min(m) = 1 AS INT) AS ack_seq FROM e GROUP BY source")
def ack_epochs(spark, sf_dir):
    """Snapshot and log prefixes a source: a new epoch starts over, older ones don't count."""
    late = F.col("seq") > 500
    done = _log(spark, sf_dir).select((F.col("event_id") % 3).alias("source"), F.when(late, 2).otherwise(1).alias("epoch"), F.when(late, F.col("seq") - 500).otherwise(F.col("seq")).alias("n"))
    done = done.select("source", "epoch", (F.floor((F.col("n") - 1) / 3) + 1).alias("seq"))
    return progress.contiguous_prefix(done, ["source"], epoch="epoch")


@query(f"""WITH {_LOG} SELECT event_type, max(seq) AS seq, arg_max(filenum, seq) AS filenum, arg_max("offset", seq) AS "offset" FROM cmd GROUP BY event_type""")
def durable_max(spark, sf_dir):
    rows = _log(spark, sf_dir).join(load(spark, sf_dir, "events").select("event_id", "event_type"), "event_id")
    return progress.high_water(rows, ["event_type"], ["filenum", "offset"])


@query(
    f"""WITH {_LOG}, n AS (SELECT {_TYPE} AS data_type, seq, filenum, "offset" FROM cmd WHERE filenum > 1 OR (filenum = 1 AND "offset" > 30000))
    SELECT data_type, arg_min(filenum, seq) AS start_filenum, arg_min("offset", seq) AS start_offset, arg_max(filenum, seq) AS end_filenum, arg_max("offset", seq) AS end_offset FROM n GROUP BY data_type"""
)
def ack_range(spark, sf_dir):
    made = progress.ack_range(_log(spark, sf_dir), ["data_type"], F.lit(1), F.lit(30_000))
    return made.select("data_type", "start_filenum", F.col("start_offset").cast("long").alias("start_offset"), "end_filenum", F.col("end_offset").cast("long").alias("end_offset"))


_SEGMENTS = f"""WITH {_LOG}, s AS (SELECT (seq - 1) // 300 AS segment, arg_min(filenum, seq) AS f, arg_min("offset", seq) AS o FROM cmd GROUP BY (seq - 1) // 300),
    w AS (SELECT *, lead(f) OVER (ORDER BY f, o, segment) AS nf, lead(o) OVER (ORDER BY f, o, segment) AS no, row_number() OVER (ORDER BY f DESC, o DESC, segment DESC) AS r FROM s)"""


@query(_SEGMENTS + " SELECT segment, f AS start_filenum, o AS start_offset FROM w WHERE r > 2 AND (f > 0 OR o > 0) AND (nf > 0 OR no > 0) AND (nf < 2 OR (nf = 2 AND no <= 70000))")
def wal_gc(spark, sf_dir):
    at = progress.position().alias("at")
    rows = _log(spark, sf_dir).select(F.floor((F.col("seq") - 1) / 300).cast("long").alias("segment"), at)
    parts = rows.groupBy("segment").agg(F.min("at").alias("at")).select("segment", F.col("at.col1").alias("start_filenum"), F.col("at.col2").cast("long").alias("start_offset"))
    return progress.removable_segments(parts, F.lit(2), F.lit(70_000)).select("segment", "start_filenum", "start_offset")


@query(f"""WITH {_LOG} SELECT DISTINCT filenum AS start_filenum, "offset" AS start_offset, seq AS segment FROM cmd""")
def segment_names(spark, sf_dir):
    name = F.format_string("wal-%08d-%020d-%08d.log", "filenum", "offset", "seq")
    s = _log(spark, sf_dir).select(wal.segment_fields(name).alias("s"))
    return s.select("s.start_filenum", F.col("s.start_offset").cast("long").alias("start_offset"), "s.segment")


@query(
    f"""WITH {_LOG} SELECT seq, CASE seq % 3 WHEN 2 THEN filenum + 1 ELSE filenum END AS filenum, CASE seq % 3 WHEN 2 THEN CAST(event_id AS BIGINT) ELSE "offset" END AS "offset",
    CASE seq % 3 WHEN 0 THEN seq WHEN 1 THEN greatest(3, seq % 11) END AS master_lag FROM cmd"""
)
def status_parse(spark, sf_dir):
    text = lambda c: F.col(c).cast("string")
    made = (
        F.when(F.col("seq") % 3 == 0, F.concat(F.lit("# Replication\r\nrole:master\r\nbinlog_offset:"), text("filenum"), F.lit(" "), text("offset"), F.lit("\r\nmaster_lag:"), text("seq")))
        .when(F.col("seq") % 3 == 1, F.concat(F.lit("some=thing binlog_offset="), text("filenum"), F.lit(","), text("offset"), F.lit(" lag=(3,"), (F.col("seq") % 11).cast("string"), F.lit(",1)")))
        .otherwise(F.concat(F.lit("binlog_file_num: "), (F.col("filenum") + 1).cast("string"), F.lit("\r\nbinlog_offset: "), text("event_id")))
    )
    rows = _log(spark, sf_dir).select("seq", made.alias("text"))
    # a lag list also follows binlog_offset=, whose first two numbers are the position
    return status.parse(rows, "text").select("seq", "filenum", F.col("offset").cast("long").alias("offset"), "master_lag")


@query(_log_sql("count(*) AS recv, count(*) FILTER (WHERE seq % 10 > 0) AS parsed, count(*) FILTER (WHERE seq % 10 > 0 AND data_type = 'list') AS produced, count(*) FILTER (WHERE seq % 10 > 0 AND data_type <> 'list') AS filtered, count(*) FILTER (WHERE seq % 10 = 0) AS errors"))
def progress_counts(spark, sf_dir):
    return progress.counters(_log(spark, sf_dir), F.col("seq") % 10 > 0, F.col("data_type") == "list")


@query(_log_sql("seq, key", "seq % 4 = 2"))
def session_filter(spark, sf_dir):
    return progress.current_session(_log(spark, sf_dir).withColumn("session_id", F.col("seq") % 4), F.lit(2)).select("seq", "key")


@query(_log_sql("""seq, filenum > 3 OR (filenum = 3 AND "offset" > 20000) AS newer, filenum > 3 OR (filenum = 3 AND "offset" >= 20000) AS newer_or_equal"""))
def position_compare(spark, sf_dir):
    other = F.struct(F.lit(3).cast("long"), F.lit(20_000).cast("decimal(20,0)"))
    return _log(spark, sf_dir).select("seq", (progress.position() > other).alias("newer"), (progress.position() >= other).alias("newer_or_equal"))


_LIFE = """SELECT o_custkey AS source, arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS s, arg_max(o_orderkey, (o_orderdate, o_orderkey)) AS k FROM orders GROUP BY o_custkey"""


@query(f"SELECT source, CASE s WHEN 'F' THEN 'done' ELSE 'running' END AS state, CASE s WHEN 'F' THEN k % 100 END AS ack_filenum, CASE s WHEN 'F' THEN k END AS ack_offset FROM ({_LIFE})")
def snapshot_lifecycle(spark, sf_dir):
    state = F.when(F.col("o_orderstatus") == "F", F.lit("done")).otherwise(F.lit("running"))
    rows = load(spark, sf_dir, "orders").select(F.col("o_custkey").alias("source"), F.struct("o_orderdate", "o_orderkey").alias("at"), state.alias("state"), (F.col("o_orderkey") % 100).alias("end_filenum"), F.col("o_orderkey").alias("end_offset"))
    return progress.snapshot_state(rows, ["source"], "at")


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'unsupported version' WHEN c_custkey % 5 = 0 THEN 'no source_id' END AS error, c_custkey * 7 AS ack_seq FROM customer")
def checkpoint_decode(spark, sf_dir):
    k = F.col("c_custkey")
    doc = F.to_json(F.struct(F.when(k % 3 == 0, 2).otherwise(1).alias("version"), F.when(k % 5 == 0, F.lit("")).otherwise(F.lit(SOURCE)).alias("source_id"), F.lit(7).alias("epoch"), F.struct((k * 7).alias("seq"), k.alias("filenum")).alias("ack_cp")))
    rows = load(spark, sf_dir, "customer").select("c_custkey", checkpoint.decode(doc).alias("d"))
    return rows.select("c_custkey", "d.error", F.col("d.checkpoint.ack_cp.seq").cast("long").alias("ack_seq"))


_DIALECT = [r"user:[0-9]*5$", r"dev|(?i)USER:1[0-4]", r"\Quser:2\E\s", "7[^0-9]?$"]
_ODD_KEY = "'user:' || c_custkey || CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN chr(10) WHEN 2 THEN ' ' ELSE chr(8232) END"


@query(f"SELECT c_custkey, {', '.join(f'regexp_matches({_ODD_KEY}, {chr(39)}{p}{chr(39)}) AS m{i}' for i, p in enumerate(_DIALECT))} FROM customer")
def filter_dialect(spark, sf_dir):
    """Key expressions on keys that end in a line feed, a blank or a line separator."""
    k = F.col("c_custkey")
    end = F.when(k % 4 == 0, "").when(k % 4 == 1, "\n").when(k % 4 == 2, " ").otherwise("\u2028")
    key = F.concat(F.lit("user:"), k.cast("string"), end)
    return load(spark, sf_dir, "customer").select(k, *[filters.parse_key(p).column(key).alias(f"m{i}") for i, p in enumerate(_DIALECT)])


@query("""SELECT c_custkey AS source, '{"version":1,"source_id":"s' || c_custkey || '","epoch":7,"ack_cp":{"seq":' || c_custkey || ',"filenum":2,"offset":' || c_custkey * 100
    || '},"durable_cp":{"seq":' || (c_custkey + 5) || ',"filenum":2,"offset":' || (c_custkey * 100 + 500) || '}}' AS document FROM customer""")
def checkpoint_export(spark, sf_dir):
    """The progress document of every source."""
    k = F.col("c_custkey").cast("long")
    at = lambda p, more: [(k + more).alias(f"{p}_seq"), F.lit(2).alias(f"{p}_filenum"), (k * 100 + more * 100).alias(f"{p}_offset")]
    rows = load(spark, sf_dir, "customer").select(F.concat(F.lit("s"), k.cast("string")).alias("source_id"), F.lit(7).alias("epoch"), *at("ack", 0), *at("durable", 5))
    return checkpoint.documents(rows).select(F.substring("source_id", 2, 20).cast("long").alias("source"), "document")


@query(_log_sql("seq, CASE seq % 4 WHEN 0 THEN 'too short' WHEN 1 THEN 'unexpected type' WHEN 2 THEN 'content length mismatch' END AS error, CASE WHEN seq % 4 = 3 THEN array_to_string(argv, '|') END AS args"))
def quarantine(spark, sf_dir):
    """Three of four records are damaged: cut, of another type, or with a byte too many; each is set aside with its reason."""
    raw = header.encode(F.col("exec_time"), F.col("term_id"), F.col("logic_id"), F.col("filenum"), F.col("offset"), F.col("raw_resp").cast("binary"))
    rows = _log(spark, sf_dir).select("seq", raw.alias("raw"))
    k = F.col("seq") % 4
    bad = F.when(k == 0, F.substring("raw", 1, 20)).when(k == 1, F.concat(F.lit(b"\x09\x00"), F.substring("raw", 3, 1 << 20))).when(k == 2, F.concat("raw", F.lit(b"x"))).otherwise(F.col("raw"))
    made = feed.decoded(rows.withColumn("raw", bad), "quarantine", NOW)
    return made.select("seq", "error", F.when(F.col("error").isNull(), F.array_join("argv", "|")).alias("args"))


@query(_log_sql("DISTINCT 'db0:' || data_type || ':' || key AS event_key, count(*) OVER (PARTITION BY data_type, key) AS n"))
def without_repeats(spark, sf_dir):
    """Every record twice, and each event once."""
    log = _log(spark, sf_dir)
    rows = events.binlog_events(log.unionByName(log), OPTIONS)
    return rows.dropDuplicates(["seq"]).groupBy("event.event_key").agg(F.count(F.lit(1)).alias("n"))


# ---- logs and streams -----------------------------------------------------------------------------------------


def _scratch(spark: SparkSession, name: str) -> str:
    """A folder of this run; shared by the cluster where one is configured."""
    import tempfile
    import uuid

    base = spark.conf.get("spark.checkpoint.dir", None) or tempfile.gettempdir()
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


@query(_log_sql("""1 AS type, CAST(7 AS BIGINT) AS epoch, seq, filenum, "offset", raw_resp AS payload"""))
def wal_roundtrip(spark, sf_dir):
    """Write segments, read them back with the data source, checksums verified."""
    folder = _scratch(spark, "wal")
    rows = _log(spark, sf_dir).select(F.lit(7).alias("epoch"), "seq", "filenum", "offset", F.col("raw_resp").cast("binary").alias("payload"))
    wal.write(wal.range_by_position(rows, 4), folder, segment_bytes=1 << 20).count()
    spark.dataSource.register(wal.WalDataSource)
    read = spark.read.format("wal").load(folder)
    return read.select("type", "epoch", F.col("seq").cast("long").alias("seq"), "filenum", F.col("offset").cast("long").alias("offset"), F.col("payload").cast("string").alias("payload"))


@query(f"WITH {_LOG} SELECT seq, NULL AS crc FROM cmd WHERE FALSE UNION ALL SELECT 1, 3808858755")
def crc32c_vector(spark, sf_dir):
    """The checksum's published test value."""
    return spark.range(1, 2).select(F.col("id").alias("seq"), numbers.crc32c(F.lit("123456789").cast("binary")).alias("crc"))


@query(_log_sql("""seq, filenum, "offset", raw_resp AS payload""", """filenum > 1 OR (filenum = 1 AND "offset" > 20000)"""))
def wal_stream(spark, sf_dir):
    """Segments read as a stream from a position on."""
    folder = _scratch(spark, "wal-stream")
    rows = _log(spark, sf_dir).select(F.lit(7).alias("epoch"), "seq", "filenum", "offset", F.col("raw_resp").cast("binary").alias("payload"))
    wal.write(wal.range_by_position(rows, 4), f"{folder}/log", segment_bytes=1 << 18).count()
    spark.dataSource.register(wal.WalDataSource)
    stream = spark.readStream.format("wal").option("startingOffsets", "1:20000").option("ackPath", f"{folder}/ack.json").load(f"{folder}/log")
    feed.write_bronze(stream, f"{folder}/bronze", f"{folder}/checkpoint").awaitTermination()
    read = spark.read.schema(stream.schema).parquet(f"{folder}/bronze")
    return read.select(F.col("seq").cast("long").alias("seq"), "filenum", F.col("offset").cast("long").alias("offset"), F.col("payload").cast("string").alias("payload"))


_STREAMED = _log_sql("'feed.binlog' AS topic, 'db0:' || data_type || ':' || key AS key, argv[1] AS command, CAST(count(*) AS BIGINT) AS n", "(starts_with(key, 'user:1') AND data_type IN ('list', 'unknown')) OR data_type IN ('zset', 'unknown')") + " GROUP BY ALL"


@query(_STREAMED)
def stream_equals_batch(spark, sf_dir):
    """The events file read as a stream, filtered, rendered and written by micro-batch, then read back."""
    path = f"{sf_dir}/events.parquet"
    source = feed.read_log(spark, path, spark.read.parquet(path).schema)
    o = Options(source_id=SOURCE, filters=["key=user:1*;type=list", "type=zset"])
    rows = adapters.as_commands(source).withColumns({"logic_id": F.col("event_id"), "filenum": F.lit(0), "offset": F.col("event_id")})
    out = _scratch(spark, "stream")
    feed.write_batches(feed.event_stream(rows, o), f"{out}/events", f"{out}/checkpoint").awaitTermination()
    first = F.from_json("value", "args array<string>")["args"][0]
    return spark.read.parquet(f"{out}/events").groupBy("topic", "key", F.unbase64(first).cast("string").alias("command")).agg(F.count(F.lit(1)).alias("n"))


@query(_log_sql("seq, key, array_to_string(argv, '|') AS args, CAST(NULL AS VARCHAR) AS error"))
def log_decode(spark, sf_dir):
    """Binary records through header, parser and expiry rewrite."""
    raw = header.encode(F.col("exec_time"), F.col("term_id"), F.col("logic_id"), F.col("filenum"), F.col("offset"), F.col("raw_resp").cast("binary"))
    rows = feed.decoded(_log(spark, sf_dir).select("seq", raw.alias("raw")), "quarantine", NOW)
    return rows.select("seq", F.get("argv", 1).alias("key"), F.array_join("argv", "|").alias("args"), "error")


@query("SELECT CAST('src' AS VARCHAR) AS source_id, CAST(1 AS BIGINT) AS epoch, CAST(96 AS BIGINT) AS ack_seq")
def ack_stream(spark, sf_dir):
    """Completions read as a stream; the state keeps numbers that came before their turn."""
    path = f"{sf_dir}/events.parquet"
    rows = feed.read_log(spark, path, spark.read.parquet(path).schema)
    done = rows.select(F.lit("src").alias("source_id"), F.lit(1).cast("long").alias("epoch"), (F.col("event_id") + 1).cast("long").alias("seq")).where("seq % 97 <> 0")
    out = _scratch(spark, "ack")
    # the state store must be one that keeps maps
    old = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        keep = lambda batch, batch_id: batch.write.mode("overwrite").parquet(f"{out}/acks/batch={batch_id}")
        feed.acknowledged(done).writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{out}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", old)
    return spark.read.parquet(f"{out}/acks").groupBy("source_id", "epoch").agg(F.max("ack_seq").alias("ack_seq"))
