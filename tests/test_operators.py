"""Filters, planning, events, snapshots, progress, status texts."""

import json

import pytest
from pyspark.sql import functions as F

from tideline.functions import resp
from tideline.operators import events, filters, planner, progress, snapshot, status
from tideline.sources import checkpoint
from tideline.sources.options import Options, conflicts, from_args, load_lines

ROWS = [(k, t, a) for k in ("dev:k", "prod:k", "tmp:1", "other:k", "ab", "", None) for t in ("string", "list", "set", "unknown", "") for a in ("lpush", "RPUSH", "sadd", "SADD", "unknown", "")]


@pytest.fixture(scope="module")
def rows(spark):
    return spark.createDataFrame(ROWS, "key string, type string, action string")


def passing(rows, groups, excludes=(), pruned=False):
    f, warnings = filters.build(list(groups), list(excludes))
    cols = F.col("key"), F.col("type"), F.col("action")
    keep = planner.pruned_predicate(f, F.coalesce(cols[0], F.lit("")), *cols[1:], snapshot=False) if pruned else filters.predicate(f, *cols)
    return {tuple(r) for r in rows.where(keep).collect()}, f, warnings


def test_exclude_only(rows):
    got, _, _ = passing(rows, [], ["tmp:*"])
    assert got == {r for r in ROWS if r[0] != "tmp:1"}


def test_groups(rows):
    got, _, _ = passing(rows, ["key=dev:*;type=list;action=lpush", "key=prod:*;type=set;action=sadd"])
    assert ("dev:k", "list", "lpush") in got and ("prod:k", "set", "SADD") in got
    assert ("dev:k", "list", "RPUSH") not in got and ("other:k", "set", "sadd") not in got
    assert ("dev:k", "unknown", "lpush") in got and ("dev:k", "list", "") in got and ("dev:k", "list", "unknown") not in got


@pytest.mark.parametrize("groups", [["key=*"], ["foo=bar"], ["type="], [";;"], ["key=a**"], ["key=(?=a)"], [r"key=(a)\1"], ["key=a++"]])
def test_what_passes_all(rows, groups):
    got, f, warnings = passing(rows, groups)
    assert got == set(ROWS) and (f is None) == (groups != ["key=*"]) and (f is not None or warnings)


def test_edges(rows):
    assert passing(rows, ["key=a*b"])[0] == {r for r in ROWS if "b" in (r[0] or "")}  # an expression, not a glob
    assert passing(rows, ["key=a**;type=set"])[0] == {r for r in ROWS if r[1] in ("set", "unknown", "")}
    assert passing(rows, ["KEY = dev:k , prod:k "])[0] == {r for r in ROWS if r[0] in ("dev:k", "prod:k")}
    assert passing(rows, ["key=a{1,2}"])[0] == set()  # a comma splits it; what is left are plain braces
    assert passing(rows, [r"key=^[[:lower:]]+:\pL$,(?P<n>b)$"])[0] == {r for r in ROWS if r[0] in ("dev:k", "prod:k", "other:k", "ab")}


@pytest.mark.parametrize("groups", [["key=dev:*"], ["key=dev:*,dev:k;type=list"], ["key=d*;type=set", "key=dev:k;action=sadd"], ["key=.*k$;type=list"], ["key=*,dev:*"], ["action=lpush"]])
def test_pruning_changes_nothing(rows, groups):
    assert passing(rows, groups)[0] == passing(rows, groups, pruned=True)[0]


def test_planning():
    build = lambda *g: filters.build(list(g), [])[0]
    assert planner.needed_types(build("type=list;key=a*", "action=sadd")) == {"list", "set"}
    assert planner.needed_types(build("action=expire")) == set(planner.TYPES) == planner.needed_types(build("key=a")) == planner.needed_types(None)
    assert planner.needed_types(build("type=odd")) == set(planner.TYPES)
    assert planner.needed_prefix(build("key=dev:1*,dev:2")) == "dev:" and planner.needed_prefix(build("key=dev:*,*")) == ""
    assert planner.needed_prefix(build("key=dev:*", "type=set")) == "" == planner.needed_prefix(build("key=dev:.*x"))
    specs, _ = planner.reader_specs(build("key=dev:*;type=list"), "type")
    assert specs == [planner.ReaderSpec(("list",), "dev:*")]
    specs, warnings = planner.reader_specs(None, "odd", ["lists", "auto", "?"], ["a", " ", "b*c", "auto"])
    assert specs == [planner.ReaderSpec(("list",), "a*"), planner.ReaderSpec(("list",), "b*c")] and warnings
    assert len(planner.reader_specs(None, "type")[0]) == 6


def test_pushdown(spark, tmp_path):
    df = spark.createDataFrame([(f"dev:{i}", t) for i in range(5) for t in ("list", "set")], "key string, data_type string")
    df.write.partitionBy("data_type").parquet(str(tmp_path / "k"))
    f, _ = filters.build(["key=dev:1.*,dev:2*;type=list"], [])
    read = spark.read.parquet(str(tmp_path / "k"))
    plan = read.where(planner.pruned_predicate(f, F.col("key"), F.col("data_type"), F.lit("rpush")))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "data_type" in plan.split("PartitionFilters: [")[1].split("]")[0]
    f, _ = filters.build(["key=dev:1*"], [])
    plan = read.where(planner.pruned_predicate(f, F.col("key"), F.col("data_type"), F.lit("rpush")))._jdf.queryExecution().executedPlan().toString()
    assert "StringStartsWith(key,dev:1)" in plan


GOLDEN = '{"event_type":"binlog","op":"set","data_type":"string","db":"db0","slot":0,"key":"k","args":["U0VU","aw==","dg=="],"args_encoding":"base64","raw_resp":"KjMNCiQzDQpTRVQNCiQxDQprDQokMQ0Kdg0K","raw_resp_encoding":"base64","ts_ms":1700000000000,"event_id":"7:12:34567:8899","source_id":"10.0.0.1:9221","binlog":{"filenum":12,"offset":34567,"logic_id":8899,"server_id":0,"term_id":7},"source":{"host":"10.0.0.1","port":9221}}'


def one_command(spark, argv):
    df = spark.createDataFrame([(argv, 1700000000, 7, 8899, 12, 34567)], "argv array<string>, exec_time long, term_id long, logic_id long, filenum long, offset long")
    return df.withColumn("raw_resp", resp.serialize(F.col("argv")))


def test_golden_event(spark):
    row = events.records(events.binlog_events(one_command(spark, ["SET", "k", "v"]), Options(source_id="10.0.0.1:9221"))).first()
    assert tuple(row) == ("feed.binlog", "db0:string:k", GOLDEN)


def test_event_variants(spark):
    o = Options(source_id="primary", args_encoding="none", include_raw_resp=False, kafka_stream_mode="single")
    row = events.records(events.binlog_events(one_command(spark, ["DEL", 'a"\n']), o)).first()
    doc = json.loads(row["value"])
    assert row["topic"] == "feed.single" and doc["args"] == ["DEL", 'a"\n'] and doc["key"] == 'a"\n' and "raw_resp" not in doc and doc["source"] == {"host": "primary"}
    empty = json.loads(events.records(events.binlog_events(one_command(spark, []), o)).first()["value"])
    assert "op" not in empty and empty["key"] == "" and empty["args"] == [] and empty["data_type"] == "unknown"
    assert events.source_object("::1") == '{"host":"::1"}' and events.source_object("h:1") == '{"host":"h","port":1}'


def chunks(df):
    return [(r["ord"], r["argv"]) for r in df.orderBy("key", "ord").collect()]


@pytest.mark.parametrize("n", [0, 1, 3, 4, 5, 256])
def test_list_chunks(spark, n):
    df = spark.createDataFrame([("k", [str(i) for i in range(n)], 9)], "key string, items array<string>, ttl long")
    got = chunks(snapshot.lists(df, 4))
    assert [a for o, a in got if o != snapshot.LAST] == [["RPUSH", "k", *map(str, range(i, min(n, i + 4)))] for i in range(0, n, 4)]
    assert [a for o, a in got if o == snapshot.LAST] == ([["EXPIRE", "k", "9"]] if n else [])
    tail = chunks(snapshot.lists(df, 4, tail=3))
    assert [x for _, a in tail if a[0] == "RPUSH" for x in a[2:]] == [str(i) for i in range(max(0, n - 3), n)]


def test_other_types(spark):
    for ttl, more in ((-2, []), (-1, []), (0, []), (1, ["EX", "1"])):
        df = spark.createDataFrame([("k", "v", ttl)], "key string, value string, ttl long")
        assert chunks(snapshot.strings(df)) == [(0, ["SET", "k", "v", *more])]
    h = spark.createDataFrame([("k", [("b", "2"), ("a", "1")], 0)], "key string, items array<struct<field:string,value:string>>, ttl long")
    assert chunks(snapshot.hashes(h, 1)) == [(0, ["HMSET", "k", "a", "1"]), (1, ["HMSET", "k", "b", "2"])]
    s = spark.createDataFrame([("k", ["b", "a"], 5)], "key string, items array<string>, ttl long")
    assert chunks(snapshot.sets(s)) == [(0, ["SADD", "k", "a", "b"]), (snapshot.LAST, ["EXPIRE", "k", "5"])]
    z = spark.createDataFrame([("k", [(2.0, "a"), (1.5, "c"), (1.5, "b")], 0)], "key string, items array<struct<score:double,member:string>>, ttl long")
    assert chunks(snapshot.zsets(z)) == [(0, ["ZADD", "k", "1.500000", "b", "1.500000", "c", "2.000000", "a"])]


def test_contiguous_prefix(spark):
    def ack(seqs):
        return [r["ack_seq"] for r in progress.contiguous_prefix(spark.createDataFrame([(s,) for s in seqs], "seq long")).collect()]

    assert ack([1, 3, 2]) == [3] and ack([1]) == [1] and ack([1, 3]) == [1] and ack([2, 3]) == [0] and ack([1, 1, 2, 5, 0]) == [2] and ack([]) == []
    df = spark.createDataFrame([("a", 1, 1), ("a", 1, 2), ("a", 2, 1), ("b", 1, 1), ("b", 1, 2)], "s string, e int, seq long")
    assert {(r["s"], r["ack_seq"]) for r in progress.contiguous_prefix(df, ["s"], epoch="e").collect()} == {("a", 1), ("b", 2)}


def test_segments(spark):
    df = spark.createDataFrame([(0, 0, 0), (1, 0, 1), (1, 500, 2), (2, 0, 3), (3, 0, 4)], "start_filenum long, start_offset long, segment long")
    gone = lambda f, o, retain=2: [r["segment"] for r in progress.removable_segments(df, F.lit(f), F.lit(o), retain).orderBy("segment").collect()]
    assert gone(0, 0) == [] and gone(1, 499) == [] and gone(1, 500) == [1] and gone(9, 0) == [1, 2] and gone(9, 0, 0) == [1, 2] and gone(9, 0, 5) == [] and gone(9, 0, 1) == [1, 2, 3]


STATUS = [
    ("# Replication\r\nrole:master\r\nbinlog_offset:7 12345\r\n", 7, 12345, None, None), ("some=thing binlog_offset=12,34567 other\r\n", 12, 34567, None, None),
    ("binlog_file_num: 9\r\nbinlog_offset: 999\r\n", 9, 999, None, None), ("binlog_offset: 999\nbinlog_file: 9", 9, 999, None, None), ("lag=(3,9,4)", None, None, 9, None),
    ("master_lag:5", None, None, 5, None), ("lag=(9)\nmaster_lag:123", None, None, 123, None), ("role:master", None, None, None, "no position or lag"), (None, None, None, None, "no position or lag"),
    ("binlog_filenum:4294967296\nbinlog_offset:1", None, None, None, "file number out of range"), ("binlog_offset:1 2\nbinlog_offset:3 4", 3, 4, None, None), ("  # binlog_offset:1 2\nbinlog_offset: 8", 0, 8, None, None),
]


def test_status(spark):
    df = spark.createDataFrame([(i, s[0]) for i, s in enumerate(STATUS)], "i int, t string")
    got = [(r["filenum"], None if r["offset"] is None else int(r["offset"]), r["master_lag"], r["error"]) for r in status.parse(df, "t").orderBy("i").collect()]
    assert got == [s[1:] for s in STATUS]


def test_options(tmp_path):
    o = load_lines(["# comment", "master_ip=10.0.0.1", "master_port=9221", "dump_path=./dump", "filter=key=dev:*;type=list;action=lpush", "exclude=tmp:*", "sync_protocol=legacy", "unknown_key=1", "; x", "args_encoding=RAW", "include_raw_resp=maybe", "snapshot_reader_types=list, ,set"])
    assert o.extra["dump_path"] == "./dump/" and o.filters == ["key=dev:*;type=list;action=lpush"] and o.excludes == ["tmp:*"] and o.args_encoding == "none" and o.snapshot_reader_types == ["list", "set"]
    assert len(o.warnings) == 3 and o.include_raw_resp
    spec = tmp_path / "f"
    spec.write_text("# groups\nkey=a*\n\nkey=b\n")
    assert from_args(["-F", str(spec), "-X", "c", "-set", "db_name=db3"]).filters == ["key=a*", "key=b"]
    assert conflicts(Options()) == [] and conflicts(Options(start_from_master=True)) and conflicts(Options(filenum=1)) and not conflicts(Options(filenum=1, offset=2, initial_full_sync=False))
    with pytest.raises(SystemExit) as e:
        from_args(["-set", "start_from_master=yes"])
    assert e.value.code == 2


def test_checkpoint(spark, tmp_path):
    path = str(tmp_path / "c.json")
    assert checkpoint.load(path) is None
    doc = {"version": 1, "source_id": "s", "epoch": 7, "ack_cp": {"seq": 12, "filenum": 3, "offset": 456}}
    checkpoint.save(path, doc)
    assert checkpoint.load(path, "s") == doc
    for bad in ({**doc, "version": 2}, {"version": 1}):
        with pytest.raises(ValueError):
            checkpoint.check(bad)
    with pytest.raises(ValueError):
        checkpoint.load(path, "t")
    rows = spark.createDataFrame([(json.dumps(d),) for d in (doc, {**doc, "version": 2}, {"version": 1})] + [("{",)], "t string").select(checkpoint.decode(F.col("t"), "s").alias("d")).collect()
    assert [r["d"]["error"] for r in rows] == [None, "unsupported version", "no source_id", "not a checkpoint"] and int(rows[0]["d"]["checkpoint"]["ack_cp"]["offset"]) == 456


def test_dialect(spark):
    """Expressions as a linear-time engine reads them, against one."""
    import duckdb

    keys = ["user:15", "user:15\n", "a\rb", "a\u2028b", "a\nb", "dev:ABC1", "dev:abc", "x a.b y", "xa+b", "t\x0bu", "t u", "ÉCOLE", "école", "a]b", "a{b", "k{2}", "1&2", "[x]", "n"]
    patterns = [r"user:[0-9]*5$", "a.b", r"dev:(?i)abc.*", r"\Qa.b\E", r"\Qa+b", r"t\su", r"t\Su", r"t[\sx]u", r"t[^\s]u", "(?i)école$", "a[]]b", "a{b", "k[{]2}", r"1[&]2", "1[0&&9]2", "[[]x]", "(?m)^a$", "(?m:^b$)|user:15$", "(?U)a.*b", "(?s)a.b", "(?s:a).b", "[[:alpha:]]{4,}:", "[^[:ascii:]]", r"\pL{5}", "(?P<n>dev):", r"(a|n)\z", "^$"]
    frame = spark.createDataFrame([(k,) for k in keys], "key string")
    got = frame.select("key", *[filters.parse_key(p).column(F.col("key")).alias(f"m{i}") for i, p in enumerate(patterns)]).collect()
    con = duckdb.connect()
    for i, p in enumerate(patterns):
        want = {k: con.execute("SELECT regexp_matches(?, ?)", [k, p]).fetchone()[0] for k in keys}
        assert {r["key"]: r[f"m{i}"] for r in got} == want, p
    for bad in ("(?=a)b", r"(a)\1", "a(b", "(?x)a", "a++"):
        with pytest.raises(ValueError):
            filters.parse_key(bad)
