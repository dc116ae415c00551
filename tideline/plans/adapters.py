"""The driver's tables as commands of a log and as a keyspace."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import commands, resp

RECORDS_PER_FILE, RECORD_BYTES = 1000, 100


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def argv_of_event() -> Column:
    """The command that an event stands for; letter case and an unlisted command on purpose."""
    k, text = F.concat(F.lit("user:"), F.col("user_id").cast("string")), F.col("event_id").cast("string")
    score = commands.score_text(F.coalesce("value", F.lit(0.0)))
    kinds = {"signup": [F.lit("SET"), k, F.col("event_type")], "view": [F.lit("LPUSH"), k, text], "click": [F.lit("hset"), k, F.lit("last"), text], "purchase": [F.lit("ZADD"), k, score, text], "error": [F.lit("del"), k]}
    out = F
    for name, argv in kinds.items():
        out = out.when(F.col("event_type") == name, F.array(*argv))
    return out


def as_commands(events: DataFrame) -> DataFrame:
    """event_id, argv, raw_resp and times of events; no order yet, so it works on streams too."""
    seconds = F.expr("timestampdiff(SECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    made = events.select("event_id", "ts", seconds.alias("exec_time"), F.lit(1).alias("term_id"), argv_of_event().alias("argv"))
    return made.withColumn("raw_resp", resp.serialize(F.col("argv")))


def log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The command log: seq by time, then position. Numbers run inside each day and are offset by the days before, so no task sorts everything."""
    rows = as_commands(load(spark, sf_dir, "events")).withColumn("day", F.to_date("ts"))
    before = Window.partitionBy(F.lit(0)).orderBy("day").rowsBetween(Window.unboundedPreceding, -1)  # a row a day
    days = rows.groupBy("day").agg(F.count(F.lit(1)).alias("n")).select("day", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))
    own = F.row_number().over(Window.partitionBy("day").orderBy("ts", "event_id"))
    seq = (F.col("before") + F.col("own")).cast("long")
    numbered = rows.withColumn("own", own).join(days, "day").withColumn("seq", seq)
    place = F.col("seq") - 1
    return numbered.select(
        "seq", "event_id", "exec_time", "term_id", "argv", "raw_resp", F.col("seq").alias("logic_id"),
        F.floor(place / RECORDS_PER_FILE).cast("long").alias("filenum"), (place % RECORDS_PER_FILE * RECORD_BYTES).cast("long").alias("offset"),
    )


def _key(prefix: str, column: str) -> Column:
    return F.concat(F.lit(prefix), F.col(column).cast("string")).alias("key")


def _ttl(column: str, every: int, ttl: int) -> Column:
    return F.when(F.col(column) % every == 0, F.lit(ttl)).otherwise(F.lit(-1)).cast("long").alias("ttl")


def strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "customer").select(_key("cust:", "c_custkey"), F.col("c_name").alias("value"), _ttl("c_custkey", 10, 3600))


def lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey")))
    rows = load(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(ordered.alias("l"))
    return rows.select(_key("lines:", "l_orderkey"), F.transform("l", lambda x: x["l_partkey"].cast("string")).alias("items"), _ttl("l_orderkey", 7, 60))


def hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    pair = lambda n, c: F.struct(F.lit(n).alias("field"), F.col(c).cast("string").alias("value"))
    items = F.array(pair("status", "o_orderstatus"), pair("priority", "o_orderpriority"), pair("cust", "o_custkey"))
    return load(spark, sf_dir, "orders").select(_key("order:", "o_orderkey"), items.alias("items"), _ttl("o_orderkey", 7, 60))


def sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = load(spark, sf_dir, "lineitem").groupBy("l_suppkey").agg(F.collect_set(F.col("l_partkey").cast("string")).alias("items"))
    return rows.select(_key("supp:", "l_suppkey"), "items", _ttl("l_suppkey", 7, 60))


def zsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    item = F.struct(F.col("o_totalprice").alias("score"), F.col("o_orderkey").cast("string").alias("member"))
    rows = load(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list(item).alias("items"))
    return rows.select(_key("spend:", "o_custkey"), "items", _ttl("o_custkey", 7, 60))
