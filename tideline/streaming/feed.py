"""The feed as a stream: log records in, filtered events out, with progress kept as state.

A file or any other streaming source replaces the replication socket. Each micro-batch decodes, filters and renders;
the checkpoint folder of the query replaces the write-ahead log and the acknowledged position, and a batch that
fails runs again as a whole. Rows that can't be decoded stop the query, or are set aside, as ``on_error`` says.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StructType

from ..functions import commands, header, resp
from ..operators import events, filters, planner
from ..sources.options import Options


def read_log(spark: SparkSession, path: str, schema: StructType | str, max_files: int | None = None) -> DataFrame:
    """path: a folder or a single file; it is given as a pattern, since the source takes a plain path for a folder."""
    reader = spark.readStream.schema(schema)
    path = path.rstrip("/")
    return (reader.option("maxFilesPerTrigger", max_files) if max_files else reader).parquet(f"{path[:-1]}[{path[-1]}]")


def decoded(records: DataFrame, on_error: str = "fail", now: int | None = None) -> DataFrame:
    """raw log records (``raw`` binary) as commands: header fields, argv, raw_resp, and error when ``on_error`` is quarantine."""
    head = records.withColumn("_h", header.decode(F.col("raw"))).withColumn("_p", resp.parse(F.col("_h.content")))
    error = F.coalesce(F.col("_h.error"), F.col("_p.error"))
    argv = F.transform("_p.argv", lambda a: a.cast("string"))
    out = head.select(*records.columns, *[F.col(f"_h.{n}").alias(n) for n in ("exec_time", "term_id", "logic_id", "filenum", "offset")], argv.alias("argv"), F.col("_h.content").cast("string").alias("raw_resp"), error.alias("error"))
    clock = F.lit(now) if now is not None else F.unix_timestamp(F.current_timestamp())
    out = out.withColumn("raw_resp", commands.rewrite_expiry(F.col("argv"), F.col("raw_resp"), clock))
    if on_error == "fail":
        return out.withColumn("argv", F.when(F.col("error").isNotNull(), F.raise_error(F.concat(F.lit("bad log record: "), F.col("error"))).cast("array<string>")).otherwise(F.col("argv"))).drop("error")
    return out


def event_stream(log: DataFrame, o: Options) -> DataFrame:
    """Commands (argv, raw_resp and header fields) filtered and rendered; works on batches and streams alike."""
    f, _ = filters.build(o.filters, o.excludes)
    command = F.get("argv", 0)
    keep = planner.pruned_predicate(f, F.coalesce(F.get("argv", 1), F.lit("")), commands.data_type(command), F.coalesce(command, F.lit("")), snapshot=False)
    return events.binlog_events(log.where(keep), o)


def write_batches(stream: DataFrame, path: str, checkpoint: str, partitions: int = 8, once: bool = True):
    """Append topic, key, value (and seq when there) by micro-batch, in key order; a batch that runs again overwrites its own folder."""
    def put(batch: DataFrame, batch_id: int) -> None:
        order = "seq" if "seq" in batch.columns else "offset"
        rows = events.in_key_order(batch, partitions, order)
        rows.select(*[c for c in ("seq",) if c in batch.columns], "event.topic", F.col("event.event_key").alias("key"), "event.value").write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    writer = stream.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def write_bronze(log: DataFrame, path: str, checkpoint: str, once: bool = True):
    """Append the raw log records themselves, before any decoding, as the durable copy that everything else can be rebuilt from."""
    writer = log.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()


def without_repeats(events_: DataFrame, time: str, delay: str = "10 minutes") -> DataFrame:
    """Log events once by event_id, within a watermark. Snapshot events share ids, so they must not come here."""
    return events_.withWatermark(time, delay).dropDuplicatesWithinWatermark(["event_id"])


def write_kafka(stream: DataFrame, brokers: str, checkpoint: str, idempotent: bool = True, max_bytes: int = 1_000_000):
    """The Kafka sink: topic, key and value columns; needs the connector's jar on the cluster."""
    rows = events.records(stream)
    return rows.writeStream.format("kafka").options(**kafka_options(brokers, idempotent, max_bytes)).option("checkpointLocation", checkpoint).start()


def kafka_options(brokers: str, idempotent: bool = True, max_bytes: int = 1_000_000) -> dict[str, str]:
    return {"kafka.bootstrap.servers": brokers, "kafka.acks": "all", "kafka.enable.idempotence": str(idempotent).lower(), "kafka.max.in.flight.requests.per.connection": "1", "kafka.max.request.size": str(max_bytes)}


def with_runs(starts: np.ndarray, ends: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted runs (first, last) of whole numbers, and more numbers, as sorted runs that neither meet nor overlap."""
    first, last = np.concatenate([starts, numbers]), np.concatenate([ends, numbers])
    order = np.argsort(first, kind="stable")
    first, reach = first[order], np.maximum.accumulate(last[order])
    new = np.flatnonzero(np.concatenate([[True], first[1:] > reach[:-1] + 1])) if len(first) else np.empty(0, dtype=np.int64)
    return first[new], reach[np.concatenate([new[1:], [len(first)]]).astype(np.int64)[: len(new)] - 1]


class AckTracker(StatefulProcessor):
    """Per (source, epoch): the next number expected, and those that arrived before their turn, as runs: a gap costs one, however many wait behind it."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.next = handle.getValueState("next", "seq long")
        self.waiting = handle.getValueState("waiting", "starts array<bigint>, ends array<bigint>")

    def handleInputRows(self, key, rows, timers):
        due = self.next.get()[0] if self.next.exists() else 1
        starts, ends = (np.array(x, dtype=np.int64) for x in (self.waiting.get() if self.waiting.exists() else ([], [])))
        for frame in rows:
            seq = np.unique(frame["seq"].to_numpy(dtype=np.int64))
            starts, ends = with_runs(starts, ends, seq[seq >= due])
        if len(starts) and starts[0] == due:
            due, starts, ends = int(ends[0]) + 1, starts[1:], ends[1:]
        self.next.update((due,))
        self.waiting.update((starts.tolist(), ends.tolist()))
        yield pd.DataFrame({"source_id": [key[0]], "epoch": [key[1]], "ack_seq": [due - 1], "pending": [int((ends - starts + 1).sum())]})

    def close(self) -> None:
        pass


def acknowledged(completions: DataFrame) -> DataFrame:
    """Streaming contiguous prefix of source_id, epoch, seq rows; ``pending`` growing without end tells of a gap that never fills."""
    return completions.groupBy("source_id", "epoch").transformWithStateInPandas(AckTracker(), "source_id string, epoch long, ack_seq long, pending long", "Update", "None")
