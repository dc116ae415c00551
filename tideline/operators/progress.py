"""Delivery progress in batch: contiguous prefixes, high-water marks, acknowledged ranges, log retention, counters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def contiguous_prefix(done: DataFrame, by: list[str] = (), seq: str = "seq", epoch: str | None = None) -> DataFrame:
    """by, ack_seq: the last number of the run 1, 2, 3... that is complete; 0 without a 1.

    The first number without a successor ends the run, which takes a self-join on the number, not a sort of everything.
    With ``epoch``, only rows of the newest epoch of each ``by`` count.
    """
    keys = list(by) or ["_all"]
    rows = done.where(F.col(seq) > 0)
    rows = rows if by else rows.withColumn("_all", F.lit(0))
    if epoch:
        newest = rows.groupBy(*keys).agg(F.max(epoch).alias("_newest"))
        rows = rows.join(newest, keys).where(F.col(epoch) == F.col("_newest"))
    rows = rows.select(*keys, F.col(seq).cast("long").alias("_seq")).distinct()
    ends = rows.join(rows.select(*keys, (F.col("_seq") - 1).alias("_seq")), [*keys, "_seq"], "left_anti")
    first = rows.groupBy(*keys).agg(F.min("_seq").alias("_first"))
    end = ends.groupBy(*keys).agg(F.min("_seq").alias("_end"))
    return first.join(end, keys).select(*by, F.when(F.col("_first") == 1, F.col("_end")).otherwise(F.lit(0)).alias("ack_seq"))


def high_water(done: DataFrame, by: list[str], position: list[str], seq: str = "seq") -> DataFrame:
    """by, the largest number and its position."""
    top = F.max(F.struct(seq, *position)).alias("_top")
    return done.groupBy(*by).agg(top).select(*by, *[F.col(f"_top.{c}").alias(c) for c in (seq, *position)])


def position(filenum: str = "filenum", offset: str = "offset") -> Column:
    """Compares by file, then by offset."""
    return F.struct(F.col(filenum).cast("long"), F.col(offset).cast("decimal(20,0)"))


def ack_range(durable: DataFrame, by: list[str], last_filenum: Column, last_offset: Column) -> DataFrame:
    """by, start and end positions to acknowledge: the first and last durable after what was sent last."""
    newer = durable.where(position() > F.struct(last_filenum.cast("long"), last_offset.cast("decimal(20,0)")))
    span = newer.groupBy(*by).agg(F.min(position()).alias("_a"), F.max(position()).alias("_b"))
    names = lambda s: [F.col(f"{s}.col1"), F.col(f"{s}.col2")]
    (a1, a2), (b1, b2) = names("_a"), names("_b")
    return span.select(*by, a1.alias("start_filenum"), a2.alias("start_offset"), b1.alias("end_filenum"), b2.alias("end_offset"))


def removable_segments(segments: DataFrame, ack_filenum: Column, ack_offset: Column, retain: int = 2, by: list[str] = ()) -> DataFrame:
    """The segments that may go: not among the last ``retain``, and the next one starts at or before what is acknowledged.

    segments: start_filenum, start_offset, segment. Starts of 0:0 aren't known, and nothing goes while the ack is 0:0.
    """
    retain = retain if retain > 0 else 2
    order = [F.col("start_filenum"), F.col("start_offset"), F.col("segment")]
    w = Window.partitionBy(*by).orderBy(*order) if by else Window.partitionBy(F.lit(0)).orderBy(*order)
    last = Window.partitionBy(*(by or [F.lit(0)])).orderBy(*[c.desc() for c in order])
    known = lambda f, o: (F.col(f) != 0) | (F.col(o) != 0)
    seen = segments.withColumns({"_next_f": F.lead("start_filenum").over(w), "_next_o": F.lead("start_offset").over(w), "_from_end": F.row_number().over(last)})
    acked = (ack_filenum > F.col("_next_f")) | ((ack_filenum == F.col("_next_f")) & (ack_offset >= F.col("_next_o")))
    keep = (F.col("_from_end") > retain) & known("start_filenum", "start_offset") & known("_next_f", "_next_o") & acked & ((ack_filenum != 0) | (ack_offset != 0))
    return seen.where(keep).drop("_next_f", "_next_o", "_from_end")


def counters(rows: DataFrame, parsed: Column, sent: Column) -> DataFrame:
    """recv, parsed, produced, filtered and errors in one pass."""
    n = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    return rows.agg(F.count(F.lit(1)).alias("recv"), n(parsed).alias("parsed"), n(parsed & sent).alias("produced"), n(parsed & ~sent).alias("filtered"), n(~parsed).alias("errors"))


def current_session(rows: DataFrame, session: Column) -> DataFrame:
    return rows.where(F.col("session_id") == session)


def snapshot_state(log: DataFrame, by: list[str], order: str) -> DataFrame:
    """by, the latest state of a snapshot and the position to go on from once it is done."""
    top = log.groupBy(*by).agg(F.max(F.struct(order, "state", "end_filenum", "end_offset")).alias("_s"))
    done = F.col("_s.state") == "done"
    return top.select(*by, F.col("_s.state").alias("state"), F.when(done, F.col("_s.end_filenum")).alias("ack_filenum"), F.when(done, F.col("_s.end_offset")).alias("ack_offset"))
