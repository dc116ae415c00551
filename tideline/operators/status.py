"""Replication status texts: position and lag out of free-form lines, natively and a row at a time.

Recognised: ``binlog_offset=`` anywhere in a line, a list after ``lag=(``, and lines of ``name:value``. Later lines win.
One number alone is an offset whose file comes from a file line. Lines that begin with # are comments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

U32 = 2**32 - 1


def _numbers(text: Column) -> Column:
    return F.transform(F.regexp_extract_all(text, F.lit(r"(\d+)"), F.lit(1)), lambda x: x.try_cast("decimal(20,0)"))


def _after(line: Column, mark: str) -> Column:
    """What follows a mark, letter case aside; null without it."""
    at = F.instr(F.lower(line), mark)
    return F.when(at > 0, F.substring(line, at + len(mark), F.length(line)))


def parse(df: DataFrame, text: str) -> DataFrame:
    """df with filenum, offset, master_lag and error (null when a position or a lag was found)."""
    lines = F.filter(F.transform(F.split(F.coalesce(F.col(text), F.lit("")), r"\r?\n"), lambda x: F.trim(x)), lambda x: (x != "") & ~x.startswith("#"))

    def facts(line: Column) -> Column:
        colon = F.instr(line, ":")
        name = F.when(colon > 0, F.lower(F.trim(F.substring(line, F.lit(1), colon - 1))))
        value = F.substring(line, colon + 1, F.length(line))
        marked = _numbers(F.coalesce(F.when(name == "binlog_offset", value), _after(line, "binlog_offset="), F.lit("")))
        file = _numbers(F.coalesce(F.when(name.isin("binlog_file_num", "binlog_filenum", "binlog_file"), value), F.lit("")))
        lags = _numbers(F.coalesce(_after(line, "lag=("), F.lit("")))
        own = _numbers(F.coalesce(F.when(name == "master_lag", value), F.lit("")))
        return F.struct(marked.alias("marked"), F.get(file, 0).alias("file"), F.array_max(lags).alias("lags"), F.get(own, 0).alias("lag"))

    big = "decimal(20,0)"
    start = F.struct(*[F.lit(None).cast(big).alias(c) for c in ("pos_file", "offset", "file", "lag")], F.lit(False).alias("bad"))

    def fold(s: Column, f: Column) -> Column:
        two, one = F.size(f["marked"]) >= 2, F.size(f["marked"]) == 1
        file = F.coalesce(f["file"], s["file"])
        at = F.when(two, F.get(f["marked"], 0)).when(one, F.coalesce(s["file"], s["pos_file"])).otherwise(s["pos_file"])
        offset = F.when(two, F.get(f["marked"], 1)).when(one, F.get(f["marked"], 0)).otherwise(s["offset"])
        at = F.when(f["file"].isNotNull() & offset.isNotNull() & (F.coalesce(at, F.lit(0).cast(big)) == 0), f["file"]).otherwise(at)
        lag = F.coalesce(f["lag"], F.greatest(s["lag"], f["lags"]))
        bad = s["bad"] | F.coalesce(f["file"] > U32, F.lit(False)) | (two & F.coalesce(F.get(f["marked"], 0) > U32, F.lit(False)))
        return F.struct(at.cast(big).alias("pos_file"), offset.cast(big).alias("offset"), file.cast(big).alias("file"), lag.cast(big).alias("lag"), bad.alias("bad"))

    held = df.withColumn("_facts", F.transform(lines, facts)).withColumn("_s", F.aggregate("_facts", start, fold))
    s = F.col("_s")
    error = F.when(s["bad"], F.lit("file number out of range")).when(s["offset"].isNull() & s["lag"].isNull(), F.lit("no position or lag"))
    ok = lambda c: F.when(error.isNull(), c)
    out = held.withColumns({"filenum": ok(F.when(s["offset"].isNotNull(), F.coalesce(s["pos_file"], F.lit(0).cast(big)))).cast("long"), "offset": ok(s["offset"]), "master_lag": ok(s["lag"]).cast("long"), "error": error})
    return out.drop("_facts", "_s")
