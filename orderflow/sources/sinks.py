"""Sinks: dated Parquet partitions and JSON Lines landing (K1-K3)."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, Observation, functions as F

# Microsecond timestamps in JSON (the default writer keeps milliseconds).
JSON_TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def partition_path(root: str, table: str, load_date: str, col: str = "data_date") -> str:
    return f"{root.rstrip('/')}/{table}/{col}={load_date}"


# --- K1 -------------------------------------------------------------------
def write_partition(df: DataFrame, root: str, table: str, load_date: str, col: str = "data_date") -> str:
    """Overwrite exactly one ``data_date=`` folder with Parquet.  The static
    path makes a rerun idempotent and lets an empty day clear the folder
    (dynamic partition overwrite would leave old rows behind)."""
    path = partition_path(root, table, load_date, col)
    df.write.mode("overwrite").parquet(path)
    return path


def write_days(df: DataFrame, root: str, table: str, ts_col: str, start: _dt.datetime, end: _dt.datetime,
               col: str = "data_date") -> list[str]:
    """Overwrite the ``data_date=`` folders of the days in [start, end), each
    with the rows of its own day, in one write (dynamic partition overwrite).
    Other days stay as they are; a day without rows is cleared.  The days that
    had rows are observed by the write itself, so ``df`` is read once."""
    path = f"{root.rstrip('/')}/{table}"
    written: set[str] = set()
    if not df.isEmpty():                   # a one-row probe: an empty plan may lose its observation
        seen = Observation()
        day = F.to_date(ts_col)
        (df.withColumn(col, day).observe(seen, F.collect_set(day.cast("string")).alias("days"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(col).parquet(path))
        written = set(seen.get["days"])
    labels = [(start + _dt.timedelta(days=i)).date().isoformat() for i in range((end - start).days)]
    for label in labels:
        if label not in written:
            write_partition(df.limit(0), root, table, label, col)
    return [partition_path(root, table, label, col) for label in labels]


def land_bucketed(df: DataFrame, table: str, path: str, keys: list[str], buckets: int,
                  mode: str = "append") -> DataFrame:
    """Land rows in a catalogue table bucketed and sorted by key: what is
    later grouped or picked by the key (C4, W7) reads it without a shuffle.
    The rows are dealt to the buckets before the write, so a landing adds one
    file a bucket.  The number of buckets is fixed for the life of a table; it
    bounds the rows of a task, so choose it for the table's final size."""
    (df.repartition(buckets, *keys).write.mode(mode).format("parquet").option("path", path)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(table))
    return df.sparkSession.table(table)


# --- K2 -------------------------------------------------------------------
def batch_stamp(now: _dt.datetime | None = None) -> str:
    now = now or _dt.datetime.now(_dt.timezone.utc)
    return now.strftime("%Y%m%dT%H%M%S")


def land_jsonl(df: DataFrame, root: str, dt: str, batch: str | None = None) -> str:
    """One JSON object per line under ``dt={run date}/batch_{UTC stamp}``;
    nulls are written (not dropped), non-ASCII kept, timestamps to the
    microsecond.  Each batch is a new folder, so landing only appends."""
    path = f"{root.rstrip('/')}/dt={dt}/batch_{batch or batch_stamp()}"
    (df.write.mode("errorifexists")
     .option("ignoreNullFields", "false")
     .option("timestampFormat", JSON_TS_FORMAT)
     .option("timestampNTZFormat", JSON_TS_FORMAT)
     .json(path))
    return path


# --- K3 -------------------------------------------------------------------
def skip_if_empty(df: DataFrame) -> bool:
    """True when there is nothing to land (a one-row probe, not a count)."""
    return df.isEmpty()
