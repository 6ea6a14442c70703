"""Structured Streaming forms of the landing and change jobs (ST1-ST3).

The stored resume point of the batch pull becomes the streaming source's
own file log + checkpoint; Spark's watermark here is a lateness bound for
the dedupe state, a separate setting.
"""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from orderflow.operators.changes import current_state, dedupe, upsert
from orderflow.schemas import TRACKING_EVENT
from orderflow.sources import versions
from orderflow.sources.state import event_key, load_watermark, save_watermark

_NTZ = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"


# --- ST1 ------------------------------------------------------------------
def tracking_stream(spark: SparkSession, landing: str, schema: T.StructType = TRACKING_EVENT,
                    ts_col: str = "timestamp", key: str = "event_id",
                    lateness: str = "7 days", max_files: int | None = None) -> DataFrame:
    """Landed JSON Lines as a stream, each event once within the lateness
    bound (``dropDuplicatesWithinWatermark`` keeps bounded state).  Rows
    behind the watermark do not pass: ``reconcile`` finds them."""
    r = spark.readStream.schema(schema).option("timestampNTZFormat", _NTZ)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    s = r.json(landing)
    # withWatermark needs a zoned timestamp; the session zone is UTC
    s = s.withColumn("_event_time", F.col(ts_col).cast("timestamp"))
    return (s.withWatermark("_event_time", lateness)
            .dropDuplicatesWithinWatermark(event_key(s, key))
            .drop("_event_time"))


def stream_tracking(spark: SparkSession, landing: str, out: str, checkpoint: str,
                    schema: T.StructType = TRACKING_EVENT, lateness: str = "7 days",
                    key: str = "event_id", ts_col: str = "timestamp",
                    max_files: int | None = None, late_out: str | None = None):
    """ST1: new landed events, once each, appended to Parquet by event day.
    Runs as an ``availableNow`` batch: everything landed so far, then stop; a
    rerun picks up only new files, and the checkpoint makes the sink
    exactly-once.  ``max_files`` bounds each micro-batch, so a large backlog is
    processed in several bounded batches rather than one.

    No event is lost: those behind the watermark are appended to the late
    sink (``<out>_late`` by default), so the two sinks together
    (``read_tracking``) hold every landed event once."""
    late_out = late_out or late_sink(out)
    day = F.to_date(ts_col)
    q = (tracking_stream(spark, landing, schema, ts_col, key, lateness, max_files)
         .withColumn(DAY, day).writeStream.format("parquet").option("path", out).partitionBy(DAY)
         .option("checkpointLocation", checkpoint)
         .outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    reconcile(spark, landing, out, late_out, schema, key, ts_col)
    return q


DAY = "event_day"


def late_sink(out: str) -> str:
    return f"{out.rstrip('/')}_late"


def _sink(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A sink of ``stream_tracking``, ``event_day`` as its partition."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])).parquet(path)


def read_tracking(spark: SparkSession, out: str, schema: T.StructType = TRACKING_EVENT,
                  late_out: str | None = None) -> DataFrame:
    """Every landed event once: both sinks of ``stream_tracking``."""
    cols = schema.fieldNames()
    return (_sink(spark, out, schema).select(*cols)
            .unionByName(_sink(spark, late_out or late_sink(out), schema).select(*cols)))


def reconcile(spark: SparkSession, landing: str, out: str, late_out: str, schema: T.StructType,
              key: str = "event_id", ts_col: str = "timestamp") -> None:
    """Append what the watermark held back to the late sink (ST3 on the
    stream's own sinks).  Only files landed since the last reconciliation are
    read, and of the sinks only the event days that these files hold: a run that
    adds a day of events reads a day.  The largest file time is kept beside the
    sink (it is read again with a second of overlap, which the sinks then
    answer for)."""
    spark.createDataFrame([], _sink_schema(schema)).write.mode("append").partitionBy(DAY).parquet(late_out)
    state = f"{late_out.rstrip('/')}/_reconciled"
    since = load_watermark(spark, state)
    late = late_events(spark, landing, out, late_out, schema, key, ts_col, since)
    if late is None:
        return
    seen, rows = late
    rows.write.mode("append").partitionBy(DAY).parquet(late_out)
    save_watermark(spark, state, seen)


def _sink_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(DAY, T.DateType())])


def late_events(spark: SparkSession, landing: str, out: str, late_out: str, schema: T.StructType,
                key: str = "event_id", ts_col: str = "timestamp", since: str | None = None):
    """(largest file time, landed events that neither sink holds, once each) of
    the files landed since ``since``; None when there are none."""
    reader = spark.read.schema(schema).option("timestampNTZFormat", _NTZ)
    if since is not None:
        back = _dt.datetime.fromisoformat(since) - _dt.timedelta(seconds=1)
        reader = reader.option("modifiedAfter", back.strftime("%Y-%m-%dT%H:%M:%S"))
    landed = reader.json(landing).withColumn(DAY, F.to_date(ts_col))
    newest, days = landed.agg(F.max("_metadata.file_modification_time").cast("string"), F.collect_set(DAY)).first()
    if newest is None:
        return None
    keys = event_key(landed, key)
    missing = landed
    for path in (out, late_out):
        # days of the new files: a static filter, so other folders aren't read
        held = _sink(spark, path, schema).filter(F.col(DAY).isin(days) | F.col(DAY).isNull())
        missing = late_rows(missing, held, keys)
    return newest.replace(" ", "T"), dedupe(missing, keys, [])


# --- ST2 ------------------------------------------------------------------
STREAM_TABLE = "rows"


def stream_upsert(spark: SparkSession, changes_dir: str, schema: T.StructType, base: str,
                  keys: list[str], update_cols: list[str] | None, checkpoint: str,
                  order_cols=("event_timestamp",), max_files: int | None = None,
                  layout: versions.Layout = versions.Layout()):
    """ST2: apply landed change files as they arrive.  Each micro-batch is
    reduced to the latest change per key and upserted into the partitions it
    touches: the months of its rows for ``Layout(column)``, else key buckets.
    The new publication is written last, so readers switch at once
    and a failed batch leaves the last one.  A retried batch upserts the same
    rows again, with the same result.
    """
    def apply(batch: DataFrame, epoch: int) -> None:
        latest = current_state(batch, keys, list(order_cols)).persist()
        try:
            if latest.isEmpty():
                return
            ss = batch.sparkSession
            pub = versions.current(ss, base)
            if pub is None:
                new = versions.write_table(base, STREAM_TABLE, latest, keys, layout)
            else:
                new = versions.merge_table(base, STREAM_TABLE, pub.tables[STREAM_TABLE], latest, keys,
                                           lambda t, c: upsert(t, c, keys, update_cols), layout)
            versions.publish(ss, base, {STREAM_TABLE: new}, pub)
        finally:
            latest.unpersist()

    r = spark.readStream.schema(schema).option("timestampNTZFormat", _NTZ)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    q = (r.json(changes_dir).writeStream.foreachBatch(apply)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    return q


def read_upserted(spark: SparkSession, base: str) -> DataFrame:
    """The table as last published by ``stream_upsert``."""
    return versions.read(spark, base, STREAM_TABLE)


# --- ST3 ------------------------------------------------------------------
def late_rows(source: DataFrame, landed: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of the source whose key is missing from what was landed (rows
    stamped into an already extracted day); remedy: ``lookback_days``."""
    seen = landed.select(*[F.col(k).alias(f"_landed_{k}") for k in keys])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_landed_{k}")) for k in keys])
    return source.join(seen, same, "left_anti")
