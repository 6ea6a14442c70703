"""Source, sink, state and streaming queries (S1-S7 K1-K3 W1-W7 ST1-ST3).

These round trips write to the session's shared scratch folder (below
``spark.checkpoint.dir``) and read the written data back, so the query
result is what a downstream reader would see.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import functions as F, types as T

from orderflow.functions.time import ntz
from orderflow.plans import driver_tables as dt
from orderflow.plans import jobs
from orderflow.plans.q_changes import ORDER_COLS, _UPSERT_SQL, order_changes, order_target
from orderflow.plans.q_lifecycle import line_shipments
from orderflow.plans.registry import query
from orderflow.session import scratch_dir
from orderflow.sources import readers as R
from orderflow.sources import sinks as K
from orderflow.sources import state as W
from orderflow.sources.versions import Layout
from orderflow.streaming import streams as ST

FEED_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("shipment_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()), T.StructField("props", T.StringType()),
])
FEED_COLS = [f.name for f in FEED_SCHEMA.fields]
_FEED_SQL = 'event_id, ts AS "timestamp", user_id AS shipment_id, event_type, value, props'

DATA_DATE = "2024-01-16"          # run date: extracts the UTC day 2024-01-15


def _src(d):
    return R.Source(kind="parquet", root=d)


@query("day_window", f"""
SELECT {_FEED_SQL} FROM events
WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' AND ts < TIMESTAMP '2024-01-16 00:00:00'
""")
def q_day_window(spark, d):
    """S2 + S3: the half-open UTC day before the run date, pushed to the scan."""
    df = R.read_day_window(spark, _src(d), "events.parquet", "ts", DATA_DATE)
    return df.select(*[F.col(c).alias(a) for c, a in
                       zip(["event_id", "ts", "user_id", "event_type", "value", "props"], FEED_COLS)])


@query("extract_day", f"""
SELECT event_id, ts, user_id, event_type, value, props, DATE '2024-01-15' AS data_date FROM events
WHERE ts >= TIMESTAMP '2024-01-15 00:00:00' AND ts < TIMESTAMP '2024-01-16 00:00:00'
""")
def q_extract_day(spark, d):
    """S4 + K1: an incremental table lands one ``data_date=`` partition (the
    start day of the window); read back with partition discovery."""
    root = scratch_dir(spark, "extract")
    specs = [R.TableSpec("events", "incremental", "ts", source="events.parquet"),
             R.TableSpec("products", "snapshot", source="part.parquet")]
    jobs.extract(spark, _src(d), root, DATA_DATE, specs)
    return spark.read.parquet(f"{root}/events")


@query("extract_lookback", """
SELECT event_id, ts, user_id, event_type, value, props, CAST(ts AS DATE) AS data_date FROM events
WHERE ts >= TIMESTAMP '2024-01-12 00:00:00' AND ts < TIMESTAMP '2024-01-16 00:00:00'
  AND (ts >= TIMESTAMP '2024-01-13 00:00:00' OR event_type <> 'purchase')
""")
def q_extract_lookback(spark, d):
    """S2 + K1 backfill: four days land without their purchases; a rerun with
    two days of lookback replaces the last three folders, each with the rows
    of its own day, and leaves the first."""
    root = scratch_dir(spark, "lookback")
    dt.table(spark, d, "events").filter("event_type <> 'purchase'").write.parquet(f"{root}/source/events.parquet")
    specs = [R.TableSpec("events", "incremental", "ts", source="events.parquet")]
    jobs.extract(spark, _src(f"{root}/source"), f"{root}/landed", DATA_DATE, specs, lookback_days=3)
    jobs.extract(spark, _src(d), f"{root}/landed", DATA_DATE, specs, lookback_days=2)
    return spark.read.parquet(f"{root}/landed/events")


@query("snapshot_copy", """
SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment, DATE '2024-01-15' AS data_date
FROM customer
""")
def q_snapshot_copy(spark, d):
    """S1 + K1: a master-data table (customers) is copied whole into the
    run's partition; rerunning the day overwrites the same folder
    (idempotent)."""
    root = scratch_dir(spark, "snapshot")
    specs = [R.TableSpec("customers", "snapshot", source="customer.parquet")]
    jobs.extract(spark, _src(d), root, DATA_DATE, specs)
    jobs.extract(spark, _src(d), root, DATA_DATE, specs)   # rerun: same result
    return spark.read.parquet(f"{root}/customers")


@query("shipped_lines", """
SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS shipment_id,
       l_orderkey AS order_id, l_shipdate AS shipped_at
FROM lineitem WHERE l_linestatus = 'F'
""")
def q_shipped_lines(spark, d):
    """Only shipped shipments, with the columns tracking needs."""
    s = line_shipments(spark, d).withColumn(
        "shipped_at", F.when(F.col("actual_arrival").isNotNull(), F.col("shipped_at")))
    return R.shipped_shipments(s).select("shipment_id", "order_id", "shipped_at")


@query("landed_roundtrip", f"""
SELECT {_FEED_SQL}, DATE '2024-01-16' AS dt FROM events
""")
def q_landed_roundtrip(spark, d):
    """K2 + S7: the whole feed landed as JSON Lines under ``dt=`` (nulls
    kept, microsecond times) and read back with an explicit schema."""
    root = scratch_dir(spark, "landing")
    K.land_jsonl(dt.tracking_feed(spark, d), root, DATA_DATE, "20240116T000000")
    return R.read_landed_tracking(spark, root, FEED_SCHEMA)


PAGE_SIZE = 500


def land_pages(spark, d, folder):
    """The feed served as pages of 500 ``{data, pagination}`` envelopes."""
    feed = dt.tracking_feed(spark, d)
    stats = feed.agg(F.count(F.lit(1)).alias("n"), F.max("event_id").alias("m")).first()
    total, pages = stats["n"], (int(stats["m"] or 0) // PAGE_SIZE) + 1
    env = (feed.groupBy((F.floor(F.col("event_id") / PAGE_SIZE) + 1).cast("int").alias("page"))
           .agg(F.sort_array(F.collect_list(F.struct(*FEED_COLS))).alias("data"))
           .select("data", F.struct(F.col("page"), F.lit(PAGE_SIZE).alias("limit"),
                                    F.lit(total).cast("long").alias("total"),
                                    F.lit(pages).alias("pages")).alias("pagination"),
                   F.lit("2024-01-31T00:00:00").alias("timestamp")))
    env.write.option("timestampNTZFormat", K.JSON_TS_FORMAT).json(folder)
    return env


@query("page_envelopes", f"SELECT {_FEED_SQL} FROM events")
def q_page_envelopes(spark, d):
    """The feed served as pages of 500 ``{data, pagination}`` envelopes
    (one JSON line each), read back into one row per event."""
    root = scratch_dir(spark, "pages")
    land_pages(spark, d, root)
    return R.read_page_envelopes(spark, root, FEED_SCHEMA)


@query("page_envelopes_two_pulls", f"SELECT {_FEED_SQL} FROM events")
def q_page_envelopes_two_pulls(spark, d):
    """S6 over the folders of two pulls: the second found nothing and landed
    one empty first page, which must not stop the pages of the first."""
    root = scratch_dir(spark, "pulls")
    env = land_pages(spark, d, f"{root}/pull=1")
    empty = env.orderBy("pagination.page").limit(1).withColumn("data", F.filter("data", lambda e: F.lit(False)))
    empty.write.option("timestampNTZFormat", K.JSON_TS_FORMAT).json(f"{root}/pull=2")
    return R.read_page_envelopes(spark, root, FEED_SCHEMA)


_PULL_SQL = f"""e AS (SELECT {_FEED_SQL} FROM events),
c AS (SELECT date_trunc('day', max("timestamp")) AS cutoff FROM e),
b AS (SELECT max("timestamp") AS boundary FROM e, c WHERE "timestamp" < c.cutoff)"""


def _two_pulls(spark, d):
    """Run the pull twice: on the feed as it stood before its last day, then
    on the whole feed; the inclusive resume point re-lands the boundary row."""
    base = scratch_dir(spark, "pull")
    landing, state = f"{base}/landing", f"{base}/state"
    feed = dt.tracking_feed(spark, d)
    cutoff = feed.agg(F.to_date(F.max("timestamp"))).first()[0]
    early = feed.filter(F.col("timestamp") < ntz(cutoff))
    r1 = W.incremental_pull(spark, early, state, landing, "2024-01-30", "20240130T000000")
    r2 = W.incremental_pull(spark, feed, state, landing, "2024-01-31", "20240131T000000")
    return landing, r1, r2


@query("incremental_pull", f"""
WITH {_PULL_SQL}
SELECT e.*, DATE '2024-01-30' AS dt FROM e, c WHERE "timestamp" < c.cutoff
UNION ALL SELECT e.*, DATE '2024-01-31' AS dt FROM e, b WHERE "timestamp" >= b.boundary
""")
def q_incremental_pull(spark, d):
    """W1-W6 + K2 + K3: two high-water-mark pulls; data is landed before the
    state is saved and the lower bound is inclusive, so the boundary event
    lands twice."""
    landing, _, _ = _two_pulls(spark, d)
    return R.read_landed_tracking(spark, landing, FEED_SCHEMA)


@query("empty_pull", f"""
WITH {_PULL_SQL}
SELECT e.*, DATE '2024-01-30' AS dt FROM e, c WHERE "timestamp" < c.cutoff
UNION ALL SELECT e.*, DATE '2024-01-31' AS dt FROM e, b WHERE "timestamp" >= b.boundary
""")
def q_empty_pull(spark, d):
    """K3: a third pull that finds nothing at or after the saved state (the
    feed without its last day) lands nothing."""
    landing, _, r2 = _two_pulls(spark, d)
    state = landing.replace("/landing", "/state")
    feed = dt.tracking_feed(spark, d)
    cutoff = feed.agg(F.to_date(F.max("timestamp"))).first()[0]
    W.incremental_pull(spark, feed.filter(F.col("timestamp") < ntz(cutoff)), state, landing, "2024-02-01",
                       "20240201T000000")
    return R.read_landed_tracking(spark, landing, FEED_SCHEMA)


@query("new_data_gate", """
WITH m AS (SELECT max(ts) AS last FROM events)
SELECT 'any' AS since, count(*) > 0 AS has_new FROM events
UNION ALL SELECT 'last event', count(*) > 0 FROM events, m WHERE ts >= last
UNION ALL SELECT 'after it', count(*) > 0 FROM events, m WHERE ts >= last + INTERVAL 1 MICROSECOND
""")
def q_new_data_gate(spark, d):
    """The gate with no state, at the last event (inclusive) and just
    after it."""
    feed = dt.tracking_feed(spark, d)
    last = _dt.datetime.fromisoformat(W.max_timestamp(feed))
    sinces = {"any": None, "last event": last.isoformat(),
              "after it": (last + _dt.timedelta(microseconds=1)).isoformat()}
    return spark.createDataFrame([(k, W.has_new_data(feed, s)) for k, s in sinces.items()],
                                 "since string, has_new boolean")


@query("dedupe_events", f"""
WITH {_PULL_SQL}
SELECT e.*, CASE WHEN "timestamp" < c.cutoff THEN DATE '2024-01-30' ELSE DATE '2024-01-31' END AS dt
FROM e, c
""")
def q_dedupe_events(spark, d):
    """The landed feed read back, one row per event id (first landing)."""
    landing, _, _ = _two_pulls(spark, d)
    return W.dedupe_events(R.read_landed_tracking(spark, landing, FEED_SCHEMA))


# --- streams ---------------------------------------------------------------------
@query("stream_dedupe", f"SELECT {_FEED_SQL} FROM events")
def q_stream_dedupe(spark, d):
    """ST1: the feed lands in two drops that overlap on the boundary event;
    two ``availableNow`` runs of the stream write each event once."""
    base = scratch_dir(spark, "stream")
    landing, out, ckpt = f"{base}/landing", f"{base}/out", f"{base}/_checkpoint"
    feed = dt.tracking_feed(spark, d)
    cutoff = feed.agg(F.to_date(F.max("timestamp"))).first()[0]
    first = feed.filter(F.col("timestamp") < ntz(cutoff))
    boundary = first.agg(F.max("timestamp")).first()[0]
    K.land_jsonl(first, landing, "2024-01-30", "1")
    ST.stream_tracking(spark, landing, out, ckpt, FEED_SCHEMA)
    K.land_jsonl(feed.filter(F.col("timestamp") >= ntz(boundary)), landing, "2024-01-31", "2")
    ST.stream_tracking(spark, landing, out, ckpt, FEED_SCHEMA)
    return ST.read_tracking(spark, out, FEED_SCHEMA)


@query("stream_upsert", _UPSERT_SQL)
def q_stream_upsert(spark, d):
    """ST2: the orders land as a first change file, the change batch as a
    second; each ``availableNow`` run upserts into the months it touches
    and publishes them."""
    base = scratch_dir(spark, "stream-upsert")
    changes, tables, ckpt = f"{base}/changes", f"{base}/orders", f"{base}/_checkpoint"
    schema = T.StructType(order_target(spark, d).schema.fields
                          + [T.StructField("event_timestamp", T.TimestampNTZType())])
    for i, df in enumerate([order_target(spark, d), order_changes(spark, d)]):
        (df.withColumn("event_timestamp", F.col("created_at"))
         .write.mode("append").option("ignoreNullFields", "false")
         .option("timestampNTZFormat", K.JSON_TS_FORMAT).json(changes))
        ST.stream_upsert(spark, changes, schema, tables, ["order_id"], ["status", "priority"], ckpt,
                         layout=Layout("created_at"))
    return ST.read_upserted(spark, tables).select(*ORDER_COLS)


@query("stream_late", f"SELECT {_FEED_SQL} FROM events")
def q_stream_late(spark, d):
    """ST1 with a late sink: the last ten days land first, the whole feed
    second; what is behind the one-day watermark by then goes to the late
    sink, and both sinks together hold every event once."""
    base = scratch_dir(spark, "stream-late")
    landing, out, late, ckpt = (f"{base}/{x}" for x in ("landing", "out", "late", "_checkpoint"))
    feed = dt.tracking_feed(spark, d)
    cutoff = feed.agg(F.to_date(F.max("timestamp"))).first()[0] - _dt.timedelta(days=10)
    for i, part in enumerate([feed.filter(F.col("timestamp") >= ntz(cutoff)), feed]):
        K.land_jsonl(part, landing, f"2024-01-3{i}", str(i))
        ST.stream_tracking(spark, landing, out, ckpt, FEED_SCHEMA, lateness="1 day", late_out=late)
    return ST.read_tracking(spark, out, FEED_SCHEMA, late)


@query("late_rows", f"""
SELECT {_FEED_SQL} FROM events e
WHERE NOT EXISTS (SELECT 1 FROM events l WHERE l.event_id = e.event_id AND l.event_type <> 'purchase')
""")
def q_late_rows(spark, d):
    """ST3: source rows missing from what was landed (purchases posted after
    their day was extracted)."""
    feed = dt.tracking_feed(spark, d)
    landed = feed.filter(F.col("event_type") != "purchase")
    return ST.late_rows(feed, landed, ["event_id"])
