"""Tracking queries on the driver tables.

Bindings: the tracking feed is the ``events`` table (user = shipment, value ->
speed, 0 below 20, and a temperature reading); a shipment per customer with
that key, shipped in the feed's first hours, with an actual, an estimated or
no arrival; its delivery address names the customer's nation (some have no
city, some are empty); routes are a dimension derived from nation / region
(one per nation, 3-5 points).
"""

from __future__ import annotations

from pyspark.sql import functions as F

from orderflow.operators import orders as O
from orderflow.operators import tracking as TR
from orderflow.plans import driver_tables as dt
from orderflow.plans.registry import query

STOP_BELOW = 20.0


def routes(spark, d):
    """Route dimension: warehouse -> 1..3 waypoints -> nation hub."""
    n = dt.table(spark, d, "nation").alias("n").join(
        dt.table(spark, d, "region").alias("r"), F.col("n.n_regionkey") == F.col("r.r_regionkey"))
    nk = F.col("n_nationkey")
    start = F.array(F.struct(F.lit(55.7943).alias("lat"), F.lit(49.1115).alias("lon"),
                             F.lit("Depot").alias("label")))
    mids = F.transform(F.sequence(F.lit(1), F.lit(1) + F.col("n_regionkey") % 3), lambda j: F.struct(
        (F.lit(55.8) - F.lit(0.1) * j - F.lit(0.01) * nk).alias("lat"),
        (F.lit(49.1) + F.lit(0.5) * j + F.lit(0.02) * nk).alias("lon"),
        F.concat(F.col("n_name"), F.lit(" km "), (j * 100).cast("string")).alias("label")))
    end = F.array(F.struct((F.lit(54.9) + F.lit(0.03) * nk).alias("lat"),
                           (F.lit(52.3) - F.lit(0.05) * F.col("n_regionkey")).alias("lon"),
                           F.concat(F.col("n_name"), F.lit(", РЦ")).alias("label")))
    return n.select(F.col("n_name").alias("city"), nk.cast("int").alias("ord"),
                    F.concat(start, mids, end).alias("route"))


def addresses(spark, d):
    k = F.col("customer_id")
    address = (F.when(k % 13 == 0, "").when(k % 11 == 0, "No city")
               .otherwise(F.concat(F.lit("Customer address, "), F.col("customer_region"))))
    return (dt.customers(spark, d).join(dt.regions(spark, d), "region_id")
            .select("customer_id", address.alias("delivery_address")))


def shipments(spark, d):
    k = F.col("customer_id")
    start = F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")
    return (addresses(spark, d)
            .withColumn("shipped_at", start + F.make_interval(hours=(k % 7).cast("int")))
            .withColumn("actual_arrival", F.when(k % 3 == 0, F.col("shipped_at") + F.make_interval(days=F.lit(20))))
            .withColumn("estimated_arrival", F.when(k % 3 == 1, F.col("shipped_at") + F.make_interval(days=F.lit(10))))
            .select(k.alias("shipment_id"), k.alias("order_id"), "delivery_address", "shipped_at",
                    "estimated_arrival", "actual_arrival",
                    F.concat(F.lit("V"), k.cast("string")).alias("vehicle_plate"),
                    F.when(k % 2 == 0, "0-4").alias("temperature_zone")))


def points(spark, d, trips):
    return TR.observed_points(feed(spark, d).drop("event_type", "value"), trips)


def classified(spark, d):
    return TR.classify_event(points(spark, d, TR.trips(shipments(spark, d), routes(spark, d))))


def feed(spark, d):
    """Tracking feed view of ``events``."""
    e = dt.tracking_feed(spark, d)
    temp = (F.pmod(F.floor(F.col("value") * 10).cast("long"), F.lit(120)) / F.lit(10.0))
    return e.select("event_id", "timestamp", "shipment_id", "event_type", "value",
                    F.when(F.col("value") < STOP_BELOW, F.lit(0)).otherwise(
                        F.col("value").cast("int")).alias("speed_kmh"),
                    temp.alias("temperature_celsius"))


# --- SQL fragments of the oracle -------------------------------------------
_RT_SQL = """rt AS (SELECT n.n_name AS city, n.n_nationkey AS ord,
  list_concat([{'lat': 55.7943::DOUBLE, 'lon': 49.1115::DOUBLE, 'label': 'Depot'}],
    list_transform(range(1, 2 + n.n_regionkey % 3), lambda j: {
      'lat': 55.8::DOUBLE - 0.1::DOUBLE * j - 0.01::DOUBLE * n.n_nationkey,
      'lon': 49.1::DOUBLE + 0.5::DOUBLE * j + 0.02::DOUBLE * n.n_nationkey,
      'label': n.n_name || ' km ' || CAST(j * 100 AS VARCHAR)}),
    [{'lat': 54.9::DOUBLE + 0.03::DOUBLE * n.n_nationkey,
      'lon': 52.3::DOUBLE - 0.05::DOUBLE * n.n_regionkey, 'label': n.n_name || ', РЦ'}]) AS route
  FROM nation n JOIN region r ON r.r_regionkey = n.n_regionkey),
ca AS (SELECT c.c_custkey AS customer_id, CASE WHEN c.c_custkey % 13 = 0 THEN '' WHEN c.c_custkey % 11 = 0
         THEN 'No city' ELSE 'Customer address, ' || n.n_name END AS address
       FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey),
mt AS (SELECT ca.customer_id, arg_min(rt.city, rt.ord) AS city, arg_min(rt.route, rt.ord) AS route
       FROM ca JOIN rt ON contains(ca.address, rt.city) GROUP BY ca.customer_id),
cr AS (SELECT ca.customer_id, mt.city AS route_city,
              coalesce(mt.route, [{'lat': 55.7943::DOUBLE, 'lon': 49.1115::DOUBLE, 'label': 'Склад КМК, Казань'},
                                  {'lat': 55.78::DOUBLE, 'lon': 49.15::DOUBLE, 'label': 'Казань, в пути'},
                                  {'lat': 55.77::DOUBLE, 'lon': 49.18::DOUBLE, 'label': 'Точка доставки'}])
                AS route
       FROM ca LEFT JOIN mt ON mt.customer_id = ca.customer_id)"""

_FEED_SQL = """f AS (SELECT event_id, ts AS "timestamp", user_id AS shipment_id, event_type, value,
  CASE WHEN value < 20 THEN 0 ELSE CAST(trunc(value) AS INTEGER) END AS speed_kmh,
  (CAST(floor(value * 10) AS BIGINT) % 120) / 10.0::DOUBLE AS temperature_celsius FROM events)"""

_PTS_SQL = _RT_SQL + """,
""" + _FEED_SQL + """,
s0 AS (SELECT c_custkey AS shipment_id, TIMESTAMP '2024-01-02 00:00:00' + (c_custkey % 7) * INTERVAL 1 HOUR
         AS shipped_at FROM customer),
sh AS (SELECT *, CASE shipment_id % 3 WHEN 0 THEN shipped_at + INTERVAL 20 DAY WHEN 1 THEN shipped_at + INTERVAL 10 DAY
                 ELSE shipped_at + INTERVAL 6 HOUR END AS trip_end FROM s0),
tm AS (SELECT *, greatest(60, CAST(trunc((epoch_us(trip_end) - epoch_us(shipped_at)) / 60000000.0::DOUBLE) AS INTEGER))
         AS trip_minutes FROM sh),
pp AS (SELECT f.event_id, f."timestamp", f.shipment_id, f.speed_kmh, f.temperature_celsius, tm.trip_minutes, cr.route,
              len(cr.route) AS k,
              greatest(0.0::DOUBLE, least(1.0::DOUBLE, (epoch_us(f."timestamp") - epoch_us(tm.shipped_at))
                / (tm.trip_minutes * 60000000.0::DOUBLE))) AS progress
       FROM f JOIN tm ON tm.shipment_id = f.shipment_id JOIN cr ON cr.customer_id = f.shipment_id),
px AS (SELECT *, progress * (k - 1) AS pos, CAST(trunc(progress * (k - 1)) AS INTEGER) AS leg FROM pp),
ps AS (SELECT *, least(leg, k - 2) AS seg,
         row_number() OVER (PARTITION BY shipment_id ORDER BY "timestamp", event_id) AS up,
         row_number() OVER (PARTITION BY shipment_id ORDER BY "timestamp" DESC, event_id DESC) AS down,
         row_number() OVER (PARTITION BY shipment_id, leg ORDER BY "timestamp", event_id) AS in_leg FROM px),
pi AS (SELECT *, round(route[seg + 1].lat + (route[seg + 2].lat - route[seg + 1].lat) * (pos - seg), 6)
                   AS latitude,
                 round(route[seg + 1].lon + (route[seg + 2].lon - route[seg + 1].lon) * (pos - seg), 6)
                   AS longitude,
                 CASE WHEN up = 1 THEN 'pickup' WHEN down = 1 THEN 'delivered' WHEN in_leg = 1 THEN 'checkpoint'
                      ELSE 'temperature_reading' END AS event_type FROM ps),
pc AS (SELECT *, CASE WHEN event_type = 'pickup' THEN route[1].label
                      WHEN event_type = 'delivered' THEN route[k].label
                      WHEN event_type = 'checkpoint' THEN route[least(seg + 1, k - 1) + 1].label
                 END AS checkpoint FROM pi)"""


@query("route_match", f"""
WITH {_RT_SQL}
SELECT customer_id, route_city, CAST(len(route) AS INTEGER) AS n_route_points,
       route[len(route)].label AS route_end
FROM cr
""")
def q_route_match(spark, d):
    """First route city (lowest ord) contained in the customer's address;
    NATION_1 matches before NATION_12, addresses without a city and empty
    ones fall to the default."""
    m = TR.match_route(addresses(spark, d), routes(spark, d))
    return m.select("customer_id", "route_city", F.size("route").alias("n_route_points"),
                    F.element_at("route", -1)["label"].alias("route_end"))


@query("trip_points", f"""
WITH {_PTS_SQL}
SELECT shipment_id, event_id, trip_minutes, round(progress, 6) AS progress,
       'TRK-' || upper(substr(md5(shipment_id || ':' || event_id), 1, 12)) AS tracking_id FROM pc
""")
def q_trip_points(spark, d):
    """The observed readings of a shipment with their trip, progress
    and stable id."""
    seen = TR.observed_points(feed(spark, d), shipments(spark, d))
    return seen.select("shipment_id", "event_id", "trip_minutes", F.round("progress", 6).alias("progress"),
                         "tracking_id")


@query("interpolated_route", f"""
WITH {_PTS_SQL}
SELECT shipment_id, event_id, latitude, longitude FROM pc
""")
def q_interpolated_route(spark, d):
    """Position of each reading on its route polyline."""
    matched = TR.match_route(shipments(spark, d), routes(spark, d))
    return TR.interpolate_route(points(spark, d, matched)).select("shipment_id", "event_id", "latitude", "longitude")


@query("event_types", f"""
WITH {_PTS_SQL}
SELECT shipment_id, event_id, event_type FROM pc
""")
def q_event_types(spark, d):
    """T4: pickup / checkpoint / temperature_reading / delivered."""
    return classified(spark, d).select("shipment_id", "event_id", "event_type")


@query("checkpoints", f"""
WITH {_PTS_SQL}
SELECT shipment_id, event_id, event_type, checkpoint FROM pc WHERE checkpoint IS NOT NULL
""")
def q_checkpoints(spark, d):
    """T5: checkpoint label of pickup, checkpoint and delivered readings."""
    return (classified(spark, d).filter(F.col("checkpoint").isNotNull())
            .select("shipment_id", "event_id", "event_type", "checkpoint"))


@query("tracking_events", f"""
WITH {_PTS_SQL},
e AS (SELECT *, speed_kmh = 0 AND event_type NOT IN ('pickup', 'delivered') AS stop FROM pc),
g AS (SELECT *, sum(CASE WHEN stop THEN 0 ELSE 1 END) OVER (PARTITION BY shipment_id
        ORDER BY "timestamp", event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM e),
r AS (SELECT shipment_id, grp FROM g WHERE stop GROUP BY shipment_id, grp
      HAVING epoch_us(max("timestamp")) - epoch_us(min("timestamp")) > 30 * 60000000)
SELECT g.event_id, g.shipment_id, g.shipment_id AS order_id, g.event_type, g."timestamp", g.latitude, g.longitude,
       g.temperature_celsius, g.speed_kmh, 'V' || g.shipment_id AS vehicle_plate, CAST(NULL AS VARCHAR) AS carrier,
       CAST(NULL AS VARCHAR) AS driver_name, g.checkpoint,
       CASE WHEN g.temperature_celsius > 6 THEN 'temperature_breach'
            WHEN g.stop AND r.grp IS NOT NULL THEN 'long_stop' END AS alert,
       CASE WHEN g.temperature_celsius > 6 THEN 'Температура ' || CAST(g.temperature_celsius AS VARCHAR)
              || ' превышает норму ' || CASE WHEN g.shipment_id % 2 = 0 THEN '0-4' ELSE '2-6' END
            WHEN g.stop AND r.grp IS NOT NULL THEN 'Простой > 30 мин' END AS alert_detail
FROM g LEFT JOIN r ON r.shipment_id = g.shipment_id AND r.grp = g.grp
""")
def q_tracking_events(spark, d):
    """The observed feed with shipment, route position, event type,
    checkpoint and alerts, all 15 columns."""
    readings = feed(spark, d).drop("event_type", "value")
    return TR.tracking_events(readings, shipments(spark, d), routes(spark, d))


# --- F1 F2 L1-L3 T7 T8 A5 -------------------------------------------------------
@query("tracking_page", """
SELECT event_id, ts AS "timestamp", user_id AS shipment_id, event_type, value FROM events
ORDER BY ts, event_id LIMIT 100 OFFSET 200
""")
def q_tracking_page(spark, d):
    """L1 + L2: page 3 of 100 of the feed in (time, id) order."""
    return TR.page(dt.tracking_feed(spark, d).drop("props"), page_no=3, limit=100)


@query("tracking_page_deep", """
SELECT event_id, ts AS "timestamp", user_id AS shipment_id, event_type, value
FROM (SELECT *, row_number() OVER (ORDER BY ts, event_id) AS n FROM events), (SELECT count(*) * 9 // 1000 * 100 AS skip FROM events)
WHERE n > skip AND n <= skip + 100
""")
def q_tracking_page_deep(spark, d):
    """L2 by position: the page of 100 nine tenths down the feed, read off the
    ranges that hold it."""
    rows = dt.tracking_feed(spark, d).drop("props")
    return TR.page_of(TR.page_index(rows), page_no=rows.count() * 9 // 1000 + 1, limit=100)


@query("page_after", """
SELECT event_id, ts AS "timestamp", user_id AS shipment_id, event_type, value FROM events
WHERE ts > TIMESTAMP '2024-01-10 00:00:00' OR (ts = TIMESTAMP '2024-01-10 00:00:00' AND event_id > 0)
ORDER BY ts, event_id LIMIT 100
""")
def q_page_after(spark, d):
    """L2 by key: the 100 events after a (time, id) position."""
    return TR.page_after(dt.tracking_feed(spark, d).drop("props"), "2024-01-10 00:00:00", 0, 100)


@query("pagination_summary", """
SELECT 3 AS page, 100 AS "limit", count(*) AS total, CAST((count(*) + 99) // 100 AS INTEGER) AS pages
FROM events WHERE event_type = 'click'
""")
def q_pagination_summary(spark, d):
    """L3: page envelope numbers for the click events, 100 per page."""
    return TR.pagination(TR.filter_tracking(dt.tracking_feed(spark, d), event_type="click"), 3, 100)


@query("tracking_filter", """
SELECT event_id, ts AS "timestamp", user_id AS shipment_id, event_type, value FROM events
WHERE ts >= TIMESTAMP '2024-01-10 00:00:00' AND ts < TIMESTAMP '2024-01-20 00:00:00'
  AND event_type = 'purchase'
""")
def q_tracking_filter(spark, d):
    """since (inclusive) / until (exclusive) / type; pushed into the scan."""
    return TR.filter_tracking(dt.tracking_feed(spark, d).drop("props"), since="2024-01-10 00:00:00",
                              until="2024-01-20 00:00:00", event_type="purchase")


def _with_temp_alert(df):
    a, det = TR.temperature_alert("temperature_celsius", None)
    return df.withColumn("alert", a).withColumn("alert_detail", det)


_TEMP_ALERT_SQL = """CASE WHEN temperature_celsius > 6 THEN 'temperature_breach' END AS alert,
  CASE WHEN temperature_celsius > 6 THEN 'Температура ' || CAST(temperature_celsius AS VARCHAR)
       || ' превышает норму 2-6' END AS alert_detail"""


@query("temperature_alerts", f"""
WITH {_FEED_SQL}
SELECT event_id, temperature_celsius, {_TEMP_ALERT_SQL} FROM f WHERE temperature_celsius > 6
""")
def q_temperature_alerts(spark, d):
    """Readings above 6 degrees with the breach text."""
    return (_with_temp_alert(feed(spark, d)).filter(F.col("alert").isNotNull())
            .select("event_id", "temperature_celsius", "alert", "alert_detail"))


@query("alerts", f"""
WITH {_FEED_SQL}, a AS (SELECT event_id, "timestamp", shipment_id, temperature_celsius,
                               {_TEMP_ALERT_SQL} FROM f)
SELECT * FROM a WHERE alert IS NOT NULL
  AND "timestamp" >= TIMESTAMP '2024-01-05 00:00:00' AND "timestamp" < TIMESTAMP '2024-01-25 00:00:00'
""")
def q_alerts(spark, d):
    """alert rows in a time range."""
    a = _with_temp_alert(feed(spark, d)).select("event_id", "timestamp", "shipment_id",
                                                "temperature_celsius", "alert", "alert_detail")
    return TR.filter_alerts(a, since="2024-01-05 00:00:00", until="2024-01-25 00:00:00")


@query("long_stops", """
WITH e AS (SELECT user_id AS shipment_id, ts, event_id, value < 20 AS stop FROM events),
g AS (SELECT *, sum(CASE WHEN stop THEN 0 ELSE 1 END) OVER (PARTITION BY shipment_id
        ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM e),
r AS (SELECT shipment_id, grp, min(ts) AS stop_start, max(ts) AS stop_end, count(*) AS n_points
      FROM g WHERE stop GROUP BY shipment_id, grp)
SELECT shipment_id, stop_start, stop_end, n_points,
       (epoch_us(stop_end) - epoch_us(stop_start)) / 60000000.0::DOUBLE AS stop_minutes
FROM r WHERE epoch_us(stop_end) - epoch_us(stop_start) > 30 * 60000000
""")
def q_long_stops(spark, d):
    """Unbroken runs of stopped readings (value < 20) per shipment that
    last more than 30 minutes."""
    e = dt.table(spark, d, "events").select(F.col("user_id").alias("shipment_id"), "ts",
                                            "event_id", "value")
    return TR.long_stops(e, "shipment_id", F.col("value") < STOP_BELOW, ts_col="ts")


@query("long_stop_alerts", f"""
WITH {_FEED_SQL},
e AS (SELECT *, speed_kmh = 0 AND event_type NOT IN ('pickup', 'delivered') AS stop FROM f),
g AS (SELECT *, sum(CASE WHEN stop THEN 0 ELSE 1 END) OVER (PARTITION BY shipment_id
        ORDER BY "timestamp", event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM e),
r AS (SELECT shipment_id, grp FROM g WHERE stop GROUP BY shipment_id, grp
      HAVING epoch_us(max("timestamp")) - epoch_us(min("timestamp")) > 30 * 60000000),
x AS (SELECT g.event_id, g.temperature_celsius,
        CASE WHEN g.temperature_celsius > 6 THEN 'temperature_breach'
             WHEN g.stop AND r.grp IS NOT NULL THEN 'long_stop' END AS alert,
        CASE WHEN g.temperature_celsius > 6 THEN 'Температура ' || CAST(g.temperature_celsius AS VARCHAR)
               || ' превышает норму 2-6'
             WHEN g.stop AND r.grp IS NOT NULL THEN 'Простой > 30 мин' END AS alert_detail
      FROM g LEFT JOIN r ON r.shipment_id = g.shipment_id AND r.grp = g.grp)
SELECT * FROM x WHERE alert IS NOT NULL
""")
def q_long_stop_alerts(spark, d):
    """T7 + T8 on the feed: breach first, else a reading inside a stop run
    longer than 30 minutes."""
    return (TR.long_stop_alert(feed(spark, d))
            .filter(F.col("alert").isNotNull())
            .select("event_id", "temperature_celsius", "alert", "alert_detail"))


@query("alerts_null_key", f"""
WITH {_FEED_SQL},
n AS (SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE shipment_id END AS shipment_id,
             CASE WHEN event_id % 5 = 0 THEN NULL ELSE "timestamp" END AS "timestamp", speed_kmh, event_type,
             temperature_celsius FROM f),
e AS (SELECT *, speed_kmh = 0 AND event_type NOT IN ('pickup', 'delivered') AS stop FROM n
      WHERE shipment_id IS NOT NULL AND "timestamp" IS NOT NULL),
g AS (SELECT *, sum(CASE WHEN stop THEN 0 ELSE 1 END) OVER (PARTITION BY shipment_id
        ORDER BY "timestamp", event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS grp FROM e),
r AS (SELECT shipment_id, grp FROM g WHERE stop GROUP BY shipment_id, grp
      HAVING epoch_us(max("timestamp")) - epoch_us(min("timestamp")) > 30 * 60000000),
st AS (SELECT g.event_id FROM g JOIN r ON r.shipment_id = g.shipment_id AND r.grp = g.grp WHERE g.stop)
SELECT n.event_id, CASE WHEN temperature_celsius > 6 THEN 'temperature_breach'
                        WHEN st.event_id IS NOT NULL THEN 'long_stop' END AS alert
FROM n LEFT JOIN st ON st.event_id = n.event_id
""")
def q_alerts_null_key(spark, d):
    """T7 + T8 where a third of the readings has no shipment and a fifth no
    time: every reading stays a row and keeps its temperature alert."""
    f = feed(spark, d)
    broken = (f.withColumn("shipment_id", F.when(F.col("event_id") % 3 != 0, F.col("shipment_id")))
              .withColumn("timestamp", F.when(F.col("event_id") % 5 != 0, F.col("timestamp"))))
    return TR.long_stop_alert(broken).select("event_id", "alert")


@query("event_count", "SELECT count(*) AS events_count FROM events")
def q_event_count(spark, d):
    """A5: number of tracking events loaded."""
    return O.event_count(dt.tracking_feed(spark, d))
