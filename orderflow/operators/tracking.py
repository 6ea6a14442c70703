"""Tracking-event derivation, filtering, paging and alerts
(F1 F2 L1-L3 T1-T9 J6).

Positions, event types and alerts are derived from the observed readings:
progress is the elapsed share of the trip, and firsts and runs are aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from orderflow.functions import ids
from orderflow.functions.time import ntz
from orderflow.operators.ordered import Ordered, write_ordered
from orderflow.schemas import ROUTES
from orderflow.session import written

# FIXED VALUES: routes by destination city (in list order) and the default
# route; each point is (lat, lon, label).
REFERENCE_ROUTES = [
    ("Набережные Челны", [
        (55.7943, 49.1115, "Склад КМК, Казань"),
        (55.7522, 49.2058, "Казань, выезд на М7"),
        (55.6500, 49.9500, "Мамадыш, трасса М7"),
        (55.6800, 50.8200, "Елабуга"),
        (55.7435, 52.4055, "Набережные Челны, РЦ"),
    ]),
    ("Нижнекамск", [
        (55.7943, 49.1115, "Склад КМК, Казань"),
        (55.7522, 49.2058, "Казань, выезд на М7"),
        (55.6500, 49.9500, "Мамадыш"),
        (55.6340, 51.8160, "Нижнекамск"),
    ]),
    ("Альметьевск", [
        (55.7943, 49.1115, "Склад КМК, Казань"),
        (55.3900, 50.3100, "Чистополь"),
        (54.9013, 52.3155, "Альметьевск, РЦ"),
    ]),
    ("Зеленодольск", [
        (55.7943, 49.1115, "Склад КМК, Казань"),
        (55.8439, 48.5178, "Зеленодольск"),
    ]),
]
DEFAULT_ROUTE = [
    (55.7943, 49.1115, "Склад КМК, Казань"),
    (55.7800, 49.1500, "Казань, в пути"),
    (55.7700, 49.1800, "Точка доставки"),
]

# FIXED VALUES: trip and alert rules
DEFAULT_TRIP_HOURS = 6
MIN_TRIP_MINUTES = 60
TEMP_BREACH_ABOVE = 6.0
DEFAULT_ZONE = "2-6"
TEMP_ALERT = "temperature_breach"
TEMP_DETAIL = "Температура %s превышает норму %s"
STOP_ALERT = "long_stop"
STOP_DETAIL = "Простой > 30 мин"
LONG_STOP_MINUTES = 30
PAGE_LIMIT_MAX = 1000
NAMES_IN_PLAN = 10_000          # city names that a plan carries


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def reference_routes(spark):
    rows = [(city, i, [dict(lat=a, lon=b, label=c) for a, b, c in pts])
            for i, (city, pts) in enumerate(REFERENCE_ROUTES)]
    return spark.createDataFrame(rows, ROUTES)


def route_literal(points) -> Column:
    return F.array(*[F.struct(F.lit(a).cast("double").alias("lat"),
                              F.lit(b).cast("double").alias("lon"),
                              F.lit(c).alias("label")) for a, b, c in points])


# --- F1 / F2 ----------------------------------------------------------------
def _ts(v):
    return ntz(v)


def filter_tracking(df: DataFrame, since=None, until=None, shipment_id=None,
                    event_type=None, ts_col: str = "timestamp") -> DataFrame:
    """Conjunction of optional predicates (``>= since``, ``< until``, equality
    on shipment and type); None or '' means not set.  Timestamps compare as
    timestamps and push down to the Parquet scan."""
    if since not in (None, ""):
        df = df.filter(F.col(ts_col) >= _ts(since))
    if until not in (None, ""):
        df = df.filter(F.col(ts_col) < _ts(until))
    if shipment_id not in (None, ""):
        df = df.filter(F.col("shipment_id") == F.lit(shipment_id))
    if event_type not in (None, ""):
        df = df.filter(F.col("event_type") == F.lit(event_type))
    return df


def filter_alerts(df: DataFrame, since=None, until=None, ts_col: str = "timestamp") -> DataFrame:
    return filter_tracking(df.filter(F.col("alert").isNotNull()), since, until, ts_col=ts_col)


# --- L1 L2 L3 -----------------------------------------------------------------
def validate_page(page: int, limit: int) -> None:
    """Q6: ``limit`` 1..1000, ``page`` >= 1."""
    if not isinstance(limit, int) or not 1 <= limit <= PAGE_LIMIT_MAX:
        raise ValueError(f"limit must be in 1..{PAGE_LIMIT_MAX}")
    if not isinstance(page, int) or page < 1:
        raise ValueError("page must be >= 1")


def order_events(df: DataFrame, ts_col: str = "timestamp", id_col: str = "event_id") -> DataFrame:
    """L1: total order by event time, the id breaks ties."""
    return df.orderBy(F.col(ts_col).asc(), F.col(id_col).asc())


def page(df: DataFrame, page_no: int = 1, limit: int = 100, ts_col: str = "timestamp",
         id_col: str = "event_id") -> DataFrame:
    """L2: rows [(page-1)*limit, +limit) of the ordered feed; past the end
    -> empty.  Offset paging sorts up to offset+limit rows per task
    (TakeOrderedAndProject); ``page_after`` and ``page_of`` are for deep pages."""
    validate_page(page_no, limit)
    return order_events(df, ts_col, id_col).offset((page_no - 1) * limit).limit(limit)


def page_after(df: DataFrame, after_ts, after_id, limit: int = 100,
               ts_col: str = "timestamp", id_col: str = "event_id") -> DataFrame:
    """Keyset paging: the next ``limit`` rows after (ts, id); the predicate
    pushes into the scan and the sort is a bounded top-k."""
    validate_page(1, limit)
    cond = (F.col(ts_col) > _ts(after_ts)) | ((F.col(ts_col) == _ts(after_ts))
                                              & (F.col(id_col) > F.lit(after_id)))
    return order_events(df.filter(cond), ts_col, id_col).limit(limit)


def page_index(df: DataFrame, ts_col: str = "timestamp", id_col: str = "event_id",
               partitions: int | None = None) -> Ordered:
    """The feed written in event order with the number of rows before each
    range; ``page_of`` reads a page off it."""
    return write_ordered(df, [F.col(ts_col).asc(), F.col(id_col).asc()], "pages", partitions)


def page_of(index: Ordered, page_no: int = 1, limit: int = 100) -> DataFrame:
    """L2 at any depth: only the ranges that hold the page's rows are read, so
    page 1,000,000 costs what page 1 does."""
    validate_page(page_no, limit)
    return index.slice((page_no - 1) * limit, limit)


def pagination(df: DataFrame, page_no: int = 1, limit: int = 100) -> DataFrame:
    """L3: page, limit, total, pages = ceil(total / limit) (0 when empty)."""
    validate_page(page_no, limit)
    total = F.count(F.lit(1))
    return df.agg(F.lit(page_no).alias("page"), F.lit(limit).alias("limit"),
                  total.alias("total"),
                  ((total + F.lit(limit - 1)) / F.lit(limit)).cast("int").alias("pages"))


def tracking_envelope(df: DataFrame, page_no: int = 1, limit: int = 100, since=None,
                      until=None, shipment_id=None, event_type=None, alerts_only: bool = False,
                      now=None, ts_col: str = "timestamp", id_col: str = "event_id") -> DataFrame:
    """One row ``{data: [events of the page], pagination: {page, limit,
    total, pages}, timestamp}`` -- the tracking (or, with ``alerts_only``,
    the alerts) response for a filter and a page.

    The page holds at most ``limit`` (<= 1000) rows, so collecting it into
    one array is bounded; the total is one count (a scalar)."""
    import datetime as _dt
    validate_page(page_no, limit)
    base = filter_alerts(df, since, until, ts_col) if alerts_only else df
    rows = filter_tracking(base, None if alerts_only else since, None if alerts_only else until,
                           shipment_id, event_type, ts_col)
    total = rows.count()
    pages = (total + limit - 1) // limit
    stamp = (now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)).isoformat()
    data = page(rows, page_no, limit, ts_col, id_col)
    cols = [F.col(c) for c in rows.columns]
    # order inside the array: (ts, id) first, as the page itself
    keyed = F.struct(F.col(ts_col).alias("_k1"), F.col(id_col).alias("_k2"), F.struct(*cols).alias("e"))
    return data.agg(F.sort_array(F.collect_list(keyed)).alias("_d")).select(
        F.transform("_d", lambda x: x["e"]).alias("data"),
        F.struct(F.lit(page_no).alias("page"), F.lit(limit).alias("limit"),
                 F.lit(total).cast("long").alias("total"), F.lit(pages).alias("pages")
                 ).alias("pagination"),
        F.lit(stamp).alias("timestamp"))


# --- J6 -------------------------------------------------------------------
def match_route(df: DataFrame, routes: DataFrame, address_col: str = "delivery_address",
                default_route=None) -> DataFrame:
    """Adds ``route_city`` and ``route``: the first city (lowest ``ord``)
    whose name is a substring of the address; the default route on a null
    or empty address or no match.

    Each distinct address is matched once: of its substrings of every city
    length only those that are a city name (a hash lookup in the names, up to
    ``NAMES_IN_PLAN`` of them) become rows, so an address gives as many rows
    as it names cities.  They are joined with the routes on the whole name, so a
    short name matches only itself, and the match comes back by address.  With
    more names than that every substring is joined: the same rows, more of them on the way."""
    default = route_literal(default_route or DEFAULT_ROUTE)
    names = [r[0] for r in routes.select("city").filter("city <> ''").distinct().limit(NAMES_IN_PLAN + 1).collect()]
    if len(names) <= NAMES_IN_PLAN:
        sizes = sorted({len(n) for n in names})
    else:
        sizes = sorted(r[0] for r in routes.select(F.length("city").alias("n")).filter("n > 0").distinct().collect())
    addr = df.select(F.col(address_col).alias("_address")).filter("_address <> ''").distinct()
    none = F.array().cast("array<string>")

    def substrings(n: int) -> Column:
        starts = F.sequence(F.lit(1), F.length("_address") - F.lit(n - 1))
        found = F.transform(starts, lambda p: F.substring(F.col("_address"), p, F.lit(n)))
        if len(names) <= NAMES_IN_PLAN:
            found = F.filter(found, lambda x: x.isin(*[c for c in names if len(c) == n]))
        return F.when(F.length("_address") >= n, found).otherwise(none)

    cities = F.array_distinct(F.flatten(F.array(none, *[substrings(n) for n in sizes])))
    hit = (addr.select("_address", F.explode(cities).alias("city"))
           .join(routes.select("city", "ord"), "city")
           .groupBy("_address").agg(F.min(F.struct("ord", "city")).alias("_hit"))
           .select("_address", F.col("_hit.ord").alias("ord"), F.col("_hit.city").alias("city"))
           .join(routes.select("city", "ord", F.col("route").alias("_route")), ["city", "ord"])
           .select("_address", F.col("city").alias("route_city"), "_route"))
    return (df.join(hit, F.col(address_col) == F.col("_address"), "left")
            .withColumn("route", F.coalesce("_route", default)).drop("_address", "_route"))


# --- T1 T2 T6 -----------------------------------------------------------------
def trip_end(shipped_at="shipped_at", actual="actual_arrival", estimated="estimated_arrival",
             default_hours: int = DEFAULT_TRIP_HOURS) -> Column:
    """Actual arrival, else estimated, else shipped + 6 h."""
    return F.coalesce(_c(actual), _c(estimated),
                      _c(shipped_at) + F.make_interval(hours=F.lit(default_hours)))


def trip_minutes(end: Column | None = None) -> Column:
    """Whole minutes of the trip, 60 at least."""
    micros = F.timestamp_diff("MICROSECOND", F.col("shipped_at"), trip_end() if end is None else end)
    return F.greatest(F.lit(MIN_TRIP_MINUTES), (micros / F.lit(60_000_000)).cast("int"))


def observed_points(feed: DataFrame, shipments: DataFrame, key: str = "shipment_id") -> DataFrame:
    """T2 + T6 on the observed feed: each reading of a shipped shipment with
    its progress, the elapsed share of the trip (0 before it, 1 after its
    end), and the stable tracking id of (shipment, reading)."""
    s = (shipments.filter(F.col("shipped_at").isNotNull())
         .withColumn("trip_minutes", trip_minutes()))
    j = feed.join(s, key)
    micros = F.timestamp_diff("MICROSECOND", F.col("shipped_at"), F.col("timestamp"))
    share = micros / (F.col("trip_minutes") * F.lit(60_000_000.0))
    return (j.withColumn("progress", F.greatest(F.lit(0.0), F.least(F.lit(1.0), share)))
            .withColumn("tracking_id", ids.tracking_id(key, "event_id")))


# --- T3 T4 T5 -----------------------------------------------------------------
def _route_pos(progress: Column, k: Column) -> Column:
    return progress * (k - 1)


def interpolate_route(points: DataFrame, route_col: str = "route") -> DataFrame:
    """pos = progress * (k-1), seg = min(int(pos), k-2), linear
    interpolation between points seg and seg+1, rounded to 6 decimals."""
    k = F.size(route_col)
    pos = _route_pos(F.col("progress"), k)
    seg = F.least(pos.cast("int"), k - 2)
    t = pos - seg
    a = F.element_at(route_col, seg + 1)
    b = F.element_at(route_col, seg + 2)
    return (points.withColumn("_seg", seg).withColumn("_t", t)
            .withColumn("latitude", F.round(a["lat"] + (b["lat"] - a["lat"]) * F.col("_t"), 6))
            .withColumn("longitude", F.round(a["lon"] + (b["lon"] - a["lon"]) * F.col("_t"), 6))
            .withColumn("route_segment", F.col("_seg"))
            .drop("_seg", "_t"))


# --- segmented scan: running values of a feed split over (key, time bucket) --------
BUCKET_MINUTES = 240


def running(df: DataFrame, key: str, stopped: Column | None = None, leg: Column | None = None,
            ts_col: str = "timestamp", id_col: str = "event_id", bucket_minutes: int = BUCKET_MINUTES,
            ends_move: bool = False) -> DataFrame:
    """Adds what a reading needs to know of its key's other readings in
    (time, id) order: ``__first`` and ``__last`` (is it the key's first / last
    reading), ``__new_leg`` (its ``leg`` differs from the one before),
    ``__stop``, and for stopped readings ``__run_start`` and ``__run_end``, the
    times of the unbroken stopped run it stands in.  With ``ends_move`` the first and the last
    reading of a key are in no run.

    The feed is shuffled and sorted once on (key, time bucket), so a hot key
    is spread over its buckets; all running values are windows in that order.
    What crosses a bucket's edge comes from one narrow row per (key, bucket):
    its first and last reading, and the readings next to its outer moves.
    A window over these rows of a key (one per bucket) hands the open run, the
    last leg and the ends of the key to every bucket; they join on the
    partitioning that the readings already have.

    A reading without a key or a time is in no sequence (all marks false, no run) but stays a
    row; such readings are dealt over buckets of their own."""
    ts, rid = F.col(ts_col), F.col(id_col)
    known = F.col(key).isNotNull() & ts.isNotNull()
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    bucket = F.floor(F.timestamp_diff("MINUTE", epoch, ts.cast("timestamp_ntz")) / bucket_minutes)
    stray = F.pmod(F.xxhash64(rid), F.lit(1 << 20)) - F.lit(1 << 60)
    x = (df.withColumn("__known", known)
         .withColumn("__b", F.when(F.col("__known"), bucket).otherwise(stray))
         .withColumn("__stop", F.coalesce(known & (F.lit(False) if stopped is None else stopped), F.lit(False)))
         .withColumn("__leg", F.lit(0) if leg is None else leg))
    w = Window.partitionBy(key, "__b").orderBy(ts, rid)

    def beside(rows: DataFrame) -> DataFrame:
        """Neighbours in the bucket: the time of a reading right after a move
        and of one right before a move."""
        before, after = F.lag("__stop").over(w), F.lead("__stop").over(w)
        return (rows.withColumn("__opens", before.isNull()).withColumn("__closes", after.isNull())
                .withColumn("__after", F.when(~before, ts)).withColumn("__ahead", F.when(~after, ts)))

    # one row per (key, bucket)
    reading = F.struct(ts.alias("t"), rid.alias("i"), F.col("__stop").alias("stop"), F.col("__leg").alias("leg"))
    edges = (beside(x.filter("__known").select(key, "__b", ts_col, id_col, "__stop", "__leg"))
             .groupBy(key, "__b").agg(
                 F.min(reading).alias("head"), F.max(reading).alias("tail"), F.bool_or(~F.col("__stop")).alias("moves"),
                 F.max("__after").alias("after"), F.min("__ahead").alias("ahead"),
                 F.min(F.when(~F.col("__opens"), ts)).alias("second"),
                 F.max(F.when(~F.col("__closes"), ts)).alias("second_last")))
    trip = Window.partitionBy(key).orderBy("__b")
    whole = trip.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edges = (edges.withColumn("next", F.lead("head.t").over(trip)).withColumn("prev", F.lag("tail.t").over(trip))
             # the reading after the bucket's last move, the one before its first
             .withColumn("opened", F.when(~F.col("tail.stop"), F.col("next")).when(F.col("moves"), F.col("after")))
             .withColumn("closed", F.when(~F.col("head.stop"), F.col("prev")).when(F.col("moves"), F.col("ahead"))))
    begin = F.first(F.coalesce("second", "next") if ends_move else F.col("head.t")).over(whole)
    end = F.last(F.coalesce("second_last", "prev") if ends_move else F.col("tail.t")).over(whole)
    carry = edges.select(
        F.col(key).alias("__ck"), F.col("__b").alias("__cb"), F.lag("tail.leg").over(trip).alias("__leg_in"),
        F.col("prev").isNull().alias("__begins"), F.col("next").isNull().alias("__ends"),
        F.coalesce(F.last("opened", ignorenulls=True).over(trip.rowsBetween(Window.unboundedPreceding, -1)),
                   begin).alias("__start_in"),
        F.coalesce(F.first("closed", ignorenulls=True).over(trip.rowsBetween(1, Window.unboundedFollowing)),
                   end).alias("__end_in"))

    started = F.last("__after", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ended = F.first("__ahead", ignorenulls=True).over(w.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    rows = (beside(x).withColumn("__started", started).withColumn("__ended", ended)
            .withColumn("__before", F.lag("__leg").over(w)))
    first, last = F.col("__opens") & F.col("__begins"), F.col("__closes") & F.col("__ends")
    held = F.col("__stop") & ~first & ~last if ends_move else F.col("__stop")
    return (rows.join(carry, (F.col(key) == F.col("__ck")) & (F.col("__b") == F.col("__cb")), "left")
            .withColumn("__first", F.coalesce(first, F.lit(False))).withColumn("__last", F.coalesce(last, F.lit(False)))
            .withColumn("__new_leg", F.coalesce(~F.col("__leg").eqNullSafe(
                F.coalesce("__before", "__leg_in")) & F.col("__known"), F.lit(False)))
            .withColumn("__stop", F.coalesce(held, F.lit(False)))
            .withColumn("__run_start", F.when(F.col("__stop"), F.coalesce("__started", "__start_in")))
            .withColumn("__run_end", F.when(F.col("__stop"), F.coalesce("__ended", "__end_in")))
            .drop("__known", "__b", "__leg", "__opens", "__closes", "__after", "__ahead", "__started", "__ended",
                  "__before", "__ck", "__cb", "__leg_in", "__begins", "__ends", "__start_in", "__end_in"))


MARKS = ("__first", "__last", "__new_leg", "__stop", "__run_start", "__run_end")


def _route_leg(route_col: str) -> Column:
    return (F.col("progress") * (F.size(route_col) - 1)).cast("int")


def _typed(marked: DataFrame, route_col: str) -> DataFrame:
    k = F.size(route_col)
    seg = F.least(_route_leg(route_col), k - 2)
    etype = (F.when(F.col("__first"), F.lit("pickup")).when(F.col("__last"), F.lit("delivered"))
             .when(F.col("__new_leg"), F.lit("checkpoint")).otherwise(F.lit("temperature_reading")))
    label = (F.when(F.col("event_type") == "pickup", F.element_at(route_col, 1)["label"])
             .when(F.col("event_type") == "delivered", F.element_at(route_col, -1)["label"])
             .when(F.col("event_type") == "checkpoint",
                   F.element_at(route_col, F.least(seg + 1, k - 1) + 1)["label"]))
    return marked.withColumn("event_type", etype).withColumn("checkpoint", label)


def classify_event(points: DataFrame, key: str = "shipment_id", ts_col: str = "timestamp",
                   id_col: str = "event_id", route_col: str = "route") -> DataFrame:
    """T4 + T5 in (time, id) order of a shipment's readings: the first ->
    pickup, the last -> delivered, the first reading on a new route segment ->
    checkpoint, else temperature_reading; the checkpoint label is the first /
    last / next point's label."""
    marked = running(points, key, leg=_route_leg(route_col), ts_col=ts_col, id_col=id_col)
    return _typed(marked, route_col).drop(*MARKS)


# --- T7 -------------------------------------------------------------------
def temperature_alert(temp="temperature_celsius", zone="temperature_zone",
                      threshold: float = TEMP_BREACH_ABOVE):
    """(alert, detail) Columns: breach above the threshold, text with the
    value and the zone (2-6 when unknown)."""
    t = _c(temp)
    z = F.coalesce(_c(zone), F.lit(DEFAULT_ZONE)) if zone is not None else F.lit(DEFAULT_ZONE)
    alert = F.when(t > threshold, F.lit(TEMP_ALERT))
    detail = F.when(t > threshold, F.format_string(TEMP_DETAIL, t.cast("string"), z))
    return alert, detail


# --- T8 -------------------------------------------------------------------
def _minutes(start: str, end: str) -> Column:
    return F.timestamp_diff("MICROSECOND", F.col(start), F.col(end)) / F.lit(60_000_000.0)


def long_stops(df: DataFrame, key: str, stopped: Column, ts_col: str = "timestamp",
               id_col: str = "event_id", min_minutes: int = LONG_STOP_MINUTES,
               bucket_minutes: int = BUCKET_MINUTES) -> DataFrame:
    """Unbroken runs of stopped readings per key (in (ts, id) order) that
    last longer than ``min_minutes`` (last minus first stopped reading)."""
    narrow = df.select(key, ts_col, id_col, stopped.alias("__s"))
    marked = running(narrow, key, F.col("__s"), ts_col=ts_col, id_col=id_col, bucket_minutes=bucket_minutes)
    minutes = _minutes("__run_start", "__run_end")
    # runs over half an hour of one key differ in their start
    return (marked.filter(F.col("__stop") & (minutes > F.lit(float(min_minutes))))
            .groupBy(key, F.col("__run_start").alias("stop_start"), F.col("__run_end").alias("stop_end"))
            .agg(F.count(F.lit(1)).alias("n_points"))
            .withColumn("stop_minutes", _minutes("stop_start", "stop_end")))


def _alerted(marked: DataFrame, zone_col: str | None) -> DataFrame:
    long_ = F.col("__stop") & (_minutes("__run_start", "__run_end") > F.lit(float(LONG_STOP_MINUTES)))
    t_alert, t_detail = temperature_alert("temperature_celsius", zone_col)
    return (marked.withColumn("alert", F.coalesce(t_alert, F.when(long_, F.lit(STOP_ALERT))))
            .withColumn("alert_detail", F.coalesce(t_detail, F.when(long_, F.lit(STOP_DETAIL)))).drop(*MARKS))


def long_stop_alert(events: DataFrame, key: str = "shipment_id", ts_col: str = "timestamp",
                    id_col: str = "event_id", zone_col: str | None = None) -> DataFrame:
    """T7 + T8 on a tracking feed: a temperature above 6 gives
    ``temperature_breach``; otherwise a reading inside a mid-trip zero-speed
    run longer than 30 minutes gives ``long_stop``."""
    stopped = (F.col("speed_kmh") == 0) & ~F.col("event_type").isin("pickup", "delivered")
    return _alerted(running(events, key, stopped, ts_col=ts_col, id_col=id_col), zone_col)


# --- T9 -------------------------------------------------------------------
TRACKING_COLS = ["event_id", "shipment_id", "order_id", "event_type", "timestamp",
                 "latitude", "longitude", "temperature_celsius", "speed_kmh", "vehicle_plate",
                 "carrier", "driver_name", "checkpoint", "alert", "alert_detail"]


def trips(shipments: DataFrame, routes: DataFrame | None = None, address_col: str = "delivery_address",
          key: str = "shipment_id") -> DataFrame:
    """Shipments with their matched route (J6), written once: a row per
    shipment, which every pass over the feed then reads instead of matching
    again."""
    spark = shipments.sparkSession
    matched = match_route(shipments, routes if routes is not None else reference_routes(spark), address_col)
    return written(matched.filter(F.col(key).isNotNull()), "trips")


def tracking_events(feed: DataFrame, shipments: DataFrame, routes: DataFrame | None = None,
                    address_col: str = "delivery_address", bucket_minutes: int = BUCKET_MINUTES) -> DataFrame:
    """T1-T8 + J6 on the observed feed (event_id, shipment_id, timestamp,
    temperature_celsius, speed_kmh): each reading of a shipped shipment with
    its position on the route, event type, checkpoint and alert, all from one
    segmented scan of the feed."""
    s = shipments
    for c in ("vehicle_plate", "carrier", "driver_name", "temperature_zone"):
        if c not in s.columns:
            s = s.withColumn(c, F.lit(None).cast("string"))
    located = interpolate_route(observed_points(feed, trips(s, routes, address_col)))
    marked = running(located, "shipment_id", F.col("speed_kmh") == 0, _route_leg("route"), bucket_minutes=bucket_minutes,
                     ends_move=True)
    return _alerted(_typed(marked, "route"), "temperature_zone").select(*TRACKING_COLS)
