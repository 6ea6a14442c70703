import datetime as dt
import hashlib

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from orderflow.operators import tracking as TR
from tests.conftest import rows

T0 = dt.datetime(2024, 3, 1, 8)


def m(x):
    return T0 + dt.timedelta(minutes=x)


def feed(spark, data):
    return spark.createDataFrame(data, "event_id string, timestamp timestamp_ntz, shipment_id string, "
                                       "event_type string")


def test_filter_bounds_inclusive_exclusive(spark):
    f = feed(spark, [("a", m(-0.0167), "s", "pickup"), ("b", m(0), "s", "pickup"),
                     ("c", m(59.98), "s", "checkpoint"), ("d", m(60), "t", "checkpoint")])
    since, until = m(0).isoformat(" "), m(60).isoformat(" ")
    assert rows(TR.filter_tracking(f, since, until), "event_id") == [("b",), ("c",)]
    assert rows(TR.filter_tracking(f, "", None, "t", ""), "event_id") == [("d",)]
    assert rows(TR.filter_tracking(f, event_type="checkpoint", shipment_id="s"), "event_id") == [("c",)]


def test_page_and_pagination(spark):
    f = feed(spark, [(f"e{i:02d}", m(i // 2), "s", "x") for i in range(25)])
    p3 = [r.event_id for r in TR.page(f, 3, 10).collect()]
    assert p3 == [f"e{i:02d}" for i in range(20, 25)]
    assert TR.page(f, 4, 10).count() == 0                      # past the end
    pages = [r.event_id for p in (1, 2, 3) for r in TR.page(f, p, 10).collect()]
    assert pages == [r.event_id for r in TR.order_events(f).collect()]
    s = TR.pagination(f, 2, 10).first()
    assert (s.page, s.limit, s.total, s.pages) == (2, 10, 25, 3)
    e = TR.pagination(f.limit(0), 1, 10).first()
    assert (e.total, e.pages) == (0, 0)
    nxt = [r.event_id for r in TR.page_after(f, m(4).isoformat(" "), "e08", 3).collect()]
    assert nxt == ["e09", "e10", "e11"]


def test_validate_page():
    for bad in [(0, 10), (1, 0), (1, 1001)]:
        with pytest.raises(ValueError):
            TR.validate_page(*bad)
    TR.validate_page(1, 1000)


def test_match_route_first_city_and_defaults(spark):
    routes = TR.reference_routes(spark)
    df = spark.createDataFrame([
        ("1", None), ("2", ""), ("3", "г. Казань, ул. Баумана"),
        ("4", "Набережные Челны, пр. Мира"),
        ("5", "Зеленодольск и Нижнекамск"),       # two cities: the first in list order wins
    ], "id string, delivery_address string")
    got = {r.id: (r.route_city, r.route[-1].label) for r in
           TR.match_route(df, routes).collect()}
    assert got["1"] == (None, "Точка доставки") and got["2"] == (None, "Точка доставки")
    assert got["3"] == (None, "Точка доставки")
    assert got["4"] == ("Набережные Челны", "Набережные Челны, РЦ")
    assert got["5"] == ("Нижнекамск", "Нижнекамск")


@pytest.mark.parametrize("in_plan", [10_000, 3])
def test_match_route_with_many_cities(spark, monkeypatch, in_plan):
    monkeypatch.setattr(TR, "NAMES_IN_PLAN", in_plan)
    cities = [f"Город{i}" for i in range(300)] + ["Го", "Дальний"]
    routes = spark.createDataFrame([(c, i, [(1.0, 2.0, c)]) for i, c in enumerate(cities)],
                                   "city string, ord int, route array<struct<lat:double,lon:double,label:string>>")
    texts = [f"ул. {i}, {cities[i * 7 % 302]} и {cities[i * 11 % 302]}" for i in range(120)] + ["Г", "нигде", None]
    df = spark.createDataFrame([(i, a) for i, a in enumerate(texts)], "id int, delivery_address string")
    got = {r.id: r.route_city for r in TR.match_route(df, routes).collect()}
    assert got == {i: next((c for c in cities if a and c in a), None) for i, a in enumerate(texts)}


def py_readings(readings, shipped, end, route):
    """Brute-force reading of the rules over one shipment's readings."""
    minutes = max(60, int((end - shipped).total_seconds() / 60))
    k, out, before = len(route), [], None
    readings = sorted(readings, key=lambda r: (r[1], r[0]))
    for n, (i, ts) in enumerate(readings):
        progress = min(1.0, max(0.0, (ts - shipped).total_seconds() / (minutes * 60)))
        pos = progress * (k - 1)
        seg = min(int(pos), k - 2)
        lat = route[seg][0] + (route[seg + 1][0] - route[seg][0]) * (pos - seg)
        if n == 0:
            kind, label = "pickup", route[0][2]
        elif n == len(readings) - 1:
            kind, label = "delivered", route[-1][2]
        elif int(pos) != before:
            kind, label = "checkpoint", route[min(seg + 1, k - 1)][2]
        else:
            kind, label = "temperature_reading", None
        before = int(pos)
        out.append((i, round(lat, 6), kind, label))
    return out


SHIPMENT = ("shipment_id string, order_id string, shipped_at timestamp_ntz, estimated_arrival timestamp_ntz, "
            "actual_arrival timestamp_ntz, delivery_address string")


@pytest.mark.parametrize("minutes", [-90, 45, 451, 2000])
def test_observed_readings_match_brute_force(spark, minutes):
    route = [(a, b, c) for a, b, c in TR.REFERENCE_ROUTES[0][1]]
    readings = [(f"e{i:02d}", m(x)) for i, x in enumerate([-30, 0, 5, 40, 40, 61, 200, 333, 440, 900, 1999, 3000])]
    s = spark.createDataFrame([("SHP-1", "o1", T0, None, m(minutes), "в Набережные Челны"),
                               ("idle", "o2", None, None, None, "Елабуга")], SHIPMENT)
    f = spark.createDataFrame([(i, ts, "SHP-1", 3.0, 50) for i, ts in readings] + [("x", T0, "idle", 3.0, 0),
                                                                               ("y", T0, "unknown", 3.0, 0)],
                              "event_id string, timestamp timestamp_ntz, shipment_id string, "
                              "temperature_celsius double, speed_kmh int")
    ev = TR.tracking_events(f, s)
    assert ev.columns == TR.TRACKING_COLS
    got = [(r.event_id, r.latitude, r.event_type, r.checkpoint) for r in ev.orderBy("timestamp", "event_id").collect()]
    assert got == py_readings(readings, T0, m(minutes), route)
    p = TR.observed_points(f, s)
    assert p.filter("event_id = 'e00'").first().tracking_id == "TRK-" + hashlib.md5(b"SHP-1:e00").hexdigest()[:12].upper()


def test_a_hot_shipment_matches_brute_force_over_its_buckets(spark):
    """One shipment holds half of a feed of several days: types, labels and
    long stops equal one pass over each shipment's sorted readings."""
    import random
    rnd = random.Random(5)
    route = TR.REFERENCE_ROUTES[1][1]
    ships = ["hot"] + [f"s{i}" for i in range(12)]
    feed, n = [], 0
    for name in ships:
        for _ in range(360 if name == "hot" else 30):
            n += 1
            # many equal times, whole days without readings, long and short stops
            minute = rnd.choice([rnd.randrange(0, 300), rnd.randrange(2000, 2100), 5 * rnd.randrange(0, 1000)])
            feed.append((f"e{n:04d}", m(minute), name, float(rnd.choice([2, 7])), rnd.choice([0, 0, 0, 0, 40])))
    s = spark.createDataFrame([(x, x, T0, None, m(4000), "Нижнекамск") for x in ships], SHIPMENT)
    f = spark.createDataFrame(feed, "event_id string, timestamp timestamp_ntz, shipment_id string, "
                                    "temperature_celsius double, speed_kmh int")
    want = {}
    for name in ships:
        mine = sorted((r for r in feed if r[2] == name), key=lambda r: (r[1], r[0]))
        types = py_readings([(r[0], r[1]) for r in mine], T0, m(4000), route)
        events = [(name, r[1], r[0], r[4] == 0 and k[2] not in ("pickup", "delivered")) for r, k in zip(mine, types)]
        long_ = py_long_stops(events)
        # a stop belongs to the run whose readings surround it
        run, inside = [], set()
        for e in events + [None]:
            if e is not None and e[3]:
                run.append(e)
                continue
            if run and run[-1][1] - run[0][1] > dt.timedelta(minutes=30):
                inside |= {x[2] for x in run}
            run = []
        assert sum(x[3] for x in long_) == len(inside)
        for r, k in zip(mine, types):
            alert = "temperature_breach" if r[3] > 6 else "long_stop" if r[0] in inside else None
            want[r[0]] = (k[1], k[2], k[3], alert)
    for minutes in (60, 240, 10_000):
        got = {r.event_id: (r.latitude, r.event_type, r.checkpoint, r.alert)
               for r in TR.tracking_events(f, s, bucket_minutes=minutes).collect()}
        assert {k: v[1:] for k, v in got.items()} == {k: v[1:] for k, v in want.items()}
        assert max(abs(got[k][0] - want[k][0]) for k in want) < 2e-6
    assert any(w[3] == "long_stop" for w in want.values()) and any(w[1] == "checkpoint" for w in want.values())


def test_pages_by_position_at_any_depth(spark):
    f = feed(spark, [(f"e{i:04d}", m(i // 7), "s", "x") for i in range(1000)])
    index = TR.page_index(f, partitions=7)
    assert index.counts.agg(F.sum("n")).first()[0] == 1000 and index.counts.count() > 3
    want = [r.event_id for r in TR.order_events(f).collect()]
    for page, limit in ((1, 100), (5, 100), (10, 100), (11, 100), (3, 333), (1, 1000)):
        got = TR.page_of(index, page, limit)
        assert [r.event_id for r in got.collect()] == want[(page - 1) * limit:page * limit]
        assert got.columns == f.columns
    one = TR.page_of(index, 9, 10)
    assert len({p.split("_range=")[1].split("/")[0] for p in one.inputFiles()}) >= 1
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_range" in plan or "PartitionFilters: [_range" in plan, plan
    assert "SinglePartition" not in plan
    empty = TR.page_index(f.limit(0))
    assert TR.page_of(empty, 1, 10).collect() == []


def test_default_trip_end(spark):
    s = spark.createDataFrame([("b", "o", T0, None, None, None)], SHIPMENT)
    assert s.select(TR.trip_end(), TR.trip_minutes()).first() == (T0 + dt.timedelta(hours=6), 360)


def test_readings_without_key_or_time_keep_their_alert(spark):
    data = [(None, m(0), "a", "x", 0, 7.0), ("s", None, "b", "x", 0, 8.0), (None, None, "c", "x", 0, 1.0),
            ("s", m(0), "d", "x", 0, 1.0), ("s", m(40), "e", "x", 0, 1.0)]
    df = spark.createDataFrame(data, "shipment_id string, timestamp timestamp_ntz, event_id string, "
                                     "event_type string, speed_kmh int, temperature_celsius double")
    got = dict(rows(TR.long_stop_alert(df), "event_id", "alert"))
    assert got == {"a": "temperature_breach", "b": "temperature_breach", "c": None, "d": "long_stop", "e": "long_stop"}


def py_long_stops(events, minutes=30):
    out = []
    for key in sorted({e[0] for e in events}):
        ev = sorted((e for e in events if e[0] == key), key=lambda e: (e[1], e[2]))
        run = []
        for e in ev + [None]:
            if e is not None and e[3]:
                run.append(e)
                continue
            if run and (run[-1][1] - run[0][1]) > dt.timedelta(minutes=minutes):
                out.append((key, run[0][1], run[-1][1], len(run)))
            run = []
    return sorted(out)


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(0, 24 * 60 * 3),
                          st.booleans()), min_size=1, max_size=80))
def test_long_stops_match_brute_force(spark, data):
    events = [(k, m(t), f"e{i:03d}", s) for i, (k, t, s) in enumerate(data)]
    df = spark.createDataFrame(events, "k string, timestamp timestamp_ntz, event_id string, stop boolean")
    got = sorted((r.k, r.stop_start, r.stop_end, r.n_points) for r in
                 TR.long_stops(df, "k", F.col("stop"), bucket_minutes=90).collect())
    assert got == py_long_stops(events)


def test_long_stop_alert_and_temperature_priority(spark):
    data = [("s", m(0), "e0", "pickup", 0, 3.0), ("s", m(10), "e1", "temperature_reading", 0, 3.0),
            ("s", m(50), "e2", "temperature_reading", 0, 7.5), ("s", m(60), "e3", "checkpoint", 60, 3.0),
            ("s", m(70), "e4", "delivered", 0, 3.0)]
    df = spark.createDataFrame(data, "shipment_id string, timestamp timestamp_ntz, event_id string, "
                                     "event_type string, speed_kmh int, temperature_celsius double")
    got = {r.event_id: (r.alert, r.alert_detail) for r in TR.long_stop_alert(df).collect()}
    assert got["e1"] == ("long_stop", "Простой > 30 мин")
    assert got["e2"] == ("temperature_breach", "Температура 7.5 превышает норму 2-6")
    assert got["e0"] == (None, None) and got["e3"] == (None, None) and got["e4"] == (None, None)


def test_tracking_envelope(spark):
    import datetime as _dt
    f = feed(spark, [(f"e{i:02d}", m(i), "s" if i % 2 else "t", "x") for i in range(25)])
    f = f.withColumn("alert", F.when(F.col("event_id") < "e05", F.lit("long_stop")))
    env = TR.tracking_envelope(f, 2, 10, now=_dt.datetime(2024, 1, 1)).first()
    assert [e.event_id for e in env.data] == [f"e{i:02d}" for i in range(10, 20)]
    assert tuple(env.pagination) == (2, 10, 25, 3) and env.timestamp == "2024-01-01T00:00:00"
    a = TR.tracking_envelope(f, 1, 100, alerts_only=True).first()
    assert [e.event_id for e in a.data] == ["e00", "e01", "e02", "e03", "e04"]
    s = TR.tracking_envelope(f, 1, 100, shipment_id="s", since=m(10).isoformat(" ")).first()
    assert s.pagination.total == 7
    past = TR.tracking_envelope(f, 9, 10).first()
    assert past.data == [] and past.pagination.pages == 3
