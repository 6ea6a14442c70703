import datetime as dt
import json
import os
import re
import time

import pytest
from pyspark.sql import functions as F

from orderflow.operators import changes as C
from orderflow.plans import jobs
from orderflow.schemas import TRACKING_EVENT
from orderflow.sources import readers as R, sinks as K, state as W, versions as V
from orderflow.streaming import streams as ST
from tests.conftest import rows

SCHEMA = "event_id string, timestamp timestamp_ntz, shipment_id string, event_type string, note string"


def ev(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def t(h, us=0):
    return dt.datetime(2024, 3, 14, 0) + dt.timedelta(hours=h, microseconds=us)


def test_source_options_defaults_and_parquet():
    s = R.source_options({})
    assert s.url == "jdbc:postgresql://localhost:5432/orders" and s.options["user"] == "admin"
    assert s.table_name("orders") == "source.orders"
    e = R.source_options({"ORDERFLOW_SOURCE_HOST": "db", "ORDERFLOW_SOURCE_DB": "sales"})
    assert e.url == "jdbc:postgresql://db:5432/sales"
    p = R.source_options({"ORDERFLOW_SOURCE_PARQUET_ROOT": "/data"})
    assert p.kind == "parquet" and p.root == "/data"


def test_extract_window_partition_and_idempotent_rerun(spark, tmp):
    src_root = f"{tmp}/src"
    data = [("a", t(-0.001), "s", "x", None), ("b", t(0), "s", "x", None),
            ("c", t(23.99), "s", "x", None), ("d", t(24), "s", "x", None)]
    ev(spark, data).withColumnRenamed("timestamp", "event_timestamp").write.parquet(f"{src_root}/events")
    spark.createDataFrame([("c1",)], "customer_id string").write.parquet(f"{src_root}/customers")
    src = R.Source(kind="parquet", root=src_root)
    specs = [R.TableSpec("events", "incremental", "event_timestamp"),
             R.TableSpec("customers", "snapshot")]
    out = f"{tmp}/raw"
    for _ in range(2):
        written = jobs.extract(spark, src, out, "2024-03-15", specs)
    assert written["events"].endswith("events/data_date=2024-03-14")
    assert rows(spark.read.parquet(f"{out}/events"), "event_id") == [("b",), ("c",)]
    with pytest.raises(ValueError):
        R.extract_table(spark, src, R.TableSpec("x", "weird"), "2024-03-15")
    # an empty day clears its partition folder
    K.write_partition(ev(spark, []), out, "events", "2024-03-14")
    assert spark.read.parquet(f"{out}/events/data_date=2024-03-14").count() == 0


def test_land_jsonl_keeps_microseconds_and_nulls(spark, tmp):
    path = K.land_jsonl(ev(spark, [("a", t(1, 123456), "s", "x", None)]), tmp, "2024-03-15", "B1")
    lines = [ln for f in sorted(os.listdir(path)) if f.endswith(".json")
             for ln in open(os.path.join(path, f)).read().splitlines() if ln.strip()]
    assert len(lines) == 1
    doc = json.loads(lines[0])
    assert doc["timestamp"] == "2024-03-14T01:00:00.123456" and "note" in doc
    back = R.read_landed_tracking(spark, tmp, R.T.StructType.fromDDL(SCHEMA))
    r = back.first()
    assert r.timestamp == t(1, 123456) and r.dt == dt.date(2024, 3, 15)


def test_watermark_state_and_incremental_pull(spark, tmp):
    state, landing = f"{tmp}/state", f"{tmp}/landing"
    assert W.load_watermark(spark, state) is None
    assert W.resolve_since(None, "2024-01-01T00:00:00") == "2024-01-01T00:00:00"
    early = ev(spark, [("a", t(1), "s", "x", None), ("b", t(2), "s", "x", None)])
    full = early.unionByName(ev(spark, [("c", t(3), "s", "x", None)]))
    r1 = W.incremental_pull(spark, early, state, landing, "2024-03-14", "B1")
    assert r1["since"] is None and r1["watermark"] == t(2).isoformat()
    assert W.has_new_data(full, r1["watermark"])
    r2 = W.incremental_pull(spark, full, state, landing, "2024-03-15", "B2")
    assert r2["since"] == t(2).isoformat()
    landed = R.read_landed_tracking(spark, landing, R.T.StructType.fromDDL(SCHEMA))
    assert sorted(r.event_id for r in landed.collect()) == ["a", "b", "b", "c"]   # inclusive bound
    d = W.dedupe_events(landed)
    assert rows(d, "event_id", "dt") == [("a", dt.date(2024, 3, 14)), ("b", dt.date(2024, 3, 14)),
                                          ("c", dt.date(2024, 3, 15))]
    # nothing new after the watermark: no file, state unchanged
    r3 = W.incremental_pull(spark, early, state, landing, "2024-03-16", "B3")
    assert r3["landed"] is None and W.load_watermark(spark, state) == t(3).isoformat()


def test_page_envelopes_validation_and_stop(spark, tmp):
    def page(n, ids, pages):
        return {"data": [{"event_id": i, "shipment_id": "s", "order_id": "o", "event_type": "pickup",
                          "timestamp": "2024-03-14T01:00:00", "latitude": 1.0, "longitude": 2.0,
                          "temperature_celsius": 3.0, "speed_kmh": 0} for i in ids],
                "pagination": {"page": n, "limit": 2, "total": 5, "pages": pages}}
    good = f"{tmp}/good"
    os.makedirs(good)
    with open(f"{good}/p.json", "w") as f:
        for p in [page(1, ["a", "b"], 4), page(2, ["c"], 4), page(3, [], 4), page(4, ["z"], 4)]:
            f.write(json.dumps(p) + "\n")
    got = R.read_page_envelopes(spark, good, TRACKING_EVENT)
    assert sorted(r.event_id for r in got.collect()) == ["a", "b", "c"]     # stops at the empty page
    bad = f"{tmp}/bad"
    os.makedirs(bad)
    with open(f"{bad}/p.json", "w") as f:
        f.write(json.dumps({"data": []}) + "\n")
    with pytest.raises(Exception, match="need data and pagination"):
        R.read_page_envelopes(spark, bad, TRACKING_EVENT).collect()


def test_stream_tracking_dedupes_across_runs(spark, tmp):
    schema = R.T.StructType.fromDDL(SCHEMA)
    landing, out, ck = f"{tmp}/landing", f"{tmp}/out", f"{tmp}/ck"
    K.land_jsonl(ev(spark, [("a", t(1), "s", "x", None), ("b", t(2), "s", "x", None)]), landing, "d1", "1")
    ST.stream_tracking(spark, landing, out, ck, schema)
    K.land_jsonl(ev(spark, [("b", t(2), "s", "x", None), ("c", t(3), "s", "x", None)]), landing, "d2", "2")
    ST.stream_tracking(spark, landing, out, ck, schema)
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == ["a", "b", "c"]


@pytest.mark.parametrize("layout", [V.Layout(buckets=8), V.Layout("made")])
def test_stream_upsert_rewrites_touched_partitions_only(spark, tmp, layout):
    schema = R.T.StructType.fromDDL("id int, status string, made timestamp_ntz, event_timestamp timestamp_ntz")
    changes, base, ck = f"{tmp}/changes", f"{tmp}/table", f"{tmp}/ck"
    n = 40

    def made(i):
        return dt.datetime(2024, 1 + i % 6, 1)
    spark.createDataFrame([(i, "new", made(i), t(1)) for i in range(n)], schema).write.json(changes)
    ST.stream_upsert(spark, changes, schema, base, ["id"], ["status"], ck, layout=layout)
    before = V.current(spark, base).tables[ST.STREAM_TABLE].folders
    late = [(2, "confirmed", made(2), t(2)), (2, "assembled", made(2), t(3)), (n, "new", made(2), t(3))]
    spark.createDataFrame(late, schema).write.mode("append").json(changes)
    ST.stream_upsert(spark, changes, schema, base, ["id"], ["status"], ck, layout=layout)
    after = V.current(spark, base)
    assert after.number == 2
    touched = {r[0] for r in spark.createDataFrame(late, schema).select(layout.part(["id"])).collect()}
    assert {p for p, f in after.tables[ST.STREAM_TABLE].folders.items() if before.get(p) != f} == touched
    want = [(i, "assembled" if i == 2 else "new") for i in range(n + 1)]
    assert sorted((r.id, r.status) for r in ST.read_upserted(spark, base).collect()) == want


def test_a_recent_batch_rewrites_its_months_only(spark, tmp):
    layout, base = V.Layout("made"), f"{tmp}/db"
    rows_ = (spark.range(6000).select(F.col("id"), F.lit("new").alias("status"), F.make_timestamp_ntz(
        F.lit(2022) + (F.col("id") % 24 / 12).cast("int"), F.col("id").cast("int") % 12 + 1, F.lit(3), F.lit(0), F.lit(0),
        F.lit(0)).alias("made")))
    table = V.write_table(base, "x", rows_, ["id"], layout)
    V.publish(spark, base, {"x": table}, None)
    assert len(table.folders) == 24
    # 250 known orders of the last month and 750 new ones of the month after
    recent = rows_.filter("date_format(made, 'yyyy-MM') = '2023-12'").withColumn("status", F.lit("done"))
    fresh = spark.range(6000, 6750).select("id", F.lit("new").alias("status"), F.lit(dt.datetime(2024, 1, 5)).cast(
        "timestamp_ntz").alias("made"))
    batch = recent.unionByName(fresh)
    assert V.touched_parts(table, batch, ["id"], layout) != [] and recent.count() == 250
    seen = {}

    def merge(old, c):
        seen["read"] = {f.split("_part=")[1][:7] for f in old.inputFiles()}
        return C.upsert(old, c, ["id"], ["status"])
    new = V.merge_table(base, "x", table, batch, ["id"], merge, layout)
    assert seen["read"] == {"2023-12"}                         # no other month's data is read
    assert {p for p, f in new.folders.items() if table.folders.get(p) != f} == {"2023-12", "2024-01"}
    V.publish(spark, base, {"x": new}, V.current(spark, base))
    got = V.read(spark, base, "x")
    assert got.count() == 6750 and got.filter("status = 'done'").count() == 250
    # only keys and folders are read to find the partitions
    keys = V.rows_of(spark, new, with_part=True).select("id", V.PART)
    plan = keys._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<id:bigint>" in plan


def test_a_row_that_changes_its_month_leaves_the_old_one(spark, tmp):
    layout, base = V.Layout("at"), f"{tmp}/db"
    schema = "id int, at timestamp_ntz"
    old = V.write_table(base, "x", spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 2)), (2, dt.datetime(2024, 2, 2)), (3, None)], schema), ["id"], layout)
    moved = spark.createDataFrame([(1, dt.datetime(2024, 3, 2)), (3, dt.datetime(2024, 2, 9))], schema)
    new = V.merge_table(base, "x", old, moved, ["id"], lambda o, c: C.upsert(o, c, ["id"]), layout)
    assert sorted(new.folders) == ["2024-02", "2024-03"]       # January and 'none' are empty now
    assert rows(V.rows_of(spark, new), "id") == [(1,), (2,), (3,)]


def test_insert_ignore_adds_files_only(spark, tmp):
    layout, base = V.Layout("at"), f"{tmp}/db"
    schema = "id int, at timestamp_ntz"
    old = V.write_table(base, "x", spark.createDataFrame([(1, dt.datetime(2024, 1, 2))], schema), ["id"], layout)
    batch = spark.createDataFrame([(1, dt.datetime(2024, 5, 1)), (2, dt.datetime(2024, 1, 5)),
                                   (2, dt.datetime(2024, 1, 5))], schema)
    new = V.append_table(base, "x", old, batch, ["id"], lambda k, c: C.unseen(k, c, ["id"]), layout)
    assert new.folders["2024-01"][0] == old.folders["2024-01"][0] and len(new.folders["2024-01"]) == 2
    assert rows(V.rows_of(spark, new), "id") == [(1,), (2,)]


def test_a_damaged_pointer_fails_and_keeps_the_version(spark, tmp):
    base = f"{tmp}/db"
    assert V.current(spark, base) is None
    df = spark.createDataFrame([(1, "a")], "id int, s string")
    table = V.write_table(base, "x", df, ["id"], V.Layout(buckets=4))
    V.publish(spark, base, {"x": table}, None)
    with pytest.raises(Exception, match="(?i)exists"):          # a second writer with the same base
        V.publish(spark, base, {"x": table}, None)
    os.makedirs(f"{base}/_versions/000000000002")
    with open(f"{base}/_versions/000000000002/part-0.json", "w") as f:
        f.write('{"version": 2, "table"')
    with pytest.raises(Exception):
        V.merge_table(base, "x", V.current(spark, base).tables["x"], df, ["id"], lambda o, c: c, V.Layout(buckets=4))
    os.replace(f"{base}/_versions/000000000002/part-0.json", f"{base}/_damaged")
    assert rows(V.read(spark, base, "x")) == [(1, "a")]
    os.makedirs(f"{tmp}/empty/_versions")
    with pytest.raises(RuntimeError, match="no readable pointer"):
        V.current(spark, f"{tmp}/empty")


def test_a_large_partition_is_written_by_several_tasks(spark, tmp):
    df = spark.range(0, 20_000, numPartitions=8).select("id", F.sha2(F.col("id").cast("string"), 512).alias("s"))
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "100k")
    try:
        table = V.write_table(f"{tmp}/db", "x", df, ["id"], V.Layout(buckets=2))
    finally:
        spark.conf.unset(size)
    assert sorted(table.folders) == ["h0", "h1"]
    assert all(len([f for f in os.listdir(p) if f.endswith(".parquet")]) > 1 for (p,) in table.folders.values())
    V.publish(spark, f"{tmp}/db", {"x": table}, None)
    assert V.read(spark, f"{tmp}/db", "x").agg(F.count_distinct("id"), F.count("s")).first()[:] == (20_000, 20_000)


def test_empty_tables_keep_their_schema(spark, tmp):
    df = spark.createDataFrame([], "id int, s string")
    V.publish(spark, f"{tmp}/db", {"x": V.write_table(f"{tmp}/db", "x", df, ["id"])}, None)
    back = V.read(spark, f"{tmp}/db", "x")
    assert back.count() == 0 and back.columns == ["id", "s"]


def test_late_events_go_to_the_late_sink_once(spark, tmp):
    schema = R.T.StructType.fromDDL(SCHEMA)
    landing, out, late, ck = (f"{tmp}/{x}" for x in ("landing", "out", "late", "ck"))
    K.land_jsonl(ev(spark, [("new1", t(100), "s", "x", None), ("new2", t(101), None, "x", None)]), landing, "d1", "1")
    ST.stream_tracking(spark, landing, out, ck, schema, lateness="1 hour", late_out=late)
    old = [(f"old{i}", t(i), "s", "x", None) for i in range(5)]
    K.land_jsonl(ev(spark, old + old[:2] + [("new1", t(100), "s", "x", None)]), landing, "d2", "2")
    for _ in range(2):
        ST.stream_tracking(spark, landing, out, ck, schema, lateness="1 hour", late_out=late)
    written = sorted(r.event_id for r in spark.read.parquet(out).collect())
    behind = sorted(r.event_id for r in spark.read.parquet(late).collect())
    assert sorted(written + behind) == ["new1", "new2"] + [f"old{i}" for i in range(5)] and len(behind) == 5


def test_pages_of_an_empty_pull_do_not_stop_another(spark, tmp):
    def page(n, ids, pages):
        return {"data": [{"event_id": i} for i in ids],
                "pagination": {"page": n, "limit": 2, "total": 6, "pages": pages}, "timestamp": "x"}
    for folder, pages in (("a", [page(1, ["e1", "e2"], 3), page(2, ["e3", "e4"], 3), page(3, ["e5", "e6"], 3)]),
                          ("b", [page(1, [], 1)])):
        os.makedirs(f"{tmp}/pages/{folder}")
        with open(f"{tmp}/pages/{folder}/p.json", "w") as f:
            f.writelines(json.dumps(p) + "\n" for p in pages)
    got = R.read_page_envelopes(spark, f"{tmp}/pages/*", R.T.StructType.fromDDL("event_id string"))
    assert sorted(r.event_id for r in got.collect()) == [f"e{i}" for i in range(1, 7)]


def test_jdbc_options_split_tables(spark):
    src = R.Source(kind="jdbc", url="jdbc:x", schema="s", options={"user": "u"})
    part = {"column": "id", "lowerBound": 0, "upperBound": 100, "numPartitions": 4}
    o = R.jdbc_options(src, "customers", part)
    assert o["dbtable"] == "s.customers" and o["user"] == "u"
    assert (o["partitionColumn"], o["lowerBound"], o["upperBound"], o["numPartitions"]) == ("id", "0", "100", "4")
    assert "partitionColumn" not in R.jdbc_options(src, "customers")


def test_ingest_gate(spark, tmp):
    feed = ev(spark, [("a", t(1), "s", "x", None)])
    first = jobs.ingest_tracking(spark, feed, f"{tmp}/l", f"{tmp}/s", "2024-03-14")
    assert first["landed"] and first["watermark"] == t(1).isoformat()
    none = jobs.ingest_tracking(spark, feed.limit(0), f"{tmp}/l", f"{tmp}/s", "2024-03-15")
    assert none == {"since": t(1).isoformat(), "landed": None, "watermark": t(1).isoformat()}


def test_late_rows(spark):
    src = ev(spark, [("a", t(1), "s", "x", None), ("b", t(2), "s", "x", None)])
    landed = src.filter(F.col("event_id") == "a")
    assert rows(ST.late_rows(src, landed, ["event_id"]), "event_id") == [("b",)]


def test_window_partitions_for_parallel_jdbc_reads():
    s, e, _ = R.day_window("2024-03-15")
    p = R.window_partitions("event_timestamp", s, e, 24)
    assert p == {"column": "event_timestamp", "lowerBound": "2024-03-14 00:00:00",
                 "upperBound": "2024-03-15 00:00:00", "numPartitions": 24}
    with pytest.raises(ValueError):
        R.window_partitions("ts", s, e, 0)


def test_stream_tracking_in_bounded_batches(spark, tmp):
    schema = R.T.StructType.fromDDL(SCHEMA)
    landing, out, ck = f"{tmp}/landing", f"{tmp}/out", f"{tmp}/ck"
    for i in range(3):
        K.land_jsonl(ev(spark, [(f"e{i}", t(i), "s", "x", None), ("dup", t(0), "s", "x", None)]),
                     landing, f"d{i}", str(i))
    q = ST.stream_tracking(spark, landing, out, ck, schema, max_files=1)
    assert sorted(r.event_id for r in spark.read.parquet(out).collect()) == ["dup", "e0", "e1", "e2"]
    assert len(q.recentProgress) >= 3


def test_a_lookback_replaces_the_folders_of_its_days(spark, tmp):
    def day(d):
        return dt.datetime(2024, 3, d, 5)
    table = spark.createDataFrame([(1, day(10)), (2, day(11)), (3, day(13))], "id int, ts timestamp_ntz")
    K.write_days(table, tmp, "t", "ts", dt.datetime(2024, 3, 10), dt.datetime(2024, 3, 14))
    fixed = spark.createDataFrame([(2, day(11)), (9, day(11)), (8, day(12))], "id int, ts timestamp_ntz")
    paths = K.write_days(fixed, tmp, "t", "ts", dt.datetime(2024, 3, 11), dt.datetime(2024, 3, 14))
    assert [p[-10:] for p in paths] == ["2024-03-11", "2024-03-12", "2024-03-13"]
    got = spark.read.parquet(f"{tmp}/t")
    assert rows(got, "id", "data_date") == [(1, dt.date(2024, 3, 10)), (2, dt.date(2024, 3, 11)),
                                            (8, dt.date(2024, 3, 12)), (9, dt.date(2024, 3, 11))]   # the 13th is cleared


def test_reconciliation_reads_new_files_and_their_days(spark, tmp):
    schema = R.T.StructType.fromDDL(SCHEMA)
    landing, out, ck = f"{tmp}/landing", f"{tmp}/out", f"{tmp}/ck"
    K.land_jsonl(ev(spark, [(f"d{i}", t(24 * i), "s", "x", None) for i in range(40)]), landing, "d1", "1")
    files = sorted(os.path.join(d, f) for d, _, fs in os.walk(landing) for f in fs if f.endswith(".json"))
    for i, f in enumerate(files):
        os.utime(f, (time.time() - 7200 + (i == 0) * 3600,) * 2)       # one file is the newest
    ST.stream_tracking(spark, landing, out, ck, schema, lateness="1 hour")
    mark = W.load_watermark(spark, f"{ST.late_sink(out)}/_reconciled")
    assert mark is not None and len(files) > 1
    # a day later: one new event, and one that is 30 days late
    K.land_jsonl(ev(spark, [("new", t(24 * 40), "s", "x", None), ("late", t(24 * 9 + 1), "s", "x", None)]), landing, "d2", "2")
    _, missing = ST.late_events(spark, landing, out, ST.late_sink(out), schema, since=mark)
    plan = missing._jdf.queryExecution().executedPlan().toString()
    read = {f for f in missing.inputFiles() if "/landing/" in f}
    assert {f.split("/landing/")[1].split("/")[0] for f in read} == {"dt=d1", "dt=d2"}
    assert sum("/dt=d1/" in f for f in read) == 1              # the overlap of a second: the newest file
    assert "event_day" in "".join(re.findall(r"PartitionFilters: \[[^\n]*", plan)), plan
    ST.stream_tracking(spark, landing, out, ck, schema, lateness="1 hour")
    got = sorted(r.event_id for r in ST.read_tracking(spark, out, schema).collect())
    assert got == sorted([f"d{i}" for i in range(40)] + ["new", "late"])
    assert [r.event_id for r in spark.read.schema(schema).parquet(ST.late_sink(out)).collect()] == ["late"]
    ST.stream_tracking(spark, landing, out, ck, schema, lateness="1 hour")       # nothing new: nothing is added
    assert ST.read_tracking(spark, out, schema).count() == 42


def test_a_pull_observes_its_watermark(spark, tmp):
    feed = ev(spark, [("a", t(1), "s", "x", None), ("b", t(3, us=100_000), "s", "x", None)])
    got = W.incremental_pull(spark, feed, f"{tmp}/state", f"{tmp}/landing", "2024-03-14", "1")
    assert got["rows"] == 2 and dt.datetime.fromisoformat(got["watermark"]) == t(3, us=100_000)
    assert W.load_watermark(spark, f"{tmp}/state") == got["watermark"]


def test_the_state_keeps_two_documents(spark, tmp):
    path = f"{tmp}/state"
    assert W.load_watermark(spark, path) is None
    for i in range(5):
        W.save_watermark(spark, path, f"2024-03-0{i + 1}T00:00:00", dt.datetime(2024, 3, 9, i))
        assert W.load_watermark(spark, path) == f"2024-03-0{i + 1}T00:00:00"
    kept = spark.read.option("recursiveFileLookup", "true").json(path)
    assert kept.count() == 2 and sorted(os.listdir(path)) == ["slot=a", "slot=b"]
