import datetime as dt

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from orderflow.operators import changes as C
from tests.conftest import rows

SCHEMA = "id int, status string, pallets int, note string"


def test_upsert_inserts_updates_only_named_columns_and_nulls_overwrite(spark):
    target = spark.createDataFrame([(1, "new", 3, "keep"), (2, "new", 5, "keep")], SCHEMA)
    changes = spark.createDataFrame([(2, "delivered", None, "ignored"), (3, "new", 1, "fresh")],
                                    SCHEMA)
    out = C.upsert(target, changes, ["id"], ["status", "pallets"])
    assert rows(out) == [(1, "new", 3, "keep"), (2, "delivered", None, "keep"),
                         (3, "new", 1, "fresh")]


def test_upsert_rejects_a_key_twice_in_one_batch(spark):
    target = spark.createDataFrame([(1, "new", 3, "x")], SCHEMA)
    changes = spark.createDataFrame([(1, "a", 1, "x"), (1, "b", 2, "x")], SCHEMA)
    with pytest.raises(Exception, match="more than once"):
        C.upsert(target, changes, ["id"], ["status"]).collect()


def test_upsert_twice_equals_once(spark):
    target = spark.createDataFrame([(i, "new", i, "t") for i in range(6)], SCHEMA)
    changes = spark.createDataFrame([(i, "done", None, "c") for i in range(3, 9)], SCHEMA)
    once = C.upsert(target, changes, ["id"], ["status", "pallets"])
    twice = C.upsert(once, changes, ["id"], ["status", "pallets"])
    assert rows(once) == rows(twice)


def test_insert_ignore_keeps_first_and_is_idempotent(spark):
    target = spark.createDataFrame([(1, "old", 0, "t")], SCHEMA)
    batch = spark.createDataFrame([(1, "dup", 9, "b"), (2, "b", 2, "x"), (2, "a", 1, "x")], SCHEMA)
    once = C.insert_ignore(target, batch, ["id"], ["pallets"])
    assert rows(once) == [(1, "old", 0, "t"), (2, "a", 1, "x")]
    assert rows(C.insert_ignore(once, batch, ["id"], ["pallets"])) == rows(once)


def test_update_by_key_ignores_unknown_keys(spark):
    target = spark.createDataFrame([(1, "new", 3, "t"), (2, "new", 4, "t")], SCHEMA)
    ch = spark.createDataFrame([(2, "confirmed"), (7, "confirmed")], "id int, status string")
    assert rows(C.update_by_key(target, ch, ["id"], ["status"])) == [
        (1, "new", 3, "t"), (2, "confirmed", 4, "t")]


def test_current_state_latest_event_then_partition(spark):
    d1, d2 = dt.date(2024, 1, 1), dt.date(2024, 1, 2)
    t1, t2 = dt.datetime(2024, 1, 1, 10), dt.datetime(2024, 1, 1, 12)
    landed = spark.createDataFrame(
        [("o1", "new", t1, d1), ("o1", "confirmed", t2, d1), ("o1", "assembled", t2, d2),
         ("o2", "new", t1, d1)],
        "order_id string, status string, event_timestamp timestamp_ntz, data_date date")
    assert rows(C.current_state(landed, ["order_id"]), "order_id", "status") == [
        ("o1", "assembled"), ("o2", "new")]


def test_first_per_key_total_order(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "z"), ("a", 1, "y"), ("b", 5, "q")],
                               "k string, ord int, v string")
    assert rows(C.first_per_key(df, ["k"], ["ord"])) == [("a", 1, "y"), ("b", 5, "q")]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 50)), min_size=0, max_size=60),
       st.integers(1, 4))
def test_top_n_per_key_matches_brute_force(spark, data, n):
    df = spark.createDataFrame(data or [(0, 0)], "k int, v int")
    if not data:
        df = df.limit(0)
    got = sorted(tuple(r) for r in C.top_n_per_key(df, ["k"], "v", n).collect())
    want = []
    for k in {k for k, _ in data}:
        want += [(k, v) for v in sorted(v for kk, v in data if kk == k)[:n]]
    assert got == sorted(want)


def test_top_n_salted_path_matches_single_stage(spark):
    df = spark.range(0, 400).select((F.col("id") % 3).alias("k"), (F.col("id") * 7 % 101).alias("v"),
                                    F.col("id"))
    spark.conf.set("spark.sql.optimizer.windowGroupLimitThreshold", "2")
    try:
        salted = rows(C.top_n_per_key(df, ["k"], "v", 5, ["id"]))
    finally:
        spark.conf.unset("spark.sql.optimizer.windowGroupLimitThreshold")
    assert salted == rows(C.top_n_per_key(df, ["k"], "v", 5, ["id"]))


def test_sample_per_key_is_reproducible_without_replacement(spark):
    df = spark.createDataFrame([(k, i) for k in range(3) for i in range(10)], "k int, i int")
    a = rows(C.sample_per_key(df, ["k"], 3, "seed", ["k", "i"]))
    b = rows(C.sample_per_key(df, ["k"], 3, "seed", ["k", "i"]))
    assert a == b and len(a) == 9 and len(set(a)) == 9
    assert rows(C.sample_per_key(df, ["k"], 3, "other", ["k", "i"])) != a


def test_bounded_sample_size_rules():
    assert C.bounded_sample_size(5) == 5          # fewer than 10 rows: capped, no failure
    assert C.bounded_sample_size(30) == 10
    assert C.bounded_sample_size(200) == 40
    assert C.bounded_sample_size(1000) == 60


def test_sample_bounded_small_population(spark):
    df = spark.createDataFrame([(i,) for i in range(7)], "id int")
    assert C.sample_bounded(df, "s", ["id"]).count() == 7


def test_load_modes(spark):
    t = spark.createDataFrame([(1, "a", 1, "t")], SCHEMA)
    b = spark.createDataFrame([(1, "b", 2, "u"), (2, "c", 3, "v")], SCHEMA)
    assert rows(C.load("historical", t, b, ["id"])) == rows(b)
    assert rows(C.load("incremental", t, b, ["id"], ["status"])) == [(1, "b", 1, "t"),
                                                                    (2, "c", 3, "v")]
    with pytest.raises(ValueError):
        C.load("sideways", t, b, ["id"])


def test_append_batches_by_name(spark):
    a = spark.createDataFrame([(1, "x")], "id int, v string")
    b = spark.createDataFrame([("y", 2)], "v string, id int")
    assert rows(C.append_batches([a, b])) == [(1, "x"), (2, "y")]


def test_insert_ignore_onto_repeated_target_keys(spark):
    # one target key repeated many times, a batch that knows it and one that does not
    target = spark.createDataFrame([(1, "t", i, "x") for i in range(50)] + [(2, "t", 0, "x")], SCHEMA)
    batch = spark.createDataFrame([(i % 5, f"b{i}", i, "y") for i in range(20)], SCHEMA)
    out = C.insert_ignore(target, batch, ["id"], ["pallets"])
    assert out.count() == 51 + 3
    assert rows(out.filter("note = 'y'"), "id", "pallets") == [(0, 0), (3, 3), (4, 4)]


def test_duplicate_new_key_raises(spark):
    target = spark.createDataFrame([(1, "new", 3, "x")], SCHEMA)
    dup_new = spark.createDataFrame([(5, "a", 1, "x"), (5, "b", 2, "x")], SCHEMA)
    for cols in (["status"], []):
        with pytest.raises(Exception, match="more than once"):
            C.upsert(target, dup_new, ["id"], cols).collect()


def test_pick_per_key_with_a_map_payload(spark):
    df = spark.createDataFrame([("a", 2, {"x": 1}), ("a", 1, {"y": 2}), ("a", 1, {"b": 3}), ("b", None, None)],
                               "k string, ord int, m map<string,int>")
    first = {r.k: r.m for r in C.first_per_key(df, ["k"], ["ord"]).collect()}
    assert first == {"a": {"b": 3}, "b": None}
    last = {r.k: r.ord for r in C.pick_per_key(df, ["k"], ["ord"], latest=True).collect()}
    assert last == {"a": 2, "b": None}


def test_ids_keep_the_whole_digest_and_the_status_time(spark):
    from orderflow.functions import ids
    from orderflow.operators.lifecycle import status_event_id
    df = spark.createDataFrame([("o1", "delayed", dt.datetime(2024, 1, 1)), ("o1", "delayed", dt.datetime(2024, 1, 2))],
                               "k string, s string, t timestamp_ntz")
    got = [r[0] for r in df.select(status_event_id("k", "s", "t")).collect()]
    assert len(set(got)) == 2 and all(len(x) == 3 + 32 for x in got)
    assert df.select(ids.keyed_id("PAY", "k")).first()[0].startswith("PAY-")


def test_events_that_share_an_id_text_are_both_kept(spark):
    from orderflow.sources.state import dedupe_events
    t = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame([("TRK-1", "s1", t, "2024-01-01"), ("TRK-1", "s2", t, "2024-01-01"),
                                ("TRK-1", "s1", t, "2024-01-02")],
                               "event_id string, shipment_id string, timestamp timestamp_ntz, dt string")
    assert rows(dedupe_events(df), "shipment_id", "dt") == [("s1", "2024-01-01"), ("s2", "2024-01-01")]
