"""Plan-shape tests: the scale properties the operators rely on."""

import os
import re

import pytest
from pyspark.sql import functions as F

from orderflow.operators import changes as C
from orderflow.operators import tracking as TR

SMOKE = "/root/testdata/sf0.001"


def plan(df) -> str:
    """The physical plan as ``explain()`` prints it."""
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain()
    return buf.getvalue()


def skewed(spark, n=3000):
    # one key holds a third of all rows
    return spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        (F.col("id") * 7919 % 1000).alias("v"), F.col("id"))


def test_pick_per_key_limits_before_the_shuffle(spark):
    p = plan(C.first_per_key(skewed(spark), ["k"], ["v"]))
    assert p.count("WindowGroupLimit") == 2, p                # partial below the exchange + final
    assert "WindowGroupLimit" in p[p.index("Exchange hashpartitioning"):], p


def test_top_n_limits_before_the_shuffle(spark):
    p = plan(C.top_n_per_key(skewed(spark), ["k"], "v", 3, ["id"]))
    assert p.count("WindowGroupLimit") == 2, p               # partial + final
    got = C.top_n_per_key(skewed(spark), ["k"], "v", 3, ["id"]).filter("k = 0").collect()
    assert len(got) == 3


def test_long_stops_windows_are_bucketed(spark):
    df = skewed(spark).select(F.col("k").cast("string").alias("k"),
                              (F.lit("2024-01-01").cast("timestamp_ntz")
                               + F.make_interval(mins=F.col("id").cast("int"))).alias("timestamp"),
                              F.col("id").alias("event_id"), (F.col("v") < 300).alias("stop"))
    p = plan(TR.long_stops(df, "k", F.col("stop")))
    assert re.search(r"hashpartitioning\(k#\d+, __b#\d+", p), p


def test_upsert_plans(spark):
    t = spark.range(100).select(F.col("id").alias("k"), F.lit("a").alias("s"))
    c = spark.range(50, 150).select(F.col("id").alias("k"), F.lit("b").alias("s"))
    # one exchange per side, shared by the duplicate check and the join
    assert plan(C.upsert(t, c, ["k"], ["s"])).count("Exchange hashpartitioning") == 2


@pytest.mark.skipif(not os.path.isdir(SMOKE), reason="driver test data not present")
def test_no_cartesian_product_in_any_query(spark):
    import __spark_entry__ as E
    bad = [n for n, q in E.queries().items() if q.__module__.startswith("orderflow.plans")
           and re.search("CartesianProduct|NestedLoopJoin", plan(q(spark, SMOKE)))]
    assert bad == []


def count(p: str, what: str) -> int:
    return len(re.findall(what, p))


EXCHANGE = r"Exchange (?:hashpartitioning|rangepartitioning|RoundRobin|SinglePartition)"


@pytest.mark.skipif(not os.path.isdir(SMOKE), reason="driver test data not present")
def test_tracking_events_is_one_segmented_scan(spark):
    import __spark_entry__ as E
    p = plan(E.queries()["tracking_events"](spark, SMOKE))
    assert count(p, EXCHANGE) <= 6 and p.count("FileScan") <= 4, p
    assert re.search(r"hashpartitioning\(shipment_id#\d+L?, __b#\d+L?", p), p      # a hot shipment is spread


@pytest.mark.skipif(not os.path.isdir(SMOKE), reason="driver test data not present")
def test_constraint_report_reads_each_table_once(spark):
    import __spark_entry__ as E
    p = plan(E.queries()["constraint_report"](spark, SMOKE))
    assert count(p, r"hashpartitioning\(c#\d+, k#\d+") == 1 and count(p, r"hashpartitioning\(c#\d+, \d") == 1, p


@pytest.mark.skipif(not os.path.isdir(SMOKE), reason="driver test data not present")
def test_bucketed_landings_are_picked_without_a_shuffle(spark):
    import __spark_entry__ as E
    p = plan(E.queries()["current_state_bucketed"](spark, SMOKE))
    assert "Exchange" not in p and "Bucketed: true" in p, p


@pytest.mark.skipif(not os.path.isdir(SMOKE), reason="driver test data not present")
def test_allocation_of_lines_has_no_task_with_a_group(spark):
    import __spark_entry__ as E
    p = plan(E.queries()["allocate_lines"](spark, SMOKE))
    assert "SinglePartition" not in p and not count(p, r"Window \[row_number"), p


def test_allocation_sends_no_group_to_a_task(spark, monkeypatch):
    from orderflow.operators import ordered as ORD
    plans, write = [], ORD.written

    def seen(df, name):
        plans.append(plan(df))
        return write(df, name)
    monkeypatch.setattr(ORD, "written", seen)
    df = spark.createDataFrame([(i % 3 or None, i, float(i % 7 + 1)) for i in range(300)], "g int, id long, w double")
    got = ORD.allocate_rows(df, "w", 1000, "id", ["g"])
    assert {r.g: r.s for r in got.groupBy("g").agg(F.sum("allocated").alias("s")).collect()} == {None: 1000, 1: 1000, 2: 1000}
    for p in [*plans, plan(got)]:
        assert not count(p, "SortMergeJoin|ShuffledHashJoin"), p
