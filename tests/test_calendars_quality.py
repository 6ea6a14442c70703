import datetime as dt

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from orderflow.functions.calendar import day_window
from orderflow.operators import calendars as CAL
from orderflow.operators import ordered as ORD
from orderflow.operators import quality as Q
from tests.conftest import rows


def test_day_spine_and_calendar(spark):
    s = CAL.with_calendar(CAL.day_spine(spark, "2024-03-04", 3))
    got = rows(s, "day", "weekday", "weekday_class", "season_factor")
    assert got == [(dt.date(2024, 3, 1), 4, "weekday", 1.05), (dt.date(2024, 3, 2), 5, "saturday", 1.05),
                   (dt.date(2024, 3, 3), 6, "sunday", 1.05)]
    b = rows(s, "weight_low", "weight_high")
    assert b == [(0.05, 0.15), (0.3, 0.5), (0.9, 1.2)]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.floats(0.05, 5.0), min_size=1, max_size=20), st.integers(1, 500))
def test_allocate_sums_to_total_when_possible(spark, weights, total):
    df = spark.createDataFrame([(i, w) for i, w in enumerate(weights)], "day int, w double")
    got = [r.allocated for r in CAL.allocate(df, "w", total, "day").collect()]
    assert min(got) >= 1
    if total >= len(weights):
        assert sum(got) == total


def test_allocate_total_below_rows_keeps_minimum(spark):
    df = spark.createDataFrame([(i, 1.0) for i in range(5)], "day int, w double")
    assert [r.allocated for r in CAL.allocate(df, "w", 3, "day").collect()] == [1] * 5


def test_allocate_takes_several_units_from_a_heavy_row(spark):
    # weights 100 and nine 1s: shares round to 18 + nine 0s, raised to 1 each
    df = spark.createDataFrame([(0, 100.0)] + [(i, 1.0) for i in range(1, 10)], "day int, w double")
    for total, heavy in ((20, 11), (10, 1)):
        got = dict(rows(CAL.allocate(df, "w", total, "day"), "day", "allocated"))
        assert got == {0: heavy, **{i: 1 for i in range(1, 10)}}
    two = spark.createDataFrame([(0, 50.0), (1, 50.0)] + [(i, 0.1) for i in range(2, 12)], "day int, w double")
    got = [r.allocated for r in CAL.allocate(two, "w", 20, "day").orderBy("day").collect()]
    assert got == [5, 5] + [1] * 10


def test_numeric_limits_round_first(spark):
    df = spark.createDataFrame([(999.994,), (999.996,), (-999.996,), (1e300,), (None,)], "v double")
    assert rows(Q.width_violations(df, None, {"v": (5, 2)})) == [("v", "NUMERIC(5,2)", 3)]


def test_constraint_report(spark):
    from orderflow import schemas as S
    tables = {"customers": spark.createDataFrame([("c1", "n" * 300), ("c1", None)],
                                                 "customer_id string, customer_name string"),
              "orders": spark.createDataFrame([("o1", "c1"), ("o2", "c9"), ("o3", None)],
                                              "order_id string, customer_id string")}
    got = {(r.table_name, r.constraint_name): r.violations for r in Q.constraint_report(
        tables, S.TABLES, S.KEYS, S.FOREIGN_KEYS, S.WIDTHS, S.NUMERICS).collect()}
    assert got["customers", "customer_name NOT NULL"] == 1 and got["customers", "customer_name VARCHAR(256)"] == 1
    assert got["customers", "PRIMARY KEY (customer_id)"] == 1 and got["orders", "PRIMARY KEY (order_id)"] == 0
    assert got["orders", "customer_id REFERENCES customers(customer_id)"] == 1
    assert got["orders", "customer_id NOT NULL"] == 1


def test_allocate_per_group(spark):
    df = spark.createDataFrame([("a", 1, 1.0), ("a", 2, 3.0), ("b", 1, 1.0), ("b", 2, 1.0)],
                               "g string, day int, w double")
    got = rows(CAL.allocate(df, "w", 10, "day", ["g"]), "g", "day", "allocated")
    assert got == [("a", 1, 2), ("a", 2, 8), ("b", 1, 5), ("b", 2, 5)]


def test_expand_by_count(spark):
    df = spark.createDataFrame([("a", 3), ("b", 0)], "k string, n int")
    assert rows(CAL.expand_by_count(df, "n"), "k", "unit") == [("a", 1), ("a", 2), ("a", 3)]


def test_day_window_and_validation():
    s, e, label = day_window("2024-03-15")
    assert (s, e, label) == (dt.datetime(2024, 3, 14), dt.datetime(2024, 3, 15), "2024-03-14")
    s, e, label = day_window("2024-03-15", lookback_days=7)
    assert s == dt.datetime(2024, 3, 7) and label == "2024-03-14"
    for bad in ["2024-3-15", "15.03.2024", "", None]:
        with pytest.raises(ValueError):
            day_window(bad)


def test_quality_checks(spark):
    df = spark.createDataFrame([("o1", 1, "ab", 1.5), ("o1", 1, None, 1234.5), ("o2", 1, "abcd", None),
                                (None, 2, "x", 2.0)], "order_id string, line int, sku string, amt double")
    assert rows(Q.duplicate_keys(df, ["order_id", "line"])) == [("o1", 1, 2)]
    assert rows(Q.null_violations(df, ["order_id", "sku", "amt"])) == [
        ("amt", 1), ("order_id", 1), ("sku", 1)]
    assert rows(Q.width_violations(df, {"sku": 3}, {"amt": (5, 2)})) == [
        ("amt", "NUMERIC(5,2)", 1), ("sku", "VARCHAR(3)", 1)]
    parent = spark.createDataFrame([("o1",)], "order_id string")
    assert rows(Q.orphans(df, parent, "order_id"), "order_id") == [("o2",)]   # null FK is fine
    d = Q.apply_defaults(df.withColumn("currency", F.lit(None).cast("string")),
                         {"currency": "RUB", "unit_of_measure": "шт"})
    assert {r.currency for r in d.collect()} == {None}       # supplied null stays null
    assert {r.unit_of_measure for r in d.collect()} == {"шт"}


def test_eligible_products_pools_and_rules(spark):
    from orderflow.operators import orders as O
    products = spark.createDataFrame([("p1", "milk"), ("p2", "cream"), ("p3", "bolts")],
                                     "sku string, category string")
    types = spark.createDataFrame([("horeca", 2), ("government", 5), ("retail", 1)],
                                  "customer_type string, n_items int")
    prefs = {"horeca": ["milk", "cream"], "government": ["milk"]}
    got = rows(O.eligible_products(types, products, prefs))
    assert got == [("government", "p1"), ("government", "p2"), ("government", "p3"),  # too few
                   ("horeca", "p1"), ("horeca", "p2"),                                 # preferred
                   ("retail", "p1"), ("retail", "p2"), ("retail", "p3")]               # no preference
    rules = rows(O.eligibility_rules(types, products, prefs))
    assert rules == [("government", "*"), ("horeca", "cream"), ("horeca", "milk"), ("retail", "*")]


@pytest.mark.parametrize("total,min_count,weights", [
    (50, 1, lambda i: i % 5 + 1), (31, 1, lambda i: 100 if i == 3 else 1), (1000, 1, lambda i: (i * 37) % 11),
    (30, 1, lambda i: 1), (33, 1, lambda i: 500 if i % 10 == 0 else 1), (95, 2, lambda i: i * i), (40, 0, lambda i: 1.5)])
def test_allocate_rows_equals_the_window_form(spark, total, min_count, weights):
    df = spark.createDataFrame([("g" if i % 3 else None, i, float(weights(i))) for i in range(30)],
                               "grp string, id int, w double")
    for groups in (None, ["grp"]):
        a = CAL.allocate(df, "w", total, "id", groups, min_count)
        b = ORD.allocate_rows(df, "w", total, "id", groups, min_count)
        assert b.columns == a.columns and rows(a, "id", "allocated") == rows(b, "id", "allocated")


def test_numbered_has_no_single_task(spark):
    df = spark.range(5000).select("id", (F.col("id") * 7919 % 13).alias("v"), F.lit("x").alias("_at"))
    got = ORD.numbered(df.drop("_at"), [F.col("v").desc(), F.col("id").asc()], partitions=6)
    want = {i: n for n, (_, i) in enumerate(sorted((-(i * 7919 % 13), i) for i in range(5000)), 1)}
    assert {r.id: r.row_number for r in got.collect()} == want
    in_group = ORD.numbered(df.drop("_at"), [F.col("id").desc()], ["v"])
    for v, g in [(0, [i for i in range(5000) if i * 7919 % 13 == 0])]:
        assert {r.id: r.row_number for r in in_group.filter(F.col("v") == v).collect()} == {
            i: n for n, i in enumerate(sorted(g, reverse=True), 1)}
    assert "SinglePartition" not in got._jdf.queryExecution().executedPlan().toString()
