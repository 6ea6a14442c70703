import datetime as dt
from decimal import Decimal

from orderflow.functions.status import reconcile_shipment_status
from orderflow.operators import lifecycle as LC
from tests.conftest import rows

T0 = dt.datetime(2024, 3, 1, 8)


def h(x):
    return T0 + dt.timedelta(hours=x)


def test_milestones_absent_give_no_row(spark):
    o = spark.createDataFrame([("o1", h(0), None, None), ("o2", h(0), h(1), h(5))],
                              "order_id string, created timestamp_ntz, shipped timestamp_ntz, "
                              "arrived timestamp_ntz")
    ev = LC.milestones_to_events(o, [("new", "created", "erp", None),
                                     ("shipped", "shipped", "tms", None),
                                     ("delivered", "arrived", "tms", None)])
    assert rows(ev, "order_id", "status", "source_system") == [
        ("o1", "new", "erp"), ("o2", "delivered", "tms"), ("o2", "new", "erp"),
        ("o2", "shipped", "tms")]
    assert all(r.event_id.startswith("ST-") for r in ev.collect())


def test_final_status_follows_lifecycle_not_time(spark):
    # arrival (delivered) is earlier than the in-transit scan
    hist = spark.createDataFrame(
        [("e1", "o1", "new", h(0)), ("e2", "o1", "shipped", h(2)), ("e3", "o1", "delivered", h(3)),
         ("e4", "o1", "in_transit", h(4)), ("e5", "o2", "new", h(0)), ("e6", "o2", "cancelled", h(1))],
        "event_id string, order_id string, status string, status_ts timestamp_ntz")
    got = {r.order_id: (r.final_status, r.last_status_ts) for r in LC.final_status(hist).collect()}
    assert got == {"o1": ("delivered", h(4)), "o2": ("cancelled", h(1))}


def test_reconcile_shipment_status(spark):
    df = spark.createDataFrame([("delayed", None), ("delayed", h(1)), ("partially_delivered", h(1)),
                                ("in_transit", h(2))], "s string, a timestamp_ntz")
    got = [r[0] for r in df.select(reconcile_shipment_status("s", "a")).collect()]
    assert got == ["delayed", "delivered", "partially_delivered", "delivered"]


def test_advance_status_map(spark):
    o = spark.createDataFrame([(s,) for s in ["new", "confirmed", "assembled", "partially_delivered",
                                              "delivered", "cancelled"]], "status string")
    got = rows(LC.advance_status(o), "status", "next_status", "source_system")
    assert got == [("assembled", "delivered", "tms"), ("confirmed", "assembled", "wms"),
                   ("new", "confirmed", "erp"), ("partially_delivered", "delivered", "tms")]


def test_open_recent_orders(spark):
    today = dt.datetime(2024, 3, 10)
    o = spark.createDataFrame([("a", dt.datetime(2024, 3, 3), "new"),
                               ("b", dt.datetime(2024, 3, 2, 23), "new"),
                               ("c", dt.datetime(2024, 3, 9), "delivered"),
                               ("d", dt.datetime(2024, 3, 9), None)],
                              "order_id string, created_at timestamp_ntz, status string")
    assert rows(LC.open_recent_orders(o, today), "order_id") == [("a",)]


def test_late_changes_follow_the_landed_data(spark):
    orders = spark.createDataFrame(
        [("all", "in_transit", h(0)), ("some", "in_transit", h(9)), ("sent", "confirmed", h(0)),
         ("hist", "new", h(0)), ("back", "delayed", h(0)), ("gone", "new", h(0)), ("done", "delivered", h(0)),
         ("quiet", "new", h(0))], "order_id string, status string, updated_at timestamp_ntz")
    ships = spark.createDataFrame(
        [("s1", "all", "delayed", h(1), h(5)), ("s2", "all", "partially_delivered", h(1), h(6)),
         ("s3", "some", "in_transit", h(1), h(4)), ("s4", "some", "in_transit", h(1), None),
         ("s5", "sent", "in_transit", h(2), None), ("s6", "back", "in_transit", h(2), None),
         ("s7", "done", "in_transit", h(2), h(3))],
        "shipment_id string, order_id string, status string, shipped_at timestamp_ntz, actual_arrival timestamp_ntz")
    hist = spark.createDataFrame(
        [("e1", "hist", "assembled", h(3)), ("e2", "gone", "cancelled", h(4)), ("e3", "sent", "in_transit", h(2))],
        "event_id string, order_id string, status string, status_ts timestamp_ntz")
    pays = spark.createDataFrame(
        [("p1", "planned", Decimal("10.00"), Decimal("10.00"), dt.date(2024, 9, 1)),
         ("p2", "planned", Decimal("10.00"), Decimal("0.00"), dt.date(2024, 3, 1)),
         ("p3", "planned", Decimal("10.00"), Decimal("0.00"), dt.date(2024, 9, 1))],
        "payment_id string, status string, amount_total decimal(14,2), amount_paid decimal(14,2), due_date date")
    ch = LC.late_changes(orders, ships, pays, hist, dt.date(2024, 3, 2))
    assert rows(ch["orders"], "order_id", "status", "updated_at") == [
        ("all", "delivered", h(6)), ("gone", "cancelled", h(4)), ("hist", "assembled", h(3)),
        ("sent", "in_transit", h(2)), ("some", "partially_delivered", h(9))]
    assert rows(ch["shipments"], "shipment_id", "status") == [("s1", "delivered"), ("s3", "delivered"),
                                                              ("s7", "delivered")]
    assert rows(ch["payments"]) == [("p1", "paid"), ("p2", "overdue")]
    # the history already holds the in_transit and assembled events
    assert rows(ch["order_status_history"], "order_id", "status") == [("all", "delivered"),
                                                                      ("some", "partially_delivered")]


def test_late_returns_are_cut_to_the_limit(spark):
    rets = spark.createDataFrame([("o1", 1, 9), ("o2", 1, 9)], "order_id string, line_number int, quantity int")
    items = spark.createDataFrame([("o1", 1, Decimal("2.75"), 40), ("o2", 1, Decimal("1.00"), 40)],
                                  "order_id string, line_number int, price_per_unit decimal(10,2), quantity int")
    arrived = spark.createDataFrame([("o1",)], "order_id string")
    assert rows(LC.late_returns(rets, items, arrived)) == [("o1", 1, 2, Decimal("5.50"))]


def test_change_base_time(spark):
    o = spark.createDataFrame([("a", h(0), h(5)), ("b", h(7), h(1))],
                              "order_id string, created_at timestamp_ntz, updated_at timestamp_ntz")
    got = dict(rows(LC.change_base_time(o, 30), "order_id", "ts_base"))
    assert got == {"a": h(5.5), "b": h(7.5)}


def test_orders_without_and_attach_shipment(spark):
    o = spark.createDataFrame([("o1",), ("o2",)], "order_id string")
    s = spark.createDataFrame([("s9", "o1", h(2), None, None), ("s1", "o1", h(2), None, h(5)),
                               ("s0", "o1", h(3), None, None)],
                              "shipment_id string, order_id string, shipped_at timestamp_ntz, "
                              "estimated_arrival timestamp_ntz, actual_arrival timestamp_ntz")
    assert rows(LC.orders_without(o, s)) == [("o2",)]
    j = rows(LC.attach_shipment(o, s), "order_id", "shipment_id")
    assert j == [("o1", "s1"), ("o2", None)]
