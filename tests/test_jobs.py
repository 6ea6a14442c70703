import datetime as dt
from decimal import Decimal

import pytest

from orderflow import schemas as S
from orderflow.plans import jobs
from orderflow.sources import versions
from tests.conftest import rows


def make(spark, schema, records):
    return spark.createDataFrame([tuple(r.get(f.name) for f in schema.fields) for r in records], schema)


def D(x):
    return Decimal(x)


DAY = dt.datetime(2024, 3, 9, 10)
ORDER = dict(customer_id="c1", supplier_name="s", supplier_inn="1", customer_name="n",
             customer_type="horeca", customer_inn="2", warehouse_id="w", total_lines=1,
             total_quantity=10, total_weight_kg=D("900.00"), total_amount=D("110.00"),
             total_vat=D("10.00"), payment_terms_days=14, created_at=DAY, updated_at=DAY,
             event_timestamp=DAY)


def all_tables(spark):
    ship = dict(customer_id="c1", carrier="TK", event_timestamp=DAY)
    return {
        "customers": make(spark, S.CUSTOMERS, [dict(customer_id=c, customer_name="n", customer_type="horeca",
                                                    customer_inn="1", created_at=DAY, updated_at=DAY)
                                               for c in ("c1", "c2")]),
        "products": make(spark, S.PRODUCTS, [dict(sku="k", product_name="p", brand="b", category="c",
                                                  created_at=DAY, updated_at=DAY)]),
        "orders": make(spark, S.ORDERS, [dict(ORDER, order_id="o1", status="in_transit"),
                                         dict(ORDER, order_id="o2", status="new"),
                                         dict(ORDER, order_id="o3", status="delivered")]),
        "order_items": make(spark, S.ORDER_ITEMS, [
            dict(order_id=o, line_number=1, sku="k", product_name="p", brand="b", category="c", packs_ordered=1,
                 quantity=40, price_per_unit=D("2.75"), line_total=D("110.00"), event_timestamp=DAY)
            for o in ("o1", "o2", "o3")]),
        "shipments": make(spark, S.SHIPMENTS, [dict(ship, shipment_id="S1", order_id="o1", status="in_transit",
                                                    shipped_at=DAY, actual_arrival=DAY + dt.timedelta(hours=4))]),
        "order_status_history": make(spark, S.ORDER_STATUS_HISTORY, [
            dict(event_id="e1", order_id="o2", status="confirmed", status_ts=DAY + dt.timedelta(hours=1),
                 event_timestamp=DAY)]),
        "payments": make(spark, S.PAYMENTS, [dict(payment_id="p1", order_id="o1", customer_id="c1", status="planned",
                                                  amount_total=D("110.00"), amount_paid=D("0.00"),
                                                  due_date=dt.date(2024, 3, 1), created_at=DAY, event_timestamp=DAY)]),
        "returns": make(spark, S.RETURNS, []),
    }


def test_apply_changes_publishes_all_tables(spark, tmp):
    out = f"{tmp}/out"
    assert jobs.load_batch(spark, "historical", all_tables(spark), out) == 1
    assert jobs.apply_changes(spark, out, dt.date(2024, 3, 10)) == 2

    def table(n):
        return versions.read(spark, out, n)
    assert rows(table("orders"), "order_id", "status") == [("o1", "delivered"), ("o2", "confirmed"), ("o3", "delivered")]
    s = table("shipments").first()
    assert s.status == "delivered" and s.carrier == "TK" and s.actual_arrival == DAY + dt.timedelta(hours=4)
    assert rows(table("payments"), "payment_id", "status") == [("p1", "overdue")]
    assert rows(table("order_status_history"), "order_id", "status") == [("o1", "delivered"), ("o2", "confirmed")]
    assert [table(n).count() for n in ("customers", "products", "order_items", "returns")] == [2, 1, 3, 0]
    # nothing more to do: the next run changes nothing
    assert jobs.apply_changes(spark, out, dt.date(2024, 3, 10)) == 3
    assert rows(table("orders"), "order_id", "status")[0] == ("o1", "delivered")
    assert table("order_status_history").count() == 2


def test_incremental_load_of_one_table_keeps_the_others(spark, tmp):
    out = f"{tmp}/db"
    jobs.load_batch(spark, "historical", all_tables(spark), out)
    later = DAY.replace(day=1)
    cust = make(spark, S.CUSTOMERS, [dict(customer_id=c, customer_name="renamed", customer_type="horeca",
                                          customer_inn="1", created_at=later, updated_at=DAY) for c in ("c2", "c3")])
    jobs.load_batch(spark, "incremental", {"customers": cust}, out)
    c = {r.customer_id: r for r in versions.read(spark, out, "customers").collect()}
    assert set(c) == {"c1", "c2", "c3"} and c["c2"].customer_name == "renamed" and c["c2"].created_at == DAY
    assert sorted(versions.current(spark, out).tables) == sorted(S.TABLES)
    assert versions.read(spark, out, "order_items").count() == 3
    # append-only tables ignore known keys; a column the batch lacks takes its default
    pay = make(spark, S.PAYMENTS, [dict(payment_id=p, order_id="o1", customer_id="c1", status="paid",
                                        amount_total=D("1.00"), amount_paid=D("1.00"), created_at=DAY,
                                        event_timestamp=DAY) for p in ("p1", "p2")]).drop("currency")
    jobs.load_batch(spark, "incremental", {"payments": pay}, out)
    p = {r.payment_id: r for r in versions.read(spark, out, "payments").collect()}
    assert p["p1"].status == "planned" and p["p2"].status == "paid" and p["p2"].currency == "RUB"
    with pytest.raises(ValueError, match="published table"):
        jobs.load_batch(spark, "incremental", {"payments": pay}, f"{tmp}/other")
