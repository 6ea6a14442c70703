import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from orderflow.functions import ids, pricing as P
from orderflow.operators import orders as O


def test_unit_price_is_decimal_half_up(spark):
    df = spark.createDataFrame(
        [(Decimal("900.10"), Decimal("5.00")), (Decimal("2.675"), Decimal("0.00")),
         (Decimal("100.00"), Decimal("12.50"))],
        "base decimal(10,3), disc decimal(5,2)")
    got = [r[0] for r in df.select(P.unit_price("base", "disc")).collect()]
    # 900.10 * 0.95 = 855.095 -> 855.10 (half up; binary floats would give 855.09)
    assert got == [Decimal("855.10"), Decimal("2.68"), Decimal("87.50")]


def test_line_total_vat_and_weight(spark):
    df = spark.createDataFrame([(Decimal("10.01"), 3, Decimal("0.333"))],
                               "price decimal(10,2), q int, w decimal(10,3)")
    r = df.select(P.line_total("price", "q").alias("t"),
                  P.line_weight("w", "q").alias("kg")).first()
    assert r.t == Decimal("30.03") and r.kg == Decimal("1.00")
    v = spark.createDataFrame([(Decimal("30.03"),), (Decimal("110.00"),)], "a decimal(14,2)")
    assert [x[0] for x in v.select(P.vat_included("a")).collect()] == [Decimal("2.73"),
                                                                       Decimal("10.00")]


def test_pallets_floor_and_minimum(spark):
    df = spark.createDataFrame([(Decimal("0.00"),), (Decimal("799.99"),), (Decimal("1600.00"),),
                                (Decimal("2399.99"),)], "w decimal(12,2)")
    assert [r[0] for r in df.select(P.pallets("w")).collect()] == [1, 1, 2, 2]


def test_due_date_null_terms_count_as_zero(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 31, 18), 30), (dt.datetime(2024, 1, 31), None)],
                               "c timestamp_ntz, t int")
    assert [r[0] for r in df.select(P.due_date("c", "t")).collect()] == [
        dt.date(2024, 3, 1), dt.date(2024, 1, 31)]


def test_payment_status_boundaries(spark):
    as_of = dt.date(2024, 5, 10)
    df = spark.createDataFrame([
        (Decimal("100"), Decimal("100"), dt.date(2024, 5, 1)),   # paid in full
        (Decimal("100"), Decimal("30"), dt.date(2024, 5, 1)),    # partial
        (Decimal("100"), Decimal("0"), dt.date(2024, 5, 11)),    # due tomorrow -> planned
        (Decimal("100"), Decimal("0"), dt.date(2024, 5, 10)),    # due today -> overdue
        (Decimal("100"), Decimal("0"), dt.date(2024, 5, 9)),     # due yesterday -> overdue
    ], "total decimal(14,2), paid decimal(14,2), due date")
    got = [r[0] for r in df.select(P.payment_status("total", "paid", "due",
                                                    F.lit(as_of))).collect()]
    assert got == ["paid", "partial", "planned", "overdue", "overdue"]


def test_check_payments_flags_planned_with_full_amount(spark):
    df = spark.createDataFrame([("p1", "planned", Decimal("50"), Decimal("50"), dt.date(2030, 1, 1)),
                                ("p2", "planned", Decimal("50"), Decimal("0"), dt.date(2030, 1, 1))],
                               "payment_id string, status string, amount_total decimal(14,2), "
                               "amount_paid decimal(14,2), due_date date")
    bad = O.check_payments(df, dt.date(2024, 1, 1)).collect()
    assert [(r.payment_id, r.expected_status) for r in bad] == [("p1", "paid")]


def test_return_quantity_cap(spark):
    df = spark.createDataFrame([(5,), (10,), (19,), (100,)], "q int")
    assert [r[0] for r in df.select(P.max_return_quantity("q")).collect()] == [1, 1, 1, 10]
    assert [r[0] for r in df.select(P.max_return_quantity("q", 0.05)).collect()] == [1, 1, 1, 5]


def test_tracking_id_matches_md5_rule(spark):
    import hashlib
    df = spark.createDataFrame([("SHP-1A2B3C4D", 0), ("SHP-1A2B3C4D", 14)], "s string, i int")
    got = [r[0] for r in df.select(ids.tracking_id("s", "i")).collect()]
    want = ["TRK-" + hashlib.md5(f"SHP-1A2B3C4D:{i}".encode()).hexdigest()[:12].upper() for i in (0, 14)]
    assert got == want


def test_order_header_totals_equal_sum_of_lines(spark):
    lines = spark.createDataFrame(
        [("o1", 1, "s1", 2), ("o1", 2, "s2", 3), ("o2", 1, "s1", 1)],
        "order_id string, line_number int, sku string, packs_ordered int"
    ).withColumn("discount_pct", F.lit(Decimal("10.00")).cast("decimal(5,2)"))
    products = spark.createDataFrame(
        [("s1", 6, Decimal("10.00")), ("s2", 4, Decimal("3.35"))],
        "sku string, pack_qty int, base_price decimal(10,2)")
    orders = spark.createDataFrame([("o1",), ("o2",), ("o3",)], "order_id string")
    h = {r.order_id: r for r in O.order_header(orders, lines, products).collect()}
    # o1: 12 x 9.00 = 108.00 and 12 x 3.02 (3.015 half up) = 36.24
    assert h["o1"].total_amount == Decimal("144.24") and h["o1"].total_quantity == 24
    assert h["o1"].total_lines == 2 and h["o1"].total_vat == Decimal("9.82") + Decimal("3.29")
    assert h["o3"].total_lines == 0 and h["o3"].total_amount == Decimal("0.00")
    assert h["o1"].currency == "RUB"


def test_vat_fast_path_equals_general_formula(spark):
    # every cent value up to 50.00 (covers all residues mod 11 many times)
    df = spark.range(0, 5001).select((F.col("id").cast("decimal(14,2)") / 100)
                                     .cast("decimal(14,2)").alias("a"))
    general = F.round(F.col("a") * F.lit(Decimal("0.10")) / F.lit(Decimal("1.10")), 2)
    bad = df.filter(P.vat_included("a") != general.cast("decimal(14,2)")).count()
    assert bad == 0
    other = df.select(P.vat_included("a", Decimal("0.18")).alias("v")).filter("v IS NULL").count()
    assert other == 0


def test_orders_without_a_dimension_row_stay_in_the_header(spark):
    orders = spark.createDataFrame([("o1", "c1", "w1", dt.datetime(2024, 1, 1)), ("o2", "c9", None, dt.datetime(2024, 1, 1))],
                                   "order_id string, customer_id string, warehouse_id string, created_at timestamp_ntz")
    dims = dict(customers=spark.createDataFrame([("c1", "n1")], "customer_id string, customer_name string"),
                warehouses=spark.createDataFrame([("w1", "W")], "warehouse_id string, warehouse_name string"))
    got = {r.order_id: (r.customer_name, r.warehouse_name) for r in O.enrich_orders(orders, **dims).collect()}
    assert got == {"o1": ("n1", "W"), "o2": (None, None)}
