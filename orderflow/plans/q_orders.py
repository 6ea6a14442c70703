"""Order pricing / totals / header queries on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderflow.functions import ids, pricing as P
from orderflow.operators import orders as O
from orderflow.plans import driver_tables as dt
from orderflow.plans.registry import query

# Shared SQL fragments of the oracle: the same pricing rule written by hand.
_PRICED_SQL = """
priced AS (
  SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_number, l.l_partkey AS sku,
         CAST(l.l_quantity AS INTEGER) * p.p_size AS quantity,
         CAST(p.p_retailprice AS DECIMAL(10,2)) AS price_before_discount,
         CAST(CAST(l.l_discount AS DECIMAL(4,2)) * 100 AS DECIMAL(5,2)) AS discount_pct,
         CAST(round(CAST(p.p_retailprice AS DECIMAL(10,2))
              * (1 - CAST(CAST(l.l_discount AS DECIMAL(4,2)) * 100 AS DECIMAL(5,2)) * 0.01), 2)
              AS DECIMAL(10,2)) AS price_per_unit,
         CAST(round(CAST(p.p_size * 0.05 AS DECIMAL(10,3)) * (CAST(l.l_quantity AS INTEGER) * p.p_size), 2)
              AS DECIMAL(12,2)) AS weight_kg
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey),
totals_l AS (
  SELECT *, CAST(round(price_per_unit * quantity, 2) AS DECIMAL(14,2)) AS line_total FROM priced),
vat_l AS (
  SELECT *, CAST(round(line_total * 0.10 / 1.10, 2) AS DECIMAL(14,2)) AS vat_amount FROM totals_l)
"""


def priced_lines(spark, d):
    return O.price_lines(O.enrich_lines(dt.order_lines(spark, d), dt.products(spark, d)))


# Binding parameters: the supplier's details on every header.
SUPPLIER = {"supplier_name": "Supplier", "supplier_inn": "1600000000", "supplier_kpp": "160000000"}


def header_orders(spark, d):
    """Orders with the header fields that no other table gives."""
    o = dt.table(spark, d, "orders")
    low = (F.col("o_orderstatus") == "O") & (F.col("o_orderpriority") == "5-LOW")
    return o.select(
        F.col("o_orderkey").alias("order_id"), F.col("o_custkey").alias("customer_id"),
        (F.col("o_custkey") % 10).alias("warehouse_id"),
        (F.col("o_custkey") % 5).cast("int").alias("sales_manager_id"),
        F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")).alias("delivery_address"),
        F.date_add(F.to_date("o_orderdate"), 2).alias("expected_delivery_date"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "prepaid").otherwise("invoice").alias("payment_method"),
        F.col("o_orderstatus").alias("status"), F.when(low, "customer").alias("cancel_reason"),
        F.col("o_orderdate").alias("created_at"))


def header(spark, d):
    from orderflow.plans.q_lifecycle import status_events
    lines = dt.order_lines(spark, d)
    ships = lines.select(
        "order_id", F.col("ship_date").alias("shipped_at"), F.col("line_number").alias("shipment_id"),
        F.concat(F.lit("Dock "), F.col("line_number").cast("string")).alias("delivery_address"))
    return O.order_header(header_orders(spark, d), lines, dt.products(spark, d),
                          customers=dt.customers(spark, d), regions=dt.regions(spark, d),
                          shipments=ships, warehouses=dt.warehouses(spark, d),
                          managers=dt.managers(spark, d), history=status_events(spark, d),
                          defaults=SUPPLIER)


@query("order_header", f"""
WITH {_PRICED_SQL},
t AS (SELECT order_id, CAST(count(*) AS INTEGER) AS total_lines,
             CAST(sum(quantity) AS INTEGER) AS total_quantity,
             CAST(sum(weight_kg) AS DECIMAL(12,2)) AS total_weight_kg,
             CAST(sum(line_total) AS DECIMAL(14,2)) AS total_amount,
             CAST(sum(vat_amount) AS DECIMAL(14,2)) AS total_vat
      FROM vat_l GROUP BY order_id),
s AS (SELECT l_orderkey AS order_id, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship,
             arg_min(l_linenumber, (l_shipdate, l_linenumber)) AS dock FROM lineitem GROUP BY 1)
SELECT o.o_orderkey AS order_id, 'Supplier' AS supplier_name, '1600000000' AS supplier_inn,
       '160000000' AS supplier_kpp, o.o_custkey AS customer_id, c.c_name AS customer_name,
       c.c_mktsegment AS customer_type, lpad(CAST(o.o_custkey AS VARCHAR), 10, '0') AS customer_inn,
       n.n_name AS customer_region, 'C-' || o.o_custkey AS contract_number,
       w.s_suppkey AS warehouse_id, w.s_name AS warehouse_name,
       w.s_name || ', nation ' || w.s_nationkey AS warehouse_address,
       CASE WHEN s.order_id IS NULL THEN 'Customer ' || o.o_custkey ELSE 'Dock ' || s.dock END
         AS delivery_address,
       CAST(o.o_orderdate AS DATE) + 2 AS expected_delivery_date,
       r.r_regionkey AS sales_manager_id, r.r_name AS sales_manager_name,
       CASE WHEN o.o_orderpriority = '1-URGENT' THEN 'prepaid' ELSE 'invoice' END AS payment_method,
       CAST(o.o_custkey % 4 * 15 AS INTEGER) AS payment_terms_days,
       coalesce(t.total_lines, 0) AS total_lines, coalesce(t.total_quantity, 0) AS total_quantity,
       coalesce(t.total_weight_kg, CAST(0 AS DECIMAL(12,2))) AS total_weight_kg,
       coalesce(t.total_amount, CAST(0 AS DECIMAL(14,2))) AS total_amount,
       coalesce(t.total_vat, CAST(0 AS DECIMAL(14,2))) AS total_vat, 'RUB' AS currency,
       CASE WHEN s.order_id IS NULL THEN 'new' WHEN o.o_orderstatus = 'F' THEN 'delivered'
            ELSE 'shipped' END AS status,
       CASE WHEN o.o_orderstatus = 'O' AND o.o_orderpriority = '5-LOW' THEN 'customer' END AS cancel_reason,
       o.o_orderdate AS created_at,
       greatest(o.o_orderdate, s.first_ship, CASE WHEN o.o_orderstatus = 'F' THEN s.last_ship END) AS updated_at,
       greatest(o.o_orderdate, s.first_ship, CASE WHEN o.o_orderstatus = 'F' THEN s.last_ship END)
         AS event_timestamp
FROM orders o LEFT JOIN t ON t.order_id = o.o_orderkey LEFT JOIN s ON s.order_id = o.o_orderkey
JOIN customer c ON c.c_custkey = o.o_custkey
JOIN nation n ON n.n_nationkey = c.c_nationkey
JOIN supplier w ON w.s_suppkey = o.o_custkey % 10
JOIN region r ON r.r_regionkey = o.o_custkey % 5
""")
def q_order_header(spark, d):
    """P9 flagship: J1 + P1/P2 + A1 + J2 + E2 + A2 over every order, all 30
    header columns."""
    from orderflow.schemas import ORDERS
    return header(spark, d).select(*ORDERS.fieldNames())


@query("customer_discount_lines", f"""
SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_number, l.l_partkey AS sku, l.l_suppkey AS supplier_id,
       CAST(o.o_custkey % 15 AS DECIMAL(5,2)) AS discount_pct,
       CAST(round(CAST(p.p_retailprice AS DECIMAL(10,2)) * (1 - CAST(o.o_custkey % 15 AS DECIMAL(5,2)) * 0.01), 2)
            AS DECIMAL(10,2)) AS price_per_unit
FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey JOIN orders o ON o.o_orderkey = l.l_orderkey
JOIN customer c ON c.c_custkey = o.o_custkey
""")
def q_customer_discount_lines(spark, d):
    """J1 with the customer: lines without a discount of their own take the
    customer's."""
    lines = dt.order_lines(spark, d).drop("discount_pct").join(
        dt.orders(spark, d).select("order_id", "customer_id"), "order_id")
    priced = O.price_lines(O.enrich_lines(lines, dt.products(spark, d), dt.customers(spark, d)))
    return priced.select("order_id", "line_number", "sku", "supplier_id", "discount_pct", "price_per_unit")


@query("order_numbers", """
SELECT o_orderkey AS order_id, 'ORD-' || strftime(o_orderdate, '%Y%m%d') || '-'
       || upper(substr(md5(CAST(o_orderkey AS VARCHAR)), 1, 8)) AS order_number FROM orders
""")
def q_order_numbers(spark, d):
    """The printed order number: day and a stable suffix."""
    return dt.orders(spark, d).select("order_id", ids.order_number("created_at", "order_id").alias("order_number"))


@query("price_lines", f"""
WITH {_PRICED_SQL}
SELECT order_id, line_number, sku, quantity, price_before_discount, discount_pct,
       price_per_unit, line_total, vat_amount, weight_kg FROM vat_l
""")
def q_price_lines(spark, d):
    """P1 + J1: every line priced with its product."""
    return priced_lines(spark, d).select(
        "order_id", "line_number", "sku", "quantity", "price_before_discount", "discount_pct",
        "price_per_unit", "line_total", "vat_amount", "weight_kg")


@query("vat", f"""
WITH {_PRICED_SQL}
SELECT order_id, line_number, sku, line_total, vat_amount,
       CAST(line_total - vat_amount AS DECIMAL(14,2)) AS net_amount FROM vat_l
""")
def q_vat(spark, d):
    """VAT contained in each gross line total and the net amount."""
    return (priced_lines(spark, d)
            .select("order_id", "line_number", "sku", "line_total", "vat_amount",
                    (F.col("line_total") - F.col("vat_amount")).cast("decimal(14,2)")
                    .alias("net_amount")))


@query("order_totals", f"""
WITH {_PRICED_SQL}
SELECT order_id, CAST(count(*) AS INTEGER) AS total_lines,
       CAST(sum(quantity) AS INTEGER) AS total_quantity,
       CAST(sum(weight_kg) AS DECIMAL(12,2)) AS total_weight_kg,
       CAST(sum(line_total) AS DECIMAL(14,2)) AS total_amount,
       CAST(sum(vat_amount) AS DECIMAL(14,2)) AS total_vat
FROM vat_l GROUP BY order_id
""")
def q_order_totals(spark, d):
    """A1: per-order line count, quantity, weight, amount and VAT."""
    return O.order_totals(priced_lines(spark, d))


@query("shelf_dates", """
SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_number, l.l_partkey AS sku,
       CAST(o.o_orderdate AS DATE) AS production_date,
       CAST(o.o_orderdate + p.p_size * INTERVAL 1 DAY AS DATE) AS best_before
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
JOIN part p ON p.p_partkey = l.l_partkey
""")
def q_shelf_dates(spark, d):
    """Production date = order day, best before = order time + shelf life
    (the part size stands in for the shelf life in days)."""
    lines = (dt.order_lines(spark, d).select("order_id", "line_number", "sku")
             .join(dt.orders(spark, d).select("order_id", F.col("created_at")
                                              .alias("event_timestamp")), "order_id")
             .join(dt.products(spark, d).select("sku", F.col("pack_qty")
                                                .alias("shelf_life_days")), "sku"))
    return O.shelf_dates(lines).select("order_id", "line_number", "sku",
                                       "production_date", "best_before")


@query("pallets", """
SELECT o_orderkey AS order_id,
       greatest(1, CAST(floor(o_totalprice / 800) AS INTEGER)) AS pallets_count
FROM orders
""")
def q_pallets(spark, d):
    """pallets = max(1, floor(weight / 800)); order total price stands in
    for the shipped weight."""
    return dt.orders(spark, d).select("order_id", P.pallets("total_price").alias("pallets_count"))


@query("due_dates", """
SELECT o_orderkey AS order_id, CAST(o_orderdate AS DATE) + CAST(substr(o_orderpriority, 1, 1) AS INTEGER) * 15 AS due_date
FROM orders
""")
def q_due_dates(spark, d):
    """P5: due = created day + payment terms (priority digit x 15 days)."""
    o = dt.orders(spark, d).withColumn(
        "payment_terms_days", F.substring("priority", 1, 1).cast("int") * 15)
    return o.select("order_id", P.due_date("created_at", "payment_terms_days").alias("due_date"))
