"""Calendar, allocation, data-quality and remaining order-model queries
(D1-D5 Q1-Q5 A2-A4 J7 F4-F6)."""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import functions as F, types as T

from orderflow.operators import calendars as CAL
from orderflow.operators import ordered as ORD
from orderflow.operators import orders as O
from orderflow.operators import quality as Q
from orderflow.plans import driver_tables as dt
from orderflow.plans.q_lifecycle import line_shipments, status_events
from orderflow.plans.q_orders import priced_lines
from orderflow.plans.registry import query
from orderflow.schemas import dec

ALLOCATE_TOTAL = 1000


def event_days(spark, d):
    return (dt.table(spark, d, "events").groupBy(F.to_date("ts").alias("day"))
            .agg(F.count(F.lit(1)).alias("n_events")))


def allocation(spark, d):
    return CAL.allocate(event_days(spark, d), "n_events", ALLOCATE_TOTAL, "day")


def _alloc_sql(weight: str, total: str) -> str:
    """The rule unit by unit: units are given (taken) round by round, in order
    of the residual, until the sum fits."""
    return f"""w AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n_events FROM events GROUP BY 1),
ww AS (SELECT *, ({weight})::DOUBLE AS wt, {total} AS total FROM w),
s AS (SELECT *, total::DOUBLE * wt / sum(wt) OVER () AS share FROM ww),
b AS (SELECT *, greatest(1, CAST(round_even(share, 0) AS BIGINT)) AS base FROM s),
g AS (SELECT *, share - base AS res, total - sum(base) OVER () AS diff, count(*) OVER () AS n FROM b),
give AS (SELECT day, res, diff, unnest(range(1, CAST(greatest(diff, 0) // n + 2 AS BIGINT))) AS rd FROM g),
ad AS (SELECT day, count(*) AS c FROM (SELECT day, diff, row_number() OVER (ORDER BY rd, res DESC, day) AS k
         FROM give) WHERE k <= diff GROUP BY day),
unit AS (SELECT day, res, diff, unnest(range(1, base)) AS rd FROM g),
tk AS (SELECT day, count(*) AS c FROM (SELECT day, diff, row_number() OVER (ORDER BY rd, res, day) AS k
         FROM unit) WHERE k <= -diff GROUP BY day),
al AS (SELECT g.day, g.n_events, CAST(g.base + coalesce(ad.c, 0) - coalesce(tk.c, 0) AS BIGINT) AS allocated
       FROM g LEFT JOIN ad ON ad.day = g.day LEFT JOIN tk ON tk.day = g.day)"""


_ALLOC_SQL = _alloc_sql("n_events", "1000")


@query("allocate_total", f"WITH {_ALLOC_SQL} SELECT * FROM al")
def q_allocate_total(spark, d):
    """1,000 units over the event days by event count: rint share, at
    least 1, then +-1 by residual in rounds until the sum is exact."""
    return allocation(spark, d)


@query("allocate_skewed", f"""
WITH {_alloc_sql("CASE WHEN day = (SELECT min(day) FROM w) THEN n_events * 50 ELSE n_events END",
                 "(SELECT count(*) + 9 FROM w)")} SELECT * FROM al
""")
def q_allocate_skewed(spark, d):
    """D4 where one day holds most of the weight and the total is nine above
    the number of days: several units are taken from one day."""
    days = event_days(spark, d)
    first, n = days.agg(F.min("day"), F.count(F.lit(1))).first()
    w = days.withColumn("weight", F.when(F.col("day") == F.lit(first), F.col("n_events") * 50)
                        .otherwise(F.col("n_events")))
    return CAL.allocate(w, "weight", n + 9, "day").drop("weight")


@query("allocate_lines", """
WITH w AS (SELECT l_returnflag AS flag, l_orderkey * 100 + l_linenumber AS line, sum(l_quantity) AS weight
           FROM lineitem GROUP BY 1, 2),
s AS (SELECT *, (SELECT 3 * count(*) + 7 FROM lineitem) AS total, sum(weight) OVER f AS whole, count(*) OVER f AS n
      FROM w WINDOW f AS (PARTITION BY flag)),
b AS (SELECT *, total::DOUBLE * weight / whole AS share, greatest(1, CAST(round_even(total::DOUBLE * weight / whole, 0)
        AS BIGINT)) AS base FROM s),
g AS (SELECT *, share - base AS res, total - sum(base) OVER (PARTITION BY flag) AS diff FROM b),
give AS (SELECT flag, line, res, diff, unnest(range(1, CAST(greatest(diff, 0) // n + 2 AS BIGINT))) AS rd FROM g),
ad AS (SELECT flag, line, count(*) AS c FROM (SELECT *, row_number() OVER (PARTITION BY flag ORDER BY rd, res DESC, line)
         AS k FROM give) WHERE k <= diff GROUP BY flag, line),
unit AS (SELECT flag, line, res, diff, unnest(range(1, base)) AS rd FROM g WHERE diff < 0),
tk AS (SELECT flag, line, count(*) AS c FROM (SELECT *, row_number() OVER (PARTITION BY flag ORDER BY rd, res, line)
         AS k FROM unit) WHERE k <= -diff GROUP BY flag, line)
SELECT flag, line, CAST(base + coalesce(ad.c, 0) - coalesce(tk.c, 0) AS BIGINT) AS allocated
FROM g LEFT JOIN ad USING (flag, line) LEFT JOIN tk USING (flag, line)
""")
def q_allocate_lines(spark, d):
    """D4 over all order lines of a return flag (a group holds half of them):
    units by quantity, exact, no task holds a group."""
    lines = dt.table(spark, d, "lineitem")
    w = lines.groupBy(F.col("l_returnflag").alias("flag"), (F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("line")
                      ).agg(F.sum("l_quantity").alias("weight"))
    return ORD.allocate_rows(w, "weight", 3 * lines.count() + 7, "line", ["flag"]).drop("weight")


@query("expand_by_count", f"""
WITH {_ALLOC_SQL}
SELECT day, CAST(u AS BIGINT) AS unit FROM al, unnest(range(1, allocated + 1)) AS t(u)
""")
def q_expand_by_count(spark, d):
    """One row per allocated unit of each day."""
    return CAL.expand_by_count(allocation(spark, d), "allocated").select("day", "unit")


@query("day_spine", """
SELECT CAST(unnest(generate_series(CAST(min(ts) AS DATE), CAST(max(ts) AS DATE), INTERVAL 1 DAY))
            AS DATE) AS day FROM events
""")
def q_day_spine(spark, d):
    """One row per calendar day of the event range (days without events
    included)."""
    bounds = dt.table(spark, d, "events").agg(F.min("ts").alias("lo"), F.max("ts").alias("hi"))
    return CAL.spine_between(bounds, "lo", "hi")


@query("days_back", """
WITH e AS (SELECT CAST(max(ts) AS DATE) AS last FROM events),
sp AS (SELECT CAST(unnest(generate_series(last - INTERVAL 10 DAY, last - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS DATE)
         AS day FROM e)
SELECT sp.day, count(ev.event_id) AS n_events FROM sp LEFT JOIN events ev ON CAST(ev.ts AS DATE) = sp.day GROUP BY 1
""")
def q_days_back(spark, d):
    """The ten days before the last event day, with their events."""
    ev = dt.table(spark, d, "events")
    last = ev.agg(F.to_date(F.max("ts"))).first()[0]
    counts = ev.groupBy(F.to_date("ts").alias("day")).agg(F.count("event_id").alias("n_events"))
    return (CAL.day_spine(spark, last, 10).join(counts, "day", "left")
            .select("day", F.coalesce("n_events", F.lit(0)).cast("long").alias("n_events")))


_DAYS_SQL = "dd AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)"


def order_days(spark, d):
    return CAL.with_calendar(dt.orders(spark, d).select(F.to_date("created_at").alias("day")).distinct())


@query("seasonality", f"""
WITH {_DAYS_SQL}
SELECT day, CAST(month(day) AS INTEGER) AS month,
       CASE month(day) WHEN 1 THEN 1.15 WHEN 2 THEN 1.0 WHEN 3 THEN 1.05 WHEN 4 THEN 1.0
         WHEN 5 THEN 0.95 WHEN 6 THEN 0.85 WHEN 7 THEN 0.80 WHEN 8 THEN 0.85 WHEN 9 THEN 1.0
         WHEN 10 THEN 1.05 WHEN 11 THEN 1.10 WHEN 12 THEN 1.25 ELSE 1.0 END::DOUBLE AS season_factor
FROM dd
""")
def q_seasonality(spark, d):
    """Month factor of every order day."""
    return order_days(spark, d).select("day", F.month("day").alias("month"), "season_factor")


@query("weekday_class", f"""
WITH {_DAYS_SQL}, x AS (SELECT day, CAST(isodow(day) - 1 AS INTEGER) AS weekday FROM dd)
SELECT day, weekday,
       CASE WHEN weekday < 5 THEN 'weekday' WHEN weekday = 5 THEN 'saturday' ELSE 'sunday' END
         AS weekday_class,
       CASE WHEN weekday < 5 THEN 0.9 WHEN weekday = 5 THEN 0.3 ELSE 0.05 END::DOUBLE AS weight_low,
       CASE WHEN weekday < 5 THEN 1.2 WHEN weekday = 5 THEN 0.5 ELSE 0.15 END::DOUBLE AS weight_high
FROM x
""")
def q_weekday_class(spark, d):
    """D3: weekday (Monday = 0), class and weight bounds of every order day."""
    return order_days(spark, d).select("day", "weekday", "weekday_class", "weight_low",
                                       "weight_high")


# --- Q1-Q5 -----------------------------------------------------------------------
@query("duplicate_keys", """
SELECT l_orderkey AS order_id, l_linenumber AS line_number, count(*) AS n_rows
FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1
""")
def q_duplicate_keys(spark, d):
    """Q1: (order_id, line_number) keys of the lines seen more than once."""
    return Q.duplicate_keys(dt.order_lines(spark, d), ["order_id", "line_number"])


@query("null_counts", """
WITH ls AS (SELECT l_orderkey AS order_id, l_shipdate AS shipped_at,
                   CASE WHEN l_linestatus = 'F' THEN l_shipdate + INTERVAL 2 DAY END AS actual_arrival
            FROM lineitem),
fs AS (SELECT order_id, arg_min(shipped_at, shipped_at) AS shipped_at,
              count(*) AS n FROM ls GROUP BY 1),
j AS (SELECT o.o_orderkey, fs.shipped_at, fs.n FROM orders o LEFT JOIN fs ON fs.order_id = o.o_orderkey)
SELECT 'order_id' AS column_name, CAST(count(*) FILTER (WHERE o_orderkey IS NULL) AS BIGINT) AS null_count FROM j
UNION ALL SELECT 'shipment_id', CAST(count(*) FILTER (WHERE n IS NULL) AS BIGINT) FROM j
UNION ALL SELECT 'shipped_at', CAST(count(*) FILTER (WHERE shipped_at IS NULL) AS BIGINT) FROM j
""")
def q_null_counts(spark, d):
    """Q2: NOT NULL check of the order -> first shipment view, one pass."""
    from orderflow.operators.lifecycle import attach_shipment
    j = attach_shipment(dt.orders(spark, d).select("order_id"), line_shipments(spark, d))
    return Q.null_violations(j, ["order_id", "shipment_id", "shipped_at"])


@query("orphans", """
SELECT l_orderkey AS order_id, l_linenumber AS line_number, l_partkey AS sku, l_suppkey AS supplier_id
FROM lineitem WHERE l_linenumber <> 7
  AND NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l_orderkey)
UNION ALL SELECT -l_orderkey - 1, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_linenumber = 7
""")
def q_orphans(spark, d):
    """Q3: lines whose order does not exist (every seventh line is given an
    unknown order)."""
    child = dt.order_lines(spark, d).select("order_id", "line_number", "sku", "supplier_id").withColumn(
        "order_id", F.when(F.col("line_number") == 7, -F.col("order_id") - 1).otherwise(F.col("order_id")))
    return Q.orphans(child, dt.orders(spark, d), "order_id")


@query("width_rounding", """
SELECT 'limit_value' AS column_name, 'NUMERIC(5,2)' AS "limit", CAST(count(*) AS BIGINT) AS violations
FROM customer WHERE c_custkey % 10 >= 5
""")
def q_width_rounding(spark, d):
    """Q4 at the limit: 999.990 to 999.999 by customer key; a NUMERIC(5,2)
    column refuses what rounds to 1000.00."""
    c = dt.customers(spark, d).select((F.lit(Decimal("999.990")) + (F.col("customer_id") % 10).cast(dec(3, 0))
                                       * F.lit(Decimal("0.001"))).cast("double").alias("limit_value"))
    return Q.width_violations(c, None, {"limit_value": (5, 2)})


def constraint_tables(spark, d):
    """The eight tables with the columns the driver tables give."""
    from orderflow.plans.q_lifecycle import line_shipments, payments
    o, lines = dt.orders(spark, d), priced_lines(spark, d)
    pay = payments(spark, d).withColumn("payment_id", F.col("order_id"))
    rets = (lines.filter(F.col("return_flag") == "R")
            .select(F.concat_ws("-", "order_id", "line_number").alias("return_id"), "order_id", "line_number",
                    F.col("packs_ordered").alias("quantity"), F.col("line_total").alias("amount")))
    return {"customers": dt.customers(spark, d), "products": dt.products(spark, d),
            "orders": o.select("order_id", "customer_id", "status", "created_at"),
            "order_items": lines.select("order_id", "line_number", "sku", "quantity", "price_per_unit", "line_total"),
            "shipments": line_shipments(spark, d).select("shipment_id", "order_id", "shipped_at"),
            "order_status_history": status_events(spark, d), "payments": pay, "returns": rets}


_C_PRICED = """pl AS (SELECT l.*, CAST(l_quantity AS INTEGER) * p_size AS quantity,
    CAST(round(CAST(p_retailprice AS DECIMAL(10,2)) * (1 - CAST(CAST(l_discount AS DECIMAL(4,2)) * 100
      AS DECIMAL(5,2)) * 0.01), 2) AS DECIMAL(10,2)) AS price FROM lineitem l JOIN part ON p_partkey = l_partkey),
it AS (SELECT *, CAST(round(price * quantity, 2) AS DECIMAL(14,2)) AS total FROM pl)"""
_C_EV = """ev AS (SELECT o_orderkey AS k, 'new' AS st, o_orderdate AS t FROM orders
  UNION ALL SELECT l_orderkey, 'shipped', min(l_shipdate) FROM lineitem JOIN orders ON o_orderkey = l_orderkey GROUP BY 1
  UNION ALL SELECT l_orderkey, 'delivered', max(l_shipdate) FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    WHERE o_orderstatus = 'F' GROUP BY 1)"""


def _nulls(table, source, cols):
    return [(table, f"{c} NOT NULL", f"SELECT count(*) FROM {source} WHERE {x} IS NULL") for c, x in cols.items()]


def _widths(table, source, cols):
    return [(table, f"{c} VARCHAR({n})", f"SELECT count(*) FROM {source} WHERE length(CAST({x} AS VARCHAR)) > {n}")
            for c, (x, n) in cols.items()]


def _numbers(table, source, cols):
    return [(table, f"{c} NUMERIC({p},{s})", f"SELECT count(*) FROM {source} WHERE abs(round({x}, {s})) >= 1e{p - s}")
            for c, (x, p, s) in cols.items()]


def _key(table, source, cols, names):
    return [(table, f"PRIMARY KEY ({names})",
             f"SELECT count(*) FROM (SELECT 1 FROM {source} GROUP BY {cols} HAVING count(*) > 1)")]


def _ref(table, what, child, col, parent, pcol):
    return [(table, what, f"SELECT count(*) FROM {child} x WHERE {col} IS NOT NULL AND NOT EXISTS "
                          f"(SELECT 1 FROM {parent} y WHERE y.{pcol} = x.{col})")]


_CONSTRAINTS = [
    *_nulls("customers", "customer", {"customer_id": "c_custkey", "customer_name": "c_name",
                                      "customer_type": "c_mktsegment", "customer_inn": "c_custkey"}),
    *_widths("customers", "customer", {"customer_id": ("c_custkey", 32), "customer_name": ("c_name", 256),
                                       "customer_type": ("c_mktsegment", 32),
                                       "customer_inn": ("lpad(CAST(c_custkey AS VARCHAR), 10, '0')", 20),
                                       "contract_number": ("'C-' || c_custkey", 64)}),
    *_numbers("customers", "customer", {"discount_pct": ("c_custkey % 15", 5, 2)}),
    *_key("customers", "customer", "c_custkey", "customer_id"),
    *_nulls("products", "part", {"sku": "p_partkey", "product_name": "p_name", "brand": "p_brand",
                                 "category": "p_type"}),
    *_numbers("products", "part", {"base_price": ("p_retailprice", 10, 2), "weight_kg": ("p_size * 0.05", 10, 3)}),
    *_key("products", "part", "p_partkey", "sku"),
    *_nulls("orders", "orders", {"order_id": "o_orderkey", "customer_id": "o_custkey", "status": "o_orderstatus",
                                 "created_at": "o_orderdate"}),
    *_widths("orders", "orders", {"order_id": ("o_orderkey", 64), "customer_id": ("o_custkey", 32),
                                  "status": ("o_orderstatus", 32)}),
    *_key("orders", "orders", "o_orderkey", "order_id"),
    *_ref("orders", "customer_id REFERENCES customers(customer_id)", "orders", "o_custkey", "customer", "c_custkey"),
    *_nulls("order_items", "it", {"order_id": "l_orderkey", "line_number": "l_linenumber", "sku": "l_partkey",
                                  "quantity": "quantity", "price_per_unit": "price", "line_total": "total"}),
    *_widths("order_items", "it", {"order_id": ("l_orderkey", 64), "sku": ("l_partkey", 32)}),
    *_numbers("order_items", "it", {"price_per_unit": ("price", 10, 2), "line_total": ("total", 14, 2)}),
    *_key("order_items", "it", "l_orderkey, l_linenumber", "order_id, line_number"),
    *_ref("order_items", "order_id REFERENCES orders(order_id)", "it", "l_orderkey", "orders", "o_orderkey"),
    *_ref("order_items", "sku REFERENCES products(sku)", "it", "l_partkey", "part", "p_partkey"),
    *_nulls("shipments", "lineitem", {"shipment_id": "concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)",
                                      "order_id": "l_orderkey"}),
    *_key("shipments", "lineitem", "l_orderkey, l_linenumber, l_partkey, l_suppkey", "shipment_id"),
    *_ref("shipments", "order_id REFERENCES orders(order_id)", "lineitem", "l_orderkey", "orders", "o_orderkey"),
    *_nulls("order_status_history", "(SELECT * FROM ev WHERE t IS NOT NULL)",
            {"event_id": "k", "order_id": "k", "status": "st", "status_ts": "t", "event_timestamp": "t"}),
    *_key("order_status_history", "(SELECT * FROM ev WHERE t IS NOT NULL)", "k, st, t", "event_id"),
    *_ref("order_status_history", "order_id REFERENCES orders(order_id)", "ev", "k", "orders", "o_orderkey"),
    *_nulls("payments", "orders", {"payment_id": "o_orderkey", "order_id": "o_orderkey", "status": "o_orderstatus",
                                   "amount_total": "o_totalprice", "amount_paid": "o_totalprice"}),
    *_numbers("payments", "orders", {"amount_total": ("o_totalprice", 14, 2), "amount_paid": ("o_totalprice", 14, 2)}),
    *_key("payments", "orders", "o_orderkey", "payment_id"),
    *_ref("payments", "order_id REFERENCES orders(order_id)", "orders", "o_orderkey", "orders", "o_orderkey"),
    *_nulls("returns", "(SELECT * FROM it WHERE l_returnflag = 'R')",
            {"return_id": "l_orderkey", "order_id": "l_orderkey", "line_number": "l_linenumber",
             "quantity": "l_quantity", "amount": "total"}),
    *_numbers("returns", "(SELECT * FROM it WHERE l_returnflag = 'R')", {"amount": ("total", 14, 2)}),
    *_key("returns", "(SELECT * FROM it WHERE l_returnflag = 'R')", "l_orderkey, l_linenumber", "return_id"),
    *_ref("returns", "order_id REFERENCES orders(order_id)", "it", "l_orderkey", "orders", "o_orderkey"),
]


@query("constraint_report", f"WITH {_C_PRICED}, {_C_EV} " + " UNION ALL ".join(
    f"SELECT '{t}' AS table_name, '{c}' AS constraint_name, CAST(({q}) AS BIGINT) AS violations"
    for t, c, q in _CONSTRAINTS))
def q_constraint_report(spark, d):
    """Q1-Q4 over the declared schema of all eight tables."""
    from orderflow import schemas as S
    return Q.constraint_report(constraint_tables(spark, d), S.TABLES, S.KEYS, S.FOREIGN_KEYS, S.WIDTHS, S.NUMERICS)


@query("width_violations", """
SELECT 'customer_name' AS column_name, 'VARCHAR(256)' AS "limit",
       CAST(count(*) FILTER (WHERE length(c_name) > 256) AS BIGINT) AS violations FROM customer
UNION ALL SELECT 'customer_type', 'VARCHAR(32)',
       CAST(count(*) FILTER (WHERE length(c_mktsegment) > 32) AS BIGINT) FROM customer
UNION ALL SELECT 'account_balance', 'NUMERIC(5,2)',
       CAST(count(*) FILTER (WHERE abs(c_acctbal) >= 1000.0) AS BIGINT) FROM customer
""")
def q_width_violations(spark, d):
    """Q4: declared text widths and a NUMERIC(5,2) range on customers."""
    return Q.width_violations(dt.customers(spark, d),
                              {"customer_name": 256, "customer_type": 32},
                              {"account_balance": (5, 2)})


@query("defaults", """
SELECT o_orderkey AS order_id, o_orderstatus AS status, 'RUB' AS currency FROM orders
""")
def q_defaults(spark, d):
    """Q5: the currency column is not supplied, so it takes its default."""
    from orderflow.schemas import DEFAULTS
    o = dt.orders(spark, d).select("order_id", "status")
    return Q.apply_defaults(o, DEFAULTS["orders"])


# --- A2 A3 A4 --------------------------------------------------------------------
@query("last_change", """
WITH a AS (SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
           FROM lineitem GROUP BY l_orderkey),
m AS (SELECT o.o_orderkey AS order_id, o.o_orderdate AS created_at, a.first_ship,
             CASE WHEN o.o_orderstatus = 'F' THEN a.last_ship END AS delivered_at
      FROM orders o LEFT JOIN a ON a.l_orderkey = o.o_orderkey)
SELECT order_id, greatest(created_at, first_ship, delivered_at) AS updated_at,
       greatest(created_at, first_ship, delivered_at) AS event_timestamp FROM m
""")
def q_last_change(spark, d):
    """A2: updated_at = event_timestamp = latest status time of each order."""
    return O.last_change(status_events(spark, d))


@query("catalog_summary", """
SELECT count(*) AS sku_count, count(DISTINCT p_brand) AS brand_count FROM part
""")
def q_catalog_summary(spark, d):
    """A3: number of SKUs and of distinct brands."""
    return O.catalog_summary(dt.products(spark, d))


@query("load_summary", """
SELECT 'orders' AS entity, count(*) AS row_count FROM orders
UNION ALL SELECT 'order_items', count(*) FROM lineitem
UNION ALL SELECT 'shipments', count(DISTINCT l_orderkey) FROM lineitem
UNION ALL SELECT 'payments', count(*) FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')
UNION ALL SELECT 'returns', count(*) FROM lineitem WHERE l_returnflag = 'R'
""")
def q_load_summary(spark, d):
    """A4: row counts per entity of one load (an audit table)."""
    lines = dt.order_lines(spark, d)
    return O.load_summary({
        "orders": dt.orders(spark, d),
        "order_items": lines,
        "shipments": dt.shipments(spark, d),
        "payments": dt.orders(spark, d).filter(F.col("priority").isin("1-URGENT", "2-HIGH")),
        "returns": lines.filter(F.col("return_flag") == "R"),
    })


# --- J7 F4 F5 F6 -------------------------------------------------------------------
@query("lookup_default", """
WITH p(customer_type, min_items, max_items, min_packs, max_packs) AS (VALUES
  ('retail_chain', 5, 18, 4, 80), ('distributor', 8, 25, 20, 200), ('government', 3, 10, 10, 60),
  ('horeca', 2, 6, 1, 8))
SELECT c.c_custkey AS customer_id, c.c_mktsegment AS customer_type,
       coalesce(p.min_items, 2) AS min_items, coalesce(p.max_items, 6) AS max_items,
       coalesce(p.min_packs, 1) AS min_packs, coalesce(p.max_packs, 8) AS max_packs
FROM customer c LEFT JOIN p ON p.customer_type = c.c_mktsegment
""")
def q_lookup_default(spark, d):
    """Order profile by customer type; unknown types take horeca's."""
    c = dt.customers(spark, d).select("customer_id", "customer_type")
    return O.profile_for(c)


CONFORM_SCHEMA = T.StructType([
    T.StructField("order_id", T.LongType()), T.StructField("line_number", T.IntegerType()),
    T.StructField("sku", T.LongType()), T.StructField("quantity", T.IntegerType()),
    T.StructField("price_per_unit", dec(10, 2)), T.StructField("line_total", dec(14, 2)),
    T.StructField("vat_amount", dec(14, 2)),
])


@query("conform", """
WITH l AS (SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_number, l.l_partkey AS sku,
             CAST(l.l_quantity AS INTEGER) * p.p_size AS quantity,
             CAST(round(CAST(p.p_retailprice AS DECIMAL(10,2)) * (1 - CAST(CAST(l.l_discount
               AS DECIMAL(4,2)) * 100 AS DECIMAL(5,2)) * 0.01), 2) AS DECIMAL(10,2)) AS price_per_unit
           FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey),
t AS (SELECT *, CAST(round(price_per_unit * quantity, 2) AS DECIMAL(14,2)) AS line_total FROM l)
SELECT order_id, line_number, sku, quantity, price_per_unit, line_total,
       CAST(round(line_total * 0.10 / 1.10, 2) AS DECIMAL(14,2)) AS vat_amount FROM t
""")
def q_conform(spark, d):
    """priced lines cut to a fixed column list, order and types."""
    return O.conform(priced_lines(spark, d), CONFORM_SCHEMA)


# Binding parameters: preferred part types per customer segment.
SEGMENT_PREFERENCES = {"HOUSEHOLD": ["SMALL", "ECONOMY"], "AUTOMOBILE": ["PROMO"],
                       "MACHINERY": ["LARGE", "STANDARD", "MEDIUM"]}
SEGMENT_MIN_PRODUCTS = 400


@query("eligible_products", """
WITH pref(customer_type, category) AS (VALUES ('HOUSEHOLD','SMALL'), ('HOUSEHOLD','ECONOMY'),
   ('AUTOMOBILE','PROMO'), ('MACHINERY','LARGE'), ('MACHINERY','STANDARD'), ('MACHINERY','MEDIUM')),
ty AS (SELECT DISTINCT c_mktsegment AS customer_type FROM customer),
np AS (SELECT pref.customer_type, count(*) AS n FROM part JOIN pref ON pref.category = part.p_type
       GROUP BY 1),
ev AS (SELECT ty.customer_type, coalesce(np.n, 0) < 400 AS every FROM ty LEFT JOIN np
         ON np.customer_type = ty.customer_type)
SELECT ev.customer_type, p.p_partkey AS sku FROM ev JOIN part p ON ev.every
UNION ALL
SELECT ev.customer_type, p.p_partkey FROM ev JOIN pref ON pref.customer_type = ev.customer_type
  JOIN part p ON p.p_type = pref.category WHERE NOT ev.every
""")
def q_eligible_products(spark, d):
    """product pool per customer segment: its preferred part types, or
    every part when the segment has no preference or fewer than 400 parts
    qualify."""
    types = (dt.customers(spark, d).select("customer_type").distinct()
             .withColumn("n_items", F.lit(SEGMENT_MIN_PRODUCTS)))
    return O.eligible_products(types, dt.products(spark, d), SEGMENT_PREFERENCES)


BUILD_NOW = _dt.datetime(2024, 2, 1)


@query("build_reference", """
SELECT c_custkey AS customer_id, c_name AS customer_name, c_mktsegment AS customer_type,
       coalesce(c_acctbal, 0.0) AS account_balance,
       TIMESTAMP '2024-02-01 00:00:00' AS created_at, TIMESTAMP '2024-02-01 00:00:00' AS updated_at
FROM customer
""")
def q_build_reference(spark, d):
    """master rows renamed, nulls defaulted, stamped with the load time."""
    return O.build_reference(dt.table(spark, d, "customer"),
                             {"c_custkey": "customer_id", "c_name": "customer_name",
                              "c_mktsegment": "customer_type", "c_acctbal": "account_balance"},
                             {"account_balance": 0.0}, BUILD_NOW)
