"""Order lifecycle, late-change and payment queries (E1-E9 F3 L4 L7 J3-J5
P6-P8 P10 P11) on the driver tables.

Status binding: O + 5-LOW -> cancelled, O -> new, P -> in_transit,
F -> delivered.  A shipment per line: shipped at the ship date, arrived two
days later when the line is final; its stored status lags behind.
"""

from __future__ import annotations

import datetime as _dt
from decimal import Decimal

from pyspark.sql import functions as F

from orderflow.functions.status import reconcile_shipment_status
from orderflow.operators import changes as C
from orderflow.operators import lifecycle as LC
from orderflow.operators import orders as O
from orderflow.plans import driver_tables as dt
from orderflow.plans.q_orders import priced_lines
from orderflow.plans.registry import query
from orderflow.schemas import dec

_LO_SQL = """lo AS (SELECT o_orderkey AS order_id, o_custkey AS customer_id,
  CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN 'cancelled'
       WHEN o_orderstatus = 'O' THEN 'new' WHEN o_orderstatus = 'P' THEN 'in_transit'
       WHEN o_orderstatus = 'F' THEN 'delivered' END AS status,
  o_orderdate AS created_at,
  o_orderdate + CAST(substr(o_orderpriority, 1, 1) AS INTEGER) * INTERVAL 1 HOUR AS updated_at,
  CAST(o_totalprice AS DECIMAL(14,2)) AS total_amount,
  CAST(o_totalprice AS DECIMAL(12,2)) AS total_weight_kg,
  CAST(substr(o_orderpriority, 1, 1) AS INTEGER) * 15 AS payment_terms_days,
  o_orderpriority AS priority
  FROM orders)"""
_LS_SQL = """ls AS (SELECT concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey) AS shipment_id,
  l_orderkey AS order_id, l_shipdate AS shipped_at, CAST(NULL AS TIMESTAMP) AS estimated_arrival,
  CASE WHEN l_linestatus = 'F' THEN l_shipdate + INTERVAL 2 DAY END AS actual_arrival,
  CASE WHEN l_returnflag = 'R' THEN 'partially_delivered' WHEN l_linestatus = 'F' THEN 'delayed'
       ELSE 'in_transit' END AS status
  FROM lineitem)"""
_FS_SQL = """fs AS (SELECT shipment_id, order_id, shipped_at, estimated_arrival, actual_arrival FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY shipped_at NULLS FIRST,
                               shipment_id NULLS FIRST) AS rn FROM ls) WHERE rn = 1)"""
_TODAY_SQL = "(SELECT max(o_orderdate) + INTERVAL 1 DAY FROM orders)"
_RANK_SQL = ("CASE status WHEN 'new' THEN 0 WHEN 'cancelled' THEN 1 WHEN 'confirmed' THEN 2 "
             "WHEN 'assembled' THEN 3 WHEN 'shipped' THEN 4 WHEN 'in_transit' THEN 5 "
             "WHEN 'delayed' THEN 6 WHEN 'delivered' THEN 7 WHEN 'partially_delivered' THEN 8 END")


def lifecycle_orders(spark, d):
    o = dt.orders(spark, d)
    digit = F.substring("priority", 1, 1).cast("int")
    status = (F.when((F.col("status") == "O") & (F.col("priority") == "5-LOW"), "cancelled")
              .when(F.col("status") == "O", "new").when(F.col("status") == "P", "in_transit")
              .when(F.col("status") == "F", "delivered"))
    return o.select("order_id", "customer_id", status.alias("status"), "created_at",
                    (F.col("created_at") + F.make_interval(hours=digit)).alias("updated_at"),
                    F.col("total_price").cast(dec(14, 2)).alias("total_amount"),
                    F.col("total_price").cast(dec(12, 2)).alias("total_weight_kg"),
                    (digit * 15).alias("payment_terms_days"), "priority")


def line_shipments(spark, d):
    li = dt.order_lines(spark, d)
    return li.select(
        F.concat_ws("-", *[F.col(c).cast("string") for c in
                           ("order_id", "line_number", "sku", "supplier_id")]).alias("shipment_id"),
        "order_id", F.col("ship_date").alias("shipped_at"),
        F.lit(None).cast("timestamp_ntz").alias("estimated_arrival"),
        F.when(F.col("line_status") == "F", F.col("ship_date") + F.make_interval(days=F.lit(2)))
        .alias("actual_arrival"),
        F.when(F.col("return_flag") == "R", "partially_delivered")
        .when(F.col("line_status") == "F", "delayed").otherwise("in_transit").alias("status"))


def today(spark, d) -> _dt.datetime:
    """The day after the last order: the run date of a late-change run."""
    return dt.orders(spark, d).agg(F.max("created_at")).first()[0] + _dt.timedelta(days=1)


# --- E1 / E2 ----------------------------------------------------------------
_EV_SQL = f"""a AS (SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
        FROM lineitem GROUP BY l_orderkey),
m AS (SELECT o.o_orderkey AS order_id, o.o_orderdate AS created_at, a.first_ship,
             CASE WHEN o.o_orderstatus = 'F' THEN a.last_ship END AS delivered_at
      FROM orders o LEFT JOIN a ON a.l_orderkey = o.o_orderkey),
ev AS (SELECT order_id, 'new' AS status, created_at AS status_ts, 'erp' AS source_system FROM m
       UNION ALL SELECT order_id, 'shipped', first_ship, 'tms' FROM m
       UNION ALL SELECT order_id, 'delivered', delivered_at, 'tms' FROM m),
se AS (SELECT 'ST-' || upper(md5(concat_ws(':', order_id, status,
                strftime(status_ts, '%Y-%m-%d %H:%M:%S.%f')))) AS event_id,
              order_id, status, status_ts, CAST(NULL AS VARCHAR) AS reason, source_system,
              status_ts AS event_timestamp FROM ev WHERE status_ts IS NOT NULL)"""


def status_events(spark, d):
    ship = (dt.order_lines(spark, d).groupBy("order_id")
            .agg(F.min("ship_date").alias("first_ship"), F.max("ship_date").alias("last_ship")))
    o = (dt.orders(spark, d).join(ship, "order_id", "left")
         .withColumn("delivered_at", F.when(F.col("status") == "F", F.col("last_ship"))))
    return LC.milestones_to_events(o, [("new", "created_at", "erp", None),
                                       ("shipped", "first_ship", "tms", None),
                                       ("delivered", "delivered_at", "tms", None)])


@query("status_events", f"WITH {_EV_SQL} SELECT * FROM se")
def q_status_events(spark, d):
    """Milestones (order date, first and last ship date) -> one status
    event each; absent milestones give no row."""
    return status_events(spark, d)


@query("order_final_status", f"""
WITH {_EV_SQL},
r AS (SELECT *, {_RANK_SQL} AS rk FROM se),
x AS (SELECT order_id, status, max(status_ts) OVER (PARTITION BY order_id) AS last_status_ts,
             row_number() OVER (PARTITION BY order_id ORDER BY rk DESC, event_id DESC) AS rn
      FROM r WHERE rk IS NOT NULL)
SELECT order_id, status AS final_status, last_status_ts FROM x WHERE rn = 1
""")
def q_order_final_status(spark, d):
    """E2 over E1: the last stage reached in lifecycle order per order."""
    return LC.final_status(status_events(spark, d))


EVENT_STAGES = ["signup", "view", "click", "purchase", "error"]


@query("final_status", """
WITH r AS (SELECT user_id, event_type, event_id, ts,
             CASE event_type WHEN 'signup' THEN 0 WHEN 'view' THEN 1 WHEN 'click' THEN 2
                             WHEN 'purchase' THEN 3 WHEN 'error' THEN 4 END AS rk FROM events),
x AS (SELECT user_id, event_type, max(ts) OVER (PARTITION BY user_id) AS last_status_ts,
             row_number() OVER (PARTITION BY user_id ORDER BY rk DESC, event_id DESC) AS rn
      FROM r WHERE rk IS NOT NULL)
SELECT user_id, event_type AS final_status, last_status_ts FROM x WHERE rn = 1
""")
def q_final_status(spark, d):
    """E2 on the event feed: the furthest stage each user reached, in stage
    order (signup < view < click < purchase < error), not by time."""
    ev = dt.table(spark, d, "events")
    return LC.final_status(ev, key="user_id", status_col="event_type", stages=EVENT_STAGES,
                           ts_col="ts")


# --- E3 / E4 / E8 -------------------------------------------------------------
@query("shipment_status", """
WITH a AS (SELECT l_orderkey, min(CASE WHEN l_linestatus = 'F' THEN l_shipdate END) AS arr
           FROM lineitem GROUP BY l_orderkey)
SELECT o.o_orderkey AS shipment_id,
       CASE o.o_orderstatus WHEN 'O' THEN 'in_transit' WHEN 'P' THEN 'partially_delivered'
                            ELSE 'delayed' END AS status_raw,
       a.arr AS actual_arrival,
       CASE WHEN a.arr IS NULL THEN (CASE o.o_orderstatus WHEN 'O' THEN 'in_transit'
                                     WHEN 'P' THEN 'partially_delivered' ELSE 'delayed' END)
            WHEN o.o_orderstatus = 'P' THEN 'partially_delivered' ELSE 'delivered' END AS status
FROM orders o LEFT JOIN a ON a.l_orderkey = o.o_orderkey
""")
def q_shipment_status(spark, d):
    """Arrived -> delivered unless partially delivered; else unchanged."""
    arr = (dt.order_lines(spark, d).groupBy("order_id")
           .agg(F.min(F.when(F.col("line_status") == "F", F.col("ship_date"))).alias("actual_arrival")))
    raw = (F.when(F.col("status") == "O", "in_transit").when(F.col("status") == "P",
                                                              "partially_delivered")
           .otherwise("delayed"))
    s = (dt.orders(spark, d).join(arr, "order_id", "left")
         .select(F.col("order_id").alias("shipment_id"), raw.alias("status_raw"), "actual_arrival"))
    return s.withColumn("status", reconcile_shipment_status("status_raw", "actual_arrival"))


@query("advance_status", f"""
WITH {_LO_SQL},
tr(status, next_status, source_system) AS (VALUES ('new','confirmed','erp'),
   ('confirmed','assembled','wms'), ('assembled','delivered','tms'), ('shipped','delivered','tms'),
   ('in_transit','delivered','tms'), ('delayed','delivered','tms'),
   ('partially_delivered','delivered','tms'))
SELECT lo.order_id, lo.status, tr.next_status, tr.source_system
FROM lo JOIN tr ON tr.status = lo.status
""")
def q_advance_status(spark, d):
    """The late-change transition of each order (closed orders have none)."""
    return LC.advance_status(lifecycle_orders(spark, d)).select(
        "order_id", "status", "next_status", "source_system")


@query("change_base_time", f"""
WITH {_LO_SQL}
SELECT order_id, greatest(updated_at, created_at) + INTERVAL 30 MINUTE AS ts_base FROM lo
""")
def q_change_base_time(spark, d):
    """Base time of a late change = max(updated, created) + 30 min."""
    return LC.change_base_time(lifecycle_orders(spark, d)).select("order_id", "ts_base")


# --- F3 / L4 / L7 / J3 -------------------------------------------------------
@query("open_recent_orders", f"""
WITH {_LO_SQL}
SELECT order_id, status, created_at FROM lo
WHERE created_at >= {_TODAY_SQL} - INTERVAL 7 DAY AND status NOT IN ('delivered', 'cancelled')
""")
def q_open_recent_orders(spark, d):
    """orders of the last 7 days that are neither delivered nor cancelled."""
    return LC.open_recent_orders(lifecycle_orders(spark, d), today(spark, d)).select(
        "order_id", "status", "created_at")


@query("top_recent_orders", f"""
WITH {_LO_SQL}
SELECT order_id, status, created_at FROM lo WHERE status NOT IN ('delivered', 'cancelled')
ORDER BY created_at DESC, order_id LIMIT 300
""")
def q_top_recent_orders(spark, d):
    """L4: the newest 300 open orders (a top-k report)."""
    o = lifecycle_orders(spark, d).filter(~F.col("status").isin("delivered", "cancelled"))
    return C.top_recent(o.select("order_id", "status", "created_at"), 300, "created_at",
                        ["order_id"])


_SAMPLE_COLS = "order_id, status, created_at"


@query("sample_recent", f"""
WITH {_LO_SQL},
o AS (SELECT {_SAMPLE_COLS} FROM lo WHERE created_at >= {_TODAY_SQL} - INTERVAL 30 DAY
      AND status NOT IN ('delivered', 'cancelled')),
n AS (SELECT least(count(*), least(60, greatest(10, CAST(trunc(count(*) * 0.2) AS BIGINT)))) AS n
      FROM o),
r AS (SELECT *, row_number() OVER (ORDER BY md5(concat_ws('|', 'recent', order_id)),
        order_id NULLS FIRST, status NULLS FIRST, created_at NULLS FIRST) AS rn FROM o)
SELECT {_SAMPLE_COLS} FROM r, n WHERE r.rn <= n.n
""")
def q_sample_recent(spark, d):
    """Bounded md5 sample of the open orders of the last 30 days:
    min(60, max(10, 20 %)) rows, never more than there are."""
    o = LC.open_recent_orders(lifecycle_orders(spark, d), today(spark, d), days=30)
    return C.sample_bounded(o.select("order_id", "status", "created_at"), "recent", ["order_id"])


@query("orders_lookup", """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
       o_totalprice AS total_price, o_orderdate AS created_at, o_orderpriority AS priority
FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')
""")
def q_orders_lookup(spark, d):
    """Order columns for a set of picked ids (orders with a returned
    line) as one join instead of a query per id."""
    picked = dt.order_lines(spark, d).filter(F.col("return_flag") == "R").select("order_id").distinct()
    o = dt.orders(spark, d)
    return LC.lookup_orders(picked, o, o.columns)


# --- J4 / J5 -----------------------------------------------------------------
@query("attach_first_shipment", f"""
WITH {_LS_SQL}, {_FS_SQL}
SELECT o.o_orderkey AS order_id, fs.shipment_id, fs.shipped_at, fs.estimated_arrival,
       fs.actual_arrival
FROM orders o LEFT JOIN fs ON fs.order_id = o.o_orderkey
""")
def q_attach_first_shipment(spark, d):
    """The first shipment of every order, or nulls."""
    o = dt.orders(spark, d).select("order_id")
    return LC.attach_shipment(o, line_shipments(spark, d))


@query("orders_without_lines", """
SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
       o_orderdate AS created_at
FROM orders o WHERE NOT EXISTS (SELECT 1 FROM lineitem l WHERE l.l_orderkey = o.o_orderkey)
""")
def q_orders_without_lines(spark, d):
    """Orders with no line (left anti join)."""
    o = dt.orders(spark, d).select("order_id", "customer_id", "status", "created_at")
    return LC.orders_without(o, dt.order_lines(spark, d))


# --- P6 / P7 / P8 / P10 / P11 ---------------------------------------------------
AS_OF = _dt.date(1998, 6, 1)
_PAY_SQL = """pm AS (SELECT o_orderkey AS order_id, o_orderstatus,
    CAST(o_totalprice AS DECIMAL(14,2)) AS amount_total,
    CASE o_orderpriority WHEN '1-URGENT' THEN CAST(o_totalprice AS DECIMAL(14,2))
         WHEN '2-HIGH' THEN CAST(round(CAST(o_totalprice AS DECIMAL(14,2)) * 0.5, 2) AS DECIMAL(14,2))
         ELSE CAST(0 AS DECIMAL(14,2)) END AS amount_paid,
    CAST(o_orderdate AS DATE) + 30 AS due_date FROM orders),
ps AS (SELECT *, CASE WHEN amount_paid >= amount_total THEN 'paid' WHEN amount_paid > 0 THEN 'partial'
                      WHEN due_date > DATE '1998-06-01' THEN 'planned' ELSE 'overdue' END
                 AS payment_status FROM pm)"""


def payments(spark, d):
    o = dt.orders(spark, d)
    total = F.col("total_price").cast(dec(14, 2))
    paid = (F.when(F.col("priority") == "1-URGENT", total)
            .when(F.col("priority") == "2-HIGH", F.round(total * F.lit(Decimal("0.5")), 2))
            .otherwise(F.lit(0)).cast(dec(14, 2)))
    return o.select("order_id", "status", total.alias("amount_total"), paid.alias("amount_paid"),
                    F.date_add(F.to_date("created_at"), 30).alias("due_date"))


@query("payment_status", f"""
WITH {_PAY_SQL}
SELECT order_id, amount_total, amount_paid, due_date, payment_status FROM ps
""")
def q_payment_status(spark, d):
    """Paid / partial / planned / overdue from amounts and due date
    (as of 1998-06-01; due that day is overdue)."""
    p = payments(spark, d).drop("status")
    return (O.with_payment_status(p, AS_OF, "payment_status")
            .select("order_id", "amount_total", "amount_paid", "due_date", "payment_status"))


@query("payment_mismatch", f"""
WITH {_PAY_SQL}
SELECT order_id, CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'planned' ELSE 'partial' END
         AS status, payment_status AS expected_status
FROM ps
WHERE CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'planned' ELSE 'partial' END
      IS DISTINCT FROM payment_status
""")
def q_payment_mismatch(spark, d):
    """Payments whose stored status disagrees with the amount/date rule."""
    p = payments(spark, d).withColumn(
        "status", F.when(F.col("status") == "F", "paid").when(F.col("status") == "O", "planned")
        .otherwise("partial"))
    return O.check_payments(p, AS_OF).select("order_id", "status", "expected_status")


_PL_SQL = """pl AS (SELECT l.l_orderkey AS order_id, l.l_linenumber AS line_number, l.l_partkey AS sku,
       l.l_suppkey AS supplier_id, CAST(l.l_quantity AS INTEGER) * p.p_size AS quantity,
       CAST(round(CAST(p.p_retailprice AS DECIMAL(10,2)) * (1 - CAST(CAST(l.l_discount
         AS DECIMAL(4,2)) * 100 AS DECIMAL(5,2)) * 0.01), 2) AS DECIMAL(10,2)) AS price_per_unit
       FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey)"""


@query("return_amounts", f"""
WITH {_PL_SQL}
SELECT r.l_orderkey AS order_id, r.l_linenumber AS line_number, r.l_partkey AS sku,
       r.l_suppkey AS supplier_id, CAST(r.l_quantity AS INTEGER) AS quantity,
       CAST(round(pl.price_per_unit * CAST(r.l_quantity AS INTEGER), 2) AS DECIMAL(14,2)) AS amount,
       greatest(1, CAST(trunc(pl.quantity * 0.1::DOUBLE) AS INTEGER)) AS max_quantity,
       CAST(r.l_quantity AS INTEGER) > greatest(1, CAST(trunc(pl.quantity * 0.1::DOUBLE) AS INTEGER))
         AS over_limit
FROM lineitem r JOIN pl ON pl.order_id = r.l_orderkey AND pl.line_number = r.l_linenumber
  AND pl.sku = r.l_partkey AND pl.supplier_id = r.l_suppkey
WHERE r.l_returnflag = 'R'
""")
def q_return_amounts(spark, d):
    """Returned lines (flag R, the packs as returned quantity) priced at
    the line's unit price; flags returns above 10 % of the line."""
    items = priced_lines(spark, d)
    rets = (dt.order_lines(spark, d).filter(F.col("return_flag") == "R")
            .select("order_id", "line_number", "sku", "supplier_id",
                    F.col("packs_ordered").alias("quantity")))
    return (O.return_amounts(items, rets, keys=("order_id", "line_number", "sku", "supplier_id"))
            .select("order_id", "line_number", "sku", "supplier_id", "quantity", "amount",
                    "max_quantity", "over_limit"))


@query("payment_times", f"""
WITH {_LO_SQL},
s AS (SELECT o.o_orderkey AS order_id, o.o_orderdate AS shipped,
             CASE WHEN o.o_orderkey % 5 <> 0 THEN min(l_shipdate) END AS arr
      FROM lineitem JOIN orders o ON o.o_orderkey = l_orderkey GROUP BY 1, 2)
SELECT lo.order_id, coalesce(s.arr, s.shipped, lo.updated_at) AS payment_base_ts,
       CASE WHEN lo.priority = '1-URGENT' THEN lo.updated_at + INTERVAL 1 DAY ELSE lo.updated_at END
         AS event_timestamp
FROM lo LEFT JOIN s ON s.order_id = lo.order_id
""")
def q_payment_times(spark, d):
    """P10: payment base time = arrival, else shipping time (every fifth
    order has not arrived), else last status time; event time = paid time
    (urgent orders), else last status time."""
    o = lifecycle_orders(spark, d).withColumn("paid_at", F.when(
        F.col("priority") == "1-URGENT", F.col("updated_at") + F.make_interval(days=F.lit(1))))
    ships = dt.shipments(spark, d).withColumn("actual_arrival", F.when(
        F.col("order_id") % 5 != 0, F.col("actual_arrival")))
    return O.payment_times(o, ships).select("order_id", "payment_base_ts", "event_timestamp")


@query("returnable", f"""
WITH {_LO_SQL}, {_LS_SQL}, {_FS_SQL}
SELECT lo.order_id, lo.status, fs.actual_arrival
FROM lo JOIN fs ON fs.order_id = lo.order_id
WHERE lo.status <> 'cancelled' AND fs.actual_arrival IS NOT NULL
""")
def q_returnable(spark, d):
    """Orders that are not cancelled and whose (first) shipment arrived."""
    j = LC.attach_shipment(lifecycle_orders(spark, d), line_shipments(spark, d).drop("status"))
    return O.returnable_orders(j).select("order_id", "status", "actual_arrival")


# --- E5 / E6 / E7 / E9: late changes read off the landed data ---------------------
_TO_SQL = """CASE WHEN actual_arrival IS NULL THEN status WHEN status = 'partially_delivered' THEN status
  ELSE 'delivered' END"""
_STORED_SQL = "CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'planned' ELSE 'partial' END"
_PAY_NOW_SQL = f"""pm AS (SELECT 'P-' || o_orderkey AS payment_id, {_STORED_SQL} AS stored,
    CAST(o_totalprice AS DECIMAL(14,2)) AS total,
    CASE o_orderpriority WHEN '1-URGENT' THEN CAST(o_totalprice AS DECIMAL(14,2))
         WHEN '2-HIGH' THEN CAST(round(CAST(o_totalprice AS DECIMAL(14,2)) * 0.5, 2) AS DECIMAL(14,2))
         ELSE CAST(0 AS DECIMAL(14,2)) END AS paid,
    CAST(o_orderdate AS DATE) + 30 AS due FROM orders),
lp AS (SELECT payment_id, CASE WHEN paid >= total THEN 'paid' WHEN paid > 0 THEN 'partial'
              WHEN due > CAST({_TODAY_SQL} AS DATE) THEN 'planned' ELSE 'overdue' END AS status, stored FROM pm)"""


def stored_payments(spark, d):
    p = payments(spark, d)
    stored = (F.when(F.col("status") == "F", "paid").when(F.col("status") == "O", "planned").otherwise("partial"))
    return p.withColumn("status", stored).withColumn(
        "payment_id", F.concat(F.lit("P-"), F.col("order_id").cast("string")))


@query("late_shipments", f"""
WITH {_LS_SQL}
SELECT shipment_id, {_TO_SQL} AS status, actual_arrival AS event_timestamp FROM ls
WHERE {_TO_SQL} <> status
""")
def q_late_shipments(spark, d):
    """E5: shipments whose landed arrival changes their status."""
    return LC.late_shipments(line_shipments(spark, d))


@query("late_payments", f"""
WITH {_PAY_NOW_SQL}
SELECT payment_id, status FROM lp WHERE status <> stored
""")
def q_late_payments(spark, d):
    """Payments whose stored status no longer fits the rule P6 on the
    day after the last order."""
    return LC.late_payments(stored_payments(spark, d), today(spark, d).date())


@query("late_returns", f"""
WITH {_LO_SQL}, {_LS_SQL}, {_FS_SQL}, {_PL_SQL},
ok AS (SELECT lo.order_id FROM lo JOIN fs ON fs.order_id = lo.order_id
       WHERE lo.status <> 'cancelled' AND fs.actual_arrival IS NOT NULL),
x AS (SELECT r.l_orderkey AS order_id, r.l_linenumber AS line_number, r.l_partkey AS sku, r.l_suppkey AS supplier_id,
             least(CAST(r.l_quantity AS INTEGER), greatest(1, CAST(trunc(pl.quantity * 0.05::DOUBLE) AS INTEGER)))
               AS quantity, pl.price_per_unit
      FROM lineitem r JOIN pl ON pl.order_id = r.l_orderkey AND pl.line_number = r.l_linenumber
        AND pl.sku = r.l_partkey AND pl.supplier_id = r.l_suppkey
      WHERE r.l_returnflag = 'R' AND r.l_orderkey IN (SELECT order_id FROM ok))
SELECT order_id, line_number, sku, supplier_id, quantity,
       CAST(round(price_per_unit * quantity, 2) AS DECIMAL(14,2)) AS amount FROM x
""")
def q_late_returns(spark, d):
    """The returned lines of orders that arrived (P11), at most 5 % of
    the line, priced at the line (P8)."""
    keys = ("order_id", "line_number", "sku", "supplier_id")
    rets = (dt.order_lines(spark, d).filter(F.col("return_flag") == "R")
            .select(*keys, F.col("packs_ordered").alias("quantity")))
    ship = line_shipments(spark, d).drop("status")
    arrived = O.returnable_orders(LC.attach_shipment(lifecycle_orders(spark, d), ship))
    return LC.late_returns(rets, priced_lines(spark, d), arrived, keys)


_PROGRESS_SQL = ("CASE {0} WHEN 'new' THEN 0 WHEN 'confirmed' THEN 1 WHEN 'assembled' THEN 2 WHEN 'shipped' THEN 3 "
                 "WHEN 'in_transit' THEN 4 WHEN 'delayed' THEN 5 WHEN 'partially_delivered' THEN 6 "
                 "WHEN 'delivered' THEN 7 WHEN 'cancelled' THEN 7 END")


@query("late_changes", f"""
WITH {_LO_SQL}, {_LS_SQL}, {_EV_SQL}, {_PAY_NOW_SQL},
s AS (SELECT order_id, count(*) AS n, count(actual_arrival) AS arrived, min(shipped_at) AS shipped,
             max(actual_arrival) AS arrival FROM ls GROUP BY 1),
hr AS (SELECT *, {_RANK_SQL} AS rk FROM se),
h AS (SELECT order_id, status AS final_status, last_status_ts FROM (
        SELECT order_id, status, max(status_ts) OVER (PARTITION BY order_id) AS last_status_ts,
               row_number() OVER (PARTITION BY order_id ORDER BY rk DESC, event_id DESC) AS rn
        FROM hr WHERE rk IS NOT NULL) WHERE rn = 1),
j AS (SELECT lo.order_id, lo.status,
        CASE WHEN s.n > 0 AND s.arrived = s.n THEN 'delivered' WHEN s.arrived > 0 THEN 'partially_delivered'
             WHEN s.shipped IS NOT NULL THEN 'in_transit' ELSE h.final_status END AS nxt,
        greatest(lo.updated_at, CASE WHEN s.arrived > 0 THEN s.arrival WHEN s.shipped IS NOT NULL THEN s.shipped
                                     ELSE h.last_status_ts END) AS at_ts
      FROM lo LEFT JOIN s ON s.order_id = lo.order_id LEFT JOIN h ON h.order_id = lo.order_id
      WHERE lo.status NOT IN ('delivered', 'cancelled')),
u AS (SELECT order_id, nxt AS status, at_ts FROM j
      WHERE {_PROGRESS_SQL.format("nxt")} > coalesce({_PROGRESS_SQL.format("status")}, -1))
SELECT 'order' AS entity, CAST(order_id AS VARCHAR) AS id, status, at_ts AS event_timestamp FROM u
UNION ALL SELECT 'shipment', shipment_id, {_TO_SQL}, actual_arrival FROM ls WHERE {_TO_SQL} <> status
UNION ALL SELECT 'payment', payment_id, status, NULL FROM lp WHERE status <> stored
UNION ALL SELECT 'status_event', 'ST-' || upper(md5(concat_ws(':', order_id, status,
    strftime(at_ts, '%Y-%m-%d %H:%M:%S.%f')))), status, at_ts FROM u
  WHERE NOT EXISTS (SELECT 1 FROM se WHERE se.order_id = u.order_id AND se.status = u.status AND se.status_ts = u.at_ts)
""")
def q_late_changes(spark, d):
    """The changes that landed shipments, payments and status events
    imply for all open orders, all four change sets in one list."""
    ch = LC.late_changes(lifecycle_orders(spark, d), line_shipments(spark, d), stored_payments(spark, d),
                         status_events(spark, d), today(spark, d).date())
    ts = "timestamp_ntz"

    def rows(entity, df, key):
        at = F.col("event_timestamp") if "event_timestamp" in df.columns else F.lit(None)
        return df.select(F.lit(entity).alias("entity"), F.col(key).cast("string").alias("id"), "status",
                         at.cast(ts).alias("event_timestamp"))
    return (rows("order", ch["orders"], "order_id").unionByName(rows("shipment", ch["shipments"], "shipment_id"))
            .unionByName(rows("payment", ch["payments"], "payment_id"))
            .unionByName(rows("status_event", ch["order_status_history"], "event_id")))
