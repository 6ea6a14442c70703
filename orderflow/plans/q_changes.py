"""Change application, per-key selection and sampling queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from orderflow.operators import changes as C
from orderflow.plans import driver_tables as dt
from orderflow.plans.registry import query
from orderflow.session import scratch_dir
from orderflow.sources import sinks as K

ORDER_COLS = ["order_id", "customer_id", "status", "total_price", "created_at", "priority"]

_T_SQL = """t AS (SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS status,
             o_totalprice AS total_price, o_orderdate AS created_at, o_orderpriority AS priority
      FROM orders)"""
# change batch: keys doubled (half hit existing orders, half are new), new
# status, a changed price (not an update column) and a null priority on F
_C_SQL = """c AS (SELECT o_orderkey * 2 AS order_id, o_custkey AS customer_id,
             lower(o_orderstatus) AS status, o_totalprice + 1 AS total_price,
             o_orderdate AS created_at,
             CASE WHEN o_orderstatus = 'F' THEN NULL ELSE o_orderpriority END AS priority
      FROM orders)"""
_UPSERT_SQL = f"""
WITH {_T_SQL}, {_C_SQL}
SELECT coalesce(t.order_id, c.order_id) AS order_id,
       CASE WHEN t.order_id IS NOT NULL THEN t.customer_id ELSE c.customer_id END AS customer_id,
       CASE WHEN c.order_id IS NOT NULL THEN c.status ELSE t.status END AS status,
       CASE WHEN t.order_id IS NOT NULL THEN t.total_price ELSE c.total_price END AS total_price,
       CASE WHEN t.order_id IS NOT NULL THEN t.created_at ELSE c.created_at END AS created_at,
       CASE WHEN c.order_id IS NOT NULL THEN c.priority ELSE t.priority END AS priority
FROM t FULL OUTER JOIN c ON t.order_id = c.order_id
"""


def order_target(spark, d):
    return dt.orders(spark, d).select(*ORDER_COLS)


def order_changes(spark, d):
    o = dt.orders(spark, d)
    return o.select((F.col("order_id") * 2).alias("order_id"), "customer_id",
                    F.lower("status").alias("status"),
                    (F.col("total_price") + 1).alias("total_price"), "created_at",
                    F.when(F.col("status") == "F", F.lit(None).cast("string"))
                    .otherwise(F.col("priority")).alias("priority"))


@query("upsert_orders", _UPSERT_SQL)
def q_upsert_orders(spark, d):
    """Upsert with update columns (status, priority); a null priority in
    the change overwrites the stored one."""
    return C.upsert(order_target(spark, d), order_changes(spark, d), ["order_id"],
                    ["status", "priority"])


@query("load_modes", f"""
WITH {_T_SQL}, {_C_SQL}, inc AS ({_UPSERT_SQL.replace(f"WITH {_T_SQL}, {_C_SQL}", "")})
SELECT 'historical' AS mode, * FROM c
UNION ALL SELECT 'incremental' AS mode, * FROM inc
""")
def q_load_modes(spark, d):
    """historical = rebuild from the batch; incremental = upsert onto the target."""
    t, c = order_target(spark, d), order_changes(spark, d)
    hist = C.load("historical", t, c, ["order_id"])
    inc = C.load("incremental", t, c, ["order_id"], ["status", "priority"])
    return (hist.select(F.lit("historical").alias("mode"), *ORDER_COLS)
            .unionByName(inc.select(F.lit("incremental").alias("mode"), *ORDER_COLS)))


LINE_COLS = ["order_id", "line_number", "sku", "supplier_id", "packs_ordered", "discount_pct",
             "return_flag", "line_status", "ship_date"]
_LINES_SQL = """lines AS (SELECT l_orderkey AS order_id, l_linenumber AS line_number,
  l_partkey AS sku, l_suppkey AS supplier_id, CAST(l_quantity AS INTEGER) AS packs_ordered,
  CAST(CAST(l_discount AS DECIMAL(4,2)) * 100 AS DECIMAL(5,2)) AS discount_pct,
  l_returnflag AS return_flag, l_linestatus AS line_status, l_shipdate AS ship_date
  FROM lineitem)"""
_LINE_ORDER = ("sku NULLS FIRST, supplier_id NULLS FIRST, packs_ordered NULLS FIRST, "
               "discount_pct NULLS FIRST, return_flag NULLS FIRST, line_status NULLS FIRST, "
               "ship_date NULLS FIRST")


def lines(spark, d):
    return dt.order_lines(spark, d).select(*LINE_COLS)


@query("insert_ignore_lines", f"""
WITH {_LINES_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY order_id, line_number ORDER BY {_LINE_ORDER}) AS rn
      FROM lines)
SELECT {", ".join(LINE_COLS)} FROM lines WHERE line_number = 1
UNION ALL SELECT {", ".join(LINE_COLS)} FROM r WHERE rn = 1 AND line_number <> 1
""")
def q_insert_ignore_lines(spark, d):
    """C2 onto the first lines of every order: their keys are known, and a
    new key repeated in the batch keeps its first row (by all remaining
    columns)."""
    batch = lines(spark, d)
    target = batch.filter(F.col("line_number") == 1)
    return C.insert_ignore(target, batch, ["order_id", "line_number"])


@query("insert_ignore_returns", f"""
WITH {_LINES_SQL},
t AS (SELECT * FROM lines WHERE return_flag = 'R'),
r AS (SELECT *, row_number() OVER (PARTITION BY order_id, line_number, sku, supplier_id
                                   ORDER BY packs_ordered NULLS FIRST, discount_pct NULLS FIRST,
                                   return_flag NULLS FIRST, line_status NULLS FIRST,
                                   ship_date NULLS FIRST) AS rn FROM lines),
n AS (SELECT {", ".join(LINE_COLS)} FROM r WHERE rn = 1 AND NOT EXISTS (
        SELECT 1 FROM t WHERE t.order_id = r.order_id AND t.line_number = r.line_number
          AND t.sku = r.sku AND t.supplier_id = r.supplier_id))
SELECT * FROM t UNION ALL SELECT * FROM n
""")
def q_insert_ignore_returns(spark, d):
    """C2 onto a non-empty target (the returned lines): only unseen keys of
    the batch are inserted."""
    batch = lines(spark, d)
    target = batch.filter(F.col("return_flag") == "R")
    return C.insert_ignore(target, batch, ["order_id", "line_number", "sku", "supplier_id"])


@query("first_line_per_order", f"""
WITH {_LINES_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY line_number NULLS FIRST,
                                   line_number NULLS FIRST, {_LINE_ORDER}) AS rn FROM lines)
SELECT {", ".join(LINE_COLS)} FROM r WHERE rn = 1
""")
def q_first_line_per_order(spark, d):
    """The first line of each order (by line number, then all columns)."""
    return C.first_per_key(lines(spark, d), ["order_id"], ["line_number"]).select(*LINE_COLS)


@query("sample_line_per_order", f"""
WITH {_LINES_SQL},
h AS (SELECT *, md5(concat_ws('|', 'lines', order_id, line_number, sku, supplier_id)) AS _h
      FROM lines),
r AS (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY _h,
        order_id NULLS FIRST, line_number NULLS FIRST, {_LINE_ORDER}) AS rn FROM h)
SELECT {", ".join(LINE_COLS)}, CAST(rn AS INTEGER) AS sample_rank FROM r WHERE rn <= 2
""")
def q_sample_line_per_order(spark, d):
    """Two lines per order without replacement in md5 order (a map-side
    top-2 per order before the shuffle)."""
    return (C.sample_per_key(lines(spark, d), ["order_id"], 2, "lines",
                             ["order_id", "line_number", "sku", "supplier_id"],
                             rank_col="sample_rank")
            .withColumn("sample_rank", F.col("sample_rank").cast("int")))


TOP_LINES = 1500


@query("top_lines_per_flag", f"""
WITH {_LINES_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY return_flag ORDER BY packs_ordered DESC NULLS LAST,
        order_id NULLS FIRST, line_number NULLS FIRST, {_LINE_ORDER}) AS rn FROM lines)
SELECT {", ".join(LINE_COLS)} FROM r WHERE rn <= {TOP_LINES}
""")
def q_top_lines_per_flag(spark, d):
    """L6 with few keys and a large n: the 1,500 largest lines of each return
    flag, cut per salted key before the shuffle by key."""
    return C.top_n_per_key(lines(spark, d), ["return_flag"], F.col("packs_ordered").desc_nulls_last(), TOP_LINES,
                           [F.col(c).asc_nulls_first() for c in LINE_COLS])


@query("update_by_key", """
WITH c AS (SELECT l_orderkey AS order_id, 'shipped' AS status, max(l_shipdate) AS updated_at
           FROM lineitem GROUP BY l_orderkey)
SELECT o.o_orderkey AS order_id, coalesce(c.status, o.o_orderstatus) AS status,
       CASE WHEN c.order_id IS NOT NULL THEN c.updated_at ELSE o.o_orderdate END AS updated_at,
       o.o_orderpriority AS priority
FROM orders o LEFT JOIN c ON c.order_id = o.o_orderkey
""")
def q_update_by_key(spark, d):
    """Orders take status and updated_at from a change set keyed by
    order (the last ship date of its lines); orders without a change keep
    their values."""
    target = dt.orders(spark, d).select("order_id", "status",
                                        F.col("created_at").alias("updated_at"), "priority")
    ch = (dt.order_lines(spark, d).groupBy("order_id")
          .agg(F.max("ship_date").alias("updated_at"))
          .withColumn("status", F.lit("shipped")))
    return C.update_by_key(target, ch, ["order_id"], ["status", "updated_at"])


_LANDED_SQL = """landed AS (
  SELECT o_orderkey AS order_id, o_orderstatus AS status, o_orderdate AS event_timestamp,
         CAST(o_orderdate AS DATE) AS data_date FROM orders
  UNION ALL
  SELECT l_orderkey, 'line_' || l_linestatus, l_shipdate, CAST(l_shipdate AS DATE) FROM lineitem)"""


@query("current_state_bucketed", f"""
WITH {_LANDED_SQL},
r AS (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY event_timestamp DESC NULLS LAST,
        data_date DESC NULLS LAST, status DESC NULLS LAST) AS rn FROM landed)
SELECT order_id, status, event_timestamp, data_date FROM r WHERE rn = 1
""")
def q_current_state_bucketed(spark, d):
    """C4 off a table that two landings bucketed by key: the pick reads it
    without a shuffle."""
    root = scratch_dir(spark, "bucketed")
    name = "landed_" + root.rsplit("-", 1)[1]
    orders_, lines_ = landed_versions(spark, d)
    K.land_bucketed(orders_, name, root, ["order_id"], 16)
    return C.current_state(K.land_bucketed(lines_, name, root, ["order_id"], 16), ["order_id"])


@query("current_state", """
WITH landed AS (
  SELECT o_orderkey AS order_id, o_orderstatus AS status, o_orderdate AS event_timestamp,
         CAST(o_orderdate AS DATE) AS data_date FROM orders
  UNION ALL
  SELECT l_orderkey, 'line_' || l_linestatus, l_shipdate, CAST(l_shipdate AS DATE) FROM lineitem),
r AS (SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY event_timestamp DESC NULLS LAST,
        data_date DESC NULLS LAST, status DESC NULLS LAST) AS rn FROM landed)
SELECT order_id, status, event_timestamp, data_date FROM r WHERE rn = 1
""")
def q_current_state(spark, d):
    """C4: one order landed in several data_date partitions (each status
    change moves event_timestamp); the current row has the latest
    (event_timestamp, data_date)."""
    o, li = landed_versions(spark, d)
    return C.current_state(o.unionByName(li), ["order_id"])


def landed_versions(spark, d):
    o = dt.orders(spark, d).select("order_id", "status",
                                   F.col("created_at").alias("event_timestamp"),
                                   F.to_date("created_at").alias("data_date"))
    li = dt.order_lines(spark, d).select(
        "order_id", F.concat(F.lit("line_"), F.col("line_status")).alias("status"),
        F.col("ship_date").alias("event_timestamp"), F.to_date("ship_date").alias("data_date"))
    return o, li


@query("append_batches", """
SELECT event_id, ts AS "timestamp", user_id AS shipment_id, event_type, value, props FROM events
""")
def q_append_batches(spark, d):
    """The feed arrives as separate batches (one per event type); the
    union by name restores the whole feed."""
    feed = dt.tracking_feed(spark, d)
    types = ["click", "view", "purchase", "signup", "error"]
    parts = [feed.filter(F.col("event_type") == t) for t in types]
    parts.append(feed.filter(~F.col("event_type").isin(*types) | F.col("event_type").isNull()))
    return C.append_batches(parts)
