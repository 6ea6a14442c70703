"""Order lifecycle, late changes and their lookups.

Every step is a set operation over all orders at once (joins against the
transition table, the first shipment per order, anti-joins).  Late changes
are read off the landed data: nothing is drawn or invented.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from orderflow.functions import ids, pricing as P
from orderflow.functions.time import ntz
from orderflow.functions.status import (CLOSED_STATUSES, LIFECYCLE, reconcile_shipment_status, stage_rank,
                                        transitions_table)
from orderflow.operators import changes as C
from orderflow.session import written


def status_event_id(key, status, ts):
    """Id of a status event: a status reached twice gives two events."""
    return ids.keyed_id("ST", key, status, ids.time_text(ts))


# --- E1 -------------------------------------------------------------------
def milestones_to_events(orders: DataFrame, milestones: list[tuple],
                         key: str = "order_id") -> DataFrame:
    """One status event per present milestone of an order.

    ``milestones``: (status, ts column, source system, reason column | None).
    Absent (null) milestones give no row.  One ``inline(array(struct))``
    per order: no join, no shuffle."""
    structs = []
    for status, ts_col, source, reason in milestones:
        structs.append(F.struct(
            F.lit(status).alias("status"),
            F.col(ts_col).cast("timestamp_ntz").alias("status_ts"),
            (F.col(reason) if reason else F.lit(None)).cast("string").alias("reason"),
            F.lit(source).alias("source_system")))
    ev = (orders.select(key, F.inline(F.array(*structs)))
          .filter(F.col("status_ts").isNotNull()))
    return ev.select(status_event_id(key, "status", "status_ts").alias("event_id"), key, "status",
                     "status_ts", "reason", "source_system",
                     F.col("status_ts").alias("event_timestamp"))


# --- E2 -------------------------------------------------------------------
def final_status(history: DataFrame, key: str = "order_id", status_col: str = "status",
                 stages: list[str] = LIFECYCLE, id_col: str = "event_id",
                 ts_col: str = "status_ts") -> DataFrame:
    """Last stage reached in lifecycle order (not by time) and the latest
    status time.  ``max_by`` over a (rank, id) struct: a two-phase aggregate
    (sort-based partial step), so hot keys are pre-aggregated before the
    shuffle."""
    rank = stage_rank(status_col, stages)
    return (history.filter(rank.isNotNull())
            .groupBy(key).agg(
                F.max_by(F.col(status_col), F.struct(rank, F.col(id_col))).alias("final_status"),
                F.max(ts_col).alias("last_status_ts")))


# --- F3 -------------------------------------------------------------------
def open_recent_orders(orders: DataFrame, today, days: int = 7,
                       created_col: str = "created_at", status_col: str = "status") -> DataFrame:
    """created_at >= today - days and status not closed (null status drops
    out, as in SQL)."""
    today_c = ntz(today)
    return orders.filter((F.col(created_col) >= today_c - F.make_interval(days=F.lit(days)))
                         & ~F.col(status_col).isin(*CLOSED_STATUSES))


# --- J3 / J4 / J5 -------------------------------------------------------------
def lookup_orders(picked: DataFrame, orders: DataFrame, cols: list[str],
                  key: str = "order_id") -> DataFrame:
    """Per-id lookup of order columns as one inner join; unknown ids drop."""
    return picked.select(key).join(orders.select(key, *[c for c in cols if c != key]), key)


def first_shipment(shipments: DataFrame, key: str = "order_id",
                   order_cols=("shipped_at", "shipment_id")) -> DataFrame:
    return C.first_per_key(shipments, [key], list(order_cols))


def attach_shipment(orders: DataFrame, shipments: DataFrame, key: str = "order_id",
                    cols=("shipment_id", "shipped_at", "estimated_arrival", "actual_arrival"),
                    order_cols=("shipped_at", "shipment_id")) -> DataFrame:
    """The first shipment of each order, or nulls (left join)."""
    need = list(dict.fromkeys([*cols, *order_cols]))
    s = first_shipment(shipments.select(key, *need), key, order_cols)
    return orders.join(s.select(key, *cols), key, "left")


def orders_without(orders: DataFrame, other: DataFrame, key: str = "order_id") -> DataFrame:
    """Orders with no row in ``other`` (left anti join)."""
    return orders.join(other.select(key), key, "left_anti")


# --- E4 -------------------------------------------------------------------
def advance_status(orders: DataFrame, status_col: str = "status") -> DataFrame:
    """Transition map: new -> confirmed (erp), confirmed -> assembled (wms),
    assembled / shipped / in_transit / delayed / partially_delivered ->
    delivered (tms).  Other statuses have no transition (inner join drops
    them).  The map is a fixed 7-row table, broadcast by hint."""
    tr = transitions_table(orders.sparkSession).withColumnRenamed("status", status_col)
    return orders.join(F.broadcast(tr), status_col, "inner")


# --- E8 -------------------------------------------------------------------
def change_base_time(orders: DataFrame, gap_minutes: int = 30) -> DataFrame:
    """ts_base = max(updated_at, created_at) + gap."""
    return orders.withColumn(
        "ts_base", F.greatest("updated_at", "created_at") + F.make_interval(mins=F.lit(gap_minutes)))


# --- E5-E9: late changes from what landed --------------------------------------
# FIXED VALUES: how far a status is along an order's way; a change never
# moves an order back
PROGRESS = ["new", "confirmed", "assembled", "shipped", "in_transit", "delayed",
            "partially_delivered", "delivered"]


def progress_rank(status):
    """Position on the order's way; cancelled closes it like delivered."""
    return F.when(status == "cancelled", F.lit(len(PROGRESS) - 1)).otherwise(stage_rank(status, PROGRESS))


def landed_evidence(shipments: DataFrame, history: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per order: shipment counts and times, and the status history's final
    status.  Both are map-side combined aggregates."""
    s = shipments.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("_n"), F.count("actual_arrival").alias("_arrived"),
        F.min("shipped_at").alias("_shipped"), F.max("actual_arrival").alias("_arrival"))
    return s, final_status(history)


def late_order_updates(orders: DataFrame, shipments: DataFrame, history: DataFrame) -> DataFrame:
    """The new status of every open order that landed data has moved on: all
    shipments arrived -> delivered, some -> partially_delivered, one under
    way -> in_transit, else the history's final status.  Its time is the
    arrival, the shipping or the status time, never before the last update."""
    s, h = landed_evidence(shipments, history)
    j = (orders.filter(~F.col("status").isin(*CLOSED_STATUSES))
         .select("order_id", "status", "updated_at").join(s, "order_id", "left").join(h, "order_id", "left"))
    to = (F.when((F.col("_n") > 0) & (F.col("_arrived") == F.col("_n")), F.lit("delivered"))
          .when(F.col("_arrived") > 0, F.lit("partially_delivered"))
          .when(F.col("_shipped").isNotNull(), F.lit("in_transit"))
          .otherwise(F.col("final_status")))
    at = (F.when(F.col("_arrived") > 0, F.col("_arrival")).when(F.col("_shipped").isNotNull(), F.col("_shipped"))
          .otherwise(F.col("last_status_ts")))
    j = j.withColumn("_to", to).withColumn("_at", F.greatest(at, F.col("updated_at")))
    moved = progress_rank(F.col("_to")) > F.coalesce(progress_rank(F.col("status")), F.lit(-1))
    return j.filter(moved).select("order_id", F.col("_to").alias("status"), F.col("_at").alias("updated_at"),
                                  F.col("_at").alias("event_timestamp"))


def late_shipments(shipments: DataFrame) -> DataFrame:
    """E5 with E3: shipments whose landed arrival changes their status."""
    to = reconcile_shipment_status("status", "actual_arrival")
    return (shipments.withColumn("_to", to).filter(~F.col("_to").eqNullSafe(F.col("status")))
            .select("shipment_id", F.col("_to").alias("status"), F.col("actual_arrival").alias("event_timestamp")))


def late_payments(payments: DataFrame, as_of) -> DataFrame:
    """E6 with P6: payments whose stored status no longer fits their amounts
    and due date as of the run day."""
    expected = P.payment_status("amount_total", "amount_paid", "due_date", F.lit(as_of).cast("date"))
    return (payments.withColumn("_to", expected).filter(~F.col("_to").eqNullSafe(F.col("status")))
            .select("payment_id", F.col("_to").alias("status")))


def late_returns(returns: DataFrame, items: DataFrame, delivered: DataFrame,
                 keys: tuple = ("order_id", "line_number")) -> DataFrame:
    """E7 with P8: landed returns on orders that arrived, at the largest
    quantity the late path allows (5 % of the line), priced at the line."""
    line = items.select(*keys, "price_per_unit", F.col("quantity").alias("_line_quantity"))
    kept = returns.join(delivered.select("order_id"), "order_id", "left_semi").join(line, list(keys))
    qty = F.least("quantity", P.max_return_quantity("_line_quantity", P.LATE_RETURN_SHARE))
    return kept.select(*keys, qty.alias("quantity"), P.return_amount("price_per_unit", qty).alias("amount"))


def late_status_events(updates: DataFrame, history: DataFrame) -> DataFrame:
    """One status event per order update that the history does not hold yet."""
    sources = transitions_table(updates.sparkSession).select(
        F.col("next_status").alias("status"), "source_system").distinct()
    ev = updates.join(F.broadcast(sources), "status", "left").select(
        status_event_id("order_id", "status", "updated_at").alias("event_id"), "order_id", "status",
        F.col("updated_at").alias("status_ts"), F.lit(None).cast("string").alias("reason"),
        F.coalesce("source_system", F.lit("tms")).alias("source_system"),
        F.col("updated_at").alias("event_timestamp"))
    return ev.join(history.select("order_id", "status", "status_ts"),
                   ["order_id", "status", "status_ts"], "left_anti").select(
        "event_id", "order_id", "status", "status_ts", "reason", "source_system", "event_timestamp")


def late_changes(orders: DataFrame, shipments: DataFrame, payments: DataFrame, history: DataFrame,
                 as_of) -> dict[str, DataFrame]:
    """The change sets that landed shipments, payments and history imply
    for all open orders.  The caller applies them with C3 (orders, shipments,
    payments) and C2 (history), and publishes them together.

    The order updates, which two of the sets need, are worked out once and
    written: one narrow row per order that moved."""
    updates = written(late_order_updates(orders, shipments, history), "order_updates")
    return {"orders": updates, "shipments": late_shipments(shipments),
            "payments": late_payments(payments, as_of),
            "order_status_history": late_status_events(updates, history)}
