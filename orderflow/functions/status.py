"""Order / shipment status rules (E2-E4) as Column expressions and small
fixed dimension tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# FIXED VALUES: order lifecycle stages in lifecycle order.  The final status
# of an order is the last stage reached in this order, not by time.
LIFECYCLE = ["new", "cancelled", "confirmed", "assembled", "shipped", "in_transit",
             "delayed", "delivered", "partially_delivered"]

# FIXED VALUES: late-change transitions (current status, next status, source system)
TRANSITIONS = [
    ("new", "confirmed", "erp"),
    ("confirmed", "assembled", "wms"),
    ("assembled", "delivered", "tms"),
    ("shipped", "delivered", "tms"),
    ("in_transit", "delivered", "tms"),
    ("delayed", "delivered", "tms"),
    ("partially_delivered", "delivered", "tms"),
]

# FIXED VALUES: statuses that close an order for late changes
CLOSED_STATUSES = ["delivered", "cancelled"]


def stage_rank(status: Column | str, stages: list[str] = LIFECYCLE) -> Column:
    """Position of a status in the lifecycle (null for unknown statuses)."""
    col = F.col(status) if isinstance(status, str) else status
    expr = None
    for i, s in enumerate(stages):
        expr = (F.when(col == s, F.lit(i)) if expr is None else expr.when(col == s, F.lit(i)))
    return expr


def reconcile_shipment_status(status: Column | str, actual_arrival: Column | str) -> Column:
    """Arrived -> delivered unless partially_delivered; not arrived -> unchanged."""
    st = F.col(status) if isinstance(status, str) else status
    arr = F.col(actual_arrival) if isinstance(actual_arrival, str) else actual_arrival
    return (F.when(arr.isNull(), st)
            .when(st == "partially_delivered", st)
            .otherwise(F.lit("delivered")))


def transitions_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(TRANSITIONS, "status string, next_status string, source_system string")
