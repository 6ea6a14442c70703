"""Explicit schemas, keys and update-column lists of the order data model.

FIXED VALUES: the column names, types, keys and update lists below are the
declared source data model and must stay as they are for results to match.
"""

from __future__ import annotations

from pyspark.sql import types as T

S = T.StringType()
I = T.IntegerType()
L = T.LongType()
B = T.BooleanType()
DT = T.DateType()
TS = T.TimestampNTZType()
D = T.DoubleType()


def dec(p: int, s: int) -> T.DecimalType:
    return T.DecimalType(p, s)


def _struct(fields) -> T.StructType:
    return T.StructType([T.StructField(n, t, nullable) for n, t, nullable in fields])


# --- FIXED VALUES: declared source tables (name, type, nullable) ----------
CUSTOMERS = _struct([
    ("customer_id", S, False), ("customer_name", S, False), ("customer_type", S, False),
    ("customer_inn", S, False), ("contract_number", S, True), ("payment_terms_days", I, True),
    ("discount_pct", dec(5, 2), True), ("customer_region", S, True),
    ("created_at", TS, False), ("updated_at", TS, False),
])

PRODUCTS = _struct([
    ("sku", S, False), ("product_name", S, False), ("brand", S, False), ("category", S, False),
    ("subcategory", S, True), ("volume", S, True), ("packaging", S, True), ("pack_qty", I, True),
    ("base_price", dec(10, 2), True), ("weight_kg", dec(10, 3), True),
    ("shelf_life_days", I, True), ("gost", S, True), ("fat_pct", dec(5, 1), True),
    ("halal_certified", B, True), ("created_at", TS, False), ("updated_at", TS, False),
])

ORDERS = _struct([
    ("order_id", S, False), ("supplier_name", S, False), ("supplier_inn", S, False),
    ("supplier_kpp", S, True), ("customer_id", S, False), ("customer_name", S, False),
    ("customer_type", S, False), ("customer_inn", S, False), ("customer_region", S, True),
    ("contract_number", S, True), ("warehouse_id", S, False), ("warehouse_name", S, True),
    ("warehouse_address", S, True), ("delivery_address", S, True),
    ("expected_delivery_date", DT, True), ("sales_manager_id", S, True),
    ("sales_manager_name", S, True), ("payment_method", S, True),
    ("payment_terms_days", I, True), ("total_lines", I, False), ("total_quantity", I, False),
    ("total_weight_kg", dec(12, 2), False), ("total_amount", dec(14, 2), False),
    ("total_vat", dec(14, 2), True), ("currency", S, True), ("status", S, False),
    ("cancel_reason", S, True), ("created_at", TS, False), ("updated_at", TS, False),
    ("event_timestamp", TS, False),
])

ORDER_ITEMS = _struct([
    ("order_id", S, False), ("line_number", I, False), ("sku", S, False),
    ("product_name", S, False), ("brand", S, False), ("category", S, False),
    ("subcategory", S, True), ("volume", S, True), ("packaging", S, True), ("pack_qty", I, True),
    ("packs_ordered", I, False), ("quantity", I, False), ("unit_of_measure", S, True),
    ("price_per_unit", dec(10, 2), False), ("price_before_discount", dec(10, 2), True),
    ("discount_pct", dec(5, 2), True), ("line_total", dec(14, 2), False),
    ("vat_rate", dec(4, 2), True), ("vat_amount", dec(14, 2), True),
    ("weight_kg", dec(12, 2), True), ("fat_pct", dec(5, 1), True), ("shelf_life_days", I, True),
    ("gost", S, True), ("halal_certified", B, True), ("best_before", DT, True),
    ("production_date", DT, True), ("event_timestamp", TS, False),
])

SHIPMENTS = _struct([
    ("shipment_id", S, False), ("order_id", S, False), ("customer_id", S, False),
    ("customer_name", S, True), ("warehouse_id", S, True), ("delivery_address", S, True),
    ("status", S, False), ("carrier", S, True), ("vehicle_plate", S, True),
    ("vehicle_type", S, True), ("driver_name", S, True), ("temperature_zone", S, True),
    ("temperature_actual", dec(4, 1), True), ("pallets_count", I, True),
    ("total_weight_kg", dec(12, 2), True), ("shipped_at", TS, True),
    ("estimated_arrival", TS, True), ("actual_arrival", TS, True),
    ("waybill_number", S, True), ("event_timestamp", TS, False),
])

ORDER_STATUS_HISTORY = _struct([
    ("event_id", S, False), ("order_id", S, False), ("status", S, False),
    ("status_ts", TS, False), ("reason", S, True), ("source_system", S, True),
    ("event_timestamp", TS, False),
])

PAYMENTS = _struct([
    ("payment_id", S, False), ("order_id", S, False), ("customer_id", S, False),
    ("method", S, True), ("status", S, False), ("amount_total", dec(14, 2), False),
    ("amount_paid", dec(14, 2), False), ("vat_amount", dec(14, 2), True),
    ("currency", S, True), ("due_date", DT, True), ("paid_at", TS, True),
    ("created_at", TS, False), ("event_timestamp", TS, False),
])

RETURNS = _struct([
    ("return_id", S, False), ("order_id", S, False), ("line_number", I, False),
    ("sku", S, False), ("quantity", I, False), ("amount", dec(14, 2), False),
    ("reason", S, True), ("created_at", TS, False), ("event_timestamp", TS, False),
])

TABLES = {
    "customers": CUSTOMERS, "products": PRODUCTS, "orders": ORDERS,
    "order_items": ORDER_ITEMS, "shipments": SHIPMENTS,
    "order_status_history": ORDER_STATUS_HISTORY, "payments": PAYMENTS, "returns": RETURNS,
}

# --- FIXED VALUES: primary keys ------------------------------------------
KEYS = {
    "customers": ["customer_id"], "products": ["sku"], "orders": ["order_id"],
    "order_items": ["order_id", "line_number"], "shipments": ["shipment_id"],
    "order_status_history": ["event_id"], "payments": ["payment_id"], "returns": ["return_id"],
}

# --- FIXED VALUES: declared foreign keys (child, column, parent, column) ---
FOREIGN_KEYS = [
    ("orders", "customer_id", "customers", "customer_id"),
    ("order_items", "order_id", "orders", "order_id"),
    ("order_items", "sku", "products", "sku"),
    ("shipments", "order_id", "orders", "order_id"),
    ("order_status_history", "order_id", "orders", "order_id"),
    ("payments", "order_id", "orders", "order_id"),
    ("returns", "order_id", "orders", "order_id"),
]

# --- FIXED VALUES: columns an upsert overwrites on an existing key ---------
UPDATE_COLUMNS = {
    "orders": ["status", "cancel_reason", "updated_at", "event_timestamp"],
    "shipments": ["status", "temperature_actual", "pallets_count", "total_weight_kg",
                  "shipped_at", "estimated_arrival", "actual_arrival", "event_timestamp"],
    "customers": ["customer_name", "customer_type", "customer_inn", "contract_number",
                  "payment_terms_days", "discount_pct", "customer_region", "updated_at"],
    "products": ["product_name", "brand", "category", "subcategory", "volume", "packaging",
                 "pack_qty", "base_price", "weight_kg", "shelf_life_days", "gost", "fat_pct",
                 "halal_certified", "updated_at"],
}

# Append-only tables: changes are applied with insert-ignore.
INSERT_IGNORE_TABLES = ["order_items", "order_status_history", "payments", "returns"]

# --- FIXED VALUES: column defaults ----------------------------------------
DEFAULTS = {
    "orders": {"currency": "RUB"},
    "order_items": {"unit_of_measure": "шт"},
    "order_status_history": {"source_system": "erp"},
    "payments": {"currency": "RUB"},
}

# --- FIXED VALUES: extract routing (incremental on event_timestamp / snapshot)
INCREMENTAL_TABLES = {t: "event_timestamp" for t in
                      ["orders", "order_items", "shipments", "order_status_history",
                       "payments", "returns"]}
SNAPSHOT_TABLES = ["customers", "products"]

# --- Tracking feed, page envelope, state ------------------------------------
TRACKING_EVENT = _struct([
    ("event_id", S, False), ("shipment_id", S, False), ("order_id", S, False),
    ("event_type", S, False), ("timestamp", TS, False), ("latitude", D, False),
    ("longitude", D, False), ("temperature_celsius", D, False), ("speed_kmh", I, False),
    ("vehicle_plate", S, True), ("carrier", S, True), ("driver_name", S, True),
    ("checkpoint", S, True), ("alert", S, True), ("alert_detail", S, True),
])

PAGINATION = _struct([("page", I, True), ("limit", I, True), ("total", L, True), ("pages", I, True)])


def envelope(event_schema: T.StructType) -> T.StructType:
    """``{data: [event], pagination: {...}, timestamp}`` around any event schema."""
    return _struct([
        ("data", T.ArrayType(event_schema), True),
        ("pagination", PAGINATION, True),
        ("timestamp", S, True),
    ])


WATERMARK = _struct([("last_timestamp", S, True), ("saved_at", S, True)])

ROUTE_POINT = _struct([("lat", D, False), ("lon", D, False), ("label", S, False)])
ROUTES = _struct([("city", S, False), ("ord", I, False), ("route", T.ArrayType(ROUTE_POINT), False)])

# FIXED VALUES: VARCHAR widths, for width checks (Q4)
WIDTHS = {
    "customers": {"customer_id": 32, "customer_name": 256, "customer_type": 32,
                  "customer_inn": 20, "contract_number": 64, "customer_region": 128},
    "orders": {"order_id": 64, "supplier_inn": 12, "supplier_kpp": 9, "customer_id": 32,
               "status": 32, "currency": 3, "cancel_reason": 256},
    "order_items": {"order_id": 64, "sku": 32, "unit_of_measure": 8},
}

# NUMERIC limits (Q4), as declared by the decimal columns above
NUMERICS = {name: {f.name: (f.dataType.precision, f.dataType.scale) for f in schema.fields
                   if isinstance(f.dataType, T.DecimalType)}
            for name, schema in TABLES.items()}
