"""Order pricing, totals and header operators.

Join strategy: dimension sides (customers, products, nations) are joined
with plain equi-joins.  Spark broadcasts them only when its size check
(``spark.sql.autoBroadcastJoinThreshold``, re-checked by AQE on runtime
statistics) says they are small; otherwise the join is a shuffle join.
Only literal in-code tables are broadcast by hint, since their size is fixed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from orderflow.functions import pricing as P
from orderflow.functions.time import ntz
from orderflow.schemas import dec

# FIXED VALUES: product attributes copied onto an order line
PRODUCT_ATTRS = ["product_name", "brand", "category", "subcategory", "volume", "packaging",
                 "pack_qty", "fat_pct", "shelf_life_days", "gost", "halal_certified"]


def _present(df: DataFrame, cols):
    return [c for c in cols if c in df.columns]


# --- J1 -------------------------------------------------------------------
def enrich_lines(lines: DataFrame, products: DataFrame, customers: DataFrame | None = None,
                 *, how: str = "inner") -> DataFrame:
    """Line ⋈ product (on sku) ⋈ customer (on customer_id): copies product
    attributes and the base price onto the line, and the customer discount
    when the line has none of its own."""
    prod_cols = ["sku"] + _present(products, PRODUCT_ATTRS + ["base_price", "weight_kg"])
    prod_cols = [c for c in prod_cols if c == "sku" or c not in lines.columns]
    out = lines.join(products.select(*prod_cols), "sku", how)
    if customers is not None and "discount_pct" not in lines.columns:
        out = out.join(customers.select("customer_id", "discount_pct"), "customer_id", how)
    return out


# --- P1 P2 P3 ---------------------------------------------------------------
def price_lines(lines: DataFrame) -> DataFrame:
    """quantity = packs * pack_qty; price = round(base * (1 - disc/100), 2);
    line_total = round(price * quantity, 2); VAT inside the total;
    weight = round(weight_kg * quantity, 2) when unit weights are known."""
    out = (lines
           .withColumn("quantity", P.line_quantity("packs_ordered", "pack_qty"))
           .withColumn("price_before_discount", F.col("base_price").cast(dec(10, 2)))
           .withColumn("price_per_unit", P.unit_price("base_price", "discount_pct"))
           .withColumn("line_total", P.line_total("price_per_unit", "quantity"))
           .withColumn("vat_rate", F.lit(P.VAT_RATE).cast(dec(4, 2)))
           .withColumn("vat_amount", P.vat_included("line_total")))
    if "weight_kg" in lines.columns:
        out = out.withColumn("weight_kg", P.line_weight("weight_kg", "quantity"))
    return out


def shelf_dates(lines: DataFrame, created_col: str = "event_timestamp") -> DataFrame:
    """production_date = order day, best_before = order time + shelf life."""
    return (lines.withColumn("production_date", P.production_date(created_col))
            .withColumn("best_before", P.best_before(created_col, "shelf_life_days")))


# --- A1 -------------------------------------------------------------------
def order_totals(items: DataFrame, key: str = "order_id") -> DataFrame:
    """Per order: line count, Σ quantity, Σ weight, Σ line_total, Σ VAT.

    A hash aggregate with map-side partial aggregation, so an order with a
    huge number of lines is combined before the shuffle."""
    aggs = [F.count(F.lit(1)).cast("int").alias("total_lines"),
            F.sum("quantity").cast("int").alias("total_quantity")]
    if "weight_kg" in items.columns:
        aggs.append(F.sum("weight_kg").cast(dec(12, 2)).alias("total_weight_kg"))
    aggs += [F.sum("line_total").cast(dec(14, 2)).alias("total_amount"),
             F.sum("vat_amount").cast(dec(14, 2)).alias("total_vat")]
    return items.groupBy(key).agg(*aggs)


# --- J2 -------------------------------------------------------------------
def enrich_orders(orders: DataFrame, customers: DataFrame | None = None,
                  warehouses: DataFrame | None = None, managers: DataFrame | None = None,
                  regions: DataFrame | None = None) -> DataFrame:
    """Star join into the denormalised header: each dimension is a left
    equi-join on its key, copying the attributes the order lacks.  An order
    whose dimension row is missing stays, with nulls; the foreign-key check
    (Q3) reports it."""
    out = orders
    for dim, key in ((customers, "customer_id"), (warehouses, "warehouse_id"),
                     (managers, "sales_manager_id"), (regions, "region_id")):
        if dim is None:
            continue
        cols = [key] + [c for c in dim.columns if c != key and c not in out.columns]
        out = out.join(dim.select(*cols), key, "left")
    return out


# --- P9 (flagship) ----------------------------------------------------------
HEADER_TOTALS = ["total_lines", "total_quantity", "total_weight_kg", "total_amount", "total_vat"]


def order_header(orders: DataFrame, lines: DataFrame, products: DataFrame,
                 customers: DataFrame | None = None, regions: DataFrame | None = None,
                 shipments: DataFrame | None = None, warehouses: DataFrame | None = None,
                 managers: DataFrame | None = None, history: DataFrame | None = None,
                 defaults: dict | None = None) -> DataFrame:
    """Priced order headers: J1 -> P1/P2 -> A1 -> J2, the final status and
    last change of the history (E2, A2) when there is one, and the delivery
    address of the first shipment when one exists.  ``defaults`` are header
    columns that are the same for every order (the supplier's details).

    Plan shape: lines ⋈ products (shuffle or size-checked broadcast) ->
    partial/final aggregate by order_id -> ⋈ orders on order_id (the
    aggregate's hash partitioning is reused, no extra exchange on that side)
    -> dimension joins.  Orders without lines keep zero totals.
    """
    priced = price_lines(enrich_lines(lines, products))
    totals = order_totals(priced)
    out = orders.join(totals, "order_id", "left")
    fill = {c: 0 for c in HEADER_TOTALS if c in totals.columns}
    for c, v in fill.items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v).cast(totals.schema[c].dataType)))
    if history is not None:
        from orderflow.operators.lifecycle import final_status
        last = final_status(history)
        out = (out.join(last, "order_id", "left")
               .withColumn("status", F.coalesce("final_status", "status"))
               .withColumn("updated_at", F.coalesce("last_status_ts", "created_at"))
               .withColumn("event_timestamp", F.col("updated_at")).drop("final_status", "last_status_ts"))
    out = enrich_orders(out, customers=customers, warehouses=warehouses, managers=managers, regions=regions)
    if shipments is not None:
        first = shipments.groupBy("order_id").agg(
            F.min(F.struct("shipped_at", "shipment_id", "delivery_address")).alias("_s"))
        out = (out.join(first, "order_id", "left")
               .withColumn("delivery_address",
                           F.coalesce(F.col("_s.delivery_address"), F.col("delivery_address")))
               .drop("_s"))
    for c, v in {"currency": "RUB", **(defaults or {})}.items():
        if c not in out.columns:
            out = out.withColumn(c, F.lit(v))
    return out


# --- A2 -------------------------------------------------------------------
def last_change(history: DataFrame, key: str = "order_id", ts: str = "status_ts") -> DataFrame:
    """updated_at = event_timestamp = latest status time of each order."""
    return (history.groupBy(key).agg(F.max(ts).alias("updated_at"))
            .withColumn("event_timestamp", F.col("updated_at")))


# --- A3 -------------------------------------------------------------------
def catalog_summary(products: DataFrame) -> DataFrame:
    """SKU count and distinct brand count (exact)."""
    return products.agg(F.count(F.lit(1)).alias("sku_count"),
                        F.countDistinct("brand").alias("brand_count"))


# --- A4 -------------------------------------------------------------------
def load_summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Row counts per entity of one load, one row per entity (an audit table)."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit(name).alias("entity"), F.col("row_count")) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


# --- A5 -------------------------------------------------------------------
def event_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("events_count"))


# --- F4 -------------------------------------------------------------------
def conform(df: DataFrame, schema) -> DataFrame:
    """Fixed column subset, order and types; a missing column is an error."""
    missing = [f.name for f in schema.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


# --- F5 -------------------------------------------------------------------
# FIXED VALUES: preferred categories per customer type (others: every product)
PREFERRED_CATEGORIES = {
    "horeca": ["сливки", "молоко", "сметана", "творог", "масло"],
    "government": ["молоко", "кефир", "творог", "масло", "сметана"],
}


EVERY = "*"


def eligibility_rules(types: DataFrame, products: DataFrame, preferred: dict[str, list[str]] | None = None, *,
                      type_col: str = "customer_type", n_col: str = "n_items",
                      category_col: str = "category") -> DataFrame:
    """The pools of each customer type, as rules (type, pool): the categories
    preferred for the type, or the one pool ``*`` (every product) for other
    types and when fewer than ``n`` products qualify."""
    preferred = PREFERRED_CATEGORIES if preferred is None else preferred
    pref = products.sparkSession.createDataFrame(
        [(t, c) for t, cats in preferred.items() for c in cats], f"{type_col} string, pool string")
    sizes = products.groupBy(F.col(category_col).alias("pool")).agg(F.count(F.lit(1)).alias("_size"))
    n_pref = pref.join(sizes, "pool").groupBy(type_col).agg(F.sum("_size").alias("_n_pref"))
    t = types.select(type_col, n_col).distinct().join(n_pref, type_col, "left")
    few = F.coalesce(F.col("_n_pref"), F.lit(0)) < F.col(n_col)
    return (t.filter(few).select(type_col, F.lit(EVERY).alias("pool"))
            .unionByName(t.filter(~few).join(pref, type_col).select(type_col, "pool")).distinct())


def eligible_products(types: DataFrame, products: DataFrame,
                      preferred: dict[str, list[str]] | None = None, *,
                      type_col: str = "customer_type", n_col: str = "n_items",
                      category_col: str = "category") -> DataFrame:
    """Product pool per customer type: ``eligibility_rules`` expanded to
    (type, sku).  A product is in the pool of its category and in ``*``, so
    the rules join on the pool (an equi-join; Spark broadcasts the rules if
    they are small)."""
    rules = eligibility_rules(types, products, preferred, type_col=type_col, n_col=n_col,
                              category_col=category_col)
    pools = products.select("sku", F.explode(F.array(F.col(category_col), F.lit(EVERY))).alias("pool"))
    return pools.join(rules, "pool").select(type_col, "sku")


# --- F6 -------------------------------------------------------------------
def build_reference(df: DataFrame, rename: dict[str, str], defaults: dict, now) -> DataFrame:
    """Master rows: rename fields, null -> default (0 / 0.0 / false), stamp
    created_at = updated_at = ``now`` (a parameter so runs repeat)."""
    cols = []
    for src, dst in rename.items():
        c = F.col(src)
        if dst in defaults:
            c = F.coalesce(c, F.lit(defaults[dst]))
        cols.append(c.alias(dst))
    ts = ntz(now)
    return df.select(*cols, ts.alias("created_at"), ts.alias("updated_at"))


# --- J7 -------------------------------------------------------------------
# FIXED VALUES: order profile per customer type (default: horeca)
ORDER_PROFILES = [
    ("retail_chain", 5, 18, 4, 80),
    ("distributor", 8, 25, 20, 200),
    ("government", 3, 10, 10, 60),
    ("horeca", 2, 6, 1, 8),
]
DEFAULT_PROFILE = "horeca"


def order_profiles(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        ORDER_PROFILES, "customer_type string, min_items int, max_items int, "
                        "min_packs int, max_packs int")


def lookup_with_default(df: DataFrame, dim: DataFrame, key: str,
                        defaults: dict[str, object], df_key: str | None = None) -> DataFrame:
    """Dictionary get with default: left join on ``key``; a miss takes the
    literal ``defaults`` (column -> value)."""
    d = dim.select(F.col(key).alias(df_key or key), *defaults.keys())
    out = df.join(d, df_key or key, "left")
    for c, v in defaults.items():
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(v).cast(dim.schema[c].dataType)))
    return out


def profile_for(df: DataFrame, type_col: str = "customer_type") -> DataFrame:
    """Order profile per row by customer type, horeca when unknown."""
    prof = order_profiles(df.sparkSession)
    dflt = {r[0]: r for r in ORDER_PROFILES}[DEFAULT_PROFILE]
    defaults = dict(zip(["min_items", "max_items", "min_packs", "max_packs"], dflt[1:]))
    return lookup_with_default(df, F.broadcast(prof), "customer_type", defaults, df_key=type_col)


# --- P6 / P7 ---------------------------------------------------------------
def with_payment_status(payments: DataFrame, as_of, out_col: str = "expected_status") -> DataFrame:
    as_of_col = as_of if isinstance(as_of, Column) else F.lit(as_of).cast("date")
    return payments.withColumn(out_col, P.payment_status("amount_total", "amount_paid",
                                                         "due_date", as_of_col))


def check_payments(payments: DataFrame, as_of) -> DataFrame:
    """Rows whose stored status disagrees with the amount/date rule."""
    return (with_payment_status(payments, as_of)
            .filter(~F.col("status").eqNullSafe(F.col("expected_status"))))


# --- P8 -------------------------------------------------------------------
def return_amounts(lines: DataFrame, returns: DataFrame, share: float = P.RETURN_SHARE,
                   keys: tuple = ("order_id", "line_number")) -> DataFrame:
    """Return ⋈ line on the line key: amount = round(price * qty, 2),
    allowed quantity = max(1, int(share * line quantity)), and a flag when
    the return asks for more."""
    l = lines.select(*keys, "price_per_unit", F.col("quantity").alias("line_quantity"))
    return (returns.join(l, list(keys), "inner")
            .withColumn("amount", P.return_amount("price_per_unit", "quantity"))
            .withColumn("max_quantity", P.max_return_quantity("line_quantity", share))
            .withColumn("over_limit", F.col("quantity") > F.col("max_quantity")))


# --- P10 ------------------------------------------------------------------
def payment_times(orders: DataFrame, shipments: DataFrame) -> DataFrame:
    """Base time of a payment = arrival, else shipping time, else last status
    time; event_timestamp = paid_at, else last status time."""
    s = shipments.groupBy("order_id").agg(
        F.min(F.struct("shipped_at", "shipment_id", "actual_arrival")).alias("_s"))
    out = orders.join(s, "order_id", "left")
    out = out.withColumn("payment_base_ts", F.coalesce(F.col("_s.actual_arrival"),
                                                       F.col("_s.shipped_at"),
                                                       F.col("updated_at")))
    if "paid_at" in out.columns:
        out = out.withColumn("event_timestamp", F.coalesce("paid_at", "updated_at"))
    return out.drop("_s")


# --- P11 ------------------------------------------------------------------
def returnable_orders(orders_with_shipment: DataFrame) -> DataFrame:
    """Not cancelled and arrived."""
    return orders_with_shipment.filter((F.col("status") != "cancelled")
                                       & F.col("actual_arrival").isNotNull())
