"""Bindings of the driver's test tables to the order data model.

Each function is a pure projection (select + alias + cast) of one parquet
table, so Catalyst prunes columns and pushes filters straight into the scan.

Roles: customers <- customer, products <- part (retail price = base price,
size = pack size and 50 g a piece, type = category), orders <- orders, order lines <-
lineitem (quantity = packs, discount fraction -> percent), regions <- nation,
warehouses <- supplier, sales managers <- region,
shipments <- one per order (order date = shipping time, earliest line ship
date = arrival), tracking feed <- events.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderflow.schemas import dec

TABLE_NAMES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem",
               "events", "documents", "embeddings", "pages", "benchmark", "labels",
               "conversations"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_mktsegment").alias("customer_type"),
        F.col("c_nationkey").alias("region_id"),
        F.col("c_acctbal").alias("account_balance"),
        F.lpad(F.col("c_custkey").cast("string"), 10, "0").alias("customer_inn"),
        F.concat(F.lit("C-"), F.col("c_custkey").cast("string")).alias("contract_number"),
        (F.col("c_custkey") % 4 * 15).cast("int").alias("payment_terms_days"),
        (F.col("c_custkey") % 15).cast(dec(5, 2)).alias("discount_pct"))


def warehouses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("warehouse_id"),
        F.col("s_name").alias("warehouse_name"),
        F.concat(F.col("s_name"), F.lit(", nation "), F.col("s_nationkey").cast("string"))
        .alias("warehouse_address"))


def managers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "region").select(
        F.col("r_regionkey").alias("sales_manager_id"),
        F.col("r_name").alias("sales_manager_name"))


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        F.col("n_nationkey").alias("region_id"),
        F.col("n_name").alias("customer_region"),
        F.col("n_regionkey").alias("macro_region_id"))


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("sku"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("brand"),
        F.col("p_type").alias("category"),
        F.col("p_size").alias("pack_qty"),
        F.col("p_retailprice").cast(dec(10, 2)).alias("base_price"),
        (F.col("p_size") * F.lit(Decimal("0.05"))).cast(dec(10, 3)).alias("weight_kg"))


def order_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("line_number"),
        F.col("l_partkey").alias("sku"),
        F.col("l_suppkey").alias("supplier_id"),
        F.col("l_quantity").cast("int").alias("packs_ordered"),
        (F.col("l_discount").cast(dec(4, 2)) * 100).cast(dec(5, 2)).alias("discount_pct"),
        F.col("l_returnflag").alias("return_flag"),
        F.col("l_linestatus").alias("line_status"),
        F.col("l_shipdate").alias("ship_date"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_totalprice").alias("total_price"),
        F.col("o_orderdate").alias("created_at"),
        F.col("o_orderpriority").alias("priority"))


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One shipment per order that has lines: shipped at the order date,
    arrived at the earliest ship date of its lines (may precede the start)."""
    arrivals = (table(spark, sf_dir, "lineitem")
                .groupBy(F.col("l_orderkey").alias("order_id"))
                .agg(F.min("l_shipdate").alias("actual_arrival")))
    return (orders(spark, sf_dir)
            .join(arrivals, "order_id", "inner")
            .select(F.col("order_id").cast("string").alias("shipment_id"),
                    "order_id", "customer_id",
                    F.col("created_at").alias("shipped_at"),
                    F.lit(None).cast("timestamp_ntz").alias("estimated_arrival"),
                    "actual_arrival"))


def tracking_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", F.col("ts").alias("timestamp"), F.col("user_id").alias("shipment_id"),
        "event_type", "value", "props")
