"""Sources: JDBC or Parquet tables, day windows, page envelopes, landed
JSON Lines (S0-S7)."""

from __future__ import annotations

import os
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from orderflow.functions.calendar import day_window
from orderflow.functions.time import ntz
from orderflow.schemas import TRACKING_EVENT, envelope


# --- S0 -------------------------------------------------------------------
@dataclass
class Source:
    """Where tables come from: ``kind='jdbc'`` (url + properties, tables
    named ``schema.table``) or ``kind='parquet'`` (one folder per table)."""
    kind: str
    url: str = ""
    schema: str = ""
    options: dict = field(default_factory=dict)
    root: str = ""

    def table_name(self, table: str) -> str:
        return f"{self.schema}.{table}" if self.schema else table


def source_options(env: dict | None = None, prefix: str = "ORDERFLOW_SOURCE_",
                   schema: str = "source") -> Source:
    """JDBC source from environment variables with defaults (host, port,
    db, user, password); a ``PARQUET_ROOT`` entry selects Parquet instead."""
    env = dict(os.environ if env is None else env)
    if env.get(prefix + "PARQUET_ROOT"):
        return Source(kind="parquet", root=env[prefix + "PARQUET_ROOT"])
    host = env.get(prefix + "HOST", "localhost")
    port = env.get(prefix + "PORT", "5432")
    db = env.get(prefix + "DB", "orders")
    return Source(kind="jdbc", url=f"jdbc:postgresql://{host}:{port}/{db}", schema=schema,
                  options={"user": env.get(prefix + "USER", "admin"),
                           "password": env.get(prefix + "PASSWORD", "admin"),
                           "driver": env.get(prefix + "DRIVER", "org.postgresql.Driver")})


# --- S1 -------------------------------------------------------------------
def read_snapshot(spark: SparkSession, src: Source, table: str,
                  partition: dict | None = None) -> DataFrame:
    """Whole-table read.  A JDBC read is split into ``numPartitions``
    parallel range queries when ``partition`` gives ``column, lowerBound,
    upperBound, numPartitions``."""
    if src.kind == "parquet":
        return spark.read.parquet(f"{src.root.rstrip('/')}/{table}")
    if src.kind != "jdbc":
        raise ValueError(f"unknown source kind {src.kind!r}")
    return spark.read.format("jdbc").options(**jdbc_options(src, table, partition)).load()


def jdbc_options(src: Source, table: str, partition: dict | None = None) -> dict[str, str]:
    """Reader options of one table; with ``partition`` the read is split."""
    out = {"url": src.url, "dbtable": src.table_name(table), **src.options}
    if partition:
        out |= {"partitionColumn": partition["column"], "lowerBound": str(partition["lowerBound"]),
                "upperBound": str(partition["upperBound"]),
                "numPartitions": str(partition["numPartitions"])}
    return out


# --- S2 -------------------------------------------------------------------
def window_partitions(ts_col: str, start, end, num_partitions: int) -> dict:
    """JDBC partitioning of a time window: ``num_partitions`` range queries
    on ``ts_col`` between the window bounds (Spark splits timestamp columns
    evenly), so one day is extracted by that many parallel tasks."""
    if num_partitions < 1:
        raise ValueError("num_partitions must be >= 1")
    return {"column": ts_col, "lowerBound": start.isoformat(sep=" "),
            "upperBound": end.isoformat(sep=" "), "numPartitions": num_partitions}


def read_day_window(spark: SparkSession, src: Source, table: str, ts_col: str,
                    data_date: str, lookback_days: int = 0,
                    partition: dict | None = None, df: DataFrame | None = None,
                    num_partitions: int | None = None) -> DataFrame:
    """Rows with ``start <= ts < end`` (half-open) for the run date; both
    bounds are pushed to the source (JDBC WHERE / Parquet row-group
    filters).  ``lookback_days`` widens the start to re-pick late rows.
    With ``num_partitions`` a JDBC source is read as that many parallel
    range queries over the window."""
    start, end, _ = day_window(data_date, lookback_days)
    if partition is None and num_partitions and src.kind == "jdbc":
        partition = window_partitions(ts_col, start, end, num_partitions)
    base = df if df is not None else read_snapshot(spark, src, table, partition)
    lo, hi = ntz(start), ntz(end)
    ts = F.col(ts_col)
    return base.filter((ts >= lo) & (ts < hi))


# --- S4 -------------------------------------------------------------------
JDBC_WINDOW_PARTITIONS = 8


@dataclass
class TableSpec:
    name: str                 # landing name
    kind: str                 # "incremental" | "snapshot"
    ts_col: str | None = None
    source: str | None = None  # table name at the source, when it differs
    partition: dict | None = None  # JDBC split: column, lowerBound, upperBound, numPartitions

    @property
    def source_table(self) -> str:
        return self.source or self.name


def default_specs() -> list[TableSpec]:
    from orderflow.schemas import INCREMENTAL_TABLES, SNAPSHOT_TABLES
    return ([TableSpec(t, "incremental", c) for t, c in INCREMENTAL_TABLES.items()]
            + [TableSpec(t, "snapshot") for t in SNAPSHOT_TABLES])


def extract_table(spark: SparkSession, src: Source, spec: TableSpec, data_date: str,
                  lookback_days: int = 0, num_partitions: int | None = None) -> DataFrame:
    """Route one table by its spec; an unknown kind is an error.  A JDBC
    table is split by the spec's ``partition``; a day window without one is
    split on its own time bounds into ``num_partitions`` (8 by default)."""
    if spec.kind == "incremental":
        return read_day_window(spark, src, spec.source_table, spec.ts_col, data_date,
                               lookback_days, partition=spec.partition,
                               num_partitions=num_partitions or JDBC_WINDOW_PARTITIONS)
    if spec.kind == "snapshot":
        return read_snapshot(spark, src, spec.source_table, spec.partition)
    raise ValueError(f"unknown table kind {spec.kind!r} for {spec.name}")


# --- S5 -------------------------------------------------------------------
# FIXED VALUES: the columns tracking needs
SHIPPED_COLS = ["shipment_id", "order_id", "delivery_address", "status", "carrier",
                "vehicle_plate", "driver_name", "temperature_zone", "shipped_at",
                "estimated_arrival", "actual_arrival"]


def shipped_shipments(shipments: DataFrame) -> DataFrame:
    """The 11 columns tracking needs, for shipped shipments only."""
    return shipments.filter(F.col("shipped_at").isNotNull()).select(
        *[c for c in SHIPPED_COLS if c in shipments.columns])


# --- S6 -------------------------------------------------------------------
def read_page_envelopes(spark: SparkSession, path: str,
                        event_schema: T.StructType = TRACKING_EVENT) -> DataFrame:
    """Landed pages ``{data: [...], pagination: {...}}`` (one envelope per
    JSON line) -> one row per event.  A page without ``data`` or
    ``pagination`` fails the job.  The pages of one pull are the files of one
    folder; of each pull, pages 1..``pages`` are read up to the first empty
    page, as a page loop would.

    Each envelope is bounded (page size <= 1000), so a task holds at most
    one page of events at a time; the stop rule is one row per pull."""
    env = (spark.read.schema(envelope(event_schema)).json(path)
           .withColumn("_pull", F.regexp_replace(F.col("_metadata.file_path"), "/[^/]*$", "")))
    ok = F.when(F.col("data").isNull() | F.col("pagination").isNull(),
                F.raise_error(F.lit("Invalid response: need data and pagination"))).otherwise(F.lit(True))
    pages = env.select("_pull", F.col("pagination.page").alias("_page"),
                       F.col("pagination.pages").alias("_pages"), F.size("data").alias("_n"),
                       ok.alias("_ok"), "data")
    stop = pages.groupBy("_pull").agg(
        F.min(F.when(F.col("_n") == 0, F.col("_page"))).alias("_first_empty"),
        F.greatest(F.max("_pages"), F.lit(1)).alias("_last"))
    page = F.col("_page")
    return (pages.join(stop, "_pull")
            .filter(F.col("_ok") & F.coalesce(page <= F.col("_last"), F.lit(True))
                    & F.coalesce(page <= F.col("_first_empty"), F.lit(True)))
            .select(F.inline("data")))


# --- S7 -------------------------------------------------------------------
def read_landed_tracking(spark: SparkSession, root: str,
                         schema: T.StructType = TRACKING_EVENT) -> DataFrame:
    """JSON Lines under ``dt=`` folders with an explicit schema; ``dt`` is
    a partition column (pruned by a filter on it)."""
    if "dt" not in schema.fieldNames():
        schema = T.StructType(schema.fields + [T.StructField("dt", T.DateType(), True)])
    return (spark.read.schema(schema)
            .option("timestampNTZFormat", "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]")
            .json(root))
