"""End-to-end jobs built from the operators.

* ``extract``: daily landing of the source tables into ``data_date=``
  partitions (S3 -> S4 -> S1/S2 -> K1).
* ``ingest_tracking``: high-water-mark pull of the tracking feed (W6),
  behind the new-data gate (W5).
* ``apply_changes``: one late-change run (E9) on the published tables.
* ``load_batch``: a historical or incremental load of the order tables (C5).

The last two publish all tables of a version together (sources/versions.py);
tables and partitions that a run does not touch are carried over.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession, functions as F

from orderflow.functions.calendar import day_window
from orderflow.operators import changes as C
from orderflow.operators.lifecycle import late_changes
from orderflow.operators.quality import apply_defaults
from orderflow.schemas import DEFAULTS, INSERT_IGNORE_TABLES, KEYS, TABLES, UPDATE_COLUMNS
from orderflow.session import checkpoint_root
from orderflow.sources import versions
from orderflow.sources.readers import Source, TableSpec, default_specs, extract_table
from orderflow.sources.sinks import write_days, write_partition
from orderflow.sources.state import has_new_data, incremental_pull, load_watermark, resolve_since


def extract(spark: SparkSession, src: Source, root: str, data_date: str,
            specs: list[TableSpec] | None = None, lookback_days: int = 0,
            num_partitions: int | None = None) -> dict[str, str]:
    """Land every table of ``specs`` for the run date.  A day window overwrites
    one partition folder; with ``lookback_days`` it overwrites the folder of
    every day of the window with that day's rows.  So a failed run can simply be
    repeated.  Returns the folder of the run date of each table."""
    start, end, label = day_window(data_date, lookback_days)
    written = {}
    for spec in specs or default_specs():
        df = extract_table(spark, src, spec, data_date, lookback_days, num_partitions)
        if lookback_days and spec.kind == "incremental":
            written[spec.name] = write_days(df, root, spec.name, spec.ts_col, start, end)[-1]
        else:
            written[spec.name] = write_partition(df, root, spec.name, label)
    return written


def ingest_tracking(spark: SparkSession, feed: DataFrame, landing: str, state_path: str,
                    run_dt: str | None = None, initial_since: str | None = None) -> dict:
    """One pull of the feed; when the gate finds nothing new, nothing is read
    further and nothing is landed."""
    run_dt = run_dt or _dt.datetime.now(_dt.timezone.utc).strftime("%Y-%m-%d")
    since = resolve_since(load_watermark(spark, state_path), initial_since)
    if not has_new_data(feed, since):
        return {"since": since, "landed": None, "watermark": since}
    return incremental_pull(spark, feed, state_path, landing, run_dt,
                            initial_since=initial_since)


def align(df: DataFrame, schema, defaults: dict | None = None) -> DataFrame:
    """The schema's columns, order and types.  A column the rows do not carry
    takes its declared default, else a typed null (for update columns the
    upsert then writes null)."""
    df = apply_defaults(df, defaults or {})
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None))
                       .cast(f.dataType).alias(f.name) for f in schema.fields])


# Order data is partitioned by the month a row was made in (a shipment's month
# is that of its last event: it moves with the row), snapshots by key.
LAYOUTS = {name: versions.Layout(col) for name, col in {
    "orders": "created_at", "order_items": "event_timestamp", "shipments": "event_timestamp",
    "order_status_history": "status_ts", "payments": "created_at", "returns": "created_at"}.items()}


def layout_of(name: str) -> versions.Layout:
    return LAYOUTS.get(name, versions.Layout())


def apply_changes(spark: SparkSession, out_root: str, as_of: _dt.date) -> int:
    """One late-change run on the published orders, shipments, payments and
    order_status_history; all changes are published together.  Only the
    months of changed rows are rewritten, and new status events are added
    without rewriting any.  Returns the version."""
    pub = versions.current(spark, out_root)
    if pub is None:
        raise ValueError(f"nothing is published in {out_root}")
    t = {n: versions.read(spark, out_root, n) for n in ("orders", "shipments", "payments", "order_status_history")}
    ch = late_changes(t["orders"], t["shipments"], t["payments"], t["order_status_history"], as_of)
    updated = {"orders": ["status", "updated_at", "event_timestamp"], "shipments": ["status", "event_timestamp"],
               "payments": ["status"]}
    checkpoint_root(spark)
    new = {}
    for n, df in ch.items():
        # each change set is used twice (its partitions, the merge): cut the lineage
        rows = df.checkpoint()
        if n in updated:
            new[n] = versions.merge_table(out_root, n, pub.tables[n], rows, KEYS[n],
                                          lambda old, c, n=n: C.update_by_key(old, c, KEYS[n], updated[n]), layout_of(n))
        else:
            new[n] = append(out_root, n, pub.tables[n], align(rows, pub.tables[n].schema))
    return versions.publish(spark, out_root, new, pub)


def append(root: str, name: str, old: versions.Table, rows: DataFrame) -> versions.Table:
    """Insert-ignore (C2) onto a published table: unseen keys become new files."""
    keys = KEYS[name]
    return versions.append_table(root, name, old, rows, keys, lambda known, c: C.unseen(known, c, keys),
                                 layout_of(name))


def load_batch(spark: SparkSession, mode: str, batch: dict[str, DataFrame], out_root: str) -> int:
    """C5 for a whole load: ``historical`` rebuilds the batch's tables from
    the batch; ``incremental`` upserts the snapshot tables (only their update
    columns) and insert-ignores the append-only ones onto the published
    tables.  Each table is conformed to its declared schema first.  Returns
    the version."""
    pub = versions.current(spark, out_root)
    new = {}
    for name, df in batch.items():
        if name not in TABLES:
            raise ValueError(f"unknown table {name!r}")
        rows = align(df, TABLES[name], DEFAULTS.get(name))
        if mode == "incremental":
            if pub is None or name not in pub.tables:
                raise ValueError(f"incremental load of {name} needs its published table")
            if name in INSERT_IGNORE_TABLES:
                new[name] = append(out_root, name, pub.tables[name], rows)
                continue

            def merge(old, changes, name=name):
                return C.load(mode, old, changes, KEYS[name], UPDATE_COLUMNS.get(name))
            new[name] = versions.merge_table(out_root, name, pub.tables[name], rows, KEYS[name], merge, layout_of(name))
        else:
            new[name] = versions.write_table(out_root, name, C.load(mode, None, rows, KEYS[name]), KEYS[name],
                                             layout_of(name))
    return versions.publish(spark, out_root, new, pub)
