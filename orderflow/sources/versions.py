"""Published versions of tables, stored in partitions.

A table is partitioned Parquet: by the calendar month of one of its columns
(``Layout(column)``; change batches are recent, so they touch few months), or
by a hash of the key where no column is local in time.  A publication is one
small pointer file below ``_versions/`` that names the live folders of every
table, so readers of a version see all tables of one state.  Folders and
pointers are written beside the old ones: a job that fails leaves
the last publication as it was.

* ``merge_table`` rewrites the partitions that hold changed keys or take
  changed rows, and reads no other data than their keys.
* ``append_table`` (insert-ignore) rewrites nothing: the new rows become one
  more folder of their partitions.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from typing import NamedTuple

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

N_BUCKETS = 64
PART = "_part"
_POINTER = "version long, table string, part string, path string, schema string"
_NO_MONTH = "none"


class Layout(NamedTuple):
    """How a table is partitioned: the month of ``column``, or a hash of its
    keys.  A table keeps its layout for life."""
    column: str | None = None
    buckets: int = N_BUCKETS

    def part(self, keys: list[str]) -> Column:
        if self.column is not None:
            return F.coalesce(F.date_format(F.col(self.column), "yyyy-MM"), F.lit(_NO_MONTH))
        return F.concat(F.lit("h"), F.pmod(F.xxhash64(*keys), F.lit(self.buckets)).cast("string"))


class Table(NamedTuple):
    schema: T.StructType
    folders: dict[str, list[str]]    # partition -> folders; empty partitions have none


class Publication(NamedTuple):
    number: int
    tables: dict[str, Table]


def _pointers(root: str) -> str:
    return f"{root.rstrip('/')}/_versions"


def current(spark: SparkSession, root: str) -> Publication | None:
    """The last publication, or None when nothing was published yet.  Any
    other condition (no readable pointer, a damaged one) is an error."""
    try:
        rows = (spark.read.schema(_POINTER).option("mode", "FAILFAST")
                .option("recursiveFileLookup", "true").json(_pointers(root)))
        last = rows.agg(F.max("version")).first()[0]
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise
    if last is None:
        raise RuntimeError(f"no readable pointer in {_pointers(root)}")
    tables: dict[str, Table] = {}
    for r in rows.filter(F.col("version") == last).collect():      # live folders
        t = tables.setdefault(r["table"], Table(T.StructType.fromJson(json.loads(r["schema"])), {}))
        if r["path"] is not None:
            t.folders.setdefault(r["part"], []).append(r["path"])
    return Publication(last, tables)


def read(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table of the last publication."""
    pub = current(spark, root)
    if pub is None or table not in pub.tables:
        raise ValueError(f"{table!r} is not published in {root}")
    return rows_of(spark, pub.tables[table])


def rows_of(spark: SparkSession, t: Table, parts=None, with_part: bool = False) -> DataFrame:
    """The rows of a table or of some of its partitions; ``with_part`` adds
    the partition as a column (read off the folder)."""
    paths = [p for part, found in sorted(t.folders.items()) if parts is None or part in parts for p in found]
    schema = T.StructType([*t.schema.fields, T.StructField(PART, T.StringType())]) if with_part else t.schema
    if not paths:
        return spark.createDataFrame([], schema)
    if not with_part:
        return spark.read.schema(schema).parquet(*paths)
    # <root>/<table>/v=<id>/_part=<value>: the table's folder is the base
    base = paths[0].rsplit("/", 2)[0]
    return spark.read.schema(schema).option("basePath", base).parquet(*paths).select(*schema.fieldNames())


def write_table(root: str, name: str, df: DataFrame, keys: list[str], layout: Layout = Layout()) -> Table:
    """Write rows into new partition folders (unpublished).

    Rows are rebalanced by partition: AQE merges small partitions into one task
    and splits one above the advisory size over several tasks (each writes a
    file of its own), so no task holds a whole large partition."""
    path = f"{root.rstrip('/')}/{name}/v={uuid.uuid4().hex}"
    (df.withColumn(PART, layout.part(keys)).hint("rebalance", F.col(PART))
     .write.partitionBy(PART).parquet(path))
    spark = df.sparkSession
    found = spark.read.schema(T.StructType([*df.schema.fields, T.StructField(PART, T.StringType())])).parquet(path)
    filled = [r[0] for r in found.select(PART).distinct().collect() if r[0] is not None]
    return Table(df.schema, {p: [f"{path}/{PART}={p}"] for p in filled})


def publish(spark: SparkSession, root: str, tables: dict[str, Table], base: Publication | None) -> int:
    """Publish ``tables`` on top of ``base``; tables not named are carried
    over.  Two writers with the same base get the same number, and the second
    fails instead of hiding the first."""
    number = (base.number if base else 0) + 1
    state = {**(base.tables if base else {}), **tables}
    rows = [(number, name, part, p, t.schema.json()) for name, t in state.items()
            for part, p in [("", None), *[(part, p) for part, found in t.folders.items() for p in found]]]
    (spark.createDataFrame(rows, _POINTER).coalesce(1).write.mode("errorifexists")
     .option("ignoreNullFields", "false").json(f"{_pointers(root)}/{number:012d}"))
    return number


def touched_parts(old: Table, changes: DataFrame, keys: list[str], layout: Layout) -> list[str]:
    """Partitions that hold a changed key or take a changed row.  Only the
    keys of a table are read to find the former, and none at all when the
    partition follows from the key."""
    spark = changes.sparkSession
    computable = layout.column is None or layout.column in changes.columns
    found = changes.select(layout.part(keys).alias(PART)) if computable else None
    if layout.column is not None:
        held = (rows_of(spark, old, with_part=True).select(*keys, PART)
                .join(changes.select(*keys), keys, "left_semi").select(PART))
        found = held if found is None else found.union(held)
    return [r[0] for r in found.distinct().collect()]            # months or buckets


def merge_table(root: str, name: str, old: Table, changes: DataFrame, keys: list[str],
                merge: Callable[[DataFrame, DataFrame], DataFrame], layout: Layout = Layout()) -> Table:
    """``merge(target, changes)`` on the touched partitions; the others keep
    their folders.  A row whose month changes leaves its old partition: both
    are rewritten."""
    touched = touched_parts(old, changes, keys, layout)
    if not touched:
        return old
    new = write_table(root, name, merge(rows_of(changes.sparkSession, old, touched), changes), keys, layout)
    kept = {p: f for p, f in old.folders.items() if p not in touched}
    return Table(old.schema, {**kept, **new.folders})


def append_table(root: str, name: str, old: Table, changes: DataFrame, keys: list[str],
                 fresh: Callable[[DataFrame, DataFrame], DataFrame], layout: Layout = Layout()) -> Table:
    """The rows that ``fresh(known keys, changes)`` returns, added as new
    folders; no live folder is rewritten."""
    known = rows_of(changes.sparkSession, old).select(*keys)
    new = write_table(root, name, fresh(known, changes), keys, layout)
    return Table(old.schema, {p: [*old.folders.get(p, []), *new.folders.get(p, [])]
                              for p in {**old.folders, **new.folders}})
