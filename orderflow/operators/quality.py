"""Data-quality checks from the declared constraints (Q1-Q5).

Parquet enforces no keys, nulls or widths, so each constraint is a job:
one aggregate or one anti-join over the whole table.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame, functions as F


# --- Q1 -------------------------------------------------------------------
def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Primary-key violations: keys seen more than once, with their count.
    A hash aggregate: partial counts per task, so a hot key is cheap."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


# --- Q2 -------------------------------------------------------------------
def null_violations(df: DataFrame, cols: list[str]) -> DataFrame:
    """NOT NULL violations per column in one pass: (column, null_count)."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.col(c).cast("long").alias("null_count"))
        for c in cols])))


# --- Q3 -------------------------------------------------------------------
def orphans(child: DataFrame, parent: DataFrame, child_key: str,
            parent_key: str | None = None) -> DataFrame:
    """Foreign-key violations: child rows whose key has no parent (nulls are
    not violations, as in SQL)."""
    pk = parent_key or child_key
    return (child.filter(F.col(child_key).isNotNull())
            .join(parent.select(F.col(pk).alias(child_key)), child_key, "left_anti"))


# --- Q4 -------------------------------------------------------------------
def outside_numeric(col, precision: int, scale: int):
    """True when a database would refuse the value for NUMERIC(p, s): it is
    rounded to ``s`` digits (half away from zero) before the range check.
    Numbers too large for any decimal are outside."""
    x = F.col(col) if isinstance(col, str) else col
    exact = x.try_cast("decimal(38,10)")
    limit = F.lit(Decimal(10) ** (precision - scale))    # a short decimal: a wide one would round the value
    return F.when(x.isNull(), F.lit(False)).otherwise(
        F.coalesce(F.abs(F.round(exact, scale)) >= limit, F.lit(True)))


def _limits(widths: dict[str, int] | None, numerics: dict[str, tuple[int, int]] | None):
    return ([(c, f"VARCHAR({n})", F.length(F.col(c)) > n) for c, n in (widths or {}).items()]
            + [(c, f"NUMERIC({p},{s})", outside_numeric(c, p, s)) for c, (p, s) in (numerics or {}).items()])


def width_violations(df: DataFrame, widths: dict[str, int] | None = None,
                     numerics: dict[str, tuple[int, int]] | None = None) -> DataFrame:
    """Counts per column of text longer than VARCHAR(n) and numbers outside
    NUMERIC(p, s): (column_name, limit, violations)."""
    checks = _limits(widths, numerics)
    counts = df.agg(*[F.count_if(cond).alias(f"_v{i}") for i, (_, _, cond) in enumerate(checks)])
    return counts.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(lim).alias("limit"),
                 F.col(f"_v{i}").cast("long").alias("violations"))
        for i, (c, lim, _) in enumerate(checks)])))


# --- Q1-Q4 over the declared schema ------------------------------------------
def constraint_report(tables: dict[str, DataFrame], schemas: dict, keys: dict, foreign_keys: list,
                      widths: dict, numerics: dict) -> DataFrame:
    """One row per declared constraint of the given tables: (table_name,
    constraint_name, violations).  Constraints on columns a table does not
    carry are left out.

    Every table is read once: a row gives one entry per key it holds (its own,
    those it refers to, those others refer to) and one per violated null,
    width or range rule.  All entries of all tables meet in one aggregate by
    (constraint, key), map-side combined, whose presence flags tell repeated
    keys and missing parents; a second one sums per constraint."""
    names: list[tuple[str, str]] = []
    entries: dict[str, list] = {t: [] for t in tables}

    def entry(table, constraint, key, cond, own=0, child=0, parent=0):
        entries[table].append((cond, F.struct(
            F.lit(constraint).alias("c"), key.cast("string").alias("k"), F.lit(own).alias("own"),
            F.lit(child).alias("child"), F.lit(parent).alias("parent"))))

    def named(table, what):
        names.append((table, what))
        return len(names) - 1

    for name, df in tables.items():
        checks = [(f"{f.name} NOT NULL", F.col(f.name).isNull()) for f in schemas[name].fields
                  if not f.nullable and f.name in df.columns]
        checks += [(f"{c} {lim}", cond) for c, lim, cond in _limits(
            {c: n for c, n in widths.get(name, {}).items() if c in df.columns},
            {c: n for c, n in numerics.get(name, {}).items() if c in df.columns})]
        for what, cond in checks:
            entry(name, named(name, what), F.lit(None), cond, child=1)
        if all(k in df.columns for k in keys[name]):
            constraint = named(name, f"PRIMARY KEY ({', '.join(keys[name])})")
            entry(name, constraint, F.to_json(F.struct(*keys[name])), F.lit(True), own=1)
    for child, col, parent, pcol in foreign_keys:
        if child in tables and parent in tables and col in tables[child].columns and pcol in tables[parent].columns:
            constraint = named(child, f"{col} REFERENCES {parent}({pcol})")
            kind = tables[parent].schema[pcol].dataType
            entry(child, constraint, F.col(col).cast(kind), F.col(col).isNotNull(), child=1)
            entry(parent, constraint, F.col(pcol), F.col(pcol).isNotNull(), parent=1)
    rows = None
    for name, df in tables.items():
        if entries[name]:
            found = df.select(F.inline(F.array_compact(F.array(*[F.when(cond, e) for cond, e in entries[name]]))))
            rows = found if rows is None else rows.unionByName(found)
    per_key = rows.groupBy("c", "k").agg(F.sum("own").alias("own"), F.sum("child").alias("child"),
                                         F.max("parent").alias("parent"))
    counted = per_key.groupBy("c").agg(F.sum(
        F.when(F.col("own") > 1, 1).otherwise(0) + F.when(F.col("parent") == 0, F.col("child")).otherwise(0)).alias("n"))
    spark = rows.sparkSession
    declared = spark.createDataFrame([(i, t, c) for i, (t, c) in enumerate(names)],
                                     "c int, table_name string, constraint_name string")
    return declared.join(F.broadcast(counted), "c", "left").select(          # a row per declared constraint
        "table_name", "constraint_name", F.coalesce("n", F.lit(0)).cast("long").alias("violations"))


# --- Q5 -------------------------------------------------------------------
def apply_defaults(df: DataFrame, defaults: dict[str, object]) -> DataFrame:
    """Column default when the column is not supplied; a supplied null stays
    null, as in SQL."""
    for c, v in defaults.items():
        if c not in df.columns:
            df = df.withColumn(c, F.lit(v))
    return df
