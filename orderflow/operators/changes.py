"""Change application and per-key selection.

Skew: "one row per key" and "n rows per key" picks are ``row_number`` limits,
which Spark plans as a partial ``WindowGroupLimit`` before the shuffle (a
map-side top-n), so a key holding a third of all rows ships n rows per map
task.  Joins carry no hints: Spark's byte-based size check decides.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T


def _cols(cols) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


# --- U1 -------------------------------------------------------------------
def append_batches(dfs: list[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Bag union of pages / buffers, matched by column name."""
    if not dfs:
        raise ValueError("no batches")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), dfs)


# --- L5 / C4 / dedupe: one row per key ------------------------------------
def _tiebreak(df: DataFrame, cols: list[str]) -> list[Column]:
    """Columns as sort keys; types without an order (maps, variants) as JSON."""
    def ordered(t):
        if isinstance(t, T.ArrayType):
            return ordered(t.elementType)
        if isinstance(t, T.StructType):
            return all(ordered(f.dataType) for f in t.fields)
        return not isinstance(t, (T.MapType, T.VariantType))
    return [F.col(c) if ordered(df.schema[c].dataType) else F.to_json(F.struct(c)) for c in cols]


def pick_per_key(df: DataFrame, keys: list[str], order_cols: list, *,
                 latest: bool = False) -> DataFrame:
    """One row per key: the smallest (or with ``latest`` the largest) row in
    ``order_cols`` order; remaining columns break ties, so the pick is total.
    Nulls are the smallest values.

    ``order_cols`` may hold column names or Columns (sorted ascending; wrap in
    a negation / use ``latest`` for descending)."""
    rest = [c for c in df.columns if c not in keys]
    order = [*_cols(order_cols), *_tiebreak(df, rest)]
    order = [c.desc_nulls_last() if latest else c.asc_nulls_first() for c in order]
    w = Window.partitionBy(*keys).orderBy(*order)
    return (df.withColumn("_pick", F.row_number().over(w)).filter(F.col("_pick") == 1)
            .select(*keys, *rest))


def first_per_key(df: DataFrame, keys: list[str], order_cols: list) -> DataFrame:
    """First row of each key in a deterministic order."""
    return pick_per_key(df, keys, order_cols)


def current_state(landed: DataFrame, keys: list[str],
                  order_cols=("event_timestamp", "data_date")) -> DataFrame:
    """C4: the current version of each key is the row with the latest
    ``order_cols`` (event time, then landing partition)."""
    return pick_per_key(landed, keys, list(order_cols), latest=True)


def dedupe(df: DataFrame, keys: list[str], order_cols: list) -> DataFrame:
    """Keep one row per key: the first in ``order_cols`` order."""
    return pick_per_key(df, keys, order_cols)


# --- L6: n rows per key -----------------------------------------------------
def top_n_per_key(df: DataFrame, keys: list[str], order_col: Column | str, n: int,
                  tiebreak: list | None = None, salt_buckets: int = 64,
                  rank_col: str | None = None) -> DataFrame:
    """The first ``n`` rows of each key by ``order_col`` (+ ``tiebreak``).

    ``row_number() <= n`` with a literal n is planned by Spark as a partial
    ``WindowGroupLimit`` before the shuffle (a map-side top-n) and a final
    one after it, so a hot key ships at most n rows per map task.  Above
    Spark's group-limit threshold an exact two-stage plan over a salted key
    does the same job.
    """
    order = _cols([order_col] + list(tiebreak or []))
    rc = rank_col or "_rn"
    threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold",
                                             "1000"))
    if n > threshold:
        salt = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(salt_buckets))
        w1 = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = (df.withColumn("_salt", salt)
              .withColumn("_r1", F.row_number().over(w1))
              .filter(F.col("_r1") <= n).drop("_r1", "_salt"))
    w = Window.partitionBy(*keys).orderBy(*order)
    out = df.withColumn(rc, F.row_number().over(w)).filter(F.col(rc) <= n)
    return out if rank_col else out.drop(rc)


def sample_per_key(df: DataFrame, keys: list[str], n: int, seed: str,
                   id_cols: list[str], rank_col: str | None = None) -> DataFrame:
    """``n`` rows per key without replacement, in a reproducible random
    order (md5 of seed and the row's id columns; all columns break ties)."""
    from orderflow.functions.ids import sample_order_key
    ordered = df.withColumn("_h", sample_order_key(seed, *id_cols))
    tiebreak = [F.col(c).asc_nulls_first() for c in df.columns]
    return top_n_per_key(ordered, keys, "_h", n, tiebreak, rank_col=rank_col).drop("_h")


# --- L4 / L7 ----------------------------------------------------------------
def top_recent(df: DataFrame, k: int, ts_col: str = "created_at",
               tiebreak: list[str] | None = None) -> DataFrame:
    """Newest ``k`` rows by ``ts_col`` DESC (TakeOrderedAndProject: each task
    keeps its own top k, one final task merges k x tasks rows)."""
    order = [F.col(ts_col).desc()] + [F.col(c).asc() for c in (tiebreak or [])]
    return df.orderBy(*order).limit(k)


def bounded_sample_size(count: int, frac: float = 0.2, lo: int = 10, hi: int = 60) -> int:
    """``min(hi, max(lo, int(frac * count)))``, never more than ``count``."""
    return min(count, min(hi, max(lo, int(count * frac))))


def sample_bounded(df: DataFrame, seed: str, id_cols: list[str], frac: float = 0.2,
                   lo: int = 10, hi: int = 60) -> DataFrame:
    """A bounded md5-ordered sample; the size needs one global count."""
    from orderflow.functions.ids import sample_order_key
    n = bounded_sample_size(df.count(), frac, lo, hi)
    tiebreak = [F.col(c).asc_nulls_first() for c in df.columns]
    return (df.withColumn("_h", sample_order_key(seed, *id_cols))
            .orderBy(F.col("_h"), *tiebreak).limit(n).drop("_h"))


# --- C1 -------------------------------------------------------------------
def _unique_marker(changes: DataFrame, keys: list[str], what: str) -> Column:
    """True for every change row; raises at run time when a key repeats.

    The count window is partitioned by the keys, the same hash partitioning
    the following join needs, so the check adds no exchange."""
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    return F.when(n > 1, F.raise_error(F.lit(f"{what}: a key occurs more than once in one batch"))
                  ).otherwise(F.lit(True))


def _checked(changes: DataFrame, cols: list[str], keys: list[str], what: str) -> DataFrame:
    """The batch with ``_in_c`` = True, filtered on it: the filter keeps every
    row but forces the duplicate check on all of them (a marker column that
    no output needs would be pruned by the optimizer)."""
    return (changes.select(*cols).withColumn("_in_c", _unique_marker(changes, keys, what))
            .filter(F.col("_in_c")))


def upsert(target: DataFrame, changes: DataFrame, keys: list[str],
           update_cols: list[str] | None = None) -> DataFrame:
    """New key -> insert the change row; existing key -> overwrite only
    ``update_cols`` (a null in the change overwrites), keep the others.
    A key repeated inside the batch is an error, as in the source database.

    One full outer join on the keys.  ``sources.versions.merge_table`` limits
    the target to the partitions that hold changed keys.
    """
    cols = target.columns
    update_cols = [c for c in cols if c not in keys] if update_cols is None else update_cols
    c = _checked(changes, cols, keys, "upsert")
    t = target.withColumn("_in_t", F.lit(True))
    j = t.alias("t").join(c.alias("c"), keys, "full_outer")
    out = []
    for col in cols:
        if col in keys:
            out.append(F.col(col))
        elif col in update_cols:
            out.append(F.when(F.col("c._in_c"), F.col(f"c.{col}"))
                       .otherwise(F.col(f"t.{col}")).alias(col))
        else:
            out.append(F.when(F.col("t._in_t"), F.col(f"t.{col}"))
                       .otherwise(F.col(f"c.{col}")).alias(col))
    return j.select(*out)


# --- C2 -------------------------------------------------------------------
def insert_ignore(target: DataFrame, changes: DataFrame, keys: list[str],
                  order_cols: list | None = None) -> DataFrame:
    """Insert only unseen keys; duplicates inside the batch keep the first
    in ``order_cols`` order (default: all columns).  One anti-join of the
    batch against the target's keys."""
    new_rows = unseen(target, changes.select(*target.columns), keys, order_cols)
    return target.unionByName(new_rows.select(*target.columns))


def unseen(target: DataFrame, changes: DataFrame, keys: list[str], order_cols: list | None = None) -> DataFrame:
    """The rows that insert-ignore adds: the first of each key that the target
    does not have.  Only the target's keys are read."""
    fresh = dedupe(changes, keys, order_cols if order_cols is not None else [])
    return fresh.join(target.select(*keys), keys, "left_anti").select(*changes.columns)


# --- C3 -------------------------------------------------------------------
def update_by_key(target: DataFrame, changes: DataFrame, keys: list[str],
                  cols: list[str]) -> DataFrame:
    """Update ``cols`` where the key exists; unknown keys are ignored.

    A left join: when the change set is small Spark broadcasts it (size
    check by the optimizer / AQE) and the target is never shuffled."""
    c = _checked(changes, [*keys, *cols], keys, "update_by_key")
    j = target.alias("t").join(c.alias("c"), keys, "left")
    out = [F.col(k) for k in keys]
    for col in target.columns:
        if col in keys:
            continue
        if col in cols:
            out.append(F.when(F.col("c._in_c"), F.col(f"c.{col}"))
                       .otherwise(F.col(f"t.{col}")).alias(col))
        else:
            out.append(F.col(f"t.{col}"))
    return j.select(*out)


# --- C5 -------------------------------------------------------------------
def load(mode: str, target: DataFrame | None, batch: DataFrame, keys: list[str],
         update_cols: list[str] | None = None, append_only: bool = False) -> DataFrame:
    """``historical``: drop and rebuild from the batch; ``incremental``:
    upsert (or insert-ignore for append-only tables) onto the target."""
    if mode == "historical":
        return batch
    if mode != "incremental":
        raise ValueError(f"unknown load mode {mode!r}")
    if target is None:
        raise ValueError("incremental load needs a target")
    if append_only:
        return insert_ignore(target, batch, keys)
    return upsert(target, batch, keys, update_cols)
