"""Positions in a total order without a task that holds it all.

``write_ordered`` range-partitions rows by their order, numbers them inside
each partition and writes both; a table of row counts per partition (one
short row each) then places every partition in the whole.  On it stand

* ``numbered``: global row numbers, or numbers inside groups,
* ``Ordered.slice``: the rows at positions [start, start + n), reading only the
  partitions that hold them,
* ``allocate_rows`` (D4 over any number of rows).

The partition bounds are sampled, so they differ from run to run; the written
table fixes them, and positions depend on the order alone.  The order must be
total (end with a unique column): equal rows could be split either way.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from orderflow.session import scratch_dir, written

PART, AT = "_range", "_at"
_LOCAL = (1 << 33) - 1          # monotonically_increasing_id: partition << 33 | row


class Ordered(NamedTuple):
    """Rows written in order: ``counts`` has (partition, rows, rows before)."""
    spark: SparkSession
    path: str
    schema: T.StructType
    counts: DataFrame

    def rows(self, parts: list[int] | None = None) -> DataFrame:
        """The rows with ``_range`` and ``_at`` (row in the partition); a
        filter on ``_range`` prunes folders."""
        schema = T.StructType([*self.schema.fields, T.StructField(AT, T.LongType()), T.StructField(PART, T.IntegerType())])
        df = self.spark.read.schema(schema).parquet(self.path)
        return df if parts is None else df.filter(F.col(PART).isin(parts) if parts else F.lit(False))

    def slice(self, start: int, n: int) -> DataFrame:
        """Rows at positions [start, start + n) of the order, in order.  The
        driver sees the counts of the one or few partitions that hold them."""
        hit = (self.counts.filter((F.col("before") < start + n) & (F.col("before") + F.col("n") > start))
               .select(PART, "before").collect())
        parts = self.rows([r[0] for r in hit])
        at = F.col(AT) + F.create_map(*[F.lit(x) for r in hit for x in (r[0], r[1])])[F.col(PART)] if hit else F.col(AT)
        return (parts.withColumn("_position", at).filter((F.col("_position") >= start) & (F.col("_position") < start + n))
                .orderBy("_position").select(*self.schema.fieldNames()))


def write_ordered(df: DataFrame, order: list[Column], name: str = "ordered", partitions: int | None = None) -> Ordered:
    """Write ``df`` in the total order ``order``, a folder per range."""
    spark = df.sparkSession
    path = scratch_dir(spark, name)
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id()
    (df.repartitionByRange(n, *order).sortWithinPartitions(*order)
     .withColumn(AT, place).withColumn(PART, F.shiftright(AT, 33).cast("int"))
     .withColumn(AT, F.col(AT).bitwiseAND(F.lit(_LOCAL)))
     .write.partitionBy(PART).parquet(path))
    out = Ordered(spark, path, df.schema, None)
    counts = out.rows().groupBy(PART).agg(F.count(F.lit(1)).alias("n"))
    # one row per range: a short window
    before = F.sum("n").over(Window.orderBy(PART).rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.withColumn("before", F.coalesce(before, F.lit(0)).cast("long"))
    return out._replace(counts=spark.createDataFrame(counts.toArrow(), counts.schema))


def numbered(df: DataFrame, order: list[Column], groups: list[str] | None = None, name: str = "row_number",
             partitions: int | None = None) -> DataFrame:
    """``df`` with ``name``: the row's number (from 1) in the order, inside its
    group if ``groups`` are given.  No window over rows: ranges are numbered
    on their own and shifted by the rows before them; a group starts at the
    smallest number in it.  The starts are written, so the planner knows how
    few they are and sends them to the rows, not a group's rows to one task."""
    by = [F.col(g) for g in groups or []]
    done = write_ordered(df, [*[g.asc() for g in by], *order], "numbered", partitions)
    rows = (done.rows().join(F.broadcast(done.counts.select(PART, "before")), PART)       # a row per range
            .withColumn(name, F.col("before") + F.col(AT) + 1))
    if groups:
        keys = F.struct(*by)
        start = written(rows.groupBy(keys.alias("__group")).agg(F.min(name).alias("__start")), "group_starts")
        rows = rows.join(start, keys.eqNullSafe(F.col("__group"))).withColumn(name, F.col(name) - F.col("__start") + 1)
    return rows.select(*df.columns, name)


# --- D4 over any number of rows ----------------------------------------------------
def allocate_rows(df: DataFrame, weight_col: str, total: int, order_col: str, group_cols: list[str] | None = None,
                  min_count: int = 1, out_col: str = "allocated") -> DataFrame:
    """``calendars.allocate`` for groups of any size: the same split, exact to
    the unit, from group aggregates (map-side combined) and one distributed
    numbering of the rows that may move; ``order_col`` must be unique in a
    group.  The aggregates are written before they meet the rows: the planner
    broadcasts small ones, and a group's rows stay where they are.

    Rows that gain a unit more (or lose one) are the first in residual order
    of one side of the group, so one numbering by (group, side, residual)
    gives all ranks."""
    groups = group_cols or []
    x = df.withColumn("_g", F.struct(*[F.col(c) for c in groups]) if groups else F.struct(F.lit(0)))
    weights = x.groupBy("_g").agg(F.sum(weight_col).alias("_sum"), F.count(F.lit(1)).alias("_n"))

    def joined(rows: DataFrame, per_group: DataFrame) -> DataFrame:
        other = written(per_group.withColumnRenamed("_g", "_og"), "groups")
        return rows.join(other, rows["_g"].eqNullSafe(other["_og"])).drop("_og")

    share = F.lit(float(total)) * F.col(weight_col) / F.coalesce("_sum", F.lit(0.0))
    x = (joined(x, weights).withColumn("_share", share)
         .withColumn("_base", F.greatest(F.lit(min_count), F.rint("_share").cast("long")))
         .withColumn("_res", F.col("_share") - F.col("_base")).withColumn("_excess", F.col("_base") - F.lit(min_count)))
    x = written(x, "allocation")       # a sum of doubles may differ when it is computed again
    # group sums and full rounds of taking, from one row per distinct excess
    # (a group has at most about sqrt(2 * total) of them)
    steps = x.groupBy("_g", "_excess").agg(F.count(F.lit(1)).alias("_c"))
    whole = Window.partitionBy("_g")
    upto = whole.orderBy("_excess").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    e, c = F.col("_excess"), F.col("_c")
    steps = (steps.withColumn("_n", F.sum("_c").over(whole))
             .withColumn("_need", F.sum(c * (e + F.lit(min_count))).over(whole) - F.lit(total))
             .withColumn("_above", F.col("_n") - F.sum("_c").over(upto))
             .withColumn("_taken", F.sum(c * e).over(upto) + e * F.col("_above")))
    line = F.when(F.col("_taken") <= F.col("_need"), e + F.when(
        F.col("_above") > 0, F.floor((F.col("_need") - F.col("_taken")) / F.col("_above"))).otherwise(0))
    some = F.greatest(F.lit(1), F.sum(F.when(e > 0, c).otherwise(0)))
    rounds = steps.groupBy("_g").agg(
        F.first("_need").alias("_need"),
        F.greatest(F.max(line), F.floor(F.first("_need") / some)).alias("_r"))
    x = (joined(x, rounds).withColumn("_cut", F.least("_excess", "_r"))
         .withColumn("_side", F.when(F.col("_need") > 0, F.col("_excess") > F.col("_r")).otherwise(F.lit(True))))
    cuts = x.groupBy("_g").agg((F.first("_need") - F.sum("_cut")).alias("_rest"))
    x = joined(x, cuts).withColumn("_by", F.when(F.col("_need") > 0, F.col("_res")).otherwise(-F.col("_res")))
    x = numbered(x, [F.col("_by").asc(), F.col(order_col).asc()], ["_g", "_side"], "_rank")
    add = F.floor(-F.col("_need") / F.col("_n")) + (F.col("_rank") <= -F.col("_need") % F.col("_n")).cast("long")
    take = F.col("_cut") + (F.col("_side") & (F.col("_rank") <= F.col("_rest"))).cast("long")
    change = F.when(F.col("_need") < 0, add).when(F.col("_need") > 0, -take).otherwise(0)
    return x.withColumn(out_col, (F.col("_base") + change).cast("long")).select(*df.columns, out_col)
