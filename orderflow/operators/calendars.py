"""Calendar spine and integer allocation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from orderflow.functions.calendar import seasonality, weekday_bounds, weekday_class


# --- D1 -------------------------------------------------------------------
def day_spine(spark: SparkSession, end, days_back: int) -> DataFrame:
    """One row per day, ``end - days_back`` .. ``end - 1``."""
    if days_back < 1:
        raise ValueError("days_back must be >= 1")
    e = F.to_date(F.lit(str(end)))
    return spark.range(1).select(F.explode(F.sequence(
        F.date_sub(e, days_back), F.date_sub(e, 1))).alias("day"))


def spine_between(bounds: DataFrame, start_col: str, end_col: str) -> DataFrame:
    """One row per day from ``start_col`` to ``end_col`` inclusive, for each
    row of ``bounds`` (e.g. the data range of a table)."""
    return bounds.select(F.explode(F.sequence(F.to_date(start_col), F.to_date(end_col)))
                         .alias("day"))


# --- D2 / D3 ------------------------------------------------------------------
def with_calendar(df: DataFrame, day_col: str = "day") -> DataFrame:
    """Month factor, weekday class and its weight bounds for each day."""
    lo, hi = weekday_bounds(day_col)
    return (df.withColumn("season_factor", seasonality(day_col))
            .withColumn("weekday", F.weekday(day_col))
            .withColumn("weekday_class", weekday_class(day_col))
            .withColumn("weight_low", lo).withColumn("weight_high", hi))


# --- D4 -------------------------------------------------------------------
def allocate(df: DataFrame, weight_col: str, total: int, order_col: str,
             group_cols: list[str] | None = None, min_count: int = 1,
             out_col: str = "allocated") -> DataFrame:
    """Split an integer ``total`` over rows by weight:
    ``max(min, rint(total * w / Σw))`` (rint is half-even, as Python's
    round), then +1 / -1 in rounds until the sum fits: each round goes over
    the rows from the largest (to add) or smallest (to take) rounding residual
    and never takes a row below ``min``.  The sum is exact whenever ``total``
    is at least ``min`` for every row.

    The rounds are closed form.  To add ``x`` to ``n`` rows: ``x div n`` each
    and one more for the first ``x mod n``.  To take ``x``: ``r`` full rounds,
    the largest ``r`` with Σ min(excess, r) <= x (a concave piecewise linear
    function of r, solved on the line of every breakpoint), then one more from
    the first rows that still have excess.

    The rows are allocation units (days of a calendar) made by an aggregate;
    each group's units meet in one window.
    """
    groups = [F.col(c) for c in group_cols or []] or [F.lit(0)]
    whole = Window.partitionBy(*groups)
    share = F.lit(float(total)) * F.col(weight_col) / F.coalesce(F.sum(weight_col).over(whole), F.lit(0.0))
    x = (df.withColumn("_share", share)
         .withColumn("_base", F.greatest(F.lit(min_count), F.rint("_share").cast("long")))
         .withColumn("_res", F.col("_share") - F.col("_base"))
         .withColumn("_excess", F.col("_base") - F.lit(min_count))
         .withColumn("_n", F.count(F.lit(1)).over(whole))
         .withColumn("_diff", F.lit(total) - F.sum("_base").over(whole)))
    # full rounds of taking: the line of each breakpoint ``e`` (and of 0)
    upto = Window.partitionBy(*groups).orderBy("_excess").rangeBetween(Window.unboundedPreceding, 0)
    e, need = F.col("_excess"), -F.col("_diff")
    above = F.col("_n") - F.count(F.lit(1)).over(upto)
    taken = F.sum("_excess").over(upto) + e * above
    line = F.when(taken <= need, e + F.when(above > 0, F.floor((need - taken) / above)).otherwise(0))
    start = F.floor(need / F.greatest(F.lit(1), F.count_if(e > 0).over(whole)))
    x = x.withColumn("_line", line).withColumn("_start", start)
    x = (x.withColumn("_r", F.greatest(F.max("_line").over(whole), F.col("_start")))
         .withColumn("_cut", F.least("_excess", "_r"))
         .withColumn("_rest", -F.col("_diff") - F.sum("_cut").over(whole)))
    up = Window.partitionBy(*groups).orderBy(F.col("_res").desc(), F.col(order_col))
    down = Window.partitionBy(*groups, F.col("_excess") > F.col("_r")).orderBy(F.col("_res").asc(), F.col(order_col))
    x = x.withColumn("_rank_up", F.row_number().over(up)).withColumn("_rank_down", F.row_number().over(down))
    add = F.floor(F.col("_diff") / F.col("_n")) + (F.col("_rank_up") <= F.col("_diff") % F.col("_n")).cast("long")
    take = F.col("_cut") + ((F.col("_excess") > F.col("_r")) & (F.col("_rank_down") <= F.col("_rest"))).cast("long")
    change = F.when(F.col("_diff") > 0, add).when(F.col("_diff") < 0, -take).otherwise(0)
    return (x.withColumn(out_col, (F.col("_base") + change).cast("long"))
            .drop("_share", "_base", "_res", "_excess", "_n", "_diff", "_line", "_start", "_r", "_cut", "_rest",
                  "_rank_up", "_rank_down"))


# --- D5 -------------------------------------------------------------------
def expand_by_count(df: DataFrame, n_col: str, unit_col: str = "unit") -> DataFrame:
    """One row per unit of a count (rows with n < 1 give none)."""
    return (df.filter(F.col(n_col) >= 1)
            .withColumn(unit_col, F.explode(F.sequence(F.lit(1).cast("long"),
                                                       F.col(n_col).cast("long")))))
