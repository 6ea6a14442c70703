"""The scalable code paths, checked on data rather than on plans."""

from pyspark.sql import functions as F

from orderflow.operators import tracking as TR


def test_short_city_names_match_only_themselves(spark):
    # a one-letter city and a thousand others with the same first letter
    routes = spark.createDataFrame(
        [("N", 5000, [dict(lat=1.0, lon=2.0, label="n"), dict(lat=1.0, lon=2.0, label="N")])]
        + [(f"N{i}x", i, [dict(lat=1.0, lon=2.0, label="a"), dict(lat=3.0, lon=4.0, label=f"L{i}")])
           for i in range(1200)], "city string, ord int, route array<struct<lat double, lon double, label string>>")
    df = spark.createDataFrame([("1", "to N17x"), ("2", "N only"), ("3", "none"), ("4", "N1x N0x"), ("5", "to N17x")],
                               "id string, delivery_address string")
    got = {r.id: r.route_city for r in TR.match_route(df, routes).collect()}
    assert got == {"1": "N17x", "2": "N", "3": None, "4": "N0x", "5": "N17x"}


def test_long_stops_with_a_hot_key_match_sql(spark):
    import duckdb
    n = 30000
    # vehicle 0 reports a third of all readings; stops are runs of v < 30
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 97 + 1).alias("k"),
        (F.lit("2024-01-01").cast("timestamp_ntz")
         + F.make_interval(secs=(F.col("id") * 37).cast("int"))).alias("timestamp"),
        F.col("id").alias("event_id"),
        (F.floor(F.col("id") / 300) * 7919 % 100).alias("v"))
    got = sorted((r.k, r.stop_start, r.stop_end, r.n_points) for r in
                 TR.long_stops(df, "k", F.col("v") < 30).collect())
    pdf = df.toPandas()
    want = duckdb.sql("""
        WITH g AS (SELECT *, sum(CASE WHEN v < 30 THEN 0 ELSE 1 END) OVER (PARTITION BY k
                     ORDER BY "timestamp", event_id ROWS UNBOUNDED PRECEDING) AS grp FROM pdf),
        r AS (SELECT k, grp, min("timestamp") s, max("timestamp") e, count(*) c FROM g
              WHERE v < 30 GROUP BY k, grp)
        SELECT k, s, e, c FROM r WHERE e - s > INTERVAL 30 MINUTE""").fetchall()
    assert got == sorted((int(k), s, e, int(c)) for k, s, e, c in want)
    assert any(r[0] == 0 for r in got)
