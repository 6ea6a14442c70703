from orderflow.session import scratch_dir, sizing_for_input


def test_sizing_for_input():
    small = sizing_for_input(10 * 1024 ** 2, 8)
    assert small["spark.sql.shuffle.partitions"] == "16"
    assert "spark.sql.files.maxPartitionBytes" not in small
    big = sizing_for_input(100 * 1024 ** 4, 8000)      # 100 TB on 8,000 cores
    assert int(big["spark.sql.shuffle.partitions"]) == 524288
    assert big["spark.sql.files.maxPartitionBytes"] == str(256 * 1024 ** 2)


def test_scratch_dirs_are_unique_below_the_checkpoint_root(spark):
    a, b = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    root = spark.sparkContext.getCheckpointDir()
    assert a != b and a.startswith(root.rstrip("/")) and b.startswith(root.rstrip("/"))
