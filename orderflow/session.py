"""Session construction and the shared scratch folder.

On a cluster the scratch folder is the shared location named by
``spark.checkpoint.dir``; we only invent one (a local temp folder) when the
session has none, which is the case in tests and local runs.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings we rely on for results (UTC, ANSI-like decimals) and for scale
# (AQE re-plans joins and coalesces / splits skewed shuffle partitions).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def get_spark(master: str | None = None, shuffle_partitions: int | None = None,
              app: str = "orderflow", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # runtime-settable SQL confs also apply to a pre-existing session
    for k, v in conf.items():
        if k.startswith("spark.sql.") and "partitionOverwriteMode" not in k:
            try:
                spark.conf.set(k, v)
            except Exception:  # static conf of an existing session
                pass
    return spark


def sizing_for_input(input_bytes: int, total_cores: int,
                     target_partition_bytes: int = 200 * 1024 ** 2) -> dict[str, str]:
    """Shuffle and scan settings for a job reading ``input_bytes``.

    Initial shuffle partitions ~ input / 200 MB (at least two waves of the
    cluster's cores), so no task's shuffle block outgrows executor memory;
    AQE then coalesces small partitions and splits skewed ones.  Scan splits
    and the AQE advisory size are 256 MB once the input is large."""
    partitions = max(2 * total_cores, -(-int(input_bytes) // target_partition_bytes))
    conf = {"spark.sql.shuffle.partitions": str(partitions),
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(partitions)}
    if input_bytes >= 1024 ** 4:
        conf.update({"spark.sql.files.maxPartitionBytes": str(256 * 1024 ** 2),
                     "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 * 1024 ** 2)})
    return conf


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session (``spark.checkpoint.dir``).

    Only a local-mode session (tests, a laptop) gets a temp folder invented
    for it; on a cluster a machine-local folder would be invisible to the
    executors, so a missing setting is an error there."""
    try:
        sc = spark.sparkContext
    except Exception:  # a Spark Connect session has no SparkContext
        sc = None
    root = sc.getCheckpointDir() if sc is not None else None
    if not root:
        root = spark.conf.get("spark.checkpoint.dir", None)
        if not root:
            master = sc.master if sc is not None else spark.conf.get("spark.master", "")
            if not (master == "local" or master.startswith("local[")):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder on a cluster")
            root = tempfile.mkdtemp(prefix="orderflow-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(root)
            root = sc.getCheckpointDir() or root
        else:
            spark.conf.set("spark.checkpoint.dir", root)
    return root


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint root for written tables."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/orderflow/{name}-{uuid.uuid4().hex[:12]}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared scratch folder and read back: a
    result that several later steps use, fixed against recomputation."""
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
