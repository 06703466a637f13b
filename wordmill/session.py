"""Session helpers: local sessions for tests/bench and checkpoint-dir policy."""

from __future__ import annotations

import atexit
import gc
import os
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels",
    "conversations",
)


def build_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "wordmill") -> SparkSession:
    """A local session with AQE and skew-join handling on, UI off."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only when unset.

    On a cluster the folder comes from ``spark.checkpoint.dir`` (a shared
    file system). Only a local-mode session without that setting (tests,
    bench) gets a fresh temporary folder, which goes when the process ends.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if conf_dir:
        sc.setCheckpointDir(conf_dir)
        return sc.getCheckpointDir()
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; set it to a shared folder "
            "before running iterative operators on a cluster")
    local_dir = tempfile.mkdtemp(prefix="wordmill-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    atexit.register(shutil.rmtree, local_dir, ignore_errors=True)
    sc.setCheckpointDir(local_dir)
    return sc.getCheckpointDir()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` to the reliable checkpoint folder (survives executor loss)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def free_unused(spark: SparkSession) -> None:
    """Have the files of shuffles and checkpoints that nothing refers to any more removed now.

    Spark removes them once the driver has collected the garbage that points to them, which
    may be hours away; until then every step of a long query adds to the disk. The scheduler's
    threads hold on to their last task until they get another one, here of a tiny job.
    """
    gc.collect()
    n = 2 * max(8, spark.sparkContext.defaultParallelism)
    spark.range(0, n, numPartitions=n).count()
    spark.sparkContext._jvm.System.gc()


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
