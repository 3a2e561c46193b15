"""Session construction and the shared scratch folder.

Everything that writes intermediate data (layouts, sinks in tests, lineage cuts) goes
under the folder the cluster names in ``spark.checkpoint.dir``.  That folder must be
shared storage on a cluster; only when it is unset on a *local* master do we create one.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
SPLITS_CONF = "spark.sql.files.minPartitionNum"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "civicflow") -> SparkSession:
    """A local[N] session configured for tests and the benchmark.

    On a cluster build the session from the cluster's own defaults; the settings here
    that matter at scale are AQE (partition coalescing, skew splits) and the UTC zone.
    """
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        # Partition values such as zip "00000" must stay strings when read back.
        .config("spark.sql.sources.partitionColumnTypeInference.enabled", "false")
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder; set a private one only for local masters."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get(CHECKPOINT_CONF, None) or sc.getConf().get(CHECKPOINT_CONF, None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError(
                f"{CHECKPOINT_CONF} is not set; point it at shared storage (HDFS/S3/ABFS) "
                "so lineage cuts and scratch tables survive executor loss"
            )
        configured = tempfile.mkdtemp(prefix="civicflow-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder."""
    root = checkpoint_root(spark)
    return f"{root.rstrip('/')}/civicflow/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def finer_splits(spark: SparkSession, parts: int) -> Iterator[None]:
    """Files are read in enough splits that each of ``parts`` consecutive parts of them keeps all cores busy.

    Spark still keeps splits above ``spark.sql.files.openCostInBytes``, and a row group whole.
    """
    before = spark.conf.get(SPLITS_CONF, None)
    wanted = parts * spark.sparkContext.defaultParallelism
    spark.conf.set(SPLITS_CONF, str(max(wanted, int(before or 0))))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(SPLITS_CONF)
        else:
            spark.conf.set(SPLITS_CONF, before)
