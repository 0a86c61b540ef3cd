"""Session and shared-scratch helpers."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(app: str = "tagweave", cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """Local session for tests and the benchmark; clusters pass their own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    On a cluster it must be configured (HDFS or object store): executors and
    the driver do not see each other's disks, so without it this raises.  Only
    a local session, as in tests, gets a folder of its own when it has none."""
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        root = tempfile.mkdtemp(prefix="tagweave-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


_MADE: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint root."""
    path = f"{checkpoint_root(spark)}/tagweave-{name}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


def drop_scratch(spark: SparkSession) -> int:
    """Delete the scratch folders this process has made, once nothing reads
    them any more.  Returns how many there were."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    n = 0
    while _MADE:
        path = jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        n += bool(path.getFileSystem(conf).delete(path, True))
    return n
