"""Session helpers: shared working folders and a local session for tests."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


_local: dict[str, str] = {}
_made: list[str] = []


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names (``spark.checkpoint.dir``).

    Nothing is set on the session.  Only on a local master, where driver and
    tasks are one process, a private folder stands in when none is named;
    anywhere else a missing setting is an error, because files in a folder of
    one machine are lost to the others.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.sparkContext.getCheckpointDir()
        except Exception:  # noqa: BLE001 - e.g. a Spark Connect session has no context
            configured = None
    if configured:
        return configured
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"spark.checkpoint.dir must name a shared folder on master {master!r}")
    app = spark.sparkContext.applicationId
    if app not in _local:
        _local[app] = tempfile.mkdtemp(prefix="martforge-ckpt-")
    return _local[app]


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused path under the shared checkpoint folder."""
    base = checkpoint_dir(spark).rstrip("/")
    path = f"{base}/martforge-{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def clean_work(spark: SparkSession) -> int:
    """Delete the work paths handed out so far; call it once their results are no
    longer read.  Returns how many existed."""
    jvm, gone = spark.sparkContext._jvm, 0
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    while _made:
        path = jvm.org.apache.hadoop.fs.Path(_made.pop())
        gone += path.getFileSystem(conf).delete(path, True)
    return gone


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "martforge") -> SparkSession:
    """Session used by tests and the benchmark (the library never calls it)."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # small local inputs: keep AQE from coalescing CPU-heavy stages below the core count
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "64k")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
