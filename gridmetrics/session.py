"""Session helpers.

Every operator in this package is a lazy ``DataFrame -> DataFrame`` function;
the only session requirements are a UTC session zone (all bucket boundaries
are UTC) and a shared folder for materialised intermediates.
"""

from __future__ import annotations

import atexit
import tempfile
import uuid
import warnings

from pyspark.sql import SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


# Settings for the large-cluster target (~100 TB input, ~1000 executors).
# Scan splits of 512 MB keep the task count near 200k for 100 TB; the initial
# shuffle width is generous and AQE coalesces it to ~256 MB partitions after
# the map-side aggregation has shrunk the data; runtime-sized broadcasts only
# (AQE measures the build side); skewed partitions are split.
CLUSTER_CONF = {
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.shuffle.partitions": "8000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64m",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
    "spark.sql.parquet.aggregatePushdown": "true",
    "spark.speculation": "true",
}


def build_session(master: str | None = None, app: str = "gridmetrics",
                  shuffle_partitions: int | None = None, extra: dict | None = None,
                  profile: str = "local") -> SparkSession:
    """Create (or reuse) a session with the settings the operators rely on.

    On a cluster ``master`` stays ``None`` and the resource manager's settings
    win; locally (tests, bench) a ``local[N]`` master is passed in.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    conf = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if profile == "cluster":
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ensure_utc(spark: SparkSession) -> None:
    """Bucket labels are UTC wall-clock; the session zone must agree."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Read from the session; only when it is unset (local runs, tests) a
    private temporary folder is created and registered. A ``file:`` folder is
    taken without remark on one machine (``local`` and ``local-cluster``
    masters); elsewhere it has to be a shared mount, so it draws a warning.
    """
    path = spark.conf.get(CHECKPOINT_CONF, None)
    sc = _spark_context(spark)
    if not path and sc is not None:
        path = sc.getConf().get(CHECKPOINT_CONF, None)
    master = (sc.master if sc is not None else spark.conf.get("spark.master", "")) or ""
    check_shared(path, master)
    if not path:
        path = tempfile.mkdtemp(prefix="gridmetrics-ckpt-")
        spark.conf.set(CHECKPOINT_CONF, path)
    if sc is not None and not sc._jsc.sc().getCheckpointDir().isDefined():
        sc.setCheckpointDir(path)
    return path


def check_shared(path: str | None, master: str) -> None:
    """Raise where a cluster names no folder; warn where it names a ``file:`` one."""
    if master.startswith("local"):
        return
    if not path:
        raise RuntimeError(f"{CHECKPOINT_CONF} must name a shared folder on a cluster "
                           f"(master={master!r}); machine-local folders do not survive executor loss")
    if path.startswith("file:"):
        warnings.warn(f"{CHECKPOINT_CONF}={path!r}: on {master!r} this must be a mount that the driver "
                      "and all executors share", stacklevel=3)


def _spark_context(spark: SparkSession):
    """The SparkContext of a classic session; ``None`` under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no SparkContext
        return None


def default_parallelism(spark: SparkSession) -> int:
    sc = _spark_context(spark)
    if sc is not None:
        return int(sc.defaultParallelism)
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


_SCRATCH: dict[str, SparkSession] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never-reused path under the shared folder; what is still there
    when the Python process ends is deleted then."""
    base = shared_dir(spark).rstrip("/")
    path = f"{base}/{name}-{uuid.uuid4().hex[:12]}"
    if not _SCRATCH:
        atexit.register(_drop_all_scratch)
    _SCRATCH[path] = spark
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on any Hadoop file system."""
    sc = spark.sparkContext
    hadoop = sc._jvm.org.apache.hadoop.fs.Path(path)
    return bool(hadoop.getFileSystem(sc._jsc.hadoopConfiguration()).exists(hadoop))


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder within its file system; its new parent is made."""
    sc = spark.sparkContext
    a, b = (sc._jvm.org.apache.hadoop.fs.Path(p) for p in (source, target))
    fs = a.getFileSystem(sc._jsc.hadoopConfiguration())
    fs.mkdirs(b.getParent())
    if not fs.rename(a, b):
        raise OSError(f"{source} could not be renamed to {target}")


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder (any Hadoop file system); missing is fine."""
    _SCRATCH.pop(path, None)
    sc = _spark_context(spark)
    if sc is None:
        return
    hadoop = sc._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(sc._jsc.hadoopConfiguration()).delete(hadoop, True)


def _drop_all_scratch() -> None:
    for path, spark in list(_SCRATCH.items()):
        try:
            drop_path(spark, path)
        except Exception:  # noqa: BLE001 - the JVM may be gone already
            _SCRATCH.clear()
            return
