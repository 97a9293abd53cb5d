"""Spark session defaults and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job relies on: UTC day boundaries, AQE (runtime coalescing,
# skew-join splitting, runtime broadcast of small shuffle outputs) and no UI.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
}


def scale_conf(input_bytes: int, target_partition_bytes: int = 256 * 2 ** 20) -> dict[str, str]:
    """Settings for a cluster run over ``input_bytes`` of input.

    Shuffle partitions start at input / target size (AQE coalesces the small
    ones at run time and splits skewed join partitions), scan splits use the
    same target, so a task's working set stays well below executor memory and
    large aggregations spill instead of failing. For 100 TB: ~400 k initial
    shuffle partitions of 256 MiB.
    """
    parts = max(200, -(-input_bytes // target_partition_bytes))
    t = str(target_partition_bytes)
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": t,
        "spark.sql.files.maxPartitionBytes": t,
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
    }


def build_session(master: str | None = None, app: str = "tidemart",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


_LOCAL_DIRS: dict[str, str] = {}


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None on Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no SparkContext
        return None


def app_id(spark: SparkSession) -> str:
    sc = _context(spark)
    return sc.applicationId if sc is not None else spark.conf.get("spark.app.id", "app")


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``; it is read from the session
    and used as is. Only when it is unset on a local master (tests, one machine) a
    scratch folder is created and registered; on any other master an unset folder
    is an error, since a local one would not be seen by the other machines.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    sc = _context(spark)
    if not path and sc is not None and sc.getCheckpointDir():
        # SparkContext appends a random child folder; use its parent.
        path = sc.getCheckpointDir().rsplit("/", 1)[0]
    if not path:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("spark.checkpoint.dir is not set: a shared folder is needed on a cluster")
        key = app_id(spark)
        if key not in _LOCAL_DIRS:
            _LOCAL_DIRS[key] = tempfile.mkdtemp(prefix="tidemart-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        path = _LOCAL_DIRS[key]
    if sc is not None and not sc.getCheckpointDir():
        sc.setCheckpointDir(path)
    return path.rstrip("/")


def scratch_path(spark: SparkSession, *parts: str) -> str:
    """A path below the shared checkpoint folder."""
    return "/".join([checkpoint_dir(spark), *parts])


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path exists; an unreachable store is an error, not "no"."""
    p, fs = _fs(spark, path)
    return fs.exists(p)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    p, fs = _fs(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def delete_path(spark: SparkSession, path: str) -> None:
    p, fs = _fs(spark, path)
    fs.delete(p, True)


def move_path(spark: SparkSession, source: str, target: str) -> None:
    """Rename a folder; it replaces what stands at ``target``."""
    (old, fs), (new, _) = _fs(spark, source), _fs(spark, target)
    fs.mkdirs(new.getParent())
    fs.delete(new, True)
    if not fs.rename(old, new):
        raise OSError(f"could not move {source} to {target}")
