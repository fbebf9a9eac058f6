"""Session construction and shared-storage helpers."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import SparkSession

# Session settings every job relies on:
# - UTC so timestamp parsing / hour extraction does not depend on the host.
# - AQE for runtime coalescing, skew-join splitting and SMJ -> BHJ demotion.
# - windowGroupLimitThreshold >= the largest per-group row cap we use (5,000
#   rows per region in the sample report) so WindowGroupLimit prunes map-side.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.windowGroupLimitThreshold": "5000",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.sources.partitionOverwriteMode": "static",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "snaplytics", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the library defaults.

    Settings submitted with the application (``--conf``) win over the defaults. The
    number of shuffle partitions is left to the submitter unless given here; see
    ``cluster_settings`` for a value sized to the input (AQE coalesces small partitions).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {"spark.ui.enabled": "false"}
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_defaults(spark, keep=set(extra or {}))
    return spark


def cluster_settings(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 << 20) -> dict:
    """Starting settings for a cluster run sized to the input.

    Shuffle partitions are set high enough that no partition of the largest
    shuffle (at most the input size) exceeds ``target_partition_bytes``; AQE then
    coalesces small ones toward the advisory size and splits skewed ones, so an
    over-estimate costs little. File splits stay at 256 MB for the scans.
    """
    partitions = max(2 * total_cores, -(-input_bytes // target_partition_bytes))
    return {
        **SESSION_DEFAULTS,
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
    }


def apply_defaults(spark: SparkSession, keep: set | None = None) -> None:
    """Apply the runtime SQL settings to an existing session (driver-made ones too);
    keys in ``keep``, and those the application was submitted with, are left as they are."""
    keep = (keep or set()) | submitted_settings(spark)
    for k, v in SESSION_DEFAULTS.items():
        if k in keep:
            continue
        try:
            spark.conf.set(k, v)
        except Exception:  # static conf on a shared session: keep the cluster's value
            pass


def submitted_settings(spark: SparkSession) -> set[str]:
    """Names of the settings the application was started with."""
    try:
        return {k for k, _ in spark.sparkContext.getConf().getAll()}
    except Exception:  # noqa: BLE001 - no SparkContext (Spark Connect)
        return set()


def _conf(spark: SparkSession, key: str) -> str | None:
    try:
        value = spark.conf.get(key, None)
    except Exception:  # noqa: BLE001 - unknown key on some deployments
        value = None
    if value:
        return value
    try:
        return spark.sparkContext.getConf().get(key, None)
    except Exception:  # noqa: BLE001 - no SparkContext (Spark Connect)
        return None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when the session has none and runs on a single machine (local runs, tests) a
    folder of our own is created and registered. On a cluster that would scatter
    staged tables over the machines' own disks, so there the setting is required.
    """
    root = _conf(spark, "spark.checkpoint.dir")
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - Spark Connect: the server owns checkpointing
        sc = None
    if not root and sc is not None:
        root = sc.getCheckpointDir()
    if not root:
        master = _conf(spark, "spark.master") or ""
        if not re.match(r"local(\[|$)", master):
            raise RuntimeError(f"spark.checkpoint.dir must name a shared folder (master is {master or 'unknown'})")
        root = tempfile.mkdtemp(prefix="snaplytics-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(root)
        else:
            spark.conf.set("spark.checkpoint.dir", root)
    elif sc is not None and sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root


def application_id(spark: SparkSession) -> str:
    return _conf(spark, "spark.app.id") or str(id(spark))


_SCRATCH_ROOTS: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique sub-folder of the application's scratch folder, which lies in the
    shared checkpoint root and is removed when the application ends."""
    root = f"{checkpoint_root(spark).rstrip('/')}/snaplytics-{application_id(spark)}"
    if root not in _SCRATCH_ROOTS:
        _SCRATCH_ROOTS.add(root)
        try:
            jvm = spark.sparkContext._jvm
            path = jvm.org.apache.hadoop.fs.Path(root)
            fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
            fs.mkdirs(path)
            fs.deleteOnExit(path)
        except Exception:  # noqa: BLE001 - no JVM at hand (Spark Connect): the folder's owner clears it
            pass
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


__all__ = ["build_session", "apply_defaults", "cluster_settings", "checkpoint_root", "scratch_path",
           "application_id"]
