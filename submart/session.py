"""Session settings and the shared scratch folder.

Nothing in the library needs a special session: every transform is plain
DataFrame code.  ``build_session`` only bundles the settings the jobs are
tuned for, and ``shared_dir`` finds the cluster-wide folder where written
intermediate tables go.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

#: settings the jobs rely on; applied by ``build_session`` and ``tune``
RECOMMENDED_CONF = {
    # the run date and to_date() must not depend on the machine's zone
    "spark.sql.session.timeZone": "UTC",
    # re-plan at run time: coalesce small shuffles, split skewed join
    # partitions, turn joins whose build side proves small into broadcasts
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # broadcast on measured sizes only: no static broadcast from file-size
    # estimates; AQE still turns a join whose side *measured* small at run
    # time into a broadcast, and explicit broadcasts follow an exact row count
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    # partitions not present in a result are never deleted by a write
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


#: sizing for ~100 TB inputs on ~1000 executors; applied with
#: ``build_session(cluster=True)``.  Scan splits and shuffle partitions aim
#: at a few hundred MB each, so a task's state fits executor memory (and
#: spills if not) without hundreds of thousands of tiny tasks.
CLUSTER_CONF = {
    # scan: fewer, larger splits (column pruning shrinks what is read)
    "spark.sql.files.maxPartitionBytes": "512MB",
    # shuffle: an upper bound for the widest stage; AQE coalesces the rest
    "spark.sql.shuffle.partitions": "16000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256MB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "64MB",
    # AQE's own skew splitting, behind the salting of hot keys
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "4",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "512MB",
    # lost executors and stragglers: re-run slow tasks elsewhere, and move
    # shuffle blocks off executors being decommissioned instead of
    # recomputing them (all jobs are deterministic, so retries are safe)
    "spark.speculation": "true",
    "spark.decommission.enabled": "true",
    "spark.storage.decommission.enabled": "true",
    "spark.storage.decommission.shuffleBlocks.enabled": "true",
}


def build_session(master: str | None = None, app_name: str = "submart",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None,
                  cluster: bool = False) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(RECOMMENDED_CONF)
    if cluster:
        conf.update(CLUSTER_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()


def _is_local(spark: SparkSession) -> bool:
    return spark.sparkContext.master.startswith("local")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster names it; the session's value is used as is.  Only a local
    session without one (tests, a laptop) gets a fresh folder of its own.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not _is_local(spark):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor "
                               "can reach; intermediate tables are written there")
        base = tempfile.mkdtemp(prefix="submart-ckpt-")
        spark.conf.set("spark.checkpoint.dir", base)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(base)
    return base


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new, empty folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/submart/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str | None:
    """The local file system path of ``path``, when it is local."""
    if path.startswith("file:"):
        return path[len("file:"):]
    if "://" in path:
        return None
    return os.path.abspath(path)
