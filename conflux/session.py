"""Session helpers: building a session for tests/bench and resolving the
shared staging folder that every written intermediate goes to.

On a cluster the staging root is ``spark.checkpoint.dir`` (a shared file
system such as HDFS/S3/ABFS that every executor can reach). Only when it is
unset -- local runs and tests -- do we create one under the system temp
folder, and only for a ``local[...]`` master.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import SparkSession

DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    # windows-1252 text files (delimited staging, A5) need the legacy
    # Java charset table.
    "spark.sql.legacy.javaCharsets": "true",
}


# Suggested settings for a large cluster (~100 TB inputs). AQE coalesces the
# many initial shuffle partitions to ~256 MB each and splits skewed ones;
# scans produce ~512 MB splits. Broadcast only below 64 MB of estimated or
# runtime size.
CLUSTER_CONF = {
    **{k: v for k, v in DEFAULT_CONF.items() if k != "spark.ui.enabled"},
    "spark.sql.shuffle.partitions": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1g",
    "spark.sql.files.maxPartitionBytes": "512m",
    "spark.sql.autoBroadcastJoinThreshold": "64m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64m",
}


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app_name: str = "conflux", extra: dict | None = None) -> SparkSession:
    b = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the runtime SQL settings this library relies on to a session
    somebody else built (e.g. the verification driver)."""
    for k in ("spark.sql.session.timeZone", "spark.sql.legacy.javaCharsets",
              "spark.sql.adaptive.enabled", "spark.sql.adaptive.skewJoin.enabled"):
        try:
            spark.conf.set(k, DEFAULT_CONF[k])
        except Exception:  # static conf on an already running session
            pass
    return spark


def staging_root(spark: SparkSession) -> str:
    """Shared folder for written intermediates (``spark.checkpoint.dir``)."""
    root = None
    try:
        root = spark.conf.get("spark.checkpoint.dir", None)
    except Exception:
        pass
    try:
        sc = spark.sparkContext
    except Exception:  # Spark Connect: no SparkContext on the client
        sc = None
    if not root and sc is not None:
        root = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not root:
        if sc is None or not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="conflux-ckpt-")
        sc.setCheckpointDir(root)
        root = sc.getCheckpointDir() or root
    return root.rstrip("/")


_scope: ContextVar[str] = ContextVar("staging_scope", default="")


def new_path(spark: SparkSession, tag: str) -> str:
    """A fresh, never reused path under the staging root."""
    return f"{staging_root(spark)}/conflux/{_scope.get()}{tag}-{uuid.uuid4().hex[:12]}"


@contextmanager
def staging(spark: SparkSession) -> Iterator[str]:
    """Whatever is staged within the block goes when it ends, whether it fails
    or not. Frames are lazy: write a result that reads staged data, to a path
    of its own, before the block ends. Blocks may be nested."""
    root, outer = staging_root(spark), _scope.get()
    folder = f"{outer}scope-{uuid.uuid4().hex[:12]}/"
    token = _scope.set(folder)
    path = f"{root}/conflux/{folder}"
    try:
        yield path
    finally:
        _scope.reset(token)
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def spread(df, min_partitions: int | None = None):
    """Round-robin a frame over the cluster's cores when its source yields
    fewer splits than cores (a single-row-group file is one task). A source
    that already has enough splits -- the normal case at scale -- is left
    alone, so this adds no shuffle there. Use before CPU-heavy row-wise
    work (JSON/text encoding and parsing)."""
    try:
        want = min_partitions or df.sparkSession.sparkContext.defaultParallelism
        have = df.rdd.getNumPartitions()
    except Exception:  # e.g. a Spark Connect session: leave the plan alone
        return df
    return df.repartition(want) if have < want else df


def table(spark: SparkSession, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
