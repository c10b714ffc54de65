"""Session construction and the shared scratch location.

On a cluster the session is supplied by the caller and ``spark.checkpoint.dir``
names a folder every executor can reach (HDFS, S3, ...).  Everything this
package writes as an intermediate (checkpoints, read-back tables) goes below
that folder.  Only when it is unset -- local runs and tests -- do we create one.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale; callers on a cluster override sizes as needed.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Inferred IS NOT NULL filters on derived keys (cells, blocks) are pushed
    # below their projections and re-evaluate the whole key expression per
    # row; every filter these jobs need is stated explicitly.
    "spark.sql.constraintPropagation.enabled": "false",
    # Cell directories such as 1.1 and 1.10 must not be read back as doubles.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "skygrid", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.master(master).appName(app_name)
    conf = dict(DEFAULT_CONF)
    conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-wide checkpoint folder.

    Read from the session; only in local mode (tests) is a temporary folder
    created when none is set -- on a cluster a missing setting is an error,
    never a machine-local fallback.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
        configured = tempfile.mkdtemp(prefix="skygrid-ckpt-")   # local mode only
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def fresh_dir(spark: SparkSession, tag: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_dir(spark).rstrip('/')}/skygrid-{tag}-{uuid.uuid4().hex}"


def cut_lineage(df, tag: str = "table"):
    """Materialise ``df`` as a Parquet table in the shared folder and read it back.

    One job writes it (an RDD checkpoint would recompute its input in a
    second job); the files survive executor loss, so every later reader sees
    exactly the same rows and values.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, tag)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)
