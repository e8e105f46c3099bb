"""Session helpers.

The library never creates a cluster session on its own behalf: jobs take the
``SparkSession`` they are given.  ``local_session`` exists for tests, the bench
and the examples; it pins the settings the oracle comparison relies on (UTC
session zone, AQE on, UI off) and sets a checkpoint folder only when the
cluster has not named one.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from typing import Any
from urllib.parse import urlparse

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

# Settings every session used by this library should carry.  On a cluster the
# operator sets them in spark-defaults; local runs get them here.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


SIDE_BY_SIDE = 8


def local_session(cores: str | int = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", app: str = "fraudspark") -> SparkSession:
    builder = (SparkSession.builder.master(f"local[{cores}]").appName(app)
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory))
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by the cluster.

    ``spark.checkpoint.dir`` is read from the session.  Only when it is unset
    (tests, a laptop) is a private scratch folder created and registered, and
    only for a local master: on a cluster executors do not share it.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    conf_dir = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    if not conf_dir and re.match(r"local(\[|$)", sc.master) is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not conf_dir:
        conf_dir = tempfile.mkdtemp(prefix="fraudspark-ckpt-")
    sc.setCheckpointDir(conf_dir)
    return sc.getCheckpointDir() or conf_dir


def _local_path(uri: str) -> str | None:
    """The local file-system path of ``uri``, or None for a remote store."""
    parsed = urlparse(uri)
    if parsed.scheme in ("", "file"):
        return parsed.path if parsed.scheme else uri
    return None


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, uniquely named folder under the shared checkpoint folder for
    tables a job writes and reads back (never a machine-local temp folder
    unless the session itself points there)."""
    base = ensure_checkpoint_dir(spark)
    local = _local_path(base)
    unique = f"{name}-{uuid.uuid4().hex[:12]}"
    if local is not None:
        os.makedirs(local, exist_ok=True)
        return os.path.join(local, unique)
    return f"{base.rstrip('/')}/{unique}"


def materialize(df, name: str = "table"):
    """Write ``df`` as Parquet to a fresh folder under the shared checkpoint
    folder and return a DataFrame reading it back.

    This cuts lineage like ``checkpoint()`` (the result survives executor loss
    and is never recomputed), but stores columnar, compressed files, so later
    scans get column pruning and filter pushdown.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def together(calls: Sequence[Callable[[], Any]], at_once: int = SIDE_BY_SIDE) -> list:
    """Results of independent calls, in order; where there are several, the Spark jobs of ``at_once`` at a time
    run side by side."""
    if len(calls) < 2:
        return [c() for c in calls]
    spark = SparkSession.active()
    with ThreadPoolExecutor(min(len(calls), at_once)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(spark)(c)) for c in calls]]
