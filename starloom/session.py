"""Session construction and the shared scratch location.

Library code never changes the configuration of a session it is handed;
only :func:`build_session` (tests, benchmarks, local runs) sets options.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

# Options for local and test sessions. On a cluster these come from the
# deployment; the values below only reflect what this library relies on:
# AQE for runtime broadcast/coalesce/skew handling and UTC so that
# timestamp_ntz arithmetic does not depend on the machine zone.
LOCAL_OPTIONS = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "starloom", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the options the library expects."""
    cpus = os.environ.get("BENCH_CPUS")
    master = master or f"local[{cpus or '*'}]"
    builder = SparkSession.builder.master(master).appName(app_name)
    opts = dict(LOCAL_OPTIONS)
    opts["spark.sql.shuffle.partitions"] = str(shuffle_partitions or int(cpus or 8))
    opts["spark.driver.memory"] = os.environ.get("STARLOOM_DRIVER_MEMORY", "8g")
    opts.update(extra or {})
    for k, v in opts.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


_local_scratch: str | None = None


def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for intermediate tables.

    Uses ``spark.checkpoint.dir`` as named by the cluster. Only when it is
    unset on a local master (local runs, tests) this process makes a folder of
    its own; anywhere else, also where the master cannot be seen, an unset
    folder is an error. The session's configuration is not touched.
    """
    global _local_scratch
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.sparkContext.getCheckpointDir()
        except Exception:  # Spark Connect: no SparkContext on the client
            configured = None
    if configured:
        return configured.rstrip("/")
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        # a machine-local folder is not shared by executors and is lost with them
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster "
                           f"(master {master!r} has none)")
    if _local_scratch is None:
        _local_scratch = tempfile.mkdtemp(prefix="starloom-ckpt-")
    return _local_scratch


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the scratch folder (never reused)."""
    return f"{scratch_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
