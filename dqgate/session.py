"""Session creation and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def get_session(app_name: str = "dqgate", cores: str | int = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


_local_bases: dict[str, str] = {}


def scratch_dir(spark: SparkSession, label: str = "work") -> str:
    """A new folder name under the shared folder named by `spark.checkpoint.dir`.

    Only a local session without that setting gets a machine-local folder; on a
    cluster the setting is required.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        context = spark.sparkContext
        base = context.getCheckpointDir()
        if not base and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        if not base:
            base = _local_bases.setdefault(context.applicationId, "") or tempfile.mkdtemp(prefix="dqgate-")
            _local_bases[context.applicationId] = base
    return f"{base.rstrip('/')}/dqgate/{label}-{uuid.uuid4().hex}"
