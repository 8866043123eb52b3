"""Session settings the package is written for, and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings worth having when submitting; none of them changes a result.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Row-level joins that feed an aggregate on the same key still get split.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # One open writer per sample instead of a sort by sample in every task.
    "spark.sql.maxConcurrentOutputFileWriters": "48",
    "spark.sql.session.timeZone": "UTC",
}

_local_roots: dict[str, str] = {}


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named in spark.checkpoint.dir.

    A temporary folder is made only where the setting is missing and the master is
    local; on a cluster a missing setting is an error, since executors could not see it.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    app = spark.conf.get("spark.app.id", "local")
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="claimbrook-")
    return _local_roots[app]


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder name under the shared scratch folder."""
    return f"{scratch_root(spark)}/claimbrook/{label}-{uuid.uuid4().hex}"
