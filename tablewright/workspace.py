"""The shared folder that holds checkpoints, staged batches and scratch namespaces."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

from tablewright.naming import quote, sql_text

_SETTING = "spark.checkpoint.dir"


def shared_root(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it.

    Only a local session without the setting gets a folder of its own; on a
    cluster a machine-local folder would be lost with its machine.
    """
    configured = spark.conf.get(_SETTING, None)
    if configured:
        return configured.rstrip("/")
    already = spark.sparkContext.getCheckpointDir()
    if already:
        return already.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_SETTING} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tablewright-")
    spark.sparkContext.setCheckpointDir(folder)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_root(spark)}/tablewright/{label}-{uuid.uuid4().hex[:12]}"


def scratch_namespace(spark: SparkSession, label: str) -> str:
    """A new, empty namespace stored below the shared folder."""
    name = f"tw_{label}_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {quote(name)} LOCATION {sql_text(f'{shared_root(spark)}/tablewright/{name}')}")
    return name
