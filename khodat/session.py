"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every job here assumes. Shuffle widths are left to AQE: it starts from
# spark.sql.shuffle.partitions (a cluster setting) and merges or splits by size.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # A page can be megabytes: keep the batches handed to Python workers small.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.parquet.compression.codec": "snappy",
    # The JVM never compiles a method above 8000 bytecodes. Wide projections of parsers pass that as one
    # whole-stage method; above the limit Spark generates several smaller methods per operator instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def build_session(app_name: str, master: str | None = None, **extra: str) -> SparkSession:
    """A session with SETTINGS; ``extra`` maps setting names (dots as ``__``) to values."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SETTINGS, **{k.replace("__", "."): v for k, v in extra.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    A local session without that setting gets a fresh folder under /tmp. On a cluster
    the setting is required: a machine-local folder would be lost with its machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    application = spark.conf.get("spark.app.id")
    if application not in _local_roots:
        _local_roots[application] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    return _local_roots[application]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_root(spark)}/khodat-{uuid.uuid4().hex}/{label}"


def scratch_database(spark: SparkSession) -> str:
    """A new database whose tables live below the shared folder; returns its name."""
    name = f"scratch_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, name)}'")
    return name
