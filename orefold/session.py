"""Session settings and the shared folder that intermediate tables go to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

# Settings the library is written for. All of them can be changed at run time,
# so a session built elsewhere may apply them with `tune`.
RECOMMENDED = {
    # Strict casts: a malformed number stops the load instead of becoming null.
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    # Sizes shuffle partitions, switches to broadcast joins from measured sizes
    # and splits hot join partitions, even where that costs one more exchange.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

_local_dirs: list[tempfile.TemporaryDirectory] = []


def build_session(
    app: str = "orefold", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """A session with the recommended settings; `conf` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RECOMMENDED, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def tune(spark: SparkSession) -> SparkSession:
    for key, value in RECOMMENDED.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, from `spark.checkpoint.dir`.

    Only a local-mode session may go without that setting; it then gets a
    temporary folder that is removed when Python exits.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError(
            "set spark.checkpoint.dir to a folder shared by all executors"
        )
    if not _local_dirs:
        _local_dirs.append(tempfile.TemporaryDirectory(prefix="orefold-"))
    return _local_dirs[0].name


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path in the shared folder that no earlier call has returned.

    All paths of one application share a parent, which can go once it is over.
    """
    application = spark.conf.get("spark.app.id", "application")
    return f"{shared_dir(spark)}/orefold/{application}/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, partition_by: Sequence[str] = ()) -> DataFrame:
    """Write `df` once and read it back.

    For a frame that feeds several branches of one plan: its inputs are then
    scanned once, and a lost executor costs a re-read, not a re-computation.
    Branches that filter on a column of `partition_by` read only their folders.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.partitionBy(*partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
