"""Full-refresh publishing: write new versions, then commit them together.

Each layer has one commit record, a view that says which stored version stands
behind each name. Replacing that view is the commit, of one table or of many:
`read_table` and `read_layer` resolve names through it, so they see all tables
of one commit or none. The names are views as well, for plain SQL; they move one
by one after the commit, and `settle` moves those that a lost driver left behind.
"""

from __future__ import annotations

import re
import threading
import uuid
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, DataFrameWriter, Observation, SparkSession
from pyspark.sql import functions as F

# Formats whose own overwrite is atomic and may read the table it replaces.
_TRANSACTIONAL = ("delta",)

COMMIT = "_commit"
_committing = threading.Lock()


@dataclass(frozen=True)
class Published:
    table: str  # the name readers use
    version: str  # the stored table behind that name
    rows: int


@dataclass(frozen=True)
class Layout:
    """How a stored table is laid out.

    `partition_by` columns become folders, for filters that name whole values.
    With `buckets` the rows are dealt by `bucket_by`, so that joins and groups
    on these columns need no shuffle; one bucket is one file, so use it for
    columns without hot values. `sort_by` sorts inside a file.
    """

    partition_by: Sequence[str] = ()
    bucket_by: Sequence[str] = ()
    buckets: int = 0
    sort_by: Sequence[str] = ()


@dataclass(frozen=True)
class Staged:
    """A stored version that no name shows yet."""

    table: str
    version: str
    rows: int
    fmt: str = "parquet"


def _quoted(name: str) -> str:
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def _escaped(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def ensure_layer(spark: SparkSession, layer: str, location: str | None = None) -> None:
    """Create the schema of a layer if missing; its tables go under `location`."""
    place = " LOCATION '" + _escaped(location) + "'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_quoted(layer)}{place}")


def publish(
    df: DataFrame,
    layer: str,
    table: str,
    *,
    location: str | None = None,
    fmt: str = "parquet",
    keep: int = 1,
    layout: Layout | None = None,
    before_swap: Callable[[], None] | None = None,
) -> Published:
    """Replace `layer.table`, data and schema, with `df`.

    The rows go to a new version table. Only when that is complete does the
    name, a view, move to it, so readers see the old or the new table and `df`
    may read the very table it replaces. If `before_swap` raises, the new
    version is dropped and the name stays where it was. The `keep` versions
    before the new one remain for readers that are still running. Without a
    `layout` the new version has that of the one before. Formats with an atomic
    overwrite of their own keep versions themselves (`keep` and `layout` do not
    apply); with a gate their rows are written aside first.

    The row count is observed in the last stage of the write itself.
    """
    spark = df.sparkSession
    if fmt in _TRANSACTIONAL and before_swap is None:
        ensure_layer(spark, layer, location)
        seen = Observation()
        _overwrite(df.observe(seen, F.count(F.lit(1)).alias("rows")), f"{layer}.{table}", fmt)
        return Published(f"{layer}.{table}", f"{layer}.{table}", seen.get["rows"])
    staged = stage(df, layer, table, location=location, fmt=fmt, layout=layout)
    if before_swap is not None:
        try:
            before_swap()
        except Exception:
            discard(spark, [staged])
            raise
    return commit(spark, layer, [staged], keep=keep)[table]


def stage(
    df: DataFrame,
    layer: str,
    table: str,
    *,
    location: str | None = None,
    fmt: str = "parquet",
    layout: Layout | None = None,
) -> Staged:
    """Store `df` as a new version of `layer.table` without showing it."""
    spark = df.sparkSession
    ensure_layer(spark, layer, location)
    if layout is None:
        layout = layout_of(spark, layer, table, df.columns)
    seen = Observation()
    # After the rows are dealt out, as a task of an earlier stage may run and count twice.
    counted = _dealt(df, layout).observe(seen, F.count(F.lit(1)).alias("rows"))
    stored_as = "parquet" if fmt in _TRANSACTIONAL else fmt
    version = write_version(counted, layer, table, fmt=stored_as, layout=layout)
    return Staged(table, version, seen.get["rows"], fmt)


def discard(spark: SparkSession, staged: Sequence[Staged]) -> None:
    for one in staged:
        drop_version(spark, one.version)


def commit(spark: SparkSession, layer: str, staged: Sequence[Staged], keep: int = 1) -> dict[str, Published]:
    """Show all staged versions of a layer at once.

    The commit record moves in one step; after it the views of the names
    follow. If the record cannot be written, the staged versions go and all
    stays as it was. A failure after it leaves views behind, but the commit
    holds. One application commits to a layer at a time.

    A table loaded by other means is set aside first, and its name is missing
    until the commit. Formats with an overwrite of their own stand outside the
    record: they are overwritten one after the other.
    """
    versioned = [one for one in staged if one.fmt not in _TRANSACTIONAL]
    if versioned:
        with _committing:
            aside: dict[str, str | None] = {}
            try:
                for one in versioned:
                    aside[one.table] = _set_loaded_table_aside(spark, layer, one.table)
                record = {**read_commit(spark, layer), **{one.table: one.version for one in versioned}}
                _write_commit(spark, layer, record)
            except Exception:
                for table, loaded in aside.items():
                    if loaded:
                        spark.sql(f"ALTER TABLE {_quoted(loaded)} RENAME TO {_quoted(f'{layer}.{table}')}")
                discard(spark, staged)
                raise
            for one in versioned:
                _point(spark, layer, one.table, one.version)
                _drop_old_versions(spark, layer, one.table, one.version, keep)
    done = {one.table: Published(f"{layer}.{one.table}", one.version, one.rows) for one in versioned}
    for one in staged:
        if one.fmt in _TRANSACTIONAL:
            name = f"{layer}.{one.table}"
            try:
                _overwrite(spark.table(_quoted(one.version)), name, one.fmt)
            finally:
                drop_version(spark, one.version)
            done[one.table] = Published(name, name, one.rows)
    return done


def read_commit(spark: SparkSession, layer: str) -> dict[str, str]:
    """The stored version behind each name of the layer; empty before the first commit."""
    name = f"{layer}.{COMMIT}"
    if not spark.catalog.tableExists(name):
        return {}
    return {row["table_name"]: row["version"] for row in spark.table(_quoted(name)).collect()}


def _write_commit(spark: SparkSession, layer: str, record: Mapping[str, str]) -> None:
    rows = ", ".join(f"('{_escaped(table)}', '{_escaped(version)}')" for table, version in sorted(record.items()))
    listed = f"SELECT * FROM VALUES {rows} AS t(table_name, version)"
    spark.sql(f"CREATE OR REPLACE VIEW {_quoted(f'{layer}.{COMMIT}')} AS {listed}")


def _point(spark: SparkSession, layer: str, table: str, version: str) -> None:
    name = _quoted(f"{layer}.{table}")
    spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM {_quoted(version)}")


def settle(spark: SparkSession, layer: str) -> None:
    """Point every view of the layer at its committed version, after a commit that was cut short."""
    with _committing:
        for table, version in read_commit(spark, layer).items():
            if not _is_loaded_table(spark, f"{layer}.{table}"):
                _point(spark, layer, table, version)


def resolve(spark: SparkSession, name: str, record: Mapping[str, str] | None = None) -> str:
    """The table to read for `layer.table`: the committed version, or the name itself."""
    layer, _, table = name.rpartition(".")
    if not layer or (record is None and table == COMMIT):
        return name
    version = (read_commit(spark, layer) if record is None else record).get(table)
    return name if version is None or _is_loaded_table(spark, name) else version


def write_version(
    df: DataFrame, layer: str, table: str, fmt: str = "parquet", layout: Layout = Layout()
) -> str:
    """Store `df` as a new version table of `layer.table`, without showing it.

    A failed write leaves neither a table nor its folder.
    """
    stamp = datetime.now(timezone.utc).strftime("%Y%m%d%H%M%S%f")
    version = f"{layer}.{_version_prefix(table)}{stamp}_{uuid.uuid4().hex[:6]}"
    try:
        _writer(df, layout).format(fmt).saveAsTable(_quoted(version))
    except Exception:
        _remove_failed(df.sparkSession, layer, version)
        raise
    return version


def _dealt(df: DataFrame, layout: Layout) -> DataFrame:
    if layout.buckets:
        # A task per bucket, so that a bucket is one file.
        return df.repartition(layout.buckets, *layout.bucket_by)
    if layout.partition_by:
        # Few files per folder, and a hot value spread over several tasks.
        return df.hint("rebalance", *layout.partition_by)
    return df


def _writer(df: DataFrame, layout: Layout) -> DataFrameWriter:
    writer = df.write.partitionBy(*layout.partition_by)
    if layout.buckets:
        writer = writer.bucketBy(layout.buckets, *layout.bucket_by)
        return writer.sortBy(*layout.sort_by) if layout.sort_by else writer
    return writer


def layout_of(spark: SparkSession, layer: str, table: str, columns: Sequence[str]) -> Layout:
    """The layout of the committed version, without what `columns` no longer has."""
    version = read_commit(spark, layer).get(table)
    if version is None or not spark.catalog.tableExists(version):
        return Layout()
    listed = spark.catalog.listColumns(_quoted(version))
    partitions = [c.name for c in listed if c.isPartition and c.name in columns]
    bucket_by = [c.name for c in listed if c.isBucket]
    if not bucket_by or not set(bucket_by) <= set(columns):
        return Layout(partitions)
    said = {row["col_name"]: row["data_type"] for row in spark.sql(f"DESCRIBE EXTENDED {_quoted(version)}").collect()}
    sort_by = re.findall(r"`([^`]+)`", said.get("Sort Columns", ""))
    return Layout(partitions, bucket_by, int(said["Num Buckets"]), [c for c in sort_by if c in columns])


def drop_version(spark: SparkSession, version: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(version)}")


def stage_all(
    frames: Mapping[str, DataFrame],
    layer: str,
    *,
    location: str | None = None,
    fmt: str = "parquet",
    layouts: Mapping[str, Layout] | None = None,
) -> list[Staged]:
    """Store several tables side by side; one failed write drops the others."""
    if not frames:
        return []
    spark = next(iter(frames.values())).sparkSession
    ensure_layer(spark, layer, location)
    known = layouts or {}

    def write(table: str) -> Staged:
        return stage(frames[table], layer, table, fmt=fmt, layout=known.get(table))

    with ThreadPoolExecutor(max_workers=len(frames)) as pool:
        jobs = [pool.submit(inheritable_thread_target(spark)(write), table) for table in frames]
    failed = [job.exception() for job in jobs if job.exception()]
    staged = [job.result() for job in jobs if not job.exception()]
    if failed:
        discard(spark, staged)
        raise failed[0]
    return staged


def publish_all(
    frames: Mapping[str, DataFrame],
    layer: str,
    *,
    location: str | None = None,
    fmt: str = "parquet",
    keep: int = 1,
    layouts: Mapping[str, Layout] | None = None,
) -> dict[str, Published]:
    """Replace several tables of a layer, all of them or none, in one commit.

    The versions are written side by side; names move only once all are
    complete, and one failed write drops the others.
    """
    staged = stage_all(frames, layer, location=location, fmt=fmt, layouts=layouts)
    return commit(staged and next(iter(frames.values())).sparkSession, layer, staged, keep=keep)


def _overwrite(df: DataFrame, name: str, fmt: str) -> None:
    df.write.format(fmt).mode("overwrite").option("overwriteSchema", "true").saveAsTable(_quoted(name))


def _remove_failed(spark: SparkSession, layer: str, version: str) -> None:
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(version)}")
    described = spark.sql(f"DESCRIBE SCHEMA {_quoted(layer)}").collect()
    place = next((r[1] for r in described if r[0].lower() == "location"), None)
    if place:
        jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
        path = jvm.org.apache.hadoop.fs.Path(f"{place}/{version.rsplit('.', 1)[1].lower()}")
        path.getFileSystem(conf).delete(path, True)


def _version_prefix(table: str) -> str:
    return f"{table}__v"


def _set_loaded_table_aside(spark: SparkSession, layer: str, table: str) -> str | None:
    """A table loaded by other means becomes the oldest version of its name.

    Returns the name it has now; None if there was no such table.
    """
    name = f"{layer}.{table}"
    if not _is_loaded_table(spark, name):
        return None
    loaded = f"{layer}.{_version_prefix(table)}0_loaded"
    spark.sql(f"DROP TABLE IF EXISTS {_quoted(loaded)}")
    spark.sql(f"ALTER TABLE {_quoted(name)} RENAME TO {_quoted(loaded)}")
    return loaded


def _is_loaded_table(spark: SparkSession, name: str) -> bool:
    """Whether the name is a stored table, not a view of this module."""
    return spark.catalog.tableExists(name) and spark.catalog.getTable(name).tableType != "VIEW"


def _drop_old_versions(
    spark: SparkSession, layer: str, table: str, current: str, keep: int
) -> None:
    """Drops what this module stored for `table`, but for the last `keep`.

    Only names of exactly the form that `write_version` gives are its own;
    neighbours such as `<table>__v1` are somebody else's.
    """
    own = re.compile(re.escape(_version_prefix(table).lower()) + r"(0_loaded|\d{20}_[0-9a-f]{6})")
    current_name = current.rsplit(".", 1)[1].lower()
    listed = spark.sql(f"SHOW TABLES IN {_quoted(layer)}").collect()
    names = (row.tableName.lower() for row in listed)
    older = sorted(name for name in names if own.fullmatch(name) and name < current_name)
    for name in older[: max(0, len(older) - keep)]:
        spark.sql(f"DROP TABLE IF EXISTS {_quoted(f'{layer}.{name}')}")
