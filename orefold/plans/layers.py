"""The three layers from end to end, for any fact table and dimension."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import normalized, unmasked
from ..operators import (
    cast_columns,
    dedupe,
    dedupe_by_fingerprint,
    dimension_snapshot,
    enrich_left,
    frequent_keys,
    normalize_text,
    reject_counters,
    rejected_values,
    sentinel_to_null,
)
from ..sinks import Layout, Published, Staged, commit, discard, ensure_layer, publish, publish_all, stage
from ..sources import (
    drop_bronze_audit,
    read_csv_declared,
    read_csv_strings,
    read_table,
    with_bronze_audit,
    with_gold_audit,
    with_silver_audit,
)
from .gold import GoldTable, build_gold_tables, group_finest


@dataclass(frozen=True)
class RawTable:
    """A raw string table and how to clean it.

    `masked` lists the columns in which the sentinel stands for null; None
    means all string columns. With `declared` the CSV columns are checked
    against `columns`, otherwise they are taken from the header.
    """

    name: str
    columns: Sequence[str]
    types: Mapping[str, str]
    text: Sequence[str]
    masked: Sequence[str] | None = None
    declared: bool = True
    source_file: str | None = None


@dataclass(frozen=True)
class Build:
    facts: RawTable
    dimension: RawTable
    key: str
    derived: Mapping[str, Callable[[], Column]]
    snapshot: Callable[[], Column]
    snapshot_drop: Sequence[str]
    snapshot_rename: Mapping[str, str]
    silver: str
    gold: Sequence[GoldTable]
    silver_dimension: str  # the typed dimension, all snapshots
    sentinel: str = "?"
    dimension_key: str | None = None  # its name in the dimension, if different
    snapshot_columns: Sequence[str] = ()  # what snapshots are told apart by: folders of the typed dimension

    @property
    def rejects(self) -> str:
        """The table of malformed values beside Silver."""
        return f"{self.silver}_rejects"


@dataclass(frozen=True)
class Layers:
    bronze: str = "bronze"
    silver: str = "silver"
    gold: str = "gold"
    location: str | None = None  # parent folder of the three schemas
    fmt: str = "parquet"

    def folder(self, layer: str) -> str | None:
        return f"{self.location.rstrip('/')}/{layer}" if self.location else None


@dataclass
class Report:
    """What was published, with the row counts the writes observed."""

    bronze: dict[str, Published] = field(default_factory=dict)
    silver: Published | None = None
    silver_dimension: Published | None = None
    rejects: Published | None = None  # of a lenient run
    hot_keys: list | None = None  # of a salted run, most frequent first
    gold: dict[str, Published] = field(default_factory=dict)

    def removed_copies(self, build: Build) -> int:
        return self.bronze[build.facts.name].rows - self.silver.rows


class TooManyRejects(ValueError):
    """Malformed values beyond the allowed number; nothing was published."""


def read_raw_csv(spark: SparkSession, raw: RawTable, path: str) -> DataFrame:
    if raw.declared:
        return read_csv_declared(spark, path, raw.columns)
    return read_csv_strings(spark, path)


def clean(df: DataFrame, raw: RawTable, sentinel: str, lenient: bool = False) -> DataFrame:
    """Raw strings to typed, normalised columns, without the Bronze audit."""
    return (
        df.transform(drop_bronze_audit)
        .transform(sentinel_to_null, raw.masked, sentinel)
        .transform(cast_columns, raw.types, lenient)
        .transform(normalize_text, raw.text)
    )


def typed_dimension(df: DataFrame, build: Build, lenient: bool = False) -> DataFrame:
    """The dimension with all its snapshots, typed, under its own column names."""
    return clean(df, build.dimension, build.sentinel, lenient)


def join_side(typed: DataFrame, build: Build) -> DataFrame:
    """The rows of a typed dimension that facts join to, renamed for the join."""
    rename = dict(build.snapshot_rename)
    if build.dimension_key:
        rename[build.dimension_key] = build.key
    return dimension_snapshot(typed, build.snapshot(), rename, build.snapshot_drop)


def clean_dimension(df: DataFrame, build: Build, lenient: bool = False) -> DataFrame:
    """`join_side` straight from raw rows."""
    return join_side(typed_dimension(df, build, lenient), build)


def build_silver(
    facts: DataFrame,
    dimension: DataFrame,
    build: Build,
    *,
    lenient: bool = False,
    salt_buckets: int = 0,
    hot_limit: int = 100,
    by_fingerprint: bool = False,
) -> DataFrame:
    """Clean, de-duplicate, derive and enrich; one lazy plan over Bronze.

    `dimension` holds raw rows; what is typed already is taken as it is.
    `by_fingerprint` finds copies by `dedupe_by_fingerprint`, which stores the
    repeated fingerprints at once.
    """
    return _silver(
        facts,
        clean_dimension(dimension, build, lenient),
        build,
        lenient=lenient,
        salt_buckets=salt_buckets,
        hot_limit=hot_limit,
        by_fingerprint=by_fingerprint,
    )


def _silver(
    facts: DataFrame,
    side: DataFrame,
    build: Build,
    *,
    lenient: bool,
    salt_buckets: int,
    hot_limit: int,
    by_fingerprint: bool,
    hot: Sequence | None = None,
    shuffled: bool = False,
    rows_by_key: int | None = None,
) -> DataFrame:
    cleaned = facts.transform(clean, build.facts, build.sentinel, lenient)
    if rows_by_key is not None:
        cleaned = _dealt_by_key(cleaned, build.key, rows_by_key)
    return (
        cleaned.transform(dedupe_by_fingerprint if by_fingerprint else dedupe)
        .withColumns({name: make() for name, make in build.derived.items()})
        .transform(with_silver_audit)
        .transform(
            enrich_left,
            side,
            build.key,
            salt_buckets=salt_buckets,
            hot_limit=hot_limit,
            keys=_keys(facts, build, lenient) if hot is None else None,
            hot=hot,
            shuffled=shuffled,
        )
    )


def _dealt_by_key(facts: DataFrame, key: str, rows: int) -> DataFrame:
    """Facts shuffled on the join key: copies meet there, and the join needs no shuffle of its own.

    The number of tasks follows the rows, so that what a task holds to find
    copies does not grow with the table; few rows are left to the planner.
    """
    tasks = min(math.ceil(rows / _TASK_ROWS), _MOST_TASKS)
    if tasks <= facts.sparkSession.sparkContext.defaultParallelism:
        return facts.repartition(F.col(key))
    return facts.repartition(tasks, key)


def cleaned_key(build: Build) -> Column:
    """The key of a raw fact row as Silver will have it; malformed ones are null."""
    raw, key = build.facts, F.col(build.key)
    if raw.masked is None or build.key in raw.masked:
        key = unmasked(key, build.sentinel)
    if build.key in raw.types:
        key = key.try_cast(raw.types[build.key])
    return normalized(key) if build.key in raw.text else key


def _keys(facts: DataFrame, build: Build, lenient: bool) -> DataFrame:
    """The key column of the facts, cleaned, with the copies still in it.

    Enough to find frequent keys, and read without the other columns.
    """
    raw, key = build.facts, build.key
    only = replace(
        raw,
        types={name: kind for name, kind in raw.types.items() if name == key},
        text=[name for name in raw.text if name == key],
        masked=None if raw.masked is None else [name for name in raw.masked if name == key],
    )
    return clean(facts.select(key), only, build.sentinel, lenient)


# Summing up by all gold keys first pays when it leaves at most this share of the rows.
_FEW_GROUPS = 0.05

# Numbers of dimension rows for which Silver is stored with the rows of a key together.
# Dealt at random, each task that sums up meets nearly every key: its groups merge too
# little and spill. A larger dimension is shuffled anyway, as the planner sees fit.
_MANY_KEYS, _MOST_KEYS = 50_000, 10_000_000

# Facts per task where they are dealt by their key alone. A key with more rows would make
# its task long, so then copies are looked for by whole rows and the join shuffles again.
_TASK_ROWS, _MOST_TASKS = 500_000, 20_000


def run_layers(
    spark: SparkSession,
    build: Build,
    sources: Mapping[str, DataFrame],
    layers: Layers = Layers(),
    *,
    max_rejects: int | None = None,
    salt_buckets: int = 0,
    hot_limit: int = 100,
    by_fingerprint: bool = False,
    silver_layout: Layout | None = None,
) -> Report:
    """Publish Bronze, Silver and Gold; each layer reads the stored one before.

    `sources` maps the two Bronze names to raw frames: CSV scans or tables,
    also the Bronze tables themselves. Silver is the enriched facts and the
    typed dimension, whose folders are its snapshots. Casts are strict unless
    `max_rejects` is given; then up to that many malformed values of facts and
    dimension become null and are listed in a table beside Silver, and with
    more Silver is left as it was. The tables of a layer are replaced in one
    commit: if one cannot be written, all stay as they were. The gold tables
    are summed up together, from one scan of Silver. The frequent keys are
    observed while Bronze is written: `salt_buckets` spreads them, and where
    there are none and the dimension is large, one shuffle on the key serves
    both the search for copies and the join.
    """
    report = Report()
    keys = Observation()
    by_key = bool(build.gold) and not salt_buckets and not by_fingerprint
    watch_keys = by_key or bool(salt_buckets)
    for layer in (layers.bronze, layers.silver, layers.gold):
        ensure_layer(spark, layer, layers.folder(layer))

    def put_bronze(raw: RawTable) -> Published:
        source = sources[raw.name]
        known = "_source_file" in source.columns
        audited = with_bronze_audit(source, None if known else raw.source_file)
        if watch_keys and raw is build.facts:
            audited = audited.observe(keys, frequent_keys(cleaned_key(build), hot_limit).alias("frequent"))
        return publish(audited, layers.bronze, raw.name, location=layers.folder(layers.bronze), fmt=layers.fmt)

    report.bronze = _side_by_side(put_bronze, (build.facts, build.dimension), spark)
    frequent = (keys.get["frequent"] or []) if watch_keys else []
    if salt_buckets:
        report.hot_keys = [row["item"] for row in frequent if row["item"] is not None]

    facts = read_table(spark, f"{layers.bronze}.{build.facts.name}")
    dimension = read_table(spark, f"{layers.bronze}.{build.dimension.name}")
    staged: list[Staged] = []
    groups = Observation()
    try:
        counts = _Watch(max_rejects is not None)
        lenient = counts.on

        def put(df: DataFrame, name: str, layout: Layout | None = None) -> Staged:
            done = stage(df, layers.silver, name, location=layers.folder(layers.silver), fmt=layers.fmt, layout=layout)
            staged.append(done)
            return done

        typed = typed_dimension(counts.watched(dimension, build.dimension, build.sentinel), build, lenient)
        by_snapshot = Layout(partition_by=build.snapshot_columns)
        stored_dimension = put(typed, build.silver_dimension, by_snapshot)
        side = join_side(spark.table(stored_dimension.version), build)
        by_key = by_key and stored_dimension.rows >= _MANY_KEYS
        by_key = by_key and max((row["count"] for row in frequent), default=0) <= _TASK_ROWS
        silver = _silver(
            counts.watched(facts, build.facts, build.sentinel),
            side,
            build,
            lenient=lenient,
            salt_buckets=salt_buckets,
            hot_limit=hot_limit,
            by_fingerprint=by_fingerprint,
            hot=report.hot_keys,
            shuffled=bool(build.gold) and _MANY_KEYS <= stored_dimension.rows <= _MOST_KEYS,
            rows_by_key=report.bronze[build.facts.name].rows if by_key else None,
        )
        finest = F.approx_count_distinct(group_finest(build.gold)).alias("groups")
        put(silver.observe(groups, finest) if build.gold else silver, build.silver, silver_layout)
        if lenient:
            _check_rejects(spark, put, counts, facts, dimension, build, max_rejects)
    except Exception:
        discard(spark, staged)
        raise
    published = commit(spark, layers.silver, staged)
    report.silver = published[build.silver]
    report.silver_dimension = published[build.silver_dimension]
    report.rejects = published.get(build.rejects)

    stored = read_table(spark, f"{layers.silver}.{build.silver}")
    few = bool(build.gold) and groups.get["groups"] <= _FEW_GROUPS * report.silver.rows
    gold = build_gold_tables(stored, build.gold, pre_aggregate=few)
    audited = {name: with_gold_audit(df) for name, df in gold.items()}
    report.gold = publish_all(audited, layers.gold, location=layers.folder(layers.gold), fmt=layers.fmt)
    return report


def _side_by_side(put: Callable, tables: Sequence, spark: SparkSession) -> dict:
    """Build independent tables at once, so one job's last tasks leave no slot idle."""
    carried = inheritable_thread_target(spark)(put)  # job group and tags go along
    with ThreadPoolExecutor(max_workers=max(1, len(tables))) as pool:
        return dict(zip((t.name for t in tables), pool.map(carried, tables)))


class _Watch:
    """Counts malformed values in the jobs that write the cleaned tables."""

    def __init__(self, on: bool):
        self.on, self.seen = on, []

    def watched(self, raw: DataFrame, table: RawTable, sentinel: str) -> DataFrame:
        """The rows without masks, and their malformed values observed."""
        unmasked = sentinel_to_null(drop_bronze_audit(raw), table.masked, sentinel)
        if not self.on or not table.types:
            return unmasked
        self.seen.append(Observation())
        return unmasked.observe(self.seen[-1], *reject_counters(table.types))

    def most(self) -> int:
        """Never too low: a map task run again after a lost executor counts twice."""
        return sum(n for one in self.seen for n in one.get.values())


def table_rejects(raw: DataFrame, table: RawTable, sentinel: str) -> DataFrame:
    """The malformed values of a Bronze table: table, row, column, value and source file."""
    unmasked = sentinel_to_null(raw, table.masked, sentinel)
    rejected = rejected_values(unmasked, table.types, ["_source_file"], drop_bronze_audit(raw).columns)
    return rejected.select(F.lit(table.name).alias("source_table"), "*")


def _check_rejects(
    spark: SparkSession,
    put: Callable[[DataFrame, str], Staged],
    counts: _Watch,
    facts: DataFrame,
    dimension: DataFrame,
    build: Build,
    max_rejects: int,
) -> None:
    """Stages the malformed values; too many of them are an error.

    Bronze is scanned for them only if the writes met any.
    """
    raws = ((facts, build.facts), (dimension, build.dimension))
    found = [table_rejects(raw, table, build.sentinel) for raw, table in raws]
    if counts.most() == 0:
        found = [one.limit(0) for one in found]
    rejects = spark.table(put(found[0].union(found[1]), build.rejects).version)
    exact = {(r[0], r[1]): r[2] for r in rejects.groupBy("source_table", "column").count().collect()}
    if sum(exact.values()) > max_rejects:
        named = {
            (name if table is build.facts else f"{table.name}.{name}"): exact[table.name, name]
            for _, table in raws
            for name in table.types
            if (table.name, name) in exact
        }
        raise TooManyRejects(f"malformed values by column: {named}")
