"""The layered build beside its naive form: python -m benchmarks.compare_naive

Naive means: one `withColumn` per column, a count after every step, sorted gold
writes, rank in an unpartitioned window, a preview of every gold table. Both
start from the same CSV files and must give the same gold tables.
"""

from __future__ import annotations

import os
import statistics
import tempfile
import time

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orefold.operators import summarize
from orefold.plans.layers import Layers, read_raw_csv, run_layers
from orefold.session import build_session
from orefold.workload.lines import LINES, given, named_lines, raw_lines
from orefold.workload.queries import fresh_layer, write_csv


def sources(spark: SparkSession, lines: str, parts: str) -> dict[str, DataFrame]:
    return {
        LINES.facts.name: read_raw_csv(spark, LINES.facts, lines),
        LINES.dimension.name: read_raw_csv(spark, LINES.dimension, parts),
    }


def ours(spark: SparkSession, lines: str, parts: str) -> dict[str, DataFrame]:
    run, folder = fresh_layer(spark)
    layers = Layers(f"{run}_b", f"{run}_s", f"{run}_g", location=folder)
    run_layers(spark, LINES, sources(spark, lines, parts), layers)
    return {t.name: spark.table(f"{layers.gold}.{t.name}") for t in LINES.gold}


def naive(spark: SparkSession, lines: str, parts: str) -> dict[str, DataFrame]:
    run, folder = fresh_layer(spark)
    spark.sql(f"CREATE SCHEMA {run} LOCATION '{folder}'")

    def save(df: DataFrame, name: str) -> DataFrame:
        df.write.saveAsTable(f"{run}.{name}")
        df.count()
        return spark.table(f"{run}.{name}")

    stored = {}
    for name, df in sources(spark, lines, parts).items():
        df = df.withColumn("_ingestion_timestamp", F.current_timestamp())
        stored[name] = save(df.withColumn("_source_layer", F.lit("raw")), name)
    facts, dim = stored[LINES.facts.name], stored[LINES.dimension.name]
    facts.count()
    dim.count()

    facts = facts.drop("_ingestion_timestamp", "_source_layer")
    for name in facts.columns:
        facts = facts.withColumn(
            name, F.when(F.col(name) == "?", None).otherwise(F.col(name))
        )
    for name, kind in LINES.facts.types.items():
        facts = facts.withColumn(name, F.col(name).cast(kind))
    facts = facts.withColumn("flag", F.lower(F.trim("flag")))
    facts.count()
    facts = facts.dropDuplicates()
    facts.count()
    for name, make in LINES.derived.items():
        facts = facts.withColumn(name, make())
    for name, kind in LINES.dimension.types.items():
        dim = dim.withColumn(name, F.col(name).cast(kind))
    dim.count()
    dim = (
        dim.filter(LINES.snapshot())
        .drop("p_name", "p_brand", "_ingestion_timestamp", "_source_layer")
        .withColumnRenamed("p_partkey", LINES.key)
    )
    for old, new in LINES.snapshot_rename.items():
        dim = dim.withColumnRenamed(old, new)
    silver = facts.join(dim, on=LINES.key, how="left")
    silver.count()
    silver = save(silver, LINES.silver)
    silver.count()

    made = {}
    for table in LINES.gold:
        kept = silver if table.where is None else silver.filter(table.where())
        groups = summarize(kept, table.keys, table.measures)
        order = F.desc(table.measures[0].name)
        if table.rank:
            window = Window.orderBy(F.desc(table.rank.score))
            groups = groups.withColumn(table.rank.name, F.rank().over(window))
            order = F.asc(table.rank.name)
        made[table.name] = save(groups.orderBy(order), table.name)
        groups.orderBy(order).take(5)
    return made


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    with tempfile.TemporaryDirectory(prefix="orefold-naive-") as scratch:
        spark = build_session(
            "orefold-naive",
            f"local[{cpus}]",
            {
                "spark.sql.shuffle.partitions": cpus,
                "spark.ui.enabled": "false",
                "spark.driver.memory": "4g",
                "spark.checkpoint.dir": f"{scratch}/shared",
                "spark.sql.warehouse.dir": f"{scratch}/warehouse",
            },
        )
        spark.sparkContext.setLogLevel("ERROR")
        lines = write_csv(named_lines(raw_lines(spark, sf_dir)), "lines")
        parts = write_csv(given(spark, sf_dir, "part"), "parts")
        results = {}
        for label, form in (("naive", naive), ("ours", ours)):
            form(spark, lines, parts)
            times = []
            for _ in range(3):
                start = time.perf_counter()
                results[label] = form(spark, lines, parts)
                times.append(time.perf_counter() - start)
            print(f"{label}: {statistics.median(times):.2f}s")
        for table in LINES.gold:
            left = results["naive"][table.name]
            right = results["ours"][table.name].drop("_gold_timestamp").select(left.columns)
            same = left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()
            print(f"{table.name}: {'same rows' if same else 'DIFFERENT'}")


if __name__ == "__main__":
    main()
