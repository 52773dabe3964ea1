"""A corpus made ready for training: five stages, each kept as a table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orefold.llm.decontaminate import benchmark_leaks
from orefold.llm.mixing import mix_sources
from orefold.llm.near_dup import near_duplicates
from orefold.llm.quality import quality_rules
from orefold.llm.queries import TOKENIZER, table
from orefold.llm.token_files import token_files
from orefold.llm.words import word_count
from orefold.session import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the thresholds of their language.

    Null and empty texts fail; an empty table stays empty.
    """
    return quality_rules(docs, table(spark, sf_dir, "labels"), whole_rows=True).filter("kept").select("row.*")


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group; rows without id stay.

    Rows equal in id and text are one document. Of texts that share an id all stay.
    """
    kept = near_duplicates(docs).filter("kept and doc_id is not null").select("doc_id")
    same = [F.col("doc_id"), F.md5(F.coalesce("text", F.lit("")))]
    chosen = docs.join(kept, "doc_id", "left_semi").select(F.struct(*docs.columns).alias("row"), *(c.alias(f"_{i}") for i, c in enumerate(same)))
    return chosen.dropDuplicates(["_0", "_1"]).select("row.*").union(docs.filter("doc_id is null"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark.

    Rows that share an id go together; rows without id, null and empty texts stay.
    """
    leaks = benchmark_leaks(docs, table(spark, sf_dir, "benchmark"))
    return docs.join(leaks.select("doc_id").distinct(), "doc_id", "left_anti").select(*docs.columns)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it, at most three times.

    Null sources are one source; rows that share an id are taken together.
    """
    mixed = mix_sources(docs, size=word_count(F.col("text")), whole_rows=True)
    repeated = mixed.filter("copies > 0").select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return repeated.select("row.*")


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The binary files, and a row per record read back from them.

    Null text counts as empty, null ids come first, repeated rows are repeated records.
    """
    return token_files(spark, docs, tokenizer=TOKENIZER, end_id=1)


STAGES: list[tuple[str, Stage]] = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("mix", mix),
    ("token_output", token_output),
]

# The tokenizer, the learnt thresholds and the binary files are beyond SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each is written, and the next reads that."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
