"""One query per operator, with production parameters, over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat import perspectives
from .decontaminate import benchmark_leaks
from .lexical import lexical_search
from .line_runs import repeated_line_runs
from .mixing import mix_sources
from .near_dup import near_duplicates
from .pii import BASE_KINDS, personal_data, written
from .prefix_trie import keyed_turns, rebuilt_turns, shard_nodes, trie
from .pseudo_lm import pseudo_likelihood
from .quality import BASE_COLUMNS, quality_rules
from .repeats import repeated_bytes
from .token_files import token_files
from .warc import warc_records
from .words import word_count

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *BASE_COLUMNS, "base_failed", "kept", "stratum", "badness", "cutoff")


def op2_superminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=2)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files(spark, table(spark, sf_dir, "documents"), tokenizer=TOKENIZER, end_id=1)


def op3_perspectives(spark: SparkSession, sf_dir: str) -> DataFrame:
    spans = F.transform("mask", lambda m: F.concat_ws(":", m["start"], m["end"]))
    return perspectives(table(spark, sf_dir, "conversations")).withColumn("mask", F.array_join(spans, ","))


def op5_line_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_line_runs(table(spark, sf_dir, "documents")).drop("kept_text", "copied")


def op6_pseudo_likelihood(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudo_likelihood(table(spark, sf_dir, "documents"))


def op7_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents")).select(
        "doc_id",
        *[f"n_{kind}" for kind in BASE_KINDS],
        F.sha2(written(F.col("base")), 256).alias("base_sha256"),
        written(F.col("found")).alias("spans"),
    )


def op8_repeated_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeated_bytes(table(spark, sf_dir, "documents")).drop("removed")


def op9_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return benchmark_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"), size=word_count(F.col("text")))
    return mixed.select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"), "source", "copies"
    )


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, members = rebuilt_turns(keyed_turns(table(spark, sf_dir, "conversations")))
    return trie(shard_nodes(turns, members)).drop("path")


def op12_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_records(spark, table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


QUERIES: dict[str, Query] = {
    "op1_quality_rules": op1_quality_rules,
    "op2_superminhash": op2_superminhash,
    "op3_perspectives": op3_perspectives,
    "op4_token_files": op4_token_files,
    "op5_line_runs": op5_line_runs,
    "op6_pseudo_likelihood": op6_pseudo_likelihood,
    "op7_personal_data": op7_personal_data,
    "op8_repeated_bytes": op8_repeated_bytes,
    "op9_benchmark_leaks": op9_benchmark_leaks,
    "op10_mix_sources": op10_mix_sources,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_warc": op12_warc,
    "op13_lexical_search": op13_lexical_search,
}
